"""Removal of repeated passages of words, a count-min sketch ahead of exact grouping.

A word goes when it lies in a window of ``WINDOW`` words whose sequence also starts
in a document with a smaller id; windows are judged on the input, never across
texts. Each partition counts its windows (by the anchors that stand for them) in a
sketch; the merged sketch never counts too low, so a second pass that groups only
windows estimated to be repeated loses none. It groups them exactly, by their words.

Words are runs of anything but ASCII white space, unchanged. A null text has none;
texts of fewer words than a window lose nothing. Ids count as ``windows`` says. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from savormap.llm.near import mixed
from savormap.llm.windows import (
    Flat,
    Units,
    Windows,
    kept_parts,
    marked,
    prefix_hashes,
    removed_units,
    run_hashes,
    utf8,
)

WINDOW = 50
RUN = 8
CELLS = 28  # bits of a cell's number, at most: a sketch of 64 MB
_CHECKED = 1 << 16  # windows checked word by word at a time
CHUNK_BITS = 6  # a chunk has 2**6 words in the mean
_SLICE = 1 << 18  # bytes hashed together
_SPACE = 0x20
_WHITE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_BYTES = np.random.default_rng(3).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _hashes_of(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A polynomial hash of each word's bytes, a bounded part at a time."""
    out = np.empty(len(begin), np.uint64)
    at = 0
    while at < len(begin):
        first = int(begin[at])
        stop = max(at + 1, int(np.searchsorted(end, first + _SLICE, side="right")))
        prefix = prefix_hashes(_BYTES[raw[first : end[stop - 1]]])
        out[at:stop] = run_hashes(prefix, begin[at:stop] - first, end[at:stop] - first)
        at = stop
    return out


def flat(column: pa.Array) -> Flat:
    """Texts as words, apart by one space each."""
    raw, edges = utf8(column)
    white = _WHITE[raw]
    first = np.zeros(len(raw), bool)  # of a text
    first[edges[:-1][np.diff(edges) > 0]] = True
    last = np.append(first[1:], True)[: len(raw)]
    begins = ~white & (first | np.append(True, white[:-1])[: len(raw)])
    ends = ~white & (last | np.append(white[1:], True)[: len(raw)])
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    words = np.searchsorted(begin, edges)
    # Where words are apart by anything but one space (or by the edge of a text) they are put together anew.
    if len(begin) and not (np.all(begin[1:] - end[:-1] <= 1) and np.all(raw[white] == _SPACE)):
        keep = ~white
        keep[end[:-1][begin[1:] > end[:-1]]] = True
        plain = np.where(white, _SPACE, raw)[keep]
        place = np.cumsum(keep) - keep
        raw, begin, end = plain, place[begin], place[end - 1] + 1
    return Flat(raw, words, begin, end, _hashes_of(raw, begin, end))


def hashes(words: list[bytes]) -> np.ndarray:
    """The same hash of each of some words."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(sizes)
    return _hashes_of(np.frombuffer(b"".join(words), np.uint8), end - sizes, end)


def runs(texts: Flat, begin: int, stop: int, run: int) -> np.ndarray:
    """Hashes of the runs that start in a range."""
    prefix = prefix_hashes(texts.hashes[begin : stop + run - 1])
    starts = np.arange(stop - begin)
    return run_hashes(prefix, starts, starts + run)


def breaks(texts: Flat) -> np.ndarray:
    """Words that have a certain hash together with the next, one in 2**``CHUNK_BITS``; of neighbours the first."""
    found = np.zeros(len(texts.hashes), bool)
    pairs = mixed(texts.hashes[:-1] * np.uint64(3) + texts.hashes[1:])
    found[: len(pairs)] = pairs >> np.uint64(64 - CHUNK_BITS) == 0
    found[1:] &= ~found[:-1].copy()
    return found


def alike(windows: Windows) -> np.ndarray:
    """Labels of windows: grouped by hash within their buckets, and checked word by word.

    Where different windows have one hash, they are sorted by their words.
    """
    codes: dict[bytes, int] = {}
    words = np.array([codes.setdefault(w, len(codes)) for w in windows.units], np.int32)
    seen = np.lib.stride_tricks.sliding_window_view(words, windows.width)
    prefix = prefix_hashes(windows.hashes)
    own = run_hashes(prefix, windows.place, windows.place + windows.width)
    order = np.lexsort((own, windows.group))
    group, own, place = windows.group[order], own[order], windows.place[order]
    tied = np.cumsum(np.append(0, (group[1:] != group[:-1]) | (own[1:] != own[:-1])))
    same = tied[1:] == tied[:-1]
    at = np.flatnonzero(same)
    for start in range(0, len(at), _CHECKED):
        some = at[start : start + _CHECKED]
        same[some] = (seen[place[some + 1]] == seen[place[some]]).all(axis=1)
    for run in np.unique(tied[at[~same[at]]]).tolist():
        a, b = np.searchsorted(tied, [run, run + 1])
        raw = {int(n): seen[windows.place[n]].tobytes() for n in order[a:b]}
        order[a:b] = sorted(raw, key=raw.__getitem__)
        same[a : b - 1] = [raw[x] == raw[y] for x, y in zip(order[a : b - 1], order[a + 1 : b], strict=True)]
    labels = np.empty(len(order), np.int64)
    labels[order] = np.cumsum(np.append(0, ~same))
    return labels


def units(window: int = WINDOW, run: int = RUN, cells: int = CELLS) -> Units:
    """Words as units."""
    return Units(
        window,
        run,
        cells,
        6,
        1 << CHUNK_BITS,
        flat=flat,
        runs=lambda texts, begin, stop: runs(texts, begin, stop, run),
        breaks=breaks,
        hashes=hashes,
        again=lambda content: content.split(b" "),
        join=lambda parts: list(chain.from_iterable(parts)),
        alike=alike,
    )


def without_repeats(docs: DataFrame, window: int = WINDOW, run: int = RUN, cells: int = CELLS) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` of every row; ``kept`` is what remains, joined by one space."""

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, gone = flat(batch.column("text")), removed_units(batch.column("spans"))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(texts.edges)),
                    pa.array([int((g[:, 1] - g[:, 0]).sum()) for g in gone], pa.int64()),
                    pa.array([b" ".join(kept_parts(texts, n, g)).decode() for n, g in enumerate(gone)], pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    rows = marked(docs, units(window, run, cells)).select("doc_id", "text", "spans")
    return rows.mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept string")
