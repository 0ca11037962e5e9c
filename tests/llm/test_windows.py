"""Removal of repeated bytes and words against brute force."""

import dataclasses
import random

import numpy as np
import pyarrow as pa
import pytest

from savormap.llm import passages, sketch, substrings, windows
from savormap.llm.common import prepared


def force(rows, split, width):
    """For each row: units, and which of them go."""
    least = {}
    for doc_id, text in rows:
        units = split(text or "")
        own = windows.LARGEST_ID if doc_id is None else doc_id
        for n in range(len(units) - width + 1):
            key = tuple(units[n : n + width])
            least[key] = min(least.get(key, own), own)
    out = []
    for doc_id, text in rows:
        units = split(text or "")
        own = windows.LARGEST_ID if doc_id is None else doc_id
        gone = np.zeros(len(units), bool)
        for n in range(len(units) - width + 1):
            if least[tuple(units[n : n + width])] < own:
                gone[n : n + width] = True
        out.append((doc_id, units, gone))
    return out


def corpus(seed: int, unit):
    """Rows with copies, shared passages of many lengths, periodic and odd texts."""
    draw = random.Random(seed)
    fresh = lambda n: unit(draw, n)
    shared = [fresh(n) for n in (49, 50, 51, 60, 90, 130, 400)]
    rows = []
    for n in range(60):
        parts = []
        for _ in range(draw.randint(1, 4)):
            parts.append(fresh(draw.randint(0, 120)))
            if draw.random() < 0.6:
                text = draw.choice(shared)
                a = draw.randint(0, len(text) // 3)
                parts.append(text[a:])
        rows.append((draw.randint(0, 80) if draw.random() < 0.1 else n, parts))
    return rows


def byte_rows(seed):
    unit = lambda draw, n: "".join(draw.choice("abcdefghé ") for _ in range(n))
    rows = [(i, "".join(p)) for i, p in corpus(seed, unit)]
    line = "a line that is in very many of these texts, with some more"
    rows += [(100 + n, f"{n * 7919:x} {n:o} {line[: 30 + n % 29]} {n * 104729:x}") for n in range(60)]
    rows += [(300 + n, rows[3][1]) for n in range(8)] + [(2, rows[4][1]), (2, rows[4][1])]
    rows += [(400, "z" * 700), (401, "z" * 300), (402, "ab" * 400), (403, ""), (404, None), (None, rows[1][1]), (None, rows[5][1][:90])]
    return rows


@pytest.mark.parametrize("crowded", [3, 16_384])
def test_bytes(spark, crowded, monkeypatch):
    monkeypatch.setattr(windows, "CROWDED", crowded)
    rows = byte_rows(crowded)
    df = prepared(spark).createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, key string").repartition(4)
    got = substrings.without_repeats(df, cells=16).collect()
    wanted = []
    for doc_id, units, gone in force(rows, str.encode, 50):
        raw = bytes(u for u, g in zip(units, gone, strict=True) if not g)
        runs = int((np.diff(np.append(0, gone.astype(int))) == 1).sum())
        wanted.append((doc_id, len(units), int(gone.sum()), runs, raw))
    assert sorted(((*r[:4], bytes(r[4])) for r in got), key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("crowded", [3, 16_384])
def test_words(spark, crowded, monkeypatch):
    monkeypatch.setattr(windows, "CROWDED", crowded)
    unit = lambda draw, n: [draw.choice("one two three fôur five six ,. \x1c \xa0".split(" ")) or "x" for _ in range(n)]
    rows = [(i, "\t".join(w for p in parts for w in p)) for i, parts in corpus(crowded, unit)]
    rows += [(300 + n, rows[3][1]) for n in range(5)] + [(2, rows[4][1])]
    rows += [(400, "z " * 700), (401, " z\n" * 300), (403, ""), (404, None), (405, " \x0b "), (None, rows[1][1])]
    df = prepared(spark).createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, first string").repartition(4)
    got = passages.without_repeats(df, cells=16).collect()
    wanted = []
    for doc_id, units, gone in force(rows, lambda t: t.encode().split(), 50):
        kept = b" ".join(u for u, g in zip(units, gone, strict=True) if not g).decode()
        wanted.append((doc_id, len(units), int(gone.sum()), kept))
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_empty_tables(spark):
    empty = prepared(spark).createDataFrame([], "doc_id long, text string")
    assert substrings.without_repeats(empty, cells=16).count() == 0
    assert passages.without_repeats(empty, cells=16).count() == 0


@pytest.mark.parametrize("kind", [substrings, passages])
def test_hashes_that_collide_do_no_harm(spark, kind, monkeypatch):
    """With next to no hash at all the results are those of the contents."""
    rows = byte_rows(5) if kind is substrings else [(i, t.replace("a", " ")) for i, t in byte_rows(6) if t is not None]
    df = prepared(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    window, split = (50, str.encode) if kind is substrings else (6, lambda t: t.encode().split())
    sizes = {} if kind is substrings else {"window": 6, "run": 2}
    few = kind.units(cells=16, **sizes)
    dull = dataclasses.replace(
        few,
        runs=lambda texts, a, b: few.runs(texts, a, b) % np.uint64(3),
        hashes=lambda units: few.hashes(units) % np.uint64(2),
        breaks=lambda texts: few.breaks(texts) | (np.arange(int(texts.edges[-1])) % 97 == 0),
    )
    monkeypatch.setattr(kind, "units", lambda *_: dull)
    got = kind.without_repeats(df, window).collect()
    wanted = []
    for doc_id, units, gone in force(rows, split, window):
        kept = [u for u, g in zip(units, gone, strict=True) if not g]
        wanted.append((doc_id, len(units), int(gone.sum()), bytes(kept) if kind is substrings else b" ".join(kept).decode()))
    found = [(r["doc_id"], r[1], r["n_removed"], bytes(r["kept"]) if kind is substrings else r["kept"]) for r in got]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


def test_sketches_that_let_too_much_pass_do_no_harm(spark, monkeypatch):
    plain, draw = sketch.counted, np.random.default_rng(7)

    def blurred(*args, **kwargs):
        bits = plain(*args, **kwargs)
        bits.rows = [row | (draw.random((len(row), 8)) < 0.5) @ (1 << np.arange(8)).astype(np.uint8) for row in bits.rows]
        bits.rows = [row.astype(np.uint8) for row in bits.rows]
        return bits

    monkeypatch.setattr(sketch, "counted", blurred)
    rows = byte_rows(11)
    df = prepared(spark).createDataFrame(rows, "doc_id long, text string").repartition(4)
    wanted = []
    for doc_id, units, gone in force(rows, str.encode, 50):
        wanted.append((doc_id, bytes(u for u, g in zip(units, gone, strict=True) if not g)))
    got = [(r["doc_id"], bytes(r["kept"])) for r in substrings.without_repeats(df, cells=16).collect()]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)


def some_texts(draw):
    bits = ["ab", "c d", " ", "\n\t", "é", "", "word", "a" * 70, "x y z " * 40]
    return ["".join(draw.choice(bits) for _ in range(draw.randint(0, 30))) for _ in range(40)]


def test_words_of_a_batch():
    draw = random.Random(3)
    for _ in range(20):
        texts = some_texts(draw)
        flat = passages.flat(pa.array(["skipped", *texts])[1:])
        cut = flat.cutter()
        for n, text in enumerate(texts):
            a, b = int(flat.edges[n]), int(flat.edges[n + 1])
            assert bytes(cut(a, b)) == b" ".join(text.encode().split())
        words = [w for t in texts for w in t.encode().split()]
        assert (flat.hashes == passages.hashes(words)).all()


@pytest.mark.parametrize("kind", [substrings, passages])
def test_chunks_and_segments_hold_each_window_once(kind, monkeypatch):
    monkeypatch.setattr(windows, "_CHUNK", 100)
    draw = random.Random(4)
    units = kind.units()
    texts = [*some_texts(draw), "".join(draw.choice("abc  ") for _ in range(3_000)), "q" * 5_000, "q " * 5_000]
    flat = units.flat(pa.array(texts))
    sizes = np.diff(flat.edges)
    wanted = [(n, k) for n, size in enumerate(sizes.tolist()) for k in range(size - units.window + 1)]
    found = windows.chunks(flat, units)
    starts = [
        (t, b + k - int(flat.edges[t]))
        for t, b, w in zip(found.text.tolist(), found.begin.tolist(), found.windows.tolist(), strict=True)
        for k in range(w)
    ]
    assert sorted(starts) == wanted
    everything = np.zeros(int(flat.edges[-1]), bool)
    everything[[int(flat.edges[t]) + k for t, k in wanted]] = True
    held = [
        b + k
        for s in windows.segments(flat, units, everything)
        for b, w in zip(s.begin.tolist(), s.windows.tolist(), strict=True)
        for k in range(w)
    ]
    assert sorted(held) == np.flatnonzero(everything).tolist()


def test_suffixes_are_sorted():
    draw = random.Random(2)
    block = np.frombuffer(bytes(draw.choices(b"ab", k=600)), np.uint8)
    units = substrings.units()
    suffixes = substrings.Suffixes(block, units.hashes(block.tobytes()), 50)
    places = np.array(draw.sample(range(550), 300))
    order = suffixes.merge_sorted(places, np.zeros(300, int))
    raw = block.tobytes()
    assert [raw[p : p + 50] for p in places[order]] == sorted(raw[p : p + 50] for p in places)


def test_sketch_misses_nothing(spark):
    items = np.random.default_rng(1).integers(0, 3_000, 5_000)
    df = prepared(spark).createDataFrame([(int(i),) for i in items], "item long").repartition(6)
    hashed = lambda batch: [windows.mixed(batch.column(0).to_numpy().view(np.uint64))[n : n + 1] for n in range(batch.num_rows)]
    bits = sketch.counted(df, hashed, 20)
    values, times = np.unique(items, return_counts=True)
    keys = windows.mixed(values.astype(np.int64).view(np.uint64))
    assert bits.has(keys[times > 1]).all()
    assert bits.has(keys[times == 1]).mean() < 0.02
    seen = sketch.counted(df, hashed, 20, least=1)
    assert seen.has(keys).all()
