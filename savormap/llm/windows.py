"""Windows of a fixed number of symbols that occur in several documents.

The task is the same for bytes and words: find, in each text, the windows that
also start in a document with a smaller id. Windows of all texts are far too many
to shuffle, so

- texts are cut into chunks at places that their own content chooses. The windows
  that start in a chunk are covered by its content; where a document with a smaller
  id has an equal chunk, they are all repeated. What is left of equal chunks is the
  one of the smallest id, and any window of others starts there too;
- of the chunks that are left, each window is filed under the smallest hash of the
  shorter runs inside it, its anchor, so neighbouring windows mostly share one; they
  form a segment. A merged count-min sketch of anchors per text rules out those of
  one text;
- segments that remain are grouped by content with the smallest id each; where an
  anchor has several different segments their windows are compared exactly.

Equal contents are told by a 128-bit cryptographic digest of their bytes. Rows of
equal contents are combined before they are shuffled, and an anchor with very many
different segments has its windows dealt out by such digests. No window is dropped:
sketches only overestimate.

Ids count as they are; a null id counts as larger than any. Rows that share an id
don't repeat each other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savormap.llm import sketch
from savormap.llm.near import mixed
from savormap.storage import cut_lineage, free_shuffles, remove_stored

LARGEST_ID = 2**63 - 1
MOST_WINDOWS = 64  # of a segment; periodic texts would make it endless
LONGEST_CHUNK = 4_096  # windows
CROWDED = 16_384  # different segments of one anchor from which their windows are dealt out
ROW_CELLS = 27  # bits of a cell's number, at most, in sketches of chunks and of rows
_CHUNK = 1 << 18  # symbols looked at together
_BATCH = 1 << 16  # windows compared together, or those of one anchor

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


def powers(base: np.uint64, count: int) -> np.ndarray:
    """Powers of a base modulo 2**64."""
    out = np.full(count, base, np.uint64)
    if count:
        out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = powers(_BASE, _CHUNK + 4_096), powers(_INVERSE, _CHUNK + 4_096)


def inverse_powers(count: int) -> np.ndarray:
    """What takes a hash to where it would be at the start of a text."""
    return _DOWN[:count] if count <= len(_DOWN) else powers(_INVERSE, count)


def prefix_hashes(symbols: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes, the empty one included."""
    up = _UP[: len(symbols)] if len(symbols) <= len(_UP) else powers(_BASE, len(symbols))
    out = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols * up, out=out[1:])
    return out


def run_hashes(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of runs of symbols, wherever they start."""
    down = inverse_powers(len(prefix))
    return mixed((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours."""
    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    held = np.full(blocks * width, np.uint64(2**64 - 1))
    held[: len(values)] = values
    held = held.reshape(blocks, width)
    ahead = np.minimum.accumulate(held, axis=1).ravel()
    behind = np.minimum.accumulate(held[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1 : width - 1 + count])


@dataclass
class Windows:
    """Windows of some segments that are compared together."""

    units: Sequence  # of all segments, one after another
    hashes: np.ndarray  # of the units
    group: np.ndarray  # for each window the bucket whose windows it may equal
    place: np.ndarray  # where it starts in hashes
    width: int


@dataclass
class Flat:
    """The texts of a batch, one after another, in their plain form.

    ``edges`` says at which unit each text begins; ``begin`` and ``end`` are the places
    of the units in ``raw`` (None: units are bytes).
    """

    raw: np.ndarray
    edges: np.ndarray
    begin: np.ndarray | None = None
    end: np.ndarray | None = None
    hashes: np.ndarray | None = None

    def cutter(self) -> Callable[[int, int], memoryview]:
        """What gives the content of some units."""
        view = memoryview(self.raw)
        if self.begin is None:
            return lambda a, b: view[a:b]
        begin, end = self.begin, self.end
        return lambda a, b: view[begin[a] : end[b - 1]] if b > a else view[:0]


@dataclass(frozen=True)
class Units:
    """How texts are read: the window, its shorter runs, and what a unit is."""

    window: int
    run: int
    cells: int  # bits of a cell's number in the sketch, at most
    size: int  # bytes of a unit, about
    chunk: int  # units of a chunk, about
    flat: Callable[[pa.Array], Flat]  # the texts of a column
    runs: Callable[[Flat, int, int], np.ndarray]  # hashes of the runs that start in a range of units
    breaks: Callable[[Flat], np.ndarray]  # for each unit whether a chunk may begin there
    hashes: Callable[[Sequence], np.ndarray]  # a 64-bit hash of each unit of a content
    again: Callable[[bytes], Sequence]  # the units of a content
    join: Callable[[list[Sequence]], Sequence]  # one after another
    alike: Callable[[Windows], np.ndarray]  # a label for each window, the same for equal ones of a group


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts without nulls, and where each begins (and the last ends)."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, ends, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    edges = np.frombuffer(ends, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[edges[0] : edges[-1]], edges - edges[0]


def _inside(begin: np.ndarray, stop: np.ndarray, count: int) -> np.ndarray:
    """Which of ``count`` places lie in one of some ranges that don't overlap."""
    step = np.zeros(count + 1, np.int8)
    np.add.at(step, begin, 1)
    np.add.at(step, stop, -1)
    return np.cumsum(step[:-1], dtype=np.int8) > 0


def _pieces(begin: np.ndarray, length: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges cut into pieces of ``most`` at most: which range, begin and length."""
    count = -(-length // most)
    which = np.repeat(np.arange(len(begin)), count)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    return which, begin[which] + nth * most, np.minimum(most, length[which] - nth * most)


def _digests(cut: Callable[[int, int], memoryview], begin: np.ndarray, stop: np.ndarray, kind: bytes) -> np.ndarray:
    """Two longs for each content; contents of different kinds have different ones."""
    joined = b"".join(
        blake2b(cut(a, b), digest_size=16, person=kind).digest() for a, b in zip(begin.tolist(), stop.tolist(), strict=True)
    )
    return np.frombuffer(joined, np.int64).reshape(-1, 2)


@dataclass
class Chunks:
    """Chunks of the texts of a batch: in which text, at which unit, of how many windows, and their digests."""

    text: np.ndarray
    begin: np.ndarray
    windows: np.ndarray
    digest: np.ndarray


def chunks(flat: Flat, units: Units) -> Chunks:
    """Every text's windows in chunks."""
    has = np.flatnonzero(np.diff(flat.edges) >= units.window)
    first, stop = flat.edges[has], flat.edges[has + 1] - units.window + 1
    count = int(flat.edges[-1])
    breaks = units.breaks(flat) & _inside(first, stop, count)
    breaks[first] = True
    begin = np.flatnonzero(breaks)
    text = np.searchsorted(first, begin, side="right") - 1
    length = np.minimum(np.append(begin[1:], count), stop[text]) - begin
    which, begin, length = _pieces(begin, length, LONGEST_CHUNK)
    return Chunks(
        has[text[which]], begin, length, _digests(flat.cutter(), begin, begin + length + units.window - 1, b"chunk")
    )


@dataclass
class Segments:
    """Some segments of the texts of a batch: anchor, first unit and number of windows."""

    anchor: np.ndarray
    begin: np.ndarray
    windows: np.ndarray


def segments(flat: Flat, units: Units, inside: np.ndarray) -> Iterator[Segments]:
    """Segments of the windows that start ``inside``, a bounded part at a time.

    They depend on the text alone but where a part or what is inside ends; a window
    has the same anchor wherever it is.
    """
    last = int(flat.edges[-1]) - units.window + 1
    for begin in range(0, last, _CHUNK):
        stop = min(begin + _CHUNK, last)
        at = np.flatnonzero(inside[begin:stop])
        if not len(at):
            continue
        width = units.window - units.run + 1
        least = sliding_least(units.runs(flat, begin, stop + width - 1), width)[at]
        new = np.flatnonzero(np.append(True, (least[1:] != least[:-1]) | (at[1:] != at[:-1] + 1)))
        which, start, length = _pieces(at[new], np.diff(np.append(new, len(at))), MOST_WINDOWS)
        yield Segments(mixed(least[new][which]), start + begin, length)


def _ordered_id(docs: DataFrame) -> Column:
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(LARGEST_ID))


def _pair(one: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A hash of a digest's first half and an id."""
    return mixed(one.view(np.uint64) ^ mixed(doc.view(np.uint64) + _BASE))


def _cells(count: int, most: int) -> int:
    return max(16, min(most, (8 * count).bit_length()))


def rows_of(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``doc`` (the id to compare), ``version``, and ``text``; null texts are empty.

    ``version`` is a hash of the text that tells rows of one id apart.
    """
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _ordered_id(docs).alias("doc"), F.xxhash64(text).alias("version"), text.alias("text")
    )


def chunk_bits(rows: DataFrame, units: Units, size: int) -> sketch.Bits:
    """Digests of chunks that may occur several times."""

    def digests(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield _firsts(chunks(units.flat(batch.column(0)), units))

    return sketch.counted(rows.select("text"), digests, _cells(size // (units.size * units.chunk), ROW_CELLS))


def _firsts(found: Chunks) -> np.ndarray:
    return mixed(np.ascontiguousarray(found.digest[:, 0]).view(np.uint64))


def chunk_owners(rows: DataFrame, bits, units: Units) -> DataFrame:
    """``one, two, least, most``: digests of chunks that may occur several times, smallest and largest id; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = chunks(units.flat(batch.column("text")), units)
            several = bits.value.has(_firsts(found))
            doc = batch.column("doc").to_numpy()[found.text[several]]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x) for x in found.digest[several].T.copy()), pa.array(doc)], ["one", "two", "doc"]
            )

    sent = rows.select("doc", "text").mapInArrow(run, "one long, two long, doc long")
    return cut_lineage(sent.groupBy("one", "two").agg(F.min("doc").alias("least"), F.max("doc").alias("most")))


@dataclass
class Known:
    """Chunks that may occur several times, and where such a chunk has its smallest id; both only overestimate."""

    several: sketch.Bits
    first: sketch.Bits

    def split(self, found: Chunks, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each chunk whether it may occur several times, and whether its windows have to be looked at."""
        several = self.several.has(_firsts(found))
        return several, ~several | self.first.has(_pair(np.ascontiguousarray(found.digest[:, 0]), doc))


def owner_bits(owners: DataFrame) -> sketch.Bits:
    """Digests with their smallest id."""
    pairs = lambda batch: [_pair(batch.column(0).to_numpy(), batch.column(1).to_numpy())]
    return sketch.counted(owners.select("one", "least"), pairs, _cells(owners.count(), ROW_CELLS), least=1)


def _looked_at(batch: pa.RecordBatch, units: Units, known: Known) -> tuple[Flat, Chunks, np.ndarray, np.ndarray]:
    """Texts of a batch, their chunks, which of these may occur several times, and the windows to look at."""
    flat = units.flat(batch.column("text"))
    found = chunks(flat, units)
    several, wanted = known.split(found, batch.column("doc").to_numpy()[found.text])
    begin, stop = found.begin[wanted], (found.begin + found.windows)[wanted]
    return flat, found, several, _inside(begin, stop, int(flat.edges[-1]))


def sketch_cells(size: int, units: Units) -> int:
    """Bits of a cell's number: eight cells an anchor, ``units.cells`` bits at most."""
    return _cells(2 * size // (units.size * (units.window - units.run + 2)), units.cells)


def anchor_bits(rows: DataFrame, known, units: Units, size: int) -> sketch.Bits:
    """Anchors that may belong to several texts; ``size`` is that of all texts in bytes."""

    def anchors(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        flat, _, _, inside = _looked_at(batch, units, known.value)
        for some in segments(flat, units, inside):
            order = np.argsort(some.anchor, kind="stable")
            anchor = some.anchor[order]
            text = np.searchsorted(flat.edges, some.begin[order], side="right")
            yield anchor[np.append(True, (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))]

    return sketch.counted(rows.select("doc", "text"), anchors, sketch_cells(size, units))


_FOUND = "one long, two long, anchor long, doc long, version long, starts binary, windows int, cut binary"


def binaries(sizes: np.ndarray, data: bytes) -> pa.Array:
    """Consecutive pieces of some bytes as a column."""
    ends = np.append(0, np.cumsum(sizes)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(data)])


def candidates(rows: DataFrame, known, anchors, units: Units) -> DataFrame:
    """Chunks that may occur several times (without ``anchor`` and ``cut``) and segments whose anchors pass.

    One row for equal ones of a text; ``starts`` holds their places as 64-bit
    numbers, ``cut`` is their content.
    """

    def packed(batch, flat, digest, begin, length, anchor=None) -> pa.RecordBatch:
        text = np.searchsorted(flat.edges, begin, side="right") - 1
        order = np.lexsort((begin, digest[:, 1], digest[:, 0], text))
        text, begin, length, digest = text[order], begin[order], length[order], digest[order]
        new = np.flatnonzero(np.append(True, (text[1:] != text[:-1]) | (digest[1:] != digest[:-1]).any(axis=1)))
        count = len(new)
        places = (begin - flat.edges[text]).astype(np.int64)
        cut = flat.cutter()
        ends = (begin + length + units.window - 1)[new].tolist()
        return pa.RecordBatch.from_arrays(
            [
                *(pa.array(np.ascontiguousarray(x)) for x in digest[new].T),
                pa.nulls(count, pa.int64()) if anchor is None else pa.array(anchor[order][new].view(np.int64)),
                batch.column("doc").take(pa.array(text[new])),
                batch.column("version").take(pa.array(text[new])),
                binaries(8 * np.diff(np.append(new, len(begin))), places.tobytes()),
                pa.array(length[new].astype(np.int32)),
                pa.nulls(count, pa.binary())
                if anchor is None
                else pa.array([bytes(cut(a, b)) for a, b in zip(begin[new].tolist(), ends, strict=True)], pa.binary()),
            ],
            [c.split()[0] for c in _FOUND.split(", ")],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, whole, several, inside = _looked_at(batch, units, known.value)
            if several.any():
                yield packed(batch, flat, whole.digest[several], whole.begin[several], whole.windows[several])
            for some in segments(flat, units, inside):
                good = anchors.value.has(some.anchor)
                if good.any():
                    begin, length = some.begin[good], some.windows[good]
                    digest = _digests(flat.cutter(), begin, begin + length + units.window - 1, b"segment")
                    yield packed(batch, flat, digest, begin, length, some.anchor[good])

    return rows.select("doc", "version", "text").mapInArrow(run, _FOUND)


def repeated_windows(table: pa.Table, units: Units) -> np.ndarray:
    """For each window of the segments of some anchors whether one with a smaller id equals it."""
    parts = [units.again(c) for c in table["cut"].to_pylist()]
    count, doc = table["windows"].to_numpy().astype(np.int64), table["doc"].to_numpy()
    anchor = table["anchor"].to_numpy()
    bucket = np.cumsum(np.append(0, anchor[1:] != anchor[:-1]))
    offset = np.cumsum([0, *map(len, parts)])[:-1]
    segment = np.repeat(np.arange(len(parts)), count)
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    whole = units.join(parts)
    windows = Windows(whole, units.hashes(whole), bucket[segment], offset[segment] + within, units.window)
    labels = units.alike(windows)
    order = np.argsort(labels, kind="stable")
    new = np.flatnonzero(np.append(True, labels[order][1:] != labels[order][:-1]))
    own = doc[segment]
    least = np.minimum.reduceat(own[order], new)
    repeated = np.empty(len(order), bool)
    repeated[order] = np.repeat(least, np.diff(np.append(new, len(order)))) < own[order]
    return repeated


def whole_anchors(batches: Iterator[pa.RecordBatch], windows: int) -> Iterator[pa.Table]:
    """Rows in the order of their anchors, in tables of about so many windows that divide no anchor."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += int(batch["windows"].to_numpy().sum())
        if size > windows:
            table = pa.Table.from_batches(held)
            anchor = table["anchor"].to_numpy()
            edges = np.flatnonzero(anchor[1:] != anchor[:-1])
            if len(edges):
                yield table.slice(0, edges[-1] + 1)
                held = table.slice(edges[-1] + 1).combine_chunks().to_batches()
                size = sum(int(b["windows"].to_numpy().sum()) for b in held)
    if held:
        yield pa.Table.from_batches(held)


_INSIDE = "one long, two long, begin long, stop long"


def compared(rows: DataFrame, units: Units) -> DataFrame:
    """``one, two, begin, stop``: units inside segments that windows of a smaller id cover.

    ``rows`` are different segments (``anchor, one, two, doc, windows, cut``); those
    of an anchor are compared, many anchors at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_anchors(batches, _BATCH):
            repeated = repeated_windows(table, units)
            ends = np.cumsum(table["windows"].to_numpy().astype(np.int64))
            edge = np.ones(len(repeated) + 1, bool)
            edge[1:-1] = repeated[1:] != repeated[:-1]
            edge[ends] = True
            cuts = np.flatnonzero(edge)
            begin, stop = cuts[:-1][repeated[cuts[:-1]]], cuts[1:][repeated[cuts[:-1]]]
            row = np.searchsorted(ends, begin, side="right")
            first = np.append(0, ends)[row]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(table["one"].to_numpy()[row]),
                    pa.array(table["two"].to_numpy()[row]),
                    pa.array(begin - first),
                    pa.array(stop - first + units.window - 1),
                ],
                ["one", "two", "begin", "stop"],
            )

    wanted = rows.select("anchor", "one", "two", "doc", "windows", "cut")
    return wanted.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, _INSIDE)


def dealt_out(rows: DataFrame, units: Units) -> DataFrame:
    """The same for anchors with very many segments, window by window.

    A window is filed under a 128-bit digest of its content, combined map-side, so
    that neither the anchor nor a frequent window gathers in one task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two, doc, count = (batch.column(n).to_numpy() for n in range(4))
            begin = np.concatenate([np.zeros(0, np.int64), *(np.arange(n) for n in count)])
            cuts: list[bytes] = []
            for content, n in zip(batch.column(4).to_pylist(), count.tolist(), strict=True):
                whole = units.again(content)
                parts = (units.join([whole[k : k + units.window]]) for k in range(n))
                cuts += [blake2b(p if isinstance(p, bytes) else b" ".join(p), digest_size=16).digest() for p in parts]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(np.repeat(x, count)) for x in (one, two, doc)), pa.array(begin), pa.array(cuts, pa.binary())],
                ["one", "two", "doc", "begin", "window"],
            )

    wanted = rows.select("one", "two", "doc", "windows", "cut")
    single = wanted.mapInArrow(run, "one long, two long, doc long, begin long, window binary")
    least = cut_lineage(
        single.groupBy("window").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most").drop("most")
    )
    return single.join(least, "window").where("doc > least").select(
        "one", "two", "begin", (F.col("begin") + units.window).alias("stop")
    )


def placed(rows: DataFrame, units: Units) -> DataFrame:
    """``doc, version, begin, stop``: repeated units in the texts themselves.

    A chunk or segment that a smaller id has too is repeated whole; elsewhere what is
    ``inside`` it, at each of its places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, version, starts, count, least, inside in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                spans = [(0, count + units.window - 1)] if doc > least else [(s["begin"], s["stop"]) for s in inside or ()]
                for place in np.frombuffer(starts, np.int64).tolist() if spans else ():
                    out.extend((doc, version, place + a, place + b) for a, b in spans)
            columns = list(zip(*out, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc", "version", "begin", "stop"])

    wanted = rows.select("doc", "version", "starts", "windows", "least", "inside")
    return wanted.mapInArrow(run, "doc long, version long, begin long, stop long")


def spans_of_texts(rows: DataFrame, units: Units, size: int) -> DataFrame:
    """``doc, version, spans`` of the texts in which something is repeated; stored."""
    context = rows.sparkSession.sparkContext
    several = chunk_bits(rows, units, size)
    bits = context.broadcast(several)
    owners = chunk_owners(rows, bits, units)
    bits.destroy()
    known = context.broadcast(Known(several, owner_bits(owners)))
    anchors = context.broadcast(anchor_bits(rows, known, units, size))
    free_shuffles(rows.sparkSession)
    found = cut_lineage(candidates(rows, known, anchors, units), "zstd")
    known.destroy()
    anchors.destroy()
    pieces = cut_lineage(
        found.where("anchor is not null")
        .groupBy("one", "two")
        .agg(*(F.min(c).alias(c) for c in ("anchor", "doc", "windows", "cut")), F.max("doc").alias("most")),
        "zstd",
    )
    free_shuffles(rows.sparkSession)
    crowded = cut_lineage(
        pieces.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWDED).select("anchor")
    )
    inside = compared(pieces.join(crowded, "anchor", "left_anti"), units).unionByName(
        dealt_out(pieces.join(crowded, "anchor", "left_semi"), units)
    )
    listed = cut_lineage(inside.groupBy("one", "two").agg(F.collect_list(F.struct("begin", "stop")).alias("inside")))
    kind = listed.schema["inside"].dataType
    told = cut_lineage(
        pieces.select("one", "two", F.col("doc").alias("least"), "most")
        .join(listed, ["one", "two"], "left")
        .where("least < most or inside is not null")
        .drop("most")
        .unionByName(owners.where("least < most").drop("most").withColumn("inside", F.lit(None).cast(kind)))
    )
    for done in (owners, pieces, crowded, listed):
        remove_stored(done)
    free_shuffles(rows.sparkSession)
    spans = placed(found.drop("anchor", "cut").join(told, ["one", "two"]), units)
    stored = cut_lineage(spans.groupBy("doc", "version").agg(F.collect_list(F.struct("begin", "stop")).alias("spans")))
    for done in (found, told):
        remove_stored(done)
    free_shuffles(rows.sparkSession)
    return stored


def marked(docs: DataFrame, units: Units) -> DataFrame:
    """``doc_id, text, spans`` of every row of ``docs``; ``spans`` holds repeated units (null: nothing).

    Texts without any stay out of the shuffle, as a sketch of the others tells.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rows = rows_of(docs)
    spans = spans_of_texts(rows, units, size)
    pairs = lambda batch: [_pair(batch.column(0).to_numpy(), batch.column(1).to_numpy())]
    bits = sketch.counted(spans.select("version", "doc"), pairs, _cells(spans.count(), ROW_CELLS), least=1)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    @F.arrow_udf("boolean")
    def may_have(version: pa.Array, doc: pa.Array) -> pa.Array:
        return pa.array(shared.value.has(_pair(version.to_numpy(), doc.to_numpy())))

    has = may_have("version", "doc")
    plain = rows.where(~has).select("doc_id", "text", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"))
    return plain.unionByName(rows.where(has).join(spans, ["doc", "version"], "left").select("doc_id", "text", "spans"))


def removed_units(spans: pa.Array) -> list[np.ndarray]:
    """For each row of a column of spans begin and end of the maximal removed runs."""
    held = np.stack([spans.values.field(n).to_numpy().astype(np.int64) for n in ("begin", "stop")], axis=1)
    out = []
    for n, valid in enumerate(spans.is_valid().to_pylist()):
        some = held[spans.offsets[n].as_py() : spans.offsets[n + 1].as_py()] if valid else held[:0]
        if len(some):
            some = some[np.argsort(some[:, 0], kind="stable")]
            furthest = np.maximum.accumulate(some[:, 1])
            new = np.append(True, some[1:, 0] > furthest[:-1])
            last = np.append(np.flatnonzero(new)[1:] - 1, len(some) - 1)
            some = np.stack([some[new, 0], furthest[last]], axis=1)
        out.append(some)
    return out


def kept_parts(flat: Flat, text: int, gone: np.ndarray) -> list[bytes]:
    """What is left of a text between the removed runs."""
    cut, first, stop = flat.cutter(), int(flat.edges[text]), int(flat.edges[text + 1])
    begins, ends = [first, *(first + gone[:, 1]).tolist()], [*(first + gone[:, 0]).tolist(), stop]
    return [bytes(cut(a, b)) for a, b in zip(begins, ends, strict=True) if b > a]
