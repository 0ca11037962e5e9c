"""Embedding near-dedup by iterative quantisation.

A rotation learnt on a bounded sample turns vectors, about their mean, into balanced
binary codes. Multi-index tables over parts of the codes bring together vectors that
differ in at most one bit of a part; vectors with no partner within the Hamming
radius go; the rest are compared by cosine of their original vectors, in double
precision.

How many rotations and how wide the parts are, follows from the sample: partners at the
threshold are made for its vectors, in directions drawn at random and from the sample,
and of the settings that bring at least ``GOAL`` of them together the one with the fewest
comparisons is taken. Where none does (vectors that are nearly as close as the threshold
anyway), all vectors are one bucket, and every pair is compared. Vectors of different
lengths have tables of their own and never link.

A bucket of more than ``BLOCK`` entries is cut into parts that meet in pairs, each
in a task of its own. A task sends on, for each vector, its number of links and the
smallest vector it reaches there, not the pairs. A pair that several tables find
counts in the first of them. Equal vectors are compared once and counted as often
as they occur.

Null, zero or non-finite vectors link with nothing. A null ``vec_id`` isn't linked
either: it has no component and isn't kept. Rows that repeat a ``vec_id`` are vectors
of their own, and of one component. Links are found, not guessed: none is below the
threshold; one at the threshold is found with a probability of about ``GOAL``, closer ones
almost surely.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savormap.llm.cells import CELL, across, by_cell, celled, groups
from savormap.llm.components import components
from savormap.storage import cut_lineage

THRESHOLD = 0.95
SAMPLE_ROWS = 8_192  # vectors the rotations are learnt on
ROTATIONS = 8  # at most
PART_BITS = (16, 12, 8, 6)  # widths tried
CODE_BITS = 64
GOAL = 0.998  # of partners at the threshold that the tables must bring together
PARTNERS = 8_192  # made to measure that
_ENTRY = 20  # comparisons that an entry of a table costs
_SHIFT = 16  # of a bucket's table above its key
BLOCK = 1_024
_SLICE = 256


def cleaned(vectors: DataFrame) -> DataFrame:
    """``vec_id, vec, digest``: packed doubles, null for what can't be compared."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            lengths = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            ends = np.cumsum(lengths)
            packed = []
            for end, size in zip(ends.tolist(), lengths.tolist(), strict=True):
                one = flat[end - size : end]
                good = np.isfinite(one).all() and one.any()
                packed.append(one.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], ["vec_id", "vec"])

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    return rows.mapInArrow(pack, "vec_id long, vec binary").withColumn("digest", F.unhex(F.sha2("vec", 256)))


def stacked(packed: Iterable[bytes], length: int) -> np.ndarray:
    """Packed vectors as rows."""
    return np.frombuffer(b"".join(packed), np.float64).reshape(-1, length)


def units(rows: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first so that no square overflows."""
    scaled = rows / np.abs(rows).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def rotations(sample: np.ndarray, count: int = ROTATIONS, rounds: int = 50, seed: int = 11) -> list[tuple]:
    """Centre and projection of each code: principal directions, turned so that codes lose least."""
    draw = np.random.default_rng(seed)
    length = sample.shape[1]
    bits = min(CODE_BITS, length)
    centre = sample.mean(axis=0)
    about = sample - centre
    _, directions = np.linalg.eigh(about.T @ about + 1e-9 * np.eye(length))
    main = directions[:, ::-1][:, :bits]
    projected = about @ main
    found = []
    for _ in range(count):
        turn = np.linalg.qr(draw.normal(size=(bits, bits)))[0]
        for _ in range(rounds):
            codes = np.where(projected @ turn >= 0, 1.0, -1.0)
            left, _, right = np.linalg.svd(projected.T @ codes)
            turn = left @ right
        found.append((centre, main @ turn))
    return found


def codes_of(rows: np.ndarray, turns: list[tuple]) -> np.ndarray:
    """One unsigned 64-bit code per rotation."""
    out = np.zeros((len(rows), len(turns)), np.uint64)
    for n, (centre, turn) in enumerate(turns):
        bits = (rows - centre) @ turn >= 0
        weights = np.uint64(1) << np.arange(bits.shape[1], dtype=np.uint64)
        out[:, n] = (bits * weights).sum(axis=1, dtype=np.uint64)
    return out


@dataclass(frozen=True)
class Index:
    """The tables of vectors of one length: a part of ``width`` bits of a code each."""

    length: int
    turns: list[tuple]
    width: int  # 0: one bucket for all
    radius: int

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """Codes of vectors of length one."""
        return codes_of(rows, self.turns)

    def parts(self, codes: np.ndarray) -> list[np.ndarray]:
        """The keys in each table; a code's bits that fill no part are left out."""
        return parts(codes, self.width, min(CODE_BITS, self.length))


def parts(codes: np.ndarray, width: int, bits: int) -> list[np.ndarray]:
    """Parts of ``width`` bits of codes of ``bits`` bits, one array per table."""
    if not width:
        return [np.zeros(len(codes), np.uint64)]
    mask = np.uint64((1 << width) - 1)
    places = [np.uint64(at) for at in range(0, bits - width + 1, width)]
    return [(codes[:, n] >> at) & mask for n in range(codes.shape[1]) for at in places]


def partners(sample: np.ndarray, threshold: float, count: int = PARTNERS, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of vectors at the threshold: half in directions drawn at random, half towards others of the sample."""
    draw = np.random.default_rng(seed)
    one = sample[draw.integers(0, len(sample), count)]
    away = draw.normal(size=one.shape)
    other = sample[draw.integers(0, len(sample), count)]
    away[::2] = (other - one)[::2] + 1e-3 * away[::2]
    away -= (away * one).sum(axis=1, keepdims=True) * one
    size = np.linalg.norm(away, axis=1, keepdims=True)
    away = np.divide(away, size, out=np.zeros_like(away), where=size > 1e-12)
    return one, threshold * one + (1 - threshold**2) ** 0.5 * away


def _distances(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.bitwise_count(one ^ other).sum(axis=1, dtype=np.int64)


def learnt(sample: np.ndarray, count: int, threshold: float) -> Index:
    """The cheapest index, for ``count`` vectors, that reaches the goal."""
    length = sample.shape[1]
    bits = min(CODE_BITS, length)
    turns = rotations(sample)
    draw = np.random.default_rng(7)
    near = [codes_of(x, turns) for x in partners(sample, threshold)]
    far = [codes_of(sample[draw.integers(0, len(sample), PARTNERS)], turns) for _ in range(2)]
    best, least = Index(length, turns[:1], 0, bits), np.inf
    for width in sorted({min(w, bits) for w in PART_BITS}):
        for used in range(1, ROTATIONS + 1):
            (a, b), (c, d) = [x[:, :used] for x in near], [x[:, :used] for x in far]
            together = [np.bitwise_count(x ^ y) <= 1 for x, y in zip(parts(a, width, bits), parts(b, width, bits), strict=True)]
            apart = [np.bitwise_count(x ^ y) <= 1 for x, y in zip(parts(c, width, bits), parts(d, width, bits), strict=True)]
            radius = int(np.quantile(_distances(a, b), 0.9995)) + 2
            met = np.any(together, axis=0) & (_distances(a, b) <= radius)
            cost = _ENTRY * len(together) * (1 + width / 2) + count * float(np.sum(apart, axis=0).mean())
            if met.mean() >= GOAL and cost < least:
                best, least = Index(length, turns[:used], width, radius), cost
    return best


def _entries(coded: DataFrame, index: Index) -> DataFrame:
    """``bucket, node, base, codes``: each vector under its own key, and under those with one bit less."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, packed = batch.column(0).to_numpy(), batch.column(1)
            for table, key in enumerate(index.parts(_unpacked(packed))):
                for bit in range(-1, index.width):
                    rows = np.arange(len(node)) if bit < 0 else np.flatnonzero(key >> np.uint64(bit) & np.uint64(1))
                    at = key[rows] if bit < 0 else key[rows] ^ np.uint64(1 << bit)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array((table << _SHIFT) + at.astype(np.int64)),
                            pa.array(node[rows]),
                            pa.array(np.full(len(rows), bit < 0)),
                            packed.take(pa.array(rows)),
                        ],
                        ["bucket", "node", "base", "codes"],
                    )

    return coded.mapInArrow(spread, "bucket long, node long, base boolean, codes binary")


def _unpacked(codes: pa.Array) -> np.ndarray:
    """Packed codes as rows."""
    listed = codes.to_pylist()
    return np.frombuffer(b"".join(listed), np.uint64).reshape(len(listed), -1) if listed else np.zeros((0, 1), np.uint64)


def _allowed(table: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
    return table["base"].to_numpy(zero_copy_only=False), table["side"].to_numpy(), across(table)


def _pairs_allowed(base: np.ndarray, side: np.ndarray, apart: bool, rows: slice) -> np.ndarray:
    allowed = base[rows, None] | base[None, :]
    if apart:
        allowed &= side[rows, None] != side[None, :]
    return allowed


def _distance(codes: np.ndarray, rows: slice) -> np.ndarray:
    return sum(np.bitwise_count(codes[rows, None, n] ^ codes[None, :, n]).astype(np.int16) for n in range(codes.shape[1]))


def _codes(table: pa.Table) -> np.ndarray:
    return _unpacked(table["codes"])


def _with_partner(cells: DataFrame, radius: int) -> DataFrame:
    """Entries that have another within the radius in their cell."""
    schema = cells.select(*CELL, "node", "base", "side", "codes")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            base, side, apart = _allowed(table)
            if table.num_rows < 2 or not base.any():
                continue
            codes = _codes(table)
            kept = np.zeros(table.num_rows, bool)
            for start in range(0, table.num_rows, _SLICE):
                rows = slice(start, start + _SLICE)
                near = (_distance(codes, rows) <= radius) & _pairs_allowed(base, side, apart, rows)
                own = np.arange(start, min(start + _SLICE, table.num_rows))
                near[own - start, own] = False
                kept[rows] |= near.any(axis=1)
            if kept.any():
                yield from table.filter(pa.array(kept)).combine_chunks().to_batches()

    return by_cell(schema).mapInArrow(keep, schema.schema)


def _first_table(one: np.ndarray, other: np.ndarray, table: int, index: Index) -> np.ndarray:
    """Whether no earlier table brings the two together."""
    first = np.ones(len(one), bool)
    for a, b in list(zip(index.parts(one), index.parts(other), strict=True))[:table]:
        first &= np.bitwise_count(a ^ b) > 1
    return first


def _least_reached(size: int, one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """For each place the smallest place that links lead to."""
    label = np.arange(size)
    while True:
        before = label.copy()
        np.minimum.at(label, one, label[other])
        np.minimum.at(label, other, label[one])
        label = label[label]
        if (label == before).all():
            return label


def _linked(entries: DataFrame, index: Index, threshold: float) -> DataFrame:
    """``a, b, links``: of each vector the links found in a cell, and the smallest vector reached there."""

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            if table.num_rows < 2:
                continue
            table = table.sort_by("node")
            base, side, apart = _allowed(table)
            codes, node = _codes(table), table["node"].to_numpy()
            copies = table["copies"].to_numpy()
            unit = units(stacked(table["vec"].to_pylist(), index.length))
            number = table["bucket"][0].as_py() >> _SHIFT
            links = np.zeros(len(node), np.int64)
            ones, others = [], []
            for start in range(0, len(node), _SLICE):
                rows = slice(start, start + _SLICE)
                near = (unit[rows] @ unit.T >= threshold) & _pairs_allowed(base, side, apart, rows)
                one, other = np.nonzero(near)
                one += start
                good = node[one] < node[other]
                one, other = one[good], other[good]
                ones.append(one)
                others.append(other)
                first = _first_table(codes[one], codes[other], number, index)
                np.add.at(links, one[first], copies[other[first]])
                np.add.at(links, other[first], copies[one[first]])
            reached = node[_least_reached(len(node), np.concatenate(ones), np.concatenate(others))]
            kept = (links > 0) | (reached != node)
            if kept.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[kept]), pa.array(reached[kept]), pa.array(links[kept])], ["a", "b", "links"]
                )

    wanted = entries.select(*CELL, "node", "base", "side", "codes", "vec", "copies")
    return by_cell(wanted).mapInArrow(rerank, "a long, b long, links long")


def links(distinct: DataFrame, length: int, threshold: float, block: int) -> DataFrame:
    """``a, b, links`` of the vectors of one length (``node, digest, vec, copies``); stored."""
    own = distinct.where(F.octet_length("vec") == 8 * length)
    sample = own.select("digest", "vec").orderBy("digest").limit(SAMPLE_ROWS).collect()
    index = learnt(units(stacked([r["vec"] for r in sample], length)), own.count(), threshold)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes = index.codes(units(stacked(batch.column(1).to_pylist(), length)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([c.tobytes() for c in codes], pa.binary())], ["node", "codes"]
                )

    coded = cut_lineage(own.select("node", "vec").mapInArrow(code, "node long, codes binary"))
    partnered = cut_lineage(_with_partner(celled(_entries(coded, index), block), index.radius))
    return cut_lineage(_linked(partnered.join(own.select("node", "vec", "copies"), "node"), index, threshold))


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row of ``vectors`` (``vec_id, embedding``)."""
    rows = cleaned(vectors)
    distinct = cut_lineage(
        rows.where("vec is not null and vec_id is not null")
        .groupBy("digest", "vec")
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    # A row for each length that occurs several times; embeddings have one or a few.
    lengths = distinct.groupBy((F.octet_length("vec") / 8).cast("int").alias("d")).count().where("count > 1").collect()
    none = distinct.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"), F.col("copies").alias("links"))
    found = reduce(DataFrame.unionByName, (links(distinct, r["d"], threshold, block) for r in lengths), none)
    reached = components(found.select("a", "b"))
    counted = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    labelled = (
        distinct.select("node", "digest", "id", "copies")
        .join(counted, "node", "left")
        .join(reached.withColumnRenamed("id", "node"), "node", "left")
        .withColumn("component", F.coalesce("component", "node"))
    )
    labelled = cut_lineage(labelled)
    smallest = labelled.groupBy("component").agg(F.min("id").alias("component_id"))
    known = cut_lineage(
        labelled.join(smallest, "component").select(
            "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")
        )
    )
    plain = rows.select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("digest")).alias("digest"))
    component = F.coalesce("component_id", "vec_id")
    return plain.join(known, "digest", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
