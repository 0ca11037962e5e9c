"""Hard negatives by segment summary filtering.

Each vector is cut into segments. Of a segment of L components its mean and its
deviation are kept; for two vectors the inner product over it lies within L times
the means' product plus or minus the deviations' product. Summed over the segments
that bounds the score. Few long segments are tried first, more shorter ones for the
pairs that are left, and only what is left then is scored exactly. What a pair must
reach rises while a task finds better partners.

Anchors are a stated query set; each meets all rows, block by block. A task holds one
block of anchors and one of rows, and sends on a few rows for each anchor, never the
pairs. First the positives are found among rows of the anchor's label, then the
negatives among the others, for the scores that the positives have.

A component counts as ``floor(scale * x)``. Scores are exact integers; a component
beyond 2**29 / sqrt(length) counts as that, so that they fit a long. Vectors of
different lengths don't meet. Rows with a null label or vector, or a null or
non-finite component take no part. A row with a null ``vec_id`` is no anchor and comes
last among ties. Rows that repeat a ``vec_id`` are rows of their own; copies of an
anchor's vector are other rows like any. An empty table gives no rows; further columns
don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from savormap.llm.cells import groups
from savormap.storage import cut_lineage

SCALE = 256
EVERY = 100  # anchors are the rows whose id this divides
POSITIVES = 5
NEGATIVES = 5
LEAST, MOST = 80, 100  # percent of the positive's score that a negative has
LEVELS = (16, 4)  # components of a segment, coarse to fine
ANCHOR_ROWS, ROWS = 4_096, 16_384  # of a block
_FEWEST = 1_024  # rows worth a block of their own
_SLICE = 2_048  # rows looked at together
_SIDE = 256  # anchors looked at together
_DENSE = 0.1  # share of pairs from which a whole product is cheaper than one by one
_NO_ID = 2**63 - 1
_EXACT = 2**53
_LIMIT = 2**29
CELL = ("length", "bucket", "i", "j")


def cleaned(vectors: DataFrame, label: Column, scale: int = SCALE) -> DataFrame:
    """``row, vec_id, label, length, vec``: rows that take part, components as whole numbers; stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, packed = [], []
            for n, values in enumerate(batch.column("vec").to_pylist()):
                if values is None or None in values:
                    continue
                whole = np.array(values, np.float64)
                if np.isfinite(whole).all():
                    most = float(int(_LIMIT / max(1, len(whole)) ** 0.5))
                    keep.append(n)
                    with np.errstate(over="ignore"):
                        packed.append(np.clip(np.floor(scale * whole), -most, most).astype(np.int64).tobytes())
            chosen = batch.take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chosen.column("vec_id"), chosen.column("label"), pa.array([len(p) // 8 for p in packed], pa.int32()), pa.array(packed, pa.binary())],
                ["vec_id", "label", "length", "vec"],
            )

    named = vectors.select(
        F.coalesce(vectors["vec_id"].cast("long"), F.lit(_NO_ID)).alias("vec_id"),
        label.cast("long").alias("label"),
        vectors["embedding"].cast("array<double>").alias("vec"),
    )
    rows = named.where("label is not null and vec is not null").mapInArrow(
        run, "vec_id long, label long, length int, vec binary"
    )
    return cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))


class Block:
    """Vectors with their summaries, coarse to fine."""

    def __init__(self, table: pa.Table, order: bool = False):
        self.vec_id, self.row, self.label = (table[c].to_numpy() for c in ("vec_id", "row", "label"))
        length = table["length"][0].as_py()
        joined = b"".join(table["vec"].to_pylist())
        self.whole = np.frombuffer(joined, np.int64).reshape(len(self.row), length)
        self.norm = np.sqrt((self.whole.astype(np.float64) ** 2).sum(axis=1))
        if order:  # long vectors first: they have high scores, and what follows must reach them
            first = np.argsort(-self.norm, kind="stable")
            self.vec_id, self.row, self.label = self.vec_id[first], self.row[first], self.label[first]
            self.whole, self.norm = self.whole[first], self.norm[first]
        self.real = self.whole.astype(np.float64)
        self.levels = [self._summary(width) for width in LEVELS]

    def _summary(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Means and deviations of each segment, both times the root of its length."""
        begins = np.arange(0, self.real.shape[1], width)
        if not len(begins):
            return np.zeros((len(self.row), 0)), np.zeros((len(self.row), 0))
        sizes = np.diff(np.append(begins, self.real.shape[1]))
        mean = np.add.reduceat(self.real, begins, axis=1) / np.sqrt(sizes)
        square = np.add.reduceat(self.real**2, begins, axis=1)
        return mean, np.sqrt(np.maximum(square - mean**2, 0))


class Meeting:
    """Some anchors and some rows: bounds first, exact scores of what the bounds leave."""

    def __init__(self, anchors: Block, some: slice, rows: Block, part: slice):
        self.anchors, self.some, self.rows, self.part = anchors, some, rows, part
        largest = anchors.norm[some].max(initial=0) * rows.norm[part].max(initial=0)
        self.exact_real = largest < _EXACT / 2
        self.slack = 1 + 1e-7 * largest  # above the rounding of the bounds

    def bounds(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """Lowest and highest possible score of each pair."""
        (ma, da), (mr, dr) = self.anchors.levels[level], self.rows.levels[level]
        middle, off = ma[self.some] @ mr[self.part].T, da[self.some] @ dr[self.part].T
        return middle - off - self.slack, middle + off + self.slack

    def scores(self, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, row (within the slices) and exact score of the pairs that are alive."""
        at, other = np.nonzero(alive)
        kind = "real" if self.exact_real else "whole"
        a, r = getattr(self.anchors, kind)[self.some], getattr(self.rows, kind)[self.part]
        if len(at) > _DENSE * alive.size:
            return at, other, (a @ r.T)[at, other].astype(np.int64)
        found = np.empty(len(at), np.int64)
        for k in range(0, len(at), 1 << 16):
            x, y = at[k : k + (1 << 16)], other[k : k + (1 << 16)]
            found[k : k + (1 << 16)] = np.einsum("ij,ij->i", a[x], r[y]).astype(np.int64)
        return at, other, found


class Best:
    """For each slot the ``n`` rows with the highest scores, ties by id."""

    def __init__(self, slots: int, n: int):
        self.n = n
        self.found = [np.zeros(0, np.int64) for _ in range(4)]  # slot, score, id, row
        self.reach = np.full(slots, -(2**62), np.int64)  # what a further row must reach

    def add(self, slot: np.ndarray, score: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        """Further rows."""
        if not len(slot):
            return
        some = [np.concatenate(x) for x in zip(self.found, (slot, score, vec_id, row), strict=True)]
        order = np.lexsort((some[3], some[2], -some[1], some[0]))
        slots = some[0][order]
        rank = np.arange(len(slots)) - np.searchsorted(slots, slots)
        kept = order[rank < self.n]
        self.found = [x[kept] for x in some]
        last = order[rank == self.n - 1]
        self.reach[some[0][last]] = some[1][last]


def near_positives(anchors: Block, rows: Block, n: int = POSITIVES) -> Best:
    """Slots are anchors; ``rows`` have their label."""
    best = Best(len(anchors.row), n)
    for meeting in _meetings(anchors, rows):
        some, part = meeting.some, meeting.part
        alive = anchors.row[some][:, None] != rows.row[part][None, :]
        alive &= anchors.label[some][:, None] == rows.label[part][None, :]
        for level in range(len(LEVELS)):
            alive &= meeting.bounds(level)[1] >= best.reach[some][:, None]
        at, other, score = meeting.scores(alive)
        good = score >= best.reach[some][at]
        at, other, score = at[good], other[good], score[good]
        best.add(at + some.start, score, rows.vec_id[part][other], rows.row[part][other])
    return best


def hard_negatives(anchors: Block, given: np.ndarray, rows: Block, n: int = NEGATIVES) -> Best:
    """Slots are anchors x positives; ``given`` has the positives' scores, below 0 for none."""
    ways = given.shape[1]
    best = Best(given.size, n)
    lowest = -((-LEAST * given) // MOST)  # the least whole score of a negative
    for meeting in _meetings(anchors, rows):
        some, part = meeting.some, meeting.part
        other_label = anchors.label[some][:, None] != rows.label[part][None, :]
        reach = np.maximum(lowest, best.reach.reshape(given.shape))[some]
        most = given[some]
        alive = other_label
        for level in range(len(LEVELS)):
            low, high = meeting.bounds(level)
            useful = np.zeros(alive.shape, bool)
            for k in range(ways):
                useful |= (high >= reach[:, k, None]) & (low <= most[:, k, None]) & (most[:, k, None] >= 0)
            alive = alive & useful
        at, other, score = meeting.scores(alive)
        slots, picked = [], []
        for k in range(ways):
            good = np.flatnonzero((score >= reach[at, k]) & (score <= most[at, k]))
            slots.append((at[good] + some.start) * ways + k)
            picked.append(good)
        chosen = np.concatenate(picked)
        best.add(np.concatenate(slots), score[chosen], rows.vec_id[part][other[chosen]], rows.row[part][other[chosen]])
    return best


def _meetings(anchors: Block, rows: Block) -> Iterator[Meeting]:
    for begin in range(0, len(rows.row), _SLICE):
        for at in range(0, len(anchors.row), _SIDE):
            yield Meeting(
                anchors, slice(at, min(at + _SIDE, len(anchors.row))), rows, slice(begin, min(begin + _SLICE, len(rows.row)))
            )


def _blocks(rows: Column, block: int, cores: int) -> Column:
    """How many blocks: none above its size, enough for every core, none tiny."""
    wanted = F.greatest(F.ceil(rows / block), F.least(F.lit(cores), F.floor(rows / _FEWEST)), F.lit(1))
    return wanted.cast("long")


def _in_cells(anchors: DataFrame, rows: DataFrame, bucket: list[str], blocks: tuple[int, int]) -> DataFrame:
    """Anchors and rows of equal ``bucket``, in each cell a block of both."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    sizes = cut_lineage(
        anchors.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("n"))
        .join(rows.groupBy(*bucket).agg(F.count(F.lit(1)).alias("m")), bucket)
        .select(*bucket, _blocks(F.col("n"), blocks[0], 1).alias("n"), _blocks(F.col("m"), blocks[1], cores).alias("m"))
    )
    columns = ["vec_id", "label", "length", "vec", "row"]
    scores = F.col("scores") if "scores" in anchors.columns else F.lit(None).cast("array<long>")
    place = F.xxhash64("row")
    ours = anchors.join(sizes, bucket).select(
        *columns,
        scores.alias("scores"),
        F.lit(True).alias("is_anchor"),
        F.pmod(place, F.col("n")).alias("i"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("j"),
        F.xxhash64(*bucket).alias("bucket"),
    )
    theirs = rows.join(sizes, bucket).select(
        *columns,
        F.lit(None).cast("array<long>").alias("scores"),
        F.lit(False).alias("is_anchor"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"),
        F.pmod(place, F.col("m")).alias("j"),
        F.xxhash64(*bucket).alias("bucket"),
    )
    return ours.unionByName(theirs).repartition("bucket", "i", "j").sortWithinPartitions(*CELL)


_FOUND = "anchor long, slot int, score long, vec_id long, row long"


def _best_of_cells(cells: DataFrame, look: str) -> DataFrame:
    """What each cell finds: ``anchor`` (its row), ``slot`` (a positive's number) and a few partners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, CELL):
            is_anchor = table["is_anchor"].to_numpy()
            if is_anchor.all() or not is_anchor.any():
                continue
            ours, rows = table.filter(pa.array(is_anchor)), Block(table.filter(pa.array(~is_anchor)), order=True)
            anchors = Block(ours)
            if look == "positives":
                best, ways = near_positives(anchors, rows), 1
            else:
                given = np.full((ours.num_rows, POSITIVES), -1, np.int64)
                for n, scores in enumerate(ours["scores"].to_pylist()):
                    given[n, : len(scores)] = scores
                best, ways = hard_negatives(anchors, given, rows), POSITIVES
            slot, score, vec_id, row = best.found
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors.row[slot // ways]),
                    pa.array((slot % ways).astype(np.int32)),
                    pa.array(score),
                    pa.array(vec_id),
                    pa.array(row),
                ],
                [c.split()[0] for c in _FOUND.split(", ")],
            )

    return cells.mapInArrow(run, _FOUND)


def _ranked(found: DataFrame, n: int) -> DataFrame:
    """The ``n`` best of each anchor and slot, with their ``rank`` from 1."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mined(
    vectors: DataFrame,
    label: Column,
    every: int = EVERY,
    scale: int = SCALE,
    blocks: tuple[int, int] = (ANCHOR_ROWS, ROWS),
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``label`` is a column of ``vectors``. Anchors are rows whose id ``every`` divides.
    """
    rows = cleaned(vectors, label, scale)
    anchors = rows.where((F.col("vec_id") % every == 0) & (F.col("vec_id") != _NO_ID))
    positives = cut_lineage(
        _ranked(_best_of_cells(_in_cells(anchors, rows, ["length", "label"], blocks), "positives"), POSITIVES)
    )
    # At most five scores of an anchor.
    listed = positives.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("held"))
    ready = cut_lineage(
        anchors.join(listed, anchors["row"] == listed["anchor"]).select(
            *anchors.columns, F.transform("held", lambda h: h["score"]).alias("scores")
        )
    )
    negatives = _ranked(_best_of_cells(_in_cells(ready, rows, ["length"], blocks), "negatives"), NEGATIVES)
    named = positives.select(
        "anchor",
        (F.col("rank") - 1).alias("slot"),
        F.col("vec_id").alias("positive"),
        F.col("score").alias("positive_score"),
    ).join(anchors.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
    none = F.lit(_NO_ID)
    return negatives.join(named, ["anchor", "slot"]).select(
        "anchor_id",
        F.nullif("positive", none).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.nullif("vec_id", none).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
