"""Near-duplicates by order MinHash and banded alignment.

Each of ``SKETCHES`` hash functions takes the two smallest of a text's shingles,
told apart by their occurrence, and keeps them in the order of the text: texts
meet where such ordered pairs agree, which follows their edit similarity. The
words of a shingle follow from the threshold and the length of the text
(``families``), so that texts at the threshold meet with probability ``RECALL`` or
more wherever their edits are; at 0.8 three words, two in texts below some 100. Texts that meet are aligned in a band; they are linked where
1 - edits / words of the longer one is at least ``SIMILARITY``. Linked texts form
classes.

Equal texts are one text here. Links are looked for in three steps, each over
pairs that the steps before left in different classes: every text against the
smallest it meets anywhere, then against the smallest of each bucket, then every
pair of a bucket that is still in two classes, the most alike first, large buckets
in cells of two parts. So a large class costs a few alignments a text, and no pair
that met goes unchecked: what isn't aligned is in one class already, or too far
apart by length or word counts.

A text shorter than a shingle is one shingle. A null text is empty; texts
without words are one class. The class is named by its smallest ``doc_id`` (null
where all are null), and the rows with that id stay. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from savormap.llm.align import most_edits, similar
from savormap.llm.cells import CELL, across, by_cell, groups
from savormap.llm.common import fresh, text_of
from savormap.llm.components import components
from savormap.llm.exact import digest_of
from savormap.storage import cut_lineage

WORDS = 5  # of a shingle at most
SIMILARITY = 0.8
SKETCHES = 80
RECALL = 0.99
_LENGTHS = 4_096  # chances at greater lengths differ no more
BLOCK = 512
BINS = 256  # of the word histogram that bounds edit distances from below
COARSE = 32
_KNOWN = 400_000
_WIDE = 8_192  # shingles up to which all functions are evaluated at once

_MIX = tuple(np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class Family(NamedTuple):
    """Shingles of ``size`` words, for texts of ``least`` to ``most`` words."""

    size: int
    least: int
    most: float


def chance(length: int, size: int, share: float) -> float:
    """How likely one hash function brings two texts at the threshold together, ``length`` words the longer.

    The worst case: substitutions so far apart that each changes ``size`` shingles.
    """
    edits = most_edits(length, length, share)
    total = max(1, length - size + 1)
    common = total - size * edits
    union = 2 * total - common
    return 1.0 if not edits else common * (common - 1) / (union * (union - 1)) if common > 1 else 0.0


@cache
def families(share: float, sketches: int = SKETCHES) -> tuple[Family, ...]:
    """Sizes of shingles, the longest that reach ``RECALL``, and the texts they are for.

    Shorter shingles take the lengths that longer ones don't reach. A text that may
    match some on both sides of the border has the keys of both.
    """
    needed = 1 - (1 - RECALL) ** (1 / sketches)
    found, most = [], math.inf
    for size in range(WORDS, 0, -1):
        missed = [n for n in range(_LENGTHS + 1) if chance(n, size, share) < needed]
        least = missed[-1] + 1 if missed and size > 1 else 0
        if least <= min(most, _LENGTHS):
            found.append(Family(size, least, most))
            most = math.floor(least / share) if least else 0
        if not least:
            break
    return tuple(found)


class WordHashes(dict):
    """Hashes of words met before."""

    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole text where it is shorter."""
    size = max(1, min(size, len(words)))
    found = np.zeros(len(words) - size + 1, np.uint64)
    for n in range(size):
        found = found * _MIX[0] + words[n : len(words) - size + 1 + n]
    return mixed(found)


def labelled(found: np.ndarray) -> np.ndarray:
    """Hashes of shingles together with the number of times they occurred before."""
    order = np.argsort(found, kind="stable")
    ranked = found[order]
    new = np.append(True, ranked[1:] != ranked[:-1])
    if new.all():
        return mixed(found)
    starts = np.flatnonzero(new)
    before = np.arange(len(found)) - starts[np.cumsum(new) - 1]
    occurrence = np.empty(len(found), np.uint64)
    occurrence[order] = before
    return mixed(found + occurrence * _MIX[0])


def sketch(words: np.ndarray, multipliers: np.ndarray, size: int) -> np.ndarray:
    """One key for each hash function."""
    if not len(words):
        return mixed(multipliers)
    found = shingles(words, size)
    marked = labelled(found)
    if len(found) == 1:
        return mixed(found[0] + multipliers)
    step = len(multipliers) if len(found) <= _WIDE else 1
    keys = []
    for n in range(0, len(multipliers), step):
        order = multipliers[n : n + step, None] * marked[None, :]
        rows = np.arange(len(order))
        one = order.argmin(axis=1)
        order[rows, one] = np.uint64(2**64 - 1)
        other = order.argmin(axis=1)
        early, late = found[np.minimum(one, other)], found[np.maximum(one, other)]
        keys.append(mixed(early * _MIX[0] + mixed(late + multipliers[n : n + step])))
    return np.concatenate(keys)


def keys_of(words: np.ndarray, multipliers: np.ndarray, kinds: tuple[Family, ...]) -> np.ndarray:
    """The keys of each family the text belongs to, in turn."""
    return np.concatenate([sketch(words, multipliers + np.uint64(2 * k.size), k.size) for k in kinds if k.least <= len(words) <= k.most])


def key_table(keys: list[bytes], words: np.ndarray, node: np.ndarray, kinds: tuple[Family, ...]) -> np.ndarray:
    """Keys of texts, one column for each function of each family; where a text isn't in a family its own node."""
    least, most = np.array([k.least for k in kinds]), np.array([k.most for k in kinds])
    inside = (words[:, None] >= least) & (words[:, None] <= most)
    flat = np.frombuffer(b"".join(keys), np.int64)
    each = len(flat) // inside.sum()
    table = np.repeat(node, len(kinds) * each).reshape(len(node), len(kinds), each)
    table[inside] = flat.reshape(-1, each)
    return table.reshape(len(node), -1)


def histogram(words: np.ndarray) -> np.ndarray:
    """How many words fall into each bin, 255 at most.

    An edit changes two bins by one at most, so texts are at least half the
    difference of their histograms apart.
    """
    bins = (words >> np.uint64(32)).astype(np.int64) % BINS
    return np.minimum(np.bincount(bins, minlength=BINS), 255).astype(np.uint8)


def sketched(docs: DataFrame, share: float, sketches: int) -> DataFrame:
    """``node, digest, id, words, keys, bins`` of each distinct text; stored."""
    multipliers = np.random.default_rng(5).integers(0, 2**63, sketches, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    kinds = families(share, sketches)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            if len(known) > _KNOWN:
                known.clear()
            counts, keys, bins = [], [], []
            for text in batch.column(2).to_pylist():
                words = np.fromiter(map(known.__getitem__, text.split()), np.uint64)
                counts.append(len(words))
                keys.append(keys_of(words, multipliers, kinds).tobytes())
                bins.append(histogram(words).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), pa.array(bins, pa.binary())],
                ["doc_id", "digest", "words", "keys", "bins"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(docs).alias("digest"), text_of(docs).alias("text"))
    return cut_lineage(
        rows.mapInArrow(run, "doc_id long, digest binary, words long, keys binary, bins binary")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("id"), F.max("words").alias("words"), F.max("keys").alias("keys"), F.max("bins").alias("bins"))
        .withColumn("node", F.monotonically_increasing_id())
    )


def met(nodes: DataFrame) -> DataFrame:
    """``key, node, words, first``: texts in buckets of more than one, and the smallest of the bucket; stored."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(2).to_pylist()
            times = [len(k) // 8 for k in keys]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.frombuffer(b"".join(keys), np.int64)),
                    pa.array(np.repeat(batch.column(0).to_numpy(), times)),
                    pa.array(np.repeat(batch.column(1).to_numpy(), times)),
                ],
                ["key", "node", "words"],
            )

    entries = nodes.select("node", "words", "keys").mapInArrow(spread, "key long, node long, words long")
    shared = cut_lineage(
        entries.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last"))
        .where("first != last").select("key", "first")
    )
    return cut_lineage(entries.join(shared, "key"))


def verified(pairs: DataFrame, held: DataFrame, share: float) -> DataFrame:
    """``a, b, same`` of each pair, by alignment of the texts in ``held`` (``node, text``); stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = [similar(x, y, share) for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same, pa.bool_())], ["a", "b", "same"])

    one = held.select(F.col("node").alias("a"), F.col("text").alias("one"))
    other = held.select(F.col("node").alias("b"), F.col("text").alias("other"))
    joined = pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other")
    return cut_lineage(joined.mapInArrow(run, "a long, b long, same boolean"))


def _apart(rows: DataFrame, classes: DataFrame | None, node: str, label: str) -> DataFrame:
    """Rows with the class of one of their nodes."""
    if classes is None:
        return rows.withColumn(label, F.col(node))
    named = classes.select(F.col("id").alias(node), F.col("component").alias(label))
    return rows.join(named, node, "left").withColumn(label, F.coalesce(label, node))


def _could_match(one: str, other: str, share: float) -> Column:
    """Lengths that leave the similarity possible."""
    shorter, longer = F.least(one, other), F.greatest(one, other)
    return shorter >= longer - F.floor(longer * (1 - share) + 1e-9)


def classes_of_nodes(nodes: DataFrame, docs: DataFrame, share: float, kinds: tuple[Family, ...]) -> DataFrame:
    """``id, component`` of each node that isn't the smallest of its class."""
    buckets = met(nodes)
    some = buckets.select("node").distinct()
    wanted = nodes.join(some, "node").select("node", "digest")
    keyed = docs.select(digest_of(docs).alias("digest"), text_of(docs).alias("text"))
    held = cut_lineage(keyed.dropDuplicates(["digest"]).join(wanted, "digest").select("node", "text"))

    lengths = nodes.select(F.col("node").alias("first"), F.col("words").alias("first_words"))
    stars = buckets.where("node != first").select("node", "words", "first").distinct()
    stars = cut_lineage(
        stars.join(lengths, "first").where(_could_match("words", "first_words", share)).select("node", "first")
    )
    tried = verified(stars.groupBy(F.col("node").alias("b")).agg(F.min("first").alias("a")), held, share)
    links = tried.where("same").select("a", "b")
    classes = components(links)

    apart = _apart(_apart(stars, classes, "node", "one"), classes, "first", "other").where("one != other")
    left = apart.select(F.col("first").alias("a"), F.col("node").alias("b")).join(
        tried.select("a", "b"), ["a", "b"], "left_anti"
    )
    links = links.unionByName(verified(left, held, share).where("same").select("a", "b"))
    classes = components(links)

    open_rows = still_open(_apart(buckets.select("key", "node", "words"), classes, "node", "class"))
    celled = in_cells(open_rows.join(nodes.select("node", "keys", "bins"), "node"))
    near_rows = cut_lineage(with_candidate(celled, share, kinds))
    found = aligned(near_rows.join(held, "node"), share, kinds)
    return components(links.unionByName(found))


def still_open(known: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of buckets of several classes, with how many parts their bucket has; stored.

    Rows of the most frequent class (``common``) and the others (``rare``) are cut
    apart, each into parts of about ``block`` rows. A bucket of at most ``block``
    rows is one part.
    """
    sizes = known.groupBy(F.col("key").alias("bucket"), "class").agg(F.count(F.lit(1)).alias("n"))
    small, cut = F.col("rows") <= block, lambda n: F.ceil(n / block).cast("int")
    tops = cut_lineage(
        sizes.groupBy("bucket")
        .agg(F.sum("n").alias("rows"), F.max(F.struct("n", "class")).alias("top"))
        .where("top.n < rows")
        .select(
            "bucket",
            F.col("top.class").alias("common"),
            F.when(small, 1).otherwise(cut(F.col("rows") - F.col("top.n"))).alias("rare_parts"),
            F.when(small, 0).otherwise(cut(F.col("top.n"))).alias("common_parts"),
        )
    )
    return cut_lineage(known.join(tops, F.col("key") == F.col("bucket")).drop("key"))


def in_cells(rows: DataFrame) -> DataFrame:
    """Rows with their part (``side``) and the cells ``i, j`` of two parts they meet in, i <= j.

    Rare parts come first and meet all parts, themselves included; common parts
    don't meet each other. So a cell holds two parts at most, and each pair that is
    not within the common class meets in exactly one.
    """
    rare, common = F.col("rare_parts"), F.col("common_parts")
    is_common = (F.col("class") == F.col("common")) & (common > 0)
    within = lambda parts: F.pmod(F.xxhash64("node"), parts).cast("int")
    last = F.when(is_common, rare).otherwise(rare + common) - 1
    return (
        rows.withColumn("side", F.when(is_common, rare + within(common)).otherwise(within(rare)))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), last)))
        .withColumn("i", F.least("side", "_other"))
        .withColumn("j", F.greatest("side", "_other"))
        .drop("_other", "rare_parts", "common_parts")
    )


class _Cell:
    """Rows of a bucket that meet in one cell."""

    def __init__(self, table: pa.Table, share: float, kinds: tuple[Family, ...]):
        self.node, self.label = table["node"].to_numpy(), table["class"].to_numpy()
        self.words, self.share = table["words"].to_numpy(), share
        self.keys = key_table(table["keys"].to_pylist(), self.words, self.node, kinds)
        self.fine = np.frombuffer(b"".join(table["bins"].to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
        self.coarse = self.fine.reshape(-1, COARSE, BINS // COARSE).sum(axis=2)
        self.bucket, self.across = table["bucket"][0].as_py(), across(table)
        side, self.rare = table["side"].to_numpy(), self.label != table["common"][0].as_py()
        self.asking = self.rare & (side == table["i"][0].as_py())
        self.asked = side == table["j"][0].as_py()

    def candidates(self, n: int) -> np.ndarray:
        """Rows that ``n``, one of those asking, may match, the most alike first.

        Lengths and word histograms rule rows out, coarse histograms first; nothing
        that could be a link goes. A pair of several buckets is seen in the first.
        """
        once = self.across | ~self.rare | (self.node < self.node[n])
        at = np.flatnonzero(self.asked & (self.label != self.label[n]) & once)
        limit = ((1.0 - self.share) * np.maximum(self.words[at], self.words[n]) + 1e-9).astype(np.int64)
        for near in (
            lambda a: np.abs(self.words[a] - self.words[n]),
            lambda a: np.abs(self.coarse[a] - self.coarse[n]).sum(axis=1) // 2,
            lambda a: np.abs(self.fine[a] - self.fine[n]).sum(axis=1) // 2,
        ):
            away = near(at)
            good = away <= limit
            at, limit, away = at[good], limit[good], away[good]
        shared = self.keys[at] == self.keys[n]
        first = self.keys[n][shared.argmax(axis=1)] == self.bucket
        return at[first][np.argsort(away[first], kind="stable")]


def with_candidate(rows: DataFrame, share: float, kinds: tuple[Family, ...]) -> DataFrame:
    """The rows that may match another in their cell."""
    schema = rows.select(*CELL, "side", "node", "class", "common", "words", "keys", "bins")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            cell, kept = _Cell(table, share, kinds), np.zeros(table.num_rows, bool)
            for n in np.flatnonzero(cell.asking):
                at = cell.candidates(n)
                kept[at] = True
                kept[n] |= len(at) > 0
            if kept.any():
                yield from table.filter(pa.array(kept)).combine_chunks().to_batches()

    return by_cell(schema).mapInArrow(keep, schema.schema)


def aligned(rows: DataFrame, share: float, kinds: tuple[Family, ...]) -> DataFrame:
    """``a, b`` of links between classes; once two classes are linked in a cell, their other pairs are skipped."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches):
            cell, text = _Cell(table, share, kinds), table["text"]
            joined: dict[int, int] = {}

            def root(label: int) -> int:
                while label in joined:
                    label = joined[label]
                return label

            links = []
            for n in np.flatnonzero(cell.asking):
                own = text[n].as_py()
                for at in cell.candidates(n):
                    one, other = root(int(cell.label[n])), root(int(cell.label[at]))
                    if one != other and similar(own, text[at].as_py(), share):
                        joined[one] = other
                        links.append((int(cell.node[n]), int(cell.node[at])))
            if links:
                one, other = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(other, pa.int64())], ["a", "b"])

    wanted = rows.select(*CELL, "side", "node", "class", "common", "words", "keys", "bins", "text")
    return cut_lineage(by_cell(wanted).mapInArrow(link, "a long, b long"))


def near_classes(docs: DataFrame, share: float = SIMILARITY, sketches: int = SKETCHES) -> DataFrame:
    """``digest, class_id, keeper`` of each distinct text; ``keeper`` is the digest of the text that stays."""
    nodes = sketched(docs, share, sketches)
    classes = classes_of_nodes(nodes, docs, share, families(share, sketches))
    named = cut_lineage(_apart(nodes.select("node", "digest", "id"), classes, "node", "class"))
    least = cut_lineage(
        named.groupBy("class").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("least"))
    )
    return cut_lineage(
        named.join(least, "class").select(
            "digest", F.col("least.id").alias("class_id"), F.col("least.digest").alias("keeper")
        )
    )


def near_documents(docs: DataFrame, share: float = SIMILARITY, sketches: int = SKETCHES) -> DataFrame:
    """``doc_id, class_id, kept`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest_of(docs).alias("digest"))
    return rows.join(near_classes(docs, share, sketches), "digest").select(
        "doc_id", "class_id", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept")
    )


def without_near_copies(docs: DataFrame, share: float = SIMILARITY, sketches: int = SKETCHES) -> DataFrame:
    """The rows that stay, one of each class, with the columns of ``docs``."""
    keepers = near_classes(docs, share, sketches).where("digest = keeper").select(F.col("digest").alias("stays"))
    key, rank = fresh(docs, "digest"), fresh(docs, "rank")
    order = Window.partitionBy(key).orderBy(F.col("doc_id").asc_nulls_last())
    ranked = docs.withColumn(key, digest_of(docs)).withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1)
    return ranked.join(keepers, ranked[key] == keepers["stays"], "left_semi").select(*docs.columns)
