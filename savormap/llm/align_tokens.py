"""Alignment of two tokenizers over the same bytes.

Both tokenizers cut the same bytes into tokens. In each batch the tokens of both
sides are put together by ``pandas.merge_asof``, keyed by document: the start of each
token finds the token of the other side that covers it. The union of both
directions is every overlap; overlaps that end together are links, and their ends cut
a document into groups, the smallest runs of tokens that cover the same bytes.

How often an id pair is linked is counted over all documents. A document's own
pairs are stored packed, so texts are encoded once. Looking their counts up has two
tiers: the ``FREQUENT`` most frequent pairs, a table of fixed size, are broadcast; the
other pairs join the counts by a shuffle, where no key is hot because hot pairs are
in the first tier. The highest count of each id of the second side is a row per id
of its vocabulary and is broadcast too.

A text that is null, empty, or whose tokens' bytes do not add up to the text has no
tokens. Rows with a null or repeated ``doc_id`` are documents of their own. An empty
table gives no rows; further columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savormap.llm.common import texts
from savormap.llm.pack import LONG_SPACE, PRE_TOKENS, encoding
from savormap.storage import cut_lineage

FIRST = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json as ranks
SECOND = "piece_bpe_32k.model"
FREQUENT = 1 << 20  # pairs of the broadcast table: 16 MB
_HELD = 1 << 20  # pairs a task gathers before it sends their counts on
_BYTES = 1 << 20  # of texts encoded together


class Side:
    """One tokenizer: how it encodes texts, and each token's bytes."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        self.numbers = np.array([str(n).encode() for n in range(len(pieces))], "S7").view(np.uint8).reshape(-1, 7)


class ByteLevel(Side):
    """A byte-level BPE given as ranks; special strings in texts are plain text."""

    def __init__(self, name: str):
        self.known = encoding(name)
        super().__init__([self.known.decode_single_token_bytes(n) for n in range(self.known.n_vocab)])

    def encode(self, some: list[str]) -> list[np.ndarray]:
        """Ids of texts with a space ahead."""
        return [self._ids(f" {text}") for text in some]

    def _ids(self, text: str) -> np.ndarray:
        if not LONG_SPACE.search(text):
            return self.known.encode_to_numpy(text, disallowed_special=())
        # The library's own splitting gives up on very long white space; its merging doesn't.
        found: list[int] = []
        for token in PRE_TOKENS.findall(text):
            found.extend(self.known._encode_single_piece(token))
        return np.array(found, np.uint32)


class Pieces(Side):
    """A model of the sentencepiece library, which puts a space ahead itself."""

    def __init__(self, name: str):
        self.known = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        count = self.known.get_piece_size()
        pieces = [self.known.id_to_piece(n) for n in range(count)]
        super().__init__(
            [bytes([int(p[3:-1], 16)]) if self.known.is_byte(n) else p.replace("▁", " ").encode() for n, p in enumerate(pieces)]
        )

    def encode(self, some: list[str]) -> list[np.ndarray]:
        """Ids of texts."""
        return [np.array(ids, np.uint32) for ids in self.known.encode(some, num_threads=1)]


@lru_cache(maxsize=4)
def side(name: str) -> Side:
    """A tokenizer, read once in each worker."""
    return Pieces(name) if name.endswith(".model") else ByteLevel(name)


class Tokens:
    """Tokens of one side of some documents: ids, documents, and places in the documents' joined bytes."""

    def __init__(self, coded: list[np.ndarray], lengths: np.ndarray):
        self.ids = np.concatenate(coded).astype(np.int64)
        self.counts = np.array(list(map(len, coded)), np.int64)
        self.doc = np.repeat(np.arange(len(coded)), self.counts)
        self.end = np.cumsum(lengths[self.ids])
        self.start = self.end - lengths[self.ids]

    def frame(self, name: str) -> pd.DataFrame:
        """Rows sorted by start; tokens without bytes cover nothing and are left out."""
        frame = pd.DataFrame({"doc": self.doc, "start": self.start, name: np.arange(len(self.ids))})
        return frame[self.end > self.start]


def overlaps(one: Tokens, other: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the tokens of both sides that share bytes, each pair once, in order."""
    a, b = one.frame("a"), other.frame("b")
    width = max(1, len(other.ids))
    codes = []
    for x, y in ((a, b), (b, a)):
        covered = pd.merge_asof(x, y, on="start", by="doc")
        codes.append(covered["a"].to_numpy() * width + covered["b"].to_numpy())
    code = np.sort(np.concatenate(codes), kind="stable")  # two sorted runs
    code = code[np.flatnonzero(np.append(True, code[1:] != code[:-1])[: len(code)])]
    return code // width, code % width


def _listed(one: Tokens, other: Tokens, links: np.ndarray, partners: np.ndarray, sides: tuple[Side, Side]) -> list[bytes]:
    """For each document its groups as ``a1,a2|b1;a3|b2,b3``."""
    count = len(one.ids) + len(other.ids)
    # A group's ids of the first side, then those of the second.
    closed_a, closed_b = np.zeros(len(one.ids), np.int64), np.zeros(len(other.ids), np.int64)
    closed_a[links], closed_b[partners] = 1, 1
    group = np.concatenate([np.cumsum(closed_a) - closed_a, np.cumsum(closed_b) - closed_b])
    second = np.repeat([0, 1], [len(one.ids), len(other.ids)])
    order = np.lexsort((second, group))  # stable, so tokens keep their order
    signs = np.concatenate([np.where(closed_a, ord("|"), ord(",")), np.where(closed_b, ord(";"), ord(","))])
    cells = np.zeros((count, 8), np.uint8)
    cells[: len(one.ids), :7] = sides[0].numbers[one.ids]
    cells[len(one.ids) :, :7] = sides[1].numbers[other.ids]
    cells[:, 7] = signs
    cells = cells[order]
    sizes = np.count_nonzero(cells, axis=1)
    joined = cells.tobytes().replace(b"\x00", b"")
    per_doc = np.zeros(len(one.counts), np.int64)
    np.add.at(per_doc, np.concatenate([one.doc, other.doc])[order], sizes)
    ends = np.cumsum(per_doc).tolist()
    return [joined[a : max(a, b - 1)] for a, b in zip([0, *ends[:-1]], ends, strict=True)]


_ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
)


def _aligned(doc_ids: list, some: list[str], first: Side, second: Side) -> pa.RecordBatch:
    coded = [first.encode(some), second.encode(some)]
    for n, text in enumerate(some):
        whole = f" {text}".encode() if text else b""
        for tokens, known in zip(coded, (first, second), strict=True):
            if b"".join(map(known.pieces.__getitem__, tokens[n].tolist())) != whole:
                whole = b""
                break
        if not whole:
            coded[0][n] = coded[1][n] = np.zeros(0, np.uint32)
    one, other = Tokens(coded[0], first.lengths), Tokens(coded[1], second.lengths)
    a, b = overlaps(one, other)
    same = one.end[a] == other.end[b]
    links, partners = a[same], b[same]
    lists = _listed(one, other, links, partners, (first, second))
    groups = np.bincount(one.doc[np.unique(links)], minlength=len(some))
    edges = np.searchsorted(one.doc[links], np.arange(len(some) + 1))
    code = one.ids[links] * len(second.pieces) + other.ids[partners]
    packed = [np.unique(code[x:y], return_counts=True) for x, y in zip(edges[:-1], edges[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(doc_ids, pa.int64()),
            pa.array(one.counts),
            pa.array(other.counts),
            pa.array(groups.astype(np.int64)),
            pa.array(np.diff(edges).astype(np.int64)),
            pa.array([hashlib.sha256(x).hexdigest() if x else "" for x in lists], pa.string()),
            pa.array([c.astype("<u4").tobytes() for c, _ in packed], pa.binary()),
            pa.array([t.astype("<u4").tobytes() for _, t in packed], pa.binary()),
        ],
        [c.split()[0] for c in _ALIGNED.split(", ")],
    )


def aligned(docs: DataFrame, first: str = FIRST, second: str = SECOND) -> DataFrame:
    """Tokens, groups and links of every document.

    ``pairs`` holds its linked id pairs (first id x size of the second vocabulary +
    second id) and ``times`` how often each is linked in it, as unsigned 32-bit
    numbers; two vocabularies of up to 65,536 ids fit.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = side(first), side(second)
        for batch in batches:
            ids, some = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            begin, size = 0, 0
            for n, text in enumerate(some):
                size += len(text)
                if size >= _BYTES or n == len(some) - 1:
                    yield _aligned(ids[begin : n + 1], some[begin : n + 1], one, other)
                    begin, size = n + 1, 0

    return texts(docs).mapInArrow(run, _ALIGNED)


def pair_counts(found: DataFrame) -> DataFrame:
    """``pair, n``: how often each id pair is linked in all documents; combined in tasks before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def sums() -> pa.RecordBatch:
            pairs = np.concatenate([p for p, _ in held])
            times = np.concatenate([t for _, t in held])
            known, at = np.unique(pairs, return_inverse=True)
            total = np.bincount(at, times, len(known)).astype(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(known.astype(np.int64)), pa.array(total)], ["pair", "n"])

        for batch in batches:
            for pairs, times in zip(*_unpacked(batch, 0), strict=True):
                held.append((pairs, times))
                size += len(pairs)
                if size > _HELD:
                    yield sums()
                    held, size = [], 0
        if held:
            yield sums()

    sent = found.select("pairs", "times").mapInArrow(run, "pair long, n long")
    return sent.groupBy("pair").agg(F.sum("n").alias("n"))


def _unpacked(batch: pa.RecordBatch, at: int) -> tuple[Iterable[np.ndarray], Iterable[np.ndarray]]:
    """The packed columns ``at`` and the next as arrays, row by row."""
    return tuple([np.frombuffer(x, "<u4") for x in batch.column(n).to_pylist()] for n in (at, at + 1))


class Table:
    """Sorted pairs and their counts; what isn't listed has 0."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray):
        order = np.argsort(pairs)
        self.pairs, self.counts = pairs[order].astype(np.uint32), counts[order]

    def of(self, pairs: np.ndarray) -> np.ndarray:
        """The count of each pair, 0 if it isn't listed."""
        if not len(self.pairs):
            return np.zeros(len(pairs), np.int64)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.counts[at], 0)


def _columns(rows: DataFrame) -> list[np.ndarray]:
    table = rows.toArrow()
    return [c.to_numpy() for c in table.columns]


def alignment(docs: DataFrame, first: str = FIRST, second: str = SECOND, frequent: int = FREQUENT) -> DataFrame:
    """Tokens, groups, links and how usual the links are, for every document.

    ``n_best`` counts links whose pair is the most frequent of its second id, ties
    included; ``count_sum`` adds the counts of all links' pairs.
    """
    context = docs.sparkSession.sparkContext
    width = len(side(second).pieces)
    found = cut_lineage(aligned(docs, first, second).withColumn("row", F.monotonically_increasing_id()))
    counted = cut_lineage(pair_counts(found))
    top = counted.orderBy(F.desc("n"), "pair").limit(frequent)  # the first tier
    best = counted.groupBy((F.col("pair") % width).alias("second")).agg(F.max("n").alias("n"))  # of a vocabulary
    listed, highest = _columns(top.select("pair", "n")), np.zeros(width, np.int64)
    ids, counts = _columns(best)
    highest[ids] = counts
    table, most = context.broadcast(Table(*listed)), context.broadcast(highest)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with what the table says, and one for each pair it lacks."""
        for batch in batches:
            rows = batch.column(0).to_numpy()
            out: list[list[np.ndarray]] = []
            for row, pairs, times in zip(rows, *_unpacked(batch, 1), strict=True):
                counts = table.value.of(pairs)
                known = counts > 0
                is_best = known & (counts == most.value[pairs % width])
                missed = pairs[~known]
                out.append(
                    [
                        np.full(len(missed) + 1, row),
                        np.append(-1, missed.astype(np.int64)),
                        np.append(0, times[~known].astype(np.int64)),
                        np.append(int(times[is_best].sum()), np.zeros(len(missed), np.int64)),
                        np.append(int((counts * times).sum()), np.zeros(len(missed), np.int64)),
                    ]
                )
            if out:
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["row", "pair", "times", "n_best", "count_sum"])

    looked = cut_lineage(
        found.select("row", "pairs", "times").mapInArrow(look_up, "row long, pair long, times long, n_best long, count_sum long")
    )

    @F.arrow_udf("long")
    def highest_of(pairs: pa.Array) -> pa.Array:
        return pa.array(most.value[pairs.to_numpy() % width])

    rest = looked.where("pair >= 0").select("row", "pair", "times").join(counted, "pair")
    rest = rest.select(
        "row",
        F.when(F.col("n") == highest_of("pair"), F.col("times")).otherwise(0).alias("n_best"),
        (F.col("n") * F.col("times")).alias("count_sum"),
    )
    sums = (
        looked.where("pair < 0")
        .select("row", "n_best", "count_sum")
        .unionByName(rest)
        .groupBy("row")
        .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    return found.join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )
