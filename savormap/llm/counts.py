"""Token counts by a map-side two-tier lookup.

The first tier is a compact hash table of frequent pre-tokens and their numbers
of tokens, broadcast; the second is a bounded cache in each worker, filled by
encoding what the table lacks. Which pre-tokens are frequent comes from
Misra-Gries summaries of all documents, one bounded row per partition, merged
in a tree. No pre-token is shuffled by key.

Counts are exact whatever the table holds. A null or empty text has no tokens;
special strings inside a text count as one token, as the tokenizer's default.
Rows with a null or repeated ``doc_id`` are documents of their own.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from savormap.llm.common import shrink, summary, texts
from savormap.llm.newer import has_newer, words
from savormap.llm.pack import PRE_TOKENS, SPECIALS, VOCABULARY, ids_of

FREQUENT = 65_536  # entries of the broadcast table: about 2 MB
CACHED = 500_000  # entries of a worker's cache before it starts anew
LONGEST_CACHED = 256  # characters; longer pre-tokens are encoded without a place in the cache
LIMIT = 1_024
LIBRARY = "byte_bpe_50k.json"  # the file that splits texts with characters unknown here
_TREE_DEPTH = 3

class LengthTable:
    """Open-addressing table from a pre-token's bytes to its number of tokens."""

    def __init__(self, lengths: dict[bytes, int]):
        size = 1 << max(4, (2 * len(lengths)).bit_length())
        self.mask = size - 1
        self.slots = np.full(size, -1, np.int32)
        keys = list(lengths)
        self.ends = np.cumsum([0, *map(len, keys)]).astype(np.uint32)
        self.blob = b"".join(keys)
        self.lengths = np.array([lengths[k] for k in keys], np.uint16)
        for n, key in enumerate(keys):
            at = zlib.crc32(key) & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = n

    def get(self, key: bytes) -> int | None:
        """The number of tokens; None for a pre-token that isn't listed."""
        at = zlib.crc32(key) & self.mask
        while (n := self.slots[at]) >= 0:
            if self.blob[self.ends[n] : self.ends[n + 1]] == key:
                return int(self.lengths[n])
            at = (at + 1) & self.mask
        return None


class Lengths(dict):
    """A worker's cache over the table: what neither has is encoded."""

    def __init__(self, table: LengthTable, vocabulary: str):
        super().__init__()
        self.table = table
        self.vocabulary = vocabulary

    def __missing__(self, token: str) -> int:
        length = self.table.get(token.encode())
        if length is None:
            length = len(ids_of(token, self.vocabulary))
        if len(token) <= LONGEST_CACHED:
            self[token] = length
        return length

    def of(self, text: str) -> int:
        """Tokens of a whole text."""
        if len(self) > CACHED:
            self.clear()
        total = 0
        for n, part in enumerate(SPECIALS.split(text)):
            if n % 2:
                total += 1
            elif has_newer(part):
                total += sum(map(self.__getitem__, words(part, LIBRARY)))
            else:
                total += sum(map(self.__getitem__, PRE_TOKENS.findall(part)))
        return total


def frequent_items(docs: DataFrame, split: regex.Pattern, keep: int) -> list[str]:
    """At most ``keep`` frequent pieces of all texts, most frequent first.

    Each partition sends one Misra-Gries summary; summaries are merged in a tree,
    so that none of them, the driver's included, is larger than ``keep`` counters.
    """

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[list]:
        for batch in batches:
            some: list[str] = []
            for text in batch.column(1).to_pylist():
                some += split.findall(text)
            yield some

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, _ = summary(pieces(batches), keep, LONGEST_CACHED)
        yield pa.RecordBatch.from_arrays(
            [pa.array([list(counts)], pa.list_(pa.string())), pa.array([list(counts.values())], pa.list_(pa.int64()))],
            ["items", "counts"],
        )

    def merge(one: Counter, other: Counter) -> Counter:
        one.update(other)
        return shrink(one, keep)

    rows = docs.mapInArrow(count, "items array<string>, counts array<long>").rdd
    merged = rows.map(lambda r: Counter(dict(zip(r["items"], r["counts"], strict=True)))).treeReduce(
        merge, _TREE_DEPTH
    ) if not docs.isEmpty() else Counter()
    return sorted(merged, key=lambda p: (-merged[p], p))


def frequent_lengths(docs: DataFrame, keep: int = FREQUENT, vocabulary: str = VOCABULARY) -> LengthTable:
    """The table of the corpus' frequent pre-tokens."""
    items = frequent_items(texts(docs), PRE_TOKENS, keep)
    return LengthTable({p.encode(): len(ids_of(p, vocabulary)) for p in items})


def token_counts(
    docs: DataFrame, limit: int = LIMIT, keep: int = FREQUENT, vocabulary: str = VOCABULARY
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, keep, vocabulary))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = Lengths(table.value, vocabulary)
        for batch in batches:
            whole = batch.column(1).to_pylist()
            tokens = [lengths.of(t) for t in whole]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in whole], pa.int64()),
                    pa.array(tokens, pa.int64()),
                    pa.array([n > limit for n in tokens], pa.bool_()),
                ],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return texts(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
