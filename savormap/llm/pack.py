"""Packing by power-of-two decomposition.

A document of L ids is cut into pieces of the largest length and the binary
digits of the rest, longest first. A piece is a sequence of its own: its length
is a power of two, so nothing is padded, and no sequence crosses documents.
Sequences of one length are a bucket; batches are drawn from one bucket.

A null or empty text has the end id alone. Rows with a null or repeated
``doc_id`` are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame

from savormap.llm.common import texts

LARGEST = 2_048
END_ID = 1
VOCABULARY = "byte_bpe_50k.tiktoken"  # the vocabulary of byte_bpe_50k.json as ranks
SPECIAL = {"<|endoftext|>": 50_256}

#: How the byte-level tokenizer splits a text before its merges.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
SPECIALS = regex.compile("(" + "|".join(map(regex.escape, SPECIAL)) + ")")
LONG_SPACE = regex.compile(r"\s{1024}")

PIECES = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
)


@lru_cache(maxsize=2)
def encoding(vocabulary: str = VOCABULARY) -> tiktoken.Encoding:
    """The byte-level tokenizer, read once in each worker."""
    with open(public_tokenizers.path(vocabulary), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding(
        vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )


def ids_of(text: str, vocabulary: str = VOCABULARY) -> np.ndarray:
    """Ids of a whole text; special strings become their ids, as the tokenizer's default."""
    known = encoding(vocabulary)
    if not LONG_SPACE.search(text):
        return known.encode_to_numpy(text, allowed_special="all")
    # The library's own splitting gives up on very long white space; its merging doesn't.
    found: list[int] = []
    for n, part in enumerate(SPECIALS.split(text)):
        if n % 2:
            found.append(SPECIAL[part])
        else:
            for token in PRE_TOKENS.findall(part):
                found.extend(known._encode_single_piece(token))
    return np.array(found, np.uint32)


def binary_lengths(total: int, largest: int = LARGEST) -> list[int]:
    """Powers of two up to ``largest``, descending, that add up to ``total``."""
    whole, rest = divmod(total, largest)
    digits = [1 << b for b in range(largest.bit_length() - 2, -1, -1) if rest >> b & 1]
    return [largest] * whole + digits


def sequence_number(length: int, partition: int, nth: int) -> int:
    """Bucket, partition and place in one long: unique, and sorted by bucket."""
    return (length.bit_length() - 1) << 58 | partition << 34 | nth


def pack(
    docs: DataFrame, largest: int = LARGEST, end_id: int = END_ID, vocabulary: str = VOCABULARY
) -> DataFrame:
    """One row per piece; ``ids`` are its ids as little-endian unsigned 32-bit numbers.

    ``start`` counts the ids of the document before the piece, ``doc_tokens`` all
    ids with the end id. Nothing is shuffled: a piece needs no partner.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, nth = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(ids_of(text, vocabulary), np.uint32(end_id)).astype("<u4")
                start = 0
                for length in binary_lengths(len(ids), largest):
                    piece = ids[start : start + length].tobytes()
                    rows.append((doc_id, start, length, piece, len(ids), sequence_number(length, partition, nth), 0))
                    start += length
                    nth += 1
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
            names = [c.split()[0] for c in PIECES.split(", ")]
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return texts(docs).mapInArrow(cut, PIECES)


def write_buckets(pieces: DataFrame, path: str) -> None:
    """A folder per sequence length."""
    pieces.write.partitionBy("length").parquet(path)
