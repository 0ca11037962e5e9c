"""BPE encoding and decoding over a minimal acyclic transducer.

Frequent words (Misra-Gries summaries of all documents) and their ids are
compiled into an acyclic transducer with shared suffixes: a word's ids are the
outputs along its path, pushed as far to the front as its neighbours allow. The
transducer is flat arrays that each worker maps into memory. A word it lacks is
merged exactly, pair by pair, and kept in a bounded cache.

Encoding normalises (NFC, lower case), splits, and drops white space, as the
tokenizer file says; special strings in a text become their ids. Decoding joins
the tokens' strings with one space, as a tokenizer without a decoder does. A
null or empty text has no ids and decodes to the empty text. Rows with a null
or repeated ``doc_id`` are documents of their own.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import tempfile
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from savormap.llm.common import texts
from savormap.llm.counts import CACHED, LONGEST_CACHED, frequent_items
from savormap.llm.newer import has_newer, words

VOCABULARY = "word_bpe_49k.json"
FREQUENT = 65_536
WORD_END = "</w>"
SHORT = 24  # bytes of a word that is merged by looking at all its pairs
_NO_MERGE = 1 << 60

#: How the tokenizer splits a normalised text.
WORDS = regex.compile(r"\p{L}++|'(?:s|t|re|ve|m|ll|d)|\p{N}|[^\s\p{L}\p{N}]++")
#: The same for ASCII in lower case.
ASCII_WORDS = re.compile(r"[a-z]++|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\x09-\x0d a-z0-9]++")


def byte_letters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(others)) for b in range(256)]


class Merges:
    """The vocabulary: exact merging of one word, strings of ids, special strings."""

    def __init__(self, vocabulary: str = VOCABULARY):
        with open(public_tokenizers.path(vocabulary), encoding="utf-8") as file:
            known = json.load(file)
        ids = known["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in known["added_tokens"]}
        self.strings = {i: s for s, i in [*ids.items(), *self.special.items()]}
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in known["model"]["merges"]]
        self.ranks = {(ids[a], ids[b]): (rank, ids[a + b]) for rank, (a, b) in enumerate(pairs)}
        self.rank_of = {pair: rank for pair, (rank, _) in self.ranks.items()}
        self.merged = [ids[a + b] for a, b in pairs]
        letters = byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + WORD_END] for c in letters]
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    def merge(self, word: bytes) -> list[int]:
        """Ids of one word: the lowest-ranked pair first, leftmost of equals; n log n."""
        if not word:
            return []
        ids = [*(self.inner[b] for b in word[:-1]), self.last[word[-1]]]
        if len(ids) <= SHORT:
            return self._merge_short(ids)
        after = list(range(1, len(ids) + 1))
        before = list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(at: int) -> None:
            to = after[at]
            if to < len(ids) and (found := self.ranks.get((ids[at], ids[to]))):
                heapq.heappush(heap, (found[0], at, ids[at], ids[to], found[1]))

        for at in range(len(ids) - 1):
            offer(at)
        while heap:
            _, at, left, right, merged = heapq.heappop(heap)
            to = after[at] if ids[at] == left else len(ids)
            if to >= len(ids) or ids[to] != right:
                continue  # one of the two has been merged meanwhile
            ids[at], ids[to] = merged, -1
            after[at] = after[to]
            if after[at] < len(ids):
                before[after[at]] = at
            offer(at)
            if before[at] >= 0:
                offer(before[at])
        return [i for i in ids if i >= 0]

    def _merge_short(self, ids: list[int]) -> list[int]:
        """The same for a few ids, where looking all pairs up is cheaper than keeping them in order."""
        rank_of, merged = self.rank_of.get, self.merged
        found = [rank_of(pair, _NO_MERGE) for pair in zip(ids, ids[1:])]  # noqa: B905, RUF007
        while found:
            best = min(found)
            if best == _NO_MERGE:
                break
            at = found.index(best)
            new = merged[best]
            ids[at : at + 2] = [new]
            del found[at]
            if at:
                found[at - 1] = rank_of((ids[at - 1], new), _NO_MERGE)
            if at < len(found):
                found[at] = rank_of((new, ids[at + 1]), _NO_MERGE)
        return ids


@lru_cache(maxsize=2)
def merges(vocabulary: str = VOCABULARY) -> Merges:
    """The vocabulary, read once in each worker."""
    return Merges(vocabulary)


@lru_cache(maxsize=2)
def strings_of_ids(vocabulary: str = VOCABULARY) -> pa.Array:
    """The string of each id, by id."""
    strings = merges(vocabulary).strings
    return pa.array([strings.get(i) for i in range(max(strings) + 1)], pa.string())


class _State:
    __slots__ = ("edges", "outputs", "final", "rest")

    def __init__(self) -> None:
        self.edges: dict[int, _State] = {}
        self.outputs: dict[int, tuple[int, ...]] = {}
        self.final = False
        self.rest: tuple[int, ...] = ()

    def shape(self) -> tuple:
        return (self.final, self.rest, tuple((b, id(s), self.outputs[b]) for b, s in self.edges.items()))


def _common(one: tuple, other: tuple) -> int:
    n = 0
    while n < min(len(one), len(other)) and one[n] == other[n]:
        n += 1
    return n


def compile_words(words: dict[bytes, list[int]]) -> bytes:
    """The minimal transducer of the words, as one block of arrays.

    Words are added in order; states behind the prefix shared with the next word
    are final, and each is replaced by an equal one if there is any.
    """
    start, known, previous = _State(), {}, b""
    path = [start]

    def settle(depth: int) -> None:
        while len(path) - 1 > depth:
            state = path.pop()
            path[-1].edges[previous[len(path) - 1]] = known.setdefault(state.shape(), state)

    for word in sorted(words):
        shared = _common(tuple(word), tuple(previous))
        settle(shared)
        rest = tuple(words[word])
        for depth in range(shared):
            state, byte = path[depth], word[depth]
            kept = state.outputs[byte][: _common(state.outputs[byte], rest)]
            if pushed := state.outputs[byte][len(kept) :]:
                below = path[depth + 1]
                below.outputs = {b: pushed + o for b, o in below.outputs.items()}
                if below.final:
                    below.rest = pushed + below.rest
                state.outputs[byte] = kept
            rest = rest[len(kept) :]
        for byte in word[shared:]:
            state = _State()
            path[-1].edges[byte] = state
            path[-1].outputs[byte] = () if len(path) > shared + 1 else rest
            path.append(state)
        path[-1].final = True
        if len(word) == shared:
            path[-1].rest = rest
        previous = word
    settle(0)

    numbers: dict[int, int] = {id(start): 0}
    states = [start]
    for state in states:
        for below in state.edges.values():
            if id(below) not in numbers:
                numbers[id(below)] = len(states)
                states.append(below)
    edges = sorted(
        (numbers[id(s)] << 8 | b, numbers[id(t)], s.outputs[b]) for s in states for b, t in s.edges.items()
    )
    pool: list[int] = []
    spans = []
    for output in [o for _, _, o in edges] + [s.rest for s in states]:
        spans.append((len(pool), len(output)))
        pool.extend(output)
    parts = [
        np.array([e[0] for e in edges], np.uint32),
        np.array([e[1] for e in edges], np.uint32),
        np.array(spans, np.uint32).reshape(-1),
        np.array([s.final for s in states], np.uint32),
        np.array(pool, np.uint32),
    ]
    return np.array([len(p) for p in parts], np.uint32).tobytes() + b"".join(p.tobytes() for p in parts)


class Transducer:
    """Looks words up in a compiled block that is mapped into memory."""

    def __init__(self, block: bytes):
        file = tempfile.TemporaryFile()  # without a name: gone with the worker
        file.write(block)
        file.flush()
        self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        whole = np.frombuffer(self.map, np.uint32)
        ends = np.cumsum([5, *whole[:5]])
        self.keys, self.targets, spans, self.final, self.pool = (
            whole[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)
        )
        self.spans = spans.reshape(-1, 2)

    def states(self) -> int:
        """How many states the automaton has."""
        return len(self.final)

    def find(self, words: list[bytes]) -> list[bytes | None]:
        """Packed ids of each word; None for one that isn't listed. All words advance a byte at a time."""
        lengths = np.array([len(w) for w in words], int)
        alive = np.flatnonzero((lengths > 0) & (lengths <= LONGEST_CACHED)) if len(self.keys) else np.zeros(0, int)
        letters = np.zeros((len(words), int(lengths[alive].max()) if len(alive) else 1), np.uint8)
        flat = np.frombuffer(b"".join(words[n] for n in alive), np.uint8)
        rows = np.repeat(alive, lengths[alive])
        letters[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths[alive]) - lengths[alive], lengths[alive])] = flat
        state = np.zeros(len(words), np.uint32)
        known = np.zeros(len(words), bool)
        passed: list[tuple[np.ndarray, np.ndarray]] = []
        at = 0
        while len(alive):
            wanted = state[alive] << np.uint32(8) | letters[alive, at]
            edge = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            good = self.keys[edge] == wanted
            alive, edge = alive[good], edge[good]
            passed.append((alive, edge))
            state[alive] = self.targets[edge]
            at += 1
            ended = alive[lengths[alive] == at]
            known[ended] = self.final[state[ended]] > 0
            passed.append((ended, len(self.keys) + state[ended].astype(np.int64)))
            alive = alive[lengths[alive] > at]
        if not passed:
            return [None] * len(words)
        owner, span = (np.concatenate(x) for x in zip(*passed, strict=True))
        some = known[owner] & (self.spans[span, 1] > 0)
        order = np.argsort(owner[some], kind="stable")
        owner, span = owner[some][order], span[some][order]
        starts, sizes = self.spans[span, 0].astype(np.int64), self.spans[span, 1].astype(np.int64)
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        ids = self.pool[np.repeat(starts, sizes) + within].tobytes()
        ends = (4 * np.cumsum(np.bincount(np.repeat(owner, sizes), minlength=len(words)))).tolist()
        return [ids[a:b] if k else None for a, b, k in zip([0, *ends], ends, known.tolist(), strict=False)]


class Encoder:
    """A worker's encoder: its cache, then the transducer, then exact merging."""

    def __init__(self, block: bytes, vocabulary: str = VOCABULARY):
        self.transducer = Transducer(block)
        self.merges = merges(vocabulary)
        self.cache: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.cache) > CACHED:
            self.cache.clear()
        new = list(words - self.cache.keys())
        coded = [w.encode() for w in new]
        for word, raw, ids in zip(new, coded, self.transducer.find(coded), strict=True):
            self.cache[word] = np.array(self.merges.merge(raw), "<u4").tobytes() if ids is None else ids

    def encode(self, whole: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each."""
        split = [list(self._parts(t)) for t in whole]
        words: set[str] = set()
        for parts in split:
            for special, found in parts:
                if not special:
                    words.update(found)
        self._learn(words)
        of = self.cache.__getitem__
        result = [
            b"".join([found if special else b"".join(map(of, found)) for special, found in parts])
            for parts in split
        ]
        for word in [w for w in words if len(w) > LONGEST_CACHED]:
            del self.cache[word]
        return result

    def _parts(self, text: str) -> Iterator[tuple[bool, object]]:
        if not text:
            return
        for n, part in enumerate(self.merges.specials.split(text)):
            if n % 2:
                yield True, np.array([self.merges.special[part]], "<u4").tobytes()
            elif part:
                yield False, words_of(part)


def normal(text: str) -> str:
    """NFC and lower case letter by letter, without the final sigma that a whole word would get."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def words_of(text: str) -> list[str]:
    """Words of a text without special strings, in the way that the tokenizer reads them."""
    if text.isascii():
        return ASCII_WORDS.findall(text.lower())
    if has_newer(text):
        return words(text, VOCABULARY)
    return WORDS.findall(normal(text))


class _Split:
    """What finds the words of whole texts for the summaries."""

    findall = staticmethod(words_of)


def lexicon(docs: DataFrame, keep: int = FREQUENT, vocabulary: str = VOCABULARY) -> bytes:
    """The compiled transducer of the corpus' frequent words."""
    known = merges(vocabulary)
    return compile_words({w.encode(): known.merge(w.encode()) for w in frequent_items(texts(docs), _Split(), keep)})


_encoders: dict[tuple[int, str], Encoder] = {}


def _encoder(block: Broadcast, vocabulary: str) -> Encoder:
    """The worker's encoder, with what it has learnt from the tasks before."""
    key = (hash(block.value), vocabulary)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(block.value, vocabulary)
    return _encoders[key]


def encode(docs: DataFrame, keep: int = FREQUENT, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, ids`` of every document; ids as an array of ints."""
    block = docs.sparkSession.sparkContext.broadcast(lexicon(docs, keep, vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(block, vocabulary)
        for batch in batches:
            ids = listed(encoder.encode(batch.column(1).to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], ["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids array<int>")


def listed(coded: list[bytes]) -> pa.ListArray:
    """Packed ids of texts as a column."""
    ends = np.cumsum([0, *(len(c) // 4 for c in coded)]).astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(coded), np.int32)))


def decoded(ids: pa.ListArray, vocabulary: str = VOCABULARY) -> pa.Array:
    """The texts of a column of ids."""
    ends = pa.array(np.cumsum([0, *ids.value_lengths().to_pylist()]), pa.int32())
    tokens = strings_of_ids(vocabulary).take(ids.flatten())
    return pc.binary_join(pa.ListArray.from_arrays(ends, tokens), " ")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The columns of ``encoded`` and ``decoded``, the text of ``ids``."""

    @F.arrow_udf("string")
    def text_of_ids(ids: pa.Array) -> pa.Array:
        return decoded(ids, vocabulary)

    return encoded.withColumn("decoded", text_of_ids("ids"))


@lru_cache(maxsize=2)
def _numbers(vocabulary: str) -> np.ndarray:
    """Every id in decimal and a space, filled up with zero bytes."""
    count = max(merges(vocabulary).strings) + 1
    width = len(str(count)) + 1
    return np.array([f"{n} ".encode() for n in range(count)], f"S{width}").view(np.uint8).reshape(count, width)


def round_trip(docs: DataFrame, keep: int = FREQUENT, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every document, encoded and decoded in one pass.

    The digests are of the ids in decimal, apart by a space, and of the decoded text.
    """
    block = docs.sparkSession.sparkContext.broadcast(lexicon(docs, keep, vocabulary))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, numbers = _encoder(block, vocabulary), _numbers(vocabulary)
        for batch in batches:
            coded = encoder.encode(batch.column(1).to_pylist())
            decimal = (numbers[np.frombuffer(c, np.int32)].tobytes().replace(b"\0", b"")[:-1] for c in coded)
            again = decoded(listed(coded), vocabulary)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(c) // 4 for c in coded], pa.int64()),
                    pa.array([sha256(d).hexdigest() for d in decimal], pa.string()),
                    pa.array([sha256(t.as_buffer()).hexdigest() for t in again], pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
