"""Quality of whole texts by a byte-level convolutional network in numpy.

A text is read as UTF-8 bytes in overlapping chunks that cover all of it. In
each chunk learned filters slide over embedded bytes and their largest responses
make one score; the mean, smallest and largest score of the chunks are combined
into one probability by a last, calibrated layer.

The network is fitted on a bounded sample of labelled rows, ``SAMPLE_ROWS`` with
the smallest hashes, whose texts are read whole; so is every text that is scored. A
null text counts as empty; an empty text is one chunk of padding and gets a score like
any other, as does a row with a null or repeated ``doc_id``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savormap.llm.common import fresh, text_of, texts

SAMPLE_ROWS = 3_000
CHUNK = 1_024
OVERLAP = 32
EMBEDDED = 8
WIDTH = 8
STRIDE = 2
FILTERS = 24
STEPS = 1_500
CROP = 160  # each sampled text also teaches by a piece of at most so many bytes
THRESHOLD = 0.7
HELD_OUT = 2  # remainder of crc32(doc_id) by 4 whose labels are never learnt from


def held_out() -> Column:
    """Whether a row's label is kept for testing."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == HELD_OUT, F.lit(False))


@dataclass
class Network:
    """Embedding, filters, the chunk layer, and the document layer."""

    embedding: np.ndarray  # 257 x EMBEDDED; the last row is padding
    filters: np.ndarray  # WIDTH * EMBEDDED x FILTERS
    bias: np.ndarray
    output: np.ndarray
    shift: float
    final: np.ndarray  # weights of mean, smallest and largest chunk score, and the constant

    def pooled(self, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Largest rectified response of each filter in each chunk, where it was, and the windows."""
        windows = unfolded(self.embedding[chunks])
        response = windows @ self.filters
        at = response.argmax(axis=1)
        top = np.take_along_axis(response, at[:, None], 1)[:, 0] + self.bias
        return np.maximum(top, 0), at, windows

    def chunk_scores(self, text: bytes, slice_chunks: int = 64) -> np.ndarray:
        """Scores of the chunks of a whole text, a bounded number of them at a time."""
        rows = chunked(text)
        return np.concatenate(
            [
                self.pooled(rows[n : n + slice_chunks])[0] @ self.output + self.shift
                for n in range(0, len(rows), slice_chunks)
            ]
        )

    def score(self, text: bytes) -> float:
        """Probability of label 1."""
        return float(sigmoid(features(self.chunk_scores(text)) @ self.final))


def sigmoid(x: np.ndarray) -> np.ndarray:
    """Logistic function without overflow."""
    return 0.5 * (1 + np.tanh(0.5 * x))


def features(scores: np.ndarray) -> np.ndarray:
    """What the document layer sees."""
    held = np.clip(scores, -20, 20)
    return np.array([held.mean(), held.min(), held.max(), 1.0])


def chunked(text: bytes) -> np.ndarray:
    """Overlapping chunks that cover the text; the last one ends with it, a short text is padded."""
    codes = np.frombuffer(text, np.uint8).astype(np.int16)
    if len(codes) < CHUNK:
        return np.pad(codes, (0, CHUNK - len(codes)), constant_values=256)[None]
    starts = np.append(np.arange(0, len(codes) - CHUNK, CHUNK - OVERLAP), len(codes) - CHUNK)
    return np.lib.stride_tricks.sliding_window_view(codes, CHUNK)[starts]


def unfolded(embedded: np.ndarray) -> np.ndarray:
    """Windows of each chunk, flattened: chunks x places x (WIDTH * EMBEDDED)."""
    chunks, length, size = embedded.shape
    flat = np.ascontiguousarray(embedded).reshape(chunks, length * size)
    windows = np.lib.stride_tricks.sliding_window_view(flat, WIDTH * size, axis=1)
    return windows[:, :: STRIDE * size]


def fit(sample: list[tuple[bytes, int]], steps: int = STEPS, seed: int = 7) -> Network:
    """Adam on the log loss of chunks, classes weighted alike; then the document layer."""
    draw = np.random.default_rng(seed)
    net = Network(
        draw.normal(0, 0.5, (257, EMBEDDED)).astype(np.float32),
        draw.normal(0, 0.2, (WIDTH * EMBEDDED, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        draw.normal(0, 0.2, FILTERS).astype(np.float32),
        0.0,
        np.array([1.0, 0.0, 0.0, 0.0]),
    )
    if not sample:
        net.final = np.zeros(4)
        return net
    crops = []
    for text, label in sample:
        length = int(draw.integers(8, CROP))
        start = int(draw.integers(0, max(1, len(text) - length)))
        crops.append((text[start : start + length], label))
    sample = sample + crops
    pieces = [(chunked(text), label) for text, label in sample]
    chunks = np.concatenate([c for c, _ in pieces])
    target = np.concatenate([np.full(len(c), y, np.float32) for c, y in pieces])
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    weight = np.where(target == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
    # A long text counts for the root of its number of chunks, so that short ones are heard too.
    weight /= np.sqrt(np.concatenate([np.full(len(c), len(c), np.float32) for c, _ in pieces]))
    weight /= weight.mean()
    names = ("embedding", "filters", "bias", "output", "shift")
    first = {n: 0.0 for n in names}
    second = {n: 0.0 for n in names}
    order = np.zeros(0, int)
    for step in range(1, steps + 1):
        if len(order) < 64:
            order = np.append(order, draw.permutation(len(chunks)))
        batch, order = order[:64], order[64:]
        top, at, windows = net.pooled(chunks[batch])
        slope = (sigmoid(top @ net.output + net.shift) - target[batch]) * weight[batch] / len(batch)
        back = slope[:, None] * net.output * (top > 0)  # chunks x filters
        seen = windows[np.arange(len(batch))[:, None], at]  # chunks x filters x inputs
        to_input = back[..., None] * net.filters.T
        places = at[..., None] * STRIDE + np.arange(WIDTH)
        codes = chunks[batch][np.arange(len(batch))[:, None, None], places]
        to_embedding = np.zeros_like(net.embedding)
        np.add.at(to_embedding, codes.reshape(-1), to_input.reshape(-1, EMBEDDED))
        slopes = {
            "embedding": to_embedding,
            "filters": np.einsum("cf,cfi->if", back, seen),
            "bias": back.sum(axis=0),
            "output": top.T @ slope,
            "shift": slope.sum(),
        }
        for name in names:
            first[name] = 0.9 * first[name] + 0.1 * slopes[name]
            second[name] = 0.999 * second[name] + 0.001 * slopes[name] ** 2
            moved = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
            setattr(net, name, (getattr(net, name) - np.float32(0.005) * moved))
        net.embedding = net.embedding.astype(np.float32)
        net.filters = net.filters.astype(np.float32)
    seen = np.array([features(net.chunk_scores(t)) for t, _ in sample])
    net.final = calibrated(seen, np.array([y for _, y in sample], float))
    return net


def calibrated(seen: np.ndarray, target: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Logistic regression by Newton steps."""
    weights = np.zeros(seen.shape[1])
    for _ in range(25):
        odds = sigmoid(seen @ weights)
        slope = seen.T @ (odds - target) + ridge * weights
        curve = (seen * (odds * (1 - odds))[:, None]).T @ seen + ridge * np.eye(seen.shape[1])
        weights = weights - np.clip(np.linalg.solve(curve, slope), -5, 5)
    return weights


def sampled(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> list[tuple[bytes, int]]:
    """A bounded sample of labelled rows that are not held out.

    Which rows are taken depends on the hash of the id alone. Their whole texts come
    to the driver, where the network is fitted: ``rows`` bounds them.
    """
    known = (
        labels.where("quality in (0, 1) and doc_id is not null")
        .where(~held_out())
        .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(rows)
    )

    joined = texts(docs).join(F.broadcast(known), "doc_id").select("doc_id", F.col("text").cast("binary").alias("text"), "quality")
    found = joined.orderBy(F.xxhash64("doc_id"), "doc_id", "text", "quality").limit(rows).collect()
    return [(bytes(r["text"] or b""), r["quality"]) for r in found]


def trained(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Network:
    """The network fitted on the bounded sample."""
    return fit(sampled(docs, labels, rows))


def score(text: Column, net: Network, spark) -> Column:
    """Probability that a text has label 1."""
    shared = spark.sparkContext.broadcast(net)

    @F.arrow_udf("double")
    def scored(batch: pa.Array) -> pa.Array:
        return pa.array([shared.value.score(t.encode()) for t in batch.to_pylist()], pa.float64())

    return scored(text)


def scores(docs: DataFrame, net: Network) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document."""
    return (
        docs.select("doc_id", held_out().alias("held_out"), score(text_of(docs), net, docs.sparkSession).alias("score"))
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
    )


def accepted(docs: DataFrame, net: Network) -> DataFrame:
    """The rows of ``docs`` whose texts are good, with their columns."""
    name = fresh(docs, "score")
    return (
        docs.withColumn(name, score(text_of(docs), net, docs.sparkSession))
        .where(F.col(name) >= THRESHOLD)
        .select(*docs.columns)
    )
