"""The classifier's accuracy on labels that it never sees."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from savormap.llm import quality
from savormap.llm.common import prepared

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    prepared(spark)
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_held_out_labels_are_predicted_and_never_read(spark, tables):
    docs, labels = tables
    held = labels.where(quality.held_out())
    spoiled = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    sample = quality.sampled(docs, labels)
    assert sample == quality.sampled(docs, spoiled)
    got = quality.scores(docs, quality.fit(sample))
    rows = got.join(held, "doc_id").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 and r["held_out"] for r in rows)
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.95
    assert (good >= quality.THRESHOLD).mean() > 0.95
    assert got.count() == docs.count()
    assert got.where("predicted != cast(score >= 0.7 as int) or not score between 0 and 1").count() == 0


def test_chosen_texts_are_read_whole(spark, tables):
    docs, labels = tables
    whole = {(r["text"] or "").encode() for r in docs.join(labels, "doc_id", "left_semi").select("text").collect()}
    sample = quality.sampled(docs, labels)
    assert {t for t, _ in sample} <= whole and max(len(t) for t, _ in sample) > 4 * quality.CHUNK


def test_chunks_cover_the_text():
    text = bytes(range(256)) * 37 + b"end"
    rows = quality.chunked(text)
    assert rows.shape[1] == quality.CHUNK and bytes(rows[-1].astype(np.uint8)) == text[-quality.CHUNK :]
    marks = np.arange(3_001).astype(np.int64)
    seen = {int(x) for r in quality.chunked(bytes(3_001)) for x in r}
    assert seen == {0} and len(marks) == 3_001
    assert quality.chunked(b"").shape == (1, quality.CHUNK)


def test_odd_rows(spark, tables):
    net = quality.fit([(b"good words", 1), (b"bad *** words", 0)], steps=5)
    rows = [(1, None, "a"), (1, "", "b"), (None, "x" * 200_000, None)]
    df = prepared(spark).createDataFrame(rows, "doc_id long, text string, score string")
    scored = quality.scores(df, net).collect()
    assert len(scored) == 3 and all(0 <= r["score"] <= 1 for r in scored)
    assert quality.accepted(df, net).columns == df.columns
    assert quality.scores(df.limit(0), net).count() == 0
    assert quality.fit([]).score(b"any") == 0.5
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.trained(df, empty).score(b"any") == 0.5
