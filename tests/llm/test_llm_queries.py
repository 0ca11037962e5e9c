"""Registered queries against their SQL, and the pipeline stage by stage."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from savormap.llm import near, pack, pii, quality
from savormap.llm.common import documents
from savormap.llm.queries import QUERIES, SQL
from tests.llm.test_pii import redacted
from tests.oracle import connect, differences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), SQL[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_every_document_is_there(spark, name):
    got = QUERIES[name](spark, SF)
    key, table = ("page_id", "pages") if "page_id" in got.columns else ("doc_id", "documents")
    assert got.select(key).distinct().count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def odd_documents(spark):
    """The documents with null, empty and repeated rows, ties, long texts and columns with names in use."""
    names = ["_digest", "doc", "key", "bucket", "node", "spans", "score"]
    schema = documents(spark, SF).schema
    docs = documents(spark, SF).select("*", *(F.lit("mine").alias(n) for n in names))
    more = ", ".join(f"{n} string" for n in names)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    first = docs.orderBy("doc_id").where("length(text) between 300 and 3000").limit(4).collect()
    rows = [
        (10_001, None, "en", "s", 0, *["x"] * 7),
        (None, "", None, None, None, *[None] * 7),
        (None, None, None, None, None, *[None] * 7),
        (10_003, first[0]["text"], "en", "s", 1, *["tie"] * 7),
        (10_003, first[0]["text"], "en", "s", 2, *["tie"] * 7),
        (10_004, first[1]["text"] + " Write to jo.doe@mail1.example.com or +1 (555) 010-2030.", "en", "s", 3, *["x"] * 7),
        (10_005, " ".join([first[2]["text"]] * 400), "en", "s", 4, *["long"] * 7),
    ]
    return docs.unionByName(spark.createDataFrame(rows, f"{kinds}, {more}"))


def test_stages(spark):
    """Each stage against a plain version of itself, on what the one before it kept."""
    docs = odd_documents(spark).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF).cache()
        assert after.columns == docs.columns, name
        before, kept = docs.collect(), after.collect()
        row = lambda r: tuple(r)
        if name == "quality_classifier":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            model = quality.trained(documents(spark, SF), labels)
            scores = quality.scores(docs, model).collect()
            good = Counter(r["doc_id"] for r in scores if r["predicted"] == 1)
            assert Counter(r["doc_id"] for r in kept) == good and 0 < len(kept) < len(before)
            assert not Counter(map(row, kept)) - Counter(map(row, before))
        if name == "exact_dedup":
            last = {}
            for r in before:
                text, at = r["text"] or "", (r["doc_id"] is not None, r["doc_id"] or 0)
                last[text] = max(last.get(text, at), at)
            assert Counter((r["text"] or "", r["doc_id"]) for r in kept) == Counter(
                (text, at[1] if at[0] else None) for text, at in last.items()
            )
        if name == "minhash_near_dedup":
            found = near.near_documents(docs).collect()
            least = {}
            for r in found:
                known = least.get(r["class_id"])
                if r["doc_id"] is not None:
                    least[r["class_id"]] = r["doc_id"] if known is None else min(known, r["doc_id"])
                else:
                    least.setdefault(r["class_id"], None)
            assert Counter(r["doc_id"] for r in kept) == Counter(least.values())
        if name == "pii":
            spans = {r["doc_id"]: r["spans"] for r in pii.find(docs).collect()}
            texts = {r["doc_id"]: r["text"] or "" for r in before}
            assert len(kept) == len(before)
            for r in kept:
                if r["doc_id"] is not None:
                    assert (r["text"] or "") == redacted(texts[r["doc_id"]], spans[r["doc_id"]])
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert len({r["sequence_id"] for r in pieces}) == len(pieces)
    ids = {}
    for r in sorted(pieces, key=lambda r: r["start"]):
        ids[r["doc_id"]] = ids.get(r["doc_id"], b"") + r["ids"]
    for r in docs.collect():
        assert ids[r["doc_id"]] == np.append(pack.ids_of(r["text"] or ""), 1).astype("<u4").tobytes()


def test_stages_of_no_documents(spark):
    empty = odd_documents(spark).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_run_is_the_stages(spark):
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF).where("length > 0").count() > 0
