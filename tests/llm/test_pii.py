"""Spans against Python's own regular expressions, and redaction."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from savormap.llm import pii
from savormap.llm.common import prepared

BITS = [
    "a@b.co", "x_@y.zz.", "@", "..", "-", "4111 1111 1111 1111", "4111-1111-1111-1111", " 1", "1", "12",
    "5555555555554444", "+1 (499) 555-6503", "+", "1.2.3.4", "255.256.1.1", "10.0.0.007", ".", "é", "\U0001f600",
    "\n", "  ", "- ", "(", ")", "%", "_", "a", "Z9",
]


def luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text: str) -> str:
    found = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end(), "email"))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m[0].split(".")):
            found.append((m.start(), 1, m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end(), "phone"))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))


def listed(spark, texts):
    df = prepared(spark).createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = pii.find(df).select("doc_id", pii.listed(pii.base_only(F.col("spans"))), pii.listed(F.col("spans")))
    return {r[0]: (r[1], r[2]) for r in found.collect()}


def test_base_spans_are_those_of_the_patterns(spark):
    draw = random.Random(3)
    texts = ["".join(draw.choice(BITS) for _ in range(draw.randint(0, 25))) for _ in range(1_500)]
    texts += ["me@x.org " * 700, "1 " * 3_000, "1.2" * 900, "+1 " * 900, "a@" + "b." * 2_000 + "c"]
    got = listed(spark, texts)
    assert [got[n][0] for n in range(len(texts))] == [base(t) for t in texts]


def test_very_long_runs_end(spark):
    texts = ["1" * 300_000, "a" * 300_000, "1 " * 150_000, "+1" + " 2" * 150_000, "A1" * 150_000, "1." * 150_000]
    got = listed(spark, texts)
    assert got[0][0] == got[1][0] == got[3][0] == ""


def test_added_kinds_need_checksum_or_context(spark):
    texts = [
        "IBAN GB82 WEST 1234 5698 7654 32.", "IBAN GB83 WEST 1234 5698 7654 32.", "ssn 123-45-6789", "part 123-45-6789",
        'token = "' + "5d" * 20 + '"', "sum " + "5d" * 20,
    ]
    got = {n: s[1] for n, s in listed(spark, texts).items()}
    assert [got[n].split(":")[0] for n in range(6)] == ["iban", "", "ssn", "", "key", ""]


@pytest.mark.parametrize("name", ["spans", "_spans"])
def test_redaction_keeps_other_columns(spark, name):
    rows = [(1, "é mail a@b.co or +1 (499) 555-6503!", 99, "s"), (1, None, None, None), (None, "", 0, "t"), (2, "clean", 5, "u")]
    df = prepared(spark).createDataFrame(rows, f"doc_id long, text string, n_chars int, {name} string")
    got = {(r["doc_id"], r["text"], r["n_chars"], r[name]) for r in pii.redact(df).collect()}
    text = "é mail <EMAIL> or <PHONE>!"
    assert got == {(1, text, len(text), "s"), (1, None, None, None), (None, "", 0, "t"), (2, "clean", 5, "u")}
    assert pii.redact(df.limit(0)).columns == df.columns and pii.redact(df.limit(0)).count() == 0


def test_overlapping_spans_become_one(spark):
    df = prepared(spark).createDataFrame([(1, "+4111 1111 1111 1111.a@b.co")], "doc_id long, text string")
    text = pii.redact(df).first()["text"]
    assert not re.search("[0-9]", text) and text.count("<") <= 2


def test_no_python_in_the_plan(spark):
    from tests.conftest import plan_of

    df = spark.range(3).select(F.col("id").alias("doc_id"), F.concat(F.lit("a@b.co "), "id").alias("text"))
    assert not re.search("Python|Arrow|Pandas", plan_of(pii.redact(df)))


def redacted(text: str, spans) -> str:
    """Spans replaced one after another; overlapping ones become one."""
    parts, at = [], 0
    for s in spans:
        if s["start"] >= at:
            parts += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]])


def test_long_lists_of_spans(spark):
    draw = random.Random(8)
    bits = [*BITS, "+4111 1111 1111 1111.a@b.co", "é", " ", " 10.0.0.1", " x@y.zz"]
    rows = [(n, "".join(draw.choice(bits) for _ in range(draw.choice([3, 1_000, 5_000])))) for n in range(30)]
    rows.append((99, "ü jo@mail.org " * 100_000))
    df = prepared(spark).createDataFrame(rows, "doc_id long, text string").repartition(8)
    spans = {r["doc_id"]: r["spans"] for r in pii.find(df).collect()}
    assert len(spans[99]) == 100_000
    begin = time.perf_counter()
    got = {r["doc_id"]: r["text"] for r in pii.redact(df).collect()}
    assert time.perf_counter() - begin < 60
    assert got == {n: redacted(t, spans[n]) for n, t in rows}
