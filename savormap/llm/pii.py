"""Personal data by patterns, checksums and context, in column expressions alone.

A regular expression proposes spans of a kind; a validator (range, Luhn,
mod 97, number of digits) confirms them; words near a span adjust its score.
Spans of the base kinds stay whatever their score; the kinds the method adds
(bank accounts, social security numbers, secret keys) stay from a score of 0.5.

Positions are code points. They come from one pass that splits the text at the
matches: a match starts where the gaps and matches before it end. A quick test
keeps texts that can't match away from that. The patterns are those of the
contract made safe for very long texts: a match can only start where a run of
its first class starts or the match before it ended, and loops over groups are
possessive or bounded, so that nothing backtracks over a run or recurses into it.

A null text counts as empty and has no spans; redacting leaves it null. Rows with
a null or repeated ``doc_id`` are treated each on its own.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savormap.llm.common import fresh, text_of

CONTEXT = 40  # code points looked at on either side
ACCEPTED = 0.5
NEAR = 0.3  # what a context word adds
_BLOCK = 256

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string,score:double>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def small_parts(value: Column) -> Column:
    """Four numbers of at most 255."""
    part = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"
    return value.rlike(rf"^{part}\.{part}\.{part}\.{part}$")


def luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn check."""

    def weighed(digits: Column) -> Column:
        def add(acc: Column, place: Column) -> Column:
            digit = F.substring(digits, -place, F.lit(1)).cast("int")
            doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
            return acc + F.when(place % 2 == 0, doubled).otherwise(digit)

        return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)

    return let(_digits(value), weighed) % 10 == 0


def mod_97(value: Column) -> Column:
    """Whether an account number leaves 1 when divided by 97, its head moved to the end."""

    def rest(plain: Column) -> Column:
        moved = F.concat(F.substring(plain, 5, 34), F.substring(plain, 1, 4))

        def step(acc: Column, place: Column) -> Column:
            letter = F.ascii(F.substring(moved, place, F.lit(1)))
            return F.when(letter < 58, (acc * 10 + letter - 48) % 97).otherwise((acc * 100 + letter - 55) % 97)

        return F.aggregate(F.sequence(F.lit(1), F.length(plain)), F.lit(0), step)

    return let(F.regexp_replace(value, " ", ""), rest) == 1


def _phone_digits(value: Column) -> Column:
    return F.length(_digits(value)).between(9, 15)


def _always(value: Column) -> Column:
    return value.isNotNull()


@dataclass(frozen=True)
class Kind:
    """What proposes, confirms and scores one kind of span."""

    name: str
    pattern: str
    quick: Callable[[Column], Column]
    confirm: Callable[[Column], Column]
    score: float
    words: str


#: In the order in which spans with one start are listed; the first four are the base.
KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda t: F.contains(t, F.lit("@")),
        _always,
        0.9,
        "mail|contact|write",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda t: t.rlike(r"[0-9]\.[0-9]"),
        small_parts,
        0.7,
        "ip|address|host|server",
    ),
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}(?![ -]?[0-9])",
        lambda t: t.rlike(r"[0-9](?:[ -]?[0-9]){11}"),
        luhn,
        0.7,
        "card|credit|visa|payment",
    ),
    Kind(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        lambda t: F.contains(t, F.lit("+")),
        _phone_digits,
        0.7,
        "tel|phone|call|mobile|fax",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        lambda t: t.rlike(r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}"),
        mod_97,
        0.6,
        "iban|account|bank|konto",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda t: t.rlike(r"[0-9]{3}-[0-9]{2}-[0-9]{4}"),
        _always,
        0.3,
        "ssn|social|security",
    ),
    Kind(
        "key",
        r"(?<![A-Za-z0-9])[0-9a-f]{32,128}(?![A-Za-z0-9])",
        lambda t: t.rlike(r"[0-9a-f]{32}"),
        _always,
        0.3,
        "token|secret|password|api.?key",
    ),
)
BASE = tuple(k.name for k in KINDS[:4])


def _ends(lengths: Column) -> Column:
    """Running sums, by blocks, so that long lists don't cost their square."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    count = F.size(lengths)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((count - 1) / _BLOCK).cast("int")),
        lambda b: total(F.slice(lengths, b * _BLOCK + 1, F.lit(_BLOCK))),
    )

    def before(sums: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(sums) - 1), lambda b: total(F.slice(sums, F.lit(1), b))
        )

    def running(starts: Column) -> Column:
        def end(_: Column, n: Column) -> Column:
            block = F.floor(n / _BLOCK).cast("int")
            inside = F.slice(lengths, block * _BLOCK + 1, n - block * _BLOCK + 1)
            return F.element_at(starts, block + 1) + total(inside)

        return F.transform(lengths, end)

    return let(let(blocks, before), running)


def _spans_of(kind: Kind, rank: int, text: Column) -> Column:
    """Confirmed and scored spans of one kind."""

    def located(cut: Column) -> Column:
        gaps, found = cut["gaps"], cut["found"]
        lengths = F.transform(found, lambda m, n: F.length(m) + F.length(F.element_at(gaps, n + 1)))

        def scored(ends: Column) -> Column:
            def one(match: Column, n: Column) -> Column:
                end = F.element_at(ends, n + 1)
                near = F.concat(
                    F.substring(F.element_at(gaps, n + 1), -CONTEXT, CONTEXT),
                    F.lit(" "),
                    F.substring(F.element_at(gaps, n + 2), 1, CONTEXT),
                )
                bonus = F.when(F.lower(near).rlike(rf"\b(?:{kind.words})"), NEAR).otherwise(0.0)
                return F.struct(
                    (end - F.length(match)).alias("start"),
                    F.lit(rank).alias("rank"),
                    end.alias("end"),
                    F.lit(kind.name).alias("kind"),
                    F.least(F.lit(1.0), F.lit(kind.score) + bonus).alias("score"),
                    kind.confirm(match).alias("confirmed"),
                )

            kept = F.filter(
                F.transform(found, one),
                lambda s: s["confirmed"] & (F.lit(kind.name in BASE) | (s["score"] >= ACCEPTED)),
            )
            return F.transform(
                kept, lambda s: F.struct(*(s[c].alias(c) for c in ("start", "rank", "end", "kind", "score")))
            )

        return F.when(F.size(found) == 0, F.array().cast(_SPAN)).otherwise(let(let(lengths, _ends), scored))

    cut = F.struct(
        F.split(text, kind.pattern, -1).alias("gaps"),
        F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0)).alias("found"),
    )
    return F.when(kind.quick(text), let(cut, located)).otherwise(F.array().cast(_SPAN))


def spans(text: Column) -> Column:
    """All spans of a text, by start and kind: ``start, rank, end, kind, score``; ends are exclusive."""
    return F.sort_array(F.concat(*(_spans_of(k, n, text) for n, k in enumerate(KINDS))))


def listed(found: Column) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def find(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every document."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), spans(text_of(docs)).alias("spans"))


def _masked(text: Column, found: Column) -> Column:
    """The text with its spans replaced, by blocks of spans, so that long lists don't cost their square.

    A block has the text from its first span to that of the next; what is covered at
    its beginning comes from the furthest end of the blocks before.
    """
    count = F.size(found)
    numbers = F.sequence(F.lit(0), F.floor((count - 1) / _BLOCK).cast("int"))

    def part(block: Column) -> Column:
        return F.slice(found, block * _BLOCK + 1, F.lit(_BLOCK))

    def first(block: Column) -> Column:
        return F.element_at(found, F.least(block * _BLOCK + 1, count))["start"]

    def replaced(block: Column, here: Column) -> Column:
        def add(acc: Column, span: Column) -> Column:
            label = F.concat(F.lit("<"), F.upper(span["kind"]), F.lit(">"))
            gap = F.substring(here["text"], acc["at"] - here["begin"] + 1, span["start"] - acc["at"])
            parts = F.when(span["start"] >= acc["at"], F.concat(acc["parts"], F.array(gap, label))).otherwise(acc["parts"])
            return F.struct(parts.alias("parts"), F.greatest(acc["at"], span["end"]).alias("at"))

        def finish(acc: Column) -> Column:
            left = F.greatest(here["stop"] - acc["at"], F.lit(0))
            return F.array_join(F.concat(acc["parts"], F.array(F.substring(here["text"], acc["at"] - here["begin"] + 1, left))), "")

        start = F.struct(F.array().cast("array<string>").alias("parts"), here["at"].alias("at"))
        return F.aggregate(part(block), start, add, finish)

    def pieces(furthest: Column) -> Column:
        def piece(block: Column) -> Column:
            begin = F.when(block == 0, F.lit(0)).otherwise(first(block))
            stop = F.when((block + 1) * _BLOCK < count, first(block + 1)).otherwise(F.length(text))
            covered = F.coalesce(F.array_max(F.slice(furthest, F.lit(1), block)), F.lit(0))

            def cut(ends: Column) -> Column:
                held = F.struct(
                    ends["begin"].alias("begin"),
                    ends["stop"].alias("stop"),
                    F.greatest(ends["begin"], ends["covered"]).alias("at"),
                    F.substring(text, ends["begin"] + 1, ends["stop"] - ends["begin"]).alias("text"),
                )
                return let(held, lambda here: replaced(block, here))

            return let(F.struct(begin.alias("begin"), stop.alias("stop"), covered.alias("covered")), cut)

        return F.array_join(F.transform(numbers, piece), "")

    return let(F.transform(numbers, lambda b: F.array_max(F.transform(part(b), lambda s: s["end"]))), pieces)


def redact(docs: DataFrame) -> DataFrame:
    """The columns of ``docs``, each span in ``text`` replaced by its kind in angle brackets.

    Overlapping spans become one, named by the first. ``n_chars``, where there is
    one, counts the new text.
    """
    name = fresh(docs, "spans")
    marked = docs.withColumn(name, spans(text_of(docs)))
    text = F.when(F.size(name) == 0, F.col("text")).otherwise(_masked(F.col("text"), F.col(name)))
    changed = marked.withColumn("text", text)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        counted = F.when(F.size(name) == 0, F.col("n_chars")).otherwise(F.length("text").cast(kind))
        changed = changed.withColumn("n_chars", counted)
    return changed.select(*docs.columns)


def count_of(kind: str, found: Column) -> Column:
    """How many spans are of one kind."""
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")


def base_only(found: Column) -> Column:
    """Spans of the base kinds."""
    return F.filter(found, lambda s: reduce(lambda a, b: a | b, (s["kind"] == k for k in BASE)))
