"""Main text of web pages, with site templates removed.

Two passes over the pages. The first hashes the subtrees of each page and counts,
per host in Spark, on how many different pages each occurs; the second deletes
subtrees that recur across many pages of their host, and what the markup itself
declares as no part of an article, and returns the text that is left.

A subtree recurs if it is on at least ``FEWEST`` pages of the host, and on at least
``SHARE`` of them or on ``MANY``. Pages with the same title (or, without one, the same
markup) count as one, so that copies of an article do not pass for a template. Only
blocks are counted, and no subtree that holds the article. Inside a declared
article paragraphs, headings, list items and cells are its text however often
they occur; other containers in it can be templates (share bars, boxes).

The article is what ``article`` elements hold, where a page has any (reader comments
apart), else ``main``, else the body. Pages without a host have no templates. A null
or empty page has an empty text. Rows that repeat a ``page_id``, or have none, are
pages of their own. An empty table gives no rows; further columns don't matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from savormap.llm import sketch
from savormap.llm.markup import BLOCK, RAW, Page, attributes
from savormap.storage import cut_lineage

FEWEST = 3  # pages
SHARE = 0.02  # of the host's pages
MANY = 50  # pages that are enough whatever the share
LISTED = 1 << 20  # templates of the broadcast table: 16 MB
CELLS = 27  # bits of a cell's number in the sketch of pages: 32 MB

NEVER = RAW | frozenset(
    "head nav aside footer form dialog search button select template svg math canvas object audio video datalist menu".split()
)
PROSE = frozenset("p h1 h2 h3 h4 h5 h6 li dd dt blockquote pre td th tr tbody thead figcaption".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
HINTS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner"
    " nav navbar navigation menu breadcrumb breadcrumbs pagination pager footer masthead"
    " sidebar aside widget related recommended popular trending"
    " cookie cookies consent gdpr notice popup modal overlay newsletter subscribe subscription signup"
    " share sharing social comment comments commentlist reply replies respond disqus".split()
)
COMMENTS = frozenset("comment comments commentlist reply replies respond disqus".split())
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


def _hints(source: str) -> tuple[bool, bool]:
    """Whether a tag's attributes say that it is no part of an article, and that it is a reader's comment."""
    if "=" not in source and "hidden" not in source:
        return False, False
    own = attributes(source)
    words = {w.lower() for w in _WORD.findall(f"{own.get('class', '')} {own.get('id', '')}")}
    if "no" in words or "has" in words or "with" in words:
        words = set()  # says what is around, not what this is
    hidden = "hidden" in own or own.get("aria-hidden", "").lower() == "true"
    role = own.get("role", "").lower() in ROLES
    return hidden or role or bool(words & HINTS), bool(words & COMMENTS)


class Cleared:
    """A page, what of it is the article by its own markup, and which subtrees may be templates."""

    def __init__(self, html: str):
        page = self.page = Page(html)
        count = len(page.tag)
        hinted, comment = [False] * count, [False] * count
        for node, source in enumerate(page.source):
            if source:
                hinted[node], comment[node] = _hints(source)
        self.never = [tag in NEVER for tag in page.tag]
        outside = [False] * count  # in something that can't hold the article
        for node in range(1, count):
            outside[node] = outside[page.parent[node]] or self.never[node] or comment[node]
        roots = self._roots("article", outside) or self._roots("main", outside)
        self.inside = [False] * count
        holds = [False] * count
        for node in roots:
            self.inside[node] = holds[node] = True
        for node in range(count - 1, 0, -1):
            if holds[node]:
                holds[page.parent[node]] = True
        for node in range(1, count):
            self.inside[node] = self.inside[node] or self.inside[page.parent[node]]
        if not roots:
            holds = [tag in ("html", "body", "#page") for tag in page.tag]
        self.holds, self.roots = holds, bool(roots)
        for node in range(1, count):
            header = page.tag[node] == "header" and not self.inside[node]
            self.never[node] = (self.never[node] or hinted[node] or header) and not holds[node]

    def _roots(self, tag: str, outside: list[bool]) -> list[int]:
        return [n for n, t in enumerate(self.page.tag) if t == tag and not outside[n]]

    def candidates(self, host: str) -> dict[bytes, list[int]]:
        """Elements that go if their subtree recurs on the host, by a digest of host and subtree."""
        page = self.page
        filled, digests, start = page.has_text(), page.digests(), host.encode()
        found: dict[bytes, list[int]] = {}
        for node in range(1, len(page.tag)):
            tag = page.tag[node]
            if filled[node] and not self.holds[node] and tag in BLOCK and not (self.inside[node] and tag in PROSE):
                found.setdefault(blake2b(start + digests[node], digest_size=16).digest(), []).append(node)
        return found

    def text(self, recurring: Iterable[int] = ()) -> str:
        """The main text, without recurring subtrees and without what is declared to be none."""
        dropped = list(self.never)
        for node in recurring:
            dropped[node] = True
        return self.page.text(dropped, self.inside if self.roots else [True] * len(dropped))


class Templates:
    """A table of digests of recurring subtrees, 16 bytes each."""

    def __init__(self, digests: list[bytes]):
        halves = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2)
        self.first, self.second = halves[np.lexsort((halves[:, 1], halves[:, 0]))].T.copy()

    def has(self, digests: list[bytes]) -> np.ndarray:
        """Whether each digest is listed."""
        if not len(self.first) or not digests:
            return np.zeros(len(digests), bool)
        first, second = np.frombuffer(b"".join(digests), np.uint64).reshape(-1, 2).T
        found = np.zeros(len(digests), bool)
        at = np.searchsorted(self.first, first)
        while True:  # digests whose first halves agree lie side by side
            here = np.minimum(at, len(self.first) - 1)
            open_ = (self.first[here] == first) & (at < len(self.first)) & ~found
            if not open_.any():
                return found
            found |= open_ & (self.second[here] == second)
            at = at + 1


def host_of(url: Column) -> Column:
    """Host of an address in lower case, without user and port; empty if there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit("")))


def _page_key(url: str | None, html: str) -> bytes:
    return blake2b(f"{url or ''}\n{html}".encode(), digest_size=16).digest()


def subtrees(pages: DataFrame) -> DataFrame:
    """``page, host, context, digest``: once for each different subtree of a page that may be a template."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for url, host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                cleared = Cleared(html)
                context = blake2b((cleared.page.title or html).encode(), digest_size=16).digest()
                page = _page_key(url, html)
                rows.extend((page, host, context, digest) for digest in cleared.candidates(host))
            kinds = (pa.binary(), pa.string(), pa.binary(), pa.binary())
            columns = zip(*rows, strict=True) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["page", "host", "context", "digest"]
            )

    wanted = pages.where("host != '' and html != ''").select("url", "host", "html")
    return wanted.mapInArrow(run, "page binary, host string, context binary, digest binary")


def recurring(found: DataFrame, fewest: int = FEWEST, share: float = SHARE, many: int = MANY) -> DataFrame:
    """``digest, on`` of the subtrees that are on many pages of their host, and on how many.

    Repeats of a page are combined before pages are counted, so neither a large host
    nor a frequent subtree gathers in one task.
    """
    sizes = found.select("host", "context").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    on = (
        found.select("host", "digest", "context")
        .distinct()
        .groupBy("host", "digest")
        .agg(F.count(F.lit(1)).alias("on"))
        .where(F.col("on") >= fewest)
    )
    enough = (F.col("on") >= F.col("pages") * share) | (F.col("on") >= many)
    return on.join(sizes, "host").where(enough).select("digest", "on")


def main_text(
    pages: DataFrame, fewest: int = FEWEST, share: float = SHARE, many: int = MANY, listed: int = LISTED
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    The ``listed`` most frequent templates, a table of fixed size, are broadcast. A page
    that has others meets their list, no longer than the page itself, by a join; a
    sketch of such pages' keys keeps all others out of the shuffle.
    """
    spark = pages.sparkSession
    rows = pages.select(
        pages["page_id"].cast("long").alias("page_id"),
        pages["url"].alias("url"),
        host_of(pages["url"]).alias("host"),
        F.coalesce(pages["html"], F.lit("")).alias("html"),
    )
    found = cut_lineage(subtrees(rows))
    often = cut_lineage(recurring(found, fewest, share, many))
    top = often.orderBy(F.desc("on"), "digest").limit(listed).select("digest").toArrow()
    table = spark.sparkContext.broadcast(Templates(top["digest"].to_pylist()))

    @F.arrow_udf("boolean")
    def is_listed(digests: pa.Array) -> pa.Array:
        return pa.array(table.value.has(digests.to_pylist()))

    @F.arrow_udf("string")
    def cleared(html: pa.Array, host: pa.Array, further: pa.Array) -> pa.Array:
        out = []
        for source, name, others in zip(html.to_pylist(), host.to_pylist(), further.to_pylist(), strict=True):
            page = Cleared(source)
            held = page.candidates(name) if name else {}
            known, also = table.value.has(list(held)), set(others or ())
            out.append(page.text(n for (d, at), k in zip(held.items(), known, strict=True) if k or d in also for n in at))
        return pa.array(out, pa.string())

    none = F.lit(None).cast("array<binary>")
    rest = cut_lineage(often.where(~is_listed("digest")).select("digest"))
    if rest.isEmpty():
        marked = rows.withColumn("further", none)
    else:
        marks = cut_lineage(
            found.select("page", "digest").distinct().join(rest, "digest").groupBy("page").agg(F.collect_list("digest").alias("further"))
        )
        bits = sketch.counted(marks.select("page"), _first_halves, CELLS, least=1)
        shared = spark.sparkContext.broadcast(bits)

        @F.arrow_udf("binary")
        def key(url: pa.Array, html: pa.Array) -> pa.Array:
            return pa.array(map(_page_key, url.to_pylist(), html.to_pylist()), pa.binary())

        @F.arrow_udf("boolean")
        def may_have(url: pa.Array, html: pa.Array) -> pa.Array:
            keys = list(map(_page_key, url.to_pylist(), html.to_pylist()))
            return pa.array(shared.value.has(_halves(keys)))

        has = may_have("url", "html")
        joined = rows.where(has).withColumn("page", key("url", "html")).join(marks, "page", "left").drop("page")
        marked = rows.where(~has).withColumn("further", none).unionByName(joined)
    texts = marked.withColumn("text", cleared("html", "host", "further"))
    return texts.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


def _halves(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), np.uint64)[::2]


def _first_halves(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield _halves(batch.column(0).to_pylist())
