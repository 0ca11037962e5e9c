"""Main text of pages, aligned tokens and hard negatives against plain versions of themselves."""

import hashlib
import random
import time
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from savormap.llm import align_tokens, extract, negatives
from savormap.llm.common import documents, prepared
from savormap.llm.markup import Page

SF = "/root/testdata/sf0.001"


# --- pages -------------------------------------------------------------------------------

MARKUP = {
    "<p>a<p>b<b>c<i>d</b>e</i><ul><li>x<li>y</ul>z": "a bcde x y z",
    "a < b &lt; c &amp;amp; &#x41;&nbsp;d<!-- x -->e<br>f": "a < b < c &amp; A de f",
    "<script>var a='<p>no</p>'</script>yes<style>p</style><textarea>t</textarea>!": "yes!",
    "<div title='a>b'>q</div><nav>m</nav><div id=sidebar>no</div><table><tr><td>1<td>2<tr><td>3</table>": "q 1 2 3",
    "<body><div class=wrap><nav>n</nav><article class=post><header><h1>T</h1></header><p>body <a href=x>link</a>s</p>"
    "<div class='share'>tw</div><section id=comments><article class=comment>bad</article></section></article>"
    "<aside>x</aside><p>outside</p></div>": "T body links",
    "<main><h2>m</h2>\n\t one　two</main><p>no</p>": "m one two",
    "<body class='has-sidebar'><p>kept<p hidden>gone<p role=alert>gone<p aria-hidden=true>gone": "kept",
    "": "", "<": "<", "<p": "", "<!--": "", "<!-->a": "a", "plain": "plain", "<html><body>a</html>b": "a b",
    "<p>x</span></p></div>y": "x y",
}


@pytest.mark.parametrize("html", MARKUP)
def test_text_of_markup(html):
    assert extract.Cleared(html).text() == MARKUP[html]


def test_odd_markup_takes_linear_time():
    begin = time.perf_counter()
    for html in (
        "<a>" + "<div>" * 50_000 + "</a>" * 50_000 + "x",
        "<ul><li><ul>" + "<div>" * 50_000 + "<li></li>" * 50_000,
        "<p a='" * 50_000, "<!--" * 50_000, "<" * 200_000, "<a " * 100_000, "<script>" * 50_000, "</x" * 50_000,
    ):
        page = extract.Cleared(html)
        page.candidates("h")
        page.text()
    assert time.perf_counter() - begin < 30


def test_digests_are_of_structure_and_text():
    one = Page("<ul class=a><li>x  y</li></ul><ul><li>x y</li></ul><ul><li>xy</li></ul>")
    digests, lists = one.digests(), [n for n, t in enumerate(one.tag) if t == "ul"]
    assert digests[lists[0]] == digests[lists[1]] != digests[lists[2]]


def _site(host: str, n: int, body: str, title: str | None = None):
    return f"https://{host}/p/{n}", f"<title>{title if title is not None else f'{host} {n}'}</title><body>{body}"


def site_pages():
    """Pages whose templates have no telling names, articles that recur, and odd rows."""
    pages = []
    for n in range(8):
        body = f"<div><p>Home</p><p>About us</p></div><p>Story {n} of many words.</p><div>Read also</div>"
        pages.append(_site("one.example.com", n, body))
    for n in range(8):  # the same blocks on few pages of another host are text
        body = f"<p>Tale {n}.</p>" + ("<div>Read also</div>" if n < 2 else "")
        pages.append(_site("two.example.com", n, body))
    for n in range(6):  # copies of an article are one page
        pages.append(_site("three.example.com", n, "<p>The same story.</p>", "same"))
    for n in range(5):  # a declared article's paragraphs are its text, a box in it is a template
        body = f"<article><h1>T{n}</h1><p>A line that recurs.</p><div><p>Follow us</p></div></article><p>loose {n}</p>"
        pages.append(_site("four.example.com", n, body))
    pages += [(None, "<div>Read also</div>"), ("no address", "<p>x</p>"), ("https://one.example.com/", None), (None, "")]
    return pages


def brute_texts(pages, fewest, share, many):
    """Main texts by counting in dictionaries."""
    titles, on, hosts = {}, {}, []
    for url, html in pages:
        host = url.split("/")[2].lower() if url and "//" in url else ""
        hosts.append(host)
        if host and html:
            page = extract.Cleared(html)
            context = page.page.title or html
            titles.setdefault(host, set()).add(context)
            for digest in page.candidates(host):
                on.setdefault((host, digest), set()).add(context)
    gone = {
        key for key, where in on.items()
        if len(where) >= fewest and (len(where) >= share * len(titles[key[0]]) or len(where) >= many)
    }
    out = []
    for host, (_, html) in zip(hosts, pages, strict=True):
        page = extract.Cleared(html or "")
        held = page.candidates(host)
        out.append(page.text(n for d, nodes in held.items() if (host, d) in gone for n in nodes))
    return out


@pytest.mark.parametrize("listed", [extract.LISTED, 1])
def test_templates_of_a_site_go(spark, listed):
    pages = site_pages()
    # Repeated rows and ids, null ids, and columns with names that the operator uses.
    rows = [(n if n % 5 else None, url, html, "mine", b"d") for n, (url, html) in enumerate(pages)] + [(3, *pages[3], "x", b"")] * 2
    table = spark.createDataFrame(rows, "page_id long, url string, html string, host string, page binary").repartition(3)
    got = extract.main_text(table, listed=listed)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    wanted = brute_texts([(r[1], r[2]) for r in rows], extract.FEWEST, extract.SHARE, extract.MANY)
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == sorted(((r[0], r[1], t, len(t)) for r, t in zip(rows, wanted, strict=True)), key=repr)
    texts = {t for _, _, t, _ in found}
    assert "Story 3 of many words." in texts and "Tale 1. Read also" in texts
    assert "The same story." in texts and "T2 A line that recurs." in texts and "Read also" in texts


def test_main_text_of_the_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in extract.main_text(pages).collect()}
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    wanted = brute_texts([r[1:] for r in rows], extract.FEWEST, extract.SHARE, extract.MANY)
    assert got == {r[0]: t for r, t in zip(rows, wanted, strict=True)}
    assert extract.main_text(pages.limit(0)).count() == 0


# --- tokens ------------------------------------------------------------------------------

ODD = [
    None, "", " ", "a  b\n\n", "▁x", "<|endoftext|> hey<s></s>", "\x00a", "é​漢字😀", " " * 3_000 + "x",
    "z" * 5_000, "<unk>", "<0x41>", "The same text.", "The same text.", "don't WE'LL  ½ ٣",
]


def brute_alignment(rows):
    """By the contract: ends of tokens in sets, counts in one dictionary."""
    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    other = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = align_tokens.encoding(align_tokens.FIRST)
    piece = lambda i: bytes([int(other.id_to_piece(i)[3:-1], 16)]) if other.is_byte(i) else other.id_to_piece(i).replace("▁", " ").encode()
    held, counts = [], Counter()
    for doc_id, text in rows:
        a = one.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = other.encode(text) if text else []
        sides = [letters.decode_single_token_bytes(i) for i in a], [piece(i) for i in b]
        if not text or any(b"".join(s) != f" {text}".encode() for s in sides):
            a, b, sides = [], [], ([], [])
        ends = [np.cumsum([len(x) for x in s]).tolist() for s in sides]
        at = {e: n for n, e in enumerate(ends[1])}
        links = [(a[n], b[at[e]]) for n, e in enumerate(ends[0]) if e in at]
        counts.update(links)
        groups, i, j = [], 0, 0
        for end in sorted(set(ends[0]) & set(ends[1])):
            x, y = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
            groups.append(",".join(map(str, a[i:x])) + "|" + ",".join(map(str, b[j:y])))
            i, j = x, y
        held.append((doc_id, a, b, links, groups))
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    return [
        (
            doc_id, len(a), len(b), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links),
            sum(counts[k] for k in links), hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "",
        )
        for doc_id, a, b, links, groups in held
    ]


@pytest.mark.parametrize("frequent", [align_tokens.FREQUENT, 5])
def test_alignment_is_that_of_the_contract(spark, frequent):
    texts = ODD + [r["text"] for r in documents(spark, SF).orderBy("doc_id").limit(60).collect()]
    rows = [(n if n % 7 else None, t) for n, t in enumerate(texts)] + [(3, "Again three.")]
    table = prepared(spark).createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, pair string, row int")
    got = align_tokens.alignment(table.repartition(3), frequent=frequent)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_alignment(rows), key=repr)


def test_overlaps_are_all_pairs_that_share_bytes():
    draw = random.Random(5)
    lengths = np.array([1, 2, 3, 5, 0])
    for _ in range(50):
        cuts = []
        for _side in range(2):
            ids, left = [], 20
            while left:
                ids.append(draw.choice([i for i in range(5) if lengths[i] <= left]))
                left -= int(lengths[ids[-1]])
            cuts.append([np.array(ids), np.zeros(0, np.int64), np.array(ids)])
        one, other = (align_tokens.Tokens(c, lengths) for c in cuts)
        a, b = align_tokens.overlaps(one, other)
        wanted = [
            (x, y) for x in range(len(one.ids)) for y in range(len(other.ids))
            if one.doc[x] == other.doc[y] and max(one.start[x], other.start[y]) < min(one.end[x], other.end[y])
        ]
        assert list(zip(a.tolist(), b.tolist(), strict=True)) == wanted


def test_alignment_of_no_documents(spark):
    assert align_tokens.alignment(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert {tuple(r)[1:] for r in align_tokens.alignment(nothing).collect()} == {(0, 0, 0, 0, 0, 0, "")}


# --- vectors -----------------------------------------------------------------------------


def brute_negatives(rows, every):
    """By the contract, in exact whole numbers; ``rows`` are (vec_id, vector, label)."""
    held = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        held.append((vec_id, [int(np.floor(256 * x)) for x in vector], label))
    out = []
    last = lambda i: (i is None, i or 0)
    for at, (anchor, vector, label) in enumerate(held):
        if anchor is None or anchor % every:
            continue
        scores = [
            (-sum(x * y for x, y in zip(vector, v, strict=True)), last(i), i, other == label)
            for n, (i, v, other) in enumerate(held) if n != at and len(v) == len(vector)
        ]
        scores.sort(key=lambda s: s[:2])
        for minus, _, positive, _ in [s for s in scores if s[3]][:5]:
            p = -minus
            kept = [s for s in scores if not s[3] and 80 * p <= 100 * -s[0] <= 100 * p][:5]
            out.extend((anchor, positive, n + 1, s[2], p, -s[0]) for n, s in enumerate(kept))
    return out


def _vectors(seed: int, count: int, length: int, spread: float):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(4, length))
    return (centres[draw.integers(0, 4, count)] + spread * draw.normal(size=(count, length))).astype(np.float32)


@pytest.mark.parametrize("blocks", [(negatives.ANCHOR_ROWS, negatives.ROWS), (3, 17)])
def test_negatives_are_those_of_brute_force(spark, blocks):
    rows = [(n, v.tolist(), int(n * 7 % 3)) for n, v in enumerate(_vectors(1, 150, 24, 0.3))]
    rows += [(1_000 + n, v.tolist(), n % 2) for n, v in enumerate(_vectors(2, 40, 5, 0.2))]  # another length
    rows += [(2_000 + n, rows[10][1], n % 2) for n in range(30)]  # ties
    rows += [(20, rows[3][1], 1), (20, rows[3][1], 1), (None, rows[30][1], 0), (None, rows[30][1], 2)]
    rows += [(3_000, None, 1), (3_010, [1.0, None], 1), (3_020, [float("nan")] * 24, 1), (3_030, [float("inf")] * 24, 1)]
    rows += [(3_040, rows[0][1], None), (3_050, [], 0), (3_051, [], 1), (3_052, [], 0), (3_060, [0.0] * 24, 1)]
    rows += [(4_000 + n, [1e9 + n, -1e9, 3e8], n % 2) for n in range(6)]  # products beyond 2**53
    table = spark.createDataFrame([(*r, "mine", 0) for r in rows], "vec_id long, embedding array<double>, label int, row string, score int")
    got = negatives.mined(table, F.col("label"), every=10, blocks=blocks)
    big = int(negatives._LIMIT / 3**0.5)
    clipped = [(i, v if v is None or len(v) != 3 else [max(-big, min(big, np.floor(256 * x))) / 256 for x in v], c) for i, v, c in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(brute_negatives(clipped, 10), key=repr)


def test_bounds_hold_and_leave_little_of_grouped_vectors():
    import pyarrow as pa

    def block(seed, spread):
        whole = np.floor(256 * _vectors(seed, 300, 64, spread)).astype(np.int64)
        return negatives.Block(
            pa.table(
                {"vec_id": np.arange(300), "row": np.arange(300), "label": np.arange(300) % 3, "length": np.full(300, 64),
                 "vec": pa.array([v.tobytes() for v in whole], pa.binary())}
            )
        )

    one, other = block(1, 0.1), block(1, 0.1)
    meeting = negatives.Meeting(one, slice(0, 256), other, slice(0, 300))
    exact = one.whole[:256] @ other.whole.T
    widths = []
    for level in range(len(negatives.LEVELS)):
        low, high = meeting.bounds(level)
        assert (low <= exact).all() and (exact <= high).all()
        widths.append((high - low).mean())
    assert widths[0] > widths[1]
    assert (meeting.bounds(0)[1] >= np.sort(exact, axis=1)[:, -6:-5]).mean() < 0.9


def test_negatives_of_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert negatives.mined(empty, F.col("label")).count() == 0
