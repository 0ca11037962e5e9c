"""Exact and near copies of texts and vectors against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from savormap.llm import align, exact, near, vectors
from savormap.llm.common import prepared
from savormap.llm.components import components


def frame(spark, rows, columns="doc_id long, text string, digest string, rank string"):
    prepared(spark)
    return spark.createDataFrame([(*r, "d", "r")[: len(columns.split(","))] for r in rows], columns).repartition(5)


@pytest.fixture(scope="module")
def copies(spark):
    draw = random.Random(1)
    rows = [(n, draw.choice(["a", "b", "c" * 9_000, f"own {n}"])) for n in range(200)]
    rows += [(n, "hot") for n in range(300, 600)]
    rows += [(700, "tie"), (700, "tie"), (None, "null id"), (None, "null id"), (5, "null id"), (701, None), (702, ""), (700, "other")]
    return rows


@pytest.mark.parametrize("counters", [2, 4_096])
def test_exact_copies(spark, copies, counters):
    got = exact.copies(frame(spark, copies), counters).collect()
    groups = {}
    for doc_id, text in copies:
        groups.setdefault(text or "", []).append(doc_id)
    assert len(got) == len(copies)
    best = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    wanted = sorted((i, best[t], len(ids)) for t, ids in groups.items() for i in ids if i is not None)
    assert sorted((r["doc_id"], r["keep_id"], r["group_size"]) for r in got if r["doc_id"] is not None) == wanted
    assert sum(r["kept"] for r in got) == len(groups)


@pytest.mark.parametrize("counters", [2, 4_096])
def test_exact_survivors(spark, copies, counters):
    df = frame(spark, copies)
    kept = exact.without_copies(df, counters)
    assert kept.columns == df.columns
    texts = [r["text"] or "" for r in kept.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in copies})
    assert {r["doc_id"] for r in kept.where("text = 'hot'").collect()} == {599}


def test_frequent_digests_are_found(spark):
    rows = [(n, "hot" if n % 3 == 0 else f"t{n}") for n in range(3_000)]
    digests = frame(spark, rows).select(F.unhex(F.sha2("text", 256)).alias("digest"))
    found = exact.frequent(digests, 16).collect()
    assert len(found) <= 16
    assert digests.where("digest = unhex(sha2('hot', 256))").first()["digest"] in {r["digest"] for r in found}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(draw, words, edits):
    out = list(words)
    for _ in range(edits):
        at = draw.randrange(len(out) + 1)
        kind = draw.random()
        if kind < 0.5 and at < len(out):
            out[at] = f"n{draw.randrange(10**6)}"
        elif kind < 0.75:
            out.insert(at, f"n{draw.randrange(10**6)}")
        elif at < len(out):
            del out[at]
    return out


def test_alignment_is_the_edit_distance():
    draw = random.Random(2)
    for _ in range(1_500):
        a = [draw.randint(0, 5) for _ in range(draw.randint(0, 40))]
        b = [x for x in a if draw.random() > 0.2] + [draw.randint(0, 5) for _ in range(draw.randint(0, 6))]
        limit, true = draw.randint(0, 15), distance(a, b)
        got = align.banded_distance(a, b, limit)
        assert got == true if true <= limit else got > limit


def classes_by_force(rows, share):
    texts = sorted({t or "" for _, t in rows})
    label = {t: t for t in texts}

    def root(t):
        while label[t] != t:
            t = label[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = a.split(), b.split()
            if distance(x, y) <= (1 - share) * max(len(x), len(y)) + 1e-9 and root(a) != root(b):
                label[root(a)] = root(b)
    return {t: root(t) for t in texts}


def test_near_classes_are_those_of_all_pairs(spark):
    draw = random.Random(8)
    rows, n = [], 0
    for _ in range(12):
        words = [f"w{draw.randrange(10**6)}" for _ in range(draw.randint(60, 150))]
        for _ in range(draw.randint(1, 8)):
            rows.append((n, " ".join(changed(draw, words, draw.randint(0, len(words) // 10)))))
            n += 1
    passage = [f"p{k}" for k in range(40)]
    for _ in range(30):
        own = [f"o{draw.randrange(10**6)}" for _ in range(50)]
        rows.append((n, " ".join([*own[:25], *passage, *own[25:]])))
        n += 1
    rows += [(n + k, rows[0][1]) for k in range(40)]
    rows += [(900, None), (901, ""), (902, "  "), (903, "two words"), (None, "two words"), (904, "x " * 9_000), (905, "x " * 8_900)]
    df = frame(spark, rows)
    got = near.near_documents(df).collect()
    assert len(got) == len(rows)
    wanted = classes_by_force(rows[:-2], near.SIMILARITY)
    ids = {}
    for doc_id, text in rows[:-2]:
        if doc_id is not None:
            ids[wanted[text or ""]] = min(doc_id, ids.get(wanted[text or ""], doc_id))
    of = {doc_id: ids[wanted[text or ""]] for doc_id, text in rows[:-2] if doc_id is not None}
    of |= {904: 904, 905: 904}
    assert {r["doc_id"]: r["class_id"] for r in got if r["doc_id"] is not None} == of
    assert {r["doc_id"] for r in got if r["kept"]} == set(of.values())
    kept = near.without_near_copies(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(of.values()))


def test_cells_of_open_buckets_are_bounded_and_meet_every_pair_once(spark):
    prepared(spark)
    rows = [(7, n, n) for n in range(300)] + [(8, n, 500 + n % 5 * (n > 120)) for n in range(250)] + [(9, n, n % 3) for n in range(20)]
    known = spark.createDataFrame(rows, "key long, node long, class long").repartition(4)
    cells = {}
    for r in near.in_cells(near.still_open(known, block=32)).collect():
        cells.setdefault((r["bucket"], r["i"], r["j"]), []).append(r)
    assert max(map(len, cells.values())) <= 3 * 32  # two parts, whose sizes vary with the hash
    met = Counter()
    for (bucket, i, j), some in cells.items():
        for n, a in enumerate(some):
            for b in some[:n]:
                if {a["side"], b["side"]} == {i, j} and a["class"] != b["class"]:
                    met[bucket, *sorted((a["node"], b["node"]))] += 1
    wanted = {(k, m, n) for k, m, c in rows for key, n, d in rows if key == k and m < n and c != d}
    assert set(met) == wanted and set(met.values()) == {1}


def test_near_classes_within_a_large_open_bucket(spark, monkeypatch):
    monkeypatch.setattr(near.still_open, "__defaults__", (16,))
    draw = random.Random(5)
    shared = [f"p{k}" for k in range(60)]
    rows = []
    for n in range(100):
        own = [f"o{draw.randrange(10**6)}" for _ in range(40)]
        rows += [(2 * n, " ".join([*shared, *own])), (2 * n + 1, " ".join(changed(draw, [*shared, *own], 12)))][: 1 + (n % 3 == 0)]
    got = {r["doc_id"]: r["class_id"] for r in near.near_documents(frame(spark, rows)).collect()}
    assert got == {doc_id: doc_id - doc_id % 2 for doc_id, _ in rows}  # 60 of 100 words shared elsewhere


def replaced(draw, words, edits, even):
    at = range(4, len(words), 5) if even else draw.sample(range(len(words)), edits)
    return [f"n{draw.randrange(10**9)}" if n in set(at) else w for n, w in enumerate(words)]


def test_copies_at_the_threshold_meet():
    draw, kinds = random.Random(4), near.families(near.SIMILARITY)
    multipliers = np.random.default_rng(5).integers(0, 2**63, near.SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    hashes = near.WordHashes()
    for length in (5, 7, 10, 20, 50, 86, 100, 107, 125, 200, 400):
        for share, even in ((0.8, True), (0.8, False), (0.85, False), (0.9, False)):
            found = 0
            for _ in range(200):
                words = [f"w{draw.randrange(10**9)}" for _ in range(length)]
                other = replaced(draw, words, align.most_edits(length, length, share), even)
                for cut in range(align.most_edits(length, length, share) // 2 if not even else 0):
                    del other[other.index(next(w for w in other if w[0] == "n"))]
                pair = [np.fromiter(map(hashes.__getitem__, w), np.uint64) for w in (words, other)]
                one, two = (near.keys_of(w, multipliers, kinds) for w in pair)
                found += bool(set(one.tolist()) & set(two.tolist()))
            assert found >= 195, (length, share, even, found)


def test_every_fifth_word_changed_is_a_copy(spark):
    draw, rows = random.Random(6), []
    for n, length in enumerate([5, 10, 20, 50, 90, 105, 110, 130, 200]):
        words = [f"w{draw.randrange(10**9)}" for _ in range(length)]
        rows += [(2 * n, " ".join(words)), (2 * n + 1, " ".join(replaced(draw, words, 0, True)))]
    rows += [(100, "four words and more"), (101, "four words and")]
    got = {r["doc_id"]: r["class_id"] for r in near.near_documents(frame(spark, rows)).collect()}
    assert got == {d: d - d % 2 for d, _ in rows[:-2]} | {100: 100, 101: 101}


def test_near_of_few_rows(spark):
    assert near.near_documents(frame(spark, []).limit(0)).count() == 0
    got = near.near_documents(frame(spark, [(None, None), (None, None)])).collect()
    assert [r["class_id"] for r in got] == [None, None]


@pytest.mark.parametrize("block", [16, 1_024])
def test_vectors_against_all_pairs(spark, block):
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 64))
    rows = [c + draw.normal(scale=0.02 + 0.01 * k, size=64) for k, c in enumerate(np.repeat(centres, 4, axis=0)[:120] * 1.0)]
    rows = [centres[n % 40] + draw.normal(scale=0.16, size=64) for n in range(120)]
    rows += [centres[0] + draw.normal(scale=0.1, size=64) for _ in range(60)] + [rows[0]] * 5 + [rows[1] * 3]
    held = [(n, r.tolist()) for n, r in enumerate(rows)]
    odd = [(500, None), (501, [0.0] * 64), (502, [float("nan")] * 64), (503, [None] * 64), (504, [1.0] * 3), (505, [float("inf")] * 64), (None, rows[0].tolist())]
    prepared(spark)
    df = spark.createDataFrame(held + odd, "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: r for r in vectors.near_vectors(df, block=block).collect()}
    unit = np.array(rows) / np.linalg.norm(rows, axis=1)[:, None]
    links = unit @ unit.T >= 0.95
    np.fill_diagonal(links, False)
    found = np.array([got[n]["n_links"] for n in range(len(rows))])
    assert (found <= links.sum(axis=1)).all()
    assert found.sum() >= 0.98 * links.sum()
    label = np.arange(len(rows))
    for _ in range(len(rows)):
        label = np.minimum(label, np.where(links, label[None, :], len(rows)).min(axis=1, initial=len(rows)))
    assert np.mean([got[n]["component_id"] == label[n] for n in range(len(rows))]) > 0.97
    assert all(got[n]["n_links"] == 0 and got[n]["component_id"] == n and got[n]["kept"] for n in range(500, 506))
    assert (got[None]["n_links"], got[None]["component_id"], got[None]["kept"]) == (0, None, False)


@pytest.mark.parametrize("length", [8, 32, 64, 384])
@pytest.mark.parametrize("mean", [0.0, 0.5, 0.8, 0.9])
def test_links_meet_whatever_the_mean_and_length(mean, length):
    """Recall at the threshold on vectors the index has not seen, and buckets that stay balanced."""
    draw = np.random.default_rng(0)
    shared = np.zeros(length)
    shared[0] = np.sqrt(mean / (1 - mean)) * np.sqrt(length) / 8
    vecs = lambda n: vectors.units(draw.normal(size=(n, length)) / 8 + shared)
    index = vectors.learnt(vecs(2_000), 100_000, 0.95)
    one, pool = vecs(2_000), vecs(2_000)
    away = vectors.units((away := draw.normal(size=one.shape)) - (away * one).sum(axis=1, keepdims=True) * one)
    cosine = draw.uniform(0.95, 0.96, (len(one), 1))
    a, b = index.codes(one), index.codes(one * cosine + away * np.sqrt(1 - cosine**2))
    met = np.any([np.bitwise_count(x ^ y) <= 1 for x, y in zip(index.parts(a), index.parts(b), strict=True)], axis=0)
    within = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) <= index.radius
    assert (met & within).mean() >= 0.99
    ones = np.unpackbits(index.codes(pool)[:, 0].copy().view(np.uint8)).mean() * 64 / min(64, length)
    assert 0.4 < ones < 0.6
    largest = max(np.unique(k, return_counts=True)[1].max() for k in index.parts(index.codes(pool)))
    # Vectors nearly as close as the threshold anyway are compared in one bucket, exactly.
    assert not index.width or largest < len(pool) / 8
    assert index.width or mean >= 0.8 or length == 8


def test_vectors_of_two_lengths_link_among_themselves(spark):
    draw = np.random.default_rng(4)
    long, short = draw.normal(size=(30, 64)), draw.normal(size=(3, 2))
    rows = [(n, long[n % 30].tolist()) for n in range(40)] + [(100 + n, short[n % 3].tolist()) for n in range(7)] + [(200, [1.0])]
    df = prepared(spark).createDataFrame(
        [(*r, "mine", 1, b"d") for r in rows], "vec_id long, embedding array<double>, digest string, node int, vec binary"
    )
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_vectors(df).collect()}
    wanted = {}
    for n, v in rows:
        near = [
            m for m, w in rows
            if len(w) == len(v) and np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w) >= 0.95
        ]
        wanted[n] = (len(near) - 1, min(near), min(near) == n)
    assert got == wanted and wanted[100][0] > 0


def test_vectors_of_an_empty_table(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(n, n + 1) for n in range(30)] + [(100, n) for n in range(200, 260)] + [(7, 7), (31, 30), (300, 299)]
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    wanted = {n: 0 for n in range(1, 32)} | {n: 100 for n in range(200, 260)} | {300: 299}
    assert {r["id"]: r["component"] for r in found} == wanted
