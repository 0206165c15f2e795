"""Quality rules, centroid clusters and hard negatives."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from conftest_helpers import table
from pyspark.sql import functions as F

from shelfwise.llm import hard_negatives, quality_rules, queries, vector_clusters

SF2 = "/root/testdata/sf0.01"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    found = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(found)]


def test_text_counts():
    rng = random.Random(1)
    texts = [None, "", " \t\n", "a", "a b c a b c", "x\n\nx\n x\nx ", "é# *\x0b<b>\x1cß|", "a b c d a b c", "a a a a a", "b\r\nb\r\nc"]
    texts += [" ".join(rng.choice("ab c\n#") for _ in range(rng.randint(0, 60))) for _ in range(300)] + ["a b " * 200_000]
    import pyarrow as pa

    got = quality_rules.text_counts(pa.array(texts))
    assert [list(x) for x in zip(*(g.tolist() for g in got), strict=True)] == [counts(t) for t in texts]
    assert [len(x) for x in quality_rules.text_counts(pa.array([], pa.string()))] == [0] * 6


def test_bucket(spark):
    values = [*range(300), 1000, 12_345, 999_999, 10**12 + 7]
    got = spark.createDataFrame([(v,) for v in values], "v long").select("v", quality_rules.bucket(F.col("v")).alias("b")).collect()
    for r in got:
        shift = max(r.v.bit_length() - 6, 0)
        assert r.b == r.v >> shift << shift and r.v - r.b <= r.v / 32


def prose(rng, n, extra=""):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 7))) + extra for _ in range(n))


def test_thresholds_follow_group(spark):
    """A source of marked-up prose keeps its symbols; the same text in a plain source goes. Junk goes everywhere."""
    rng = random.Random(2)
    rows = [(i, "en", "plain", prose(rng, 80)) for i in range(300)] + [(1000 + i, "en", "code", prose(rng, 80, "#")) for i in range(400)]
    rows += [(2000, "en", "plain", prose(rng, 80, "#")), (2001, "en", "code", prose(rng, 80, "###")), (2002, "en", "plain", (prose(rng, 3) + " ") * 40)]
    rows += [(3000, None, None, prose(rng, 60)), (3001, "en", "plain", None), (3002, "en", "plain", ""), (3003, "en", "plain", prose(rng, 49)), (3003, "en", "plain", prose(rng, 70))]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, lang string, source string, text string, n_words int")
    got = {}
    for r in quality_rules.quality(df).collect():
        got.setdefault(r.doc_id, []).append((r.kept, r.base_failed, r.broken))
    assert all(got[i] == [(True, False, [])] for i in [*range(300), *range(1000, 1400), 3000])
    assert got[2000] == [(False, False, ["symbols"])] and "symbols" in got[2001][0][2]
    assert got[2002][0][1] and all(got[i][0][:2] == (False, True) for i in (3001, 3002))
    assert sorted(x[:2] for x in got[3003]) == [(False, True), (True, False)]
    kept = quality_rules.good_documents(df)
    assert kept.columns == df.columns and {r[0] for r in kept.select("doc_id").collect()} == {i for i, g in got.items() if any(x[0] for x in g)}
    assert quality_rules.quality(df.limit(0)).count() == 0


def test_sketches_merge(spark):
    """Sketches of parts, merged in any order, are the sketch of all."""
    docs = table(spark, SF2, "documents").select("doc_id", "lang", "source", "text")
    whole = quality_rules.counted(docs).persist()
    parts = [whole.where(F.col("doc_id") % 3 == i) for i in range(3)]
    one = quality_rules.merged(*[quality_rules.sketch(p) for p in reversed(parts)])
    assert sorted(map(tuple, one.collect()), key=str) == sorted(map(tuple, quality_rules.sketch(whole).collect()), key=str)
    whole.unpersist()


def test_quality_against_labels(spark):
    """Documents of good quality that pass the base rules stay; bad ones go."""
    got = queries.op11_quality_rules(spark, SF2).join(table(spark, SF2, "labels"), "doc_id").groupBy("quality").agg(
        F.sum(F.expr("int(kept)")).alias("kept"), F.sum(F.expr("int(not base_failed)")).alias("passed")
    )
    got = {r.quality: (r.kept, r.passed) for r in got.collect()}
    assert got[1][0] >= 0.99 * got[1][1] and got[0][0] <= 0.05 * got[0][1]


def lloyd(vectors, k=8, rounds=10, scale=1024):
    """(row, cluster, distance) of each vector in plain Python, and the centroids."""
    whole = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in vectors]
    first = sorted(whole, key=lambda r: (hashlib.sha256(f"3:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in whole]
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(whole, own, strict=True) if o == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, near(v)[1], near(v)[0]) for i, v in whole], centroids


@pytest.mark.parametrize("big", [False, True])
def test_clusters_against_plain_python(spark, big):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 64)).round(2) * (1e4 if big else 1)
    given = [(i, base[i % 40].tolist()) for i in range(90)] + [(200 + i, base[7].tolist()) for i in range(60)] + [(5, base[3].tolist()), (None, base[2].tolist())]
    bad = [(300, None), (301, [1.0] * 63), (302, [*[1.0] * 63, None]), (303, [*[1.0] * 63, float("nan")]), (304, [*[1.0] * 63, float("-inf")]), (305, [])]
    df = spark.createDataFrame([(*g, 1) for g in given + bad], "vec_id long, embedding array<double>, cluster int").repartition(5)
    want, centroids = lloyd(given)
    got = vector_clusters.clusters(df).collect()
    assert sorted(((r.vec_id, r.cluster, r.distance) for r in got), key=str) == sorted(want, key=str)
    total = sum(d for _, _, d in want)
    for r in got:
        assert r.inertia == total and r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[r.cluster])).encode()).hexdigest()


def test_clusters_edges(spark):
    df = spark.createDataFrame([(1, [0.5] * 64), (2, [0.5] * 64)], "vec_id long, embedding array<float>")
    got = vector_clusters.clusters(df).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in got] == [(0, 0, 0)] * 2  # ties: the smaller of two equal centroids
    assert vector_clusters.clusters(df.limit(0)).count() == 0
    far = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64)], "vec_id long, embedding array<double>")
    assert [r.distance for r in vector_clusters.clusters(far, k=1).collect()] == [2**63 - 1] * 2  # the centroid is between them


def negatives(rows, picks, k=5, m=3, scale=256):
    whole = [(i, label, [int(np.floor(scale * x)) for x in v]) for i, label, v in rows]
    end = lambda s: min(max(s, -(2**63 - 1)), 2**63 - 1)
    out = []
    for a, (i, label, v) in enumerate(whole):
        if not picks(i):
            continue
        got = [(-end(sum(x * y for x, y in zip(v, w))), j, lab) for b, (j, lab, w) in enumerate(whole) if b != a and len(w) == len(v)]
        for s, j, _ in sorted(x for x in got if x[2] == label)[:k]:
            fit = sorted((t, n) for t, n, lab in got if lab != label and 50 * -s <= 100 * -t <= 95 * -s)[:m]
            out += [(i, j, r + 1, n, -s, -t) for r, (t, n) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("leaf,group", [(32, 4096), (3, 20)])
def test_negatives_against_plain_python(spark, monkeypatch, leaf, group):
    monkeypatch.setattr(hard_negatives, "LEAF", leaf)
    monkeypatch.setattr(hard_negatives, "GROUP", group)
    rng = np.random.default_rng(6)
    rows = []
    for i in range(400):
        label = int(rng.integers(4)) if i % 3 else 1  # a label that holds half of all rows
        v = rng.normal(size=6) * 0.3 + np.eye(6)[label]
        rows.append((i, label, np.round(v, 2).tolist()))
    rows += [(1000 + i, 1, [0.0, 1.0, 0.0, 0.0, 0.0, 0.0]) for i in range(60)]  # repeated vectors: ties
    rows += [(50, 2, rows[3][2]), (7, 1, rows[4][2]), (5000, 0, [1.0, 2.0]), (5001, 0, [1.0, 1.0]), (5002, 3, [0.5, 1.0])]
    bad = [(600, None, [1.0] * 6), (650, 1, None), (700, 1, [1.0] * 5 + [None]), (750, 1, [float("inf")] * 6), (800, 1, []), (None, 1, [1.0] * 6)]
    df = spark.createDataFrame([(*r, 0.5) for r in rows + bad], "vec_id long, label int, embedding array<double>, score double").repartition(3)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 50 == 0)
    want = negatives(rows, lambda i: i % 50 == 0)
    assert len(want) > 50 and sorted(map(tuple, got.collect())) == want
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_negatives_of_large_components(spark):
    rows = [(0, 1, [3e15, 1.0]), (1, 1, [3e15, -2.0]), (2, 2, [2e15, 5.0]), (3, 2, [1.0, 1.0]), (4, 1, [-1e9, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert sorted(map(tuple, hard_negatives.hard_negatives(df, F.col("vec_id") == 0).collect())) == negatives(rows, lambda i: i == 0)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") == 0).count() == 0
    assert hard_negatives.hard_negatives(df, F.lit(False)).count() == 0


def test_dual_tree_prunes_groups_of_anchors():
    """On clustered vectors most leaf pairs are never scored, and intervals hold what they say."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(40, 16)) * 100
    labels = np.repeat(np.arange(40), 100)
    m = np.floor(centres[labels] + rng.normal(size=(4000, 16)))
    rows = hard_negatives.Rows(np.arange(4000), labels, np.arange(4000), m)
    order = hard_negatives.tree_order(m, labels)
    c = hard_negatives.Rows(*(x[order] for x in rows))
    a = hard_negatives.Rows(*(x[::10] for x in c))
    least = hard_negatives._own_bounds(a, c, 5)
    wishes = hard_negatives.Wishes(np.arange(len(a.ids)), least, np.full(len(least), hard_negatives.MOST))
    a_tree, c_tree = (hard_negatives.tree(x.data, x.labels) for x in (a, c))
    wish, row, score, scored = hard_negatives.search(a, a_tree, c, c_tree, wishes, 5, True)
    assert scored < 0.15 * len(a_tree.low[0]) * len(c_tree.low[0])
    assert (score == (a.data[wish] * c.data[row]).sum(1)).all()
    for w in range(0, len(a.ids), 37):
        dots = c.data @ a.data[w]
        best = sorted((-dots[i], c.ids[i]) for i in range(4000) if c.labels[i] == a.labels[w] and c.places[i] != a.places[w])[:5]
        assert sorted((-s, c.ids[r]) for s, r in zip(score[wish == w], row[wish == w])) == best
    low, high = hard_negatives.interval(a_tree.low[0][0], a_tree.high[0][0], c_tree.low[2], c_tree.high[2])
    dots = a.data[: hard_negatives.LEAF] @ c.data.T
    for n in range(len(low)):
        part = dots[:, n * 4 * hard_negatives.LEAF : (n + 1) * 4 * hard_negatives.LEAF]
        assert low[n] <= part.min() and part.max() <= high[n]
