"""Sharding, URL filter and chat formatting."""

import hashlib
import random
import zlib

import pytest
from conftest_helpers import plan_has_python, table
from pyspark.sql import functions as F

from shelfwise.llm import chat_format, queries, sharding, url_filter

SF = "/root/testdata/sf0.001"


def shards(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["shard"], []).append(r["slot"])
    return {k: sorted(v) for k, v in out.items()}


def check_shards(got, total, n):
    sizes = [len(got.get(s, [])) for s in range(n)]
    assert sum(sizes) == total and max(sizes) - min(sizes) <= 1
    assert all(v == list(range(len(v))) for v in got.values())


def test_sharding_edges(spark):
    rows = [(None, None), (None, None), (1, ""), (1, "é" * 5000), (2, "x")] * 3 + [(7, "same")] * 40
    df = spark.createDataFrame([(*r, 1, "s") for r in rows], "doc_id long, text string, shard int, Slot string")
    out = sharding.shard_documents(df, n_shards=7, bucket_bytes=100)
    assert out.columns == ["doc_id", "text", "shard_in", "Slot_in", "shard", "slot"]
    check_shards(shards(out), len(rows), 7)
    assert sorted(map(str, (r[:2] for r in out.collect()))) == sorted(map(str, rows))
    assert sharding.shard_documents(df.limit(0), n_shards=7).count() == 0


def test_sharding_is_a_seeded_shuffle(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")).repartition(3)
    a, b, c = (sharding.shard_documents(df, n_shards=4, seed=s, bucket_bytes=4000).orderBy("shard", "slot").collect() for s in (1, 1, 2))
    assert a == b != c
    ids = [r["doc_id"] for r in a]
    assert sorted(ids) == list(range(2000)) and sum(x < y for x, y in zip(ids, ids[1:])) < 1200


def test_op1(spark):
    got = queries.op1_sharding(spark, SF)
    docs = table(spark, SF, "documents").collect()
    check_shards(shards(got), len(docs), 40)
    want = sorted((d.doc_id, len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode()), "rows", None) for d in docs)
    assert sorted((r.doc_id, r.size, r.text_crc32, r.law, r.grown_shard) for r in got.collect()) == want


def test_shards_do_not_depend_on_how_files_are_cut(spark, tmp_path):
    table(spark, SF, "documents").unionByName(table(spark, SF, "documents")).repartition(3).write.parquet(f"file://{tmp_path}/d")
    found = []
    for n in (1, 16):
        spark.conf.set("spark.sql.files.minPartitionNum", n)
        found.append(sorted(map(tuple, sharding.shard_documents(spark.read.parquet(f"file://{tmp_path}/d"), n_shards=3).select("doc_id", "shard", "slot").collect())))
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert found[0] == found[1]


RULES = queries.URL_RULES


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        (None, "", "", None, "allow"), ("no scheme", "", "", None, "allow"), ("http://A.Com/x?q#f", "a.com", "/x", "com/", "allow"), ("x://com", "com", "", None, "allow"),
        ("https://b.Example.com/en/1", "b.example.com", "/en/1", "example.com/en/", "block"), ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), ("http://x.net/es/a", "x.net", "/es/a", "net/es/", "block"), ("http://x.net/esa", "x.net", "/esa", None, "allow"),
        ("http://É.com/a://b/?", "É.com", "/a://b/", "com/", "allow"), ("http://x.com#/y", "x.com", "", None, "allow"),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, None, "kept out")], "page_id long, url string, html string, verdict string")
    r = url_filter.filter_urls(pages, RULES).first()
    assert (r.host, r.path, r.rule, r.verdict) == (host, path, rule, verdict)


def brute_rule(host, path, rules):
    best = None
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    return best


@pytest.mark.parametrize("n", [40, 3000])
def test_rules_join_for_any_number(spark, n):
    """The join by suffix and start of path, which lists over MOST_LITERAL take, against plain Python; alike for short lists."""
    rng = random.Random(n)
    label = lambda: rng.choice(["a", "b", "www", "é", "x.", ""])
    host = lambda: ".".join([*(label() for _ in range(rng.randrange(3))), rng.choice(["com", "net", "org"])])
    path = lambda: "/".join(rng.choice(["e", "en", "é", "", "x y"]) for _ in range(rng.randrange(4)))
    rules = [(rng.choice(["allow", "block"]), rng.choice([f"{host()}/{path()}", host()])) for _ in range(n)]
    rules += [(v, f"h{i}.org/p/{i}") for i, (v, _) in enumerate(rules)]
    urls = [(i, rng.choice([f"http://{host()}/{path()}", f"http://{host()}", f"x://s.h{i}.org/p/{i}{path()}", None])) for i in range(300)] * 2
    pages = spark.createDataFrame([(*u, None) for u in urls], "page_id long, url string, html string")
    rows = pages.select("page_id", url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"))
    joined = url_filter.ruled(rows, url_filter.rule_table(spark, rules))
    found = joined.collect()
    assert len(found) == len(urls) and sum(r.r is not None for r in found) > 100
    assert all((tuple(r.r) if r.r else None) == brute_rule(r.host, r.path, rules) for r in found)
    whole = url_filter.filter_urls(pages, rules).collect()
    assert sorted((r.page_id, r.rule or "") for r in whole) == sorted((r.page_id, r.r.rule if r.r else "") for r in found)
    assert not plan_has_python(joined)
    assert url_filter.ruled(rows, url_filter.rule_table(spark, [])).where("r is not null").count() == 0
    assert url_filter.ruled(rows.limit(0), url_filter.rule_table(spark, rules)).count() == 0


def brute_ranks(seeds, edges, a):
    score = {h: (1 - a) * s for h, s in seeds.items()}
    for _ in range(300):
        new = {h: (1 - a) * s for h, s in seeds.items()}
        for (u, v), w in edges.items():
            if u in score:
                new[v] = new.get(v, 0) + a * score[u] * w
        score = new
    return score


def test_propagation_matches_brute_force(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.{t}" for i in range(12) for t in ("com", "net", "org")]
    pages, links = [], {}
    for i in range(200):
        src = rng.choice(hosts)
        to = [rng.choice(hosts) for _ in range(rng.randrange(4))]
        html = "".join(f"<a class=x href='{rng.choice(['http:', 'https:', ''])}//{t.upper()}/p'>l</a>" for t in to) + '<a href="/own">'
        pages.append((i, f"http://{src}/{rng.choice(['es', 'fr', 'en'])}/", html))
        for t in to:
            if t != src:
                links[src, t] = links.get((src, t), 0) + 1
    rows = url_filter.filter_urls(spark.createDataFrame(pages, "page_id long, url string, html string"), RULES, damping=0.5).collect()
    verdict = lambda h, p: "allow" if h.endswith(".com") else "block" if h.endswith(".net") and p in ("/es/", "/fr/") else None
    by_host = {}
    for _, u, _ in pages:
        h, _, p = u[7:].partition("/")
        by_host.setdefault(h, []).append(verdict(h, "/" + p))
    share = lambda v: {h: x.count(v) / len(x) for h, x in by_host.items() if v in x}
    out, into = {}, {}
    for (s, t), n in links.items():
        out[s], into[t] = out.get(s, 0) + n, into.get(t, 0) + n
    trust = brute_ranks(share("allow"), {(s, t): n / out[s] for (s, t), n in links.items()}, 0.5)
    distrust = brute_ranks(share("block"), {(t, s): n / into[t] for (s, t), n in links.items()}, 0.5)
    assert {r.verdict for r in rows if r.rule is None} == {"allow", "block"}
    for r in rows:
        assert abs(r.trust - trust.get(r.host, 0)) < 1e-4 and abs(r.distrust - distrust.get(r.host, 0)) < 1e-4
        bad = (r.distrust - r.trust) / 0.5 >= 0.5
        assert r.verdict == (verdict(r.host, r.path) or ("block" if bad else "allow"))
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string, html string"), RULES).count() == 0


def test_ranks_that_do_not_settle_are_an_error(spark):
    html = "<a href='http://a.net/'>a</a><a href='http://b.com/'>b</a>"
    pages = spark.createDataFrame([(1, "http://a.net/es/", html), (1, "http://a.net/es/", html), (2, "http://b.com/", html), (3, "http://c.org/" + "x" * 100_000, html)], "page_id long, url string, html string")
    with pytest.raises(RuntimeError, match="settle"):
        url_filter.filter_urls(pages, RULES, tolerance=1e-9, most_steps=2)
    got = url_filter.filter_urls(pages, RULES, tolerance=1e-3)
    assert [(r.page_id, len(r.path)) for r in got.orderBy("page_id").collect()] == [(1, 4), (1, 4), (2, 1), (3, 100_001)]


def test_chat_windows(spark):
    rng = random.Random(5)
    nasty = ["\\### Assistant: </turn> ok", "\\h\\\\l", "<</turn>\n### user: ", "", "a\\", "\\c: ", "é😀 \n", "### x: y</turn>\n"]
    given = []
    for c in [None, -1, 0, 1, 2, 3, 4, 5]:
        for t in range(rng.randrange(1, 25)):
            role = "system" if t == 0 and c in (1, 2, None) else rng.choice(["user", "assistant", "assistant", "tool: #1", None])
            given.append((c, t * 40, role, None if rng.random() < 0.1 else rng.choice(nasty) + " w" * rng.randrange(60), "x"))
    df = spark.createDataFrame(given, "conv_id long, turn long, role string, text string, window string").repartition(4)
    windows = chat_format.write_and_read(df, stride=100, history=40, chunk=64)
    read = chat_format.read_windows(windows).collect()
    for c in {g[0] for g in given}:
        mine = sorted((r for r in read if r.conv_id == c), key=lambda r: r.window)
        want = sorted(((t, r or "", x or "") for cc, t, r, x, _ in given if cc == c))
        assert [(t.role, t.text) for r in mine for t in r.turns] == [w[1:] for w in want]
        assert [x for r in mine for x in r.loss] == [w[2] for w in want if w[1] == "assistant"]
        if want[0][1] == "system" and len(mine) > 1:
            assert all(w.formatted.startswith("### system: ") for w in windows.where(F.col("conv_id").eqNullSafe(c)).collect())
    repeated = [r["n_repeated"] for r in windows.collect()]
    assert max(repeated) > 1
    assert chat_format.format_windows(df.limit(0)).count() == 0
    with pytest.raises(ValueError, match="history"):
        chat_format.format_windows(df, stride=1, history=2)


def test_op10_minus_seven(spark):
    r = queries.op10_chat_format(spark, SF).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert (r.n_turns, r.loss_chars) == (2, len(text))
    assert r.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert r.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()


def test_native_plans_have_no_python(spark):
    for q in (queries.op1_sharding, queries.op8_url_filter, queries.op10_chat_format):
        assert not plan_has_python(q(spark, SF))
