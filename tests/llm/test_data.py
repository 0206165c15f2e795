"""Top-k, mixing, token files and the pipeline."""

import os
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest_helpers import table
from oracle import assert_same, connect
from pyspark.sql import Observation
from pyspark.sql import functions as F
from test_text import brute_groups

import corpus_pipeline
from shelfwise.llm import decontamination, mixing, queries, rans, token_files, vector_topk
from shelfwise.llm.workspace import recorded, written

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_oracle(spark, name):
    assert_same(queries.queries()[name](spark, SF), connect(SF), queries.oracle_sql()[name])


def test_top_k_edges(spark):
    big = [3e15, -2e15]
    given = [
        (0, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 2.0]),
        (7, [-0.01, 0.0]), (8, []), (9, [5.0, 1.0, 1.0]), (10, [1.0, 1.0, 1.0]), (11, big), (12, big),
    ]
    df = spark.createDataFrame([(*g, 1) for g in given], "vec_id long, embedding array<double>, score int")
    got = [tuple(r) for r in vector_topk.top_k(df, F.col("vec_id").isin(0, 7, 10, 11, 3), k=3).orderBy("query_id", "rank").collect()]
    whole = lambda v: [int(np.floor(64 * x)) for x in v]
    valid = {i: whole(v) for i, v in given if i is not None and v and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in (0, 7, 10, 11):
        dots = [(min(max(sum(a * b for a, b in zip(valid[q], v)), -(2**63 - 1)), 2**63 - 1), i) for i, v in valid.items() if i != q and len(v) == len(valid[q])]
        want += [(q, r + 1, i, s) for r, (s, i) in enumerate(sorted(dots, key=lambda x: (-x[0], x[1]))[:3])]
    assert got == want
    assert vector_topk.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_top_k_prunes_rightly(spark, monkeypatch):
    monkeypatch.setattr(vector_topk, "BLOCK", 4)
    monkeypatch.setattr(vector_topk, "GROUP", 3)
    rng = np.random.default_rng(2)
    m = np.round(rng.normal(size=(300, 5)), 2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    whole = np.floor(64 * m).astype(int)
    got = {}
    for r in vector_topk.top_k(df, F.col("vec_id") % 20 == 0, k=7).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    for q, found in got.items():
        s = whole @ whole[q]
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-s[i], i))[:7]
        assert [found[k + 1] for k in range(7)] == [(i, s[i]) for i in best]
    assert len(got) == 15


def test_top_k_stops_at_the_kth_score():
    """On vectors in clusters, in their order, most blocks are never scored, and the result is that of all."""
    rng = np.random.default_rng(7)
    centres = 64 * rng.normal(size=(16, 24))
    m = np.floor(np.repeat(centres, vector_topk.BLOCK, 0) + 6 * rng.normal(size=(16 * vector_topk.BLOCK, 24)))
    cut = m.reshape(16, vector_topk.BLOCK, 24)
    asked = np.arange(0, len(m), 97)
    kept, scored = vector_topk.search_group(asked, m[asked], np.full(len(asked), -vector_topk.MOST), np.arange(len(m)), m, cut.min(1), cut.max(1), 20)
    assert scored < 0.4 * 16 * len(asked)
    for i, (names, found) in zip(asked, kept, strict=True):
        s = (m @ m[i]).astype(int)
        best = sorted((j for j in range(len(m)) if j != i), key=lambda j: (-s[j], j))[:20]
        assert names.tolist() == best and found.tolist() == s[best].tolist()


def test_top_k_sends_nothing_through_the_driver(spark, monkeypatch):
    """Batches of queries go to all slots: were that a join, the planner would take them for small and broadcast them all."""
    plans = []
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    monkeypatch.setattr(vector_topk, "written", lambda df, name: plan(df) or written(df, name))
    plan(queries.op2_exact_topk(spark, SF))
    assert not any("Broadcast" in p for p in plans)
    assert len(plans) == 5


def test_top_k_meets_each_dimension_in_one_pass(spark, monkeypatch):
    """Slots hold groups of several dimensions, and more slots than cores; the number of jobs doesn't grow with dimensions."""
    monkeypatch.setattr(vector_topk, "SLOT_BYTES", 200)
    tables = []
    monkeypatch.setattr(vector_topk, "written", lambda df, name: tables.append(name) or written(df, name))
    given = {i: [(i * j * 7) % 11 - 5 for j in range(1, 2 + i % 6)] for i in range(240)}
    df = spark.createDataFrame([(i, [x / 64 for x in v]) for i, v in given.items()], "vec_id long, embedding array<double>")
    want = []
    for q in range(0, 240, 20):
        dots = sorted((-sum(a * b for a, b in zip(given[q], v)), i) for i, v in given.items() if i != q and len(v) == len(given[q]))
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(dots[:5])]
    assert [tuple(r) for r in vector_topk.top_k(df, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect()] == want
    assert len(tables) == 4


@pytest.mark.parametrize("pool", [3, 1 << 20])
def test_search_of_copies_keeps_the_smallest_ids(monkeypatch, pool):
    monkeypatch.setattr(vector_topk, "POOL", pool)
    rng = np.random.default_rng(4)
    m = np.repeat(rng.integers(-9, 9, (6, 3)), 40, 0).astype(float)
    ids, cuts = rng.permutation(len(m)), np.append(np.arange(0, len(m), 7), len(m))
    low, high = (f.reduceat(m, cuts[:-1], 0) for f in (np.minimum, np.maximum))
    blocks, asked = vector_topk.Blocks(ids, m.astype(np.int16), low, high, cuts), np.arange(0, len(m), 11)
    for least in (np.full(len(asked), -vector_topk.MOST), vector_topk.first_scores(ids[asked], m[asked], blocks, 5)):
        who, name, score, _ = vector_topk.search(ids[asked], m[asked], least, blocks, 5)
        for n, i in enumerate(asked):
            s = (m @ m[i]).astype(int)
            best = sorted((j for j in range(len(m)) if j != i), key=lambda j: (-s[j], ids[j]))[:5]
            assert name[who == n].tolist() == ids[best].tolist() and score[who == n].tolist() == s[best].tolist()


def best_sum(sizes, counts, budget):
    sums = {0}
    for z, n in zip(sizes.tolist(), counts.tolist(), strict=True):
        sums = {s + z * k for s in sums for k in range(n + 1) if s + z * k <= budget}
    return max(sums)


def test_fit_budget_is_exact_where_it_can_be():
    rng = np.random.default_rng(3)
    for seed in range(8):
        for sizes, n, budget, want in (([40_000, 50_000], 5, 330_000, 330_000), ([50_000, 60_000, 70_000], 5, 110_000, 110_000)):
            z = np.array(sizes)
            assert (z * mixing.fit_budget(z, np.full(len(z), n), budget, seed)).sum() == want
    for _ in range(40):  # budgets beyond reach miss less than the smallest size that is left
        sizes = np.unique(rng.integers(1, 60, rng.integers(1, 6)))
        counts = rng.integers(1, 40, len(sizes))
        budget = int(rng.random() * (sizes * counts).sum())
        took = mixing.fit_budget(sizes, counts, budget, 1, reaches=(50, 100))
        miss = budget - (sizes * took).sum()
        assert (took >= 0).all() and (took <= counts).all() and 0 <= miss < min((z for z, t, c in zip(sizes, took, counts, strict=True) if t < c), default=1)
    for _ in range(60):
        sizes = np.unique(rng.integers(0, 50, rng.integers(1, 6)))
        counts = rng.integers(1, 4, len(sizes))
        budget = int(rng.random() * (sizes * counts).sum())
        took = mixing.fit_budget(sizes, counts, budget, 1)
        assert (took >= 0).all() and (took <= counts).all() and (sizes * took).sum() == best_sum(sizes, counts, budget)
    sizes, counts = np.arange(1, 2000), np.full(1999, 3)
    for budget in (1, 777, 10**5, 10**6, 5 * 10**6):
        assert (sizes * mixing.fit_budget(sizes, counts, budget, 1)).sum() == budget


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, left, open_ = dict.fromkeys(names, 0.0), float(sum(sizes.values())), list(names)
    while open_ and left > 1e-9:
        unit, left = left / sum(w[s] for s in open_), 0.0
        for s in list(open_):
            target[s] += unit * w[s]
            if target[s] >= cap * sizes[s]:
                left += target[s] - cap * sizes[s]
                target[s] = float(cap * sizes[s])
                open_.remove(s)
    return target


def check_mix(rows):
    """Rows of (source, size, source_size, target, taken)."""
    sizes = {}
    for s, z, *_ in rows:
        sizes[s] = sizes.get(s, 0) + z
    want = brute_targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for s, z, whole, target, t in rows:
        assert whole == sizes[s] and abs(target - want[s]) < 1e-6 * max(1, want[s])
        assert 0 <= t <= 3 * z and (t == 0 or t % z == 0)
        taken[s] += t
    return {s: taken[s] - want[s] for s in sizes}


def test_op5(spark):
    docs = table(spark, SF2, "documents").select("doc_id", "source", "text")
    got = queries.op5_source_mixing(spark, SF2)
    joined = got.join(docs, "doc_id").collect()
    white = re.compile(r"[^\x20\x09-\x0D]+")
    assert all(r.size == len(white.findall(r.text or "")) for r in joined)
    off = check_mix([(r.source, r.size, r.source_size, r.target, r.taken) for r in joined])
    assert max(map(abs, off.values())) <= 1
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, queries.op5_source_mixing(spark, SF2).collect()))


def test_mixing_edges(spark):
    given = [(1, "a b", None), (2, "a b c", "é"), (2, "a b c", "é"), (None, None, "z"), (3, "", "z"), (4, "x " * 500, "b")] + [(i, "w w w w", "hot") for i in range(100, 400)]
    docs = written(spark.createDataFrame([(*g, 1) for g in given], "doc_id long, text string, source string, size int").repartition(3), "t")
    mixed = mixing.mix_sources(docs, cell_rows=1)
    off = check_mix([(r.source, r.size, r.source_size, r.target, r.taken) for r in mixed.collect()])
    assert all(abs(x) <= 4 for s, x in off.items() if s != "b")
    again = mixing.mixed_documents(docs, cell_rows=1)
    assert again.columns == docs.columns
    assert again.count() == mixed.agg(F.sum("repeats")).first()[0]
    assert mixing.mix_sources(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.repartition(2)).columns == docs.columns


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 5000, 300_000])
def test_rans_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 60_000).astype(np.uint32)
    t = rans.Table.of(ids)
    block = t.encode(ids, 32)
    assert (t.decode(block, n, 32) == ids).all()
    assert int(t.freqs.sum()) == 1 << rans.bits_for(len(t.symbols))


def test_rans_many_symbols_and_damage():
    ids = np.random.default_rng(1).permutation(np.arange(50_000, dtype=np.uint32))
    data = token_files.pack([None, 5, 7], [ids, np.array([], np.uint32), np.array([0], np.uint32)])
    names, back = token_files.unpack(data)
    assert names == [None, 5, 7] and (back[0] == ids).all() and list(map(len, back)) == [50_000, 0, 1]
    for at in (len(data) // 2, len(data) - 1, 60):
        with pytest.raises(Exception, match="damaged|decompress|incorrect|invalid"):
            token_files.unpack(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])


def brute_ids(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(queries.tokenizer_path())
    return [[*e.ids, 0] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_words_are_encoded_once_while_they_fit(monkeypatch):
    import tokenizers

    plain = tokenizers.Tokenizer.from_file(queries.tokenizer_path())
    rng = random.Random(7)
    words = ["".join(rng.choices("aeioustrné", k=7)) + rng.choice(["", ".", "),", "\nNo", "'s"]) for _ in range(20_000)]
    texts = [" ".join(words[i : i + 500]) for i in range(0, len(words), 500)]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    for most, again in ((2 << 20, False), (1 << 14, True)):
        tokens = token_files.Tokens(queries.tokenizer_path(), most=most)
        asked: list[str] = []
        for r in range(2):
            got = [x.tolist() for t in range(0, len(texts), 10) for x in tokens.encode(texts[t : t + 10])]
            assert got == want
            if not r:
                plainly = tokens._ids
                monkeypatch.setattr(tokens, "_ids", lambda x: asked.extend(x) or plainly(x))
        assert (sum(map(len, asked)) > 10_000) == again


def test_token_files_match_the_tokenizer(spark, tmp_path):
    rng = random.Random(6)
    odd = ["", " ", "  a  ", "a\n b", "it's, 'x' won't.", "x<|endoftext|> y <|endoftext|>", "é\x1c z", "\x85 q", "a\u0301., b", "3., 4%", "\u3000 \u2003x", "😀 😀", "a\tb  \n c", "q. "]
    texts = odd + [" ".join(rng.choice([*odd, "the", "thing,", "other"]) for _ in range(rng.randrange(200))) for _ in range(60)] + [None, "long word " * 30_000]
    ids = [None, None, 5, 5, *range(100, 100 + len(texts) - 4)]
    df = spark.createDataFrame([(i, t, 1) for i, t in zip(ids, texts, strict=True)], "doc_id long, text string, n_tokens int").repartition(4)
    path = token_files.write_token_files(df, queries.tokenizer_path(), segment_tokens=1000, path=f"file://{tmp_path}/t")
    got = token_files.token_index(spark, path).orderBy("start").collect()
    assert len(got) == len(texts)
    want = sorted((i is not None, i or 0, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in zip(ids, brute_ids([t or "" for t in texts]), strict=True))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.concatenate(([0], np.cumsum([r.n_tokens for r in got])[:-1])).tolist()
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    empty = token_files.write_token_files(df.limit(0), queries.tokenizer_path(), path=f"file://{tmp_path}/e")
    assert token_files.token_index(spark, empty).count() == 0


def test_a_stage_deletes_what_the_one_before_wrote_for_itself(spark):
    stages, docs = dict(corpus_pipeline.STAGES), table(spark, SF, "documents")
    with recorded() as made:
        mixed = stages["source_mixing"](spark, docs, SF)
    there = lambda: [os.path.exists(t.written_to.removeprefix("file://")) for t in made]
    assert made and all(there())
    now = written(mixed, "t")
    lazily = stages["decontamination"](spark, mixed, SF).count()  # its docs read what the mix wrote
    assert any(there())
    assert stages["decontamination"](spark, now, SF).count() == lazily > 0
    assert not any(there())


def test_pipeline(spark):
    """Each stage on what the one before kept, against plain Python over the same rows."""
    docs = table(spark, SF2, "documents")
    extra = [(10**6, "12 34 !!", "en", "src0", 8), (10**6 + 1, None, None, None, None), (10**6 + 2, "ქართული ენა", None, "src0", 11)]
    now, kept = written(docs.unionByName(spark.createDataFrame(extra, docs.schema)), "t"), {}
    for name, stage in corpus_pipeline.STAGES:
        now = written(stage(spark, now, SF2), "t")
        kept[name] = now.collect()
        if name != "token_output":
            assert now.columns == docs.columns
    rows = sorted((r.doc_id, r.text) for r in [*docs.collect(), *(r for r in docs.sparkSession.createDataFrame(extra, docs.schema).collect() if r.text)])
    rows = [(d, t) for d, t in rows if any(map(str.isalpha, t or ""))]
    assert sorted(r.doc_id for r in kept["language_id"]) == [d for d, _ in rows] and rows[-1][0] == 10**6 + 2
    rows = [(d, t) for (d, t), (_, _, least) in zip(rows, brute_groups(rows), strict=True) if d == least]
    assert sorted(r.doc_id for r in kept["near_dedup"]) == [d for d, _ in rows] and len(rows) < len(kept["language_id"])
    words = lambda t: " ".join("".join(c if c.isalnum() else " " for c in (t or "").lower()).split())
    items = [words(r.text) for r in table(spark, SF2, "benchmark").collect()]
    rows = {d: t for d, t in rows if not any(f" {x} " in f" {words(t)} " for x in items)}
    assert {r.doc_id for r in kept["decontamination"]} == set(rows) and len(rows) < len(kept["near_dedup"])
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    repeats = Counter(r.doc_id for r in kept["source_mixing"])
    wholes, taken = {}, Counter()
    for r in kept["decontamination"]:
        wholes.setdefault(r.source, []).append(size(r.text))
    want = brute_targets({s: sum(z) for s, z in wholes.items()})
    for r in kept["source_mixing"]:
        assert r.text == rows[r.doc_id]
        taken[r.source] += size(r.text)
    for s, z in wholes.items():  # whole passes, and the best sum of some documents once more
        passes = int((want[s] + 1e-6) // sum(z))
        assert taken[s] == passes * sum(z) + best_sum(np.array(z), np.ones(len(z), int), round(want[s]) - passes * sum(z))
    assert max(repeats.values()) <= 3
    mixed = sorted((r.doc_id, r.text) for r in kept["source_mixing"])
    start = 0
    for (d, t), ids, r in zip(mixed, brute_ids([t for _, t in mixed]), sorted(kept["token_output"], key=lambda r: r.start), strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_pipeline_languages(spark, monkeypatch):
    docs = spark.createDataFrame(
        [(1, "the cat sat on the mat", "en", 1), (2, "der Hund und die Katze", "de", 2), (3, "the dog", None, 3), (4, "7", "en", 4), (5, None, "de", 5), (None, "und der", None, 6)],
        "doc_id long, text string, lang string, `a.b` int",
    )
    for wanted, want, gone in ((None, [1, 2, 3, 6], (2, 0)), (frozenset(["en"]), [1, 3], (2, 2)), (frozenset(["xx"]), [], (2, 4))):
        monkeypatch.setattr(corpus_pipeline, "LANGUAGES", wanted)
        counts = Observation("t")
        got = corpus_pipeline.identify_language(spark, docs, SF, counts)
        assert got.columns == docs.columns
        assert sorted(r["a.b"] for r in got.collect()) == want
        assert (counts.get["no_letter"], counts.get["other_language"]) == gone
    assert corpus_pipeline.identify_language(spark, docs.withColumn("lang", F.lit(None).cast("string")), SF).count() == 0
    counts = Observation("empty")
    assert corpus_pipeline.identify_language(spark, written(docs.limit(0), "t"), SF, counts).collect() == []
    assert counts.get == {"no_letter": 0, "other_language": 0}


def test_results_do_not_depend_on_how_files_are_cut(spark, tmp_path):
    """The number of splits changes from read to read, as with executors that come and go between the steps."""
    table(spark, SF, "documents").unionByName(table(spark, SF, "documents").limit(60)).repartition(3).write.parquet(f"file://{tmp_path}/d")
    items = table(spark, SF, "benchmark")
    found = []
    for n in (1, 16):
        docs = spark.read.parquet(f"file://{tmp_path}/d")
        spark.conf.set("spark.sql.files.minPartitionNum", n)
        near = corpus_pipeline.remove_near_duplicates(spark, docs, SF)
        spark.conf.set("spark.sql.files.minPartitionNum", 17 - n)
        clean = decontamination.without_contaminated(docs, items)
        mixed = mixing.mixed_documents(docs)
        found.append([sorted((r.doc_id, zlib.crc32((r.text or "").encode())) for r in df.collect()) for df in (near, clean, mixed)])
    spark.conf.unset("spark.sql.files.minPartitionNum")
    assert found[0] == found[1] and all(found[0])


def test_tables_of_a_stage_go_once_its_result_is_written(spark, monkeypatch):
    made = []

    def doubled(spark, docs, sf_dir, **options):
        made.append(written(docs.limit(5), "own"))
        return made[-1].union(made[-1])

    last = lambda spark, docs, sf_dir: docs
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("a", lambda spark, docs, sf_dir, rejected: doubled(spark, docs, sf_dir).observe(rejected, F.count(F.lit(1)).alias("n"))), ("b", doubled), ("c", last)])
    assert corpus_pipeline.run(spark, SF).count() == 10
    fs = spark._jvm.org.apache.hadoop.fs.Path(made[0].written_to).getFileSystem(spark._jsc.hadoopConfiguration())
    assert len(made) == 2 and not any(fs.exists(spark._jvm.org.apache.hadoop.fs.Path(t.written_to)) for t in made)
