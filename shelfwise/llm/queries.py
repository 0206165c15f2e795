"""The queries of the operators in this package, as __spark_entry__ registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.llm import (
    chat_format, decontamination, hard_negatives, html_text, language_id, mixing, near_dedup, quality_rules, sharding, token_files, url_filter,
    vector_clusters, vector_topk,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Where the public tokenizer of that name lies on this machine and the executors."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards by the two-pass external shuffle, read back from the shards."""
    out = sharding.shard_documents(_table(spark, sf_dir, "documents"), n_shards=40)
    return out.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best other vectors of each whose vec_id is divisible by 20."""
    return vector_topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contaminated(docs, _table(spark, sf_dir, "benchmark").select("item_id", "text"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from those that aren't held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.learn(docs.where("doc_id is not null and not held_out"))
    return language_id.identify(docs.select("doc_id", "text", "held_out"), model).select("doc_id", "held_out", "lang_pred", "score")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document, and its source's size and target."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and checksum in the token files, from the files."""
    path = token_files.write_token_files(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_path())
    return token_files.token_index(spark, path)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The group of near-duplicates of each document, and whether it is the one that stays."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


#: The rules of op8.
URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/")]


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of all pages, with their hosts' trust and distrust."""
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages and its length."""
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract_main_text(pages).select("page_id", "url", "text", html_text.n_chars(F.col("text")).alias("n_chars"))


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations and of conversation -7, from the windows as written."""
    given = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "\\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit(text).alias("text"),
    )
    read = chat_format.read_windows(chat_format.write_and_read(given.unionByName(extra)))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = read.select(
        "conv_id", F.struct("window", said.alias("said"), F.array_join("loss", "").alias("loss")).alias("w"),
        F.size("turns").cast("long").alias("n"), "n_chars",
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.sum("n_chars").alias("formatted_chars"), F.array_sort(F.collect_list("w")).alias("w")
    )
    loss = F.array_join(F.col("w.loss"), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join(F.col("w.said"), ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document's text and the verdict of its language's and source's thresholds."""
    return quality_rules.quality(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines"
    )


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors in eight clusters after ten rounds."""
    return vector_clusters.clusters(_table(spark, sf_dir, "embeddings"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Negatives of the five positives of each vector whose vec_id is divisible by 50; some labels are moved first."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label)


OP2_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(embedding) > 0
), c AS (
  SELECT vec_id, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v
), s AS (
  SELECT q.vec_id AS query_id, d.vec_id AS vec_id, CAST(sum(q.x * d.x) AS BIGINT) AS score
  FROM c q JOIN c d ON q.i = d.i AND q.vec_id <> d.vec_id
  WHERE q.vec_id % 20 = 0 GROUP BY 1, 2
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""

OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS l FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(l[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, l, unnest(range(1, greatest(len(l) - 3, 2))) AS i FROM w WHERE len(l) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), e AS (
  SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * c >= 75 * (x.n + y.n - c)
), r AS (
  SELECT doc_id AS d, doc_id AS t FROM documents
  UNION
  SELECT r.d, z.b FROM r JOIN (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) z ON r.t = z.a
), c AS (
  SELECT d, min(t) AS component_id FROM r GROUP BY 1
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN c ON doc_id = d LEFT JOIN n USING (doc_id)
"""

#: Links to other hosts are absolute, and no html of the tables has a ://, so nothing spreads: a page without a rule has its
#: host's own shares. (Ranks over links are beyond SQL; a brute-force version holds them in the tests.)
OP8_SQL = r"""
WITH p AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM p
), v AS (
  SELECT *, CASE WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS own FROM r
), h AS (
  SELECT host, (1 - CAST(0.85 AS DOUBLE)) * avg(CASE WHEN own = 'allow' THEN 1.0 ELSE 0.0 END) AS trust,
    (1 - CAST(0.85 AS DOUBLE)) * avg(CASE WHEN own = 'block' THEN 1.0 ELSE 0.0 END) AS distrust
  FROM v WHERE host <> '' GROUP BY 1
)
SELECT page_id, v.host, path, rule, coalesce(own, CASE WHEN (coalesce(distrust, 0) - coalesce(trust, 0)) / (1 - CAST(0.85 AS DOUBLE)) >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
  coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM v LEFT JOIN h ON v.host = h.host
"""

#: Windows of 512 tokens with a history of 128, as format_windows() cuts them.
OP10_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), n AS (
  SELECT *, len(regexp_extract_all(text, '\S+')) + 4 AS tokens, row_number() OVER w AS i FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
), b AS (
  SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM n
), x AS (
  SELECT *, before // 512 AS span,
    4 + length(role) + (length(role) - length(replace(replace(replace(replace(role, chr(92), ''), '#', ''), '<', ''), ':', '')))
      + 2 + length(text) + (length(text) - length(replace(replace(replace(text, chr(92), ''), '#', ''), '<', ''))) + 8 AS size
  FROM b
), s AS (
  SELECT conv_id, span AS win, min(before) AS start FROM x GROUP BY 1, 2
), f AS (
  SELECT x.conv_id, sum(size) AS formatted_chars
  FROM x JOIN s ON x.conv_id = s.conv_id
    AND (x.span = s.win OR (x.i = 1 AND x.role = 'system' AND s.win > x.span)
      OR (NOT (x.i = 1 AND x.role = 'system') AND s.win = x.span + 1 AND s.start - x.before <= 128))
  GROUP BY 1
), g AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY i) AS said,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY i), '') AS loss
  FROM x GROUP BY 1
)
SELECT g.conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM g JOIN f ON g.conv_id = f.conv_id
"""


#: The base counts, the sketches (a bucket keeps a value's six leading bits), a group's weights with those of its language,
#: quartiles, thresholds and verdicts.
OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS place, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS l, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), g AS (
  SELECT place, i, l[i] AS a, l[i + 1] AS b, l[i + 2] AS c FROM (SELECT place, l, unnest(range(1, len(l) - 1)) AS i FROM w)
), r AS (
  SELECT place, count(DISTINCT i + k) AS n_repeat_words
  FROM (SELECT place, i, count(*) OVER (PARTITION BY place, a, b, c) AS n FROM g), (VALUES (0), (1), (2)) t(k) WHERE n > 1 GROUP BY 1
), s AS (
  SELECT place, doc_id, lang, source, len(l) AS n_words, coalesce(list_sum(list_transform(l, lambda x: length(x))), 0) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (place)
), b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM s
), m AS (
  SELECT place, lang, source, base_failed, unnest(['word_length', 'symbols', 'dup_lines', 'repeats']) AS rule, CAST(unnest([
    CASE WHEN n_words > 0 THEN 1000 * word_chars // n_words ELSE 0 END, CASE WHEN n_words > 0 THEN 1000000 * n_symbols // n_words ELSE 0 END,
    CASE WHEN n_lines > 0 THEN 1000000 * n_dup_lines // n_lines ELSE 0 END, CASE WHEN n_words > 0 THEN 1000000 * n_repeat_words // n_words ELSE 0 END]) AS BIGINT) AS v
  FROM b
), k AS (
  SELECT lang, source, rule, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS bucket, count(*) AS n
  FROM m WHERE NOT base_failed GROUP BY ALL
), kl AS (
  SELECT lang, rule, bucket, sum(n) AS m FROM k GROUP BY ALL
), nl AS (
  SELECT lang, rule, sum(m) AS n_lang FROM kl GROUP BY ALL
), gs AS (
  SELECT k.lang, source, k.rule, n_lang, sum(n) AS n_group FROM k JOIN nl ON k.lang IS NOT DISTINCT FROM nl.lang AND k.rule = nl.rule GROUP BY ALL
), u AS (
  SELECT gs.*, k.bucket, k.n * n_lang AS weight
  FROM k JOIN gs ON k.lang IS NOT DISTINCT FROM gs.lang AND k.source IS NOT DISTINCT FROM gs.source AND k.rule = gs.rule
  UNION ALL
  SELECT gs.*, kl.bucket, 100 * m FROM gs JOIN kl ON gs.lang IS NOT DISTINCT FROM kl.lang AND gs.rule = kl.rule
), c AS (
  SELECT lang, source, rule, bucket, n_lang * (n_group + 100) AS total, sum(sum(weight)) OVER (PARTITION BY lang, source, rule ORDER BY bucket) AS rank
  FROM u GROUP BY lang, source, rule, bucket, n_lang, n_group
), q AS (
  SELECT lang, source, rule, min(bucket) FILTER (4 * rank >= total) AS q1, min(bucket) FILTER (4 * rank >= 2 * total) AS q2,
    min(bucket) FILTER (4 * rank >= 3 * total) AS q3
  FROM c GROUP BY ALL
), t AS (
  SELECT q.lang, source, q.rule, q2 + 8 * greatest(q3 - q2, least) AS high, CASE WHEN two THEN q2 - 8 * greatest(q2 - q1, least) ELSE -1 END AS low
  FROM q JOIN (VALUES ('word_length', 250, true), ('symbols', 12500, false), ('dup_lines', 50000, false), ('repeats', 50000, false)) f(rule, least, two) ON q.rule = f.rule
), bad AS (
  SELECT DISTINCT place FROM m JOIN t ON m.lang IS NOT DISTINCT FROM t.lang AND m.source IS NOT DISTINCT FROM t.source AND m.rule = t.rule WHERE v > high OR v < low
)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND bad.place IS NULL AS kept, n_lines
FROM b LEFT JOIN bad USING (place)
"""


def _op12_sql(rounds: int = 10) -> str:
    """Each round in CTEs of its own; a centroid's and a vector's components are rows."""
    nearest = """
d{i} AS MATERIALIZED (
  SELECT p, cluster, distance FROM (
    SELECT x.p, c.cluster, CAST(sum((x.x - c.x) * (x.x - c.x)) AS BIGINT) AS distance,
      row_number() OVER (PARTITION BY x.p ORDER BY sum((x.x - c.x) * (x.x - c.x)), c.cluster) AS best
    FROM x JOIN c{i} c ON x.i = c.i GROUP BY x.p, c.cluster
  ) WHERE best = 1
)"""
    moved = """,
c{j} AS MATERIALIZED (
  SELECT c.cluster, c.i, coalesce(s.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT cluster, i, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x FROM d{i} JOIN x USING (p) GROUP BY cluster, i
  ) s ON c.cluster = s.cluster AND c.i = s.i
),"""
    steps = "".join(nearest.format(i=i) + moved.format(i=i, j=i + 1) for i in range(rounds)) + nearest.format(i=rounds)
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS p, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), x AS MATERIALIZED (
  SELECT p, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v
), f AS (
  SELECT p, e, row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), 'null')), e) - 1 AS cluster FROM v QUALIFY cluster < 8
), c0 AS MATERIALIZED (
  SELECT cluster, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM f
),{steps}, h AS (
  SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY 1
)
SELECT vec_id, CAST(cluster AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM v JOIN d{rounds} USING (p) JOIN h USING (cluster)
"""


OP13_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS p, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), c AS MATERIALIZED (
  SELECT p, vec_id, label, len(e) AS dim, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v
), s AS MATERIALIZED (
  SELECT a.p AS a, a.vec_id AS anchor_id, b.p AS b, b.vec_id AS vec_id, a.label = b.label AS same, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM c a JOIN c b ON a.i = b.i AND a.dim = b.dim AND a.p <> b.p WHERE a.vec_id % 50 = 0 GROUP BY ALL
), o AS (
  SELECT *, row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id, b) AS n FROM s WHERE same QUALIFY n <= 5
), r AS (
  SELECT o.a, o.n, o.anchor_id, o.vec_id AS positive_id, s.vec_id AS negative_id, o.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY o.a, o.n ORDER BY s.score DESC, s.vec_id, s.b) AS rank
  FROM o JOIN s ON o.a = s.a AND NOT s.same AND 50 * o.score <= 100 * s.score AND 100 * s.score <= 95 * o.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM r WHERE rank <= 3
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_sharding": op1_sharding,
        "op2_exact_topk": op2_exact_topk,
        "op3_decontamination": op3_decontamination,
        "op4_language_id": op4_language_id,
        "op5_source_mixing": op5_source_mixing,
        "op6_token_output": op6_token_output,
        "op7_near_dedup": op7_near_dedup,
        "op8_url_filter": op8_url_filter,
        "op9_html_extraction": op9_html_extraction,
        "op10_chat_format": op10_chat_format,
        "op11_quality_rules": op11_quality_rules,
        "op12_centroid_clusters": op12_centroid_clusters,
        "op13_hard_negatives": op13_hard_negatives,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_exact_topk": OP2_SQL, "op7_near_dedup": OP7_SQL, "op8_url_filter": OP8_SQL, "op10_chat_format": OP10_SQL, "op11_quality_rules": OP11_SQL,
        "op12_centroid_clusters": _op12_sql(), "op13_hard_negatives": OP13_SQL,
    }
