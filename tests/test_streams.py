"""Streams, the bucketed state and named tables."""

import datetime
import json
import re

import pytest
from helpers import rows
from pyspark.sql import functions as F

from shelfwise.operators import cdc
from shelfwise.operators.combine import BucketedTable
from shelfwise.plans import named_tables, pipeline
from shelfwise.settings import Settings
from shelfwise.sources import readers, schemas
from shelfwise.streaming.changes import RunTable, stream_changes
from shelfwise.streaming.landing import landed, load_landed, stream_landing

DAY = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC)


def change(i, hours, op="UPSERT", title="t"):
    return ("b", DAY, op, i, title, DAY + datetime.timedelta(hours=hours))


def add(spark, path, *changes):
    df = spark.createDataFrame(list(changes), "batch_run_id string, batch_run_ts timestamp, operation string, id string, title string, change_ts timestamp")
    schemas.conform(df, schemas.VARIANT_CHANGES).coalesce(1).write.mode("append").parquet(path)


def test_late_changes_are_not_sent(spark, tmp_path):
    log, sent = f"file://{tmp_path}/log", []

    def start(failed=0):
        sink = lambda put, gone: sent.append(sorted([*rows(put, "id", "title"), *((r[0], "-") for r in gone.collect())])) or failed
        stream_changes(spark, log, RunTable(spark, f"file://{tmp_path}/runs"), sink, f"file://{tmp_path}/c").awaitTermination()

    add(spark, log, change("a", 5, title="new"), change("a", 3, title="old"), change("b", 1))
    start()
    assert sent == [[("a", "new"), ("b", "t")]]
    add(spark, log, change("a", 4, title="late"), change("b", 2, "DELETE"), change("c", 1))  # a's is older than what was sent
    with pytest.raises(Exception, match="failed"):
        start(failed=1)
    start()
    assert sent[1:] == [[("b", "-"), ("c", "t")]] * 2  # what failed is sent again, from the state before
    add(spark, log, change("b", 1.5, title="late"), change("a", 6, title="newer"))
    start()
    assert sent[3:] == [[("a", "newer")]]
    add(spark, log, change("b", 2, "UPSERT", title="same time"))  # of two at one time UPSERT is the later
    start()
    assert sent[4:] == [[("b", "same time")]]


def product(i):
    return {"id": i, "title": f"P{i}", "handle": "h", "variants": [{"id": 10 * i, "price": "1"}, {"id": 10 * i + 1, "price": "2"}]}


def drop(tmp_path, name, body):
    (tmp_path / "raw/shop").mkdir(parents=True, exist_ok=True)
    (tmp_path / f"raw/shop/{name}.json").write_text(body)


@pytest.mark.parametrize("done", ["archive", "delete"])
def test_landing_folder(spark, tmp_path, done):
    s = Settings(raw_dir=f"file://{tmp_path}/raw", parsed_dir=f"file://{tmp_path}/p", table_dir=f"file://{tmp_path}/t", landing_done=done)
    start = lambda: stream_landing(spark, s, f"file://{tmp_path}/c", files_per_batch=2).awaitTermination()
    drop(tmp_path, "my__shop_1_20240101", json.dumps([product(1), product(2)]))
    drop(tmp_path, "my__shop_2_20240101", json.dumps({"products": [product(3)]}))
    drop(tmp_path, "my__shop_3_20240101", "<html>blocked</html>")
    start()
    assert rows(landed(spark, s, "Products"), "VariantId") == [(i,) for i in (10, 11, 20, 21, 30, 31)]
    assert rows(landed(spark, s, "ProductInfo"), "MainProductId", "Store") == [(i, "my.shop") for i in (1, 2, 3)]
    assert rows(landed(spark, s, "BadPages"), "n_chars", "snippet") == [(20, "<html>blocked</html>")]
    assert load_landed(spark, s) == {"ProductInfo": 3, "Products": 6, "BadPages": 1}
    drop(tmp_path, "my__shop_4_20240102", json.dumps([product(4)]))
    start()
    start()  # nothing new
    assert rows(landed(spark, s, "Products"), "VariantId") == [(i,) for i in (10, 11, 20, 21, 30, 31, 40, 41)]
    assert load_landed(spark, s) == {"ProductInfo": 1, "Products": 2, "BadPages": 0} and load_landed(spark, s)["Products"] == 0
    left = {p.name for p in (tmp_path / "raw/shop").glob("*.json")}
    assert len(left) < 4  # those of committed micro-batches went
    if done == "archive":
        assert {p.name for p in (tmp_path / "raw/archive").rglob("*.json")} | left == {f"my__shop_{i}_2024010{1 + (i > 3)}.json" for i in (1, 2, 3, 4)}


def test_any_json(spark, tmp_path):
    for name, body in {"a": '{"x": 1}', "b": "[1, 2]", "c": "{broken", "d": ""}.items():
        (tmp_path / f"{name}.json").write_text(body)
    got = readers.read_any_json(spark, f"file://{tmp_path}")
    assert rows(got.select(F.substring_index("source_file", "/", -1).alias("f"), F.col("value").isNull().alias("bad")), "f", "bad")[:3] == [("a.json", False), ("b.json", False), ("c.json", True)]
    assert got.where("value is not null").count() == 2


def exchanges(df):
    return re.findall(r"Exchange \w+\([^)]*\), (\w+)", df._jdf.queryExecution().executedPlan().toString())


def variants(spark, ids, tag):
    df = spark.createDataFrame([(i, f"{tag}{i}", f"h{tag}{i}") for i in ids], "id string, title string, row_hash string")
    return schemas.conform(df, schemas.VARIANT_STATE)


def test_bucketed_state_is_not_shuffled(spark, tmp_path):
    table = BucketedTable(spark, f"file://{tmp_path}/s", "id", 4)
    assert table.read(schemas.VARIANT_STATE).count() == 0
    table.publish(table.dealt(variants(spark, ["a", "b", "c"], "x")))
    old = table.read(schemas.VARIANT_STATE)
    assert rows(old, "id", "title") == [("a", "xa"), ("b", "xb"), ("c", "xc")]
    new = table.dealt(variants(spark, ["b", "c", "d"], "x").where("id <> 'c'").unionByName(variants(spark, ["c"], "y")))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        log = cdc.change_log(new, old, F.lit("b"), F.lit(DAY), F.lit(DAY))
        assert exchanges(log) == ["REPARTITION_BY_NUM"]  # the new side's own, once
        assert rows(log, "operation", "id") == [("DELETE", "a"), ("UPSERT", "c"), ("UPSERT", "d")]
        assert exchanges(cdc.upserts(new, old)) == ["REPARTITION_BY_NUM"]
        assert set(exchanges(cdc.merged(old, new, "id", "last_seen_at"))) == {"REPARTITION_BY_NUM"}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    table.publish(new)
    other = BucketedTable(spark, f"file://{tmp_path}/s", "id", 2)  # another number of buckets from here on
    assert rows(other.read(schemas.VARIANT_STATE), "id") == [("b",), ("c",), ("d",)]
    other.publish(other.dealt(variants(spark, ["e"], "z")))
    assert rows(table.read(schemas.VARIANT_STATE), "id") == [("e",)]
    (tmp_path / "s/v4b2").mkdir()  # not whole
    assert rows(other.read(schemas.VARIANT_STATE), "id") == [("e",)]


def test_named_tables(spark, tmp_path):
    log = "spark_catalog.shelf_test.VariantChanges"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS shelf_test LOCATION 'file://{tmp_path}/db'")
    tables = named_tables.NamedTables.beside(log, buckets=2)
    assert (tables.state, tables.runs) == ("spark_catalog.shelf_test.VariantState", "spark_catalog.shelf_test.IndexerRuns")
    for bad in ("a.b", "a.b.c.d", "a.b.c; DROP TABLE x", "a..c"):
        with pytest.raises(ValueError, match="catalog.schema.table"):
            named_tables.table_name(bad)
    try:
        tables.create(spark)
        spark.sql("DROP TABLE shelf_test.IndexerRuns")
        spark.sql("CREATE TABLE shelf_test.IndexerRuns (batch_run_id string, status string) USING parquet")
        tables.create(spark)  # adds what the run table of an earlier release lacks
        assert [f"{c} {t}" for c, t in spark.table(tables.runs).dtypes] == schemas.INDEX_RUNS.split(", ")
        assert named_tables.newest_batch(spark, log) is None
        variants(spark, ["a", "b", " "], "x").drop("last_seen_at").createOrReplaceTempView("hashed_now")
        named_tables.append_changes(spark, tables, "hashed_now", "b1", "2024-01-01 00:00:00")
        named_tables.replace_state(spark, tables, "hashed_now", "2024-01-01 00:00:00")
        variants(spark, ["b"], "x").unionByName(variants(spark, ["c"], "y")).drop("last_seen_at").createOrReplaceTempView("hashed_now")
        named_tables.append_changes(spark, tables, "hashed_now", "b2", "2024-01-02 00:00:00")
        named_tables.replace_state(spark, tables, "hashed_now", "2024-01-02 00:00:00")
        assert rows(spark.table(log), "batch_run_id", "operation", "id", "title") == [("b1", "UPSERT", "a", "xa"), ("b1", "UPSERT", "b", "xb"), ("b2", "DELETE", "a", None), ("b2", "UPSERT", "c", "yc")]
        assert rows(spark.table(tables.state), "id", "last_seen_at") == [("b", datetime.datetime(2024, 1, 2)), ("c", datetime.datetime(2024, 1, 2))]
        assert named_tables.newest_batch(spark, log) == "b2"
        assert [(r.id, r.operation) for r in named_tables.latest_changes(spark, log, "b2", ordered=True).collect()] == [("a", "DELETE"), ("c", "UPSERT")]
        with pytest.raises(ValueError, match="has batch"):
            named_tables.append_changes(spark, tables, "hashed_now", "b2", "2024-01-02 00:00:00")
    finally:
        spark.sql("DROP DATABASE IF EXISTS shelf_test CASCADE")


def test_state_buckets_of_a_run(spark, tmp_path):
    from test_flow import raw

    s = raw(tmp_path)
    import dataclasses

    s = dataclasses.replace(s, state_buckets=3)
    pipeline.run_all(spark, s, ("parse-shop", "parse-records", "load-shop", "load-records"))
    pipeline.process(spark, s, DAY)
    assert [p.name for p in (tmp_path / "tables/VariantState").iterdir()] == ["v1b3"]
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        pipeline.process(spark, s, DAY)
