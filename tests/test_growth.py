"""What keeps queries in proportion to their input: shuffles shared by both sides of a comparison, few columns in them, all tasks at work."""

import re

import pytest
from helpers import rows

from shelfwise.operators import snapshot
from shelfwise.plans import catalog
from shelfwise.sources import schemas
from shelfwise.sources.schemas import LOG_TYPES

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def plain(spark):
    """Plans as they run: not adaptive, and with no table small enough to be broadcast."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def moved_by(df, column):
    """The columns that each shuffle by a column moves, as DDL."""

    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    found = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]
    return [n.schema().toDDL() for n in found if f"hashpartitioning({column}#" in n.outputPartitioning().toString()]


COMPARED = ["cdc_full", "cdc_upserts", "cdc_deletes", "merge_keep"]


@pytest.mark.parametrize("name", COMPARED)
def test_both_sides_read_one_shuffle_of_the_snapshot(plain, name):
    plan = executed(catalog.queries()[name](plain, SF))
    assert len(re.findall(r"[+:]- Exchange hashpartitioning\(id#", plan)) == 1
    assert "ReusedExchange" in plan and plan.count("lineitem.parquet") == 2  # variants and their price bounds


NARROW = [*COMPARED, "merge_state", "snapshot_hashed"]


@pytest.mark.parametrize("name", NARROW)
def test_only_columns_of_the_result_move_with_the_hash(plain, name):
    plan = catalog.queries()[name](plain, SF)._jdf.queryExecution().optimizedPlan().toString()
    moved = re.findall(r"Aggregate \[id#\d+\], .*", plan)
    assert moved and not any("BodyHtml" in x or "max_by" in x for x in moved)


@pytest.mark.parametrize("name", ["cdc_upserts", "merge_keep", "snapshot_hashed", "variant_snapshot"])
def test_no_columns_of_parts_move_with_lineitems(plain, name):
    plain.conf.set("spark.sql.autoBroadcastJoinThreshold", "30000")  # parts are broadcast, price bounds are not
    df = catalog.queries()[name](plain, SF)
    moved = moved_by(df, "l_partkey")
    assert "BroadcastHashJoin" in executed(df) and any("l_orderkey" in x for x in moved)
    assert not any("p_name" in x for x in moved)


def test_deletes_move_no_titles(plain):
    moved = moved_by(catalog.queries()["cdc_deletes"](plain, SF), "id")
    assert len(moved) == 1 and "product_id" in moved[0] and "title" not in moved[0]


def test_hash_is_over_all_columns_whatever_is_kept(spark):
    cells = [("a", "t1", "b1"), ("a", "t1", "b2"), ("b", "t2", None)]
    df = spark.createDataFrame(cells, "id string, title string, BodyHtml string")
    df = schemas.conform(df, ", ".join(f"{c} {t}" for c, t in LOG_TYPES.items()))
    whole, some = snapshot.hashed(df), snapshot.hashed(df, ["title"])
    assert some.columns == ["id", "title", "row_hash"]
    assert rows(some) == rows(whole, "id", "title", "row_hash") and len({r[2] for r in rows(some)}) == 2
    one = [rows(snapshot.hashed(df.where(f"BodyHtml = '{b}'")), "row_hash")[0][0] for b in ("b1", "b2")]
    assert rows(some.where("id = 'a'"), "row_hash") == [(max(one),)]


@pytest.mark.parametrize("name", ["table_shop_rows", "option_shop_rows"])
def test_pages_made_of_a_small_file_are_parsed_by_all_tasks(spark, name):
    assert catalog.queries()[name](spark, SF).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
