import pytest
from oracle import assert_same, connect

from shelfwise.plans import catalog

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    assert_same(catalog.queries()[name](spark, SF), con, catalog.oracle_sql()[name])


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_all_variants_have_a_document(spark):
    got = catalog.queries()["search_documents"](spark, SF).groupBy("store").count().collect()
    assert {r[0] for r in got} == {""} | {f"Shop{i}" for i in range(10)}
    assert sum(r[1] for r in got) == catalog.queries()["variant_snapshot"](spark, SF).count()
