"""Every registered query beside its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry_points
import check

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.connect(SF_DIR)


# Optional queries have tests of their own.
OPTIONAL = {"pipeline", *(entry_points.llm_queries.queries() if entry_points.llm_queries else ())}
OWN = [name for name in entry_points.queries() if name not in OPTIONAL]


@pytest.mark.parametrize("name", OWN)
def test_query_equals_its_sql(spark, duck, name):
    assert name in entry_points.oracle_sql()
    assert check.compare(spark, duck, SF_DIR, name) == ""


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["name", "image", "send_freq"]
    assert df.count() == entry_points.TOP_N


def test_day_filter_reaches_the_scan(spark):
    df = entry_points.queries()["top_senders"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan
