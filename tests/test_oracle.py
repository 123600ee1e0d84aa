"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from tidewater.plans.check import compare, duck_connection
from tidewater.plans.registry import ORACLE, QUERIES

from conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE.get(name), con)
    assert res["status"] in ("match", "rows-only"), res


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() > 0


ZONE_SENSITIVE = ["tumbling_sum", "day_offset_sum", "running_day_total", "event_time_tumbling",
                  "order_timeout_drain", "lateness_classes", "order_timeout_stream"]


@pytest.mark.parametrize("name", ZONE_SENSITIVE)
def test_results_do_not_depend_on_session_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        res = compare(spark, SF_SMALL, name, QUERIES[name], ORACLE.get(name), con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert res["status"] == "match", res
