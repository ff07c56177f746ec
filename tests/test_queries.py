from __future__ import annotations

import pytest

from chronopix.queries import oracle_sql, queries
from tests.oracle import check, connect


@pytest.fixture(scope="module")
def con(request):
    return connect("/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_gives_what_its_sql_gives(spark, sf, con, name):
    check(queries()[name](spark, sf), con, oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_sql_gives_rows(spark, sf, name):
    assert queries()[name](spark, sf).count() > 0


def test_daily_discovery_over_the_whole_table(spark, sf, con):
    days = con.sql("SELECT count(DISTINCT (l_partkey, CAST(l_shipdate AS DATE))), count(DISTINCT CAST(l_shipdate AS DATE)) FROM lineitem").fetchall()[0]
    got = queries()["epochs_daily_discovery"](spark, sf)
    assert (got.count(), got.select("epoch_start").distinct().count()) == days


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_core_does_not_import_llm():
    import subprocess
    import sys

    code = "import sys, chronopix.queries, chronopix.__main__, chronopix.sinks.output, chronopix.streaming.incremental; assert not [m for m in sys.modules if m.startswith('chronopix.llm')]"
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)


def test_filters_and_columns_reach_the_scan(spark, sf):
    plan = queries()["epochs_single"](spark, sf)._jdf.queryExecution().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x or "Scan parquet" in x)
    assert "l_shipdate" in scan and "GreaterThanOrEqual(l_shipdate" in plan and "l_comment" not in scan and "l_extendedprice" not in scan.split("ReadSchema")[-1]
