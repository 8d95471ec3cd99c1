"""Every registered query against its SQL, and the shape of the plans."""

from __future__ import annotations

import os
import re

import pytest

import __spark_entry__ as contract
from catchframe.checks.compare import compare
from catchframe.checks.oracle import ORACLE
from catchframe.checks.queries import QUERIES

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no driver tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    assert compare(spark, SF, QUERIES[name], ORACLE[name]).startswith("ok")


def test_entry(spark):
    df = contract.entry(spark)
    assert df.count() > 0 and "discard_ratio" in df.columns


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"sectioned_report_scan", "skip_lines_scan", "schema_drift"}))
def test_plans_have_no_python_and_no_cross_join(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not re.search(r"Python|BatchEval|MapInPandas|CartesianProduct|BroadcastNestedLoopJoin", text)
    assert not re.search(r"windowspecdefinition\(0", text)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["year_spine"](spark, SF))
    schema = re.search(r"ReadSchema: struct<([^>]*l_[^>]*)>", text).group(1)
    assert "l_extendedprice" not in schema and "l_tax" not in schema
    assert "PartitionFilters: [isnotnull(year" in plan(QUERIES["table_sink"](spark, SF))


def test_detail_is_aggregated_once(spark):
    """The total row of the category table reuses the detail's exchange."""
    df = QUERIES["catch_category_table"](spark, SF)
    df.collect()
    final = plan(df).split("Initial Plan")[0]
    assert "ReusedExchange" in final
    assert len(re.findall(r"FileScan parquet \[l_", final)) == 1
