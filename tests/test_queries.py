"""Every registered query against its SQL, and the plans that have to hold at scale."""

import os
import re

import pytest

import __spark_entry__ as entry_module
import oracle
from plans import exchanges, plan
from tablesync.plans import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def tables():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, tables, name):
    df = entry_module.queries()[name](spark, SF_DIR)
    assert oracle.compare(tables, df, entry_module.oracle_sql()[name]) == []


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name, column",
    [("window_exclusive_inclusive", "o_orderdate"), ("window_string_cursor", "o_orderpriority"), ("window_lower_inclusive", "l_shipdate")],
)
def test_window_reaches_the_scan(spark, name, column):
    text = plan(entry_module.queries()[name](spark, SF_DIR))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "GreaterThan" in pushed and column in pushed
    assert exchanges(text) == 0


def test_pruning_reaches_the_scan(spark):
    text = plan(entry_module.queries()["read_table_pruned"](spark, SF_DIR))
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in text


@pytest.mark.parametrize("name", ["redact_registered", "json_to_struct", "json_bad_rows", "nested_widen_float", "decimal_text_roundtrip"])
def test_row_functions_do_not_shuffle(spark, name):
    text = plan(entry_module.queries()[name](spark, SF_DIR))
    assert "Exchange" not in text and "Python" not in text


def test_no_query_runs_python_or_a_cross_join(spark):
    for name, query in entry_module.queries().items():
        if name not in REGISTRY or name.startswith(("sink", "stream", "write")):
            continue
        text = plan(query(spark, SF_DIR))
        assert not re.search(r"Python|InPandas|CartesianProduct|BroadcastNestedLoopJoin", text), name
