"""Registered queries against their SQL, and the shape of their plans."""

import re

import pytest
from oracle_compare import compare, connect

from fieldbook.workbook.oracle import ORACLE
from fieldbook.workbook.queries import Desk, QUERIES, registered


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, con, sf_dir, name):
    problems = compare(spark, con, name, registered()[name], ORACLE[name], sf_dir)
    assert [p for p in problems if not p.startswith("note")] == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_pairing_of_everything(spark, sf_dir, name):
    text = plan_text(registered()[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "PythonUDF" not in text and "InPandas" not in text


def test_history_has_one_shuffle(spark, sf_dir):
    text = plan_text(Desk(spark, sf_dir).history)
    assert len(re.findall(r"\bExchange hashpartitioning", text)) == 1
    assert "SortAggregate" not in text and "Window" not in text and "Sort " not in text


def test_recoded_history_survives_without_broadcast(spark, sf_dir):
    """With broadcasts off, customers meet history in one shuffle per side and nothing is nested."""
    setting = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        name = "dashboard_all"
        assert compare(spark, connect(sf_dir), name, registered()[name], ORACLE[name], sf_dir) == []
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", setting)


def test_sql_is_written_without_the_package():
    """A wrong label or threshold in the package must not be shared by the SQL it is compared with."""
    import inspect

    from fieldbook.workbook import oracle

    assert not re.search(r"^\s*(from|import) fieldbook", inspect.getsource(oracle), re.M)


def test_names_are_normalised_once():
    from fieldbook.operators.permissions import PermissionRule

    assert PermissionRule("youth deer", "type", ("x",), parent="all deer") == PermissionRule("youth_deer", "type", ("x",), parent="all_deer")
