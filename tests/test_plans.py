"""Plan properties of the registered queries: pruning, pushdown, shuffles, no Python."""

import os
import re

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                "FlatMapCoGroupsInPandas", "PythonUDF")


def physical(spark, name):
    df = entry.queries()[name](spark, SF)
    if df.isStreaming:
        return ""
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.catalog.QUERIES))
def test_no_python_in_plans(spark, name):
    plan = physical(spark, name)
    assert not any(node in plan for node in PYTHON_NODES), name


def test_survey_summary_one_stage_pruned(spark):
    plan = physical(spark, "survey_summary")
    assert "Exchange" not in plan
    read = re.search(r"FileScan parquet \[([^\]]*)\]", plan).group(1)
    for unused in ("l_orderkey", "l_returnflag", "l_linestatus", "l_shipdate"):
        assert unused not in read


def test_term_count_pushes_substring(spark):
    assert "StringContains(text," in physical(spark, "term_mentions")


def test_strict_pairs_scan_each_table_once(spark):
    plan = physical(spark, "qa_pairs")
    assert len(re.findall(r"FileScan parquet", plan)) == 2


def test_best_score_is_one_aggregate(spark):
    plan = physical(spark, "qa_best_score")
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_fused_ranking_scans_once(spark):
    plan = physical(spark, "term_rank_fused")
    assert len(re.findall(r"FileScan parquet", plan)) == 1
