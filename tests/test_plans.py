"""Physical plan checks: the shapes the design relies on."""

import re

import pytest

import __spark_entry__ as E
from riverflow.plans.catalog import QUERIES

from tests.conftest import SF_SMALL, plan_text

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF", "FlatMapCoGroupsInPandas", "AggregateInPandas")


@pytest.fixture(scope="module")
def plans(spark):
    qs = E.queries()
    return {name: plan_text(qs[name](spark, SF_SMALL)) for name in QUERIES}


def test_no_python_evaluation_anywhere(plans):
    for name, text in plans.items():
        assert not any(node in text for node in PYTHON_NODES), name


def test_latest_uses_window_group_limit(plans):
    text = plans["live_latest"]
    # partial limit before the shuffle, final limit after it
    assert len(re.findall(r"WindowGroupLimit \(", text)) >= 2


def test_six_quantiles_one_aggregate(plans):
    text = plans["hist_agg"]
    assert len(re.findall(r"percentile_approx\(", text.split("=====")[0])) >= 1
    calls = set(re.findall(r"percentile_approx\([^)]*\)", text))
    assert len(calls) == 1


def test_dedup_is_partial_then_final_aggregate(plans):
    text = plans["live_dedup"]
    assert text.count("HashAggregate (") >= 2
    assert "Exchange" in text


def test_filters_reach_the_scan(plans):
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(l_shipdate", plans["bbox_filter"])
    # only the columns the fixture needs are read
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double,l_linestatus:string," \
           "l_shipdate:timestamp_ntz>" in plans["bbox_filter"]


def test_top20_is_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["live_top20"]


def test_not_in_is_anti_join_with_existence_probes(plans):
    text = plans["not_in_files"]
    assert "LeftAnti" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_file_lists_do_not_shuffle_the_source(plans):
    for name in ("not_in_files", "load_new_files"):
        assert "BroadcastHashJoin LeftAnti" in plans[name], name
        assert "hashpartitioning(json_file" not in plans[name], name


def test_no_cross_joins(plans):
    for name, text in plans.items():
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name
