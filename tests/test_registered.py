"""Registered queries against their SQL oracles, and properties of their physical plans."""

from __future__ import annotations

import os
import re

import pytest
from compare import mismatch

import __spark_entry__ as driver

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
ORACLES = driver.oracle_sql()
QUERIES = driver.queries()

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_oracle(spark, name):
    assert mismatch(QUERIES[name](spark, FOLDER), ORACLES[name], FOLDER) is None


def test_entry_runs(spark):
    assert driver.entry(spark).count() == 1


# Representatives of every kind of plan: scans, windows, features, splits, rules, evaluation.
PLANS = [
    "scan_orders",
    "scan_order_lines",
    "user_timeline",
    "enriched_lines",
    "history_lines",
    "candidate_table",
    "tail_summary",
    "hist_user_orders",
    "recency_curve",
    "association_rules",
    "segment_features",
    "topk_baseline_eval",
    "threshold_eval",
    "row_metrics",
    "top_k_predictions",
    "numeric_describe",
]


def plan_of(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return re.split(r"\n", text.split("== Initial Plan ==")[0])


@pytest.fixture(params=["small", "large"])
def tables_of_size(spark, request):
    """Joins as for small tables, and as for tables too large to broadcast."""
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    if request.param == "large":
        for key in keys:
            spark.conf.set(key, "-1")
    yield request.param
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", PLANS)
def test_plans_hold_at_scale(spark, name, tables_of_size):
    lines = plan_of(QUERIES[name](spark, FOLDER))
    text = "\n".join(lines)
    if tables_of_size == "large":
        assert "BroadcastHashJoin" not in text or "_fine" in text  # block borders are a few numbers
    for banned in ("PythonUDF", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert banned not in text
    # Whatever meets in one partition has been reduced to partial aggregates (or block totals).
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = re.sub(r"^[\s:+\-*()\d|]*", "", lines[i + 1])
            assert "partial_" in below, line + "\n" + lines[i + 1]


def test_windows_on_a_customer_see_blocks_of_days(spark):
    text = "\n".join(plan_of(QUERIES["scan_orders"](spark, FOLDER)))
    alone = re.findall(r"Window \[[^\n]*\], \[user_id#\d+L?\], \[(\w+)#", text)
    assert alone and set(alone) == {"_block"}


def test_candidates_take_stored_product_features(spark):
    """A stored product table is joined once; small, it leaves the candidates where they are."""
    from basketloom.operators import features
    from basketloom.plans import registered
    from basketloom.sources import stage_for

    s = stage_for(spark, FOLDER)
    pairs = registered.pair_totals(s)
    stored = s.table("product_table", lambda: features.product_table(pairs, s.products))
    lines = plan_of(features.candidate_table(s.tables(), pairs=pairs, products=stored))
    assert not any("Exchange hashpartitioning(product_id" in line for line in lines)
    plain = features.candidate_table(s.tables(), pairs=pairs)
    with_stored = features.candidate_table(s.tables(), pairs=pairs, products=stored)
    assert with_stored.exceptAll(plain).isEmpty() and with_stored.count() == plain.count()


def test_filters_and_columns_reach_the_scan(spark):
    text = "\n".join(plan_of(QUERIES["labels"](spark, FOLDER)))
    assert "PushedFilters: [IsNotNull(eval_set), EqualTo(eval_set,train)" in text
    assert "order_dow" not in text and "add_to_cart_order" not in text


def test_per_key_limit_runs_before_the_exchange(spark):
    text = "\n".join(plan_of(QUERIES["top_k_predictions"](spark, FOLDER)))
    assert text.count("WindowGroupLimit") >= 2
