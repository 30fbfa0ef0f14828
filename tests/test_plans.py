"""The three end-to-end paths on the small hand-made tables."""

from __future__ import annotations

import threading
from dataclasses import replace

import pytest

from basketloom.plans.profile_report import profile_report
from basketloom.plans.segmentation import segments_and_bundles
from basketloom.sources import Stage
from basketloom.sources.staging import fingerprint


def test_profile_report(tables, spark):
    report = profile_report(tables, Stage(spark, "profile"))
    assert len(report) == 32
    counts = {
        name: report[name].count()
        for name in ("missing_report", "tails", "recency_curve", "coverage", "hist_gap_days")
    }
    assert counts == {
        "missing_report": 6,
        "tails": 5,
        "recency_curve": 9,
        "coverage": 6,
        "hist_gap_days": 31,
    }


def test_segments_and_bundles(spark):
    from basketloom.schemas import AISLES, DEPARTMENTS, LINES, ORDERS, PRODUCTS, Tables

    orders, lines = [], []
    for user in range(24):
        for number in range(1, 4):
            order = user * 10 + number
            orders.append((order, user, "prior", number, 0, 0, None if number == 1 else float(user % 4 * 9)))
            lines += [(order, p, p, 0) for p in range(1, 3 + user % 4)]
    make = spark.createDataFrame
    tables = Tables(
        make(orders, ORDERS),
        make(lines, LINES),
        make([], LINES),
        make([(p, f"p{p}", p, 1) for p in range(1, 7)], PRODUCTS),
        make([(p, f"a{p}") for p in range(1, 7)], AISLES),
        make([(1, "d")], DEPARTMENTS),
    )
    got = segments_and_bundles(tables, Stage(spark, "segments"), k=2, restarts=2, min_lift=0.9)
    assert got["elbow"].count() == 8
    assert sum(r.n_users for r in got["profile"].collect()) == 24
    assert got["edges"].count() == got["bundle_pair_count"].collect()[0].n_pairs > 0
    shares = got["cross_sell"].collect()
    assert {r.segment for r in shares} == {0, 1} and all(0 < r.share <= 1 for r in shares)


@pytest.mark.parametrize("blend", [True])
def test_next_order_path(spark, blend):
    from basketloom.plans.next_order import predict_next_orders
    from basketloom.sources import read_warehouse

    tables = read_warehouse(spark, "/root/testdata/sf0.001")
    got = predict_next_orders(
        tables, Stage(spark, "next"), names=("logistic", "boosted_c"), rounds=2, with_blend=blend
    )
    metrics = {r.model: r for r in got["row_metrics"].collect()}
    assert set(metrics) == {"logistic", "boosted_c", "blend"}
    assert all(0 <= r.auc <= 1 and r.ece >= 0 and r.log_loss > 0 for r in metrics.values())
    methods = [r.method for r in got["summary"].collect()]
    assert sorted(methods) == ["baseline top-11", "blend top-11", "boosted_c top-11", "logistic top-11"]


def test_fingerprint_tells_tables_apart(tables):
    fewer = replace(tables, orders=tables.orders.where("user_id < 3"))
    assert fingerprint(tables) == fingerprint(replace(tables))
    assert fingerprint(tables) != fingerprint(fewer)


def test_models_are_fitted_side_by_side(tables, spark, monkeypatch):
    # They were fitted one after the other, each in short jobs that leave cores idle.
    from basketloom.plans import next_order

    names = next_order.DEFAULT_MODELS
    meeting = threading.Barrier(len(names))

    def fitted(tables, stage, name, *args):
        meeting.wait(60)
        return name

    monkeypatch.setattr(next_order, "staged_scores", fitted)
    with Stage(spark, "together") as stage:
        found = next_order.fitted_together(tables, stage, names, None, False)
    assert list(found.items()) == [(name, name) for name in names]

    def failing(tables, stage, name, *args):
        raise ValueError(name)

    monkeypatch.setattr(next_order, "staged_scores", failing)
    with Stage(spark, "failing") as stage, pytest.raises(ValueError, match=names[0]):
        next_order.fitted_together(tables, stage, names, None, False)
