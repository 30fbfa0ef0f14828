from __future__ import annotations

import random

from basketloom.operators import cleaning
from basketloom.operators import purchases as buy
from basketloom.schemas import ORDERS


def test_purchase_table_has_order_and_catalogue_columns(tables, rows):
    got = buy.purchase_table(cleaning.clean_metadata(tables))
    assert got.columns == buy.PURCHASE_COLUMNS
    lines = rows(got, "order_id", "product_id", "source", "user_id", "aisle")
    assert len(lines) == 7 and (12, 3, "train", 1, "bakery") in lines


def test_lines_of_unknown_orders_are_dropped_and_unknown_products_kept(tables, spark, rows):
    from basketloom.schemas import LINES

    lines = spark.createDataFrame([(99, 1, 1, 0), (10, 77, 1, 0)], LINES)
    joined = buy.with_catalog(buy.with_order_attributes(lines, tables.orders), tables)
    assert rows(joined, "order_id", "product_id", "aisle_id", "user_id") == [(10, 77, None, 1)]


def test_cumulative_days_fill_the_first_gap(tables, rows):
    timeline = buy.with_cumulative_days(tables.orders)
    got = dict(rows(timeline, "order_id", "user_cum_days"))
    assert got == {10: 0.0, 11: 5.0, 12: 12.0, 20: 0.0, 21: 30.0, 30: 0.0}
    assert rows(buy.last_cumulative_day(timeline)) == [(1, 12.0), (2, 30.0), (3, 0.0)]


def test_cumulative_days_of_one_dominant_user(spark, monkeypatch):
    monkeypatch.setattr(buy, "ORDERS_PER_BLOCK", 8)
    rng = random.Random(5)
    data = [(i, 1, "prior", i, 0, 0, float(rng.randint(0, 30))) for i in range(1, 301)]
    data += [(1000 + i, i, "prior", 1, 0, 0, None) for i in range(2, 100)]
    want, total = {}, 0.0
    for row in data[:300]:
        total += row[6]
        want[row[0]] = total
    got = buy.with_cumulative_days(spark.createDataFrame(data, ORDERS)).where("user_id = 1")
    assert {r.order_id: r.user_cum_days for r in got.collect()} == want


def test_target_is_the_last_order_with_lines(tables, rows):
    purchases = buy.purchase_table(tables)
    targets = buy.target_orders(tables.orders, purchases)
    # User 2's test order has no lines, so the prior order is the target; user 3 has none.
    assert rows(targets, "user_id", "target_order_id", "eval_set") == [(1, 12, "train"), (2, 20, "prior")]
    target, history = buy.target_rows(purchases, targets), buy.history_rows(purchases, targets)
    assert rows(target, "order_id", "product_id") == [(12, 1), (12, 3), (20, 2), (20, 3)]
    assert sorted(rows(target) + rows(history), key=repr) == rows(purchases)
    assert rows(buy.eligible_users(history)) == [(1, 2)]
    flagged = buy.with_target_flag(purchases, targets)
    assert rows(flagged.where("is_target_order"), *purchases.columns) == rows(target)


def test_target_ties_take_the_larger_order(spark, tables, rows):
    from basketloom.schemas import LINES

    orders = spark.createDataFrame(
        [(1, 7, "prior", 2, 0, 0, 1.0), (2, 7, "prior", 2, 0, 0, 1.0), (3, 7, "prior", 1, 0, 0, None)],
        ORDERS,
    )
    lines = spark.createDataFrame([(1, 1, 1, 0), (3, 1, 1, 0)], LINES)
    purchases = buy.with_order_attributes(lines, orders)
    assert rows(buy.target_orders(orders, purchases), "user_id", "target_order_id") == [(7, 2)]
    assert rows(buy.last_orders(orders), "order_id") == [(2,)]
