from __future__ import annotations

import pytest

from basketloom.operators import cleaning


def test_lenient_keys_drop_what_cannot_be_read(spark, rows):
    data = [("1", "2"), ("x", "2"), ("", "2"), (None, "2"), ("3.0", "4"), (str(2**60 + 1), "5")]
    df = spark.createDataFrame(data, "order_id string, product_id string")
    got = rows(cleaning.lenient_keys(df, ["order_id", "product_id"]))
    assert got == sorted([(1, 2), (3, 4), (2**60 + 1, 5)], key=repr)


def test_missing_metadata_cascades(tables, rows):
    clean = cleaning.clean_metadata(tables)
    assert rows(clean.products, "product_id") == [(1,), (2,), (3,)]
    assert rows(clean.prior, "order_id", "product_id") == [(10, 1), (10, 2), (11, 1), (20, 2), (20, 3)]
    assert len(rows(clean.aisles)) == 3 and len(rows(clean.departments)) == 3
    report = dict(rows(cleaning.missing_report(tables), "what", "n"))
    assert report == {
        "product_names": 0,
        "aisle_names": 1,
        "department_names": 0,
        "products_removed": 1,
        "prior_lines_removed": 1,
        "train_lines_removed": 0,
    }


def test_missing_by_own_name_and_by_department(tables, spark, rows):
    from dataclasses import replace

    from basketloom.schemas import DEPARTMENTS, PRODUCTS

    products = [(1, "Missing", 1, 1), (2, "milk", 2, 2), (3, None, 3, 3), (5, "x", 9, 9)]
    odd = replace(
        tables,
        products=spark.createDataFrame(products, PRODUCTS),
        departments=spark.createDataFrame([(1, "a"), (2, "missing"), (3, "c")], DEPARTMENTS),
    )
    # A null name is kept, and so is a product whose aisle and department are unknown.
    assert rows(cleaning.clean_metadata(odd).products, "product_id") == [(3,), (5,)]


def test_null_pattern_and_profile(tables, rows):
    assert rows(cleaning.null_pattern(tables.orders)) == [(3, 3, 3)]
    profile = {r[:2]: r[2] for r in rows(cleaning.null_profile({"orders": tables.orders}))}
    assert profile["orders", "days_since_prior_order"] == 3
    assert sum(profile.values()) == 3 and len(profile) == 7


def test_audit(tables, rows):
    got = {r[0]: r[1:] for r in rows(cleaning.table_audit(dict(tables.items())))}
    assert got["orders"] == (6, 7, 3) and got["prior"] == (6, 4, None)


def test_describe(tables):
    got = cleaning.describe_numeric({"orders": (tables.orders, ["days_since_prior_order"])}).collect()
    assert len(got) == 1
    row = got[0]
    assert (row.n, row.mean, row.min, row.q50, row.max) == (3, 14.0, 5.0, 7.0, 30.0)
    assert row.q75 == 18.5 and row["std"] == pytest.approx(13.892444)


def test_preview_and_fill(tables, rows):
    assert [r.order_id for r in cleaning.preview(tables.orders, ["order_id"], 2).collect()] == [10, 11]
    filled = cleaning.fill_nulls(tables.orders, {"days_since_prior_order": 0.0})
    assert rows(filled.where("order_number = 1"), "days_since_prior_order") == [(0.0,)] * 3


def test_required_columns_are_checked_while_planning(tables):
    with pytest.raises(KeyError, match="absent"):
        cleaning.require_columns(tables.orders, ["order_id", "absent"])
