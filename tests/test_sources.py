from __future__ import annotations

import datetime as dt
import os
import random

import pytest

from basketloom.schemas import SCHEMAS
from basketloom.session import shared_dir, use_sql_defaults
from basketloom.sources import Stage, read_delimited, stage_for, staging, warehouse
from basketloom.sources.delimited import DEFAULT_FILES


def test_delimited_round_trip(tables, tmp_path, rows):
    for name, df in tables.items():
        target = tmp_path / DEFAULT_FILES[name]
        df.toPandas().to_csv(target, index=False)
    read = read_delimited(tables.orders.sparkSession, str(tmp_path))
    for name, df in tables.items():
        assert getattr(read, name).schema == SCHEMAS[name]
        assert rows(getattr(read, name)) == rows(df)


def test_a_header_that_differs_is_an_error(tables, tmp_path):
    for name, df in tables.items():
        df.toPandas().rename(columns={"user_id": "customer"}).to_csv(
            tmp_path / DEFAULT_FILES[name], index=False
        )
    read = read_delimited(tables.orders.sparkSession, str(tmp_path))
    with pytest.raises(Exception, match="(?i)header"):
        read.orders.collect()


def test_stage_builds_once_and_reads_back(spark):
    stage, built = Stage(spark, "test"), []

    def build():
        built.append(1)
        return spark.range(5)

    assert stage.table("a/b", build).count() == 5 and stage.table("a/b", build).count() == 5
    assert built == [1]
    assert stage.root.startswith(shared_dir(spark))


def test_a_closed_stage_leaves_nothing(spark):
    with Stage(spark, "closing") as stage:
        assert stage.table("a/b", lambda: spark.range(5)).count() == 5
        assert os.path.isdir(stage.root.removeprefix("file://"))
    assert not os.path.exists(stage.root.removeprefix("file://"))


def test_a_changed_file_gives_a_new_stage(spark, tmp_path):
    for name in staging.INPUTS:
        spark.range(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    folder = str(tmp_path)
    first = stage_for(spark, folder)
    made = first.table("t", lambda: spark.range(2))
    assert stage_for(spark, folder) is first and made.count() == 2
    spark.range(4).write.mode("append").parquet(str(tmp_path / "part.parquet"))
    second = stage_for(spark, folder)
    assert second is not first and not os.path.exists(first.root.removeprefix("file://"))
    second.table("t", lambda: spark.range(2))
    staging._stages, kept = {k: v for k, v in staging._stages.items() if k[1] == folder}, staging._stages
    staging.close_stages(spark)
    assert not staging._stages and not os.path.exists(second.root.removeprefix("file://"))
    staging._stages = {k: v for k, v in kept.items() if k[1] != folder}


@pytest.mark.parametrize("days", [1, 64, 10_000])
def test_orders_of_a_dominant_customer_are_numbered_exactly(spark, monkeypatch, days):
    monkeypatch.setattr(warehouse, "KEYS_PER_BLOCK", 16)
    monkeypatch.setattr(warehouse, "DAYS_PER_BLOCK", days)
    rng = random.Random(2)
    start = dt.datetime(2020, 1, 1)
    raw = []
    for key in range(600):
        customer = 1 if key % 3 == 0 else rng.randint(2, 60)
        raw.append((key, customer, start + dt.timedelta(days=rng.randint(0, 40) * 25)))
    rng.shuffle(raw)
    want = {}
    by_customer = {}
    for key, customer, day in sorted(raw, key=lambda r: (r[2], r[0])):
        earlier = by_customer.setdefault(customer, [])
        gap = (day - earlier[-1][1]).days if earlier else None
        earlier.append((key, day))
        capped = None if gap is None else 30.0 if gap >= 300 else float(gap // 10)
        want[key] = [len(earlier), capped]
    last = {v[-1][0] for v in by_customer.values()}
    df = spark.createDataFrame(raw, "o_orderkey long, o_custkey long, o_orderdate timestamp")
    got = warehouse.warehouse_orders(df).collect()
    assert {r.order_id: [r.order_number, r.days_since_prior_order] for r in got} == want
    for r in got:
        final = "test" if r.user_id % 3 == 0 else "train"
        assert r.eval_set == (final if r.order_id in last else "prior")


def test_lines_are_merged_by_part_and_marked_as_repeats(spark):
    orders = spark.createDataFrame(
        [(1, 7, "prior", 1), (2, 7, "train", 2), (3, 8, "test", 1)],
        "order_id long, user_id long, eval_set string, order_number int",
    )
    raw = spark.createDataFrame(
        [(1, 105, 2), (1, 5, 1), (1, 5, 3), (1, 9, 1), (2, 105, 1), (2, 30, 1), (3, 5, 1)],
        "l_orderkey long, l_partkey long, l_linenumber int",
    )
    got = sorted(tuple(r) for r in warehouse.warehouse_lines(raw, orders).collect())
    assert got == [
        (1, 5, 1, 0, "prior"), (1, 9, 2, 0, "prior"), (1, 105, 3, 0, "prior"),
        (2, 30, 1, 0, "train"), (2, 105, 2, 1, "train"),
    ]


def test_any_type_or_brand_is_one_row_of_its_dimension(spark):
    raw = spark.createDataFrame(
        [(1, "a", "Brand#11", "RARE"), (105, "b", "Other#11", "ODD"), (205, "c", "Brand#12", None),
         (3, "d", "Brand#7", "RARE")],
        "p_partkey long, p_name string, p_brand string, p_type string",
    )
    products = warehouse.warehouse_products(raw)
    assert sorted(tuple(r) for r in products.collect()) == [
        (1, "a", 11, 2), (3, "d", 7, 2), (105, "b", 11, 1), (205, "c", 12, None),
    ]
    aisles, departments = warehouse.warehouse_aisles(raw), warehouse.warehouse_departments(raw)
    assert sorted(tuple(r) for r in aisles.collect()) == [
        (7, " Missing "), (11, "brand#11"), (12, "brand#12"),
    ]
    joined = products.join(aisles, "aisle_id", "left").join(departments, "department_id", "left")
    assert joined.count() == 4


def test_lines_are_read_and_exchanged_once(spark):
    orders = spark.createDataFrame(
        [(1, 7, "prior", 1)], "order_id long, user_id long, eval_set string, order_number int"
    )
    raw = spark.createDataFrame([(1, 5, 1)], "l_orderkey long, l_partkey long, l_linenumber int")
    # Without adaptive execution, reused exchanges show in the plan.
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = warehouse.warehouse_lines(raw, orders)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert plan.count("Scan ExistingRDD") == 2 and plan.count("ReusedExchange") == 1


def test_exchanges_start_with_more_partitions_for_more_input(spark):
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.unset(initial)
    use_sql_defaults(spark)
    assert spark.conf.get(initial, None) is None
    try:
        use_sql_defaults(spark, 1 << 30)
        assert spark.conf.get(initial) == "512"
        use_sql_defaults(spark, 1000)
        assert spark.conf.get(initial) == str(own)
    finally:
        spark.conf.unset(initial)
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == "16m"
