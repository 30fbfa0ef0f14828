"""Explicit schemas of the six input tables."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

ORDERS = StructType(
    [
        StructField("order_id", LongType()),
        StructField("user_id", LongType()),
        StructField("eval_set", StringType()),
        StructField("order_number", IntegerType()),
        StructField("order_dow", IntegerType()),
        StructField("order_hour_of_day", IntegerType()),
        StructField("days_since_prior_order", DoubleType()),
    ]
)
LINES = StructType(
    [
        StructField("order_id", LongType()),
        StructField("product_id", LongType()),
        StructField("add_to_cart_order", IntegerType()),
        StructField("reordered", IntegerType()),
    ]
)
PRODUCTS = StructType(
    [
        StructField("product_id", LongType()),
        StructField("product_name", StringType()),
        StructField("aisle_id", IntegerType()),
        StructField("department_id", IntegerType()),
    ]
)
AISLES = StructType([StructField("aisle_id", IntegerType()), StructField("aisle", StringType())])
DEPARTMENTS = StructType(
    [StructField("department_id", IntegerType()), StructField("department", StringType())]
)

SCHEMAS = {
    "orders": ORDERS,
    "prior": LINES,
    "train": LINES,
    "products": PRODUCTS,
    "aisles": AISLES,
    "departments": DEPARTMENTS,
}


@dataclass(frozen=True)
class Tables:
    """The six input tables as DataFrames."""

    orders: DataFrame
    prior: DataFrame
    train: DataFrame
    products: DataFrame
    aisles: DataFrame
    departments: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]
