"""Delimited-text source."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from ..schemas import SCHEMAS, Tables

# The file names of the public grocery-order data set layout.
DEFAULT_FILES = {
    "orders": "orders.csv",
    "prior": "order_products__prior.csv",
    "train": "order_products__train.csv",
    "products": "products.csv",
    "aisles": "aisles.csv",
    "departments": "departments.csv",
}


def read_delimited(
    spark: SparkSession, folder: str, files: Mapping[str, str] = DEFAULT_FILES, sep: str = ","
) -> Tables:
    """Read the six tables with explicit schemas; a header that differs from them is an error.

    A field that cannot be read as its type becomes null; ``cleaning.lenient_keys`` drops the rows
    whose keys were lost that way.
    """
    frames = {
        name: spark.read.schema(schema)
        .options(header=True, enforceSchema=False, sep=sep, quote='"', escape='"')
        .csv(f"{folder.rstrip('/')}/{files[name]}")
        for name, schema in SCHEMAS.items()
    }
    return Tables(**frames)
