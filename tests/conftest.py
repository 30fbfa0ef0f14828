from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from basketloom.schemas import AISLES, DEPARTMENTS, LINES, ORDERS, PRODUCTS, Tables  # noqa: E402
from basketloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "6g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    """Three users, four products (product 4 is in a nameless aisle), small enough to check by eye.

    User 1: prior orders 10, 11, train order 12. User 2: prior order 20, test order 21.
    User 3: a single train order 30 with no lines.
    """
    orders = [
        (10, 1, "prior", 1, 0, 8, None),
        (11, 1, "prior", 2, 1, 9, 5.0),
        (12, 1, "train", 3, 2, 9, 7.0),
        (20, 2, "prior", 1, 3, 8, None),
        (21, 2, "test", 2, 4, 10, 30.0),
        (30, 3, "train", 1, 5, 8, None),
    ]
    prior = [
        (10, 1, 1, 0),
        (10, 2, 2, 0),
        (11, 1, 1, 1),
        (11, 4, 2, 0),
        (20, 2, 1, 0),
        (20, 3, 2, 0),
    ]
    train = [(12, 1, 1, 1), (12, 3, 2, 0)]
    products = [(1, "apple", 1, 1), (2, "milk", 2, 2), (3, "bread", 3, 3), (4, "mystery", 4, 1)]
    aisles = [(1, "fruit"), (2, "dairy"), (3, "bakery"), (4, " MISSING\t")]
    departments = [(1, "fresh"), (2, "cold"), (3, "ambient")]
    make = spark.createDataFrame
    return Tables(
        orders=make(orders, ORDERS),
        prior=make(prior, LINES),
        train=make(train, LINES),
        products=make(products, PRODUCTS),
        aisles=make(aisles, AISLES),
        departments=make(departments, DEPARTMENTS),
    )


@pytest.fixture
def rows():
    """Sorted tuples of the given columns (default: all)."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect
