"""Implicit-feedback factors and the affinity features made from them."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cosine, dot, norm
from ..session import ensure_checkpoints, written_once
from .running import dense_ids


# Pairs of a block of the fit, and of a cell of the scoring.
PAIRS_PER_BLOCK = 8 << 20
PAIRS_PER_CELL = 2 << 20
# Rounds between two writings of the factors, which let Spark remove the exchanges before them.
CHECKPOINT_ROUNDS = 2
# Pairs scored at a time, and the least denominator of a cosine.
SCORED = 1 << 14
COSINE_FLOOR = 1e-8


def factor_blocks(pairs: int) -> int:
    """Blocks of users, and of items: a factor is sent to every block that needs it, in every round.

    Their number follows the pairs, not the cores, and so do the factors that a seed gives.
    """
    return max(6, -(-pairs // PAIRS_PER_BLOCK))


def cells_a_side(pairs: int) -> int:
    """Ranges of users, and of items, that the pairs are dealt over when they are scored."""
    return max(3, math.ceil(math.sqrt(pairs / PAIRS_PER_CELL)))


def fit_factors(
    pairs: DataFrame,
    rank: int = 32,
    reg: float = 0.01,
    iterations: int = 15,
    alpha: float = 15.0,
    seed: int = 42,
    user: str = "user_id",
    item: str = "product_id",
    blocks: int | None = None,
) -> ALSModel:
    """Implicit-feedback factors from purchase counts (``up_buy_cnt``).

    Users and items are dealt over ``blocks`` blocks each, by default ``factor_blocks`` of the pairs.
    """
    ensure_checkpoints(pairs.sparkSession)
    blocks = blocks or factor_blocks(pairs.count())
    ratings = pairs.select(
        F.col(user).cast("int").alias("user"),
        F.col(item).cast("int").alias("item"),
        F.col("up_buy_cnt").cast("float").alias("rating"),
    )
    als = ALS(
        rank=rank,
        regParam=reg,
        maxIter=iterations,
        alpha=alpha,
        seed=seed,
        implicitPrefs=True,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=CHECKPOINT_ROUNDS,
        coldStartStrategy="nan",
    )
    return als.fit(ratings)


def affinity_features(
    pairs: DataFrame, reindex: bool = False, **parameters
) -> DataFrame:
    """als_dot and als_cos per (user, product); 0.0 where a factor is missing.

    Factor ids must fit 32 bits. With ``reindex`` both ids are first replaced by dense ones,
    numbered in a distributed way.
    """
    user, item, working = "user_id", "product_id", pairs
    if reindex:
        user, item = "user_code", "item_code"
        slim = pairs.select("user_id", "product_id", "up_buy_cnt")
        # Written, as it is fitted on, counted and scored.
        working = written_once(
            slim.join(dense_ids(pairs, "user_id", user), "user_id").join(
                dense_ids(pairs, "product_id", item), "product_id"
            ),
            "coded-pairs",
        )
    model = fit_factors(working, user=user, item=item, **parameters)
    return score_affinity(working, model, user, item)


def score_affinity(
    pairs: DataFrame, model: ALSModel, user: str = "user_id", item: str = "product_id"
) -> DataFrame:
    """Dot product and cosine of the factors of every given pair; 0.0 where a factor is missing.

    Pairs are dealt over a square of cells by the hashes of both ids. A cell gets the factors of its
    range of users and of its range of items once, so no pair carries a vector through an exchange.
    """
    side = cells_a_side(pairs.count())

    def place(id_column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(id_column)), F.lit(side)).cast("int")

    every = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))

    def dealt(factors: DataFrame, name: str, cell: Callable[[Column, Column], Column]) -> DataFrame:
        spread = written_once(factors, name).select(
            F.col("id").cast("int").alias("id"), "features", every.alias("_other")
        )
        return spread.select(
            F.lit(name).alias("side"), "id", "features", cell(place("id"), F.col("_other")).alias("cell")
        )

    users = dealt(model.userFactors, "user-factors", lambda own, other: own * side + other)
    items = dealt(model.itemFactors, "item-factors", lambda own, other: other * side + own)
    placed = pairs.select(
        "user_id", "product_id", F.col(user).cast("int").alias("_u"), F.col(item).cast("int").alias("_i")
    ).withColumn("cell", place("_u") * side + place("_i"))
    schema = pairs.select("user_id", "product_id").schema.add("als_dot", "double").add("als_cos", "double")
    cells = placed.groupBy("cell").cogroup(users.unionByName(items).groupBy("cell"))
    return cells.applyInArrow(_scored, schema)


def _side(factors: pa.Table, name: str, ids: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The vectors of one side, a last one of zeros, and which of them each id has."""
    own = factors.filter(pc.equal(factors["side"], name))
    known = own["id"].to_numpy()
    flat = pc.list_flatten(own["features"]).to_numpy()
    vectors = flat.reshape(len(known), -1) if len(known) else np.zeros((0, 1), np.float32)
    vectors = np.concatenate([vectors, np.zeros((1, vectors.shape[1]), np.float32)])
    wanted = ids.fill_null(-1).to_numpy()
    order = np.argsort(known)
    at = np.searchsorted(known, wanted, sorter=order)
    found = np.append(order, len(known))[at]
    hit = np.append(known, -1)[found] == wanted
    return vectors, np.where(hit, found, len(known))


def _scored(pairs: pa.Table, factors: pa.Table) -> pa.Table:
    """The pairs of a cell with the dot product and cosine of their factors."""
    (users, u), (items, i) = (
        _side(factors, name, pairs[c]) for name, c in (("user-factors", "_u"), ("item-factors", "_i"))
    )
    dots, cosines = np.zeros(len(u)), np.zeros(len(u))
    # A cell may lack one side altogether.
    if users.shape[1] == items.shape[1]:
        for low in range(0, len(u), SCORED):
            some = slice(low, low + SCORED)
            left, right = users[u[some]].astype(float), items[i[some]].astype(float)
            dots[some] = (left * right).sum(axis=1)
            lengths = np.sqrt((left**2).sum(axis=1) * (right**2).sum(axis=1))
            cosines[some] = dots[some] / np.maximum(lengths, COSINE_FLOOR)
    return pa.table(
        [pairs["user_id"], pairs["product_id"], pa.array(dots), pa.array(cosines)],
        names=["user_id", "product_id", "als_dot", "als_cos"],
    )


def similarity_to_groups(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", group: str = "label"
) -> DataFrame:
    """Norm of every vector, and its dot product and cosine with the mean vector of its group.

    Means are taken by (group, place), so no task holds a group. Vectors without a group, or null
    ones, are left out; vectors of a group are equally long.
    """
    places = vectors.select(group, F.posexplode(vector).alias("_place", "_x"))
    means = (
        places.groupBy(group, "_place")
        .agg(F.avg(F.col("_x").cast("double")).alias("_x"))
        .groupBy(group)
        .agg(F.array_sort(F.collect_list(F.struct("_place", "_x"))).alias("_all"))
        .select(group, F.transform("_all", lambda s: s["_x"]).alias("_mean"))
    )
    own = F.col(vector)
    return vectors.where(own.isNotNull()).join(means, group).select(
        key,
        group,
        norm(own).alias("norm"),
        dot(own, F.col("_mean")).alias("dot"),
        cosine(own, F.col("_mean")).alias("cosine"),
    )
