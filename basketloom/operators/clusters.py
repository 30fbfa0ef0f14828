"""k-means for many numbers of clusters and many restarts at once.

A scan of the rows serves all fits: it draws the next centre of every restart, or adds up the rows of
every cluster of every fit. Rows never move; what meets are sums, and the driver holds centres only.
Sums are taken over integers, so that results do not depend on the order of tasks.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Coordinates and squared distances are summed in these units.
UNIT = 1 << 24
COST = 1 << 20
# Rows compared with all centres at a time.
BLOCK = 2048
_ODD = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class Clusters:
    """The centres of a fit and the sum of squared distances to them."""

    centres: np.ndarray
    inertia: float

    def nearest(self, columns: Sequence[Column | str]) -> Column:
        """The number of the nearest centre (the first of equally near ones)."""
        values = [F.col(c) if isinstance(c, str) else c for c in columns]

        def far(centre: np.ndarray) -> Column:
            terms = [(v - F.lit(float(x))) * (v - F.lit(float(x))) for v, x in zip(values, centre, strict=True)]
            return sum(terms[1:], terms[0])

        away = F.array(*[far(c) for c in self.centres])
        return (F.array_position(away, F.array_min(away)) - 1).cast("int")


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.stack([batch.column(f"x{i}").to_numpy() for i in range(width)], axis=1)


def _blocks(batches: Iterator[pa.RecordBatch], width: int):
    for batch in batches:
        values, ids = _matrix(batch, width), batch.column("id").to_numpy().view(np.uint64)
        for low in range(0, len(values), BLOCK):
            yield values[low : low + BLOCK], ids[low : low + BLOCK]


def _distances(values: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres (..., columns), as (rows, ...)."""
    flat = centres.reshape(-1, centres.shape[-1])
    away = (values**2).sum(axis=1)[:, None] - 2.0 * values @ flat.T + (flat**2).sum(axis=1)
    return np.maximum(away, 0.0).reshape(len(values), *centres.shape[:-1])


def _uniform(ids: np.ndarray, salt: int) -> np.ndarray:
    """A number in (0, 1] for every row: a hash of its id and the salt."""
    x = ids ^ np.uint64(salt)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x >> np.uint64(11)).astype(float) + 1.0) / (1 << 53)


def _next_centres(rows: DataFrame, width: int, centres: np.ndarray, salts: Sequence[int]) -> np.ndarray:
    """One more centre for every restart, drawn by squared distance from those it has.

    Of all rows the one with the least -ln(u) / weight comes out with a chance in proportion to its
    weight; every task hands in its own least.
    """
    first = centres.shape[1] == 0

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.full(len(salts), np.inf)
        own = np.zeros(len(salts), np.uint64)
        found = np.zeros((len(salts), width))
        for values, ids in _blocks(batches, width):
            weight = (
                np.ones((len(values), len(salts)))
                if first
                else _distances(values, centres).min(axis=2)
            )
            for s, salt in enumerate(salts):
                with np.errstate(divide="ignore"):
                    wait = np.where(weight[:, s] > 0, -np.log(_uniform(ids, salt)) / weight[:, s], np.inf)
                i = int(np.argmin(wait))
                if (wait[i], ids[i]) < (best[s], own[s]):
                    best[s], own[s], found[s] = wait[i], ids[i], values[i]
        some = np.flatnonzero(np.isfinite(best))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int32)),
                pa.array(best[some]),
                pa.array(own[some].view(np.int64)),
                pa.array(found[some].tolist(), pa.list_(pa.float64())),
            ],
            ["restart", "wait", "id", "row"],
        )

    drawn = (
        rows.mapInArrow(draw, "restart int, wait double, id long, row array<double>")
        .groupBy("restart")
        .agg(F.min(F.struct("wait", "id", "row")).alias("least"))
        .collect()
    )
    chosen = {r.restart: r.least.row for r in drawn}
    # Fewer different rows than centres: the first centre again.
    return np.array(
        [chosen[s] if s in chosen else (centres[s, 0] if not first else np.zeros(width)) for s in range(len(salts))]
    )


def _sums(rows: DataFrame, width: int, centres: Mapping[int, np.ndarray]):
    """Per number of clusters: (count and coordinate sums by restart and cluster, cost by restart)."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {k: np.zeros((width + 1, c.shape[0] * k), np.int64) for k, c in centres.items()}
        cost = {k: np.zeros(c.shape[0], np.int64) for k, c in centres.items()}
        for values, _ in _blocks(batches, width):
            whole = np.rint(values * UNIT)
            for k, c in centres.items():
                away = _distances(values, c)
                nearest = away.argmin(axis=2)
                at = (nearest + np.arange(c.shape[0]) * k).ravel()
                size = total[k].shape[1]
                total[k][0] += np.bincount(at, minlength=size)
                for i in range(width):
                    weights = np.repeat(whole[:, i], c.shape[0])
                    total[k][i + 1] += np.bincount(at, weights, size).astype(np.int64)
                cost[k] += np.rint(away.min(axis=2) * COST).astype(np.int64).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(centres), pa.int32()),
                pa.array([total[k].tobytes() for k in centres], pa.binary()),
                pa.array([cost[k].tobytes() for k in centres], pa.binary()),
            ],
            ["k", "total", "cost"],
        )

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        merged = [
            np.sum([np.frombuffer(b, np.int64) for b in table[c].to_pylist()], axis=0).tobytes()
            for c in ("total", "cost")
        ]
        return pa.table(
            [pa.array([key[0].as_py()], pa.int32()), *[pa.array([m], pa.binary()) for m in merged]],
            names=["k", "total", "cost"],
        )

    schema = "k int, total binary, cost binary"
    found = rows.mapInArrow(add, schema).groupBy("k").applyInArrow(merge, schema).collect()
    return {
        r.k: (
            np.frombuffer(r.total, np.int64).reshape(width + 1, -1, r.k),
            np.frombuffer(r.cost, np.int64) / COST,
        )
        for r in found
    }


def fit_clusters(
    df: DataFrame,
    columns: Sequence[str],
    ks: Sequence[int],
    restarts: int = 20,
    seed: int = 42,
    key: str = "user_id",
    steps: int = 300,
    tolerance: float = 1e-4,
) -> dict[int, Clusters]:
    """For every k the fit of least inertia among ``restarts``.

    A restart draws its first centres by squared distance; every k takes as many of them as it needs.
    A fit moves its centres until their squared moves add up to no more than ``tolerance`` times the mean
    variance of the columns, or ``steps`` times. A cluster that loses all rows keeps its centre. There
    must be at least one row.
    """
    width = len(columns)
    rows = df.select(
        F.xxhash64(key).alias("id"),
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(columns)],
    ).persist()
    try:
        drawn = np.zeros((restarts, 0, width))
        for step in range(max(ks)):
            salts = [((seed + r) * _ODD + step * 0x632BE59BD9B4E019) % (1 << 64) for r in range(restarts)]
            following = _next_centres(rows, width, drawn, salts)
            drawn = np.concatenate([drawn, following[:, None, :]], axis=1)
        variances = rows.agg(*[F.var_pop(f"x{i}") for i in range(width)]).first()
        enough = tolerance * float(np.mean([v or 0.0 for v in variances]))
        centres = {k: drawn[:, :k].copy() for k in ks}
        moving = {k: np.arange(restarts) for k in ks}
        for _ in range(steps):
            active = {k: centres[k][which] for k, which in moving.items() if len(which)}
            if not active:
                break
            for k, (total, _) in _sums(rows, width, active).items():
                which, n = moving[k], total[0]
                means = np.moveaxis(total[1:], 0, -1) / UNIT / np.maximum(n, 1)[:, :, None]
                after = np.where(n[:, :, None] > 0, means, active[k])
                moved = ((after - active[k]) ** 2).sum(axis=(1, 2))
                centres[k][which] = after
                moving[k] = which[moved > enough]
        last = _sums(rows, width, centres)
    finally:
        rows.unpersist()
    if not any(total[0].any() for total, _ in last.values()):
        raise ValueError("no rows to cluster")
    costs = {k: cost for k, (_, cost) in last.items()}
    best = {k: int(np.argmin(costs[k])) for k in ks}
    return {k: Clusters(centres[k][best[k]], float(costs[k][best[k]])) for k in ks}
