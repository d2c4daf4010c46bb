"""Centroid clustering of whole-number vectors by an equal-average equal-variance search.

The squared distance of two vectors is at least the squared difference of their component sums over the width (equal
average), and that plus the squared difference of their deviations, the lengths left when the mean is taken off (equal
variance). Centroids are sorted by their component sum. A vector's search starts at its own sum and goes outward, the
nearer sum first: it ends where the first bound exceeds the best distance so far, skips a centroid where the second one
does, and takes every other distance exactly, in integers. Bounds are floating point and give way by more than their
rounding, so the result is that of comparing with every centroid.

Each round is one pass over the rows: a task sums its vectors per cluster, Spark adds up the sums, and the new centroids,
a fixed number, go out to the next round.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common

#: Relative room for rounding in the bounds.
ROOM = 1e-9
ASSIGNED = "`__id` {}, cluster int, distance bigint"


def largest(width: int) -> int:
    """Greatest size of a component for which every squared distance fits 64 bits."""
    return math.isqrt(2**62 // width) // 2


def integers(df: DataFrame, id_col="vec_id", vector_col="embedding", width=64, scale=64) -> DataFrame:
    """``__id`` and ``v``, the array of floor(scale * x). Left out are rows whose vector is missing, has another number of
    components, or has one that is missing or not finite. A component beyond ``largest(width)`` is an error, as distances
    would not fit their type."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    bound = float(largest(width))
    whole = F.transform("v", lambda e: F.when(F.abs(e * scale) < bound, F.floor(e * scale).cast("int")).otherwise(
        F.raise_error(F.lit("a component is too large for exact distances")).cast("int")))
    return df.select(F.col(id_col).alias("__id"), x.alias("v")).where(F.size("v") == width).where(
        fine.alias("fine")).select("__id", whole.alias("v"))


def clustered(df: DataFrame, id_col="vec_id", vector_col="embedding", k=16, rounds=3, width=64, scale=64, seed="1:"
              ) -> DataFrame:
    """Per kept row (see ``integers``): the id, ``cluster``, ``distance`` (squared, to its centroid), ``cluster_inertia``
    and ``inertia`` (distances summed over its cluster and over all), ``centroid_sha256``.

    Centroids 0, 1, ... start as the ``k`` rows with the least sha256 of ``seed`` and id, or as all rows if there are
    fewer; of rows with equal ids the lesser vector comes first, and a row without an id starts none, but is assigned.
    In each of ``rounds`` every row goes to the nearest centroid, of equally near ones to the smaller number, and each
    centroid that has rows moves to the floor of their mean. Then rows are assigned once more. Repeated rows and ids each
    give their row; other columns are dropped. An empty table, or one without an id, gives no rows.
    """
    spark = df.sparkSession
    kind = df.schema[id_col].dataType.simpleString()
    rows = common.staged(integers(df, id_col, vector_col, width, scale), "integers")
    order = F.sha2(F.concat(F.lit(seed), F.col("__id").cast("string")), 256)
    first = rows.where("__id IS NOT NULL").orderBy(order, "v").limit(k).select("v").collect()
    if not first:
        return spark.createDataFrame([], f"`{id_col}` {kind}, cluster int, distance bigint, cluster_inertia bigint, "
                                         "inertia bigint, centroid_sha256 string")
    centres = np.array([r.v for r in first], np.int64)
    for _ in range(rounds):
        centres = _moved(rows, centres)
    sent = spark.sparkContext.broadcast(centres)
    placed = common.staged(common.mapped(rows, _assigner(sent), ASSIGNED.format(kind)), "assigned")
    # One row per centroid, at most k.
    sums = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    ends = spark.createDataFrame(
        [(c, s, sum(sums.values()), names[c]) for c, s in sorted(sums.items())],
        "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return placed.join(F.broadcast(ends), "cluster").select(
        F.col("__id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centre of each row of ``x``, and the squared distance; both arrays of whole numbers."""
    width = x.shape[1]
    total = centres.sum(1)
    order = np.argsort(total, kind="stable")
    total, spread = total[order].astype(np.float64), _deviation(centres)[order]
    own, wide = x.sum(1).astype(np.float64), _deviation(x)
    up = np.searchsorted(total, own)
    down = up - 1
    # A centre beyond either end is infinitely far.
    total = np.concatenate([[-np.inf], total, [np.inf]])
    best, number = np.full(len(x), np.iinfo(np.int64).max), np.full(len(x), len(centres))
    live = np.arange(len(x))
    while len(live):
        below, above = own[live] - total[down[live] + 1], total[up[live] + 1] - own[live]
        rising = above <= below
        average = np.where(rising, above, below) ** 2 / width * (1 - ROOM)
        on = average <= best[live]
        live, rising, average = live[on], rising[on], average[on]
        at = np.where(rising, up[live], down[live])
        up[live] += rising
        down[live] -= ~rising
        apart = np.abs(wide[live] - spread[at]) - ROOM * (wide[live] + spread[at] + 1)
        near = average + np.maximum(apart, 0) ** 2 * (1 - ROOM) <= best[live]
        row, centre = live[near], order[at[near]]
        exact = ((x[row] - centres[centre]) ** 2).sum(1)
        better = (exact < best[row]) | ((exact == best[row]) & (centre < number[row]))
        best[row[better]], number[row[better]] = exact[better], centre[better]
    return number, best


def _deviation(x):
    """Length of each row without its mean."""
    return np.sqrt(((x - x.mean(1, keepdims=True)) ** 2).sum(1))


def _matrix(lists) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(lists), -1)


def _assigner(sent):
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                number, distance = nearest(_matrix(batch.column("v")), sent.value)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("__id"), pa.array(number, pa.int32()), pa.array(distance, pa.int64())],
                    ["__id", "cluster", "distance"])

    return run


def _moved(rows: DataFrame, centres: np.ndarray) -> np.ndarray:
    """Centroids at the floor of the mean of their rows; those without rows stay."""
    sent = rows.sparkSession.sparkContext.broadcast(centres)

    def run(batches):
        sums = np.zeros((len(sent.value), sent.value.shape[1] + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v"))
                number, _ = nearest(x, sent.value)
                np.add.at(sums[:, 1:], number, x)
                sums[:, 0] += np.bincount(number, minlength=len(sums))
        used = np.flatnonzero(sums[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(list(sums[used]), pa.list_(pa.int64()))],
                                         ["cluster", "sums"])

    # The first sum is the number of rows. What comes back is bounded by centroids times components.
    parts = common.mapped(rows, run, "cluster int, sums array<bigint>").select("cluster", F.posexplode("sums"))
    sums = parts.groupBy("cluster", "pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("s")).collect()
    found = {(r.cluster, r.pos): int(r.s) for r in sums}
    moved = centres.copy()
    for (c, pos), s in found.items():
        if pos:
            moved[c, pos - 1] = s // found[c, 0]
    return moved
