"""Exact top-k search by inner product over norm-sorted, rotated vectors.

Vectors are rotated onto the singular directions of the whole table, so that the first coordinates carry most of every
product, and cut into blocks by descending length. For a query, the product of the first coordinates plus the product
of the lengths of the remaining ones bounds the whole product (Cauchy-Schwarz). Each query first meets the block of the
longest vectors, which gives it a score that it must beat; the other blocks are visited only where the product of
lengths can reach that score, and within a block, whole products are taken only where the bound can.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common

#: Vectors in a block of candidates, and queries handled with a block at once.
BLOCK, QUERIES = 4096, 1024
#: Most steps of length that blocks are told apart by.
STEPS = 64
#: Relative room for rounding in the rotated coordinates; scores themselves are exact integers.
ROOM = 1e-9


def quantised(df: DataFrame, id_col="vec_id", vector_col="embedding", scale=64) -> DataFrame:
    """``id`` and ``v``, the array of floor(scale * x). Rows with a missing id or vector, an empty vector, or a
    component that is missing or not finite are left out."""
    x = F.col(vector_col).cast("array<double>")
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return df.select(F.col(id_col).cast("bigint").alias("id"), x.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(fine.alias("fine")).select(
        "id", F.transform("v", lambda e: F.floor(e * scale)).alias("v"))


def search(vectors: DataFrame, is_query, k=20) -> DataFrame:
    """For the rows of ``vectors`` (``id``, ``v`` array of whole numbers) where ``is_query`` holds, the ``k`` other rows
    of the greatest inner product: ``query_id``, ``rank`` from 1, ``vec_id``, ``score``.

    Equal scores go to the smaller id. Vectors meet only those of as many components; each number of components is a
    search of its own. Scores are exact; one that 64 bits cannot hold is an error. Fewer candidates give fewer rows. Rows that
    repeat an id are one candidate each for other queries and none for a query of their id; repeated queries of equal id
    and vector are one.
    """
    spark = vectors.sparkSession
    vectors = common.staged(vectors, "vectors")
    widths = [r[0] for r in vectors.select(F.size("v")).distinct().collect()]
    if len(widths) > 1:
        found = [search(vectors.where(F.size("v") == w), is_query, k) for w in sorted(widths)]
        return functools.reduce(DataFrame.unionByName, found)
    rotation, count = _rotation(vectors)
    if not count:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    rows = common.staged(common.mapped(vectors, _rotator(rotation), "id bigint, v array<bigint>, r array<double>, "
                                       "norm double, tail double"), "rotated")
    # Steps of descending length, their bounds found by a sketch; a step of more vectors than a block holds, be it for
    # equal lengths or for a large table, is several blocks of the same lengths.
    steps = min(STEPS, max(1, -(-count // BLOCK)))
    shares = [i / steps for i in range(1, steps)]
    edges = sorted(set(rows.approxQuantile("norm", shares, 0.25 / steps))) if shares else []
    step = _bucket(F.col("norm"), edges)
    sizes = {r[0]: r[1] for r in rows.groupBy(step.alias("s")).count().collect()}
    parts = {s: max(1, -(-n // BLOCK)) for s, n in sizes.items()}
    first, order = {}, 0
    for s in sorted(parts, reverse=True):
        first[s] = order
        order += parts[s]
    lookup = lambda d: F.create_map(*(F.lit(x) for p in d.items() for x in p))
    own = (lookup(first)[step] + F.pmod(F.monotonically_increasing_id(), lookup(parts)[step])).cast("int")
    candidates = common.staged(rows.withColumn("block", own), "candidates")
    tops = candidates.groupBy(F.col("block").alias("at")).agg(F.max("norm").alias("top"))
    queries = rows.where(is_query).dropDuplicates(["id", "v"])
    number = max(1, -(-queries.count() // QUERIES))
    queries = common.staged(queries.withColumn("group", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(number)).cast("int")),
                            "queries")
    wanted = queries.withColumn("least", F.lit(float("-inf")))
    head = _met(candidates.where("block = 0"), wanted.withColumn("block", F.lit(0)), k)
    head = common.staged(head, "head")
    if order == 1:
        return _best(head, k)
    # A query visits the blocks whose longest vector can still reach the score of its k-th best so far.
    least = head.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    bound = F.coalesce(F.col("least"), F.lit(float("-inf")))
    later = queries.join(least, queries["id"] == least["query_id"], "left").select(
        "id", "v", "r", "norm", "tail", "group", bound.cast("double").alias("least"))
    tops = F.broadcast(tops.where("at > 0"))  # one row per block of thousands of vectors
    reach = F.col("norm") * F.col("top") * (1 + ROOM) >= F.col("least")
    visits = later.join(tops, reach).withColumn("block", F.col("at")).drop("top", "at")
    rest = _met(candidates.where("block > 0"), visits, k)
    return _best(head.unionByName(rest), k)


def _bucket(norm, edges):
    out = F.lit(0)
    for e in edges:
        out = out + (norm >= e).cast("int")
    return out


def _rotation(vectors: DataFrame):
    """Singular directions by the sum of outer products over all rows (columns in order of their weight), and the
    number of rows."""
    def run(batches):
        total, rows = None, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("v")).astype(np.float64)
                total = x.T @ x if total is None else total + x.T @ x
                rows += len(x)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([rows]), pa.array([total.ravel().tolist()])], ["n", "g"])

    sums = common.mapped(vectors, run, "n bigint, g array<double>")
    flat = sums.select(F.posexplode("g")).groupBy("pos").agg(F.sum("col")).collect()
    count = sums.agg(F.sum("n")).first()[0] or 0
    gram = np.zeros(len(flat))
    for at, value in flat:
        gram[at] = value
    if not count:
        return np.zeros((0, 0)), 0
    width = int(round(np.sqrt(len(gram))))
    _, directions = np.linalg.eigh(gram.reshape(width, width))
    return directions[:, ::-1], count


def _rotator(rotation):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v")).astype(np.float64)
            r = x @ rotation
            head = _head(r.shape[1])
            ends = np.arange(len(x) + 1, dtype=np.int32) * r.shape[1]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), batch.column("v"), pa.ListArray.from_arrays(ends, r.ravel()),
                pa.array(np.sqrt((x * x).sum(1))), pa.array(np.sqrt((r[:, head:] ** 2).sum(1)))],
                ["id", "v", "r", "norm", "tail"])

    return run


def _head(width):
    """Rotated coordinates that are multiplied first."""
    return max(1, width // 4)


def _matrix(lists) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _met(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The best ``k`` of each block for the queries that visit it. A task has one block and one group of queries, both
    of bounded size."""
    groups = queries.select(F.col("block").alias("b"), F.col("group").alias("g")).distinct()
    left = candidates.withColumn("own", F.col("block")).drop("block")
    left = left.join(groups, F.col("own") == F.col("b")).drop("own").groupBy("b", "g")

    def run(key, left, right):
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64())] * 3, names)
        ids, v, r = left["id"].to_numpy(), _matrix(left["v"]), _matrix(left["r"])
        norm, tail = left["norm"].to_numpy(), left["tail"].to_numpy()
        order = np.argsort(-norm, kind="stable")
        ids, v, r, norm, tail = ids[order], v[order], r[order], norm[order], tail[order]
        # No sum within a product exceeds the product of the lengths: doubles are exact below 2**53, else whole numbers.
        kind = np.float64 if norm.max() * right["norm"].to_numpy().max() < 2.0**52 else object
        head, v = _head(r.shape[1]), v.astype(kind)
        asked, qv, qr = right["id"].to_numpy(), _matrix(right["v"]), _matrix(right["r"])
        qnorm, qtail, least = (right[c].to_numpy() for c in ("norm", "tail", "least"))
        qv = qv.astype(kind)
        partial = qr[:, :head] @ r[:, :head].T
        out = []
        for i in range(len(asked)):
            room = ROOM * (1 + qnorm[i] * norm)
            upper = partial[i] + qtail[i] * tail + room
            # Vectors come by descending length: past this place none can reach the score.
            stop = int(np.searchsorted(-(qnorm[i] * norm + room), -least[i], "right"))
            could = np.flatnonzero(upper[:stop] >= least[i])
            could = could[ids[could] != asked[i]]
            if len(could) > 4 * k:
                # The best bounds first; what they score raises the mark for the others.
                some = could[np.argpartition(-upper[could], 2 * k)[:2 * k]]
                mark = np.sort((v[some] @ qv[i]).astype(np.float64))[-k]
                could = could[upper[could] >= mark]
            score = (v[could] @ qv[i]).astype(np.int64)
            best = np.lexsort((ids[could], -score))[:k]
            out.append((np.full(len(best), asked[i]), ids[could[best]], score[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out)], names)

    common.ship(candidates.sparkSession)
    return left.cogroup(queries.groupBy("block", "group")).applyInArrow(
        run, "query_id bigint, vec_id bigint, score bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
