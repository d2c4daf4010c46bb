"""Best-fit packing of token sequences by large-item matching.

Only lengths matter, and there are at most ``capacity`` of them. The numbers of pieces per length are counted in Spark;
from these few numbers a plan is made in runs: pieces above a third of the capacity are matched, at most two to a bin,
each with the longest partner that fits; the smaller ones go, longest first, into the smallest gap that holds them. A
run says "pieces number r to s of this length, q to a bin, from bin b on". Each piece then finds its place from its
length and its number among the pieces of that length: the pieces of a task are numbered as they are written, and
running sums over the tasks' counts say where a task's numbers begin.
"""

from __future__ import annotations

import bisect
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from . import common, tokens

CAPACITY = 4096
END_ID = 1


def pieces(df: DataFrame, id_col="doc_id", text_col="text", tokenizer="word_bpe_49k.json", end_id=END_ID,
           capacity=CAPACITY) -> DataFrame:
    """Per piece of a text: the id, ``piece`` (from 0), ``start`` (the text's tokens before it), ``length`` and ``ids``
    (binary, little-endian unsigned 32-bit).

    Only texts of more than ``capacity`` tokens, their end id included, are cut. A missing or empty text is one piece
    with the end id alone. Repeated rows and ids each give their pieces.
    """
    width = 4 * capacity

    def cut(ids):
        rows, number, start, length, data = [], [], [], [], []
        for i, x in enumerate(ids):
            for k in range(0, max(len(x), 1), width):
                part = x[k:k + width]
                rows.append(i)
                number.append(k // width)
                start.append(k // 4)
                length.append(len(part) // 4)
                data.append(part)
        columns = [pa.array(number, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                   pa.array(data, pa.binary())]
        return np.array(rows, np.int64), columns, ["piece", "start", "length", "ids"]

    return tokens.encoded(df, [id_col], text_col, tokenizer, end_id=end_id, then=cut,
                          fields="piece int, start bigint, length bigint, ids binary")


def plan(counts: dict[int, int], capacity=CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first number, first bin, pieces of this run in one bin, offset in the bin) for the counts of each
    length. Their number depends on the number of different lengths, not on that of pieces."""
    runs, bins = [], 0
    gaps: list[int] = []
    free: dict[int, list] = defaultdict(list)

    def add(gap, first, count):
        if count and gap:
            if not free[gap]:
                bisect.insort(gaps, gap)
            free[gap].append((first, count))

    large = sorted((n for n in counts if 3 * n > capacity and counts[n]), reverse=True)
    left, used = {n: counts[n] for n in large}, defaultdict(int)
    ascending = large[::-1]
    while large:
        n = large[0]
        at = bisect.bisect_right(ascending, capacity - n) - 1
        if at >= 0 and ascending[at] == n and left[n] == 1:
            # The last piece of its length takes the next shorter one.
            at -= 1
        partner = ascending[at] if at >= 0 else None
        if partner is None:
            take = left[n]
            runs.append((n, used[n], bins, 1, 0))
            add(capacity - n, bins, take)
            bins += take
            pairs = []
        elif partner == n:
            take = left[n] - left[n] % 2
            runs.append((n, used[n], bins, 2, 0))
            add(capacity - 2 * n, bins, take // 2)
            bins += take // 2
            pairs = []
        else:
            take = min(left[n], left[partner])
            runs.append((n, used[n], bins, 1, 0))
            runs.append((partner, used[partner], bins, 1, n))
            add(capacity - n - partner, bins, take)
            bins += take
            pairs = [partner]
        for m in [n, *pairs]:
            left[m] -= take
            used[m] += take
            if not left[m]:
                large.remove(m)
                ascending.remove(m)
    for n in sorted((n for n in counts if n and 3 * n <= capacity and counts[n]), reverse=True):
        todo, number = counts[n], 0
        while todo:
            at = bisect.bisect_left(gaps, n)
            if at == len(gaps):
                each = capacity // n
                need = -(-todo // each)
                add(capacity, bins, need)
                bins += need
                continue
            gap = gaps[at]
            first, count = free[gap].pop()
            if not free[gap]:
                gaps.pop(at)
            each = gap // n
            take = min(todo, each * count)
            runs.append((n, number, first, each, capacity - gap))
            full, rest = divmod(take, each)
            add(gap - each * n, first, full)
            if rest:
                add(gap - rest * n, first + full, 1)
            add(gap, first + full + (rest > 0), count - full - (rest > 0))
            todo -= take
            number += take
    return runs


def pack(pieces: DataFrame, length_col="length", capacity=CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``, both long; no sequence holds more than ``capacity``, and its
    offsets leave no gap.

    Lengths are at least 1 and at most ``capacity``; others, or a missing one, are an error. Columns of the two names
    are replaced. Repeated rows each get their own place. No rows give no rows.
    """
    names = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    schema = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in names)

    def number(batches):
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in batches:
            own = np.zeros(batch.num_rows, np.int64)
            for i, n in enumerate(batch.column(length_col).to_pylist()):
                if not n or not 0 < n <= capacity:
                    raise ValueError(f"a piece of length {n} does not fit a sequence of {capacity}")
                own[i] = seen[n]
                seen[n] += 1
            columns = [*(batch.column(c) for c in names), pa.array(np.full(len(own), part, np.int64)), pa.array(own)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "__part", "__number"])

    # Written once with its numbers, so it does not matter how later jobs split the table.
    rows = common.staged(common.mapped(pieces.select(*names), number, f"{schema}, __part bigint, __number bigint"),
                         "numbered")
    counts = rows.groupBy("__part", F.col(length_col).cast("bigint").alias("__length")).count()
    totals = {r[0]: r[1] for r in counts.groupBy("__length").agg(F.sum("count")).collect()}
    before = Window.partitionBy("__length").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("__part", "__length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__base"))
    runs = np.array(sorted(plan(totals, capacity)), np.int64).reshape(-1, 5)
    found = rows.withColumn("__length", F.col(length_col).cast("bigint")).join(bases, ["__part", "__length"])
    ranked = found.select(*names, "__length", (F.col("__base") + F.col("__number")).alias("__rank"))

    def place(batches):
        # Runs in order of (length, first number): one search finds the run of each piece.
        order = runs[:, 0] * 2**48 + runs[:, 1]
        for batch in batches:
            n, rank = batch.column("__length").to_numpy(), batch.column("__rank").to_numpy()
            run = runs[np.searchsorted(order, n * 2**48 + rank, "right") - 1]
            rank = rank - run[:, 1]
            columns = [*(batch.column(c) for c in names), pa.array(run[:, 2] + rank // run[:, 3]),
                       pa.array(run[:, 4] + rank % run[:, 3] * n)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "sequence_id", "offset"])

    return common.mapped(ranked, place, f"{schema}, sequence_id bigint, offset bigint")


def packed(df: DataFrame, id_col="doc_id", text_col="text", keep_ids=True, **how) -> DataFrame:
    """Cut and pack the texts. ``ids_crc32`` is the crc32 of a piece's ids; with ``keep_ids`` off, the ids themselves
    are neither staged nor returned."""
    cut = pieces(df, id_col, text_col, **how).withColumn("ids_crc32", F.crc32("ids"))
    return pack(cut if keep_ids else cut.drop("ids"), capacity=how.get("capacity", CAPACITY))
