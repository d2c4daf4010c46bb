"""Source divergence audit: how the sources of a language differ in their use of its terms.

One translation of a text's bytes lowers A-Z and blanks whatever separates terms; split and a counter per document give
the term frequencies, summed in the task per language and source before anything is shuffled. One shuffle by language and
term gives the counts of all sources and the number of documents; terms of too few documents end there.

The table of counts stays sparse. Share p belongs to a count, p0 to a term that a source lacks, and the divergence of two
sources s and t is the sum of f(p, q) over the V terms of their language, which is

    V f(p0_s, p0_t)  +  sum over terms of s of f(p_s, p0_t) - f(p0_s, p0_t)  +  the same for t
    +  sum over terms of both of f(p_s, p_t) - f(p_s, p0_t) - f(p0_s, p_t) + f(p0_s, p0_t).

The second sum needs only how many terms of a source have each share; the last one takes every term's own sources.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from . import common

#: Documents of a language that must hold a term; ranks of terms per group.
LEAST_DOCS, RANKS = 10, 10
#: Shares are parts of so many.
PARTS = 1_000_000_000
#: Entries that a task holds before it hands them on, bytes split at once, pairs of shares handled at once.
HELD, PIECE, PAIRS = 400_000, 1 << 20, 1 << 20

#: One byte to one byte: A-Z to lower case, other ASCII that is no letter to a blank, the rest (UTF-8) as it is.
TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c < 128 and not 97 <= c <= 122 else c for c in range(256))


def term_counts(df: DataFrame, lang_col="lang", source_col="source", text_col="text") -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` (occurrences) and ``docs`` (rows that hold it), partly summed: a term may
    have several rows. Missing values count as empty."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    source = common.texts(df, blank(lang_col).alias("__lang"), blank(source_col).alias("__source"), text=text_col)

    def run(batches):
        held, entries = {}, 0
        for batch in common.slices(batches, "__text"):
            group = zip(batch.column("__lang").to_pylist(), batch.column("__source").to_pylist())
            for key, text in zip(group, batch.column("__text")):
                counts, docs = held.setdefault(key, (Counter(), Counter()))
                entries -= len(counts)
                own = _document(text.as_buffer().to_pybytes())
                counts.update(own)
                docs.update(own.keys())
                entries += len(counts)
                if entries > HELD:
                    yield from _rows(held)
                    held, entries = {}, 0
        yield from _rows(held)

    return common.mapped(source, run, "lang string, source string, term string, n bigint, docs bigint")


def _document(data: bytes) -> Counter:
    """Counts of the terms of one text; a long one is split piece by piece, at blanks."""
    data = data.translate(TABLE)
    if len(data) <= PIECE:
        return Counter(data.split())
    own, start = Counter(), 0
    while start < len(data):
        stop = data.find(b" ", start + PIECE)
        stop = len(data) if stop < 0 else stop
        own.update(data[start:stop].split())
        start = stop
    return own


def _rows(held):
    for (lang, source), (counts, docs) in held.items():
        terms = list(counts)
        for i in range(0, len(terms), 50_000):
            some = terms[i:i + 50_000]
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()),
                pa.array(some, pa.binary()).cast(pa.string()), pa.array([counts[t] for t in some], pa.int64()),
                pa.array([docs[t] for t in some], pa.int64())], ["lang", "source", "term", "n", "docs"])


def audit(df: DataFrame, lang_col="lang", source_col="source", text_col="text", least_docs=LEAST_DOCS, ranks=RANKS
          ) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank``: for each (lang, source) that occurs, how far each
    other source of the language diverges from it (part ``pair``, all of them), and by which terms it exceeds its
    language the most (part ``term``, to rank ``ranks``).

    Terms are runs of letters A-Z (lowered) and characters beyond ASCII. A language keeps those that at least
    ``least_docs`` of its rows hold: V terms. With N occurrences of these in a group or language, a term that occurs c
    times there has the share 1 + floor(10^9 (c + 2) / (N + 2 V)); two shares p and q differ by
    floor((p - q)^2 / (p + q)), and two sources by the sum over all V terms (0 without any). Part ``term`` has the terms
    that occur in the group with a share above the language's. Larger values come first, equal ones by item in UTF-8
    order. Missing text, language and source count as empty; every row is a document, also one that repeats another.
    Groups without terms have pairs. An empty table gives no rows.
    """
    blank = lambda c, name: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name)
    groups = df.select(blank(lang_col, "lang"), blank(source_col, "source")).distinct()
    # Partitioned by language and term, which serves both groupings. A task's rows are summed already.
    parts = term_counts(df, lang_col, source_col, text_col).repartition("lang", "term")
    sums = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = sums.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("uses"))
    terms = common.staged(terms.where(F.col("docs") >= least_docs).select("lang", "term", "total", "uses"), "terms")
    uses = terms.select("lang", "term", "total", F.inline("uses"))

    langs = terms.groupBy("lang").agg(F.count("*").alias("v"), F.sum("total").alias("all_n"))
    sizes = uses.groupBy("lang", "source").agg(F.sum("n").alias("own_n"))
    groups = groups.join(langs, "lang", "left").join(sizes, ["lang", "source"], "left").select(
        "lang", "source", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("v", "all_n", "own_n")))
    groups = groups.withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0), "own_n", "v")))
    numbered = groups.withColumn("s", F.row_number().over(Window.partitionBy("lang").orderBy("source")))
    groups = common.staged(numbered, "groups")
    shares = common.staged(uses.join(groups, ["lang", "source"]).select(
        "lang", "source", "s", "term", share("n", "own_n", "v").alias("p"), share("total", "all_n", "v").alias("q"), "p0"),
        "shares")
    return _pairs(groups, shares).unionByName(_terms(shares, ranks))


def share(count, total, v):
    """1 + floor(10^9 (count + 2) / (total + 2 v)); in wide decimals where 64 bits do not hold the product."""
    count, total, v = (F.col(c) if isinstance(c, str) else c.cast("bigint") for c in (count, total, v))
    fits = count < 2**63 // PARTS - 2
    low = F.call_function("div", (count + 2) * F.lit(PARTS).cast("bigint"), total + 2 * v)
    wide = F.call_function("div", (count + 2).cast("decimal(20,0)") * F.lit(PARTS).cast("decimal(10,0)"),
                           (total + 2 * v).cast("decimal(20,0)"))
    return F.when(fits, low).otherwise(wide) + 1


def gap(p, q):
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so the square fits 64 bits."""
    p, q = F.col(p), F.col(q)
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    one = groups.select("lang", F.col("s").alias("a"), F.col("source").alias("item"), "p0", "v")
    two = groups.select("lang", F.col("s").alias("b"), "source", F.col("p0").alias("q0"))
    # Every two sources of a language are rows of the result.
    both = one.join(two, "lang").where("a <> b")
    base = both.where("v > 0 AND a < b").select("lang", "a", "b", (F.col("v") * gap("p0", "q0")).alias("value"))
    # How many terms of a source have each share; against the sources' shares of a term they lack.
    tally = shares.groupBy("lang", F.col("s").alias("a"), "p", "p0").agg(F.count("*").alias("k"))
    lacking = tally.join(two, "lang").where("a <> b").select(
        "lang", F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
        (F.col("k") * (gap("p", "q0") - gap("p0", "q0"))).alias("value"))
    lists = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("s", "p", "p0")).alias("uses"))
    common_terms = common.mapped(lists.where(F.size("uses") > 1).select("lang", "uses"), _both,
                                 "lang string, a int, b int, value bigint")
    values = base.unionByName(lacking).unionByName(common_terms).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    low, high = F.least("a", "b"), F.greatest("a", "b")
    found = both.select("lang", "source", "item", low.alias("a"), high.alias("b")).join(values, ["lang", "a", "b"], "left")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = found.withColumn("value", F.coalesce("value", F.lit(0)))
    return found.select("lang", "source", F.lit("pair").alias("part"), "item", "value",
                        F.row_number().over(order).alias("rank"))


def _terms(shares: DataFrame, ranks: int) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    above = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         gap("p", "q").alias("value"))
    # Spark keeps the first ranks of every task before it shuffles.
    return above.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)


def _both(batches):
    """Sums over the terms that two sources share, per language and pair, flushed while they are many."""
    held = {}
    for batch in batches:
        uses = batch.column("uses")
        ends = uses.offsets.to_numpy() - uses.offsets.to_numpy()[0] if len(uses) else np.zeros(1, np.int64)
        flat = uses.flatten()
        s, p, p0 = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(3))
        langs = np.array(batch.column("lang").to_pylist(), object)
        size = np.diff(ends)
        for lang in dict.fromkeys(langs):
            of = langs == lang
            for d in np.unique(size[of]).tolist():
                starts = ends[:-1][of & (size == d)]
                for i, j, value in _chunks(starts, d, s, p, p0):
                    a, b = np.minimum(i, j), np.maximum(i, j)
                    key, place = np.unique(a << 32 | b, return_inverse=True)
                    sums = np.zeros(len(key), np.int64)
                    np.add.at(sums, place, value)
                    held.setdefault(lang, []).append((key, sums))
        if sum(len(k) for parts in held.values() for k, _ in parts) > PAIRS:
            yield from _summed(held)
            held = {}
    yield from _summed(held)


def _chunks(starts, d, s, p, p0):
    """Sources and values of all pairs within each run of ``d`` uses, a bounded number at a time."""
    rows = max(1, PAIRS // (d * d))
    for k in range(0, len(starts), rows):
        some = starts[k:k + rows]
        step = max(1, PAIRS // (d * len(some)))
        for first in range(0, d - 1, step):
            x, y = np.nonzero(np.arange(first, min(first + step, d - 1))[:, None] < np.arange(d))
            i, j = (some[:, None] + (x + first)).ravel(), (some[:, None] + y).ravel()
            value = _gap(p[i], p[j]) - _gap(p[i], p0[j]) - _gap(p0[i], p[j]) + _gap(p0[i], p0[j])
            yield s[i], s[j], value


def _gap(p, q):
    return (p - q) ** 2 // (p + q)


def _summed(held):
    for lang, parts in held.items():
        key, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        sums = np.zeros(len(key), np.int64)
        np.add.at(sums, place, np.concatenate([v for _, v in parts]))
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(key), pa.string()), pa.array(key >> 32, pa.int32()), pa.array(key & 0xFFFFFFFF, pa.int32()),
            pa.array(sums)], ["lang", "a", "b", "value"])
