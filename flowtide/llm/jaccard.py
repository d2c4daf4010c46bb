"""Near duplicates by a Jaccard join in the metric space of shingle sets.

1. Every text becomes the set of its word shingles. Equal sets are one node from here on.
2. A pair that links shares shingles among the first quarter of both sets, in any one order of all shingles; the order
   used has those of rare words first, as unrelated texts hardly share these however many texts there are, and those that
   very many texts have last. Nodes that share one of these get its least node as a pivot; a node that shares too few can
   link with nothing and is done, and so is one that no region joins with another. A node leaves the regions with which
   it shares too little to miss a link there, and those where no other is near it in size. Texts go to the regions, and
   become sets there.
3. A pivot's region is every node that has it as a pivot. A small region is joined in one task: the nodes are pivots in
   turn, the one with the most common shingles first, and a pivot is compared only with nodes whose distance from the
   first one differs by no more than the linking distance (triangle inequality) and that are not yet connected with it.
4. A large region is cut by pivots of its own into Voronoi cells: a node goes to its nearest pivot and, as boundary, to
   every pivot that is at most twice the linking distance farther and within the cell's reach; nodes far from all pivots
   and those on their border form one more cell. Cells are joined in the same way, until they are small. A region that
   its pivots do not divide is cut into blocks, and each two blocks are one small region.
5. Links join nodes to components: rounds of joining every node to its least neighbour.

The join is exact, and a component is found without making all of its pairs.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from . import common

SHINGLE = 5
#: Two sets link from this share of common shingles on, in hundredths.
SHARE = 75
#: Prefixes are longer than they need to be by one in so many of the shingles, and links share so many more of them.
LONGER = 8
#: Nodes and shingles of a region that one task joins; pivots of a larger one; rounds of cells before blocks are made.
REGION, REGION_SHINGLES, PIVOTS, ROUNDS = 2048, 4_000_000, 16, 4
#: Counters of the sketches that tell shingles of very many texts, and rare words: a fixed number, so their size has a
#: bound.
SKETCH, WORDS = 1 << 18, 1 << 16
#: Parts of the sieve for texts that are asked for, and its most bits (32 MB): a fixed number, as above.
SIEVE_PARTS, SIEVE_BITS = 16, 1 << 28
#: Shingles of the prefixes that one bucket takes, and those that a task deals out to the buckets at once.
BUCKET, DEALT = 2_000_000, 1_000_000
ITEM = "region bigint, node bigint, shingles binary"


# --- sets ----------------------------------------------------------------------------------------------------------

def shingle_sets(column, n=SHINGLE) -> list[np.ndarray]:
    """Per text the ascending 64-bit hashes of its runs of ``n`` words (A-Z in lower case); a text of fewer words has
    the whole sequence as its one shingle, a text without words none."""
    return _sets_of(*_words(column), n)


def _sets_of(hashes, first, n) -> list[np.ndarray]:
    runs = common.windows(hashes, n)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(runs[a:b - n + 1]))
        elif b > a:
            out.append(common.windows(hashes[a:b], b - a))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _words(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, and for each text the number of words before it, as ``common.words``."""
    data, offsets = common.buffers(column)
    starts, ends, first = common.words(data, offsets)
    return common.hash_spans(common.lowered(data), starts, ends), first


def node_of(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _sets(n):
    def run(batches):
        for batch in common.slices(batches, "__text"):
            sets = shingle_sets(batch.column("__text"), n)
            node = pa.array([node_of(s) if len(s) else None for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("__id"), batch.column("__th"), pa.array([len(s) for s in sets], pa.int64()), node],
                ["__id", "th", "n_shingles", "node"])

    return run


# --- operator ------------------------------------------------------------------------------------------------------

def components(df: DataFrame, id_col="doc_id", text_col="text", n=SHINGLE, share=SHARE) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the least id that links reach from it, itself included.

    Sets A and B link when 100 |A and B| >= share |A or B|. An empty set (missing, empty or blank text) links with
    nothing, not even with another. Rows that repeat an id or a text each give their row. A missing id is larger than
    all others; a component of missing ids alone has none. Shingles count as equal when their 64-bit hashes are.
    """
    rows = common.texts(df, F.col(id_col).alias("__id"), text=text_col)
    hashed = rows.withColumn("__th", F.xxhash64("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    sets = common.staged(common.mapped(hashed, _sets(n), f"__id {kind}, th bigint, n_shingles bigint, node bigint"),
                         "sets")
    roots = connected(links(rows.select("__text"), sets, n, share))
    joined = sets.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    joined = common.staged(joined.select("__id", "n_shingles", "root"), "rooted")
    least = joined.where("root IS NOT NULL").groupBy("root").agg(F.min("__id").alias("component_id"))
    alone = joined.where("root IS NULL").select("__id", "n_shingles", F.col("__id").alias("component_id"))
    found = joined.where("root IS NOT NULL").join(least, "root").select("__id", "n_shingles", "component_id")
    return found.unionByName(alone).withColumnRenamed("__id", id_col)


def links(texts: DataFrame, sets: DataFrame, n=SHINGLE, share=SHARE) -> DataFrame:
    """Links (a, b) between nodes that connect what the join connects."""
    levels, weights = _sketches(texts, n)
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = max(1, -(-int(total * (100 - share) * 1.15 / 100) // BUCKET))
    shared = _pivots(texts, n, share, levels, weights, buckets)
    shared = common.staged(shared.groupBy("node", "lead").agg(F.sum("c").alias("c")), "pivots")
    nodes = sets.where("node IS NOT NULL").groupBy("node").agg(
        F.first("n_shingles").alias("n"), F.count("*").alias("copies"), F.min("th").alias("th"))
    # A node that could link shares at least so many of its first shingles.
    sums = shared.groupBy("node").agg(F.sum("c").alias("c")).join(nodes, "node")
    need = F.col("copies") * F.expr(_need("n", share))
    able = sums.where(F.col("c") >= need).select("node", "n", "th", need.alias("need"))
    member = _with_partners(common.staged(shared.join(able, "node"), "members"), share)
    member = _without_inner(common.staged(_needed_regions(member), "needed"))
    member = _with_partners(common.staged(member, "outer"), share)
    sizes = member.groupBy("lead").agg(F.count("*").alias("size"), F.sum("n").alias("shingles")).where("size > 1")
    fits = (F.col("size") <= REGION) & (F.col("shingles") <= REGION_SHINGLES)
    member = common.staged(member.join(sizes.select("lead", fits.alias("fits")), "lead"), "regions")
    asked = member.groupBy("th").agg(F.first("node").alias("node"), F.collect_set(F.struct("lead", "fits")).alias("asked"))
    # A task sends one of the copies of a text, packed; these meet sorted by its hash, and one of them goes on. There is a
    # shuffle after the join, so adaptive execution may split a hash; a region takes its nodes once.
    wanted = common.mapped(_maybe_asked(texts, member.select("th")), _packed, "th bigint, packed binary")
    wanted = wanted.join(asked.hint("merge"), "th").select("th", "packed", "node", "asked")
    items = common.mapped(wanted, _items, "region bigint, node bigint, packed binary, fits boolean")
    made = common.staged(_joined(items, share, n), "joined")
    found = [made.where("region IS NULL").select("a", "b")]
    if not member.where(~F.col("fits")).isEmpty():
        left = made.where("region IS NOT NULL").select("region", "node", "shingles")
        for round_ in range(ROUNDS):
            edges, left, undivided = _cells(left, share, round_)
            found += [edges, _edges_of(_blocks(undivided), share)]
            sizes = left.groupBy("region").agg(F.count("*").alias("s"), F.sum(F.length("shingles") / 8).alias("e"))
            small = (F.col("s") <= REGION) & (F.col("e") <= REGION_SHINGLES)
            left = common.staged(left.join(sizes.where("s > 1").select("region", "s", "e", small.alias("small")), "region"),
                                 "cells")
            found.append(_edges_of(left.where("small"), share))
            left = left.where(~F.col("small")).select("region", "node", "shingles", "s", "e")
            if left.isEmpty():
                break
        else:
            found.append(_edges_of(_blocks(left), share))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return common.staged(out.distinct(), "links")


def _maybe_asked(texts: DataFrame, keys: DataFrame) -> DataFrame:
    """``texts`` with ``th``, their hash, without almost all of those whose hash is not among ``keys`` (th): the join that
    follows then sends only texts that are asked for, however many these are."""
    passes = sieve(keys)

    def run(batches):
        for batch in batches:
            keep = passes(batch.column("th"))
            if keep.any():
                yield batch.filter(pa.array(keep))

    hashed = texts.select("__text", F.xxhash64("__text").alias("th"))
    return common.mapped(hashed, run, "__text string, th bigint")


def sifted(rows: DataFrame, th, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows`` in two parts: those whose hash ``th`` is certainly not among ``keys`` (th), and the others, with few
    besides."""
    common.ship(rows.sparkSession)
    passes = sieve(keys)

    @F.arrow_udf("boolean")
    def may_be(hashes: pa.Array) -> pa.Array:
        return pa.array(passes(hashes))

    marked = rows.withColumn("__may", may_be(th))
    return marked.where("NOT __may").drop("__may"), marked.where("__may").drop("__may")


def sieve(keys: DataFrame):
    """What tells of an Arrow array of hashes which may be among ``keys`` (th): a function for tasks, that is true for all
    of these and for almost no others. The sieve is a bitmap of bounded size in which every key has two bits; were it too
    small for the keys, it would be true for more others."""
    bits = min(max(1 << (16 * keys.count()).bit_length(), SIEVE_PARTS * 8), SIEVE_BITS) // SIEVE_PARTS

    def places(th):
        h = common.mix(th.to_numpy().view(np.uint64))
        # Three runs of bits of the hash, which is even.
        part = (h & np.uint64(SIEVE_PARTS - 1)).astype(np.int64)
        return part, [((h >> np.uint64(s)) & np.uint64(bits - 1)).astype(np.int64) for s in (4, 36)]

    def mark(batches):
        made: dict = {}
        for batch in batches:
            part, at = places(batch.column("th"))
            for p in np.unique(part).tolist():
                own = made.setdefault(p, np.zeros(bits, bool))
                for x in at:
                    own[x[part == p]] = True
        yield pa.RecordBatch.from_arrays([
            pa.array(list(made), pa.int32()),
            pa.array([np.packbits(x).tobytes() for x in made.values()], pa.binary())], ["part", "bits"])

    def add(batches):
        made: dict = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("bits").to_pylist()):
                made[part] = made.get(part, np.uint8(0)) | np.frombuffer(data, np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()),
                                          pa.array([x.tobytes() for x in made.values()], pa.binary())], ["part", "bits"])

    schema = "part int, bits binary"
    # Keys are first dealt to a few tasks, as each makes whole parts.
    marks = common.mapped(keys.repartition(SIEVE_PARTS), mark, schema).repartition(SIEVE_PARTS, "part")
    marked = np.zeros((SIEVE_PARTS, bits // 8), np.uint8)
    for part, data in common.mapped(marks, add, schema).collect():
        marked[part] = np.frombuffer(data, np.uint8)
    sent = keys.sparkSession.sparkContext.broadcast(marked)

    def passes(th):
        part, at = places(th)
        keep = np.ones(len(th), bool)
        for x in at:
            keep &= (sent.value[part, x >> 3] >> (7 - (x & 7)).astype(np.uint8) & 1).astype(bool)
        return keep

    return passes


def _with_partners(member: DataFrame, share) -> DataFrame:
    """``member`` (node, lead, n, ...) without the regions in which a node has no other near enough in size to link. Sizes
    of a link are in the same band or in neighbouring ones, as bands are a little wider than its ratio."""
    width = -math.log(share / 100) + 1e-6
    banded = member.withColumn("band", F.floor(F.log("n") / width))
    reach = banded.groupBy("lead", "band").agg(F.count("*").alias("k")).select(
        F.col("lead").alias("l"), F.explode(F.array(*(F.col("band") + i for i in (-1, 0, 1)))).alias("near"), "k")
    reach = reach.groupBy("l", "near").agg(F.sum("k").alias("k")).where("k > 1")
    return banded.join(reach, (F.col("lead") == F.col("l")) & (F.col("band") == F.col("near"))).select(*member.columns)


def _needed_regions(member: DataFrame) -> DataFrame:
    """``member`` (node, lead, c, need, ...) without the regions that a node can do without.

    All regions have one order, in which those come first whose nodes share most with them. A node leaves the last of
    its regions as long as it shares fewer than ``need`` shingles with all it leaves. Of the regions that two nodes have
    in common when they link, the first in order is kept by both: with it and those behind it they share ``need``.
    """
    rank = member.groupBy(F.col("lead").alias("l")).agg(F.avg(F.col("c") / F.col("need")).alias("rank"))
    last_first = Window.partitionBy("node").orderBy("rank", "lead").rowsBetween(Window.unboundedPreceding, 0)
    left = member.join(rank, F.col("lead") == F.col("l")).withColumn("behind", F.sum("c").over(last_first))
    return left.where("behind >= need").select("node", "lead", "n", "th")


def _without_inner(member: DataFrame) -> DataFrame:
    """``member`` (node, lead, ...) without the regions all of whose nodes also lie in the region of the least pivot of
    their own pivot: what they would join is joined there."""
    outer = member.groupBy("node").agg(F.min("lead").alias("outer")).where("outer < node").select(
        F.col("node").alias("lead"), "outer")
    there = member.select(F.col("node").alias("x"), F.col("lead").alias("l"))
    both = member.select("node", "lead").join(outer, "lead").join(
        there, (F.col("node") == F.col("x")) & (F.col("outer") == F.col("l")), "left")
    inner = both.groupBy("lead").agg(F.count("*").alias("s"), F.count("l").alias("c")).where("s = c").select("lead")
    return member.join(inner, "lead", "left_anti")


def _need(n, share):
    return f"1 + ceil({n} * {share} / 100) div {LONGER}"


# --- pivots --------------------------------------------------------------------------------------------------------

def _sketches(texts: DataFrame, n) -> tuple[np.ndarray, np.ndarray]:
    """For each counter of a sketch of shingles over all texts, how far the number of texts that have one of its shingles
    exceeds the usual number: 0, or the logarithm. And for each counter of one of words the logarithm, in eighths, of how
    often its words occur."""
    parts = 16
    both = SKETCH + WORDS
    width = both // parts

    def count(batches):
        total = np.zeros(both, np.int64)
        for batch in common.slices(batches, "__text"):
            hashes, first = _words(batch.column("__text"))
            shingles = np.concatenate(_sets_of(hashes, first, n)) % np.uint64(SKETCH)
            words = hashes % np.uint64(WORDS) + np.uint64(SKETCH)
            total += np.bincount(np.concatenate([shingles, words]).astype(np.int64), minlength=both)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(parts, dtype=np.int32)),
            pa.array([total[i:i + width].tobytes() for i in range(0, both, width)], pa.binary())], ["part", "n"])

    def add(batches):
        total: dict = {}
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("n").to_pylist()):
                total[part] = total.get(part, 0) + np.frombuffer(data, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()),
                                          pa.array([x.tobytes() for x in total.values()], pa.binary())], ["part", "n"])

    schema = "part int, n binary"
    summed = common.mapped(common.mapped(texts, count, schema).repartition(parts, "part"), add, schema)
    total = np.zeros(both)
    for part, data in summed.collect():
        total[part * width:(part + 1) * width] = np.frombuffer(data, np.int64)
    shingles, words = total[:SKETCH], total[SKETCH:]
    usual = max(shingles.mean(), 1)
    return (np.floor(np.log2(np.maximum(shingles / (4 * usual), 1))).astype(np.int8),
            np.round(8 * np.log2(1 + words)).astype(np.int32))


def _prefixes(column, n, share, levels, weights) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each text with words its node and the shingles by which its set is found, with their levels: all links of the
    set share ``_need`` of them. Shingles are ordered by level, by how often their words occur, and by hash. That is one
    order of all shingles, as equal ones have equal words."""
    hashes, first = _words(column)
    runs = common.windows(hashes, n)
    sums = np.concatenate([[0], np.cumsum(weights[(hashes % np.uint64(WORDS)).astype(np.int64)])])
    sums = sums[n:] - sums[:-n] if len(sums) > n else sums[:0]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a < n:
            if b > a:
                shingles = common.windows(hashes[a:b], b - a)
                out.append((node_of(shingles), shingles, levels[(shingles % np.uint64(SKETCH)).astype(np.int64)]))
            continue
        shingles, place = np.unique(runs[a:b - n + 1], return_index=True)
        size = len(shingles)
        keep = size - -(-size * share // 100) + 1 + size // LONGER
        level = levels[(shingles % np.uint64(SKETCH)).astype(np.int64)]
        order = np.argsort(level.astype(np.int64) << 32 | sums[a + place], kind="stable")[:keep]
        out.append((node_of(shingles), shingles[order], level[order]))
    return out


def _pivots(texts: DataFrame, n, share, levels, weights, buckets) -> DataFrame:
    """(node, lead, c): the node shares ``c`` of its first shingles with others, of whom ``lead`` is the least.

    A task sends rows to each bucket of shingles, each for very many of them. Shingles that very many texts have go
    another way, by partial sums, so that no bucket grows with one of them.
    """
    sent = texts.sparkSession.sparkContext.broadcast((levels, weights))

    def prefixes(batches):
        held, size = [], 0
        for batch in common.slices(batches, "__text"):
            found = _prefixes(batch.column("__text"), n, share, *sent.value)
            if found:
                nodes, s, level = zip(*found)
                held.append((np.concatenate(s), np.repeat(np.array(nodes, np.int64), [len(x) for x in s]),
                             np.concatenate(level) > 0))
                size += len(held[-1][0])
            if size >= DEALT:
                yield tuple(np.concatenate(x) for x in zip(*held))
                held, size = [], 0
        if held:
            yield tuple(np.concatenate(x) for x in zip(*held))

    def many(batches):
        for s, own, hot in prefixes(batches):
            yield pa.RecordBatch.from_arrays([pa.array(s[hot].view(np.int64)), pa.array(own[hot])], ["hot", "node"])

    def split(batches):
        for s, own, hot in prefixes(batches):
            s, own = s[~hot], own[~hot]
            bucket = (s >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(buckets + 1))
            s, own = s[order].astype(np.uint32), own[order]
            used = np.flatnonzero(np.diff(cut))
            places, names = [], []
            for b in used:
                some, place = np.unique(own[cut[b]:cut[b + 1]], return_inverse=True)
                places.append(place.astype(np.uint32).tobytes() if len(some) > 65535 else place.astype(np.uint16).tobytes())
                names.append(some.tobytes())
            yield pa.RecordBatch.from_arrays([
                pa.array(used, pa.int64()), pa.array([s[cut[b]:cut[b + 1]].tobytes() for b in used], pa.binary()),
                pa.array(places, pa.binary()), pa.array(names, pa.binary())], ["bucket", "s", "place", "nodes"])

    def meet(batches):
        held, last = [], None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "s", "place", "nodes"))):
                if row[0] != last and held:
                    yield _met(held)
                    held = []
                last = row[0]
                held.append(row[1:])
        if held:
            yield _met(held)

    cold = common.mapped(texts, split, "bucket bigint, s binary, place binary, nodes binary")
    cold = cold.repartition(max(buckets, _partitions(texts)), "bucket").sortWithinPartitions("bucket")
    pairs = common.mapped(cold, meet, "node bigint, lead bigint, c bigint")
    if not levels.any():
        return pairs
    hot = common.staged(common.mapped(texts, many, "hot bigint, node bigint"), "frequent")
    leads = hot.groupBy("hot").agg(F.min("node").alias("lead"), F.max("node").alias("top")).where("lead < top")
    leads = leads.select(F.col("hot").alias("h"), "lead")
    common_ = hot.join(leads, F.col("hot") == F.col("h")).groupBy("node", "lead").agg(F.count("*").alias("c"))
    return pairs.unionByName(common_)


def _partitions(df):
    spark = df.sparkSession
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def _met(held):
    s = np.frombuffer(b"".join(x[0] for x in held), np.uint32)
    node = np.concatenate([
        np.frombuffer(names, np.int64)[np.frombuffer(place, np.uint16 if len(place) * 2 == len(x) else np.uint32)]
        for x, place, names in held])
    order = np.argsort(s, kind="stable")
    s, node = s[order], node[order]
    head = np.concatenate([[0], np.flatnonzero(s[1:] != s[:-1]) + 1])
    least, most = np.minimum.reduceat(node, head), np.maximum.reduceat(node, head)
    size = np.diff(np.append(head, len(s)))
    keep = np.repeat(least < most, size)
    node, lead = node[keep], np.repeat(least, size)[keep]
    order = np.lexsort((lead, node))
    node, lead = node[order], lead[order]
    head = np.flatnonzero(np.concatenate([[True], (node[1:] != node[:-1]) | (lead[1:] != lead[:-1])])) if len(node) else []
    c = np.diff(np.append(head, len(node))).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(node[head], pa.int64()), pa.array(lead[head], pa.int64()), pa.array(c)],
                                      ["node", "lead", "c"])


# --- regions -------------------------------------------------------------------------------------------------------

def _packed(batches):
    """Texts with their hash, compressed, as they are sent twice; a task sends copies of a text once."""
    codec, seen = pa.Codec("zstd", 1), set()
    for batch in common.slices(batches, "__text"):
        if len(seen) > 1_000_000:  # more copies go then, and are left out later
            seen.clear()
        names, out = [], []
        for th, text in zip(batch.column("th").to_pylist(), batch.column("__text").to_pylist()):
            if th not in seen:
                seen.add(th)
                data = text.encode()
                names.append(th)
                out.append(len(data).to_bytes(8, "little") + codec.compress(data, asbytes=True))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(out, pa.binary())], ["th", "packed"])


def _unpacked(packed) -> pa.Array:
    codec = pa.Codec("zstd", 1)
    return pa.array([codec.decompress(memoryview(x)[8:], int.from_bytes(x[:8], "little"), asbytes=True).decode()
                     for x in packed.to_pylist()], pa.string())


def _items(batches):
    """A row for each region that asks for a text; copies of it follow each other, and the first one is taken."""
    last = None
    for batch in common.slices(batches, "packed", 500_000):
        rows = []
        for th, packed, node, asked in zip(*(batch.column(c).to_pylist() for c in ("th", "packed", "node", "asked"))):
            if th != last:
                rows += [(a["lead"], node, packed, a["fits"]) for a in asked]
            last = th
        for i in range(0, len(rows), 256):
            columns = zip(*rows[i:i + 256])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.bool_()))],
                ["region", "node", "packed", "fits"])


def _as_sets(batches, n):
    """Rows with a packed text as rows with its shingles."""
    for batch in common.slices(batches, "packed", 250_000):
        data = pa.array([s.tobytes() for s in shingle_sets(_unpacked(batch.column("packed")), n)], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("region"), batch.column("node"), data, batch.column("fits")],
                                         ["region", "node", "shingles", "fits"])


def _joined(items: DataFrame, share, n=None) -> DataFrame:
    """Links (a, b) within the regions that fit, and the rows of the others as they are; a task sees the regions one
    after another, and rows that are only passed on are dealt evenly. With ``n`` rows have packed texts, which become sets
    here: a text is a fraction of its set."""
    def run(batches):
        held, last, out = [], None, []
        for batch in batches if n is None else _as_sets(batches, n):
            aside = batch.filter(pc.invert(batch.column("fits"))).select(["region", "node", "shingles"])
            if aside.num_rows:
                none = pa.nulls(aside.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, *aside.columns], ["a", "b", "region", "node", "shingles"])
            batch = batch.filter(batch.column("fits"))
            for row in zip(*(batch.column(c).to_pylist() for c in ("region", "node", "shingles"))):
                if row[0] != last and held:
                    out += region_links(held, share)
                    held = []
                    if len(out) > 10_000:
                        yield _edges(out)
                        out = []
                last = row[0]
                held.append(row[1:])
        yield _edges(out + (region_links(held, share) if held else []))

    deal = F.when(F.col("fits"), F.col("region")).otherwise(F.col("node"))
    dealt = items.withColumn("deal", deal).repartition("deal").sortWithinPartitions("region").drop("deal")
    return common.mapped(dealt, run, f"a bigint, b bigint, {ITEM}")


def _edges_of(items: DataFrame, share) -> DataFrame:
    rows = items.select("region", "node", "shingles", F.lit(True).alias("fits"))
    return _joined(rows, share).select("a", "b")


def _edges(pairs):
    a, b = zip(*pairs) if pairs else ((), ())
    none = pa.nulls(len(a), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), none, none,
                                       pa.nulls(len(a), pa.binary())], ["a", "b", "region", "node", "shingles"])


def region_links(rows, share) -> list[tuple[int, int]]:
    """Links that connect what all links of the rows (node, shingles as bytes) would connect."""
    unique = dict(rows)
    nodes = list(unique)
    sets = [np.frombuffer(x, np.uint64) for x in unique.values()]
    size = np.array([len(s) for s in sets], np.int64)
    if len(nodes) == 2:
        both = len(np.intersect1d(*sets, assume_unique=True))
        return [(nodes[0], nodes[1])] if 100 * both >= share * (size.sum() - both) else []
    flat = np.concatenate(sets)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    start = np.concatenate([[0], np.cumsum(size)])
    mark = np.zeros(len(count), bool)

    def inter(i):
        own = code[start[i]:start[i + 1]]
        mark[own] = True
        both = np.add.reduceat(mark[code].astype(np.int64), start[:-1])
        mark[own] = False
        return both

    # The node with the most common shingles first: the others connect to it soon.
    order = np.argsort(-np.add.reduceat(count[code], start[:-1]) / size, kind="stable")
    label, todo, out = np.arange(len(nodes)), np.ones(len(nodes), bool), []
    far = None
    for i in order:
        todo[i] = False
        near = todo & (label != label[i]) & (100 * size >= share * size[i]) & (100 * size[i] >= share * size)
        if far is not None:
            near &= np.abs(far - far[i]) <= 1 - share / 100 + 1e-9
        if far is not None and not near.any():
            continue
        both = inter(i)
        union = size + size[i] - both
        if far is None:
            far = 1 - both / union
        for j in np.flatnonzero(near & (100 * both >= share * union)):
            if label[j] != label[i]:
                out.append((nodes[i], nodes[j]))
                label[label == label[j]] = label[i]
    return out


def _cells(items: DataFrame, share, round_):
    """Links with pivots of large regions; the cells that are left to join; and the rows of regions that their pivots do
    not divide, with the region's nodes ``s`` and shingles ``e``: their cells would have over half as many pairs."""
    items = common.staged(items.select("region", "node", "shingles"), "large")
    slot = F.pmod(F.xxhash64("node", F.lit(round_)), F.lit(PIVOTS))
    chosen = items.groupBy("region", slot.alias("slot")).agg(
        F.min_by(F.struct("node", "shingles"), F.xxhash64("node", "region")).alias("pivot"))
    chosen = chosen.groupBy("region").agg(F.collect_list("pivot").alias("pivots"))
    far = 1 - share / 100

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out = []
                known: dict = {}
                for region, node, data, pivots in zip(*(part.column(c).to_pylist() for c in (
                        "region", "node", "shingles", "pivots"))):
                    if region not in known:
                        known[region] = [(p["node"], np.frombuffer(p["shingles"], np.uint64))
                                         for p in sorted(pivots, key=lambda p: p["node"])]
                    own = np.frombuffer(data, np.uint64)
                    both = [len(np.intersect1d(own, s, assume_unique=True)) for _, s in known[region]]
                    union = [len(own) + len(s) - b for b, (_, s) in zip(both, known[region])]
                    d = np.array([1 - b / u for b, u in zip(both, union)])
                    tied = [p for (p, _), b, u in zip(known[region], both, union) if 100 * b >= share * u and p != node]
                    out += [(None, node, None, p, None, None, region) for p in tied]
                    if any(p == node for p, _ in known[region]):
                        continue  # a pivot has met all of its region
                    home = int(d.argmin())
                    for j in range(len(d)):
                        # A cell reaches to twice the linking distance; its boundary is once more as wide.
                        if (j == home and d[j] <= 2 * far) or (
                                j != home and d[j] <= min(d[home] + 2 * far, 3 * far) + 1e-9):
                            out.append((_cell(region, known[region][j][0]), node, data, None, d[j], bool(d[j] > far),
                                        region))
                    if d[home] > far:
                        out.append((_cell(region, 0), node, data, None, d[home], True, region))
                for i in range(0, len(out), 1024):
                    columns = zip(*out[i:i + 1024])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.int64(),
                                                                  pa.float64(), pa.bool_(), pa.int64()))],
                        ["region", "node", "shingles", "pivot", "d", "outer", "parent"])

    made = common.staged(common.mapped(items.join(chosen, "region"), run,
                                       ITEM + ", pivot bigint, d double, outer boolean, parent bigint"), "met")
    edges = made.where("pivot IS NOT NULL").select(F.col("node").alias("a"), F.col("pivot").alias("b"))
    cells = made.where("pivot IS NULL")
    # Nodes within the linking distance of the pivot are connected by it: they are needed only near those beyond it.
    edge = cells.where("outer").groupBy("region").agg(F.min("d").alias("nearest"))
    left = cells.join(edge, "region").where(F.col("outer") | (F.col("d") >= F.col("nearest") - far - 1e-9))
    pairs = left.groupBy("parent", "region").agg(F.count("*").alias("c")).groupBy("parent").agg(
        F.sum(F.col("c").cast("double") * F.col("c")).alias("pairs"))
    whole = items.groupBy("region").agg(F.count("*").alias("s"), F.sum(F.length("shingles") / 8).alias("e"))
    undivided = whole.join(pairs, F.col("region") == F.col("parent")).where(
        2 * F.col("pairs") > F.col("s").cast("double") * F.col("s")).select("region", "s", "e")
    left = left.join(undivided.select(F.col("region").alias("parent")), "parent", "left_anti")
    return edges, left.select("region", "node", "shingles"), items.join(undivided, "region")


def _cell(region, pivot):
    return int.from_bytes(hashlib.blake2b(f"{region}/{pivot}".encode(), digest_size=8).digest(), "little", signed=True)


def _blocks(left: DataFrame) -> DataFrame:
    """Every two blocks of a region as a small region of its own: exact for regions that no pivots divide."""
    half, shingles = REGION // 2, REGION_SHINGLES // 2
    number = F.greatest(F.lit(2), F.ceil(F.col("s") * 1.3 / half).cast("int"),
                        F.ceil(F.col("e") * 1.3 / shingles).cast("int"))
    rows = left.withColumn("b", F.pmod(F.xxhash64("node", F.lit(9)), F.col("s") * 0 + number).cast("int")).withColumn("k", number)
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    rows = rows.withColumn("o", other)
    pair = F.xxhash64("region", F.least("b", "o"), F.greatest("b", "o"))
    return rows.where((F.col("b") != F.col("o")) | (F.col("k") == 1)).select(pair.alias("region"), "node", "shingles")


# --- components ----------------------------------------------------------------------------------------------------

def connected(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for all nodes of ``edges`` (a, b)."""
    pairs = common.staged(edges.where("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "star")
    before = None
    while True:
        # Every neighbour joins the least neighbour, then every node joins its least smaller one.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), F.least("u", "m").alias("m"))
        big = both.join(least, F.col("u") == F.col("w")).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        big = common.staged(big.where("u <> v").distinct(), "star")
        least = big.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("w"), "m")
        small = big.join(least, F.col("u") == F.col("w"))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select(F.col("w").alias("u"), F.col("m").alias("v")))
        pairs = common.staged(small.where("u <> v").distinct(), "star")
        state = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots
