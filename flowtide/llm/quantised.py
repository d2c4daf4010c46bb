"""Embedding near-duplicates by product quantisation with inverted lists and an exact cosine rerank.

1. Vectors are scaled to length 1, where a cosine of at least c is a distance of at most r = sqrt(2 - 2c). Equal vectors
   of one label are one node from here on.
2. A coarse quantiser (k-means on a bounded sample) gives each node its inverted list. What remains is cut into subspaces,
   and each part is replaced by the number of the nearest entry of that subspace's codebook. The node keeps the length of
   what the codes leave out.
3. A node probes the lists whose border (the bisecting plane of both coarse centres) is at most r / 2 away. Two linked
   nodes of two lists are at most r apart, and so are their distances to the border together: one of them probes the
   other's list, and no link is lost.
4. In a list, a table of squared distances from the probing vector to all codebook entries gives its distance to every
   code. Those within r, codes' error allowed for, are compared by their exact cosine in double precision.
5. Links are counted where they are found, and only as many go on as keep the same nodes connected; rounds of joining
   every node to its least neighbour give the components.

Probing and codes only leave out pairs that cannot link, so all links are found. Lists are dealt out in blocks of bounded
size, each two blocks to one task, so a list or a group of near copies may hold any share of the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common
from .jaccard import connected

LEAST_COSINE = 0.93
#: Nodes that the quantisers are fitted on, about; rounds of k-means; most inverted lists.
SAMPLE, ROUNDS, LISTS = 16_384, 8, 1024
#: Subspaces and codebook entries of each.
PARTS, CODES = 8, 256
#: Nodes of a list, and nodes that probe it, that one task takes.
BLOCK, PROBES = 2048, 8192
#: Room for rounding in distances of vectors of length 1.
ROOM = 1e-6

NODE = "node bigint, copies bigint, label string, v {}, list int, probes array<int>, codes binary, left double"
FOUND = "a bigint, b bigint, n bigint"


def valid(vector):
    """Whether a vector has a direction: not missing, no component missing or not finite, not zero."""
    fine = F.forall(vector, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & fine & F.exists(vector, lambda e: e != 0), F.lit(False))


def near_duplicates(df: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label", least=LEAST_COSINE
                    ) -> DataFrame:
    """Per row: the id, ``n_links`` (other rows linked directly), ``component_id`` (least id that links reach, its own
    included) and ``kept`` (its id is the component's).

    Rows link when their labels are equal and not null and the cosine of their vectors is at least ``least``. A vector
    that is missing, empty or zero, or holds a component that is missing or not finite, links with nothing, nor do
    vectors of different lengths. Rows that repeat an id or a vector each give their row and link like others. A missing
    id is larger than all others; a component of missing ids alone has none and keeps them. Other columns are dropped.
    """
    kind = df.schema[id_col].dataType.simpleString()
    # Single precision stays so: it is half as much to send, and the same numbers.
    v = F.col(vector_col)
    if df.schema[vector_col].dataType.simpleString() != "array<float>":
        v = v.cast("array<double>")
    plain = df.select(F.col(id_col).alias("__id"), v.alias("v"), F.col(label_col).cast("string").alias("label"))
    able = valid(F.col("v")) & F.col("label").isNotNull()
    # Two hashes name a node: 128 bits.
    hashes = [F.when(able, F.xxhash64(F.lit(i), "label", "v")).alias(f"h{i}") for i in (1, 2)]
    rows = common.staged(plain.select("__id", "label", "v", *hashes), "vectors")
    distinct = rows.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first("v").alias("v"), F.count("*").alias("copies"))
    nodes = common.staged(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes")
    found = common.staged(links(nodes.select("node", "copies", "label", "v"), least), "links")
    counts = found.where("b IS NULL").groupBy("a").agg(F.sum("n").alias("n"))
    roots = connected(found.where("b IS NOT NULL").select("a", "b"))
    known = nodes.select("h1", "h2", "node", "copies").join(counts, F.col("node") == F.col("a"), "left").join(
        roots, "node", "left").select("h1", "h2", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                                      F.coalesce("root", "node").alias("root"))
    placed = common.staged(rows.where("h1 IS NOT NULL").select("__id", "h1", "h2").join(known, ["h1", "h2"]), "placed")
    ids = placed.groupBy("root").agg(F.min("__id").alias("component_id"))
    linked = placed.join(ids, "root").select("__id", "n_links", "component_id")
    alone = rows.where("h1 IS NULL").select("__id", F.lit(0).cast("bigint").alias("n_links"), F.col("__id").alias("component_id"))
    out = linked.unionByName(alone).withColumn("kept", F.col("__id").eqNullSafe(F.col("component_id")))
    return out.select(F.col("__id").cast(kind).alias(id_col), "n_links", "component_id", "kept")


def links(nodes: DataFrame, least=LEAST_COSINE) -> DataFrame:
    """From ``node``, ``copies``, ``label`` and ``v``: rows (a, null, n) that add up to the number of copies of other
    nodes that link with a, and rows (a, b, null) whose links connect what all links connect."""
    spark = nodes.sparkSession
    reach = float(np.sqrt(max(0.0, 2 - 2 * least)))
    spaces = {r.width: r.n for r in nodes.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n")).collect()}
    out = spark.createDataFrame([], FOUND)
    for width, n in spaces.items():
        some = nodes.where(F.size("v") == width)
        model = spark.sparkContext.broadcast(fitted(some, n))
        kind = NODE.format(nodes.schema["v"].dataType.simpleString())
        coded = common.staged(common.mapped(some, _coder(model, reach), kind), "codes")
        out = out.unionByName(_compared(coded, model, least, reach))
    return out


# --- quantisers ----------------------------------------------------------------------------------------------------

def fitted(nodes: DataFrame, n: int):
    """Coarse centres and a codebook for each subspace, from about ``SAMPLE`` nodes, drawn by their number's hash. The
    number of lists grows with the root of the number of nodes; the bound only sets how long lists get."""
    share = min(1.0, SAMPLE / n)
    some = nodes.where(F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1_000_000)) < share * 1_000_000)
    drawn = some.select("v").toArrow()["v"]
    if not len(drawn):
        drawn = nodes.select("v").limit(1).toArrow()["v"]
    unit = _unit(_matrix(drawn))
    lists = int(min(LISTS, max(1, np.sqrt(n) / 4)))
    coarse = _means(unit, lists)
    left = unit - coarse[_near(unit, coarse)]
    cuts = np.linspace(0, unit.shape[1], min(PARTS, unit.shape[1]) + 1).astype(int)
    return coarse, cuts, [_means(left[:, a:b], CODES) for a, b in zip(cuts[:-1], cuts[1:])]


def _means(x, k):
    """At most ``k`` centres by k-means, begun at rows picked at random."""
    rng = np.random.default_rng(7)
    centres = np.unique(x[rng.permutation(len(x))[:k]], axis=0)
    for _ in range(ROUNDS):
        own = _near(x, centres)
        count = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def _squared(x, centres):
    return np.maximum((x * x).sum(1)[:, None] - 2 * (x @ centres.T) + (centres * centres).sum(1), 0)


def _near(x, centres):
    return np.concatenate([_squared(x[i:i + 4096], centres).argmin(1) for i in range(0, len(x), 4096)])


def _coder(model, reach):
    def run(batches):
        coarse, cuts, books = model.value
        apart = np.sqrt(_squared(coarse, coarse))
        np.fill_diagonal(apart, 1)
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                piece = batch.slice(start, 4096)
                unit = _unit(_matrix(piece.column("v")))
                square = _squared(unit, coarse)
                own = square.argmin(1)
                at = np.arange(len(unit))
                border = (square - square[at, own][:, None]) / (2 * np.maximum(apart[own], 1e-12))
                row, lists = np.nonzero(border <= reach / 2 + ROOM)
                ends = np.searchsorted(row, np.arange(len(unit) + 1)).astype(np.int32)
                left = unit - coarse[own]
                codes = np.empty((len(unit), len(books)), np.uint8)
                for i, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                    codes[:, i] = _near(left[:, a:b], books[i])
                    left[:, a:b] -= books[i][codes[:, i]]
                yield pa.RecordBatch.from_arrays([
                    *(piece.column(c) for c in ("node", "copies", "label", "v")), pa.array(own, pa.int32()),
                    pa.ListArray.from_arrays(ends, pa.array(lists, pa.int32())),
                    pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(np.sqrt((left * left).sum(1)))],
                    [f.split()[0] for f in NODE.split(", ")])

    return run


# --- comparison ----------------------------------------------------------------------------------------------------

def _compared(coded: DataFrame, model, least: float, reach: float) -> DataFrame:
    """Counts and links of every list, one task for each two blocks of its nodes and of the nodes that probe it."""
    own = coded.select("label", "list", "node", "copies", "v", "probes", "codes", "left")
    visits = coded.toDF(*coded.columns).select("label", F.explode("probes").alias("list"), "node", "copies", "v", F.col("list").alias("home"))
    # One row per label and list: how many blocks its nodes and its visitors take.
    here = F.when(F.col("home") == F.col("list"), 1)
    sizes = visits.groupBy("label", "list").agg(F.ceil(F.count("*") / PROBES).cast("int").alias("vs"),
                                                F.ceil(F.count(here) / BLOCK).cast("int").alias("bs"))
    sizes = common.staged(sizes.where("bs > 0"), "sizes")
    part = lambda n, seed: F.pmod(F.xxhash64("node", F.lit(seed)), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = own.join(sizes, ["label", "list"]).withColumn("b", part(F.col("bs"), 11)).withColumn("p", each("vs"))
    right = visits.join(sizes, ["label", "list"]).withColumn("p", part(F.col("vs"), 13)).withColumn("b", each("bs"))
    unit = ["label", "list", "b", "p"]
    left = left.select(*unit, "node", "copies", "v", "probes", "codes", "left")
    right = right.select(*unit, "node", "copies", "v", "home")
    common.ship(coded.sparkSession)
    return left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(_joiner(model, least, reach), FOUND)


def _joiner(model, least, reach):
    def run(key, left, right):
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_pylist([], pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]))
        coarse, cuts, books = model.value
        centre = key[1].as_py()
        node, copies = left["node"].to_numpy(), left["copies"].to_numpy()
        asked, weight, home = (right[c].to_numpy() for c in ("node", "copies", "home"))
        x, y = _unit(_matrix(left["v"])), _unit(_matrix(right["v"]))
        codes = np.frombuffer(b"".join(left["codes"].to_pylist()), np.uint8).reshape(len(node), -1)
        error = left["left"].to_numpy()
        # Two nodes that probe each other's lists meet twice: only the smaller list counts.
        probes = left["probes"].combine_chunks() if isinstance(left["probes"], pa.ChunkedArray) else left["probes"]
        back = np.zeros((len(node), len(coarse)), bool)
        back[np.repeat(np.arange(len(node)), np.diff(probes.offsets.to_numpy())), probes.flatten().to_numpy()] = True
        inside = _inside(x, y, codes, error, coarse[centre], cuts, books, reach)
        links, found = np.zeros(len(node), np.int64), np.zeros(len(asked), np.int64)
        at, by = [], []
        for i, j in inside:
            same = home[i] == centre
            once = np.where(same, asked[i] > node[j], ~back[j, home[i]] | (centre < home[i]))
            i, j = i[once], j[once]
            near = np.einsum("ij,ij->i", y[i], x[j]) >= least
            i, j = i[near], j[near]
            np.add.at(links, j, weight[i])
            np.add.at(found, i, copies[j])
            i, j = _spanning(i, j, len(asked), len(node))
            at.append(i)
            by.append(j)
        i, j = _spanning(np.concatenate(at), np.concatenate(by), len(asked), len(node))
        some, other = np.flatnonzero(links), np.flatnonzero(found)
        a = np.concatenate([node[some], asked[other], asked[i]])
        b = pa.array(np.concatenate([np.zeros(len(some) + len(other), np.int64), node[j]]),
                     mask=np.arange(len(a)) < len(some) + len(other))
        n = pa.array(np.concatenate([links[some], found[other], np.zeros(len(i), np.int64)]))
        return pa.Table.from_arrays([pa.array(a, pa.int64()), b, n], ["a", "b", "n"])

    return run


def _inside(x, y, codes, error, centre, cuts, books, reach, some=256):
    """Pairs (place in y, place in x) that their codes do not tell apart, for so many of y at a time: the distance from
    y to the coded x, off by at most the length that the codes leave out."""
    limit = (reach + error + ROOM) ** 2
    for start in range(0, len(y), some):
        left = y[start:start + some] - centre
        total = np.zeros((len(left), len(codes)))
        for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            total += _squared(left[:, a:b], books[p])[:, codes[:, p]]
        i, j = np.nonzero(total <= limit)
        yield i + start, j


def _spanning(i, j, rows, others):
    """Some of the links (i, j) that connect what all of them connect: each node and the first one it is connected with."""
    if not len(i):
        return i.astype(np.int64), j.astype(np.int64)
    # A link for each node to its group's least column, and for each column to its group's least row.
    row = np.full(rows, others)
    column = np.full(others, rows)
    kept = np.zeros(len(i), bool)
    np.minimum.at(row, i, j)
    np.minimum.at(column, j, i)
    kept |= (row[i] == j) | (column[j] == i)
    label = np.arange(others)
    while True:
        # Columns that share a row, by the links kept, take the least label.
        best = np.full(rows, others)
        np.minimum.at(best, i[kept], label[j[kept]])
        new = label.copy()
        np.minimum.at(new, j[kept], best[i[kept]])
        if (new == label).all():
            break
        label = new
    reached = np.full(rows, others)
    reached[i[kept]] = label[j[kept]]
    more = reached[i] != label[j]
    if more.any():
        # Links between groups that the kept ones do not connect stay as they are.
        kept |= more
    return i[kept], j[kept]


def _unit(x):
    """Rows at length 1; the largest component is taken out first, so squares neither overflow nor vanish."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _matrix(lists) -> np.ndarray:
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)
