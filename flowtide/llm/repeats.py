"""Removal of long repeated byte strings by interval expansion on a Burrows-Wheeler transform.

A window is a run of ``least`` bytes. Windows that occur twice are found in regions that hold all occurrences of some
bytes: each window has the k-gram of the least hash in it as its anchor, so equal windows meet under their anchor. What
is the same around many anchors is settled by counting equal surroundings; where surroundings differ, a transform over
them is expanded: starting from single symbols, intervals of growing common prefixes are extended backwards, breadth
first, and each boundary takes the length at which it first appears, up to ``least``. Boundaries that have none then lie
between suffixes that share a whole window. The task that has a region first cuts its surroundings into blocks of windows
and leaves out those whose shared bytes, almost as long as a window, no other has. A region with very many different
surroundings is split by longer keys until every part is small, at last by whole windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common

LEAST = 400
#: Different surroundings that one task takes of one region at once; more are split. Bytes that it takes of all regions,
#: and those of them that one transform takes.
REGION, REGION_BYTES, TRANSFORM_BYTES = 4096, 1_000_000, 150_000
#: Blocks of windows into which a task cuts the surroundings of a region before their transform.
BLOCKS = 8
#: Bytes of text whose anchors are looked for at once; each needs over a hundred bytes then.
ANCHOR_BYTES = 500_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_SCRAMBLED = common.mix(np.arange(1, 257, dtype=np.uint64))
#: ``n`` windows of text ``tk`` from byte ``lo`` on, under a key. Under it, windows are numbered alike in all texts, and
#: the first of these has the number ``off``: texts that begin or end near an anchor lack some.
ITEM = "key bigint, ctx bigint, tk binary, lo bigint, n int, off int"
SPANS = "tk binary, lo bigint, hi bigint"


def repeated_spans(df: DataFrame, text_col="text", least=LEAST) -> DataFrame:
    """Per different text (``tk``, the digest of its bytes): the runs of bytes [lo, hi) that windows occurring anywhere
    else cover, as ``spans``, an array of structs that may overlap. Texts without any have no row.

    Texts are taken as UTF-8; a missing one is empty. Windows do not cross texts. A text that occurs in several rows has
    each of its windows elsewhere.
    """
    rows = common.texts(df, text=text_col)
    places = common.staged(common.mapped(rows, _anchored(least), ITEM), "anchors")
    found, open_ = _settled(places, least)
    sets = [found]
    if open_ is not None:
        texts = common.texts(df, text=text_col).withColumn("tk", F.unhex(F.md5("__text")))
        asked = open_.groupBy("tk").agg(F.collect_set(F.struct("key", "ctx", "lo", "n", "off", "many", "m")).alias("asked"))
        cut = common.mapped(texts.join(asked, "tk"), _surroundings(least),
                            ITEM + ", many boolean, m bigint, bytes binary")
        # Copies of a text give the same surroundings.
        items = common.staged(cut.dropDuplicates(["key", "ctx", "tk", "lo"]), "surroundings")
        width = least - max(1, least // 2) + 1  # windows that hold an anchor
        while True:
            sets.append(_transformed(items.where(F.col("m") <= REGION), least, width))
            large = items.where(F.col("m") > REGION)
            if large.isEmpty():
                break
            width = -(-width // 2)
            halves = common.mapped(large.drop("m", "key", "ctx"), _halved(least, width), ITEM + ", many boolean, bytes binary")
            # Two anchors of one text may lead to the same windows under one key: they are one place.
            halves = common.staged(halves.dropDuplicates(["key", "tk", "lo", "n"]), "halves")
            found, open_ = _settled(halves, least)
            sets.append(found)
            if open_ is None:
                break
            items = common.staged(open_, "surroundings")
    spans = sets[0]
    for more in sets[1:]:
        spans = spans.unionByName(more)
    return common.staged(spans.distinct().groupBy("tk").agg(F.collect_list(F.struct("lo", "hi")).alias("spans")), "spans")


def removed(df: DataFrame, text_col="text", least=LEAST) -> DataFrame:
    """``df`` with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), all long, and ``kept`` (binary: the
    bytes outside the spans, joined). Columns of these names are replaced; every row stays, in its number."""
    new = ["n_bytes", "n_removed", "n_spans", "kept"]
    names = [c for c in df.columns if c not in new]
    spans = repeated_spans(df, text_col, least).withColumnsRenamed({"tk": "__tk", "spans": "__spans"})
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = df.select(*names, text.alias("__text"), F.unhex(F.md5(text)).alias("__own"))
    rows = rows.join(spans, F.col("__own") == F.col("__tk"), "left").drop("__own", "__tk")

    def run(batches):
        for batch in common.slices(batches, "__text"):
            data, offsets = common.buffers(batch.column("__text"))
            cover = np.zeros(len(data) + 1, np.int64)
            lists = batch.column("__spans")
            lists = lists.fill_null([]) if lists.null_count else lists
            ends = lists.offsets.to_numpy()
            owner = np.repeat(offsets[:-1], np.diff(ends))
            pairs = lists.flatten()
            np.add.at(cover, owner + pairs.field("lo").to_numpy(), 1)
            np.add.at(cover, owner + pairs.field("hi").to_numpy(), -1)
            gone = np.cumsum(cover[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = offsets[1:-1][offsets[1:-1] < len(data)]
            begins[inner] = gone[inner]
            count = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
            kept = common.binary_array(data[~gone], np.concatenate([[0], np.cumsum(~gone)])[offsets])
            columns = [pa.array(x.astype(np.int64)) for x in (np.diff(offsets), count(gone), count(begins))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), *columns, kept], [*names, *new])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)
    return common.mapped(rows, run, f"{schema}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


# --- regions -------------------------------------------------------------------------------------------------------

def _settled(places: DataFrame, least: int):
    """Spans of surroundings that occur more than once under their key, and what remains open: under keys with different
    surroundings some of which occur once, those and one of each of the others; ``m`` counts them. ``places`` has key,
    ctx (hash of the surroundings), tk, lo, n (number of windows), perhaps bytes."""
    alike = places.groupBy("key", "ctx").agg(F.count("*").alias("c"), F.min(F.struct("tk", "lo")).alias("first"))
    keys = alike.groupBy("key").agg(F.sum("c").alias("total"), F.count("*").alias("m"), F.min("c").alias("least_c"))
    keys = keys.where("total > 1").select(F.col("key").alias("k"), "m", "least_c")
    # Counts per surroundings first: a key that a third of all texts have arrives here as its different surroundings.
    known = common.staged(alike.join(keys, F.col("key") == F.col("k")).drop("k"), "known")
    known = known.select(F.col("key").alias("k"), F.col("ctx").alias("x"), "c", "first", "m", "least_c")
    rows = common.staged(places.join(known, (F.col("key") == F.col("k")) & (F.col("ctx") == F.col("x"))).drop("k", "x"),
                         "labelled")
    found = rows.where("c > 1").select("tk", "lo", (F.col("lo") + F.col("n") - 1 + least).alias("hi"))
    once = (F.col("c") == 1) | F.struct("tk", "lo").eqNullSafe(F.col("first"))
    open_ = rows.where((F.col("m") > 1) & (F.col("least_c") == 1) & once).withColumn("many", F.col("c") > 1).drop(
        "c", "first", "least_c").dropDuplicates(["key", "ctx", "tk", "lo"])
    return found, None if open_.isEmpty() else open_


def _powers(n):
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if len(_POWERS[0]) < n:
        inverse = np.uint64(pow(int(_ODD), -1, 2**64))
        size = max(n, 2 * len(_POWERS[0]))
        for i, base in enumerate((_ODD, inverse)):
            _POWERS[i] = np.cumprod(np.append(np.ones(1, np.uint64), np.full(size - 1, base)))
    return _POWERS[0][:n], _POWERS[1][:n]


def _sums(data):
    """Prefix sums from which the hash of any run of bytes follows in one step."""
    up, _ = _powers(len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SCRAMBLED[data] * up, out=out[1:])
    return out


def _run_hash(sums, lo, hi):
    _, down = _powers(len(sums))
    return common.mix((sums[hi] - sums[lo]) * down[lo] ^ common.mix((hi - lo).astype(np.uint64)))


def _gram_hashes(sums, k):
    """``_run_hash`` of all runs of ``k`` bytes."""
    _, down = _powers(len(sums))
    return common.mix((sums[k:] - sums[:-k]) * down[:len(sums) - k] ^ common.mix(np.full(1, k, np.uint64)))


def _sliding(x, width, fold):
    """``fold`` (minimum or maximum) over all runs of ``width`` entries."""
    rows = -(-len(x) // width)
    fill = x[-1]
    padded = np.concatenate([x, np.full(rows * width - len(x), fill)]).reshape(rows, width)
    ahead = fold.accumulate(padded, 1).ravel()
    behind = fold.accumulate(padded[:, ::-1], 1)[:, ::-1].ravel()
    n = len(x) - width + 1
    return fold(behind[:n], ahead[width - 1:width - 1 + n])


def _anchored(least):
    """Anchors of all windows: for windows of ``least`` bytes, the places of the least hash among their k-grams, where
    k is half the length. Ties are all anchors, so that the choice depends on the window's bytes alone."""
    k = max(1, least // 2)
    width = least - k + 1

    def run(batches):
        for batch in common.slices(batches, "__text", ANCHOR_BYTES):
            data, offsets = common.buffers(batch.column("__text"))
            digests = pa.array([hashlib.md5(data[a:b]).digest() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
            if len(data) < least:
                continue
            sums = _sums(data)
            grams = _gram_hashes(sums, k)
            windows = _sliding(grams, width, np.minimum)
            # Windows across two texts do not count; the hash 0 is kept for them.
            grams |= np.uint64(1)
            windows |= np.uint64(1)
            long = np.diff(offsets) >= least
            valid = np.zeros(len(windows) + 1, np.int64)
            np.add.at(valid, offsets[:-1][long], 1)
            np.add.at(valid, np.minimum(offsets[1:][long] - least + 1, len(windows)), -1)
            windows[np.cumsum(valid[:-1]) == 0] = 0
            edge = np.zeros(width - 1, np.uint64)
            most = _sliding(np.concatenate([edge, windows, edge]), width, np.maximum)
            anchors = np.flatnonzero(most[:len(grams)] == grams)
            text = np.searchsorted(offsets, anchors, "right") - 1
            lo = np.maximum(anchors - (least - k), offsets[text])
            last = np.minimum(anchors, offsets[text + 1] - least)
            key = _run_hash(sums, anchors, anchors + k)
            # A short text may have several anchors of one key for the same windows: one of them counts.
            whole = np.flatnonzero((lo == offsets[text]) & (last == offsets[text + 1] - least))
            _, first = np.unique(np.stack([text[whole], key[whole].view(np.int64)]), axis=1, return_index=True)
            keep = np.ones(len(anchors), bool)
            keep[np.delete(whole, first)] = False
            text, lo, last, key, anchors = (x[keep] for x in (text, lo, last, key, anchors))
            ctx = _run_hash(sums, lo, last + least)
            yield pa.RecordBatch.from_arrays([
                pa.array(key.view(np.int64)), pa.array(ctx.view(np.int64)), digests.take(pa.array(text)),
                pa.array(lo - offsets[text]), pa.array((last - lo + 1).astype(np.int32)),
                pa.array((lo - anchors + least - k).astype(np.int32))], ["key", "ctx", "tk", "lo", "n", "off"])

    return run


def _surroundings(least):
    """The bytes around the places asked of each text."""
    def run(batches):
        for batch in common.slices(batches, "__text"):
            asked = batch.column("asked")
            row = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
            data, offsets = common.buffers(batch.column("__text"))
            fields = asked.flatten()
            for start in range(0, len(row), 4096):
                part, own = fields.slice(start, 4096), row[start:start + 4096]
                lo, n = (np.asarray(part.field(f)).astype(np.int64) for f in ("lo", "n"))
                begin = offsets[own] + lo
                cut = [data[a:a + b - 1 + least].tobytes() for a, b in zip(begin, n)]
                tk = batch.column("tk").take(pa.array(own))
                names = ["key", "ctx", "tk", "lo", "n", "off", "many", "m", "bytes"]
                columns = [tk if c == "tk" else pa.array(cut, pa.binary()) if c == "bytes" else part.field(c) for c in names]
                yield pa.RecordBatch.from_arrays(columns, names)

    return run


def _halved(least, width):
    """Each surroundings as those of the windows numbered below ``width`` and of the others; the key of either is the
    hash of what all windows of its numbers share."""
    def run(batches):
        for batch in batches:
            rows, core, whole = [], [], []
            for tk, lo, n, off, many, data in zip(*(
                    batch.column(c).to_pylist() for c in ("tk", "lo", "n", "off", "many", "bytes"))):
                for begin in (0, width):
                    first, stop = max(off, begin), min(off + n, begin + width)
                    if first < stop:
                        part = data[first - off:stop - 1 - off + least]
                        # Shared by the windows numbered begin to begin + width - 1, seen from the first one here.
                        shared = part[begin + width - 1 - first:begin - first + least]
                        rows.append((tk, lo + first - off, stop - first, first - begin, many, part))
                        core.append(hashlib.blake2b(shared, digest_size=8).digest())
                        whole.append(hashlib.blake2b(part, digest_size=8).digest())
            key, ctx = (pa.array(np.frombuffer(b"".join(x), np.int64)) for x in (core, whole))
            kinds = [pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kinds)]
            yield pa.RecordBatch.from_arrays([key, ctx, *columns],
                                             ["key", "ctx", "tk", "lo", "n", "off", "many", "bytes"])

    return run


# --- transform -----------------------------------------------------------------------------------------------------

def _transformed(items: DataFrame, least: int, width: int) -> DataFrame:
    """Spans of windows that occur twice among the surroundings of one region. Regions are small and are taken many at
    a time; a task sees them in order of their keys."""
    def run(batches):
        held, size, last = [], 0, None
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("key", "tk", "lo", "off", "many", "bytes"))):
                if size > REGION_BYTES and row[0] != last:
                    yield from _spans(held, least, width)
                    held, size = [], 0
                held.append(row)
                size += len(row[5])
                last = row[0]
        if held:
            yield from _spans(held, least, width)

    dealt = items.select("key", "tk", "lo", "off", "many", "bytes").repartition("key").sortWithinPartitions("key")
    return common.mapped(dealt, run, SPANS)


def _spans(rows, least, width):
    """Spans of the rows (key, tk, lo, off, many, bytes). The windows of a key are numbered below ``width``, and all of
    them hold the bytes from the start of the last one to the end of the first one: these are its core."""
    keys, tks, lo, off, many, cuts = zip(*rows)
    number: dict = {}
    text = np.array([number.setdefault(tk, len(number)) for tk in tks])
    _, region = np.unique(np.array(keys), return_inverse=True)
    lo, off, many = np.array(lo, np.int64), np.array(off, np.int64), np.array(many, bool)
    step = -(-width // BLOCKS)
    row, first, n, region, off, many, whole = _blocks(cuts, text, lo, off, many, region, least, width, step)
    spans = [(tks[i], int(lo[i] + f), int(lo[i] + f + c - 1 + least)) for i, f, c in zip(row[whole], first[whole], n[whole])]
    if len(spans):
        yield _listed(spans)
    row, first, n, region, off, many = (x[~whole | many] for x in (row, first, n, region, off, many))
    # Those of a block with nothing else in it are done.
    row, first, n, region, off, many = (
        x[np.bincount(region)[region] > 1] if len(region) else x for x in (row, first, n, region, off, many))
    # Parts of a block stay together.
    size = np.cumsum(n + step)
    start = 0
    while start < len(row):
        stop = int(np.searchsorted(size, size[start] + TRANSFORM_BYTES, "right"))
        stop = int(np.searchsorted(region, region[stop - 1], "right"))
        i, f, c = row[start:stop], first[start:stop], n[start:stop]
        parts = [cuts[r][a:a + b - 1 + least] for r, a, b in zip(i, f, c)]
        starts = repeated_starts(parts, text[i], lo[i] + f, many[start:stop], least, region[start:stop],
                                 step - 1 - off[start:stop], least - step + 1)
        spans = []
        for r, begin, at in zip(i, f, starts):
            if len(at):
                edges = np.flatnonzero(np.diff(at) > 1)
                begin = int(lo[r] + begin)
                for a, b in zip(np.concatenate([[at[0]], at[edges + 1]]), np.concatenate([at[edges], [at[-1]]])):
                    spans.append((tks[r], begin + int(a), begin + int(b) + least))
        yield _listed(spans)
        start = stop


def _listed(spans):
    columns = zip(*spans) if spans else ([], [], [])
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64()))], ["tk", "lo", "hi"])


def _blocks(cuts, text, lo, off, many, region, least, width, step):
    """The surroundings in blocks of ``step`` windows, by number, without those blocks whose core only one of a region has,
    in order of these cores: the row, its first window there, their number, the block and core (as ``region``), the
    first one's number in the block, whether it is ``many``, and whether the same part occurs at another place, so that
    all its windows are repeated. Of equal parts at different places the first one is ``many``."""
    size = np.array([len(c) for c in cuts], np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    sums = _sums(np.frombuffer(b"".join(cuts), np.uint8))
    count = -(-width // step)
    row, block = (x.ravel() for x in np.indices((len(cuts), count)))
    low = block * step
    first = np.maximum(off[row], low)
    n = np.minimum(off[row] + size[row] - least + 1, low + step) - first
    some = n > 0
    row, block, low, first, n = (x[some] for x in (row, block, low, first, n))
    at = begin[row] - off[row]  # where the window of the number 0 begins, or would
    core = _run_hash(sums, at + low + step - 1, at + low + least)
    core = common.mix(core ^ common.mix((region[row] * count + block).astype(np.uint64) + np.uint64(1)))
    _, core, shared = np.unique(core, return_inverse=True, return_counts=True)
    order = np.flatnonzero(shared[core] > 1)
    order = order[np.argsort(core[order], kind="stable")]
    row, low, first, n, core = (x[order] for x in (row, low, first, n, core))
    own = _run_hash(sums, begin[row] + first - off[row], begin[row] + first - off[row] + n - 1 + least)
    own = common.mix(own ^ common.mix(core.astype(np.uint64)) ^ (first - low).astype(np.uint64))
    # Equal parts at different places.
    _, own = np.unique(own, return_inverse=True)
    place = lo[row] + first - off[row]
    place += text[row] * (place.max(initial=0) + 1)
    by = np.lexsort((place, own))
    fresh = np.append(True, own[by][1:] != own[by][:-1])[:len(own)]
    other = ~fresh & (np.append(True, place[by][1:] != place[by][:-1])[:len(own)])
    whole = (np.bincount(own[by], other) > 0)[own]
    head = np.zeros(len(own), bool)
    head[by[fresh]] = True
    return row, first - off[row], n, core, first - low, np.where(whole, head, many[row]), whole


def repeated_starts(cuts, text, lo, many, least, region=None, core=None, width=1) -> list[np.ndarray]:
    """For each piece of bytes, the places in it where a string of ``least`` bytes starts that also starts elsewhere.
    Piece i lies in text ``text[i]`` from ``lo[i]`` on; equal places of a text are one, unless the piece is ``many``.

    Where pieces come from regions, all strings of piece i hold its bytes from ``core[i]`` on, ``width`` of them, which
    are the same in all of ``region[i]``. They are one symbol then, which no other region has.
    """
    size = np.array([len(c) for c in cuts], np.int64)
    begin = np.concatenate([[0], np.cumsum(size + 1)])
    codes = np.zeros(begin[-1], np.int64)  # 0 ends a piece
    inside = np.ones(len(codes), bool)
    inside[begin[1:] - 1] = False
    codes[inside] = np.frombuffer(b"".join(cuts), np.uint8) + np.int64(1)
    if region is not None:
        codes[begin[:-1] + core] = 257 + region
        gone = np.zeros(len(codes) + 1, np.int64)
        gone[begin[:-1] + core + 1] += 1
        gone[begin[:-1] + core + width] -= 1
        codes = codes[np.cumsum(gone[:-1]) == 0]
        least, size = least - width + 1, size - width + 1
        begin = np.concatenate([[0], np.cumsum(size + 1)])
    used = np.bincount(codes) > 0
    codes = (np.cumsum(used) - 1)[codes]
    order = suffix_order(codes, least)
    shared = shared_prefix(codes, order, least)
    out = [np.zeros(0, np.int64)] * len(cuts)
    # A run of neighbours that share a window: the suffixes at and before its boundaries.
    member = shared.copy()
    member[:-1] |= shared[1:]
    suffix, group = order[member], np.cumsum(member & ~shared)[member]
    piece = np.searchsorted(begin, suffix, "right") - 1
    at = suffix - begin[piece]
    whole = at + least <= size[piece]  # what runs across an end is no window
    group, piece, at = group[whole], piece[whole], at[whole]
    if not len(group):
        return out
    # Count different places of a group.
    place = lo[piece] + at
    _, place = np.unique(text[piece] * (place.max() + 1) + place, return_inverse=True)
    different = np.unique(group * (place.max() + 1) + place) // (place.max() + 1)
    count = np.bincount(different, minlength=group.max() + 1) + np.bincount(
        group, many[piece], minlength=group.max() + 1)
    good = count[group] > 1
    piece, at = piece[good], at[good]
    order = np.argsort(begin[piece] + at)
    piece, at = piece[order], at[order]
    cut = np.searchsorted(piece, np.arange(len(cuts) + 1))
    return [at[a:b] for a, b in zip(cut[:-1], cut[1:])]


def suffix_order(codes, least):
    """Suffixes in order of their first ``least`` symbols at least, by multiplying the length that is in order."""
    n = len(codes)
    key, width, step = codes + 1, (int(codes.max()) + 1).bit_length(), 1
    while True:
        join = min(62 // width, -(-least // step))
        parts = np.concatenate([key, np.zeros(join * step, np.int64)])
        joined = key
        for i in range(1, join):
            joined = joined << width | parts[i * step:i * step + n]
        total = step * join  # symbols that these keys tell apart
        order = np.argsort(joined)
        ranked = joined[order]
        fresh = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
        if total >= least or fresh[-1] == n - 1:
            return order
        key = np.empty(n, np.int64)
        key[order] = fresh + 1
        width, step = n.bit_length(), total


def shared_prefix(codes, order, least):
    """Whether each suffix shares its first ``least`` symbols with the one before it in order: boundaries to which no
    interval of a shorter common prefix extends. Not told for suffixes whose first symbols hold an end, a 0."""
    n = len(order)
    count = int(codes.max()) + 1
    symbol = codes[order - 1]  # before the first one stands the last one, an end
    # Where the suffix with the preceding symbol lies: after those of smaller symbols, in order among those of its own.
    mapped = np.empty(n, np.int64)
    mapped[np.argsort(symbol.astype(np.uint16) if count < 1 << 16 else symbol, kind="stable")] = np.arange(n)
    # Equal neighbours of the transform are one run; repetitive text has few.
    begin = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
    stop = np.append(begin[1:], n)
    run = np.repeat(np.arange(len(begin)), stop - begin)
    sign = symbol[begin]
    open_ = np.ones(n + 1, bool)  # boundaries without a length yet
    open_[[0, n]] = False
    edge = np.flatnonzero(np.diff(codes[order])) + 1
    open_[edge] = False
    lo, hi = np.concatenate([[0], edge]), np.concatenate([edge, [n]])
    lo, hi = lo[hi < n], hi[hi < n]
    for _ in range(1, least):
        if not len(lo):
            break
        head = run[lo]
        size = run[hi - 1] - head + 1
        interval = np.repeat(np.arange(len(lo)), size)
        at = np.arange(len(interval)) - np.repeat(np.cumsum(size) - size - head, size)
        inner = sign[at] > 0  # nothing extends across an end
        at, interval = at[inner], interval[inner]
        if not len(at):
            break
        first = mapped[np.maximum(begin[at], lo[interval])]
        last = mapped[np.minimum(stop[at], hi[interval]) - 1] + 1
        if (size > 1).any():
            # Runs of one symbol within an interval are one extension.
            key = interval * count + sign[at]
            by = np.argsort(key, kind="stable")
            same = np.flatnonzero(np.concatenate([[True], np.diff(key[by]) != 0]))
            first, last = np.minimum.reduceat(first[by], same), np.maximum.reduceat(last[by], same)
        fresh = open_[last]
        lo, hi = first[fresh], last[fresh]
        open_[hi] = False
    return open_[:n]
