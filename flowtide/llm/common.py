"""Helpers that the operators of this subpackage share: staged tables, text batches, hashing, vocabulary files."""

from __future__ import annotations

import hashlib
import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from flowtide.session import scratch_dir

#: Bytes of text that a task handles at once; a longer text is a batch of its own.
BATCH_BYTES = 2_000_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: later jobs neither recompute it nor depend on
    an executor that may be lost."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def mapped(df: DataFrame, run, schema: str, keeps=False) -> DataFrame:
    """``df.mapInArrow`` with this package at hand on the executors. Unless ``run`` keeps tables in its worker, those of
    an earlier stage go when it begins. A task's own memory goes back to the system when it ends, as its worker waits
    for others beside them."""
    ship(df.sparkSession)
    return df.mapInArrow(_tidy(run, keeps), schema)


def _tidy(run, keeps):
    def begin(batches):
        if _KEPT and not keeps:
            _KEPT.clear()
            _give_back()
        yield from run(batches)
        _give_back()

    return begin


def ship(spark) -> None:
    """Send this package's source to the executors, once a context."""
    context = spark.sparkContext
    if getattr(context, "_flowtide_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    archive = os.path.join(tempfile.mkdtemp(prefix="flowtide-"), "flowtide_source.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(os.path.join(top, "flowtide")):
            for name in names:
                if name.endswith(".py"):
                    out.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    context.addPyFile(archive)
    context._flowtide_shipped = True


def qualified(spark, path: str) -> str:
    """``path`` with the scheme that Spark gives it, for readers and writers that know nothing of Spark's default one."""
    java = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf, place = spark.sparkContext._jsc.hadoopConfiguration(), java.Path(path)
    if place.toUri().getScheme() is not None:
        return path
    if not place.isAbsolute():
        return place.getFileSystem(conf).makeQualified(place).toString()
    return place.makeQualified(java.FileSystem.getDefaultUri(conf), java.Path("/")).toString()


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, *keep, text="text", empty=True) -> DataFrame:
    """The columns ``keep`` and the text as a string; a missing text becomes empty unless ``empty`` is off."""
    t = F.col(text).cast("string")
    return df.select(*keep, (F.coalesce(t, F.lit("")) if empty else t).alias("__text"))


def kept_texts(df: DataFrame, id_cols, text="text") -> tuple[DataFrame, str]:
    """``id_cols`` as ``__id0``, ``__id1``, ... with the text, and the text's column: one of these where the text is kept
    anyway, so it is sent once. There, a missing text stays missing."""
    small_batches(df.sparkSession)
    kept = [F.col(c).alias(f"__id{i}") for i, c in enumerate(id_cols)]
    if text in id_cols and df.schema[text].dataType.simpleString() == "string":
        return df.select(*kept), f"__id{list(id_cols).index(text)}"
    return texts(df, *kept, text=text), "__text"


def small_batches(spark) -> None:
    """Let Spark send batches of a few megabytes where the session has its default of 64: beside a batch, a task needs
    several times its size. Results do not depend on it."""
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting) in ("67108864b", "64MB", "64m"):
        spark.conf.set(setting, str(2 * BATCH_BYTES))


_KEPT: dict = {}


def kept_in_worker(key, make):
    """``make()``, kept by this worker for its later tasks until it is asked for something else: one stage's tables do
    not stay beside the next one's."""
    if key not in _KEPT:
        if _KEPT:
            _KEPT.clear()
            _give_back()
        _KEPT[key] = make()
    return _KEPT[key]


def _give_back() -> None:
    """Return freed memory to the system, where the C library can."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file, by the installed package; an existing path is taken as it is."""
    if os.path.exists(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(batches, column, limit=BATCH_BYTES):
    """Cut Arrow batches so that each piece holds about ``limit`` bytes of ``column``, or one longer row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(lengths_of(batch.column(column)))
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def lengths_of(array) -> np.ndarray:
    data, offsets = buffers(array)
    return np.diff(offsets)


def buffers(array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its offsets into them, without copying; nulls count as empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, places, data = array.buffers()
    offsets = np.frombuffer(places, np.int64 if wide else np.int32, len(array) + 1, array.offset * (8 if wide else 4))
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def binary_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array over ``data`` cut at ``offsets``."""
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, [
        None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    ]).cast(pa.binary())


# --- hashing -------------------------------------------------------------------------------------------------------

_ROOM = np.array([(1 << (8 * i)) - 1 for i in range(8)] + [2**64 - 1], np.uint64)
_LONG = 256


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``data[starts:ends]``, eight bytes a step for all of them at once."""
    size = ends - starts
    out = mix(size.astype(np.uint64) + np.uint64(0x51ED270B))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = np.flatnonzero(size <= _LONG)
    for i in np.flatnonzero(size > _LONG):
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i]:ends[i]].tobytes(), digest_size=8).digest(), "little")
    at, rest = starts[left], size[left]
    more = rest > 0
    left, at, rest = left[more], at[more], rest[more]
    while len(left):
        out[left] = mix(out[left] ^ (eight[at] & _ROOM[np.minimum(rest, 8)]))
        more = rest > 8
        left, at, rest = left[more], at[more] + 8, rest[more] - 8
    return out


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z."""
    return _LOWER[data]


def words(data: np.ndarray, offsets: np.ndarray):
    """Starts and ends of the runs of bytes other than tab to carriage return and blank, per text, and for each text
    the number of words before it (one entry more than texts)."""
    ink = ~_SPACE[data]
    begin, finish = ink.copy(), ink.copy()
    begin[1:] &= ~ink[:-1]
    finish[:-1] &= ~ink[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begin[edge] = ink[edge]
    finish[edge - 1] = ink[edge - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def multipliers(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def windows(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries."""
    if len(hashes) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(hashes) - n + 1, np.uint64)
    for i, k in enumerate(multipliers(n)):
        total += hashes[i:len(hashes) - n + 1 + i] * k
    return mix(total ^ np.uint64(n))
