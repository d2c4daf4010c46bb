"""Token files: flat unsigned integers, document offsets beside them, and a reader that maps them into memory.

``tokens-*.bin`` holds ids one after another, 16 bits each where the vocabulary allows and else 32, little-endian.
``tokens-*.idx`` holds, for each document of it, 64-bit: its id and its first token's place in the file; the last pair
has the number of tokens. ``manifest`` (Parquet) names the files of the tasks that succeeded, in order of document ids,
with their token counts; a file's first token's place in the corpus is the sum of the counts before it.
"""

from __future__ import annotations

import json
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import common, tokens

END_ID = 0
#: In place of a missing document id; such documents come first.
NO_ID = -(2**63)


def _store(path):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))


def write(df: DataFrame, path: str, id_col="doc_id", text_col="text", tokenizer="byte_bpe_50k.json",
          end_id=END_ID) -> DataFrame:
    """Write the token files of all texts to ``path`` in the shared store, ascending by id; returns the manifest.

    Ids are long. A missing id comes first and reads as null; documents of equal ids are ordered by a hash of
    their text. A missing or empty text is the end id alone. A task's files have names of their own, so a task that runs twice does no harm.
    """
    spark = df.sparkSession
    path = common.qualified(spark, path)
    place = common.vocabulary(tokenizer)
    with open(place) as f:
        spec = json.load(f)
    top = max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"]), end_id])
    kind = "<u2" if top < 2**16 else "<u4"
    source = common.texts(df, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("__id"), text=text_col)
    # The last two keys let the range split the rows of one id, and even equal rows.
    keyed = source.withColumns({"__hash": F.xxhash64("__text"), "__tie": F.monotonically_increasing_id()})
    order = ["__id", "__hash", "__tie"]
    sorted_ = keyed.repartitionByRange(_partitions(spark), *order).sortWithinPartitions(*order).drop("__hash", "__tie")

    def run(batches):
        store, folder = _store(path)
        chunks = tokens.encoder(place, tokens.library)
        name, total, ids, starts = f"tokens-{uuid.uuid4().hex}", 0, [], []
        out = None
        for batch in common.slices(batches, "__text"):
            out = out or store.open_output_stream(f"{folder}/{name}.bin")
            parts = [np.append(np.frombuffer(x, "<u4"), np.uint32(end_id))
                     for x in chunks.ids(batch.column("__text").to_pylist())]
            sizes = np.array([len(x) for x in parts], np.int64)
            ids.append(batch.column("__id").to_numpy())
            starts.append(total + np.cumsum(sizes) - sizes)
            total += int(sizes.sum())
            out.write(np.concatenate(parts).astype(kind).tobytes())
        if out is None:
            return
        out.close()
        ids, starts = np.concatenate(ids), np.concatenate(starts)
        with store.open_output_stream(f"{folder}/{name}.idx") as index:
            pairs = np.stack([np.append(ids, NO_ID), np.append(starts, total)], 1)
            index.write(pairs.astype("<i8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (name, int(ids[0]), len(ids), total)],
                                         ["name", "first_id", "documents", "tokens"])

    _store(path)[0].create_dir(_store(path)[1], recursive=True)
    made = common.mapped(sorted_, run, "name string, first_id bigint, documents bigint, tokens bigint").withColumn(
        "part", F.spark_partition_id())
    made.write.parquet(f"{path}/manifest")
    # One row per file, in the order of the ranges: the base of each is the sum of the counts before it.
    rows = spark.read.parquet(f"{path}/manifest").orderBy("part").collect()
    base, listed = 0, []
    for r in rows:
        listed.append((r["name"], base, r["documents"], r["tokens"], kind))
        base += r["tokens"]
    schema = "name string, base bigint, documents bigint, tokens bigint, kind string"
    out = spark.createDataFrame(listed, schema).coalesce(1)
    out.write.parquet(f"{path}/files")
    return spark.read.schema(schema).parquet(f"{path}/files")


def _partitions(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)


def read(spark: SparkSession, path: str, files: DataFrame | None = None) -> DataFrame:
    """Documents of token files: ``doc_id``, ``start`` (tokens of all documents before it), ``n_tokens`` and ``ids``
    (binary, little-endian unsigned 32-bit). No files give no rows."""
    path = common.qualified(spark, path)
    files = spark.read.parquet(f"{path}/files") if files is None else files

    def run(batches):
        store, folder = _store(path)
        for batch in batches:
            for name, base, documents, total, kind in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_file(f"{folder}/{name}.idx") as f:
                    pairs = np.frombuffer(f.read(), "<i8").reshape(-1, 2)
                data = _mapped(store, f"{folder}/{name}.bin", kind)
                starts, start = pairs[:, 1], 0
                while start < documents:
                    stop = int(np.searchsorted(starts, starts[start] + 500_000, "right")) - 1
                    stop = min(documents, max(start + 1, stop))
                    ids = data(starts[start], starts[stop])
                    own = pairs[start:stop, 0]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(own, mask=own == NO_ID), pa.array(base + starts[start:stop]),
                        pa.array(np.diff(starts[start:stop + 1])),
                        common.binary_array(ids.astype("<u4").view(np.uint8), 4 * (starts[start:stop + 1] - starts[start])),
                    ], ["doc_id", "start", "n_tokens", "ids"])
                    start = stop

    named = files.select("name", "base", "documents", "tokens", "kind")
    return common.mapped(named.repartition(_partitions(spark), "name"), run,
                         "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def _mapped(store, place, kind):
    """A function (first, last) -> ids of a file: a memory map where the store is a local or mounted folder, else
    reads of the range alone."""
    from pyarrow import fs

    if isinstance(store, fs.LocalFileSystem):
        ids = np.memmap(place, kind, "r")
        return lambda first, last: ids[first:last]
    file, width = store.open_input_file(place), np.dtype(kind).itemsize
    return lambda first, last: np.frombuffer(file.read_at(int(last - first) * width, int(first) * width), kind)
