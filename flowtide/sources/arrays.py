"""JSON arrays read by several tasks a file.

Spark's text source deals out byte ranges (blocks) of a file as pieces that end in a closing brace, the one character at
which every object ends. Whether a block starts inside a string, and how deep, only the blocks before it tell:

1. Each block is passed once for both answers to the first question: where does it end, and how many levels deeper.
2. From the first block on, these give every block's true start: one row per block.
3. Each block is cut into objects. What crosses a border is one piece per block, and these are put together.
"""

import re

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import Window

from flowtide.sources import files

#: A string with its closing quote, where it has one; the rest of a string; a string or a bracket.
STRING = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+("?)', re.S)
REST = re.compile(r'[^"\\]*+(?:\\.[^"\\]*+)*+"', re.S)
MARK = re.compile(r'"[^"\\]*+(?:\\.[^"\\]*+)*+("?)|[{}\[\]]', re.S)

#: Blocks whose starts are broadcast (about 100 bytes each); starts of more are joined by a shuffle.
BROADCAST_BLOCKS = 200_000
BLOCK = ["_path", "_block"]


def read_objects(spark: SparkSession, paths) -> DataFrame:
    """Objects of JSON files as text: ``_path``, ``_block`` and ``_pos``, which rise in the order of the file, ``_text``.

    A file is one array of objects, or objects one after another. Elements that are not objects are left out, an empty
    file or array gives no rows, and a file that ends within an array or object is an error.
    """
    found = (
        spark.read.option("lineSep", "}").option("recursiveFileLookup", True).text(paths)
        .select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"), "value")
    )
    starts = files.landed(_starts(found))
    if starts.count() <= BROADCAST_BLOCKS:
        placed = found.join(F.broadcast(starts), BLOCK)
    else:
        numbered = found.withColumn("_order", F.monotonically_increasing_id())
        placed = numbered.join(starts, BLOCK).repartition(*BLOCK).sortWithinPartitions(*BLOCK, "_order")
    cut = files.landed(_cut(placed.select(*BLOCK, "value", "_inside", "_depth", "_base")), "_kind")
    whole = cut.filter("_kind = 'whole'").select(*BLOCK, "_pos", "_text")
    return whole.unionByName(_mended(cut.filter("_kind <> 'whole'")))


def _starts(found: DataFrame) -> DataFrame:
    """One row per block: whether it starts inside a string, its depth there, and that of the file's elements."""
    def passed(batches):
        import pyarrow as pa

        def level(text, inside):
            """Levels that the text adds, and whether it ends inside a string."""
            if inside:
                end = REST.match(text)
                if end is None:
                    return 0, True
                text = text[end.end():]
            bare, strings = STRING.subn(r"\1", text)
            deeper = bare.count("{") + bare.count("[") - bare.count("}") - bare.count("]")
            return deeper, bare.count('"') < strings

        def out(key, first, ends):
            (d0, in0), (d1, in1) = ends
            return pa.RecordBatch.from_pylist([dict(_path=key[0], _block=key[1], _first=first, _d0=d0, _in0=in0, _d1=d1,
                                                    _in1=in1)])

        key = None
        for batch in batches:
            paths, blocks, values = (c.to_pylist() for c in batch.columns)
            at = 0
            while at < len(values):
                stop = at + 1
                while stop < len(values) and blocks[stop] == blocks[at] and paths[stop] == paths[at]:
                    stop += 1
                text = "}".join(values[at:stop]) + "}"
                if key != (paths[at], blocks[at]):
                    if key is not None:
                        yield out(key, first, ends)
                    key, ends = (paths[at], blocks[at]), [(0, False), (0, True)]
                    first = text.lstrip("\ufeff \t\r\n")[:1]
                now = [level(text, inside) for _, inside in ends]
                ends = [(depth + d, inside) for (depth, _), (d, inside) in zip(ends, now)]
                at = stop
        if key is not None:
            yield out(key, first, ends)

    def chained(key, table):
        import pyarrow as pa

        rows, inside, depth, base = [], False, 0, None
        for r in sorted(table.to_pylist(), key=lambda r: r["_block"]):
            if base is None:
                base = 1 if r["_first"] == "[" else 0
            rows.append(dict(_path=r["_path"], _block=r["_block"], _inside=inside, _depth=depth, _base=base))
            depth, inside = (depth + r["_d1"], r["_in1"]) if inside else (depth + r["_d0"], r["_in0"])
        # A file's last piece has got a closing brace too, unless the file ends in one.
        if inside or depth not in ((-1,) if base else (-1, 0)):
            raise ValueError(f"{rows[0]['_path']} ends within an array or object")
        return pa.Table.from_pylist(rows)

    blocks = found.mapInArrow(passed, "_path string, _block long, _first string, _d0 long, _in0 boolean, _d1 long, "
                                      "_in1 boolean")
    return blocks.groupBy("_path").applyInArrow(
        chained, "_path string, _block long, _inside boolean, _depth long, _base long")


def _cut(placed: DataFrame) -> DataFrame:
    """Objects of each block, and what it has of an object that crosses its borders."""
    def cut(batches):
        import pyarrow as pa

        key = held = None
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            paths, blocks, values = columns[:3]
            rows, at = [], 0

            def out(kind, text):
                # Objects that start in a block are fewer than its bytes, so places rise over all blocks of a file.
                rows.append(dict(_path=key[0], _block=key[1], _pos=key[1] + number, _kind=kind, _text=text))

            while at < len(values):
                stop = at + 1
                while stop < len(values) and blocks[stop] == blocks[at] and paths[stop] == paths[at]:
                    stop += 1
                text = "}".join(values[at:stop]) + "}"
                if key != (paths[at], blocks[at]):
                    if held is not None:
                        out("middle" if earlier else "begin", "".join(held))
                    key, number = (paths[at], blocks[at]), 0
                    inside, depth, base = (c[at] for c in columns[3:])
                    # The texts of an object that is not yet closed, and whether it began in an earlier block.
                    earlier = depth > base
                    held = [] if earlier else None
                at, start, place = stop, 0, 0
                if inside:
                    end = REST.match(text)
                    inside, place = end is None, len(text) if end is None else end.end()
                for mark in MARK.finditer(text, place):
                    c = text[mark.start()]
                    if c == '"':
                        inside = not mark[1]
                    elif c in "{[":
                        if c == "{" and depth == base:
                            start, held = mark.start(), []
                        depth += 1
                    else:
                        depth -= 1
                        if depth == base and held is not None:
                            held.append(text[start:mark.end()])
                            out("end" if earlier else "whole", "".join(held))
                            number, earlier, held = number + 1, False, None
                if held is not None:
                    held.append(text[start:])
            if rows:
                yield pa.RecordBatch.from_pylist(rows)
        if held is not None:
            number, rows = number, []
            yield pa.RecordBatch.from_pylist([dict(_path=key[0], _block=key[1], _pos=key[1] + number,
                                                   _kind="middle" if earlier else "begin", _text="".join(held))])

    return placed.mapInArrow(cut, "_path string, _block long, _pos long, _kind string, _text string")


def _mended(borders: DataFrame) -> DataFrame:
    """Objects that cross borders, from at most two pieces per block."""
    order = Window.partitionBy("_path").orderBy("_block", "_pos")
    begins = F.count_if(F.col("_kind") == "begin").over(order)
    before = Window.partitionBy("_path", "_object").orderBy("_block", "_pos").rowsBetween(Window.unboundedPreceding, -1)
    ended = F.coalesce(F.count_if(F.col("_kind") == "end").over(before), F.lit(0))
    # What an element that is no object leaves has no beginning of its own.
    own = borders.withColumn("_object", begins).withColumn("_ended", ended).filter("_object > 0 AND _ended = 0")
    pieces = F.sort_array(F.collect_list(F.struct("_block", "_pos", "_text"))).alias("_pieces")
    return own.groupBy("_path", "_object").agg(pieces).select(
        "_path", F.col("_pieces")[0]["_block"].alias("_block"), F.col("_pieces")[0]["_pos"].alias("_pos"),
        F.concat_ws("", F.col("_pieces._text")).alias("_text"))
