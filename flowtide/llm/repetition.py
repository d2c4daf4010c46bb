"""Quality rules by repetition coverage: characters inside duplicated word windows and duplicated lines.

For every text, rolling hashes over 5 to 10 words find the windows that occur twice or more in it; a character of a word
is covered if any such window of the given length holds it. Rows are independent, so there is no shuffle, and a task
holds about two megabytes of text at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import common

#: Largest share of word characters that may lie in windows of so many words that occur twice or more, first included.
#: Published thresholds for repeated n-grams of web text.
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of word characters in lines that equal an earlier line.
LINE_COVERAGE = 0.20
#: Base rules: least number of words, and largest percentage of words in repeated five-word windows.
LEAST_WORDS, MOST_REPEATED = 10, 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "dup_line_chars", "n_repeat_words"]


def measure(df: DataFrame, id_col="doc_id", text_col="text", lengths=tuple(COVERAGE)) -> DataFrame:
    """Per row: the id and the counts below, all long.

    ``n_words``, ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines`` (lines with a word that equal an
    earlier line), ``dup_line_chars`` (their word characters), ``n_repeat_words`` (words in repeated five-word windows)
    and for each window length ``dup_chars_<n>``. Words are runs of characters other than blank and tab to carriage
    return. A missing or empty text has zeros. Repeated rows and ids each give their row; other columns are ignored.
    """
    names = [*COUNTS, *(f"dup_chars_{n}" for n in lengths)]
    source = common.texts(df, F.col(id_col).alias("__id"), text=text_col)

    def run(batches):
        for batch in common.slices(batches, "__text"):
            found = _measure(batch.column("__text"), lengths)
            yield pa.RecordBatch.from_arrays([batch.column("__id"), *(pa.array(x, pa.int64()) for x in found)],
                                             ["__id", *names])

    kind = source.schema["__id"].dataType.simpleString()
    return common.mapped(source, run, f"`__id` {kind}, " + ", ".join(f"{n} bigint" for n in names)).withColumnRenamed(
        "__id", id_col)


def judge(measured: DataFrame, coverage=None, line_coverage=LINE_COVERAGE) -> DataFrame:
    """``base_failed`` (too few words, or over a fifth of them in repeated windows) and ``kept``: not failed, and no
    coverage above its threshold. A text without words fails the base rules."""
    chars = F.greatest(F.col("word_chars"), F.lit(1))
    base = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    fine = F.col("dup_line_chars") <= line_coverage * chars
    for n, most in (coverage or COVERAGE).items():
        fine &= F.col(f"dup_chars_{n}") <= most * chars
    return measured.withColumn("base_failed", base).withColumn("kept", ~base & fine)


def _measure(column, lengths) -> list[np.ndarray]:
    data, offsets = common.buffers(column)
    starts, ends, first = common.words(data, offsets)
    rows = len(offsets) - 1
    heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = heads[ends] - heads[starts]
    before = np.concatenate([[0], np.cumsum(chars)])
    symbols = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    owner = np.repeat(np.arange(rows), np.diff(first))
    hashes = common.hash_spans(data, starts, ends)
    out = [np.diff(first), np.diff(before[first]), np.diff(symbols[offsets])]
    out += _lines(column, rows)
    seed = common.mix(owner.astype(np.uint64) + np.uint64(77))
    places = np.arange(len(starts))
    for n in sorted({5, *lengths}):
        # A window of n words repeats only if the shorter windows at its place do.
        places = places[places + n <= len(starts)]
        places = places[owner[places] == owner[places + n - 1]]
        keys = np.zeros(len(places), np.uint64)
        for i, k in enumerate(common.multipliers(n)):
            keys += hashes[places + i] * k
        keys = common.mix(common.mix(keys) ^ seed[places])
        order = np.argsort(keys)
        same = keys[order[1:]] == keys[order[:-1]]
        twice = np.zeros(len(places), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        places = places[twice]
        cover = np.zeros(len(starts) + 1, np.int64)
        np.add.at(cover, places, 1)
        np.add.at(cover, places + n, -1)
        inside = np.cumsum(cover[:-1]) > 0
        if n == 5:
            held = np.concatenate([[0], np.cumsum(inside)])
            out.append(np.diff(held[first]))
        if n in lengths:
            held = np.concatenate([[0], np.cumsum(inside * chars)])
            out.append(np.diff(held[first]))
    return out


def _lines(column, rows):
    """Lines with a word that equal an earlier line of their text, and the characters of their words."""
    count, chars = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    for i, text in enumerate(pc.fill_null(column, "").to_pylist()):
        lines = text.split("\n")
        if len(lines) == len(set(lines)):
            continue
        seen = set()
        for line in lines:
            if line in seen:
                ink = len(line.translate(_BLANKS))
                count[i] += ink > 0
                chars[i] += ink
            seen.add(line)
    return [count, chars]


_BLANKS = dict.fromkeys([9, 10, 11, 12, 13, 32])
