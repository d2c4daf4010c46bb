"""Quality classifier: cumulative-link regression on graded ratings over hashed text.

One weight per text feature, shared by all grades, gives a text's position on a line; ordered thresholds cut the line
into grades: P(grade > k) = 1 / (1 + exp(threshold_k - position)). So a text has a probability of reaching each grade
and an expected grade. The weights are fitted on a bounded sample of rated documents; scoring reads every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common

#: Features are hashed to so many bits.
BITS = 22
#: Rated documents to learn from, about so many, chosen by a hash of their id.
SAMPLE = 12_000
#: A feature must occur in so many documents of the sample; for each threshold the most telling ones are used, at most so
#: many.
LEAST_DOCS, FEATURES = 5, 4096
STEPS, RATE, DECAY = 600, 0.05, 3e-5
#: A text is selected if it is good with at least this probability: a little less than even, so that clean texts stay.
LEAST_GOOD = 0.45
_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def fit(rated: DataFrame, text_col="text", grade_col="grade", sample=SAMPLE):
    """The model (feature numbers in order, their weights, thresholds) of rated texts.

    Grades are whole numbers from 0. Rows without a grade are left out; a missing text counts as empty. With fewer than
    two grades every text gets the one grade there is, or 0.
    """
    rows = common.texts(rated, F.col(grade_col).cast("int").alias("__grade"), text=text_col).where("__grade IS NOT NULL")
    rows = common.staged(common.mapped(rows, _rows, "__grade int, __features array<int>, __values array<float>"), "rated")
    grades = [r[0] for r in rows.select("__grade").distinct().orderBy("__grade").collect()]
    if len(grades) < 2:
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(0), grades or [0]
    # For each threshold, how far the share above it of the documents with a feature lies from that of all documents,
    # in standard errors: a feature of a middle grade tells nothing by its mean grade.
    above = [F.avg((F.col("__grade") > g).cast("int")).alias(f"above{i}") for i, g in enumerate(grades[:-1])]
    share = rows.agg(*above).first()
    met = rows.select("__grade", F.explode("__features").alias("f")).groupBy("f").agg(
        F.count("*").alias("n"), *above).where(F.col("n") >= LEAST_DOCS)
    met, found = common.staged(met, "met"), set()
    for i, overall in enumerate(share):
        telling = met.withColumn("z", F.abs(F.col(f"above{i}") - overall) * F.sqrt("n")).orderBy(F.desc("z"), "f")
        found.update(r[0] for r in telling.limit(FEATURES).select("f").collect())
    chosen = np.array(sorted(found), np.int64)

    def narrow(batches):
        for batch in batches:
            features, ends = _flat(batch.column("__features"))
            values, _ = _flat(batch.column("__values"))
            at = np.minimum(np.searchsorted(chosen, features), max(len(chosen) - 1, 0))
            keep = chosen[at] == features if len(chosen) else np.zeros(len(features), bool)
            kept = np.concatenate([[0], np.cumsum(keep)])[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                batch.column("__grade"), pa.ListArray.from_arrays(kept, at[keep].astype(np.int32)),
                pa.ListArray.from_arrays(kept, values[keep].astype(np.float32))], ["g", "f", "v"])

    # Bounded: the sample's documents by the chosen features.
    table = common.mapped(rows, narrow, "g int, f array<int>, v array<float>").toArrow()
    features, ends = _flat(table.column("f").combine_chunks())
    values, _ = _flat(table.column("v").combine_chunks())
    grade = np.searchsorted(grades, table.column("g").to_numpy())
    weights, thresholds = _descend(features, values.astype(np.float64), ends, grade, len(chosen), len(grades))
    return chosen, weights, thresholds, grades


def _descend(features, values, ends, grade, width, levels):
    """Maximum likelihood with a small penalty on the weights, by adaptive gradient steps over the whole sample."""
    rows = len(grade)
    owner = np.repeat(np.arange(rows), np.diff(ends))
    above = np.array([np.mean(grade > k) for k in range(levels - 1)]).clip(1e-3, 1 - 1e-3)
    # The thresholds are a first one and positive steps, so they stay in order.
    first = -np.log(above / (1 - above))
    param = np.concatenate([np.zeros(width), first[:1], np.log(np.maximum(np.diff(first), 1e-2))])
    one, two = np.zeros_like(param), np.zeros_like(param)
    for step in range(1, STEPS + 1):
        weights, steps = param[:width], np.exp(param[width + 1:])
        thresholds = param[width] + np.concatenate([[0], np.cumsum(steps)])
        position = np.bincount(owner, values * weights[features], rows)
        # P(grade > k) for k = -1 .. levels - 1, and the chance of the grade itself.
        reach = np.concatenate([np.ones((rows, 1)), _sigmoid(position[:, None] - thresholds), np.zeros((rows, 1))], 1)
        low, high = reach[np.arange(rows), grade], reach[np.arange(rows), grade + 1]
        chance = np.maximum(low - high, 1e-12)
        pull_low, pull_high = low * (1 - low) / chance, high * (1 - high) / chance
        slope = pull_low - pull_high
        gradient = np.zeros_like(param)
        gradient[:width] = np.bincount(features, values * slope[owner], width) / rows - DECAY * weights
        each = np.zeros(levels + 1)
        np.subtract.at(each, grade, pull_low)
        np.add.at(each, grade + 1, pull_high)
        each = each[1:levels] / rows
        gradient[width] = each.sum()
        gradient[width + 1:] = steps * (each[::-1].cumsum()[::-1][1:])
        one, two = 0.9 * one + 0.1 * gradient, 0.999 * two + 0.001 * gradient**2
        param = param + RATE * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.999**step)) + 1e-8)
    return param[:width], param[width] + np.concatenate([[0], np.cumsum(np.exp(param[width + 1:]))])


def score(df: DataFrame, model, id_cols=("doc_id",), text_col="text") -> DataFrame:
    """``id_cols`` with ``expected_grade`` and ``reaches``: an array of the probabilities of reaching each grade above
    the lowest. A missing text counts as empty and has the position 0. Repeated rows and ids each give their row; other
    columns are dropped."""
    source, text = common.kept_texts(df, id_cols, text_col)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        chosen, weights, thresholds, grades = sent.value
        table = np.zeros(1 << BITS, np.float32)
        table[chosen] = weights
        for batch in common.slices(batches, text):
            features, values, ends = featured(batch.column(text))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            position = np.bincount(owner, values * table[features], batch.num_rows)
            reach = _sigmoid(position[:, None] - thresholds)
            grade = grades[0] + reach @ np.diff(grades)
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * len(thresholds)
            rest = batch.drop_columns(["__text"]) if text == "__text" else batch
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array(grade.astype(np.float64)), pa.ListArray.from_arrays(ends, reach.ravel())],
                [*rest.schema.names, "expected_grade", "reaches"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__text"]
    out = common.mapped(source, run, ", ".join([*kinds, "expected_grade double", "reaches array<double>"]))
    return out.withColumnsRenamed({f"__id{i}": c for i, c in enumerate(id_cols)})


def selected(least=LEAST_GOOD):
    """Whether a scored text reaches the highest grade with at least this probability. Where there are no two grades to
    tell apart, every text is selected."""
    return F.coalesce(F.try_element_at("reaches", F.lit(-1)), F.lit(1.0)) >= least


def rated(docs: DataFrame, labels: DataFrame, sample=SAMPLE) -> DataFrame:
    """Ids, texts and grades of a bounded sample of rated documents: 0 for low quality, 1 for good but toxic, 2 for good.

    About ``sample`` different pairs of id and text are drawn by their hash, or all if there are no more. Of several
    ratings of an id the lowest counts; ratings that lack the id, the quality or, where it is good, the toxicity do not.
    Documents that repeat in id and text are one, a missing text is an empty one. Empty tables give no rows.
    """
    common.small_batches(docs.sparkSession)
    grade = F.when(F.col("quality") == 0, 0).otherwise(F.col("quality") * (2 - F.col("toxic"))).cast("int")
    grades = labels.select("doc_id", grade.alias("grade")).dropna().groupBy("doc_id").agg(F.min("grade").alias("grade"))
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    named = docs.select("doc_id", text).withColumn("__hash", F.xxhash64("text"))
    pairs = common.staged(named.select("doc_id", "__hash").distinct().join(grades, "doc_id"), "rated-pairs")
    share = min(1.0, sample / max(pairs.count(), 1))
    drawn = pairs.where(F.pmod(F.xxhash64("doc_id", "__hash", F.lit(7)), F.lit(1_000_000)) < share * 1_000_000)
    # At most about ``sample`` rows of numbers, however often an id or a text occurs.
    found = named.join(F.broadcast(drawn), ["doc_id", "__hash"])
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, __hash bigint, text string, grade int"
    once = common.mapped(found.select("doc_id", "__hash", "text", "grade"), _once, kinds)
    return once.dropDuplicates(["doc_id", "__hash"]).select("doc_id", "text", "grade")


def _once(batches):
    """The rows without those whose id and text this task met before: at most as many are kept as were drawn."""
    seen = set()
    for batch in batches:
        keep = []
        for i, key in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("__hash").to_pylist())):
            if key not in seen:
                seen.add(key)
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))


def featured(column):
    """Features (hashed), their values and each text's end: words without their closing marks in lower case, the marks
    that close a word, words in capitals, and the text's length; a value grows with the logarithm of the count."""
    data, offsets = common.buffers(column)
    starts, ends, first = common.words(data, offsets)
    rows = len(offsets) - 1
    owner = np.repeat(np.arange(rows), np.diff(first))
    # The last letter or digit of each word: what follows it are its closing marks.
    letter = np.concatenate([[-1], np.maximum.accumulate(np.where(_LETTER[data], np.arange(len(data)), -1))])
    stem = np.maximum(letter[ends] + 1, starts)
    hashes = common.hash_spans(common.lowered(data), starts, stem)
    marked = np.flatnonzero(stem < ends)
    marks = common.hash_spans(data, stem[marked], ends[marked]) ^ np.uint64(0xABCD)
    caps = np.concatenate([[0], np.cumsum(_UPPER[data])])
    loud = np.flatnonzero((caps[stem] - caps[starts] == stem - starts) & (stem - starts > 2))
    size = np.ceil(np.log2(np.diff(first) + 1)).astype(np.uint64)
    feature = np.concatenate([hashes, marks, np.full(len(loud), 0x10D, np.uint64), size + np.uint64(0x512E)])
    feature = (common.mix(feature) >> np.uint64(64 - BITS)).astype(np.int64)
    owner = np.concatenate([owner, owner[marked], owner[loud], np.arange(rows)])
    key, count = np.unique(owner << BITS | feature, return_counts=True)
    return key & ((1 << BITS) - 1), 1 + np.log(count), np.searchsorted(key, np.arange(rows + 1) << BITS)


def _rows(batches):
    for batch in common.slices(batches, "__text"):
        features, values, ends = featured(batch.column("__text"))
        ends = ends.astype(np.int32)
        yield pa.RecordBatch.from_arrays([
            batch.column("__grade"), pa.ListArray.from_arrays(ends, features.astype(np.int32)),
            pa.ListArray.from_arrays(ends, values.astype(np.float32))], ["__grade", "__features", "__values"])


def _flat(lists):
    ends = lists.offsets.to_numpy()
    return lists.flatten().to_numpy(zero_copy_only=False), ends - ends[0]


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))
