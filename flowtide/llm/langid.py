"""Language identification by unigram pieces, summed over all segmentations.

For each language, every piece of a fixed public vocabulary has a probability. A word's probability is the sum, over all
ways to cut it into pieces, of the products of their probabilities; a forward algorithm adds them up. A text's score
is the product over its words. The probabilities come from expectation maximisation over labelled texts: the expected
numbers of pieces are computed and summed in Spark, and only a table of languages by pieces reaches the driver.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from . import common

VOCABULARY = "piece_bpe_32k.model"
#: Different texts to learn from, for each language about so many, chosen by their hash.
SAMPLE = 600
ROUNDS = 3
#: Characters of the vocabulary's longest piece; probability of a character that is no piece; added to expected counts.
LONGEST, UNKNOWN, PRIOR = 16, 1e-7, 0.05
#: Words of more characters are handled together with somewhat longer ones.
WORD = 32
#: Most words a scorer keeps, and as many times WORD characters.
CACHE = 150_000
_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.cumprod(np.append(np.ones(1, np.uint64), np.full(LONGEST, _BASE)))


def learned(df: DataFrame, text_col="text", lang_col="lang", vocabulary=VOCABULARY, sample=SAMPLE, rounds=ROUNDS):
    """The model (languages in order, piece hashes in order, log probabilities) of the labelled texts in ``df``.

    Rows without a text or language are left out. Without any, the model has no language.
    """
    common.small_batches(df.sparkSession)
    rows = common.texts(df, F.col(lang_col).cast("string").alias("__lang"), text=text_col, empty=False).where(
        F.col("__lang").isNotNull() & F.col("__text").isNotNull())
    rows = rows.withColumn("__hash", F.xxhash64("__text"))
    # Copies of a text count once, so they neither crowd out other texts nor stay out together.
    sizes = {r[0]: r[1] for r in rows.select("__lang", "__hash").distinct().groupBy("__lang").count().collect()}
    languages = sorted(sizes)
    hashes = piece_hashes(common.vocabulary(vocabulary))
    if not languages:
        return [], hashes, np.zeros((len(hashes), 0))
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, sample / sizes[k]))))
    # With at most ``sample`` texts the share is 1; above, about ``sample`` are drawn.
    chosen = F.pmod("__hash", F.lit(10**15)) < share[F.col("__lang")] * 10**15
    index = F.create_map(*(F.lit(x) for i, k in enumerate(languages) for x in (k, i)))
    drawn = common.mapped(rows.where(chosen).select(index[F.col("__lang")].alias("__lang"), "__hash", "__text"), _once,
                          "__lang int, __hash bigint, __text string").dropDuplicates(["__lang", "__hash"])
    words = common.mapped(drawn.select("__lang", "__text"), _counted, "lang int, word string, n bigint")
    words = common.staged(words.groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    weights = np.full((len(hashes), len(languages)), 1 / len(hashes))
    for _ in range(rounds):
        weights = _maximised(words, hashes, weights)
    return languages, hashes, np.log(weights)


def _once(batches):
    """The rows without those whose language and text this task met before."""
    seen = set()
    for batch in batches:
        keep = []
        for i, key in enumerate(zip(batch.column("__lang").to_pylist(), batch.column("__hash").to_pylist())):
            if key not in seen:
                seen.add(key)
                keep.append(i)
        yield batch.take(pa.array(keep, pa.int64()))


def _counted(batches):
    from collections import Counter

    for batch in common.slices(batches, "__text"):
        found: Counter = Counter()
        for lang, text in zip(batch.column("__lang").to_pylist(), batch.column("__text").to_pylist()):
            for word, n in Counter(words_of(text)).items():
                found[lang, word] += n
        langs, words = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.int32()), pa.array(words, pa.string()), pa.array(list(found.values()), pa.int64())],
            ["lang", "word", "n"])


def _maximised(words: DataFrame, hashes, weights) -> np.ndarray:
    """Piece probabilities from the expected piece counts under ``weights``."""
    sent = words.sparkSession.sparkContext.broadcast((hashes, weights))

    def run(batches):
        hashes, weights = sent.value
        total = np.zeros(weights.shape)
        for batch in batches:
            langs, n = batch.column("lang").to_numpy(), batch.column("n").to_numpy()
            for some, codes, size in by_length(batch.column("word").to_pylist()):
                expected(codes, hashes, weights, langs[some], n[some], total, size)
        piece, lang = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(piece), pa.array(total[piece, lang])],
                                         ["lang", "piece", "n"])

    sums = common.mapped(words, run, "lang bigint, piece bigint, n double").groupBy("lang", "piece").agg(F.sum("n"))
    total = np.full(weights.shape, PRIOR)
    for lang, piece, n in sums.collect():
        total[piece, lang] += n
    return total / total.sum(0)


def predict(df: DataFrame, model, id_cols=("doc_id",), text_col="text") -> DataFrame:
    """``id_cols`` with ``lang_pred`` and ``score``, the probability of that language given the text.

    A missing text, one without a letter, or a model without languages gives ``und`` and 0. Of equally probable
    languages the first in order is taken. Repeated rows and ids each give their row; other columns are dropped.
    """
    source, text = common.kept_texts(df, id_cols, text_col)
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != "__text"]
    scored = common.mapped(source, _predictor(df.sparkSession, model, text),
                           ", ".join([*kinds, "lang_pred string", "score double"]), keeps=True)
    return scored.withColumnsRenamed({f"__id{i}": c for i, c in enumerate(id_cols)})


def _predictor(spark, model, text):
    languages = [*model[0], "und"]
    sent = spark.sparkContext.broadcast(model[1:])
    key = uuid.uuid4().hex

    def run(batches):
        scorer = common.kept_in_worker(key, lambda: Scorer(*sent.value))
        for batch in common.slices(batches, text):
            best, score = scorer.best(pc.fill_null(batch.column(text), "").to_pylist())
            rest = batch.drop_columns(["__text"]) if text == "__text" else batch
            yield pa.RecordBatch.from_arrays(
                [*rest.columns, pa.array([languages[i] for i in best]), pa.array(score)],
                [*rest.schema.names, "lang_pred", "score"])

    return run


class Scorer:
    """Scores texts; the words met last keep their scores in a table of bounded size."""

    def __init__(self, hashes, logs):
        self.hashes, self.weights = hashes, np.exp(logs)
        self.known: dict[str, int] = {}
        self.letters = 0
        self.scores = np.zeros((0, logs.shape[1]))

    def best(self, texts):
        """Per text, the number of the most probable language (-1 for none) and its probability."""
        found = [words_of(t) for t in texts]
        wanted = set()
        for words in found:
            wanted.update(words)
        if len(self.known) > CACHE or self.letters > WORD * CACHE:
            self.known, self.scores, self.letters = {}, self.scores[:0], 0
        fresh = [w for w in wanted if w not in self.known]
        if fresh:
            added = np.zeros((len(fresh), self.scores.shape[1]))
            for some, codes, size in by_length(fresh):
                added[some] = forward(codes, self.hashes, self.weights, size)
            self.known.update(zip(fresh, range(len(self.scores), len(self.scores) + len(fresh))))
            self.scores = np.concatenate([self.scores, added])
            self.letters += sum(map(len, fresh))
        best, score = np.full(len(texts), -1), np.zeros(len(texts))
        if not self.scores.shape[1]:
            return best, score
        for i, words in enumerate(found):
            if words:
                total = self.scores[list(map(self.known.__getitem__, words))].sum(0)
                best[i] = total.argmax()
                score[i] = 1 / np.exp(total - total.max()).sum()
        return best, score


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case, each marked at its start."""
    return ["▁" + w for w in _LETTERS.findall(text.lower())]


def by_length(words: list[str]):
    """(places, characters as a matrix, lengths) of the words of each length; those above ``WORD`` go together with up
    to a quarter longer ones, filled up with zeros."""
    size = np.array([len(w) for w in words], np.int64)
    order = np.argsort(size, kind="stable")
    start = 0
    while start < len(order):
        least = int(size[order[start]])
        most = least if least <= WORD else least + least // 4
        stop = min(int(np.searchsorted(size, most, "right", sorter=order)), start + max(1, 20_000 * WORD // max(most, WORD)))
        some = order[start:stop]
        width = int(size[some[-1]])
        data = "".join([words[i].ljust(width, "\0") for i in some.tolist()]).encode("utf-32-le", "surrogatepass")
        yield some, np.frombuffer(data, np.uint32).reshape(len(some), width), size[some]
        start = stop


def piece_hashes(path: str) -> np.ndarray:
    """Hashes of the vocabulary's pieces, in lower case, in ascending order."""
    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=path)
    found = set()
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i).lower()
        if not (processor.is_control(i) or processor.is_unknown(i) or processor.is_byte(i)):
            if len(piece) > LONGEST:
                raise ValueError(f"the vocabulary has a piece of more than {LONGEST} characters")
            found.add(piece)
    hashes = [_hashed(codes) for _, codes, _ in by_length(sorted(found))]
    return np.unique(np.concatenate(hashes))


def _hashed(codes: np.ndarray) -> np.ndarray:
    out = np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1]):
        out = out * _BASE + codes[:, j] + np.uint64(1)
    return common.mix(out)


def _pieces(codes, hashes, j):
    """For each length n: the words whose last n characters before j are a piece, and the pieces."""
    raw = np.zeros(len(codes), np.uint64)
    for n in range(1, min(j, LONGEST) + 1):
        raw = raw + (codes[:, j - n] + np.uint64(1)) * _POWERS[n - 1]
        key = common.mix(raw)
        at = np.minimum(np.searchsorted(hashes, key), len(hashes) - 1)
        hit = np.flatnonzero(hashes[at] == key)
        if len(hit):
            yield n, hit, at[hit]


def forward(codes, hashes, weights, size=None) -> np.ndarray:
    """Log probabilities of words (rows of characters, the first ``size`` of each) under each language (columns of
    ``weights``)."""
    rows, width = codes.shape
    size = np.full(rows, width) if size is None else size
    # The last sums only, brought back to 1 before they can become too small.
    ring = LONGEST + 1
    alpha = np.zeros((ring, rows, weights.shape[1]))
    alpha[0] = 1
    scale, out = np.zeros(alpha.shape[1:]), np.zeros(alpha.shape[1:])
    for j in range(1, width + 1):
        now = alpha[j % ring]
        now[:] = alpha[(j - 1) % ring] * UNKNOWN
        for n, hit, piece in _pieces(codes, hashes, j):
            now[hit] += alpha[(j - n) % ring, hit] * weights[piece]
        done = np.flatnonzero(size == j)
        if len(done):
            out[done] = np.log(now[done]) + scale[done]
        if j % LONGEST == 0 and j < width:
            scale += np.log(now)
            alpha /= now.copy()
    return out


def expected(codes, hashes, weights, langs, n, total, size=None) -> None:
    """Add to ``total`` (pieces by languages) the expected number of each piece in words of a known language."""
    rows, width = codes.shape
    size = np.full(rows, width) if size is None else size
    logs, unknown, every = np.log(weights), np.log(UNKNOWN), np.arange(rows)
    alpha, beta = np.full((width + 1, rows), -np.inf), np.full((width + 1, rows), -np.inf)
    alpha[0], beta[size, every] = 0, 0
    for j in range(1, width + 1):
        alpha[j] = alpha[j - 1] + unknown
        for k, hit, piece in _pieces(codes, hashes, j):
            alpha[j, hit] = np.logaddexp(alpha[j, hit], alpha[j - k, hit] + logs[piece, langs[hit]])
    whole = alpha[size, every]
    for j in range(width, 0, -1):
        beta[j - 1] = np.logaddexp(beta[j - 1], beta[j] + unknown)
        for k, hit, piece in _pieces(codes, hashes, j):
            lang = langs[hit]
            after = beta[j, hit] + logs[piece, lang]
            beta[j - k, hit] = np.logaddexp(beta[j - k, hit], after)
            np.add.at(total, (piece, lang), np.exp(alpha[j - k, hit] + after - whole[hit]) * n[hit])
