"""Registered queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowtide.session import scratch_dir

from . import (
    bpe, centroids, divergence, jaccard, langid, ordinal, packing, quantised, repeats, repetition, tokenfiles, topk, warc)
from .common import table
from .sql import ORACLE


def op1_jaccard(spark, sf_dir):
    """Component of every document under Jaccard links of five-word shingles."""
    return jaccard.components(table(spark, sf_dir, "documents"))


def op2_warc(spark, sf_dir):
    """Write a WARC capture of every page, read the archives and put the captures together again."""
    path = f"{scratch_dir(spark)}/warc"
    archives = warc.write(warc.deduplicated(table(spark, sf_dir, "pages")), path)
    captures = warc.transactions(warc.read(spark, path, archives), payload=False)
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "target_uri",
                           "request", "response", "metadata")


def op3_packing(spark, sf_dir):
    """Place of every piece of every document in sequences of 4096 tokens."""
    packed = packing.packed(table(spark, sf_dir, "documents"), keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_language(spark, sf_dir):
    """Language of every document, learned from four fifths of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    model = langid.learned(docs.where(~held_out))
    return langid.predict(docs.withColumn("held_out", held_out), model, ("doc_id", "held_out"))


def op5_topk(spark, sf_dir):
    """The 20 vectors of the greatest integer inner product for every 20th vector."""
    vectors = topk.quantised(table(spark, sf_dir, "embeddings"))
    return topk.search(vectors, F.col("id") % 20 == 0, 20)


def op6_bpe(spark, sf_dir):
    """Encode and decode every document."""
    ids = bpe.decode(bpe.encode(table(spark, sf_dir, "documents")))
    return ids.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_token_files(spark, sf_dir):
    """Write token files of all documents and read them back."""
    path = f"{scratch_dir(spark)}/tokens"
    files = tokenfiles.write(table(spark, sf_dir, "documents"), path)
    return tokenfiles.read(spark, path, files).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_quality(spark, sf_dir):
    """Expected grade of every document, and whether it is selected as good."""
    docs = table(spark, sf_dir, "documents")
    scored = ordinal.score(docs, ordinal.fit(ordinal.rated(docs, table(spark, sf_dir, "labels"))))
    return scored.select("doc_id", "expected_grade", F.get("reaches", F.lit(0)).alias("p_not_low"),
                         F.get("reaches", F.lit(1)).alias("p_good"), ordinal.selected().alias("selected"))


def op9_repeats(spark, sf_dir):
    """Remove every byte covered by a 400-byte string that also starts elsewhere."""
    cut = repeats.removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_repetition(spark, sf_dir):
    """Repetition measures and verdict for every document."""
    judged = repetition.judge(repetition.measure(table(spark, sf_dir, "documents")))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return judged.select(*first, *(c for c in judged.columns if c not in first))


def op11_divergence(spark, sf_dir):
    """Divergence of every two sources of a language, and the terms that set each source apart."""
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_near_vectors(spark, sf_dir):
    """Links and component of every vector among those of its label."""
    return quantised.near_duplicates(table(spark, sf_dir, "embeddings"))


def op13_centroids(spark, sf_dir):
    """Cluster of every vector after three rounds from sixteen centroids."""
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (
    op1_jaccard, op2_warc, op3_packing, op4_language, op5_topk, op6_bpe, op7_token_files, op8_quality, op9_repeats,
    op10_repetition, op11_divergence, op12_near_vectors, op13_centroids)}
__all__ = ["ORACLE", "QUERIES"]
