"""Corpus preparation: language identification, quality classifier, near-duplicate join, repeat removal, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows of ``docs``; its result is written and read again as the
next one's ``docs``. All but the last return the columns of ``docs``, whatever they are, beside ``doc_id``, ``text``,
``lang``. Documents may repeat, and any column may be null.
"""

from pyspark.sql import functions as F

from flowtide.llm import jaccard, langid, ordinal, packing, repeats
from flowtide.llm.common import staged
from flowtide.session import scratch_dir

#: A document's language must have at least this probability.
LEAST_LANGUAGE = 0.5


def _numbered(docs):
    """``docs`` with its columns named c0, c1, ... so that no operator's result can clash with them, the place of the
    text among them, and the columns that restore the names."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain = docs.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(docs.columns, names)))
    back = [F.col(n).alias(c) for c, n in zip(docs.columns, names)]
    return plain, names, names[docs.columns.index("text")], back


def identify_language(spark, docs, sf_dir):
    """Keep documents whose language is known: not those without a letter or text, nor undecided ones."""
    model = langid.learned(docs)
    plain, names, text, back = _numbered(docs)
    known = langid.predict(plain, model, names, text)
    undecided = (F.col("lang_pred") == "und") | (F.col("score") < LEAST_LANGUAGE)
    return known.where(~undecided if model[0] else F.lit(True)).select(*back)


def classify_quality(spark, docs, sf_dir):
    """Keep documents that the classifier, fitted on rated documents of its input, selects as good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = ordinal.fit(ordinal.rated(docs, labels))
    plain, names, text, back = _numbered(docs)
    return ordinal.score(plain, model, names, text).where(ordinal.selected()).select(*back)


def drop_near_duplicates(spark, docs, sf_dir):
    """Keep the document of the least id of each component, and one of rows that are equal in every column. Documents that
    are certainly kept, those with a key of their own and the least in their component, stay where they are."""
    plain, names, text, back = _numbered(docs)
    own = names[docs.columns.index("doc_id")]
    key = F.struct(F.col(own).isNull().alias("missing"), F.col(own).alias("id"), F.xxhash64(*names).alias("hash"))
    rows = plain.withColumn("key", key)
    found = jaccard.components(rows, "key", text)
    least = F.coalesce(F.col("key") == F.col("component_id"), F.lit(False)).alias("least")
    found = staged(found.groupBy("key", least).agg(F.count("*").alias("copies")), "least")
    kept = found.where("least").select("key")
    doubt = found.where("NOT least OR copies > 1").select(F.col("key.hash").alias("th"))
    sure, rest = jaccard.sifted(rows, F.col("key.hash"), doubt)
    return sure.unionByName(rest.join(kept, "key", "left_semi").dropDuplicates(["key"])).select(*back)


def remove_repeats(spark, docs, sf_dir):
    """Take out what is covered by 400-byte strings that also occur elsewhere; every document stays, if with an empty
    text. A character that a cut goes through becomes the replacement character. ``n_chars`` follows the text."""
    plain, names, text, back = _numbered(docs)
    cut = repeats.removed(plain, text)
    left = F.when(F.col(text).isNull(), None).when(F.col("n_removed") == 0, F.col(text)).otherwise(
        F.make_valid_utf8(F.col("kept").cast("string")))
    columns = []
    for c, n in zip(docs.columns, names):
        value = F.col(n)
        if c == "text":
            value = left
        elif c == "n_chars":
            value = F.when(F.col("n_removed") > 0, F.length(left).cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return cut.select(*columns)


def pack_documents(spark, docs, sf_dir):
    """Place of every piece of every document in sequences of 4096 tokens."""
    return packing.packed(docs, keep_ids=False)


STAGES = [
    ("language", identify_language), ("quality", classify_quality), ("near duplicates", drop_near_duplicates),
    ("repeats", remove_repeats), ("packing", pack_documents),
]
#: Tokenising, learning and suffix order have no form in SQL. The tests look at which rows each stage keeps; they have no
#: plain version of the language, quality and packing stages.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{scratch_dir(spark)}/{i}-{name.replace(' ', '-')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
