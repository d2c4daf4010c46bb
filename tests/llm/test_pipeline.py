"""The pipeline's stages on a small table, against plain versions, and on odd and empty tables."""

import random
from collections import Counter

import pytest

import corpus_pipeline
from flowtide.llm import jaccard
from flowtide.session import scratch_dir

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, lang_pred int, kept int"


@pytest.fixture(scope="module")
def sf_dir(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("aeioutrnsl") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = prose(110)
    texts = [prose(120) for _ in range(40)] + [prose(30) + " " + passage + " " + prose(30) for _ in range(4)]
    texts += [texts[0], texts[1] + " more", None, "", "12 %", prose(60) + " %%%" * 40]
    rows = [(i, t, "en", "s", len(t or ""), "k", 1, 2) for i, t in enumerate(texts)]
    rows += [rows[5], (None, texts[6], None, None, None, None, None, None)]
    path = scratch_dir(spark)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 0 if "%%%" in (t or "") else 1, 0) for i, t in enumerate(texts)] + [(1, None, 0)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = f"{scratch_dir(spark)}/out"
        out = stage(spark, docs, sf_dir)
        assert out.schema.simpleString() == docs.schema.simpleString()
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = docs.collect()
    known = Counter(r.doc_id for r in kept["language"])
    assert known[46] == known[47] == known[48] == 0 and known[5] == 2 and known[None] == 1 and len(known) == 48
    assert Counter(r.doc_id for r in kept["near duplicates"]).most_common(1)[0][1] == 1
    left = {r.doc_id: r for r in kept["near duplicates"]}
    assert 0 in left and 44 not in left and 1 in left and 45 not in left and None not in left and set(range(2, 40)) <= {*left}
    cut = {r.doc_id: r for r in kept["repeats"]}
    assert cut.keys() == left.keys()
    assert all(cut[i].text == left[i].text for i in range(2, 40))
    assert all(len(cut[i].text) < len(left[i].text) / 2 + 60 and cut[i].n_chars == len(cut[i].text) for i in range(40, 44))
    packed = corpus_pipeline.pack_documents(spark, docs, sf_dir).collect()
    assert {r.doc_id for r in packed} == left.keys()


def test_documents_that_are_certainly_kept_are_not_joined(spark, monkeypatch):
    word = lambda i, j: f"w{i}x{j}"
    texts = [" ".join(word(i, j) for j in range(30)) for i in range(300)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, texts[6], "en"), (None, texts[6], "en"), (900, texts[7] + " end", "en"),
             (8, texts[8], "de"), (901, None, "en"), (902, "", "en"), (902, "", "en"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(3)
    joined = []
    sifted = jaccard.sifted

    def counted(*args):
        sure, rest = sifted(*args)
        joined.append(rest.count())
        return sure, rest

    monkeypatch.setattr(jaccard, "sifted", counted)
    kept = Counter(tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, None).collect())
    # Of the two rows of id 8 one is the least by its hash.
    eight = [r for r in kept if r[0] == 8]
    want = Counter({r: 1 for r in rows[:300] + [rows[306], rows[307], rows[309]] if r[0] != 8})
    assert len(eight) == 1 and kept == want + Counter(eight)
    assert 10 <= joined[0] < 60


def test_run_equals_its_stages(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.count() > 40


def test_quality_stage_rejects_low_and_toxic(spark):
    rng = random.Random(14)
    more = {0: ["%%%"] * 9, 1: ["rude", "nasty"], 2: []}
    text = lambda g: " ".join([f"w{rng.randrange(50)}" for _ in range(40)] + more[g])
    rows = [(i, text(i % 3), "en") for i in range(450)]
    path = scratch_dir(spark)
    # A third of the documents have no rating.
    labels = [(i, int(i % 3 > 0), int(i % 3 == 1)) for i in range(300)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.classify_quality(spark, docs, path).collect()}
    unrated = range(300, 450)
    assert [sum(i in kept for i in unrated if i % 3 == g) for g in (0, 1)] == [0, 0]
    assert sum(i in kept for i in unrated if i % 3 == 2) >= 45


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []
