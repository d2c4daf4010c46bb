"""Every registered query on small tables: against its SQL, brute force or the tokenizers library, column by column."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import oracle
from flowtide.llm import common, ordinal
from flowtide.llm.queries import ORACLE, QUERIES
from flowtide.session import scratch_dir

WORD = re.compile("[^\x20\x09-\x0d]+")
SF = f"{oracle.DATA}/sf0.001"


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(12)
    words = ["".join(rng.choice("aeioutrnsl") for _ in range(rng.randint(2, 7))) for _ in range(500)]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = prose(120), prose(80)
    texts = [prose(rng.randint(1, 200)) for _ in range(40)] + [prose(20) + "\n" + passage + " " + prose(9) for _ in range(5)]
    texts += [base, base, base.upper(), base + " more", None, "", " \n", "EVİ. Gel, EVİ! şimdi", "Straße 日本語 <|endoftext|>",
              "\n".join([prose(6)] * 9), "# $ | <b>", prose(11) + " " + passage]
    # One text above the bytes that a task handles at once.
    texts.append(" ".join(f"{rng.choice(words)}{rng.randrange(900)}" for _ in range(260_000)))
    return [(i, t, "en" if i % 3 else "de", f"s{i % 4}", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def sf_dir(spark, rows):
    path = scratch_dir(spark)
    kind = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 5 > 0), int(i % 7 == 1)) for i in range(45)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    pages = [(i, f"http://x/{i}", t) for i, t, *_ in rows[:-1]]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{path}/pages.parquet")
    return path


def result(spark, name, sf_dir, *columns):
    df = QUERIES[name](spark, sf_dir)
    assert df.columns[:len(columns)] == list(columns)
    return {r[0]: tuple(r)[1:len(columns)] for r in df.collect()}


def library(name):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(common.vocabulary(name))


@pytest.mark.parametrize("name", list(ORACLE))
def test_queries_equal_their_sql(spark, name):
    assert oracle.compare(spark, oracle.connect(SF), SF, QUERIES[name], ORACLE[name]) is None


def test_op1(spark, sf_dir, rows):
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}
    for _ in range(3):
        for i, a in sets.items():
            for j, b in sets.items():
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    got = result(spark, "op1_jaccard", sf_dir, "doc_id", "n_shingles", "component_id")
    assert got == {i: (len(s), root[i]) for i, s in sets.items()}


def test_op2(spark, sf_dir, rows):
    df = QUERIES["op2_warc"](spark, sf_dir)
    assert df.columns[:5] == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    body = {i: (t or "").encode() for i, t, *_ in rows[:-1]}
    kept = {b: i for i, b in sorted(body.items())}
    got = {r.page_id: r for r in df.collect()}
    for i, b in body.items():
        sha = base64.b32encode(hashlib.sha1(b).digest()).decode()
        want = (len(b), sha, "response", None) if kept[b] == i else (len(b), sha, "revisit", kept[b])
        assert tuple(got[i])[1:5] == want
        # One nested row per capture, with all three records.
        assert got[i].request.http.startswith("GET ") and f"page-id: {i}\r" in got[i].metadata.fields
        assert f"Content-Length: {len(b)}" in got[i].response.http
    assert len(got) == len(body)


def test_op3(spark, sf_dir, rows):
    tokenizer = library("word_bpe_49k.json")
    df = QUERIES["op3_packing"](spark, sf_dir)
    assert df.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = df.collect()
    want = {}
    for i, t, *_ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            piece = ids[k:k + 4096]
            want[i, k // 4096] = (k, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()))
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(bins) <= -(-sum(v[1] for v in want.values()) // 4096) + 1


def test_op4(spark, sf_dir, rows):
    df = QUERIES["op4_language"](spark, sf_dir)
    assert df.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    for r in df.collect():
        text = dict((i, t) for i, t, *_ in rows)[r.doc_id]
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        letters = re.search(r"[^\W\d_]", text or "")
        assert (r.lang_pred in ("en", "de")) if letters else (r.lang_pred, r.score) == ("und", 0)
        assert 0 <= r.score <= 1


def test_op6(spark, sf_dir, rows):
    tokenizer = library("word_bpe_49k.json")
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want[i] = (len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))
    assert result(spark, "op6_bpe", sf_dir, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_op7(spark, sf_dir, rows):
    tokenizer = library("byte_bpe_50k.json")
    want, start = {}, 0
    for i, t, *_ in rows:
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 0]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert result(spark, "op7_token_files", sf_dir, "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_op8(spark, sf_dir, rows):
    got = result(spark, "op8_quality", sf_dir, "doc_id", "expected_grade", "p_not_low", "p_good", "selected")
    assert got.keys() == {r[0] for r in rows}
    for grade, not_low, good, selected in got.values():
        assert grade == pytest.approx(not_low + good) and 0 <= good <= not_low <= 1 and selected == (good >= ordinal.LEAST_GOOD)


def test_op9(spark, sf_dir, rows):
    found = Counter()
    for _, t, *_ in rows:
        b = (t or "").encode()
        found.update(hash(b[k:k + 400]) for k in range(len(b) - 399))
    want = {}
    for i, t, *_ in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, np.int64)
        for k in range(len(b) - 399):
            if found[hash(b[k:k + 400])] > 1:
                gone[k] += 1
                gone[min(k + 400, len(b))] -= 1
        cover = np.cumsum(gone)[:-1] > 0
        spans = int(cover[:1].sum() + (cover[1:] & ~cover[:-1]).sum())
        left = np.frombuffer(b, np.uint8)[~cover].tobytes()
        want[i] = (len(b), int(cover.sum()), spans, hashlib.sha256(left).hexdigest())
    assert sum(v[1] > 0 for v in want.values()) >= 8
    assert result(spark, "op9_repeats", sf_dir, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_op10(spark, sf_dir, rows):
    got = result(spark, "op10_repetition", sf_dir, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                 "n_repeat_words", "base_failed", "kept")
    for i, t, *_ in rows:
        w = WORD.findall(t or "")
        windows = Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        inside = {k + d for k in range(len(w) - 4) if windows[tuple(w[k:k + 5])] > 1 for d in range(5)}
        lines, seen, again = (t or "").split("\n"), set(), 0
        for line in lines:
            again += line in seen and bool(WORD.search(line))
            seen.add(line)
        failed = len(w) < 10 or 100 * len(inside) > 20 * len(w)
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        assert got[i][:6] == (len(w), sum(map(len, w)), symbols, again, len(inside), failed)
        assert not (failed and got[i][6])


# --- the sample that the quality classifier is fitted on -----------------------------------------------------------

def _rated(spark, docs, labels, sample):
    docs = spark.createDataFrame(docs, "doc_id bigint, text string, grade string")
    labels = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    return ordinal.rated(docs, labels, sample).collect()


def test_a_hot_id_does_not_fill_the_sample(spark):
    docs = [(1, "hot", "x")] * 20_000 + [(i, f"text {i}", "x") for i in range(2, 400)]
    got = _rated(spark, docs, [(i, 1, 0) for i in range(1, 400)], 100)
    assert 40 < len(got) < 200 and Counter(r.doc_id for r in got).most_common(1)[0][1] == 1


def test_hot_labels_do_not_empty_the_sample(spark):
    labels = [(1, i % 2, 0) for i in range(60_000)] + [(i, i % 2, i % 3 == 0) for i in range(2, 302)]
    got = _rated(spark, [(i, f"text {i}", "x") for i in range(1, 400)], [(a, b, int(c)) for a, b, c in labels], 100)
    assert 40 < len(got) < 200 and {r.grade for r in got} == {0, 1, 2}


def test_many_texts_of_one_id_are_bounded(spark):
    got = _rated(spark, [(1, f"text {i}", "x") for i in range(5000)] + [(2, None, "x")], [(1, 1, 1), (1, 1, 0), (2, 0, None)], 100)
    assert 40 < len(got) < 200 and {(r.doc_id, r.grade) for r in got} <= {(1, 1), (2, 0)}
    assert _rated(spark, [(1, "a", "x")], [], 100) == [] and _rated(spark, [], [(1, 1, 0)], 100) == []
    assert [tuple(r) for r in _rated(spark, [(1, None, "x"), (1, "", "x"), (None, "a", "x")],
                                     [(1, 1, 0), (1, None, 0), (None, 1, 0)], 100)] == [(1, "", 2)]
