"""Operators against brute force, on small tables with nulls, empty and long texts, ties, repeated rows and extra
columns."""

import base64
import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from flowtide.llm import bpe, common, jaccard, langid, ordinal, packing, repeats, repetition, tokenfiles, topk, warc
from flowtide.session import scratch_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, node int, kept int, ids int, `__x` int"


def _texts(seed=3):
    """Prose with copies, near copies, shared passages, repeated lines and odd cases."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(1, 7))) for _ in range(300)]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "", ",", "."]) for _ in range(n))
    base, passage = prose(150), prose(90)
    out = [None, "", " \t\n", "one", "Two words", "TWO  WORDS", "12 -- 34 <|endoftext|>", "ab" * 700, "x" * 3000,
           "日本語 Σας İi ﬁ don't WE'LL 😀", base, base, base.upper(), prose(4000)]
    for _ in range(12):
        parts = base.split()
        for _ in range(rng.randint(1, 9)):
            parts[rng.randrange(len(parts))] = rng.choice(words)
        out.append(" ".join(parts))
    out += [prose(rng.randint(3, 40)) + " " + passage + " " + prose(rng.randint(3, 40)) for _ in range(8)]
    line = prose(12)
    out += ["\n".join([line, prose(5), line, "", line]), prose(60), prose(60), " ".join([prose(7)] * 9)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "de", None][i % 3], 1, 2, 3, 4) for i, t in enumerate(_texts())]
    rows += [rows[10], rows[10], (None, _texts()[10], "en", None, None, None, None), (None, None, None, 0, 0, 0, 0)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def shingles(text):
    table = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    w = WORD.findall((text or "").translate(table))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("region", [2048, 3])
def test_jaccard_components(docs, empty, monkeypatch, region):
    monkeypatch.setattr(jaccard, "REGION", region)
    sets = [(r.doc_id, shingles(r.text)) for r in docs.collect()]
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and 100 * len(a & b) >= 75 * len(a | b):
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(sets):
        least[find(i)].append(d)
    want = [(d, len(s), min((x for x in least[find(i)] if x is not None), default=None)) for i, (d, s) in enumerate(sets)]
    assert rows_of(jaccard.components(docs)) == sorted(want, key=repr)
    assert jaccard.components(empty).collect() == []


def test_texts_not_asked_for_stay_out_of_the_join(spark, monkeypatch):
    rows = [(f"text {i}",) for i in range(4000)]
    texts = spark.createDataFrame([*rows, rows[3], rows[3], ("",)], "__text string").repartition(5)
    asked = texts.where("__text in ('text 3', 'text 17', 'text 444', '')").select(F.xxhash64("__text").alias("th"))
    want = rows_of(texts.withColumn("th", F.xxhash64("__text")).where("__text in ('text 3', 'text 17', 'text 444', '')"))
    got = rows_of(jaccard._maybe_asked(texts, asked))
    assert len(want) == 6 and not Counter(want) - Counter(got) and len(got) < 400
    # A sieve that is too small lets more through and loses none.
    monkeypatch.setattr(jaccard, "SIEVE_BITS", jaccard.SIEVE_PARTS * 8)
    assert set(want) <= set(rows_of(jaccard._maybe_asked(texts, asked)))
    assert jaccard._maybe_asked(texts, asked.limit(0)).collect() == []


def _asked_regions(spark, monkeypatch, texts):
    """Components of the texts, and the number of rows that are sent to regions."""
    sent = []
    staged = common.staged

    def counted(df, name):
        out = staged(df, name)
        if name == "regions":
            sent.append(out.count())
        return out

    monkeypatch.setattr(common, "staged", counted)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    found = {r.doc_id: r.component_id for r in jaccard.components(rows).collect()}
    return found, sent[0]


def test_texts_that_share_frequent_words_only_meet_in_no_region(spark, monkeypatch):
    rng = random.Random(5)
    # A third of each text is a run of frequent words that a few other texts also have.
    runs = [" ".join(rng.choice(["the", "of", "and", "in", "to", "is", "a"]) for _ in range(60)) for _ in range(100)]
    texts = [" ".join(f"w{i}x{j}" for j in range(120)) + " " + runs[i % 100] for i in range(400)]
    texts += [texts[7] + " end", texts[8].replace("w8x3 ", "")]
    found, sent = _asked_regions(spark, monkeypatch, texts)
    assert found == {i: i for i in range(400)} | {400: 7, 401: 8}
    assert sent == 4


def test_texts_of_other_sizes_meet_in_no_region(spark, monkeypatch):
    passage = " ".join(f"p{j}" for j in range(40))
    texts = [passage + " " + " ".join(f"w{i}x{j}" for j in range(45 * 2**i)) for i in range(6)]
    want = {i: i for i in range(6)}
    # Sizes at the limit itself link: a text with three quarters of the shingles of the other. One fewer does not.
    for n in (4, 12, 40, 400, 4000):
        for fewer in (0, 1):
            words = [f"v{n}x{fewer}x{j}" for j in range(n + 4)]
            want |= {len(texts): len(texts), len(texts) + 1: len(texts) + fewer}
            texts += [" ".join(words), " ".join(words[:n * 3 // 4 + 4 - fewer])]
            assert len(shingles(texts[-1])) == n * 3 // 4 - fewer and len(shingles(texts[-2])) == n
    found, sent = _asked_regions(spark, monkeypatch, texts)
    # Those that are too far by one shingle may meet, if their sizes are in neighbouring bands.
    assert found == want and 10 <= sent <= 20


def test_a_task_sends_copies_of_a_text_once():
    texts = ["", "one two", "é" * 5000, "one two"]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 2]), pa.array(texts)], ["th", "__text"])
    out = pa.Table.from_batches(jaccard._packed([batch, batch]))
    assert out.column("th").to_pylist() == [1, 2, 3]
    assert jaccard._unpacked(out.column("packed").combine_chunks()).to_pylist() == texts[:3]
    assert out.column("packed").nbytes < 1000


def test_sifted_keeps_all_rows_and_few_of_them_in_doubt(spark):
    rows = spark.createDataFrame([(i, f"text {i}") for i in range(4000)] * 2, "i bigint, text string").repartition(5)
    asked = rows.where("i IN (3, 17, 444)").select(F.xxhash64("i").alias("th"))
    sure, rest = jaccard.sifted(rows, F.xxhash64("i"), asked)
    assert rows_of(sure.unionByName(rest)) == rows_of(rows)
    assert sure.where("i IN (3, 17, 444)").isEmpty() and rest.count() < 400


def test_region_links_connect_what_all_pairs_connect():
    rng = random.Random(5)
    for _ in range(60):
        base = rng.sample(range(200), 24)
        sets = {i: frozenset(rng.sample(base, rng.randint(14, 24)) + rng.sample(range(200), rng.randint(0, 3)))
                for i in range(rng.randint(2, 14))}
        rows = [(i, np.array(sorted(s), np.uint64).tobytes()) for i, s in sets.items()]
        got = jaccard.region_links(rows, 75)
        every = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]

        def classes(edges):
            label = {i: i for i in sets}
            for _ in sets:
                for a, b in edges:
                    label[a] = label[b] = min(label[a], label[b])
            return label

        assert classes(got) == classes(every)
        assert all(100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]) for a, b in got)


def test_warc_round_trip(spark):
    schema = "page_id bigint, url string, html string, record_type string, digest int"
    rows = [(1, "http://a/ b", "same", "x", 1), (2, "http://b", "same", "x", 1), (3, None, None, "x", 1),
            (4, "http://c", "", "x", 1), (5, "http://d\r\nEvil: 1", "é" * 40_000, None, None), (None, None, "same", "", 0),
            (2, "http://b", "same", "x", 1), (6, "http://e", "a\r\n\r\nWARC/1.1\r\n", "x", 1), (None, "u", "lone", "", 0)]
    pages = spark.createDataFrame(rows, schema)
    path = f"{scratch_dir(spark)}/warc"
    archives = warc.write(warc.deduplicated(pages), path)
    captures = warc.transactions(warc.read(spark, path, archives)).collect()
    body = [(i, (h or "").encode()) for i, _, h, _, _ in rows]
    kept = defaultdict(lambda: None)
    for i, b in body:
        kept[b] = max((x for x in (i, kept[b]) if x is not None), default=None)
    want = sorted(((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
                    "response" if kept[b] == i else "revisit", None if kept[b] == i else kept[b]) for i, b in body), key=repr)
    got = sorted(((c.page_id, c.payload_bytes, c.payload_digest, c.record_type, c.refers_to) for c in captures), key=repr)
    assert got == want
    for c in captures:
        assert c.request.http.startswith("GET ") and "page" in c.metadata.fields
        if c.record_type == "response":
            assert bytes(c.response.block) in {b for _, b in body}
    none = f"{scratch_dir(spark)}/none"
    assert warc.transactions(warc.read(spark, none, warc.write(warc.deduplicated(pages.limit(0)), none))).collect() == []


def test_packing(spark, docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(common.vocabulary("word_bpe_49k.json"))
    got = [r.asDict() for r in packing.packed(docs).collect()]
    want = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = np.array(ids[k:k + 4096], "<u4").tobytes()
            want[r.doc_id, k // 4096, k, len(part) // 4, zlib.crc32(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 4096
    assert packing.packed(empty).collect() == []


def test_packing_plan_places_each_piece_once():
    rng = random.Random(2)
    for _ in range(40):
        capacity = rng.choice([7, 30, 100])
        counts = {rng.randint(1, capacity): rng.randint(1, 50) for _ in range(rng.randint(1, 20))}
        used, placed = defaultdict(list), Counter()
        runs = sorted(packing.plan(dict(counts), capacity))
        for n, number, first, each, offset in runs:
            following = [m for k, m, *_ in runs if k == n and m > number]
            last = min(following, default=counts[n])
            for i in range(last - number):
                used[first + i // each].append((offset + i % each * n, n))
                placed[n] += 1
        assert placed == Counter(counts)
        for places in used.values():
            end = 0
            for offset, n in sorted(places):
                assert offset == end
                end += n
            assert end <= capacity
        total = sum(n * c for n, c in counts.items())
        assert len(used) <= 1.5 * -(-total // capacity) + 1


def _bins_piece_by_piece(counts, capacity):
    """Bins of the same greedy packing, one piece after the other: each large piece, longest first, with the longest
    other large one that fits; then each smaller one into the smallest gap that holds it."""
    sizes = sorted(Counter(counts).elements())
    large, gaps = [n for n in sizes if 3 * n > capacity], []
    while large:
        gap = capacity - large.pop()
        partner = max((i for i, m in enumerate(large) if m <= gap), default=None)
        gaps.append(gap - (large.pop(partner) if partner is not None else 0))
    for n in reversed([n for n in sizes if 3 * n <= capacity]):
        fitting = [g for g in gaps if g >= n]
        if fitting:
            gaps.remove(min(fitting))
        gaps.append((min(fitting) if fitting else capacity) - n)
    return len(gaps)


def _bins_of(counts, capacity):
    out = 0
    runs = sorted(packing.plan(dict(counts), capacity))
    for i, (n, number, first, each, _) in enumerate(runs):
        last = runs[i + 1][1] if i + 1 < len(runs) and runs[i + 1][0] == n else counts[n]
        out = max(out, first + -(-(last - number) // each))
    return out


def test_packing_plan_matches_large_pieces_as_one_by_one():
    assert _bins_of({2000: 1, 1999: 1, 1998: 1, 1997: 1}, 4096) == 2
    assert _bins_of({2000: 3, 1999: 1}, 4096) == 2
    rng = random.Random(9)
    for _ in range(60):
        capacity = rng.choice([30, 100])
        counts = {rng.randint(capacity // 3 + 1, capacity // 2 + 3): rng.randint(1, 9) for _ in range(rng.randint(1, 15))}
        assert _bins_of(counts, capacity) == _bins_piece_by_piece(counts, capacity)
        small = counts | {rng.randint(1, capacity // 3): rng.randint(1, 9) for _ in range(5)}
        assert _bins_of(small, capacity) <= _bins_piece_by_piece(small, capacity) + 1


def test_bpe_equals_the_library(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(common.vocabulary("word_bpe_49k.json"))
    want = []
    for r in docs.collect():
        ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert rows_of(bpe.decode(bpe.encode(docs))) == sorted(want, key=repr)
    assert bpe.decode(bpe.encode(empty)).collect() == []


def test_special_tokens_are_matched_with_their_case(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(common.vocabulary("word_bpe_49k.json"))
    texts = ["<|ENDOFTEXT|>", "<|EndOfText|> End", "A <|endoftext|>B <|Endoftext|>", "<|STARTOFTEXT|>É\n<|startoftext|>",
             "Ω <|ENDOFTEXT|>", "ENDOFTEXT |> <| x"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    ids = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[0] == [27, 347, 40786, 4160, 91, 285] and 49407 in ids[2]
    got = rows_of(bpe.decode(bpe.encode(rows)))
    assert got == [(i, x, tokenizer.decode(x, skip_special_tokens=False)) for i, x in enumerate(ids)]
    cut = packing.packed(rows).select("doc_id", "start", "length", "ids_crc32")
    assert rows_of(cut) == [(i, 0, len(x) + 1, zlib.crc32(np.array([*x, 1], "<u4").tobytes())) for i, x in enumerate(ids)]


def test_token_files(spark, docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(common.vocabulary("byte_bpe_50k.json"))
    path = f"{scratch_dir(spark)}/tokens"
    got = tokenfiles.read(spark, path, tokenfiles.write(docs, path)).collect()
    want = Counter()
    for r in docs.collect():
        ids = [*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 0]
        want[r.doc_id, np.array(ids, "<u4").tobytes()] += 1
    assert Counter((r.doc_id, bytes(r.ids)) for r in got) == want
    end, before = 0, None
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == end and (before is None or r.doc_id >= before)
        end += r.n_tokens
        before = r.doc_id
    none = f"{scratch_dir(spark)}/none"
    assert tokenfiles.read(spark, none, tokenfiles.write(empty, none)).collect() == []


def test_language(spark, docs, empty):
    rng = random.Random(4)
    kinds = {"aa": ["the", "thing", "with", "other", "that"], "bb": ["der", "schein", "und", "nicht", "heit"]}
    say = lambda k: " ".join(rng.choice(kinds[k]) + rng.choice(kinds[k]) for _ in range(30))
    rows = [(i, say(k), k) for i in range(60) for k in kinds]
    model = langid.learned(spark.createDataFrame([*rows, (9, None, "aa"), (9, "x", None)], "doc_id long, text string, lang string"))
    fresh = [(i, say(k), k) for i in range(30) for k in kinds]
    asked = spark.createDataFrame([*fresh, (90, None, "aa"), (91, " 1!", "aa"), (92, "q" * 500, "")],
                                  "doc_id long, text string, lang string")
    got = {(r.doc_id, r.lang): r for r in langid.predict(asked, model, ("doc_id", "lang")).collect()}
    assert sum(got[i, k].lang_pred == k for i, _, k in fresh) >= 0.95 * len(fresh)
    assert [(got[i, "aa"].lang_pred, got[i, "aa"].score) for i in (90, 91)] == [("und", 0.0)] * 2
    assert got[92, ""].lang_pred in kinds and all(0 <= r.score <= 1 for r in got.values())
    nothing = langid.learned(empty)
    assert {r.lang_pred for r in langid.predict(docs, nothing).collect()} == {"und"}
    assert langid.predict(empty, model).collect() == []


def test_language_forward_sums_all_segmentations():
    hashes = langid._hashed(np.array([[ord("a")]], np.uint32)), langid._hashed(np.array([[97, 97]], np.uint32))
    hashes, weights = np.sort(np.concatenate(hashes)), np.array([[0.5], [0.25]])
    weights = weights if hashes[0] == langid._hashed(np.array([[97]], np.uint32))[0] else weights[::-1]
    word = np.array([[97, 97, 97]], np.uint32)
    assert np.exp(langid.forward(word, hashes, weights))[0, 0] == pytest.approx(0.5**3 + 2 * 0.5 * 0.25, rel=1e-5)


def test_language_sums_long_pieces_and_words():
    assert len(langid.piece_hashes(common.vocabulary(langid.VOCABULARY))) == len(_language_pieces())
    rng = random.Random(11)
    pieces = ["a", "b", "ab", "ba", "aab", "abababab" * 2, "ab" * 6]
    of = {langid._hashed(np.array([[ord(c) for c in p]], np.uint32))[0]: p for p in pieces}
    hashes = np.array(sorted(of), np.uint64)
    order = [of[h] for h in hashes]
    weights = np.array([[rng.uniform(0.01, 0.2), rng.uniform(0.01, 0.2)] for _ in pieces])
    words = ["ab" * 9, "a" * 33 + "b", "ab" * 20, "ab" * 23 + "a", "b" * 300, "aabx" * 60, "ab" * 1500]
    for some, codes, size in langid.by_length(words):
        got = langid.forward(codes, hashes, weights, size)
        for row, place in enumerate(some):
            for lang in (0, 1):
                a, word = [0.0], words[place]
                for j in range(1, len(word) + 1):
                    ways = [a[j - 1] + np.log(langid.UNKNOWN)]
                    ways += [a[j - len(p)] + np.log(weights[i, lang]) for i, p in enumerate(order) if word[:j].endswith(p)]
                    a.append(np.logaddexp.reduce(ways))
                assert got[row, lang] == pytest.approx(a[-1], rel=1e-9)
        # Each expected count is the derivative of the log probability by the logarithm of the piece's probability.
        total = np.zeros(weights.shape)
        langid.expected(codes, hashes, weights, np.zeros(len(some), np.int64), np.ones(len(some), np.int64), total, size)
        for i in range(len(pieces)):
            more, less = weights.copy(), weights.copy()
            more[i] *= 1 + 1e-5
            less[i] *= 1 - 1e-5
            change = langid.forward(codes, hashes, more, size) - langid.forward(codes, hashes, less, size)
            assert total[i, 0] == pytest.approx(change[:, 0].sum() / 2e-5, rel=1e-4, abs=1e-4)


def test_language_sample_counts_copies_once(spark):
    rng = random.Random(12)
    kinds = {"aa": ["the", "thing", "with", "other", "that"], "bb": ["der", "schein", "und", "nicht", "heit"]}
    say = lambda k: " ".join(rng.choice(kinds[k]) + rng.choice(kinds[k]) for _ in range(30))
    few = [("bb", say("bb")) for _ in range(3)]
    texts = [("aa", say("aa")) for _ in range(200)] + few
    schema = "lang string, text string"
    once = langid.learned(spark.createDataFrame(texts, schema), sample=60)
    copies = spark.createDataFrame([*texts, *few * 400, *texts[:1] * 300], schema).repartition(5)
    languages, _, logs = langid.learned(copies, sample=60)
    assert languages == ["aa", "bb"] and np.allclose(logs, once[2], rtol=0, atol=1e-9)
    assert np.ptp(logs, axis=0).min() > 1
    asked = spark.createDataFrame([(i, say("bb")) for i in range(20)], "doc_id long, text string")
    assert {r.lang_pred for r in langid.predict(asked, once).collect()} == {"bb"}


def _language_pieces():
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=common.vocabulary(langid.VOCABULARY))
    return {p.id_to_piece(i).lower() for i in range(p.get_piece_size())
            if not (p.is_control(i) or p.is_unknown(i) or p.is_byte(i))}


def test_quality(spark, docs, empty):
    rng = random.Random(6)
    plain = [f"w{i}" for i in range(50)]

    def text(grade):
        words = [rng.choice(plain) for _ in range(40)]
        return " ".join(words + {0: ["%%%"] * 9, 1: ["rude", "nasty"], 2: []}[grade])

    rows = [(i, text(i % 3), i % 3) for i in range(600)]
    model = ordinal.fit(spark.createDataFrame([*rows, (0, None, None)], "doc_id long, text string, grade int"))
    asked = spark.createDataFrame([(i, text(i % 3), i % 3) for i in range(90)] + [(99, None, 0), (98, "", 0)],
                                  "doc_id long, text string, grade int")
    got = {r.doc_id: r for r in ordinal.score(asked, model).collect()}
    assert sum(round(got[i].expected_grade) == i % 3 for i in range(90)) >= 85
    assert all(a >= b for r in got.values() for a, b in zip(r.reaches, r.reaches[1:])) and len(got) == 92
    assert ordinal.score(empty, model).collect() == []
    single = ordinal.fit(docs.selectExpr("text", "1 AS grade"))
    assert {r.expected_grade for r in ordinal.score(docs, single).collect()} == {1.0}


def test_quality_features_tell_the_middle_grade(spark, monkeypatch):
    monkeypatch.setattr(ordinal, "FEATURES", 8)
    rng = random.Random(13)
    more = {0: ["%%%"] * 9, 1: ["rude", "nasty"], 2: []}
    text = lambda g: " ".join([f"w{rng.randrange(50)}" for _ in range(40)] + more[g])
    # The mean grade is 1, that of the documents with a rude word.
    rows = [(i, text(i % 3), i % 3) for i in range(600)]
    model = ordinal.fit(spark.createDataFrame(rows, "doc_id long, text string, grade int"))
    asked = spark.createDataFrame([(i, text(i % 3)) for i in range(90)], "doc_id long, text string")
    scored = ordinal.score(asked, model).select("doc_id", ordinal.selected().alias("good")).collect()
    assert sum(r.good == (r.doc_id % 3 == 2) for r in scored) >= 85


@pytest.mark.parametrize("region", [256, 2])
def test_repeats(docs, empty, monkeypatch, region):
    monkeypatch.setattr(repeats, "REGION", region)
    least, data = 40, [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    count = Counter(b[i:i + least] for _, b in data for i in range(len(b) - least + 1))
    want = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, np.int64)
        for j in range(len(b) - least + 1):
            if count[b[j:j + least]] > 1:
                gone[j] += 1
                gone[j + least] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(np.concatenate([[0], gone])) == 1).sum())
        want.append((i, len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, np.uint8)[~gone])))
    cut = repeats.removed(docs.drop("kept"), least=least)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in cut.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert repeats.removed(empty).collect() == []


def test_passages_shorter_than_a_window_need_no_rounds(spark, monkeypatch):
    """Hundreds of different surroundings of one passage, which is a little shorter than a window: one task settles them."""
    rng = random.Random(4)
    prose = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage, longer = prose(37), prose(43)
    texts = [prose(50) + passage + prose(50) for _ in range(400)] + [prose(50) + longer + prose(50) for _ in range(2)]
    names, staged = [], common.staged
    monkeypatch.setattr(common, "staged", lambda df, name: names.append(name) or staged(df, name))
    cut = repeats.removed(spark.createDataFrame(enumerate(texts), "doc_id bigint, text string"), least=40)
    # A byte or two beside a passage may be equal by chance.
    assert {r.doc_id: r.n_removed for r in cut.collect() if r.n_removed >= 43}.keys() >= {400, 401}
    assert "surroundings" in names and "halves" not in names


@pytest.mark.parametrize("least", [2, 3, 8, 20])
def test_blocks_lose_no_repeat(monkeypatch, least):
    """Surroundings that share an anchor against all their windows, with small transforms."""
    rng = random.Random(least)
    k = least // 2
    for _ in range(60):
        monkeypatch.setattr(repeats, "TRANSFORM_BYTES", rng.choice([10, 200, 150_000]))
        sides = [bytes(rng.choice(b"abcd") for _ in range(least - k)) for _ in range(4)]
        rows = []
        for i in range(rng.randint(2, 12)):
            left = rng.choice(sides)[rng.randint(0, least - k):]
            right = rng.choice(sides)[:rng.randint(0, least - k)]
            data, off = left + b"e" * k + right, least - k - len(left)
            if len(data) >= least:
                rows.append((rng.randint(0, 1), b"%d" % (i % 5), 1000 * i, off, False, data))
        places = {}
        for key, tk, lo, off, _, data in rows:
            for j in range(len(data) - least + 1):
                places.setdefault((key, data[j:j + least]), set()).add((tk, lo + j))
        want = set().union(*(x for x in places.values() if len(x) > 1))
        got = set()
        for batch in repeats._spans(rows, least, least - k + 1) if rows else []:
            for tk, lo, hi in zip(*(c.to_pylist() for c in batch.columns)):
                got |= {(tk, x) for x in range(lo, hi - least + 1)}
        assert got == want


def test_interval_expansion_finds_every_repeat():
    rng = random.Random(1)
    for _ in range(150):
        least, letters = rng.choice([1, 2, 3, 5, 8, 13]), rng.choice([b"a", b"ab", b"abcdefgh"])
        base = bytes(rng.choice(letters) for _ in range(60))
        cuts = [base[a:a + rng.randint(1, 40)] for a in (rng.randint(0, 40) for _ in range(rng.randint(1, 8)))]
        cuts = [c for c in cuts if c] or [b"a"]
        none = np.zeros(len(cuts), np.int64)
        got = repeats.repeated_starts(cuts, np.arange(len(cuts)), none, none.astype(bool), least)
        count = Counter(c[j:j + least] for c in cuts for j in range(len(c) - least + 1))
        assert [x.tolist() for x in got] == [
            [j for j in range(len(c) - least + 1) if count[c[j:j + least]] > 1] for c in cuts]


def test_repetition(docs, empty):
    def measured(text):
        text = text or ""
        w, lines = WORD.findall(text), text.split("\n")
        again = [i for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i]]
        out = [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(again),
               sum(len(x) for i in again for x in WORD.findall(lines[i]))]
        repeat = []
        for n in (5, *repetition.COVERAGE):
            count = Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
            inside = {k for i in range(len(w) - n + 1) if count[tuple(w[i:i + n])] > 1 for k in range(i, i + n)}
            repeat.append(inside)
        return (*out, len(repeat[0]), *(sum(len(w[k]) for k in x) for x in repeat[1:]))

    want = sorted(((r.doc_id, *measured(r.text)) for r in docs.collect()), key=repr)
    assert rows_of(repetition.measure(docs)) == want
    for r in repetition.judge(repetition.measure(docs)).collect():
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert repetition.judge(repetition.measure(empty)).collect() == []


@pytest.mark.parametrize("block", [4096, 16])
def test_topk(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(150, 8)) * rng.exponential(size=(150, 1))
    x[40:50] = x[3]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    rows += [(200, None, 1), (201, [1.0, None, *[0.0] * 6], 1), (202, [float("nan")] * 8, 1), (None, [1.0] * 8, 1),
             (203, [float("inf")] * 8, 1), (204, [], 1), rows[60], rows[61]]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rank int")
    vectors = topk.quantised(table)
    got = rows_of(topk.search(vectors, F.col("id") % 20 == 0, 20))
    ids = np.array([i for i, _, _ in rows[:150]] + [60, 61])
    v = np.floor(64 * np.array([np.float32(r[1]) for r in rows[:150] + rows[-2:]], np.float64)).astype(np.int64)
    want = []
    for q in range(0, 150, 20):
        score = v @ v[q]
        other = np.flatnonzero(ids != q)
        order = other[np.lexsort((ids[other], -score[other]))][:20]
        want += [(q, n + 1, int(ids[j]), int(score[j])) for n, j in enumerate(order)]
    assert got == sorted(want, key=repr)
    assert topk.search(topk.quantised(table.limit(0)), F.col("id") % 20 == 0).collect() == []


def test_topk_of_several_lengths_and_large_numbers(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [int(x) for x in rng.integers(-2**29, 2**29, 3 + i % 2)]) for i in range(90)]
    vectors = spark.createDataFrame(rows, "id bigint, v array<bigint>")
    want = []
    for q, a in rows[::20]:
        scores = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q and len(a) == len(b))
        want += [(q, n + 1, i, -score) for n, (score, i) in enumerate(scores[:5])]
    assert rows_of(topk.search(vectors, F.col("id") % 20 == 0, 5)) == sorted(want, key=repr)


def test_paths_without_a_scheme_are_those_of_spark(spark):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    try:
        conf.set("fs.defaultFS", "hdfs://name:9000")
        assert common.qualified(spark, "/a/b") == "hdfs://name:9000/a/b"
        assert common.qualified(spark, "file:/a/b") == "file:/a/b"
        assert common.qualified(spark, "s3a://a/b") == "s3a://a/b"
    finally:
        conf.set("fs.defaultFS", before)
    assert common.qualified(spark, "/a/b") in ("file:/a/b", "file:///a/b")
