"""Divergence audit, near vectors and centroids against brute force, with odd rows, copies, ties and hot groups."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from flowtide.llm import centroids, divergence, quantised

ODD = [None, [], [0.0, 0.0], [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [3.0]]
VECTORS = "vec_id bigint, embedding array<double>, label int, node int, cluster string, `list` int"


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- divergence ----------------------------------------------------------------------------------------------------

TERM = re.compile("[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def audited(rows, least_docs):
    docs = [(lang or "", source or "", TERM.findall((text or "").translate(LOWER))) for lang, source, text in rows]
    counts, held, every = defaultdict(Counter), defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        counts[lang, source].update(words)
        held[lang].update(set(words))
        every[lang].update(words)
    out = []
    for (lang, source), own in counts.items():
        kept = [t for t, n in held[lang].items() if n >= least_docs]

        def share(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 2) // (n + 2 * len(kept)) for t in kept}

        gap = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = share(own), share(every[lang])
        pairs = []
        for other, theirs in ((s, c) for (x, s), c in counts.items() if x == lang and s != source):
            r = share(theirs)
            pairs.append((sum(gap(p[t], r[t]) for t in kept), other))
        terms = [(gap(p[t], q[t]), t) for t in kept if own[t] and p[t] > q[t]]
        for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
            found.sort(key=lambda x: (-x[0], x[1].encode()))
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out, key=repr)


def _documents():
    rng = np.random.default_rng(4)
    terms = [f"{a}{b}" for a in ["ab", "cé", "日本", "Zz", "don", "ß"] for b in ["", "x", "Y", "é", "q"]]
    rows = []
    for i in range(160):
        words = rng.choice(terms, rng.integers(0, 30), p=np.arange(1, 31) / 465)
        text = "".join(w + rng.choice([" ", "\n", "1", "'", "\x00", "@", "[", "`", "{", "\x7f"]) for w in words)
        rows.append((["en", "de", None, ""][i % 4], ["a", "b", "B", "é", None][i * i % 5], text))
    rows += [("en", "hot", "same words here " * 3)] * 60 + [("fr", "x", None), ("fr", "y", ""), ("fr", None, "12 %")]
    rows += [("en", "long", "Long ab " * 400_000), ("en", "quiet", "1 2 3"), ("it", "only", "one two"), (None, None, None)]
    return rows


@pytest.mark.parametrize("least_docs", [10, 1])
def test_audit(spark, monkeypatch, least_docs):
    rows = _documents()
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in rows],
                               "lang string, source string, text string, term int, p string, rank int").repartition(4)
    assert rows_of(divergence.audit(df, least_docs=least_docs)) == audited(rows, least_docs)
    assert divergence.audit(df.limit(0)).collect() == []


def test_sums_do_not_depend_on_how_much_is_held(monkeypatch):
    rng = np.random.default_rng(2)
    s, p, p0, ends = [], [], [], [0]
    for _ in range(40):
        d = int(rng.integers(2, 9))
        s += rng.permutation(9)[:d].tolist()
        p += rng.integers(1, 10**9, d).tolist()
        ends.append(len(s))
    p0 = [100 + 7 * x for x in s]
    s, p, p0, ends = np.array(s), np.array(p), np.array(p0), np.array(ends)
    f = lambda a, b: int((a - b) ** 2 // (a + b))
    want = Counter()
    for a, b in zip(ends[:-1], ends[1:]):
        for i in range(a, b):
            for j in range(i + 1, b):
                want[min(s[i], s[j]), max(s[i], s[j])] += f(p[i], p[j]) - f(p[i], p0[j]) - f(p0[i], p[j]) + f(p0[i], p0[j])
    for most in (1, 5, 1 << 20):
        monkeypatch.setattr(divergence, "PAIRS", most)
        got = Counter()
        for d in set(np.diff(ends).tolist()):
            for x, y, v in divergence._chunks(ends[:-1][np.diff(ends) == d], d, s, p, p0):
                for i, j, k in zip(x, y, v):
                    got[min(i, j), max(i, j)] += int(k)
        assert got == want


def test_long_texts_are_split_at_blanks(monkeypatch):
    data = ("ab" * 9 + " c" + "é" * 30 + "  \n").encode() * 20
    whole = Counter(data.translate(divergence.TABLE).split())
    for piece in (1, 7, 50):
        monkeypatch.setattr(divergence, "PIECE", piece)
        assert divergence._document(data) == whole


def test_shares_of_very_large_counts(spark):
    rows = [(c, n, 7) for n in (10**12, 4 * 10**18) for c in (0, 9_223_372_034, 9_223_372_035, 10**11, n)]
    df = spark.createDataFrame(rows, "c bigint, n bigint, v bigint")
    got = df.select("c", "n", divergence.share("c", "n", "v").alias("p")).collect()
    assert [r.p for r in got] == [1 + 10**9 * (r.c + 2) // (r.n + 14) for r in got]


# --- near vectors --------------------------------------------------------------------------------------------------

def near(rows, least):
    fine = lambda v: v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    linked = [[] for _ in rows]
    for i, (_, a, x) in enumerate(rows):
        for j, (_, b, y) in enumerate(rows):
            if i != j and x is not None and x == y and fine(a) and fine(b) and len(a) == len(b):
                a_, b_ = np.array(a), np.array(b)
                if a_ @ b_ / (np.linalg.norm(a_) * np.linalg.norm(b_)) >= least:
                    linked[i].append(j)
    out = []
    for i in range(len(rows)):
        seen, todo = {i}, [i]
        while todo:
            for j in linked[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least_id = min(ids, default=None)
        out.append((rows[i][0], len(linked[i]), least_id, rows[i][0] == least_id))
    return sorted(out, key=repr)


def _vectors(width, spread):
    rng = np.random.default_rng(width)
    base = rng.normal(size=(6, width))
    rows = []
    for i in range(260):
        v = base[i % 6] + spread * rng.normal(size=width) if i % 3 else rng.normal(size=width)
        rows.append((i, (v * 10 ** float(rng.integers(-3, 3))).tolist(), [0, 0, 0, 1, None][i % 5]))
    rows += [(300 + i, rows[1][1], 0) for i in range(20)] + [(400, [-x for x in rows[1][1]], 0), rows[1], rows[1]]
    rows += [(None, rows[1][1], 0), (None, rows[3][1], 1), (None, [1.0, 2.0, 3.0], 5)]
    return rows + [(500 + i, v, 0) for i, v in enumerate(ODD)] + [(600, [1.0, 1e-3], 0), (601, [1.0, 0.0], 0), (602, [5.0], 0)]


@pytest.mark.parametrize("width, spread, block", [(64, 0.2, None), (64, 0.35, 7), (3, 0.1, 16), (9, 0.3, 4)])
def test_near_duplicates(spark, monkeypatch, width, spread, block):
    if block:
        monkeypatch.setattr(quantised, "BLOCK", block)
        monkeypatch.setattr(quantised, "PROBES", 2 * block)
    rows = _vectors(width, spread)
    df = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], VECTORS).repartition(3)
    got = rows_of(quantised.near_duplicates(df))
    assert got == near(rows, 0.93)
    assert sum(r[1] for r in got) > 500
    if not block:
        assert quantised.near_duplicates(df.limit(0)).collect() == []


def test_many_lists_lose_no_link():
    """Probing and codes alone, with links at and about the least cosine and more lists than the sample asks for."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(700, 12))
    x[350:] = x[:350] + 0.4 * rng.normal(size=(350, 12))
    unit = quantised._unit(x)
    coarse = quantised._means(unit, 40)
    reach = np.sqrt(2 - 2 * 0.93)
    square = quantised._squared(unit, coarse)
    own = square.argmin(1)
    apart = np.sqrt(quantised._squared(coarse, coarse))
    near_border = (square - square[np.arange(700), own][:, None]) / (2 * np.maximum(apart[own], 1e-12)) <= reach / 2 + quantised.ROOM
    i, j = np.nonzero(np.triu(unit @ unit.T >= 0.93, 1))
    assert len(i) > 100 and (own[i] != own[j]).any()
    assert (near_border[i, own[j]] | near_border[j, own[i]]).all()


def test_spanning_links_connect_what_all_links_connect():
    rng = np.random.default_rng(3)
    for _ in range(200):
        rows, others = rng.integers(1, 9, 2)
        i, j = np.nonzero(rng.random((rows, others)) < rng.random())
        groups = []
        for a, b in ((i, j), quantised._spanning(i, j, rows, others)):
            label = np.arange(rows + others)
            for _ in range(rows + others):
                for x, y in zip(a, b + rows):
                    label[[x, y]] = min(label[x], label[y])
            groups.append(label.tolist())
        assert groups[0] == groups[1]


# --- centroids -----------------------------------------------------------------------------------------------------

def clustered(rows, k, rounds, width, scale=64):
    fine = lambda v: v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v, *_ in rows if fine(v)]
    starts = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    centres = [v for _, v in starts[:k]]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[assign(v)[1]].append(v)
        centres = [[sum(x) // len(own[n]) for x in zip(*own[n])] if n in own else c for n, c in enumerate(centres)]
    last = [(i, *assign(v)) for i, v in kept]
    sums = Counter()
    for _, d, n in last:
        sums[n] += d
    name = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return sorted(((i, n, d, sums[n], sum(sums.values()), name(centres[n])) for i, d, n in last), key=repr)


@pytest.mark.parametrize("width, k", [(64, 16), (2, 5), (1, 3)])
def test_clustered(spark, width, k):
    rng = np.random.default_rng(width)
    rows = [(i, (rng.normal(size=width) * (1 + 50 * (i % 7 == 0))).round(2).tolist(), 1) for i in range(200)]
    rows += [(900 + i, [0.5] * width, 1) for i in range(90)] + [rows[3], rows[3], (None, [0.25] * width, 1), (7, [1.0] * width, 1)]
    rows += [(500 + i, v, 0) for i, v in enumerate(ODD[:2] + ODD[3:6])] + [(600, [1.0] * (width + 1), 0)]
    rows = [r for r in rows if not (width == 2 and r[0] == 502)]
    df = spark.createDataFrame([(*r, 1, "c", 2) for r in rows], VECTORS).repartition(3)
    assert rows_of(centroids.clustered(df, k=k, width=width)) == clustered(rows, k, 3, width)
    assert centroids.clustered(df.limit(0), width=width).collect() == []
    assert centroids.clustered(df.where("vec_id IS NULL"), width=width).collect() == []
    few = df.where("vec_id < 3")
    assert rows_of(centroids.clustered(few, k=k, width=width)) == clustered([r for r in rows if r[0] is not None and r[0] < 3], k, 3, width)


def test_search_equals_comparing_with_all():
    rng = np.random.default_rng(9)
    for width, size in ((1, 3), (4, 50), (64, 700), (3, 2**26)):
        x = rng.integers(-size, size, (300, width))
        centres = np.concatenate([rng.integers(-size, size, (20, width)), x[:5], x[:5], np.zeros((1, width), np.int64)])
        number, distance = centroids.nearest(x, centres)
        every = ((x[:, None].astype(object) - centres[None].astype(object)) ** 2).sum(2)
        assert distance.tolist() == every.min(1).tolist()
        assert number.tolist() == [row.index(min(row)) for row in every.tolist()]


def test_too_large_a_component_is_an_error(spark):
    df = spark.createDataFrame([(1, [1e9] * 64), (2, [1.0] * 64)], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large for exact distances"):
        centroids.clustered(df).collect()
