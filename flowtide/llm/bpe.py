"""BPE encoding by dynamic programming over prefixes, and decoding.

The encoding of every prefix of a piece ends in exactly one token. For each prefix, an automaton over the vocabulary
gives the tokens that end there, longest first; the first one that is compatible with the last token of the prefix
before it is stored. Following the stored tokens back from the end gives the ids that merging pairs by rank gives.
Distinct pieces of a batch go through all steps together, as columns of numpy arrays.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from . import common, tokens

#: Words of the vocabulary with an end mark: the pattern of its file.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_MODELS: dict = {}


def byte_letters() -> dict[int, str]:
    """The printable letter by which vocabulary files write each byte: printable Latin-1 stands for itself, the other
    bytes take the letters from 256 on in ascending order."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = (b for b in range(256) if b not in set(own))
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(spare)}


class Vocabulary:
    """Tokens as strings of symbols: a byte, or 256 and more for a byte that ends a word."""

    def __init__(self, path: str):
        with open(path) as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, mark = model["vocab"], model.get("end_of_word_suffix") or ""
        self.mark = mark
        self.text = {i: t for t, i in vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max(self.text)
        byte = {c: b for b, c in byte_letters().items()}

        def symbols(token):
            ended = bool(mark) and token.endswith(mark) and token != mark
            codes = [byte[c] for c in (token[:-len(mark)] if ended else token)]
            if ended:
                codes[-1] += 256
            return tuple(codes)

        spelled = {symbols(t): i for t, i in vocab.items()}
        self.of_symbol = np.full(512, -1, np.int64)
        for s, i in spelled.items():
            if len(s) == 1:
                self.of_symbol[s[0]] = i
        self.length = np.zeros(self.size, np.int64)
        for s, i in spelled.items():
            self.length[i] = len(s)
        # A token that no merge makes has rank -1 and no parts.
        self.rank = np.full(self.size, -1, np.int64)
        self.left = np.full(self.size, -1, np.int64)
        self.right = np.full(self.size, -1, np.int64)
        pairs = {}
        for r, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            made, a, b = vocab[a + b], vocab[a], vocab[b]
            pairs.setdefault(a * self.size + b, r)
            if self.rank[made] < 0:
                self.rank[made], self.left[made], self.right[made] = r, a, b
        keys = np.array(sorted(pairs), np.int64)
        self.pair_keys, self.pair_ranks = keys, np.array([pairs[k] for k in keys.tolist()], np.int64)
        self._automaton({s: i for s, i in spelled.items() if len(s) == 1 or self.rank[i] >= 0})

    def _automaton(self, spelled) -> None:
        """States are the prefixes of tokens; ``shorter`` leads from a token to the longest token that ends it."""
        state, edges, ends, parent = {(): 0}, {}, [-1], [(0, 0)]
        for s, i in sorted(spelled.items()):
            for k in range(1, len(s) + 1):
                p = s[:k]
                if p not in state:
                    state[p] = len(state)
                    edges[state[p[:-1]] << 9 | p[-1]] = state[p]
                    ends.append(-1)
                    parent.append((state[p[:-1]], p[-1]))
            ends[state[s]] = i
        depth = [0] * len(ends)
        for p, n in state.items():
            depth[n] = len(p)
        fail, best, shorter = [0] * len(ends), [-1] * len(ends), np.full(self.size, -1, np.int64)
        for n in sorted(range(1, len(ends)), key=depth.__getitem__):
            up, c = parent[n]
            f = fail[up]
            if up:
                while f and (f << 9 | c) not in edges:
                    f = fail[f]
                fail[n] = edges.get(f << 9 | c, 0)
            if ends[n] >= 0:
                best[n] = ends[n]
                shorter[ends[n]] = best[fail[n]]
            else:
                best[n] = best[fail[n]]
        keys = np.array(sorted(edges), np.int64)
        self.edge_keys, self.edge_to = keys, np.array([edges[k] for k in keys.tolist()], np.int64)
        self.fail, self.best, self.shorter = np.array(fail), np.array(best), shorter

    def step(self, state, symbol):
        """The automaton's next states."""
        out, todo, at = np.zeros(len(state), np.int64), np.arange(len(state)), state
        while len(todo):
            key = at << 9 | symbol[todo]
            k = np.minimum(np.searchsorted(self.edge_keys, key), len(self.edge_keys) - 1)
            hit = self.edge_keys[k] == key
            out[todo[hit]] = self.edge_to[k[hit]]
            go = ~hit & (at > 0)
            todo, at = todo[go], self.fail[at[go]]
        return out

    def compatible(self, a, b):
        """Whether two tokens stand side by side in the encoding of their joined spelling: while either is taken apart
        at its seam, in the order in which merges would have made it, no pair across the seam may merge first."""
        out, todo = np.ones(len(a), bool), np.arange(len(a))
        limit = np.full(len(a), np.iinfo(np.int64).max)
        a, b = a.copy(), b.copy()
        while len(todo):
            key = a * self.size + b
            k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            rank = np.where(self.pair_keys[k] == key, self.pair_ranks[k], np.iinfo(np.int64).max)
            # Merges of equal rank go from left to right: the pair at the seam comes before the right token's own.
            bad = rank < limit
            out[todo[bad]] = False
            ra, rb = self.rank[a], self.rank[b]
            go = ~bad & ((ra >= 0) | (rb >= 0))
            todo, a, b, ra, rb = todo[go], a[go], b[go], ra[go], rb[go]
            # The one made later is taken apart first. Of equal ranks, the right one was made later.
            take_left = ra > rb
            limit = np.where(take_left, ra, rb + 1)
            a, b = np.where(take_left, self.right[a], a), np.where(take_left, b, self.left[b])
        return out

    def encode(self, pieces: list[np.ndarray]) -> list[np.ndarray]:
        """Ids of pieces given as symbols."""
        out: list = [None] * len(pieces)
        size = np.array([len(p) for p in pieces], np.int64)
        order = np.argsort(size, kind="stable")
        start = 0
        while start < len(order):
            longest = size[order[start]]
            # Pieces of about one length go together; the table of last tokens has a bounded number of cells.
            stop = int(np.searchsorted(size[order], longest + longest // 4, "right"))
            stop = min(stop, start + max(1, 4_000_000 // int(longest + longest // 4 + 1)))
            some = order[start:stop]
            for i, ids in zip(some.tolist(), self._encode([pieces[i] for i in some], size[some])):
                out[i] = ids
            start = stop
        return out

    def _encode(self, pieces, size):
        n, width = len(pieces), int(size.max(initial=0))
        table = np.zeros((width, n), np.int64)
        if width:
            flat = np.concatenate(pieces)
            row = np.repeat(np.arange(n), size)
            table[np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size), row] = flat
        last = np.full((width + 1, n), -1, np.int64)
        state = np.zeros(n, np.int64)
        for j in range(width):
            live = np.flatnonzero(size > j)
            state[live] = self.step(state[live], table[j, live])
            token = self.best[state[live]]
            while len(live):
                begin = j + 1 - self.length[token]
                before = last[begin, live]
                fits = begin == 0
                check = np.flatnonzero(~fits)
                fits[check] = self._known(before[check], token[check])
                last[j + 1, live[fits]] = token[fits]
                live, token = live[~fits], self.shorter[token[~fits]]
                if (token < 0).any():
                    raise ValueError("the vocabulary lacks a byte of the text")
        ids, at, rows = [], size.copy(), np.arange(n)
        while len(rows := rows[at[rows] > 0]):
            token = last[at[rows], rows]
            ids.append((rows, token))
            at[rows] -= self.length[token]
        if not ids:
            return [np.zeros(0, np.int64)] * n
        row = np.concatenate([r for r, _ in ids])[::-1]
        token = np.concatenate([t for _, t in ids])[::-1]
        order = np.argsort(row, kind="stable")
        return np.split(token[order], np.searchsorted(row[order], np.arange(1, n)))

    _pairs = np.zeros(0, np.int64)
    _fits = np.zeros(0, bool)

    def _known(self, a, b):
        """``compatible``, with the answers for pairs met before kept in a table of bounded size."""
        key = a * self.size + b
        k = np.searchsorted(self._pairs, key)
        known = np.zeros(len(key), bool)
        inside = k < len(self._pairs)
        known[inside] = self._pairs[k[inside]] == key[inside]
        out = np.zeros(len(key), bool)
        out[known] = self._fits[k[known]]
        if not known.all():
            fresh, back = np.unique(key[~known], return_inverse=True)
            fits = self.compatible(fresh // self.size, fresh % self.size)
            out[~known] = fits[back]
            if len(self._pairs) > 1_000_000:
                self._pairs, self._fits = fresh, fits
            else:
                at = np.searchsorted(self._pairs, fresh)
                self._pairs, self._fits = np.insert(self._pairs, at, fresh), np.insert(self._fits, at, fits)
        return out


def model(path: str) -> Vocabulary:
    if path not in _MODELS:
        _MODELS[path] = Vocabulary(path)
    return _MODELS[path]


def prefix_encoder(path: str):
    """list of chunks -> list of their ids (little-endian unsigned 32-bit), for a vocabulary with an end mark."""
    import regex

    vocabulary, pattern = model(path), regex.compile(WORDS.replace(r"\s", r"\p{White_Space}"))
    special = regex.compile("|".join(f"({regex.escape(s)})" for s in vocabulary.special) or r"(?!)")

    def symbols(piece):
        codes = np.frombuffer(piece.encode(), np.uint8).astype(np.int64)
        codes[-1] += 256
        return codes

    def encode(chunks):
        pieces: dict[str, int] = {}
        plans = []
        for chunk in chunks:
            plan = []
            for part in special.split(chunk) if "<|" in chunk else [chunk]:
                if part in vocabulary.special:
                    plan.append(-1 - vocabulary.special[part])
                elif part:
                    plan += [pieces.setdefault(p, len(pieces)) for p in pattern.findall(tokens.composed_lower(part))]
            plans.append(plan)
        ids = [np.asarray(x, "<u4").tobytes() for x in vocabulary.encode([symbols(p) for p in pieces])]
        return [b"".join((-1 - p).to_bytes(4, "little") if p < 0 else ids[p] for p in plan) for plan in plans]

    return encode


def encode(df: DataFrame, id_cols=("doc_id",), text_col="text", tokenizer="word_bpe_49k.json") -> DataFrame:
    """Rows of ``id_cols`` and ``ids`` (array of int): the token ids of the whole text.

    A missing, empty or blank text has an empty array. Special tokens written out in a text are found as the library
    finds them. Repeated rows and ids each give their row; other columns are dropped.
    """
    def lists(ids):
        flat = np.frombuffer(b"".join(ids), "<u4").astype(np.int32)
        ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
        return np.arange(len(ids)), [pa.ListArray.from_arrays(ends, flat)], ["ids"]

    return tokens.encoded(df, list(id_cols), text_col, tokenizer, prefix_encoder, then=lists, fields="ids array<int>")


def decode(df: DataFrame, ids_col="ids", out_col="decoded", tokenizer="word_bpe_49k.json") -> DataFrame:
    """``df`` with the text of its ids: this vocabulary names no decoder, so the tokens' own spelling joined by one
    blank. An empty or missing array gives an empty text."""
    path = common.vocabulary(tokenizer)
    names = [c for c in df.columns if c != out_col]

    def run(batches):
        vocabulary = model(path)
        spelled = pa.array([vocabulary.text.get(i) for i in range(vocabulary.size)], pa.string())
        blank = pa.scalar(" ", pa.string())
        import pyarrow.compute as pc

        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                ids = part.column(ids_col)
                ids = ids.fill_null([]) if ids.null_count else ids
                width = ids.offsets.to_numpy()
                strings = pa.ListArray.from_arrays(
                    pa.array(width - width[0], pa.int32()), spelled.take(ids.flatten()))
                text = pc.binary_join(strings, blank)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), text], [*names, out_col])

    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in names)
    return common.mapped(df.select(*names), run, f"{schema}, `{out_col}` string")
