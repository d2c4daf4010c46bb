"""Token ids of texts by a public tokenizer file and the tokenizers library.

Text falls into chunks at blanks and line ends, where neither vocabulary lets a token cross, so each distinct chunk is
encoded once and looked up afterwards; the ids are those of the whole text. The lookup table is bounded.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata

import numpy as np

from . import common

#: Most entries of each of the two generations of a worker's lookup table.
CACHE = 300_000
_TAIL = frozenset(".,;:!?")
_CUT = re.compile(r"(?<=\S)(?= )")


def encoder(path: str, make):
    """This worker's encoder for a vocabulary file; it stays for later tasks of the same kind."""
    return common.kept_in_worker((path, make), lambda: Chunks(make(path), spaced(path)))


def spaced(path: str) -> bool:
    """Whether the vocabulary keeps white space (byte level) or drops it (words with an end mark)."""
    with open(path) as f:
        return not json.load(f)["model"].get("end_of_word_suffix")


#: Chunks that go to the library as one string.
TOGETHER = 100
#: A blank, then Latin letters and visible ASCII without the mark that added tokens have. In a row, byte-level vocabularies
#: part such chunks at the blanks: a blank before anything visible goes with it, and nothing in a chunk takes the next one.
_WORD = re.compile(" [!-;=-~À-ÖØ-öø-ɏ]+")


def library(path: str):
    """list of chunks -> list of their ids (little-endian unsigned 32-bit), by the tokenizers library.

    Chunks are joined by a special token, which the library takes out of the raw text before it does anything else, so
    each of them is encoded as if alone. One that holds a character of the token's edges goes alone. Where the library
    itself parts words at their blanks and keeps these, words are joined by nothing, which costs a third less: each
    begins at the one token of it that has the blank.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    mark = None
    for number, token in tokenizer.get_added_tokens_decoder().items():
        if token.special and not (token.normalized or token.lstrip or token.rstrip or token.single_word):
            mark, edges = (number, token.content), (token.content[0], token.content[-1])

    def alone(chunks):
        found = tokenizer.encode_batch_fast(chunks, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in found]

    with open(path) as f:
        spec = json.load(f)
    cut = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
    begins = None
    marked = all("<" in token.content for token in tokenizer.get_added_tokens_decoder().values())
    if marked and spec.get("normalizer") is None and cut.items() <= (spec.get("pre_tokenizer") or {}).items():
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        begins = np.zeros(max(vocabulary.values()) + 1, bool)
        begins[[number for token, number in vocabulary.items() if token[0] == "Ġ"]] = True  # the blank's byte

    def encode(chunks):
        known, rest = {}, chunks
        if begins is not None:
            words = [c for c in chunks if _WORD.fullmatch(c)]
            known = dict(zip(words, in_a_row(words)))
            rest = [c for c in chunks if c not in known]
        odd = rest if mark is None else [c for c in rest if edges[0] in c or edges[1] in c]
        known.update(zip(odd, alone(odd)))
        rest = [c for c in rest if c not in known]
        known.update(zip(rest, together(rest)))
        return [known[c] for c in chunks]

    def in_a_row(words):
        if not words:
            return []
        joined = ["".join(words[i:i + TOGETHER]) for i in range(0, len(words), TOGETHER)]
        ids = np.concatenate([
            np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(joined, add_special_tokens=False)])
        starts = 4 * np.flatnonzero(begins[ids])
        assert len(starts) == len(words)
        data = ids.tobytes()
        return [data[a:b] for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(data)])]

    def together(chunks):
        if not chunks:
            return []
        number, content = mark
        joined = [content.join([*chunks[i:i + TOGETHER], ""]) for i in range(0, len(chunks), TOGETHER)]
        ids = [np.array(e.ids, "<u4") for e in tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(ids)
        ends = 4 * np.flatnonzero(ids == number)
        assert len(ends) == len(chunks)
        data, starts = ids.tobytes(), np.append(0, ends[:-1] + 4).tolist()
        return [data[a:b] for a, b in zip(starts, ends.tolist())]

    return encode


class Chunks:
    """Encode texts chunk by chunk. ``encode``: list of chunks -> list of their ids. Ids are little-endian unsigned
    32-bit integers."""

    def __init__(self, encode, spaced: bool):
        self.encode, self.spaced = encode, spaced
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        parts = [self.keys(t) for t in texts]
        if len(self.new) > CACHE:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        missing = []
        for w in set().union(*parts).difference(new):
            if (ids := old.get(w)) is not None:
                new[w] = ids
            else:
                missing.append(w)
        self._fill(missing)
        look = new.__getitem__
        return [b"".join(map(look, p)) for p in parts]

    def keys(self, text: str) -> list[str]:
        """Keys of the chunks that can be encoded alone. With white space kept, a chunk starts with the white space
        before it: a key is a word, for the chunk of a blank and it, or starts with a line end, for itself, or with a
        blank, for what follows that."""
        if not self.spaced:
            # Lower case first makes more chunks equal; within Latin-1 it commutes with composition. Special tokens are
            # matched in the raw text, where case counts, so a text that may hold one is left as it is.
            if "<|" not in text:
                try:
                    text.encode("latin-1")
                    text = text.lower()
                except UnicodeEncodeError:
                    pass
            return text.replace("\n", " ").split(" ")
        parts = text.replace("\n", " ").split(" ")
        if parts != text.split():
            # White space other than single blanks and line ends between words.
            return [" " + c for c in _CUT.split(text)]
        if "\n" in text:
            parts = text.replace("\n", " \n").split(" ")
        parts[0] = " " + parts[0]
        return parts

    def _chunk(self, key: str) -> str:
        if not self.spaced or key[:1] == "\n":
            return key
        return key[1:] if key[:1] == " " else " " + key

    def _fill(self, missing: list[str]) -> None:
        """A chunk that ends in a letter and one mark of punctuation is its letters' ids and the mark's."""
        new, tails = self.new, []
        plain = set()
        alone = " " if self.spaced else ""
        for w in missing:
            # The letter may not grow in lower case: a combining mark would join the punctuation after it.
            if len(w) > 2 and w[-1] in _TAIL and w[-2] < "ƀ" and w[-2].lower().isalnum():
                tails.append(w)
                if w[:-1] not in new:
                    plain.add(w[:-1])
                if alone + w[-1] not in new:
                    plain.add(alone + w[-1])
            else:
                plain.add(w)
        plain = list(plain)
        for i in range(0, len(plain), 20_000):
            some = plain[i:i + 20_000]
            new.update(zip(some, self.encode([self._chunk(w) for w in some])))
        for w in tails:
            new[w] = new[w[:-1]] + new[alone + w[-1]]


def composed_lower(text: str) -> str:
    """Composed form, then each character to lower case."""
    if text.isascii():
        return text.lower()
    return "".join(map(str.lower, unicodedata.normalize("NFC", text)))


def encoded(df, id_cols, text_col, tokenizer, make=library, end_id=None, then=None, fields=None):
    """Rows of ``id_cols`` and ``ids`` (binary: little-endian unsigned 32-bit token ids of the whole text, followed by
    ``end_id`` if given). ``then(list of bytes) -> list of (row number, Arrow columns)`` may replace ``ids`` by
    ``fields``. A missing text counts as empty."""
    import pyarrow as pa
    from pyspark.sql import functions as F

    path = common.vocabulary(tokenizer)
    common.small_batches(df.sparkSession)
    source = common.texts(df, *(F.col(c).alias(f"__id{i}") for i, c in enumerate(id_cols)), text=text_col)
    end = b"" if end_id is None else np.array([end_id], "<u4").tobytes()

    def run(batches):
        chunks = encoder(path, make)
        for batch in common.slices(batches, "__text"):
            ids = [x + end for x in chunks.ids(batch.column("__text").to_pylist())]
            rest = batch.drop_columns(["__text"])
            if then is None:
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(ids, pa.binary())], [*rest.schema.names, "ids"])
            else:
                rows, columns, names = then(ids)
                rest = rest.take(pa.array(rows, pa.int64()))
                yield pa.RecordBatch.from_arrays([*rest.columns, *columns], [*rest.schema.names, *names])

    kinds = [f"`__id{i}` {source.schema[f'__id{i}'].dataType.simpleString()}" for i in range(len(id_cols))]
    out = common.mapped(source, run, ", ".join([*kinds, fields or "ids binary"]), keeps=True)
    return out.withColumnsRenamed({f"__id{i}": c for i, c in enumerate(id_cols)})
