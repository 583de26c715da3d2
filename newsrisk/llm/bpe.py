"""BPE encoding and decoding with the merges of a public tokenizer file.

Encoding normalises and splits a text as the file says, then merges the distinct words of a
batch together: their symbols lie in one flat array, every round finds the rank of each
neighbouring pair by binary search over the sorted pair keys, takes each word's least rank and
merges it from the left, until no word has a pair left.  Decoding joins the tokens' strings
with blanks, as a file without a decoder asks for.

A missing text is empty and has no tokens.  Strings of special tokens inside a text are
special tokens, as in the library the file is made for.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from newsrisk.llm.common import sliced, with_fields

NONE = np.int64(2**62)
#: Ids in bytes, as their hash is taken.
ID = np.dtype("<u4")
#: Words whose ids a task keeps from batch to batch.
KEPT_WORDS = 600_000


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next above 255."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, above = [], 256
    for b in range(256):
        out.append(chr(b if b in printable else above))
        above += b not in printable
    return out


class Vocabulary:
    """A tokenizer file (BPE with an end-of-word suffix) as arrays for encoding and decoding."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*self.ids.values(), *self.special.values()])
        self.size = size
        self.tokens = [""] * size
        for token, i in [*self.ids.items(), *self.special.items()]:
            self.tokens[i] = token
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left, right, whole = (
            np.array([self.ids[t] for t in column], np.int64)
            for column in zip(*((a, b, a + b) for a, b in merges), strict=True)
        )
        keys = left * size + right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = whole  # by rank
        letters = byte_letters()
        self.inner = np.array([self.ids[c] for c in letters], np.int64)
        self.last = np.array([self.ids[c + self.suffix] for c in letters], np.int64)
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(split)
        self.stops = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")

    # -- encoding ------------------------------------------------------------------------

    def split(self, text: str) -> list[str]:
        """The words and special tokens of a text, in order; specials keep their string."""
        if not any(s in text for s in self.special):
            return self.words.findall(normal(text))
        out = []
        for piece in self.stops.split(text):
            out += [piece] if piece in self.special else self.words.findall(normal(piece))
        return out

    def merge(self, words: list[str]) -> list[bytes]:
        """The ids of each word (``ID`` numbers): rounds of numpy over the symbols of all words at once."""
        out: list = [None] * len(words)
        raws = [w.encode() for w in words]
        lengths = np.fromiter(map(len, raws), np.int64, len(raws))
        flat = np.frombuffer(b"".join(raws), np.uint8)
        ends = np.cumsum(lengths)
        symbols = self.inner[flat]
        symbols[ends - 1] = self.last[flat[ends - 1]]
        word = np.repeat(np.arange(len(words)), lengths)
        while len(symbols):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            ranks = self.pair_ranks(symbols, word)
            least = np.minimum.reduceat(ranks, first)
            done = least == NONE
            if done.any():
                counts = np.diff(np.append(first, len(symbols)))
                keep = ~np.repeat(done, counts)
                ended, at = symbols[~keep].astype(ID).tobytes(), 0
                for w, n in zip(word[first[done]].tolist(), (counts[done] * ID.itemsize).tolist(), strict=True):
                    out[w] = ended[at : at + n]
                    at += n
                symbols, word, ranks = symbols[keep], word[keep], ranks[keep]
                if not len(symbols):
                    break
                least, first = least[~done], np.flatnonzero(np.diff(word, prepend=-1))
            counts = np.diff(np.append(first, len(symbols)))
            hit = np.flatnonzero(ranks == np.repeat(least, counts))
            # Of overlapping hits (aaa) every other one counts, from the left of each run.
            fresh = np.diff(hit, prepend=-2) != 1
            start = np.maximum.accumulate(np.where(fresh, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - start) % 2 == 0]
            symbols[hit] = self.merged[ranks[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, word = symbols[keep], word[keep]
        return out

    def pair_ranks(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        """For each symbol the rank of the pair it starts within its word, or NONE."""
        ranks = np.full(len(symbols), NONE)
        inside = np.flatnonzero(word[1:] == word[:-1])
        keys = symbols[inside] * self.size + symbols[inside + 1]
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        found = self.keys[at] == keys
        ranks[inside[found]] = self.ranks[at[found]]
        return ranks

    def encode(self, texts: list[str | None], known: dict[str, bytes] | None = None) -> list[list[int]]:
        """The ids of every text.  ``known`` keeps words from call to call."""
        return [np.frombuffer(raw, ID).tolist() for raw in self.encode_raw(texts, known)]

    def encode_raw(self, texts: list[str | None], known: dict[str, bytes] | None = None) -> list[bytes]:
        """The ids of every text as ``ID`` numbers: a few bytes each, also in ``known``."""
        known = {} if known is None else known
        if len(known) > KEPT_WORDS:
            known.clear()
        for token, i in self.special.items():
            known[token] = np.array([i], ID).tobytes()
        split = [self.split(t or "") for t in texts]
        fresh = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in known]
        known.update(zip(fresh, self.merge(fresh), strict=True))
        return [b"".join(map(known.__getitem__, words)) for words in split]

    # -- decoding ------------------------------------------------------------------------

    def decode(self, ids) -> str:
        """The text of ids, special tokens included; ids without a token are left out."""
        tokens, size = self.tokens, self.size
        return " ".join([tokens[i] for i in ids if 0 <= i < size])


def normal(text: str) -> str:
    """Composed and in lower case, letter by letter.

    The file also makes each run of white space one blank; as no word holds white space,
    that does not change the words.
    """
    text = unicodedata.normalize("NFC", text)
    # A capital sigma depends on its place for str.lower, not for a single letter.
    return "".join(map(str.lower, text)) if "Σ" in text else text.lower()


def chunks(texts: list, size: int = 500_000) -> Iterator[list]:
    """Lists of neighbouring texts, ``size`` characters long or one text."""
    part, length = [], 0
    for text in texts:
        part.append(text)
        length += len(text or "")
        if length >= size:
            yield part
            part, length = [], 0
    if part:
        yield part


def encode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``token_ids``, an array of the ids of each text."""
    docs = docs.drop("token_ids")
    at = docs.columns.index(text)
    schema = with_fields(docs, "token_ids array<int>")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = Vocabulary(path), {}
        for batch in sliced(batches):
            texts = batch.column(at).to_pylist()
            ids = [i for part in chunks(texts) for i in vocabulary.encode(part, known)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ids, pa.list_(pa.int32()))],
                names=[*batch.schema.names, "token_ids"],
            )

    return docs.mapInArrow(work, schema)


def decode(rows: DataFrame, path: str, ids: str = "token_ids") -> DataFrame:
    """``rows`` with ``decoded``, the text of the ids; NULL ids give an empty text."""
    rows = rows.drop("decoded")
    at = rows.columns.index(ids)
    schema = with_fields(rows, "decoded string")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for batch in sliced(batches):
            texts = [vocabulary.decode(i or ()) for i in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.string())],
                names=[*batch.schema.names, "decoded"],
            )

    return rows.mapInArrow(work, schema)


ROUND_TRIP = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """Per document the number of ids and the hashes of the ids and of the decoded text.

    One pass: ids and decoded texts are as large as the documents and stay in the task.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known = Vocabulary(path), {}
        for batch in sliced(batches):
            counts, first, second = [], [], []
            for part in chunks(batch.column(1).to_pylist()):
                for raw in vocabulary.encode_raw(part, known):
                    ids = np.frombuffer(raw, ID).tolist()
                    counts.append(len(ids))
                    first.append(hashlib.sha256(raw).hexdigest())
                    second.append(hashlib.sha256(vocabulary.decode(ids).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(first, pa.string()), pa.array(second, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(work, ROUND_TRIP)
