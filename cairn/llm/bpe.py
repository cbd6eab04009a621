"""Encoding of whole texts with a public byte-level BPE vocabulary.

Method: a segment tree over the byte positions of a pretoken holds, at the leaf of each live position,
the rank of the pair that starts there; the root knows the leftmost position of least rank. A merge
updates the two neighbouring pairs and clears one leaf, each in logarithmic time, so a pretoken of n
bytes takes O(n log n), however long it is. Encoded pretokens are remembered (the memory is bounded and
only saves work). Ids never leave Python as objects: they go to Arrow as one flat buffer.

Texts are ordinary text throughout: strings that look like special tokens get no special ids.
Null and empty texts have the empty list.
"""

from __future__ import annotations

import base64
import importlib.util
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.runtime import spread

#: Where the vocabulary lies; the default is the installed public package.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The public pattern that splits a text before the merges.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Remembered stretches of text, each at most so many characters.
REMEMBERED, REMEMBERED_CHARS = 400_000, 64

_INF = 1 << 60


def vocabulary_path(name: str = VOCABULARY, folder: str | None = None) -> str:
    if folder is None:
        spec = importlib.util.find_spec("public_tokenizers")
        folder = os.path.dirname(spec.origin) if spec else "/opt/tokenizers"
    return os.path.join(folder, name)


class SegmentTreeBPE:
    """Byte-pair merges of one byte string by the ranks of a vocabulary."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks

    def encode(self, data: bytes) -> list[int]:
        ranks = self.ranks
        whole = ranks.get(data)
        if whole is not None:
            return [whole]
        n = len(data)
        if n == 0:
            return []
        size = 1 << (n - 1).bit_length()
        token = [data[i : i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        get = ranks.get
        # a node's value is rank * width + position: its minimum is the least rank, of equals the leftmost
        width = size
        tree = [_INF] * (2 * size)
        for i in range(n - 1):
            r = get(data[i : i + 2])
            if r is not None:
                tree[size + i] = r * width + i
        for k in range(size - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b

        def update(i: int, value: int) -> None:
            k = size + i
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                v = a if a < b else b
                if tree[k] == v:
                    return
                tree[k] = v
                k >>= 1

        while tree[1] < _INF:
            i = tree[1] % width
            j = after[i]
            token[i] += token[j]
            token[j] = None
            nxt = after[j]
            after[i] = nxt
            update(j, _INF)
            if nxt < n:
                before[nxt] = i
                r = get(token[i] + token[nxt])
                update(i, _INF if r is None else r * width + i)
            else:
                update(i, _INF)
            p = before[i]
            if p >= 0:
                r = get(token[p] + token[i])
                update(p, _INF if r is None else r * width + p)
        out, i = [], 0
        while i < n:
            out.append(ranks[token[i]])
            i = after[i]
        return out


class _Remember(dict):
    """Stretch of text -> its ids; a stretch is what lies between two places at which any text is split."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.bpe, self.find, self.words = SegmentTreeBPE(ranks), regex.compile(PATTERN).findall, {}

    def word(self, word: str) -> tuple[int, ...]:
        ids = self.words.get(word)
        if ids is None:
            ids = tuple(self.bpe.encode(word.encode("utf-8", "surrogatepass")))
            if len(word) <= REMEMBERED_CHARS:
                if len(self.words) >= REMEMBERED:
                    self.words.clear()
                self.words[word] = ids
        return ids

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        ids = tuple(chain.from_iterable(map(self.word, self.find(stretch))))
        if len(stretch) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.clear()
            self[stretch] = ids
        return ids


#: A single blank between two characters that no definition calls white space: a pretoken always begins at it.
_SPLIT = re.compile(r"(?<=\S) (?=\S)")


class Tokenizer:
    """Public vocabulary and pattern; encode gives ids, count their number."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.known = _Remember(ranks)

    def _stretches(self, text: str) -> list[str]:
        parts = _SPLIT.split(text)
        parts[1:] = [" " + p for p in parts[1:]]
        return parts

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.known.__getitem__, self._stretches(text)))) if text else []

    def count(self, text: str) -> int:
        return sum(map(len, map(self.known.__getitem__, self._stretches(text)))) if text else 0


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """One tokenizer per path and Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Tokenizer(path)
    return _TOKENIZERS[path]


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids array<int>): one row per row of docs, without special tokens.

    Null and empty texts give the empty list, ids may repeat, and other columns don't matter.
    """
    path = path or vocabulary_path()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            ids = [np.fromiter(chain.from_iterable(map(t.known.__getitem__, t._stretches(x))), np.int32) if x else np.empty(0, np.int32) for x in b.column(1).to_pylist()]
            offsets = np.zeros(len(ids) + 1, np.int32)
            np.cumsum([len(x) for x in ids], out=offsets[1:])
            flat = np.concatenate(ids) if ids else np.empty(0, np.int32)
            yield pa.record_batch([b.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], names=[id_col, "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return spread(docs.select(id_col, F.col(text_col).alias("text"))).mapInArrow(encode, f"`{id_col}` {kind}, ids array<int>")


def count_tokens(docs: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None) -> DataFrame:
    """The columns ``keep`` and n_tokens bigint, one row per row of docs; 0 for null and empty texts."""
    path = path or vocabulary_path()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = tokenizer(path)
        for b in batches:
            n = pa.array([t.count(x) if x else 0 for x in b.column("__text").to_pylist()], pa.int64())
            yield pa.record_batch([*[b.column(c) for c in keep], n], names=[*keep, "n_tokens"])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return spread(docs.select(*keep, F.col(text_col).alias("__text"))).mapInArrow(count, fields + ", n_tokens bigint")
