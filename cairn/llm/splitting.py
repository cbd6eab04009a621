"""Cutting oversized texts and code into overlapping pieces at natural boundaries.

Method: every position of a text gets a boundary strength; a sparse table answers which position of a
range is strongest, the rightmost of equals. A piece that starts at s ends at the strongest position of
[s + minimum, s + limit]; the next piece starts ``overlap`` characters before that end. Lengths are in
Unicode code points and nothing is trimmed, so the pieces without their overlaps are the text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.runtime import spread

LIMIT = 2000
OVERLAP = 200

#: Strength of a cut before the position.
NEVER, ANY, WORD, CLAUSE, SENTENCE, LINE, ITEM, BLOCK, SECTION = -1, 0, 1, 2, 3, 4, 5, 6, 7

_CLAUSE = re.compile(r"[,;:)\]}](?=\s)|[，、；：]")
_SENTENCE = re.compile(r"[.!?…][\"'”’)\]]*(?=\s)|[。！？]")
_ITEM = re.compile(r"^(?:[ \t]*(?:[-*+•]|\d{1,9}[.)])[ \t]|[ \t]*\||[^\s#@)\]}])", re.M)
_BLANK = re.compile(r"(?:^|(?<=\n))[ \t]*\r?\n(?=[^\n])", re.M)
_HEADING = re.compile(r"^(?:#{1,6}[ \t]|={2,6}[^=\n]|(?:async[ ]def|def|class)[ ]|@\w|<h[1-6][ >]|\\(?:sub)*section\b)", re.M)
_FENCE = re.compile(r"^[ \t]*(`{3,}|~{3,})[^\n]*(?:\n|\Z)", re.M)
_SPACE = re.compile(r"\s+")
_NEWLINE = re.compile("\r\n|\n|\r(?!\n)|[\x0b\x0c\x85\u2028\u2029]")
_MARKS = "\u0300-\u036f\u0483-\u0489\u0591-\u05bd\u064b-\u065f\u0900-\u0903\u093a-\u094f\u0e31\u0e34-\u0e3a\u0e47-\u0e4e\u1ab0-\u1aff\u1dc0-\u1dff\u20d0-\u20ff\u3099\u309a\ufe00-\ufe0f\ufe20-\ufe2f\U0001f3fb-\U0001f3ff\U000e0100-\U000e01ef\u200d"
#: No cut inside a line end of two characters, before a combining mark or variation, or at a joiner.
_GLUE = re.compile("(?<=\r)\n|[" + _MARKS + "]|(?<=\u200d).", re.S)


def strengths(text: str) -> np.ndarray:
    """s[p], p from 0 to len(text): how natural a cut before character p is."""
    n = len(text)
    s = np.zeros(n + 1, np.int8)

    def put(pattern: re.Pattern, value: int, end: bool) -> None:
        at = np.fromiter((m.end() if end else m.start() for m in pattern.finditer(text)), np.int64)
        s[at] = np.maximum(s[at], value)

    put(_SPACE, WORD, True)
    for pattern, value in ((_CLAUSE, CLAUSE), (_SENTENCE, SENTENCE)):
        at = np.fromiter((m.end() for m in pattern.finditer(text)), np.int64)
        # the blank after the mark stays with the piece it ends
        at = at + np.fromiter((1 if p < n and text[p] in " \t" else 0 for p in at), np.int64, len(at)) if len(at) else at
        s[at] = np.maximum(s[at], value)
    put(_NEWLINE, LINE, True)
    lines = s >= LINE
    lines[0] = True
    at = np.fromiter((m.start() for m in _ITEM.finditer(text)), np.int64)
    at = at[lines[at]]
    s[at] = np.maximum(s[at], ITEM)
    put(_BLANK, BLOCK, True)
    at = np.fromiter((m.start() for m in _HEADING.finditer(text)), np.int64)
    s[at] = SECTION
    opened = None
    for m in _FENCE.finditer(text):
        if opened is None:
            opened, mark = m, m.group(1)
            s[m.start()] = BLOCK
        elif m.group(1)[0] == mark[0] and len(m.group(1)) >= len(mark):
            inside = s[opened.start() + 1 : m.end()]
            np.minimum(inside, LINE, out=inside)
            s[m.end()] = BLOCK
            opened = None
    at = np.fromiter((m.start() for m in _GLUE.finditer(text)), np.int64)
    s[at] = NEVER
    s[0] = NEVER
    s[n] = SECTION
    return s


class RangeMax:
    """A sparse table over strengths[base:...]: the rightmost strongest position of any range of up to ``span`` positions."""

    def __init__(self, values: np.ndarray, span: int):
        self.values = values
        self.levels = [np.arange(len(values), dtype=np.int32)]
        half = 1
        while 2 * half <= min(span, len(values)):
            last = self.levels[-1]
            left, right = last[:-half], last[half:]
            self.levels.append(np.where(values[right] >= values[left], right, left))
            half *= 2

    def strongest(self, lo: int, hi: int) -> int:
        """The position of [lo, hi] with the largest value, of equals the rightmost."""
        level = self.levels[k := (hi - lo + 1).bit_length() - 1]
        a, b = level[lo], level[hi - (1 << k) + 1]
        return int(b if self.values[b] >= self.values[a] else a)


#: Positions that one table covers: the memory of a table doesn't grow with the text.
_TABLE = 1 << 16


def cut(text: str, limit: int = LIMIT, overlap: int = OVERLAP, minimum: int | None = None) -> list[tuple[int, int, int]]:
    """The pieces (start, end, strength of the end) of a text; one piece if it isn't longer than ``limit``.

    Every piece is at most ``limit`` long and all but the last at least ``minimum`` (half the limit, but
    more than the overlap). An empty text is one empty piece.
    """
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be at least 0 and under the limit")
    minimum = max(limit // 2 if minimum is None else minimum, overlap + 1)
    if minimum > limit:
        raise ValueError("the minimum is above the limit")
    n = len(text)
    if n <= limit:
        return [(0, n, SECTION)]
    s = strengths(text)
    pieces, start, base, table = [], 0, 0, None
    while n - start > limit:
        if table is None or start + limit >= base + len(table.values):
            base = start
            table = RangeMax(s[base : base + max(_TABLE, 2 * limit) + 1], limit)
        end = base + table.strongest(start + minimum - base, start + limit - base)
        pieces.append((start, end, int(s[end])))
        start = end - overlap
    pieces.append((start, n, SECTION))
    return pieces


_PIECES = "array<struct<part:int,start:int,end:int,strength:int,text:string>>"
_ARROW = pa.list_(pa.struct([("part", pa.int32()), ("start", pa.int32()), ("end", pa.int32()), ("strength", pa.int32()), ("text", pa.string())]))


def split_oversized(items: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, with_text: bool = True) -> DataFrame:
    """items (tab, item_id, field, value) -> one row per piece (tab, item_id, field, part, start, end, strength[, text]).

    Only values longer than the limit are cut; the others, null and empty ones give no row. Only the
    oversized values leave the JVM. start and end count code points from 0; end isn't part of the piece.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        @lru_cache(maxsize=64)  # deliveries of a value often lie together
        def pieces(value: str) -> list[dict]:
            return [{"part": i, "start": a, "end": b, "strength": k, "text": value[a:b] if with_text else None} for i, (a, b, k) in enumerate(cut(value, limit, overlap))]

        for b in batches:
            # small slices, as each value becomes several pieces
            for k in range(0, b.num_rows, 256):
                part = b.slice(k, 256)
                out = pa.array([pieces(v) for v in part.column("value").to_pylist()], _ARROW)
                yield pa.record_batch([*part.select(["tab", "item_id", "field"]).columns, out], names=["tab", "item_id", "field", "pieces"])

    big = items.where(F.length("value") > limit).select(F.col("tab").cast("string").alias("tab"), F.col("item_id").cast("bigint").alias("item_id"), F.col("field").cast("string").alias("field"), "value")
    done = spread(big).mapInArrow(split, f"tab string, item_id bigint, field string, pieces {_PIECES}")
    cols = ["part", "start", "end", "strength"] + ["text"] * with_text
    return done.select("tab", "item_id", "field", F.explode("pieces").alias("p")).select("tab", "item_id", "field", *[f"p.{c}" for c in cols])


def items_of(tab: str, df: DataFrame, id_col: str, fields: list[str], limit: int = LIMIT) -> DataFrame:
    """The values of several fields of a table as items; rows without any value over the limit are dropped at the scan."""
    over = F.lit(False)
    for f in fields:
        over = over | F.coalesce(F.length(F.col(f)) > limit, F.lit(False))
    values = F.filter(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in fields]), lambda x: F.length(x.getField("value")) > limit)
    return df.where(over).select(F.lit(tab).alias("tab"), F.col(id_col).alias("item_id"), F.explode(values).alias("x")).select("tab", "item_id", "x.field", "x.value")
