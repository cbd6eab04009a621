"""Records to chunks: gated recipes, and lossless splitting at ranked line boundaries."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.config import BOUNDARIES, Config
from cairn.functions.fields import build_text, has_fields
from cairn.functions.text import CLEANERS


@lru_cache(maxsize=64)
def _searches(patterns: tuple[str, ...]) -> list[Callable]:
    return [re.compile(p).search for p in patterns]


def boundary_ranks(lines: Sequence[str], patterns: Sequence[str] = BOUNDARIES) -> list[int]:
    """Per line the index of the first pattern that occurs in it; the number of patterns if none does."""
    searches = _searches(tuple(patterns))
    return [next((k for k, search in enumerate(searches) if search(line)), len(searches)) for line in lines]


def cut_lines(text: str, limit: int, patterns: Sequence[str] = BOUNDARIES) -> list[str]:
    """Pieces of whole lines of at most ``limit`` characters, before small ones are merged.

    Each cut is at the strongest boundary in reach, the farthest of equals; the end of the text is the
    weakest. A line above the limit is a piece of its own. Joined, the pieces are the text.
    """
    lines = text.splitlines(keepends=True)
    ranks = [*boundary_ranks(lines, patterns), len(patterns)]
    offset = [0]
    for line in lines:
        offset.append(offset[-1] + len(line))
    pieces, begin = [], 0
    while begin < len(lines):
        end, best, k = begin + 1, len(patterns) + 1, begin + 1
        while k <= len(lines) and offset[k] <= offset[begin] + limit:
            if ranks[k] <= best:
                best, end = ranks[k], k
            k += 1
        pieces.append(text[offset[begin] : offset[end]])
        begin = end
    return pieces


def merge_small(pieces: Sequence[str], limit: int) -> list[str]:
    """Pieces whose stripped length is under a tenth of the limit join the one before, the first one the one behind."""
    least = max(1, limit // 10)
    groups: list[list[str]] = []
    for p in pieces:
        if groups and len(p.strip()) < least:
            groups[-1].append(p)
        else:
            groups.append([p])
    merged = ["".join(g) for g in groups]
    # whatever begins a later group is large enough, so one forward merge is all that can happen
    if len(merged) > 1 and len(merged[0].strip()) < least:
        merged[:2] = [merged[0] + merged[1]]
    return merged


def split_text(text: str, limit: int | None, patterns: Sequence[str] = BOUNDARIES) -> list[str]:
    """The text as it is if it needs no split, else its stripped non-empty pieces."""
    if not limit or len(text) <= limit:
        return [text]
    pieces = merge_small(cut_lines(text, limit, patterns), limit)
    if "".join(pieces) != text:
        raise ValueError("the pieces aren't the text")
    return [s for s in (p.strip() for p in pieces) if s]


def split_pieces(text: Column, limit: int | None, patterns: Sequence[str] = BOUNDARIES) -> Column:
    """array<string>: short texts never leave the JVM, only oversized ones go through Arrow. Null gives null."""
    if not limit:
        return F.when(text.isNotNull(), F.array(text))

    @F.pandas_udf("array<string>")
    def split(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else split_text(t, limit, patterns))

    long = F.length(text) > limit
    return F.when(long, split(F.when(long, text))).when(text.isNotNull(), F.array(text))


def cut_pieces(text: Column, limit: int, patterns: Sequence[str] = BOUNDARIES) -> Column:
    """array<string>: the pieces before small ones are merged and without stripping; short texts never leave the JVM."""

    @F.pandas_udf("array<string>")
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else cut_lines(t, limit, patterns))

    long = F.length(text) > limit
    return F.when(long, cut(F.when(long, text))).when(text.isNotNull(), F.array(text))


def recipe_rows(records: DataFrame, config: Config = Config()) -> DataFrame:
    """(record_id, chunk_type, text, return_text, corpus): a row per record and recipe that it passes, unsplit.

    One scan: the recipes become an array of structs that is filtered and exploded.
    """
    made = []
    for r in config.recipes:
        text = build_text(r.embedded)
        answer = F.coalesce(build_text(r.returned or r.embedded), text)
        if r.cleanup:
            text = CLEANERS[r.cleanup](text)
        ok = has_fields(r.required) & build_text(r.embedded).isNotNull()
        made.append(F.when(ok, F.struct(F.lit(r.chunk_type).alias("chunk_type"), text.alias("text"), answer.alias("return_text"))))
    kept = F.filter(F.array(*made), lambda x: x.isNotNull())
    rows = records.select(F.col("name").alias("record_id"), F.col("corpus"), F.explode(kept).alias("c"))
    return rows.select("record_id", "c.chunk_type", "c.text", "c.return_text", "corpus")


def build_chunks(records: DataFrame, config: Config = Config()) -> DataFrame:
    """Records to chunks (record_id, chunk_type, part, text, return_text, corpus).

    Every piece of a split text carries the whole return text. Records without any field of a recipe,
    and empty tables, give no chunk; repeated records give repeated chunks, the store decides on them.
    """
    rows = recipe_rows(records, config)
    pieces = rows.select("record_id", "chunk_type", F.posexplode(split_pieces(F.col("text"), config.chunk_chars, config.boundaries)).alias("part", "piece"), "return_text", "corpus")
    return pieces.select("record_id", "chunk_type", F.col("part").cast("int").alias("part"), F.col("piece").alias("text"), "return_text", "corpus")
