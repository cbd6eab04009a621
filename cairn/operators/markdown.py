"""Markdown files to section records, one independent row of work per file."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.runtime import spread

# fixed values: the line forms that results depend on
HEADING = re.compile(r"^(#{1,6})\s+(.+?)\s*$")
FENCE = re.compile(r"^\s*(```+|~~~+)")
SPDX = re.compile(r"SPDX-License-Identifier:\s*(.+?)\s*$", re.M)
COMMENT = re.compile(r"<!--.*?-->", re.S)

_SECTION = pa.struct(
    [("name", pa.string()), ("heading_path", pa.list_(pa.string())), ("heading_level", pa.int32()), ("section_text", pa.string()), ("source", pa.string()), ("code", pa.string()), ("license", pa.string())]
)


def classed_lines(lines: list[str]) -> list[tuple[str, int | None]]:
    """Per line what it is and in which fenced block: (kind, block), kind one of text, heading, mark, code.

    A block ends at a mark of the character that began it, however long; marks of the other character
    inside it belong to neither text nor code.
    """
    out: list[tuple[str, int | None]] = []
    opened, block = None, -1
    for line in lines:
        m = FENCE.match(line)
        if m:
            ch = m.group(1)[0]
            if opened is None:
                opened, block = ch, block + 1
            elif ch == opened:
                out.append(("mark", block))
                opened = None
                continue
            out.append(("mark", block))
        elif opened is not None:
            out.append(("code", block))
        else:
            out.append(("heading" if HEADING.match(line) else "text", None))
    return out


def blank_comments(text: str, scope: str = "all") -> str:
    """HTML comments emptied without moving a line; ``leading`` touches only those before the first heading."""
    end = len(text)
    if scope == "leading":
        first = re.search(HEADING.pattern, text, re.M)
        end = first.start() if first else end
    elif scope != "all":
        raise ValueError("scope is all or leading")
    return COMMENT.sub(lambda m: "\n" * m.group().count("\n"), text[:end]) + text[end:]


def sections(text: str, prefix: str, path: str, comment_scope: str = "all") -> list[dict]:
    """The section records of one file. Text before the first heading, and sections without text, give none."""
    found = SPDX.search(text)
    lines = blank_comments(text, comment_scope).splitlines()
    kinds = classed_lines(lines)
    at = [i for i, (kind, _) in enumerate(kinds) if kind == "heading"]
    stem = posixpath.splitext(posixpath.basename(path))[0]
    out: list[dict] = []
    open_titles: dict[int, str] = {}
    for begin, end in zip(at, [*at[1:], len(lines)]):
        level, title = len(HEADING.match(lines[begin]).group(1)), HEADING.match(lines[begin]).group(2)
        open_titles = {k: v for k, v in open_titles.items() if k < level} | {level: title}
        body = "\n".join(lines[begin + 1 : end]).strip()
        if not body:
            continue
        blocks = [(b, "\n".join(lines[i] for i in ids)) for b, ids in ((b, list(g)) for b, g in groupby((i for i in range(begin + 1, end) if kinds[i][0] == "code"), key=lambda i: kinds[i][1]))]
        titles = [open_titles[k] for k in sorted(open_titles)]
        out.append(
            {
                "name": f"{prefix}/{stem}::{' > '.join(titles)}",
                "heading_path": titles,
                "heading_level": level,
                "section_text": body,
                "source": f"{path}#L{begin + 1}-L{end}",
                "code": "\n\n".join(code for _, code in blocks) or None,
                "license": found.group(1) if found else None,
            }
        )
    return out


def parse_markdown(files: DataFrame, comment_scope: str = "all") -> DataFrame:
    """files (prefix, path, content) -> section records with kind and corpus. Null contents give none."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [sections(text, prefix or "", path or "", comment_scope) if text else [] for prefix, path, text in zip(*(b.column(c).to_pylist() for c in ("prefix", "path", "content")))]
            yield pa.record_batch([b.column("prefix"), pa.array(rows, pa.list_(_SECTION))], names=["prefix", "found"])

    one = "struct<name:string,heading_path:array<string>,heading_level:int,section_text:string,source:string,code:string,license:string>"
    parsed = spread(files.select("prefix", "path", "content")).mapInArrow(parse, f"prefix string, found array<{one}>")
    flat = parsed.select(F.concat("prefix", F.lit("_docs")).alias("corpus"), F.explode("found").alias("s"))
    return flat.select("s.name", F.lit("doc_section").alias("kind"), "s.heading_path", "s.heading_level", "s.section_text", "s.source", "s.code", "s.license", "corpus")
