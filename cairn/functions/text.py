"""String functions with Unicode semantics, as Column expressions that stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str knows it: what (?U)\\s lacks are the four separators.
_WS = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Unicode white space gone from both ends."""
    return F.regexp_replace(c, rf"(?U)\A{_WS}+|{_WS}+\z", "")


def present(c: Column) -> Column:
    """Null for an empty string."""
    return F.nullif(c, F.lit(""))


def clean_markdown(c: Column) -> Column:
    """Links become their text, rules of tables go, three line feeds or more become two, the ends are stripped."""
    c = F.regexp_replace(c, r"\[([^\]]*)\]\([^)]*\)", "$1")
    c = F.regexp_replace(c, rf"(?Umd)^\|[\s\x1c-\x1f\-:|]+\|{_WS}*$", "")
    return strip(F.regexp_replace(c, r"\n{3,}", "\n\n"))


def spdx_license(text: Column, normalise: bool = False) -> Column:
    """The first SPDX identifier of a text, null without one; a comment's end stays unless ``normalise``."""
    found = present(F.regexp_extract(text, r"(?Umd)SPDX-License-Identifier:\s*(.+?)\s*$", 1))
    return normal_license(found) if normalise else found


def normal_license(c: Column) -> Column:
    """Without the end of a comment that a one-line mark leaves behind."""
    return present(strip(F.regexp_replace(c, r"(?U)\s*(-->|\*/)\s*$", "")))


CLEANERS: dict[str, Callable[[Column], Column]] = {"markdown": clean_markdown}


def register_cleaner(name: str, cleaner: Callable[[Column], Column]) -> None:
    CLEANERS[name] = cleaner
