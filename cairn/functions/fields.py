"""The field vocabulary: how each field of a record is rendered. Null means that the record lacks it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions.text import present


def _joined(array: Column, sep: str) -> Column:
    return F.when(F.size(array) > 0, F.array_join(array, sep))


def _labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value)


def parameter_names(parameters: Column) -> Column:
    """Sorted distinct names over all overloads."""
    names = F.array_sort(F.array_distinct(F.transform(F.flatten(parameters), lambda p: p.getField("name"))))
    return _labelled("parameters: ", _joined(names, ", "))


def _printed_string(token: Column) -> Column:
    """A JSON string as Python shows it inside a list: single quotes, unless it holds them and no double ones."""
    text = F.get_json_object(F.concat(F.lit('{"v":'), token, F.lit("}")), "$.v")
    for plain, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(shown))
    quote = F.when(F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"')), F.lit('"')).otherwise(F.lit("'"))
    return F.concat(quote, F.when(quote == "'", F.replace(text, F.lit("'"), F.lit("\\'"))).otherwise(text), quote)


_WORDS = {"null": "None", "true": "True", "false": "False"}


def printed(value: Column) -> Column:
    """A JSON value as Python prints it: bare strings, True, False and None; numbers as they are spelled."""
    tokens = F.regexp_extract_all(value, F.lit(r'("(?:[^"\\]|\\.)*"|[^"]+)'), 1)
    words = lambda t: F.regexp_replace(F.regexp_replace(F.regexp_replace(t, r"\bnull\b", _WORDS["null"]), r"\btrue\b", _WORDS["true"]), r"\bfalse\b", _WORDS["false"])
    nested = F.array_join(F.transform(tokens, lambda t: F.when(t.startswith('"'), _printed_string(t)).otherwise(words(t))), "")
    return F.when(value.startswith('"'), F.coalesce(F.get_json_object(F.concat(F.lit('{"v":'), value, F.lit("}")), "$.v"), value)).otherwise(nested)


FIELDS: dict[str, Callable[[], Column]] = {
    **{c: (lambda c=c: present(F.col(c))) for c in ("name", "kind", "explanation", "doc", "code", "section_text")},
    "heading_path": lambda: _joined(F.col("heading_path"), " > "),
    "source": lambda: _labelled("source: ", present(F.col("source"))),
    "license": lambda: _labelled("license: ", present(F.col("license"))),
    "signatures": lambda: _joined(F.col("signatures"), "\n"),
    "parameter_names": lambda: parameter_names(F.col("parameters")),
    "apis_used": lambda: _labelled("uses: ", _joined(F.col("apis_used"), ", ")),
    "enum_members": lambda: _labelled("members: ", _joined(F.transform(F.col("members"), lambda m: m.getField("name")), ", ")),
    "enum_of": lambda: _labelled("belongs to enum: ", present(F.col("enum_of"))),
    "value": lambda: _labelled("value: ", printed(F.col("value"))),
}


def register_field(name: str, render: Callable[[], Column]) -> None:
    FIELDS[name] = render


def field(name: str) -> Column:
    if name not in FIELDS:
        raise KeyError(f"no field is called {name}; known: {', '.join(sorted(FIELDS))}")
    return FIELDS[name]()


def build_text(names: Sequence[str]) -> Column:
    """The fields that a record has, a line feed between them; null if it has none."""
    return present(F.concat_ws("\n", *map(field, names)))


def has_fields(names: Sequence[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & field(n).isNotNull()
    return cond
