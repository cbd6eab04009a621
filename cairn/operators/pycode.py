"""Python files to example records: static references to a library, resolved by joins against its API records."""

from __future__ import annotations

import ast
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators.policy import longest_known, prefix_minimal, score_files
from cairn.runtime import materialise, spread

_DEFS = (ast.FunctionDef, ast.AsyncFunctionDef)
_SEGMENT = "struct<symbol:string,code:string,start:int,end:int,refs:array<string>>"
_DENSITY = "struct<function:int,refs:array<string>>"
_ARROW_SEGMENT = pa.struct([("symbol", pa.string()), ("code", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("refs", pa.list_(pa.string()))])
_ARROW_DENSITY = pa.struct([("function", pa.int32()), ("refs", pa.list_(pa.string()))])


def import_aliases(tree: ast.AST, module: str) -> dict[str, str]:
    """Local name -> dotted path, for every import of the library anywhere in the file. The level of a relative import is ignored."""
    names: dict[str, str] = {}
    for node in ast.walk(tree):
        if isinstance(node, ast.Import):
            for a in node.names:
                if a.name.partition(".")[0] == module:
                    names[a.asname or module] = a.name if a.asname else module
        elif isinstance(node, ast.ImportFrom) and (node.module or "").partition(".")[0] == module:
            names |= {a.asname or a.name: f"{node.module}.{a.name}" for a in node.names}
    return names


class _References(ast.NodeVisitor):
    """Every attribute access whose chain begins at an alias, as a dotted path; inner parts of a chain count too."""

    def __init__(self, aliases: dict[str, str]):
        self.aliases, self.found = aliases, set()

    def _path(self, node: ast.expr) -> str | None:
        if isinstance(node, ast.Name):
            return self.aliases.get(node.id)
        if isinstance(node, ast.Attribute) and (head := self._path(node.value)):
            return f"{head}.{node.attr}"
        return None

    def visit_Attribute(self, node: ast.Attribute) -> None:
        path = self._path(node)
        if path:
            self.found.add(path)
        self.generic_visit(node)


def references(node: ast.AST, aliases: dict[str, str]) -> list[str]:
    visitor = _References(aliases)
    visitor.visit(node)
    return sorted(visitor.found)


def segments(source: str, module: str) -> tuple[list[dict], list[dict], int]:
    """(segments, references per function of any depth, lines). The last segment has no symbol: what no top-level
    definition covers, with the references of the whole file; a file without such lines has none."""
    tree = ast.parse(source)
    aliases = import_aliases(tree, module)
    lines = source.splitlines()
    out, free = [], [True] * len(lines)
    for node in tree.body:
        if isinstance(node, (*_DEFS, ast.ClassDef)):
            start = min([node.lineno, *(d.lineno for d in node.decorator_list)])
            out.append({"symbol": node.name, "code": "\n".join(lines[start - 1 : node.end_lineno]), "start": start, "end": node.end_lineno, "refs": references(node, aliases)})
            free[start - 1 : node.end_lineno] = [False] * (node.end_lineno - start + 1)
    rest = "\n".join(line for line, f in zip(lines, free) if f).strip()
    if rest:
        out.append({"symbol": None, "code": rest, "start": 1, "end": len(lines), "refs": references(tree, aliases)})
    density = [{"function": i, "refs": references(n, aliases)} for i, n in enumerate(x for x in ast.walk(tree) if isinstance(x, _DEFS))]
    return out, density, len(lines)


def read_code(files: DataFrame, module: str) -> DataFrame:
    """files (prefix, path, content) -> (prefix, path, segments, density, lines, error): a file that doesn't parse has an error instead of failing the job."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts, dens, n, errors = [], [], [], []
            for text in b.column("content").to_pylist():
                try:
                    s, d, k = segments(text or "", module)
                    parts.append(s), dens.append(d), n.append(k), errors.append(None)
                except (SyntaxError, ValueError, RecursionError, MemoryError) as err:
                    parts.append([]), dens.append([]), n.append(None), errors.append(f"{type(err).__name__}: {err}")
            yield pa.record_batch([b.column("prefix"), b.column("path"), pa.array(parts, pa.list_(_ARROW_SEGMENT)), pa.array(dens, pa.list_(_ARROW_DENSITY)), pa.array(n, pa.int32()), pa.array(errors, pa.string())], names=["prefix", "path", "segments", "density", "lines", "error"])

    return spread(files.select("prefix", "path", "content")).mapInArrow(parse, f"prefix string, path string, segments array<{_SEGMENT}>, density array<{_DENSITY}>, lines int, error string")


def resolved(rows: DataFrame, keys: list[str], known: DataFrame) -> DataFrame:
    """rows (keys, refs array) -> (keys, apis_used, unknown_refs): each reference by its longest known name of two
    parts or more; used names that a longer used one is below are left out; both sorted."""
    refs = rows.select(*keys, F.explode("refs").alias("ref"))
    found = refs.join(longest_known(refs, known), "ref").groupBy(*keys).agg(F.collect_set("known").alias("used"), F.collect_set(F.when(F.col("known").isNull(), F.col("ref"))).alias("unknown"))
    return found.select(*keys, F.array_sort(prefix_minimal(F.col("used"))).alias("apis_used"), F.array_sort("unknown").alias("unknown_refs"))


def code_records(files: DataFrame, module: str, known: DataFrame, manifest: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(example records, errors). Segments without any reference to the library give no record.

    manifest (prefix, path, url, license) is optional; without a url a record has no source.
    """
    read = materialise(read_code(files, module), "code")  # parsed once, read several times
    errors = read.where("error is not null").select("prefix", "path", "error")
    flat = read.select("prefix", "path", F.posexplode("segments").alias("ord", "s")).select("prefix", "path", "ord", "s.*")
    keys = ["prefix", "path", "ord"]
    out = flat.drop("refs").join(resolved(flat.select(*keys, "refs"), keys, known), keys)
    if manifest is None:
        out = out.withColumn("url", F.lit(None).cast("string")).withColumn("license", F.lit(None).cast("string"))
    else:
        out = out.join(manifest.select("prefix", "path", "url", "license"), ["prefix", "path"], "left")
    name = F.concat_ws("::", F.concat("prefix", F.lit("/"), "path"), "symbol")
    source = F.concat("url", F.lit("#L"), F.col("start").cast("string"), F.lit("-L"), F.col("end").cast("string"))
    unknown = F.when(F.size("unknown_refs") > 0, F.col("unknown_refs"))
    return out.select(name.alias("name"), F.lit("example").alias("kind"), F.when(F.col("url") != "", source).alias("source"), F.nullif("license", F.lit("")).alias("license"), "apis_used", "code", unknown.alias("unknown_refs"), F.col("prefix").alias("corpus")), errors


def file_scores(files: DataFrame, module: str, known: DataFrame, min_apis: int = 3) -> DataFrame:
    """(prefix, path, apis_used, unknown_refs, n_unknown, lines, max_apis_in_function, qualifying_functions): files that parse and use at least one known API."""
    keys = ["prefix", "path"]
    read = materialise(read_code(files, module), "code").where("error is null")
    whole = resolved(read.select(*keys, F.array_distinct(F.flatten(F.transform("segments", lambda s: s.getField("refs")))).alias("refs")), keys, known).where(F.size("apis_used") > 0)
    per = read.select(*keys, F.explode("density").alias("d")).select(*keys, "d.function", "d.refs")
    apis = resolved(per, [*keys, "function"], known).select(*keys, "function", F.explode("apis_used").alias("api"))
    out = whole.join(read.select(*keys, "lines"), keys).join(score_files(apis, keys, min_apis), keys, "left")
    return out.select(*keys, "apis_used", "unknown_refs", F.size("unknown_refs").alias("n_unknown"), "lines", F.coalesce("max_apis_in_function", F.lit(0)).cast("int").alias("max_apis_in_function"), F.coalesce("qualifying_functions", F.lit(0)).cast("int").alias("qualifying_functions"))
