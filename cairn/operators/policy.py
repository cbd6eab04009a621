"""Filters and rankings over records, repositories and candidates."""

from __future__ import annotations

import ast
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.config import EXAMPLE_DIRS, LICENSES
from cairn.functions.fields import field


def is_public(name: Column) -> Column:
    """Names without a leading underscore, and the two special methods that callers use."""
    return ~name.startswith("_") | name.isin("__init__", "__call__")


# ---------------------------------------------------------------- hierarchical prefixes


def load_prefixes(source: str) -> list[str]:
    """All string literals of the lists that a policy file assigns at top level, in order, once each. The file is parsed, never
    run; what else a list holds is passed over."""
    lists = [n.value.elts for n in ast.parse(source).body if isinstance(n, ast.Assign) and isinstance(n.value, ast.List | ast.Tuple)]
    return list(dict.fromkeys(e.value for elts in lists for e in elts if isinstance(e, ast.Constant) and isinstance(e.value, str)))


def dotted_prefixes(name: Column) -> Column:
    """a.b.c -> [a, a.b, a.b.c]: what a hierarchical prefix can be equal to."""
    parts = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "."))


def prefix_frame(records: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    rows = [(p, i) for i, p in enumerate(dict.fromkeys(prefixes))]
    return records.sparkSession.createDataFrame(rows, "prefix string, ord int")


def by_prefix(records: DataFrame, prefixes: DataFrame, mode: str = "exclude", name: str = "name") -> DataFrame:
    """Records whose name is (``keep``) or isn't (``exclude``) a prefix or below one: name = p or begins with p and a dot.

    A name has as many dotted prefixes as parts, so this is an equi-join on names, not a nested loop. A
    null name is below no prefix.
    """
    if mode not in ("exclude", "keep"):
        raise ValueError("mode is exclude or keep")
    names = records.select(F.col(name).alias("_n")).where("_n is not null").distinct()
    hit = names.select("_n", F.explode(dotted_prefixes(F.col("_n"))).alias("prefix")).join(prefixes.select("prefix"), "prefix", "left_semi").select("_n").distinct()
    return records.join(hit, records[name] == hit["_n"], "left_semi" if mode == "keep" else "left_anti")


def prefix_counts(records: DataFrame, prefixes: DataFrame, name: str = "name") -> DataFrame:
    """(prefix, n): records per first matching prefix, by its place in the policy; zeroes are reported."""
    rows = records.select(F.col(name).alias("_n")).where("_n is not null").groupBy("_n").agg(F.count(F.lit(1)).alias("times"))
    first = rows.select("_n", "times", F.explode(dotted_prefixes(F.col("_n"))).alias("prefix")).join(prefixes, "prefix").groupBy("_n", "times").agg(F.min_by("prefix", "ord").alias("prefix"))
    counted = first.groupBy("prefix").agg(F.sum("times").alias("n"))
    return prefixes.join(counted, "prefix", "left").select("prefix", F.coalesce("n", F.lit(0)).alias("n"))


def filter_records(records: DataFrame, prefixes: DataFrame, mode: str = "exclude", dry_run: bool = False) -> tuple[DataFrame, dict]:
    """The records that stay, with a report; a filter that drops everything is refused, one that drops nothing or runs dry changes nothing."""
    kept = by_prefix(records, prefixes, mode)
    before, after = records.count(), kept.count()
    report = {"before": before, "after": after, "dropped": before - after, "changed": after != before and not dry_run}
    if before and not after and not dry_run:
        raise ValueError("the filter would leave no record")
    return (kept if report["changed"] else records), report


def longest_known(refs: DataFrame, known: DataFrame, least: int = 2, ref: str = "ref", name: str = "name") -> DataFrame:
    """(ref, known): for each distinct ref its longest dotted prefix of at least ``least`` parts among the known names, null if none is."""
    distinct = refs.select(F.col(ref).alias("ref")).where("ref is not null").distinct()
    names = known.select(F.col(name).alias("known")).where("known is not null").distinct()
    tried = distinct.select("ref", F.posexplode(dotted_prefixes(F.col("ref"))).alias("depth", "known")).where(F.col("depth") >= least - 1)
    best = tried.join(names, "known").groupBy("ref").agg(F.max_by("known", "depth").alias("known"))
    return distinct.join(best, "ref", "left")


def prefix_minimal(refs: Column) -> Column:
    """The elements of an array that no other element is below."""
    return F.filter(refs, lambda u: ~F.exists(refs, lambda o: F.startswith(o, F.concat(u, F.lit(".")))))


# ---------------------------------------------------------------- licences, repositories, candidates


def licence_allowed(licence: Column, allowed: Sequence[str] = LICENSES) -> Column:
    return F.coalesce(licence.isin(*allowed), F.lit(False))


def prefilter_reason(is_fork: Column, licence: Column, stars: Column, pushed_at: Column, now: Column, min_stars: int = 200, max_age_days: int = 730, allowed: Sequence[str] = LICENSES) -> Column:
    """The first reason to turn a repository away, null if it passes. An empty or null push date passes."""
    cutoff = F.date_sub(now.cast("date"), max_age_days)
    pushed = F.expr("null").cast("date") if pushed_at is None else F.to_date(F.nullif(pushed_at.cast("string"), F.lit("")))
    return (
        F.when(is_fork, F.lit("fork"))
        .when(~licence_allowed(licence, allowed), F.concat(F.lit("licence "), F.coalesce(licence, F.lit("NO-LICENSE"))))
        .when(stars < min_stars, F.concat(stars.cast("string"), F.lit(" stars")))
        .when(pushed < cutoff, F.concat(F.lit("stale since "), F.date_format(pushed, "yyyy-MM-dd")))
    )


def not_ingested(candidates: DataFrame, official: DataFrame) -> DataFrame:
    """Candidates (repo, path) that don't lie in the official (repo, dir)."""
    o = official.select(F.col("repo").alias("o_repo"), F.col("dir").alias("o_dir"))
    inside = (candidates["repo"] == F.col("o_repo")) & (candidates["path"].startswith(F.concat(F.col("o_dir"), F.lit("/"))))
    return candidates.join(o, inside, "left_anti")


def score_files(functions: DataFrame, keys: Sequence[str], min_apis: int = 3) -> DataFrame:
    """(keys, max_apis_in_function, qualifying_functions) from (keys, function, api): distinct APIs per function, then per file."""
    per = functions.groupBy(*keys, "function").agg(F.count_distinct("api").alias("n"))
    return per.groupBy(*keys).agg(F.max("n").alias("max_apis_in_function"), F.count_if(F.col("n") >= min_apis).alias("qualifying_functions"))


def rank_candidates(scored: DataFrame, max_unknown: int = 0) -> DataFrame:
    """With ``recommended`` and in the order of the report: recommended first, then by qualifying functions and densest function."""
    ok = (F.col("qualifying_functions") >= 1) & (F.col("n_unknown") <= max_unknown)
    out = scored.withColumn("recommended", ok)
    return out.orderBy(F.desc("recommended"), F.desc("qualifying_functions"), F.desc("max_apis_in_function"), "repo", "path")


def example_dirs(paths: DataFrame, names: Sequence[str] = EXAMPLE_DIRS, path: str = "path") -> DataFrame:
    """(dir, n): files below each directory with a conventional name; a file counts for all of its ancestors that have one."""
    parts = F.split(F.col(path), "/")
    rows = paths.where(F.col(path).isNotNull()).select(parts.alias("parts"), F.posexplode(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))).alias("pos", "part"))
    named = rows.where(F.lower("part").isin(*[n.lower() for n in names]))
    return named.select(F.array_join(F.slice("parts", F.lit(1), F.col("pos") + 1), "/").alias("dir")).groupBy("dir").agg(F.count(F.lit(1)).alias("n"))


def best_example_dir(counts: DataFrame) -> DataFrame:
    return counts.orderBy(F.desc("n"), "dir").limit(1)


def resolve_ref(version: str, tags: DataFrame) -> DataFrame:
    """The tag of a version: its own name before the one with a v; no row if neither exists."""
    wanted = tags.sparkSession.createDataFrame([(version, 0), (f"v{version}", 1)], "tag string, ord int")
    return tags.select("tag").distinct().join(wanted, "tag").agg(F.min_by("tag", "ord").alias("tag")).where("tag is not null")


# ---------------------------------------------------------------- explanations


def pending_explanations(records: DataFrame) -> DataFrame:
    return records.where(F.coalesce(F.col("explanation"), F.lit("")) == "")


def invalidate(records: DataFrame, fields: Sequence[str] = (), everything: bool = False) -> DataFrame:
    """records with ``explanation`` null where any of the fields is present (or everywhere), and ``invalidated`` to tell which had one."""
    hit = F.lit(everything)
    for f in fields:
        hit = hit | field(f).isNotNull()
    had = F.coalesce(F.col("explanation"), F.lit("")) != ""
    return records.withColumn("invalidated", hit & had).withColumn("explanation", F.when(~hit, F.col("explanation")))


def first_by_name(records: DataFrame, order: str, name: str = "name") -> DataFrame:
    """The first record of each name, sorted by name."""
    rest = [c for c in records.columns if c != name]
    best = records.groupBy(name).agg(F.min_by(F.struct(*rest), F.col(order)).alias("r"))
    return best.select(name, *[F.col("r").getField(c).alias(c) for c in rest]).orderBy(name)
