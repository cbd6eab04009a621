"""The flows from end to end: API records, code and documentation records, community candidates, ingest, serving."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.config import Config
from cairn.operators import chunking, enrich, markdown, policy, pycode, search, signatures
from cairn.operators.store import VectorStore
from cairn.runtime import filesystem
from cairn.sources import fetch, files, introspect, records


def api_records(spark: SparkSession, library: str, version: str | None = None, exclude: Sequence[str] = (), keep: Sequence[str] = ()) -> DataFrame:
    """The library's API as records: introspected, one per name, filtered by prefix, with prose and parameters, sorted by name."""
    spark.dataSource.register(introspect.LibraryApi)
    reader = spark.read.format("library_api").option("library", library)
    rows = (reader.option("version", version) if version else reader).load()
    rows = policy.first_by_name(rows, "ord").drop("ord")
    for mode, prefixes in (("exclude", exclude), ("keep", keep)):
        if prefixes:
            rows = policy.by_prefix(rows, policy.prefix_frame(rows, prefixes), mode)
    rows = rows.withColumn("doc", signatures.prose(F.col("kind"), F.col("doc")))
    return records.align(signatures.with_parameters(rows).withColumn("corpus", F.lit("api"))).orderBy("name")


def source_records(spark: SparkSession, config: Config, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records of all Python and Markdown files below src, errors). Official files should be there before community ones are judged."""
    manifests = files.read_manifests(spark, config.src_dir, config.manifest)
    code, errors = pycode.code_records(files.read_python(spark, config.src_dir), config.library, known, manifests)
    docs = markdown.parse_markdown(files.read_markdown(spark, config.src_dir))
    return records.align(code).unionByName(records.align(docs)), errors


def official_source(spark: SparkSession, config: Config, client: fetch.Fetcher, package_url: str, tags: DataFrame, tree: DataFrame, raw_url: Callable[[fetch.Source, str], str], prefix: str = "official") -> tuple[fetch.Source, DataFrame]:
    """(where the examples lie, the files with whether they were fetched): the example files of the library's own repository
    are downloaded below src/<prefix> with their manifest, where ``source_records`` reads them. ``raw_url`` makes the address
    of a file's content from the source and a name."""
    source = fetch.resolve_source(spark, config, fetch.package_metadata(client, package_url), tags, tree)
    folder = f"{config.src_dir}/{prefix}"
    got = fetch.download(fetch.example_files(tree, source), client, F.concat(F.lit(raw_url(source, "")), F.col("path")), folder, config.politeness_seconds)
    fetch.write_manifest(spark, fetch.manifest(source, got.where("fetched")), folder, config.manifest)
    return source, got


def community_files(spark: SparkSession, config: Config, candidates: DataFrame, client: fetch.Fetcher, url_of_file: Column, prefix: str = "community") -> DataFrame:
    """The recommended candidates downloaded below src/<prefix>, with a manifest of one licence per file."""
    chosen = candidates.where("recommended").select("repo", F.col("path").alias("repo_path"), "branch", "license", F.col("local_path").alias("path"), F.col("source").alias("page"))
    folder = f"{config.src_dir}/{prefix}"
    seen = chosen.withColumn("_path", F.col("path")).withColumn("path", F.col("repo_path")).withColumn("_at", url_of_file)
    got = fetch.download(seen.withColumn("path", F.col("_path")).drop("_path"), client, F.col("_at"), folder, config.politeness_seconds).drop("_at")
    rows = got.where("fetched").select("path", "page", "license").collect()  # as many as a report recommends, and a manifest names them all
    fetch.write_manifest(spark, {"source": prefix, "license": None, "files": {r.path: r.page for r in rows}, "licenses": {r.path: r.license for r in rows}}, folder, config.manifest)
    return got


def import_only(read: DataFrame) -> DataFrame:
    """(prefix, path): files that parse and refer to nothing of the library, of the output of ``pycode.read_code``."""
    return read.where(F.col("error").isNull() & ~F.exists("segments", lambda s: F.size(s.getField("refs")) > 0)).select("prefix", "path")


def duplicates(rows: DataFrame) -> DataFrame:
    """(corpus, name, n): names that a corpus has more than once."""
    return rows.groupBy("corpus", "name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def summary(rows: DataFrame) -> DataFrame:
    """Per corpus and kind: records, those with unknown references, licences."""
    return rows.groupBy("corpus", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("unknown_refs") > 0).alias("n_unknown"), F.array_sort(F.collect_set("license")).alias("licenses"))


def community_candidates(
    spark: SparkSession, config: Config, known: DataFrame, hits: DataFrame, client: fetch.Fetcher, url_of_repo: Callable[[str], str], url_of_file: Column, now: Column, official: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(candidates in the order of the report, repositories turned away with the reason).

    Cheap tests come first: repositories are judged before any of their files is fetched, and files of the
    official source are left out before the fetch, too. ``url_of_file`` sees repo, branch and path.
    """
    repos = fetch.repo_metadata(fetch.repo_files(hits), client, url_of_repo, config.politeness_seconds)
    reason = policy.prefilter_reason(F.col("is_fork"), F.col("license"), F.col("stars"), F.col("pushed_at"), now, config.min_stars, config.max_age_days, config.licenses)
    judged = repos.withColumn("reason", reason)
    away = judged.where("reason is not null").select("repo", "reason")
    paths = judged.where("reason is null").select("repo", "branch", "license", "stars", "pushed_at", F.explode("paths").alias("path"))
    if official is not None:
        paths = policy.not_ingested(paths, official)
    got = fetch.file_contents(paths, client, url_of_file).where("content is not null")
    scored = pycode.file_scores(got.select(F.col("repo").alias("prefix"), "path", "content"), config.library, known, config.min_apis_per_function)
    rows = scored.withColumnRenamed("prefix", "repo").join(got.drop("content"), ["repo", "path"])
    ranked = policy.rank_candidates(rows.withColumn("local_path", files.local_path(F.col("repo"), F.col("path"))).withColumn("source", url_of_file), config.max_unknown_refs)
    cols = ("repo", "path", "branch", "local_path", "source", "license", "stars", "pushed_at", "recommended", "apis_used", "unknown_refs", "lines", "max_apis_in_function", "qualifying_functions")
    return ranked.select(*cols), away


def write_candidates(candidates: DataFrame, config: Config) -> None:
    candidates.write.mode("overwrite").parquet(config.candidates_dir)


def explained(rows: DataFrame, complete: Callable[[str, str], str], config: Config = Config(), skip_kinds: Sequence[str] = ()) -> DataFrame:
    """(name, explanation, error) for what is pending; write it down before joining it back, so that no model is asked twice."""
    todo = rows.where(~F.col("kind").isin(*skip_kinds)) if skip_kinds else rows
    return enrich.explain(todo, complete, config.attempts, config.retry_seconds)


def explain_all(rows: DataFrame, complete: Callable[[str, str], str], table: str, config: Config = Config(), skip_kinds: Sequence[str] = (), blocks: int = 16) -> DataFrame:
    """rows with explanations, which are kept in a table of their own: what it has isn't asked for again.

    Pending records are split into ``blocks`` by name, each of which is appended when it is done, so a job that dies repeats at
    most one block. What failed isn't kept and stays pending.
    """
    spark = rows.sparkSession
    kept = "name string, explanation string"
    fs, to = filesystem(spark, table)
    have = lambda: spark.read.schema(kept).parquet(table) if fs.exists(to(table)) else spark.createDataFrame([], kept)
    for k in range(blocks):
        block = rows.where(F.pmod(F.xxhash64("name"), F.lit(blocks)) == k).join(have().select("name").distinct(), "name", "left_anti")
        explained(block, complete, config, skip_kinds).where("explanation is not null").select("name", "explanation").write.mode("append").parquet(table)
    return enrich.with_explanations(rows, have().dropDuplicates(["name"]).withColumn("error", F.lit(None).cast("string")))


def invalidation_report(rows: DataFrame, fields: Sequence[str] = (), everything: bool = False, shown: int = 10) -> dict:
    """What an invalidation would touch: how many, the first names, how many more."""
    hit = policy.invalidate(rows, fields, everything).where("invalidated").select("name")
    n = hit.count()
    return {"invalidated": n, "names": [r.name for r in hit.orderBy("name").limit(shown).collect()], "more": max(0, n - shown)}


def ingest(rows: DataFrame, store: VectorStore, model: Callable[[Sequence[str]], Sequence[Sequence[float]]], config: Config = Config(), prune: bool = False) -> int:
    """Records to vectors: chunks, the difference to the store, embeddings, one commit. Returns how many rows were written."""
    return store.load(chunking.build_chunks(rows, config), lambda todo: enrich.embed(todo, model, attempts=config.attempts, first_pause=config.retry_seconds), prune=prune)


def answer(spark: SparkSession, config: Config, embed: Callable[[str], Sequence[float]], query: str, k: int = 5) -> list[dict]:
    """One question to the store of a corpus, which must exist."""
    return search.serve(VectorStore.open(spark, config.store_dir).read(), embed, query, min(k, config.top_k))
