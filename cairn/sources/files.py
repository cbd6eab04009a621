"""Source trees and manifests: one row per file, the prefix taken from the directory below src."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_tree(spark: SparkSession, src_dir: str, pattern: str) -> DataFrame:
    """(prefix, path, content) of the files below src_dir/<prefix>/ that match a glob, at any depth; empty files have no row."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(src_dir)
    root = src_dir.split("://", 1)[-1].rstrip("/") + "/"
    below = F.substring_index("path", root, -1)
    return rows.select(F.substring_index(below, "/", 1).alias("prefix"), F.regexp_replace(below, r"^[^/]*/", "").alias("path"), F.decode("content", "UTF-8").alias("content"))


def read_python(spark: SparkSession, src_dir: str) -> DataFrame:
    return read_tree(spark, src_dir, "*.py")


def read_markdown(spark: SparkSession, src_dir: str) -> DataFrame:
    return read_tree(spark, src_dir, "*.md")


_MANIFEST = "license string, files map<string,string>, licenses map<string,string>"


def read_manifests(spark: SparkSession, src_dir: str, name: str = "_manifest.json") -> DataFrame:
    """(prefix, path, url, license) of the files that the manifests src_dir/<prefix>/<name> list; none without manifests.

    A file that ``licenses`` names has that licence, even a null one; the others have the shared one. Spark's
    readers skip names with a leading underscore, so the manifests, one per source directory, are opened by
    the driver and taken apart by Spark.
    """
    to = spark._jvm.org.apache.hadoop.fs.Path
    fs = to(src_dir).getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for d in fs.listStatus(to(src_dir)):
        at = to(d.getPath(), name)
        if d.isDirectory() and fs.exists(at):
            stream = fs.open(at)
            try:
                found.append((d.getPath().getName(), bytes(stream.readAllBytes()).decode("utf-8")))
            finally:
                stream.close()
    rows = spark.createDataFrame(found, "prefix string, json string").select("prefix", F.from_json("json", _MANIFEST).alias("m"))
    flat = rows.select("prefix", "m.license", "m.licenses", F.explode("m.files").alias("path", "url"))
    own = F.coalesce(F.map_contains_key("licenses", F.col("path")), F.lit(False))
    return flat.select("prefix", "path", "url", F.when(own, F.try_element_at("licenses", F.col("path"))).otherwise(F.col("license")).alias("license"))


def local_path(repo: Column, path: Column) -> Column:
    """owner/name and a path -> where the file lies below src."""
    return F.concat(F.replace(repo, F.lit("/"), F.lit("__")), F.lit("/"), path)
