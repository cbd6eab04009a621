"""Record files in and out: JSON lines with a fixed schema, corpora told apart by file name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.schema import RECORD


def read_jsonl(spark: SparkSession, path: str, schema: str = RECORD, corpus: bool = True) -> DataFrame:
    """JSON lines of a file, folder or glob; blank lines are skipped, a broken line fails.

    ``corpus`` is the name of the file without its ending, unless the rows have their own.
    """
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if not corpus:
        return rows
    stem = F.regexp_replace(F.col("_metadata.file_name"), r"(_chunks)?\.jsonl(\.gz)?$", "")
    return rows.select(*[c for c in rows.columns if c != "corpus"], (F.coalesce(F.col("corpus"), stem) if "corpus" in rows.columns else stem).alias("corpus"))


CHUNK = "record_id string, chunk_type string, part int, text string, return_text string"


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """All chunk files ``*_chunks.jsonl`` (or folders of that name) of a folder as one table; corpus is the name before that."""
    rows = spark.read.schema(CHUNK).option("mode", "FAILFAST").option("recursiveFileLookup", True).json(f"{folder.rstrip('/')}/*_chunks.jsonl")
    return rows.withColumn("corpus", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)_chunks\.jsonl", 1))


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines; the nulls of nested structs stay explicit, top-level nulls are left out as in the records."""
    packed = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns]), {"ignoreNullFields": "true"})
    nested = [f.name for f in df.schema.fields if "struct" in f.dataType.simpleString()]
    if nested:
        # per row: only present columns are written, and nested ones with their nulls
        parts = [F.when(F.col(f"`{c}`").isNotNull(), F.expr(f"substring(to_json(struct(`{c}`), map('ignoreNullFields', 'false')), 2, length(to_json(struct(`{c}`), map('ignoreNullFields', 'false'))) - 2)")) for c in df.columns]
        packed = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    df.select(packed.alias("value")).write.mode("overwrite").text(path)


def align(df: DataFrame, schema: str = RECORD) -> DataFrame:
    """A table with the columns of a schema; those it lacks are null, others are dropped."""
    from pyspark.sql.types import StructType

    want = StructType.fromDDL(schema)
    return df.select(*[(F.col(f"`{f.name}`").cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields])


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)
