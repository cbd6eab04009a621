"""Streaming ingest: record files as they arrive, chunked, and loaded into the vector store batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from cairn.config import Config
from cairn.operators.chunking import build_chunks
from cairn.operators.store import VectorStore
from cairn.schema import RECORD


def record_stream(spark: SparkSession, folder: str, schema: str = RECORD, fmt: str = "json", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch).load(folder)


def chunk_stream(records: DataFrame, config: Config = Config()) -> DataFrame:
    """Stateless: the same plan as for a batch."""
    return build_chunks(records, config)


def load_stream(chunks: DataFrame, store: VectorStore, embed: Callable[[DataFrame], DataFrame], checkpoint: str) -> DataStreamWriter:
    """A writer that upserts each micro-batch. A batch that is run again after a failure finds nothing pending, so the store ends the same."""

    def load(batch: DataFrame, epoch: int) -> None:
        store.load(batch, embed)

    return chunks.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
