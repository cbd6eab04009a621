"""Chunk ids, content hashes and stored documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cairn.functions.text import present
from cairn.operators.incremental import text_hash

__all__ = ["chunk_id", "stored_document", "text_hash"]


def chunk_id(record_id: Column, chunk_type: Column, part: Column) -> Column:
    """record::type, and ::part for parts above 0."""
    return F.concat_ws("::", record_id, chunk_type, F.when(part > 0, part.cast("string")))


def stored_document(text: Column, return_text: Column) -> Column:
    return F.coalesce(present(return_text), text)
