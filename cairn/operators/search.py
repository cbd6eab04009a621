"""Nearest chunks by cosine distance, at most one hit per record."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.runtime import materialise

MAX_TOP_K = 5
#: Query vectors and store vectors of one product: 512 x 8192 distances are 32 MB.
QUERY_BLOCK, ROW_BLOCK = 512, 8192


def clamp_k(k: int, most: int = MAX_TOP_K) -> int:
    return max(1, min(int(k), most))


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cosine, in double; null for zero or null vectors and for unequal lengths."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), F.lit(1.0) - dot(a, b) / norms)


def _rows_of(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(which lists have ``width`` elements and no null among them, those as unit rows; zero rows are NaN)."""
    keep = pc.fill_null(pc.equal(pc.list_value_length(column), width), False).to_numpy(zero_copy_only=False)
    flat = column.filter(pa.array(keep)).flatten().to_numpy(zero_copy_only=False).astype(float)
    x = flat.reshape(-1, width)
    length = np.sqrt((x * x).sum(1))
    return np.flatnonzero(keep), x / np.where(length > 0, length, np.nan)[:, None]


def distances_to(vector: Sequence[float]) -> Callable[[Column], Column]:
    """The distance of an array column to one vector, one product per Arrow batch; null for null and zero vectors and other lengths."""
    q = np.asarray(vector, float)
    length = math.sqrt(float(q @ q))

    @F.arrow_udf("double")
    def distance(column: pa.Array) -> pa.Array:
        out = np.full(len(column), np.nan)
        if length > 0:
            at, x = _rows_of(column, len(q))
            out[at] = 1.0 - x @ (q / length)
        return pa.array(out, pa.float64(), mask=np.isnan(out))

    return distance


def search(store: DataFrame, vector: Sequence[float], k: int = MAX_TOP_K, most: int = MAX_TOP_K) -> DataFrame:
    """The k records whose nearest chunk is nearest: (record_id, matched_chunk_type, distance, text).

    Exact, so nothing is widened: the least distance per record by partial aggregation, then a top-k.
    Ties go by distance, record_id, chunk_type, chunk_id. Null distances come last. k is clamped to 1..most.
    """
    near = store.withColumn("distance", distances_to(vector)(F.col("embedding")))
    order = F.struct(F.col("distance").isNull().alias("none"), "distance", "chunk_type", "chunk_id")
    best = near.groupBy("record_id").agg(F.min_by(F.struct("chunk_type", "distance", "document"), order).alias("b"))
    hits = best.select("record_id", F.col("b.chunk_type").alias("matched_chunk_type"), F.col("b.distance").alias("distance"), F.col("b.document").alias("text"))
    return hits.orderBy(F.asc_nulls_last("distance"), "record_id").limit(clamp_k(k, most))


def _nearest(least: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k least finite values of each column, the upper row of equals."""
    n = len(least)
    if n > k:
        kth = np.partition(least, k - 1, axis=0)[k - 1]
        chosen = (least <= kth) & np.isfinite(least)
    else:
        chosen = np.isfinite(least)
    below = chosen & (least < kth) if n > k else chosen
    if n > k:  # of those at the edge only as many as there is room for, from above
        edge = chosen & ~below
        chosen = below | (edge & (np.cumsum(edge, axis=0) <= k - below.sum(axis=0)))
    return np.nonzero(chosen)


def search_batch(store: DataFrame, queries: DataFrame, k: int = MAX_TOP_K, block: int = QUERY_BLOCK, rows: int = ROW_BLOCK) -> DataFrame:
    """All queries (query_id, vector) against the whole store: (query_id, record_id, distance, rank).

    The queries are written to the shared folder and the store is scanned once: a task takes ``rows`` vectors of the store
    at a time and reads the queries past them in blocks of ``block``, so what it holds is a matrix of that size and the
    driver holds nothing. Of each such product the k best records per query leave the task, not a row per pair.
    Ties go by record_id; null and zero vectors, and vectors of other lengths, are near to nothing.
    """
    qid, rid = (df.schema[c].dataType.simpleString() for df, c in ((queries, "query_id"), (store, "record_id")))
    asked = materialise(queries.select("query_id", F.col("vector").cast("array<double>").alias("vector")), "queries").scratch

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import dataset
        from pyarrow.fs import FileSystem

        fs, where = FileSystem.from_uri(asked if "://" in asked else f"file://{asked}")

        def against(part: pa.Table) -> Iterator[pa.RecordBatch]:
            vectors = part.column("embedding").combine_chunks()
            known: dict[int, tuple] = {}
            for q in dataset.dataset(where, filesystem=fs, format="parquet").to_batches(batch_size=block):
                sizes = pc.list_value_length(q.column("vector"))
                for width in pc.unique(sizes.drop_null()).to_pylist():
                    if width not in known:
                        at, x = _rows_of(vectors, width)
                        names = part.column("record_id").take(pa.array(at)).combine_chunks()
                        order = pc.array_sort_indices(names).to_numpy()
                        names, x = names.take(pa.array(order)), x[order]
                        # where a record begins: names are sorted, nulls are one record of their own
                        same = pc.fill_null(pc.equal(names[1:], names[:-1]), False).to_numpy(zero_copy_only=False) if len(names) else np.empty(0, bool)
                        null = names.is_null().to_numpy(zero_copy_only=False)
                        first = np.flatnonzero(np.concatenate([[True], ~(same | null[1:] & null[:-1])])) if len(names) else np.empty(0, int)
                        known[width] = (names.take(pa.array(first)), first, x)
                    names, first, x = known[width]
                    if not len(names):
                        continue
                    of, m = _rows_of(q.column("vector"), width)
                    least = np.minimum.reduceat(np.nan_to_num(1.0 - x @ m.T, nan=np.inf), first, axis=0)
                    row, column = _nearest(least, k)
                    yield pa.record_batch([q.column("query_id").take(pa.array(of[column])), names.take(pa.array(row)), pa.array(least[row, column])], names=["query_id", "record_id", "distance"])

        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(h.num_rows for h in held) >= rows:
                yield from against(pa.Table.from_batches(held))
                held = []
        if held:
            yield from against(pa.Table.from_batches(held))

    near = store.select("record_id", "embedding").mapInArrow(best, f"query_id {qid}, record_id {rid}, distance double")
    one = near.groupBy("query_id", "record_id").agg(F.min("distance").alias("distance"))
    w = Window.partitionBy("query_id").orderBy("distance", "record_id")
    return one.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def serve(store: DataFrame, embed: Callable[[str], Sequence[float]], query: str, k: int = MAX_TOP_K) -> list[dict]:
    """The serving call: embeds one query on the driver and returns its hits."""
    return [r.asDict() for r in search(store, embed(query), k).collect()]
