"""The vector table: an immutable base with deltas and an atomic pointer; only new or changed chunks are embedded and written."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.functions.hashing import chunk_id, stored_document, text_hash
from cairn.runtime import filesystem, numbered, read_text, write_once
from cairn.schema import VECTOR, columns


def keyed(chunks: DataFrame) -> DataFrame:
    """chunks with chunk_id and text_hash; null parts count as 0."""
    part = F.coalesce(F.col("part"), F.lit(0))
    return chunks.withColumn("part", part).withColumn("chunk_id", chunk_id(F.col("record_id"), F.col("chunk_type"), part)).withColumn("text_hash", text_hash(F.col("text"), F.col("return_text")))


def last_of(chunks: DataFrame, order: list[str]) -> DataFrame:
    """One row per chunk_id: the last by ``order`` (ids may collide, the last delivery counts)."""
    rest = [c for c in chunks.columns if c != "chunk_id"]
    best = chunks.groupBy("chunk_id").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return best.select("chunk_id", *[F.col("r").getField(c).alias(c) for c in rest])


def pending(chunks: DataFrame, stored: DataFrame) -> DataFrame:
    """Keyed chunks that the store lacks or holds with another (or no) hash."""
    return chunks.join(stored.where("text_hash is not null").select("chunk_id", "text_hash"), ["chunk_id", "text_hash"], "left_anti")


def upserted(stored: DataFrame, fresh: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """stored with the rows of fresh put in or replaced; with ``keep``, ids that it lacks are pruned."""
    out = stored.join(fresh.select("chunk_id"), "chunk_id", "left_anti").unionByName(fresh)
    return out if keep is None else out.join(keep.select("chunk_id"), "chunk_id", "left_semi")


#: Columns that tell which of two deliveries of a chunk is the later one, if the chunks have them.
ORDER = ("parsed_at", "arrived_at", "chunk_seq")
#: What a delta has beside a vector row: whether the chunk was removed.
DELTA = VECTOR + ", gone boolean"


class Conflict(RuntimeError):
    """Another writer came first; nothing of this commit is visible, load again."""


class VectorStore:
    """A base table and the deltas since. ``HEAD/<n>.json`` names those of version n; it appears by a rename that
    doesn't replace, so of two writers one fails.

    A load writes its new and changed rows only. After ``COMPACT`` deltas a load folds them into a new base;
    ``vacuum`` removes what older versions alone name.
    """

    COMPACT = 16

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs, self._to = filesystem(spark, self.path)

    @classmethod
    def create(cls, spark: SparkSession, path: str, metric: str = "cosine", dim: int | None = None, model: str | None = None) -> VectorStore:
        store = cls(spark, path)
        if not store.exists():
            store._fs.mkdirs(store._to(f"{store.path}/HEAD"))
            try:
                write_once(spark, f"{store.path}/meta.json", json.dumps({"metric": metric, "dim": dim, "model": model}))
            except FileExistsError:  # made at the same time by another one
                pass
        return store

    @classmethod
    def open(cls, spark: SparkSession, path: str) -> VectorStore:
        """The store for reading; it is never made here."""
        store = cls(spark, path)
        if not store.exists():
            raise LookupError(f"there is no vector store at {path}; load one first")
        return store

    def exists(self) -> bool:
        return self._fs.exists(self._to(f"{self.path}/meta.json"))

    def meta(self) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/meta.json"))

    def version(self) -> int:
        return max(numbered(self.spark, f"{self.path}/HEAD"), default=0)

    def _head(self, n: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/HEAD/{n:09d}.json")) if n else {"base": None, "deltas": []}

    def read(self, version: int | None = None) -> DataFrame:
        """The live rows: of the deltas the last one counts, and the base has what no delta has."""
        head = self._head(self.version() if version is None else version)
        base = self.spark.read.schema(VECTOR).parquet(f"{self.path}/{head['base']}") if head["base"] else self.spark.createDataFrame([], VECTOR)
        if not head["deltas"]:
            return base
        deltas = [self.spark.read.schema(DELTA).parquet(f"{self.path}/{d}").withColumn("delta", F.lit(k)) for k, d in enumerate(head["deltas"])]
        newest = deltas[0] if len(deltas) == 1 else last_of(reduce(DataFrame.unionAll, deltas), ["delta"])
        kept = base.join(newest.select("chunk_id"), "chunk_id", "left_anti") if head["base"] else base
        return kept.unionByName(newest.where("not gone").select(columns(VECTOR)))

    def count(self) -> int:
        return self.read().count()

    def _commit(self, before: int, head: dict) -> int:
        try:
            write_once(self.spark, f"{self.path}/HEAD/{before + 1:09d}.json", json.dumps(head))
        except FileExistsError as err:
            raise Conflict(f"version {before + 1} of {self.path} exists") from err
        return before + 1

    def compact(self) -> int:
        """One base of the live rows."""
        n, name = self.version(), f"base/{uuid.uuid4().hex}"
        self.read(n).write.parquet(f"{self.path}/{name}")
        return self._commit(n, {"base": name, "deltas": []})

    def vacuum(self, keep: int = 1) -> int:
        """Removes tables that the last ``keep`` versions don't name, and older versions (run it while nobody loads); returns how many tables."""
        heads = numbered(self.spark, f"{self.path}/HEAD")
        named = {x for n in heads[-keep:] for h in [self._head(n)] for x in [h["base"], *h["deltas"]]}
        removed = 0
        for kind in ("base", "deltas"):
            where = self._to(f"{self.path}/{kind}")
            for s in self._fs.listStatus(where) if self._fs.exists(where) else []:
                if f"{kind}/{s.getPath().getName()}" not in named:
                    removed += bool(self._fs.delete(s.getPath(), True))
        for n in heads[:-keep]:
            self._fs.delete(self._to(f"{self.path}/HEAD/{n:09d}.json"), False)
        return removed

    def load(self, chunks: DataFrame, embed: Callable[[DataFrame], DataFrame], order: list[str] | None = None, prune: bool = False) -> int:
        """Embeds what is pending and commits; returns how many rows were written.

        ``embed`` adds ``embedding`` to rows (null where the model failed: those stay pending). Its output is the
        delta itself, written once, so no model is called twice for a row of one load. Of several deliveries of
        a chunk the last by ``order`` counts, by default the columns of ``ORDER`` that the chunks have; without
        any, the greatest text_hash does. Loads count in the order in which they commit.
        """
        order = order or [c for c in ORDER if c in chunks.columns] or ["corpus", "text_hash"]
        rows, before = last_of(keyed(chunks), order), self.version()
        stored, head = self.read(before), self._head(before)
        todo = pending(rows, stored).withColumn("document", stored_document(F.col("text"), F.col("return_text")))
        delta = f"deltas/{uuid.uuid4().hex}"
        fresh = embed(todo).where("embedding is not null").select("chunk_id", "record_id", "chunk_type", "text_hash", F.col("embedding").cast("array<float>").alias("embedding"), "document", F.lit(False).alias("gone"))
        fresh.write.parquet(f"{self.path}/{delta}")
        made = [delta]
        if prune:
            gone = stored.join(rows.select("chunk_id"), "chunk_id", "left_anti").select("chunk_id", *[F.lit(None).cast(f.dataType).alias(f.name) for f in stored.schema.fields[1:]], F.lit(True).alias("gone"))
            made.append(f"deltas/{uuid.uuid4().hex}")
            gone.write.parquet(f"{self.path}/{made[1]}")
        counts = [self.spark.read.schema(DELTA).parquet(f"{self.path}/{d}").count() for d in made]
        kept = [d for d, n in zip(made, counts) if n]
        try:
            if kept:
                self._commit(before, {"base": head["base"], "deltas": head["deltas"] + kept})
        except Conflict:
            kept = []
            raise
        finally:
            for d in made:
                if d not in kept:
                    self._fs.delete(self._to(f"{self.path}/{d}"), True)
        if len(head["deltas"]) + len(kept) >= self.COMPACT:
            self.compact()
        return counts[0]
