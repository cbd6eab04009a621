"""Processing only new or changed records: an interval ledger over sequence numbers.

Processed sequence numbers are kept as disjoint intervals. A run subtracts them from the ranges
that are available, processes the rows in the gaps (rows with low numbers that were committed late
included) and commits its output and the merged intervals in one atomic step.

Everything is sharded by sequence block: intervals never cross the edge of a block of ``BLOCK``
numbers, so each window below sees at most one block, whatever the size of the table, and no key of
the data (record, source) ever decides how work is spread.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.runtime import filesystem, numbered, read_text, scratch, write_once

#: Sequence numbers in a block: the bound of every group that a task sorts.
BLOCK = 1 << 15
#: Blocks with gaps that a broadcast carries; beyond it they are joined by a shuffle.
BROADCAST_BLOCKS = 100_000

INTERVALS = "block bigint, lo bigint, hi bigint"


def _block(seq: Column) -> Column:
    return F.floor(seq / F.lit(BLOCK)).cast("bigint")


def intervals(df: DataFrame, seq: str) -> DataFrame:
    """The distinct non-null numbers of ``seq`` as disjoint maximal intervals (block, lo, hi).

    Repeated numbers count once, null numbers have no place in a sequence and are left out (callers
    that may meet them must give them a number), an empty table gives no interval.
    """
    n = df.select(F.col(seq).cast("bigint").alias("n")).where("n is not null")
    # partitioned by block once: the distinct, the window and the grouping below need no further shuffle
    n = n.withColumn("block", _block(F.col("n"))).repartition("block").distinct()
    w = Window.partitionBy("block").orderBy("n")
    return n.withColumn("run", F.col("n") - F.row_number().over(w)).groupBy("block", "run").agg(F.min("n").alias("lo"), F.max("n").alias("hi")).drop("run")


def _coverage(*parts: tuple[DataFrame, str]) -> DataFrame:
    """Elementary segments (block, lo, hi) with the number of intervals of each part that cover them."""
    names = [n for _, n in parts]
    events = None
    for df, name in parts:
        ends = F.explode(F.array(F.struct(F.col("lo").alias("pos"), F.lit(1).alias("step")), F.struct((F.col("hi") + 1).alias("pos"), F.lit(-1).alias("step"))))
        e = df.select("block", ends.alias("e")).select("block", "e.pos", *[(F.col("e.step") if n == name else F.lit(0)).cast("bigint").alias(n) for n in names])
        events = e if events is None else events.unionAll(e)
    at = events.repartition("block").groupBy("block", "pos").agg(*[F.sum(n).alias(n) for n in names])
    w = Window.partitionBy("block").orderBy("pos")
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return at.select("block", F.col("pos").alias("lo"), (F.lead("pos").over(w) - 1).alias("hi"), *[F.sum(n).over(run).alias(n) for n in names]).where("hi is not null")


def _joined(segments: DataFrame) -> DataFrame:
    """Adjacent segments of a block become one."""
    w = Window.partitionBy("block").orderBy("lo")
    start = F.when(F.lag("hi").over(w) == F.col("lo") - 1, 0).otherwise(1)
    grouped = segments.withColumn("start", start).withColumn("g", F.sum("start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return grouped.groupBy("block", "g").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("g")


def subtract(available: DataFrame, processed: DataFrame) -> DataFrame:
    """The gaps: what ``available`` covers and ``processed`` doesn't, as disjoint maximal intervals."""
    return _joined(_coverage((available, "a"), (processed, "p")).where("a > 0 and p = 0").select("block", "lo", "hi"))


def merge(a: DataFrame, b: DataFrame) -> DataFrame:
    """The union of two interval tables as disjoint maximal intervals."""
    return _joined(_coverage((a, "a"), (b, "b")).where("a > 0 or b > 0").select("block", "lo", "hi"))


def rows_near(rows: DataFrame, seq: str, gaps: DataFrame) -> DataFrame:
    """The rows of the blocks that have a gap: what else there is never gets into a shuffle.

    The outermost numbers go into the scan as a filter, the blocks come by a semi-join. ``gaps`` should be a written table.
    """
    low, high, n = gaps.agg(F.min("lo"), F.max("hi"), F.count_distinct("block")).first()
    if n == 0:
        return rows.where(F.lit(False))
    number = F.col(f"`{seq}`")
    blocks = gaps.select(F.col("block").alias("_block")).distinct()
    near = rows.where((number >= low) & (number <= high))
    near = near.withColumn("_block", _block(number.cast("bigint")))
    return near.join(F.broadcast(blocks) if n <= BROADCAST_BLOCKS else blocks, "_block", "left_semi").drop("_block")


def rows_in(rows: DataFrame, seq: str, gaps: DataFrame) -> DataFrame:
    """The rows whose number lies in one of the (disjoint) gaps, with the columns of ``rows``.

    A sweep over each block instead of a range join: the last gap that began at or before a row is
    the only one that can hold it. Rows with a null number are in no gap.
    """
    cols = rows.columns
    near = rows_near(rows, seq, gaps)
    tagged = near.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("r"), F.col(f"`{seq}`").cast("bigint").alias("pos")).where("pos is not null")
    tagged = tagged.select(_block(F.col("pos")).alias("block"), "pos", F.lit(1).alias("kind"), F.lit(None).cast("bigint").alias("hi"), "r")
    starts = gaps.select("block", F.col("lo").alias("pos"), F.lit(0).alias("kind"), "hi", F.lit(None).cast(tagged.schema["r"].dataType).alias("r"))
    w = Window.partitionBy("block").orderBy("pos", "kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = tagged.unionAll(starts).withColumn("hi", F.last("hi", ignorenulls=True).over(w))
    return swept.where("kind = 1 and pos <= hi").select([F.col("r").getField(c).alias(c) for c in cols])


class Conflict(RuntimeError):
    """Another run committed first; nothing of this one is visible, run it again."""


class IntervalLedger:
    """The processed intervals and the outputs of a job, kept between runs below a folder that all executors share.

    ``commits/<n>.json`` names the output and the interval snapshot of commit n. It appears by a rename
    that doesn't replace, which is the only commit point: output of a run that died before it is never
    read, and the next run meets the same gaps. Two runs at once can't both commit. Every ``CHECKPOINT``
    commits ``checkpoints/<n>.json`` sums up the log, so a run reads a bounded number of small files.
    """

    CHECKPOINT = 32

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._fs, self._to = filesystem(spark, self.path)
        for folder in ("commits", "checkpoints"):
            self._fs.mkdirs(self._to(f"{self.path}/{folder}"))

    def version(self) -> int:
        return max(numbered(self.spark, f"{self.path}/commits"), default=0)

    def _commit_of(self, n: int) -> dict:
        return json.loads(read_text(self.spark, f"{self.path}/commits/{n:09d}.json"))

    def outputs(self, since: int = 0) -> list[str]:
        """The folders of committed output of versions above ``since``, in their order."""
        last = self.version()
        known = [n for n in numbered(self.spark, f"{self.path}/checkpoints") if n <= last]
        summed = json.loads(read_text(self.spark, f"{self.path}/checkpoints/{known[-1]:09d}.json")) if known else {"version": 0, "outputs": []}
        later = [(n, self._commit_of(n)["output"]) for n in range(summed["version"] + 1, last + 1)]
        return [o for n, o in [*map(tuple, summed["outputs"]), *later] if o and n > since]

    def processed(self) -> DataFrame:
        n = self.version()
        if n == 0:
            return self.spark.createDataFrame([], INTERVALS)
        return self.spark.read.schema(INTERVALS).parquet(f"{self.path}/{self._commit_of(n)['intervals']}")

    def output(self, schema, since: int = 0) -> DataFrame:
        paths = [f"{self.path}/{o}" for o in self.outputs(since)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def gaps(self, available: DataFrame) -> DataFrame:
        """What of the available intervals isn't processed, as a written table: rows that arrive meanwhile belong to the next run."""
        path = f"{self.path}/gaps/{uuid.uuid4().hex}"
        subtract(available, self.processed()).write.parquet(path)
        return self.spark.read.schema(INTERVALS).parquet(path)

    def run(self, source: DataFrame, seq: str, process: Callable[[DataFrame], DataFrame], before_commit: Callable[[], None] | None = None) -> int:
        """Processes what no committed run has processed; returns the version of the new commit.

        ``process`` gets the rows in the gaps. ``before_commit`` is called after all data is written.
        """
        version, run = self.version() + 1, uuid.uuid4().hex
        gaps = self.gaps(intervals(source, seq))
        process(rows_in(source, seq, gaps)).write.parquet(f"{self.path}/output/{run}")
        merge(self.processed(), gaps).write.parquet(f"{self.path}/intervals/{run}")
        if before_commit:
            before_commit()
        self._commit({"version": version, "output": f"output/{run}", "intervals": f"intervals/{run}"})
        return version

    def settle(self, done: DataFrame) -> int:
        """Commits intervals that are known to be processed, without output: numbers that were processed and aren't in
        ``done`` (their output was lost elsewhere) are gaps again."""
        version, run = self.version() + 1, uuid.uuid4().hex
        done.select("block", "lo", "hi").write.parquet(f"{self.path}/intervals/{run}")
        self._commit({"version": version, "output": None, "intervals": f"intervals/{run}"})
        return version

    def _commit(self, entry: dict) -> None:
        n = entry["version"]
        try:
            write_once(self.spark, f"{self.path}/commits/{n:09d}.json", json.dumps(entry))
        except FileExistsError as err:
            raise Conflict(f"commit {n} exists") from err
        if n % self.CHECKPOINT == 0:
            before = max((k for k in numbered(self.spark, f"{self.path}/checkpoints") if k < n), default=0)
            outputs = json.loads(read_text(self.spark, f"{self.path}/checkpoints/{before:09d}.json"))["outputs"] if before else []
            outputs += [[k, self._commit_of(k)["output"]] for k in range(before + 1, n + 1)]
            try:
                write_once(self.spark, f"{self.path}/checkpoints/{n:09d}.json", json.dumps({"version": n, "outputs": outputs}))
            except FileExistsError:  # another one summed up the same log
                pass

    def vacuum(self) -> int:
        """Removes what no commit names (run it while no other run is at work); returns how many folders."""
        removed, last = 0, self.version()
        keep = {*self.outputs(), *([self._commit_of(last)["intervals"]] if last else [])}
        for kind in ("gaps", "output", "intervals"):
            where = self._to(f"{self.path}/{kind}")
            for s in self._fs.listStatus(where) if self._fs.exists(where) else []:
                if f"{kind}/{s.getPath().getName()}" not in keep:
                    removed += bool(self._fs.delete(s.getPath(), True))
        return removed


# ---------------------------------------------------------------- chunks against the store

KEY = ["record_id", "chunk_type", "part"]


def text_hash(text: Column, return_text: Column) -> Column:
    """SHA-256 of text, NUL and return_text in UTF-8, lower-case hex; null counts as empty."""
    return F.sha2(F.concat(F.coalesce(text, F.lit("")), F.lit("\x00"), F.coalesce(return_text, F.lit(""))), 256)


#: Stands for a null in a key, so that groupings and joins share one partitioning.
_NULL = "\x00null"


def _key(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(_NULL)).alias(name)


def durable_entries(store_rows: DataFrame, load_flushes: DataFrame) -> DataFrame:
    """Per chunk the hash of its latest entry of a committed flush: (record_id, chunk_type, part, stored_hash).

    part is what ``id`` has behind record_id::chunk_type (nothing: 0). Of entries with equal written_at
    the one with the larger entry_id counts; null written_at is older than any. Nulls of a key are spelled out.
    """
    committed = load_flushes.where("committed_at is not null").select("flush_id").distinct()
    part = F.expr("coalesce(try_cast(nullif(substring(id, length(record_id) + length(chunk_type) + 5), '') as int), 0)")
    rows = store_rows.join(committed, "flush_id", "left_semi").select(_key("record_id"), _key("chunk_type"), part.alias("part"), "written_at", "entry_id", "text_hash")
    order = F.struct(F.col("written_at").isNotNull(), "written_at", "entry_id")
    latest = rows.groupBy(*KEY).agg(F.max_by(F.struct("text_hash"), order).alias("last"))
    return latest.select(*KEY, F.col("last.text_hash").alias("stored_hash"))


def _deliveries(chunks: DataFrame, *extra: Column) -> DataFrame:
    # a null parsed_at is older than any other
    return chunks.select(F.col("chunk_seq").cast("bigint").alias("seq"), _key("record_id"), _key("chunk_type"), F.coalesce("part", F.lit(0)).cast("int").alias("part"), F.coalesce("parsed_at", F.lit("0001-01-01").cast("timestamp_ntz")).cast("timestamp_ntz").alias("parsed_at"), *extra)


def settled(chunks: DataFrame, store_rows: DataFrame, load_flushes: DataFrame) -> DataFrame:
    """The processed intervals of chunk_seq that the store itself proves.

    A delivery needs no work if a later version of its chunk was delivered, or if the latest committed
    entry of its chunk has its hash. Hashes are computed once and only hashes travel, never texts.
    """
    current = _deliveries(chunks).groupBy(*KEY).agg(F.max("parsed_at").alias("current_at"))
    durable = durable_entries(store_rows, load_flushes)
    state = current.join(durable, KEY, "left")
    rows = _deliveries(chunks, text_hash(F.col("text"), F.col("return_text")).alias("hash"))
    done = rows.join(state, KEY).where((F.col("parsed_at") < F.col("current_at")) | (F.col("hash") == F.col("stored_hash")))
    return intervals(done, "seq")


def pending_chunks(chunks: DataFrame, store_rows: DataFrame, load_flushes: DataFrame, ledger: IntervalLedger | None = None) -> DataFrame:
    """The chunks (record_id, chunk_type, part) that the next load must embed and store.

    The ledger is brought up to date by what the store has durably kept, numbers of lost flushes going back
    to the gaps, and what comes out are the rows in its gaps. Without a ledger one is made for this call.

    Nulls: part counts as 0, null record_id or chunk_type is a key like another, null text as empty.
    Repeated and late deliveries, and rows repeated whole, give one row. Empty tables give no row.
    """
    spark = chunks.sparkSession
    ledger = ledger or IntervalLedger(spark, scratch(spark, "ledger"))
    ledger.settle(settled(chunks, store_rows, load_flushes))
    gaps = ledger.gaps(intervals(chunks, "chunk_seq"))
    return rows_in(_deliveries(chunks).drop("parsed_at"), "seq", gaps).select(*KEY).distinct().select(F.nullif("record_id", F.lit(_NULL)).alias("record_id"), F.nullif("chunk_type", F.lit(_NULL)).alias("chunk_type"), "part")
