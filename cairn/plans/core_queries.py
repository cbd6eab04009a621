"""Queries of the core problem operators, with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.operators import incremental as inc
from cairn.runtime import scratch


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inc.pending_chunks(*(table(spark, sf_dir, t) for t in ("chunks", "store_rows", "load_flushes")))


def p1_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed intervals as the store proves them before the next load."""
    return inc.settled(*(table(spark, sf_dir, t) for t in ("chunks", "store_rows", "load_flushes"))).select("block", "lo", "hi")


def p1_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All deliveries through the ledger in three runs by arrival, of which the second dies before its commit.

    Low sequence numbers that arrive late are picked up by the run after; each delivery comes out once.
    """
    rows = table(spark, sf_dir, "chunks")
    ledger = inc.IntervalLedger(spark, scratch(spark, "replay"))
    keep = lambda df: df.withColumn("part", F.coalesce("part", F.lit(0)))

    def die() -> None:
        raise InterruptedError

    ledger.run(rows.where("arrived_at < timestamp_ntz'2025-04-01'"), "chunk_seq", keep)
    try:
        ledger.run(rows.where("arrived_at < timestamp_ntz'2025-06-01'"), "chunk_seq", keep, before_commit=die)
    except InterruptedError:
        pass
    ledger.run(rows.where("arrived_at < timestamp_ntz'2025-06-01'"), "chunk_seq", keep)
    ledger.run(rows, "chunk_seq", keep)
    return ledger.output(keep(rows).schema).select("chunk_seq", "record_id", "chunk_type", "part", F.md5(F.coalesce("text", F.lit("-"))).alias("text_md5"), F.md5(F.coalesce("return_text", F.lit("-"))).alias("return_md5"), "parsed_at")


_STATE = """
  with d as (select chunk_seq, record_id, chunk_type, coalesce(part, 0) as part, parsed_at,
      sha256(coalesce(text, '') || chr(0) || coalesce(return_text, '')) as h from chunks),
  c as (select record_id, chunk_type, part, max(parsed_at) as current_at from d group by all),
  s as (select s.record_id, s.chunk_type,
      coalesce(try_cast(nullif(substr(s.id, length(s.record_id) + length(s.chunk_type) + 5), '') as int), 0) as part,
      arg_max(coalesce(s.text_hash, 'none'), (s.written_at, s.entry_id)) as stored
    from store_rows s where s.flush_id in (select flush_id from load_flushes where committed_at is not null) group by all),
  f as (select d.*, d.parsed_at < c.current_at or coalesce(s.stored = d.h, false) as done
    from d join c using (record_id, chunk_type, part) left join s using (record_id, chunk_type, part))
"""

QUERIES = {"p1_found": p1_found, "p1_intervals": p1_intervals, "p1_replay": p1_replay}

SQL = {
    "p1_found": _STATE + "select distinct record_id, chunk_type, part from f where not done",
    "p1_intervals": _STATE
    + f""", n as (select distinct chunk_seq as n, chunk_seq // {inc.BLOCK} as block from f where done),
  i as (select *, n - row_number() over (partition by block order by n) as run from n)
  select block, min(n) as lo, max(n) as hi from i group by block, run""",
    "p1_replay": "select chunk_seq, record_id, chunk_type, coalesce(part, 0) as part, md5(coalesce(text, '-')) as text_md5, md5(coalesce(return_text, '-')) as return_md5, parsed_at from chunks",
}
