import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cairn.operators import incremental as inc

CHUNKS = "chunk_seq bigint, record_id string, chunk_type string, part int, text string, return_text string, parsed_at timestamp_ntz"
STORE = "entry_id bigint, id string, record_id string, chunk_type string, text_hash string, flush_id bigint, written_at timestamp_ntz"
FLUSHES = "flush_id bigint, committed_at timestamp_ntz"


def frame(spark, numbers):
    return spark.createDataFrame([(n,) for n in numbers], "n bigint")


def covered(df):
    out = []
    for r in df.collect():
        assert r.lo <= r.hi and r.lo // inc.BLOCK == r.hi // inc.BLOCK == r.block
        out += range(r.lo, r.hi + 1)
    assert len(out) == len(set(out)), "intervals overlap"
    return sorted(out)


@pytest.mark.parametrize("numbers", [[], [5], [1, 2, 3, 3, 7, None, 9], [inc.BLOCK - 1, inc.BLOCK, inc.BLOCK + 1], [-3, -2, 0, 1]])
def test_intervals_are_the_numbers(spark, numbers):
    df = inc.intervals(frame(spark, numbers), "n")
    assert covered(df) == sorted({n for n in numbers if n is not None})


def test_intervals_are_maximal(spark):
    assert sorted((r.lo, r.hi) for r in inc.intervals(frame(spark, [1, 2, 3, 5, 6, 9]), "n").collect()) == [(1, 3), (5, 6), (9, 9)]


def test_subtract_merge_and_rows_against_sets(spark):
    rng = random.Random(7)
    for _ in range(4):
        a = {rng.randrange(0, 90) + rng.choice([0, inc.BLOCK - 40]) for _ in range(70)}
        b = {rng.randrange(0, 90) + rng.choice([0, inc.BLOCK - 40]) for _ in range(50)}
        ia, ib = inc.intervals(frame(spark, a), "n"), inc.intervals(frame(spark, b), "n")
        assert covered(inc.subtract(ia, ib)) == sorted(a - b)
        assert covered(inc.merge(ia, ib)) == sorted(a | b)
        rows = frame(spark, [*a, *a, None]).withColumn("lo", F.lit("clash"))
        got = [r.n for r in inc.rows_in(rows, "n", inc.subtract(ia, ib)).collect()]
        assert sorted(got) == sorted([*(a - b)] * 2)


def test_ledger_survives_failures_and_late_numbers(spark, tmp_path):
    ledger = inc.IntervalLedger(spark, f"file://{tmp_path}/ledger")
    keep = lambda df: df
    assert covered(ledger.processed()) == []
    assert ledger.run(frame(spark, [1, 2, 5]), "n", keep) == 1

    def die():
        raise KeyError("lost")

    with pytest.raises(KeyError):
        ledger.run(frame(spark, [1, 2, 3, 5, 8]), "n", keep, before_commit=die)
    assert ledger.version() == 1
    assert ledger.run(frame(spark, [1, 2, 3, 5, 8]), "n", keep) == 2  # 3 is late
    assert ledger.run(frame(spark, [1, 2, 3, 4, 5, 8]), "n", keep) == 3
    assert sorted(r.n for r in ledger.output("n bigint").collect()) == [1, 2, 3, 4, 5, 8]
    assert ledger.vacuum() > 0
    assert sorted(r.n for r in ledger.output("n bigint").collect()) == [1, 2, 3, 4, 5, 8]
    assert covered(ledger.processed()) == [1, 2, 3, 4, 5, 8]


def test_two_writers_cannot_both_commit(spark, tmp_path):
    a = inc.IntervalLedger(spark, f"file://{tmp_path}/l")
    b = inc.IntervalLedger(spark, f"file://{tmp_path}/l")
    with pytest.raises(inc.Conflict):
        a.run(frame(spark, [1, 2]), "n", lambda df: df, before_commit=lambda: b.run(frame(spark, [1, 2]), "n", lambda df: df))
    assert len(a.output("n bigint").collect()) == 2


def at(n):
    return dt.datetime(2025, 1, n)


def pending(spark, chunks, store, flushes):
    out = inc.pending_chunks(spark.createDataFrame(chunks, CHUNKS), spark.createDataFrame(store, STORE), spark.createDataFrame(flushes, FLUSHES))
    return sorted((r.record_id or "", r.chunk_type or "", r.part) for r in out.collect())


def digest(text, ret=None):
    import hashlib

    return hashlib.sha256(((text or "") + "\0" + (ret or "")).encode()).hexdigest()


def test_pending_chunks_cases(spark):
    flushes = [(1, at(1)), (2, None), (3, at(9))]
    chunks = [
        (1, "a::b", "doc", None, "x", None, at(1)),  # stored, unchanged, null part
        (2, "n", "doc", 0, "x", "", at(1)),  # new
        (3, "c", "doc", 1, "old", None, at(1)),  # an old version is stored
        (4, "c", "doc", 1, "new", None, at(2)),
        (5, "c", "doc", 1, "new", None, at(2)),  # delivered again
        (6, "l", "doc", 0, "x", None, at(1)),  # only in a lost flush
        (7, "h", "doc", 0, "x", None, at(1)),  # latest entry without hash
        (8, "r", "doc", 0, "x", None, at(3)),  # latest of two entries has it
        (9, None, None, None, None, None, None),  # nulls everywhere
        (10, "z", "doc", 0, "stale", None, at(5)),  # late delivery of an old version follows
        (11, "z", "doc", 0, "older", None, at(4)),
    ]
    store = [
        (1, "a::b::doc", "a::b", "doc", digest("x"), 1, at(2)),
        (2, "c::doc::1", "c", "doc", digest("old"), 1, at(2)),
        (3, "l::doc", "l", "doc", digest("x"), 2, at(2)),
        (4, "h::doc", "h", "doc", digest("x"), 1, at(2)),
        (5, "h::doc", "h", "doc", None, 3, at(3)),
        (6, "r::doc", "r", "doc", "0", 1, at(2)),
        (7, "r::doc", "r", "doc", digest("x"), 3, at(4)),
        (8, "z::doc", "z", "doc", digest("stale"), 3, at(4)),
        (9, "gone::doc", "gone", "doc", digest("x"), 3, at(4)),
        (10, None, None, None, None, None, None),
    ]
    assert pending(spark, chunks, store, flushes) == [("", "", 0), ("c", "doc", 1), ("h", "doc", 0), ("l", "doc", 0), ("n", "doc", 0)]
    assert pending(spark, chunks * 2, store * 2, flushes * 2) == pending(spark, chunks, store, flushes)


def test_pending_chunks_of_empty_tables(spark):
    assert pending(spark, [], [], []) == []
    assert pending(spark, [(1, "a", "doc", 0, "x", None, at(1))], [], []) == [("a", "doc", 0)]


def test_a_hot_key_stays_in_small_groups(spark):
    rows = [(i, "hot", "doc", 0, f"v{i}", None, at(1) + dt.timedelta(seconds=i)) for i in range(3000)]
    assert pending(spark, rows, [(1, "hot::doc", "hot", "doc", digest("v2999"), 1, at(2))], [(1, at(1))]) == []


def test_lost_numbers_are_gaps_again_and_the_log_is_summed_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(inc.IntervalLedger, "CHECKPOINT", 3)
    ledger = inc.IntervalLedger(spark, f"file://{tmp_path}/l")
    for n in range(1, 6):
        assert ledger.run(frame(spark, range(n)), "n", lambda df: df) == n
    assert [s.name for s in (tmp_path / "l" / "checkpoints").glob("[0-9]*")] == ["000000003.json"]
    assert sorted(r.n for r in ledger.output("n bigint").collect()) == [0, 1, 2, 3, 4]
    assert sorted(r.n for r in ledger.output("n bigint", since=3).collect()) == [3, 4]
    assert ledger.settle(inc.intervals(frame(spark, [0, 1, 4]), "n")) == 6
    assert covered(ledger.gaps(inc.intervals(frame(spark, range(7)), "n"))) == [2, 3, 5, 6]


def test_a_second_run_reads_only_the_blocks_of_its_gaps(spark, tmp_path, monkeypatch):
    source = f"file://{tmp_path}/source"
    spark.range(6 * inc.BLOCK).selectExpr("id as n", "repeat('t', 20) as text").repartitionByRange(6, "n").write.parquet(source)
    rows = spark.read.parquet(source)
    ledger = inc.IntervalLedger(spark, f"file://{tmp_path}/l")
    ledger.settle(inc.intervals(rows.where(f"n < {4 * inc.BLOCK} and n <> 70000"), "n"))
    gaps = ledger.gaps(inc.intervals(rows.where(f"n < {4 * inc.BLOCK}"), "n"))
    near = inc.rows_near(rows, "n", gaps)
    assert near.count() == 1 and "GreaterThanOrEqual(n,70000)" in near._jdf.queryExecution().executedPlan().toString()
    assert [r.n for r in inc.rows_in(rows, "n", gaps).collect()] == [70000]
    gaps = ledger.gaps(inc.intervals(rows.where(f"n < {5 * inc.BLOCK + 7}"), "n"))
    for most in (100_000, 0):
        monkeypatch.setattr(inc, "BROADCAST_BLOCKS", most)
        assert inc.rows_near(rows.where("n % 2 = 0 or n > 9"), "n", gaps).count() == (3 * inc.BLOCK - 70000) + inc.BLOCK + 7
        assert inc.rows_in(rows, "n", gaps).count() == 1 + inc.BLOCK + 7


def test_pending_chunks_from_a_ledger_kept_between_loads(spark, tmp_path):
    ledger = inc.IntervalLedger(spark, f"file://{tmp_path}/l")
    df = lambda rows, schema: spark.createDataFrame(rows, schema)
    chunks = [(n, f"r{n}", "doc", 0, f"t{n}", None, at(1)) for n in range(5)]
    stored = [(n, f"r{n}::doc", f"r{n}", "doc", digest(f"t{n}"), 1, at(2)) for n in range(5)]
    left = lambda c, s, f: sorted(r.record_id for r in inc.pending_chunks(df(c, CHUNKS), df(s, STORE), df(f, FLUSHES), ledger).collect())
    assert left(chunks, [], []) == [f"r{n}" for n in range(5)]
    assert left(chunks, stored, [(1, at(3))]) == [] and covered(ledger.processed()) == [0, 1, 2, 3, 4]
    # the flush turns out to be lost: its numbers are gaps again
    assert left(chunks, stored, [(1, None)]) == [f"r{n}" for n in range(5)] and ledger.version() == 3
    assert left([*chunks, (9, "r0", "doc", 0, "new", None, at(4))], stored, [(1, at(3))]) == ["r0"]
