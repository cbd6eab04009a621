"""Mixing sources to target shares of all tokens, with a cap on how often a document is repeated.

Method: capped water-filling. Each source gets its share of the total; a source that would need more
epochs than its cap is clamped there, and what it can't give is spread over the others in proportion
to their shares, again until nothing is above its cap. A source of e epochs gives every document
floor(e) times and a seeded part of them once more: documents in the order of a seeded hash, up to the
fraction's tokens (the document at the edge counts if at least half of it is within). Long documents, of more than
1 / ``FINE`` of the fraction's tokens, come first, up to the fraction of their own tokens, and the others fill up
what is left, so that the edge is a short document wherever there are any.

The size of the mix is a parameter. By default it is the largest at which no cap keeps a source that has
tokens from its exact share; a larger mix is as near to the shares as the caps permit.

Scale: the token counts are written once and used twice. The prefix sums are taken over hash buckets of a
source, then within a bucket; there are as many buckets as keep one near ``BUCKET`` documents, so a source
with a third of all rows is many small sorts. Only one row per listed source comes to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.llm import bpe
from cairn.runtime import materialise, spread

SEED = 20_240_517
#: Documents that a bucket holds about: what one sort sees.
BUCKET = 50_000
#: A document above the fraction's tokens divided by this is long.
FINE = 500
#: The most sources that the target table may list: what the driver holds. More are an error.
MAX_SOURCES = 100_000


def water_fill(sources: dict[str, tuple[float, float, float]], total: float) -> dict[str, float]:
    """{source: (share, tokens, max_repeats)} -> {source: epochs}, the tokens summing to ``total`` if the caps permit.

    Sources without share, tokens or repeats get 0 epochs; their share is spread like any excess.
    """
    epochs = {s: 0.0 for s in sources}
    active = {s for s, (share, tokens, cap) in sources.items() if share > 0 and tokens > 0 and cap > 0}
    left = total
    while active:
        weight = math.fsum(sources[s][0] for s in active)
        clamped = {s for s in active if left * sources[s][0] / weight >= sources[s][1] * sources[s][2] * (1 - 1e-12)}
        if not clamped:
            for s in active:
                epochs[s] = left * sources[s][0] / weight / sources[s][1]
            break
        for s in clamped:
            epochs[s] = float(sources[s][2])
            left -= sources[s][1] * sources[s][2]
        active -= clamped
    return epochs


def exact_total(sources: dict[str, tuple[float, float, float]]) -> float:
    """The most tokens of a mix in which each source that has tokens keeps its share of them within its cap."""
    able = [(share, tokens * cap) for share, tokens, cap in sources.values() if share > 0 and tokens > 0 and cap > 0]
    weight = math.fsum(share for share, _ in able)
    return min((most * weight / share for share, most in able), default=0.0)


def listed_sources(targets: DataFrame) -> DataFrame:
    """The distinct non-null sources of the target table; more than MAX_SOURCES are an error."""
    sources = targets.where("source is not null").select("source").distinct()
    if sources.limit(MAX_SOURCES + 1).count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources are listed")
    return sources


def plan_mix(sized: DataFrame, targets: DataFrame, total_tokens: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, available_tokens, epochs): one row per listed source.

    total_tokens is the size of the mix; without it, the largest with exact shares. Null shares count
    as 0, null caps as 1, shares are scaled to sum 1; a null source is none.
    """
    listed_sources(targets)
    available = sized.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"))
    wanted = targets.where("source is not null").groupBy("source").agg(F.max(F.coalesce(F.col("target_share").cast("double"), F.lit(0.0))).alias("target_share"), F.max(F.coalesce("max_repeats", F.lit(1))).cast("int").alias("max_repeats"))
    rows = wanted.join(available, "source", "left").select("source", "target_share", "max_repeats", F.coalesce("available_tokens", F.lit(0)).cast("bigint").alias("available_tokens")).collect()
    sources = {r.source: (max(0.0, r.target_share), r.available_tokens, max(0, r.max_repeats)) for r in rows}
    epochs = water_fill(sources, float(exact_total(sources) if total_tokens is None else total_tokens))
    data = [(r.source, r.target_share, r.max_repeats, r.available_tokens, epochs[r.source]) for r in sorted(rows, key=lambda r: r.source)]
    return sized.sparkSession.createDataFrame(data, "source string, target_share double, max_repeats int, available_tokens bigint, epochs double")


def mix(docs: DataFrame, targets: DataFrame, total_tokens: float | None = None, seed: int = SEED, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(the mix: doc_id, source, n_tokens, repeats; the report: one row per listed source).

    The mix has the documents with at least one repeat. Documents of unlisted and null sources are
    never in it; null and empty texts have 0 tokens and follow their source. Rows repeated whole are
    separate documents. The report has target_share, the share the mix really has, and the plan.
    """
    sized = spread(docs.select("doc_id", "source", "text")).join(F.broadcast(listed_sources(targets)), "source", "left_semi")
    sized = materialise(bpe.count_tokens(sized, ["doc_id", "source"], path=path), "tokens")
    plan = plan_mix(sized, targets, total_tokens)
    buckets = max(1, math.ceil(sized.count() / BUCKET))
    fraction = F.col("epochs") - F.floor("epochs")
    goal = plan.select("source", F.floor("epochs").cast("int").alias("whole"), fraction.alias("fraction"), (fraction * F.col("available_tokens")).alias("part"))
    # buckets are ranges of the hash, so the order of the documents is the same with any number of them
    h = sized.withColumn("h", F.xxhash64(F.lit(seed), F.col("doc_id"))).withColumn("bucket", F.floor((F.col("h").cast("double") / 2.0**64 + 0.5) * buckets).cast("bigint"))
    h = h.join(F.broadcast(goal), "source").withColumn("long", F.col("n_tokens") * FINE > F.col("part"))
    sums = h.groupBy("source", "long", "bucket").agg(F.sum("n_tokens").alias("t"))
    before = Window.partitionBy("source", "long").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("source", "long", "bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("before"), F.sum("t").over(Window.partitionBy("source", "long")).alias("kind_tokens"))
    inside = Window.partitionBy("source", "long", "bucket").orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = h.join(starts, ["source", "long", "bucket"]).withColumn("middle", F.col("before") + F.sum("n_tokens").over(inside) - F.col("n_tokens") / 2)
    first = F.col("long") & (F.col("middle") <= F.col("fraction") * F.col("kind_tokens"))
    # a row per listed source: what the long documents take
    taken = goal.select("source").join(placed.where(first).groupBy("source").agg(F.sum("n_tokens").alias("taken")), "source", "left").fillna(0, ["taken"])
    once_more = first | (~F.col("long") & (F.col("middle") <= F.col("part") - F.col("taken")))
    counted = placed.join(F.broadcast(taken), "source").select("doc_id", "source", "n_tokens", (F.col("whole") + F.when((F.col("part") > 0) & once_more, 1).otherwise(0)).cast("int").alias("repeats"))
    mixed = materialise(counted.where("repeats > 0"), "mix")
    real = mixed.groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("mixed_tokens"), F.max("repeats").alias("most_repeats"))
    report = plan.join(real, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    report = report.withColumn("whole", F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0))))  # a row per listed source
    return mixed, report.select("source", "target_share", F.when(F.col("whole") > 0, F.col("mixed_tokens") / F.col("whole")).otherwise(0.0).alias("actual_share"), "available_tokens", "mixed_tokens", "epochs", "max_repeats", F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"))
