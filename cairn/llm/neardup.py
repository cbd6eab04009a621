"""Near-duplicate records by the exact Jaccard similarity of their word shingles.

Method: size-banded tiles with hashed bitmap signatures. The shingles of a record are ordered by a fixed
order, frequent ones last, and of any two records above the threshold the first shingles (prefixes) have
one in common. So a tile is one prefix shingle; it is cut by bands of sizes, a band and the next larger one
being all that the threshold lets match. A pair of a tile must pass the bounds by size and by position,
then the bits that one bitmap signature has and the other lacks bound the overlap from above, and only
pairs that pass get the exact intersection of their sorted arrays.

Any fixed order loses no pair, so none needs the count of every shingle: a sketch of ``WIDTH`` counters, whatever
the size of the data, tells which shingles are frequent. Only prefixes (at 0.7 about 30 % of the shingles) are
exploded. A record is a class with its exact copies; a task emits the prefix of a class once.

Scale: members of tiles that the sketch can't prove small are counted with partial aggregation; tiles of more than ``SLOT`` members are split by
band and into slots before their rows are shuffled, so a hot shingle is many tasks. Arrays of shingles travel
only for classes that are in a pair, which a bitmap of fixed size picks out in the scan. Classes of copies are
expanded into pairs only at the end, by joins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cairn.runtime import discard, materialise, spread

WORDS = 4
MIN_WORDS = 30
THRESHOLD = 0.7
#: Bits of a signature, a multiple of 64.
BITS = 512
#: Members of a tile that one slot holds.
SLOT = 512
#: Counters of the sketch that tells frequent shingles, and the counts that a task leaves out.
WIDTH, LOCAL = 1 << 20, 4
#: Parts of a lookup of hot tiles, and the most rows of them that a broadcast carries.
SALTS, BROADCAST_ROWS = 16, 200_000
#: Classes that a task remembers to have emitted (it saves work only).
REMEMBERED = 2_000_000
#: Bits of the bitmap that picks out the classes to compare.
BLOOM = 1 << 23
#: Copies of a class that one slot holds when pairs are expanded.
COPIES = 1024

_WORD = re.compile(r"[A-Za-z0-9_]+")
_MULT = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def shingle_hashes(code: str, words: int = WORDS) -> tuple[int, np.ndarray]:
    """The number of words of a code and the sorted distinct 64-bit hashes of its runs of ``words`` words."""
    found = _WORD.findall(code)
    if len(found) < words:
        return len(found), np.empty(0, np.int64)
    with np.errstate(over="ignore"):
        w = np.fromiter(map(_HASHES.__getitem__, found), np.uint64, len(found))
        n = len(w) - words + 1
        h = w[:n].copy()
        for k in range(1, words):
            h = (h ^ (h >> np.uint64(29))) * _MULT[k % 3] + w[k : n + k]
        h = (h ^ (h >> np.uint64(32))) * _MULT[0]
        h ^= h >> np.uint64(29)
    return len(found), np.unique(h.view(np.int64))


def bitmap(hashes: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The signature: bit (hash mod bits) for every shingle, as bits/64 signed longs."""
    out = np.zeros(bits // 64, np.uint64)
    at = (hashes.view(np.uint64) % np.uint64(bits)).astype(np.int64)
    np.bitwise_or.at(out, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
    return out.view(np.int64)


def _offsets(sizes: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, prints, keys, arrays, keep = b.column(0).to_pylist(), [], [], [], []
        for i, code in zip(ids, b.column(1).to_pylist()):
            if code is None:
                continue
            n, h = shingle_hashes(code)
            if n >= MIN_WORDS and len(h):
                keep.append(i)
                arrays.append(h)
                digest = xxhash.xxh3_128_digest(h.tobytes())
                prints.append(digest)
                keys.append(int.from_bytes(digest[:8], "big", signed=True))
        sizes = np.fromiter(map(len, arrays), np.int32, len(arrays))
        flat = pa.array(np.concatenate(arrays) if arrays else np.empty(0, np.int64))
        sigs = np.concatenate([bitmap(h) for h in arrays]) if arrays else np.empty(0, np.int64)
        wide = _offsets(np.full(len(arrays), BITS // 64))
        columns = [pa.array(keep, pa.int64()), pa.array(prints, pa.binary()), pa.array(keys, pa.int64()), pa.array(sizes, pa.int32()), pa.ListArray.from_arrays(_offsets(sizes), flat), pa.ListArray.from_arrays(wide, pa.array(sigs))]
        yield pa.record_batch(columns, names=["rec_id", "print", "key", "n", "h", "sig"])


def shingle_sets(records: DataFrame, id_col: str = "rec_id", text_col: str = "code") -> DataFrame:
    """(rec_id, print, key, n, h, sig) of each record with at least MIN_WORDS words; null and short texts have none.

    print is 128 bits of the sorted shingles h, key its first 64.
    """
    long = records.select(F.col(id_col).cast("bigint").alias("rec_id"), F.col(text_col).alias("code")).where(F.length("code") >= 2 * MIN_WORDS - 1)
    return spread(long).mapInArrow(_sets, "rec_id bigint, print binary, key bigint, n int, h array<bigint>, sig array<bigint>")


def _need(a: Column, b: Column, t: float) -> Column:
    """The least overlap that sizes a and b must have at similarity t."""
    return F.ceil((a + b) * F.lit(t / (1 + t)) - F.lit(1e-9))


def _cells(h: np.ndarray, width: int) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(64 - width.bit_length() + 1)).astype(np.int64)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and where each list begins in them (and the last ends)."""
    at = column.offsets.to_numpy()
    return column.flatten().to_numpy(), at - at[0] if len(at) else at


def _slices(b: pa.RecordBatch, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in parts of about ``most`` shingles, so that what numpy holds at once is bounded but for a single longer record."""
    at, begin = b.column("h").offsets.to_numpy(), 0
    while begin < b.num_rows:
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + most, "right")) - 1)
        yield b.slice(begin, end - begin)
        begin = end


def frequent_cells(sets: DataFrame, width: int = WIDTH) -> tuple[np.ndarray, int]:
    """(a counter for each of ``width`` (a power of two) ranges of hashes, by how much it may be too low): how many records have a shingle there.

    A task leaves out counters below LOCAL. The result has a fixed size.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for b in batches:
            total += np.bincount(_cells(_flat(b.column("h"))[0], width), minlength=width)
        at = np.flatnonzero(total >= LOCAL)
        # the row of cell -1 counts the tasks
        yield pa.record_batch([pa.array(np.append(at, -1)), pa.array(np.append(total[at], 1))], names=["cell", "c"])

    found = sets.select("h").mapInArrow(count, "cell bigint, c bigint").groupBy("cell").agg(F.sum("c").alias("c")).toArrow()  # at most ``width`` rows
    cell, c = found.column("cell").to_numpy(), found.column("c").to_numpy()
    out = np.zeros(width, np.int64)
    out[cell[cell >= 0]] = c[cell >= 0]
    return out, (LOCAL - 1) * int(c[cell < 0].sum())


def prefix_rows(sets: DataFrame, t: float, slot: int = SLOT) -> DataFrame:
    """(token, key, n, k, hot): of each class the shingles of its prefix with their places in it; copies that one task sees give one.

    hot is false only where the sketch proves that at most ``slot`` records have the shingle.
    """
    spark = sets.sparkSession
    cells, low_by = frequent_cells(sets)
    order = spark.sparkContext.broadcast(np.minimum(cells, np.iinfo(np.int32).max).astype(np.int32))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, seen = order.value, set()
        for b in chain.from_iterable(map(_slices, batches)):
            keys, (h, at) = b.column("key").to_numpy(), _flat(b.column("h"))
            fresh = np.fromiter((k not in seen and not seen.add(k) for k in keys.tolist()), bool, len(keys))
            if len(seen) > REMEMBERED:
                seen.clear()
            n = np.diff(at)
            row = np.repeat(np.arange(len(n)), n)
            by = np.lexsort((h, counts[_cells(h, len(counts))], row))
            place = np.arange(len(h)) - np.repeat(at[:-1], n)
            keep = (place < np.repeat(n - np.ceil(n * t - 1e-9) + 1, n)) & np.repeat(fresh, n)
            row = row[keep]
            token = h[by][keep]
            hot = counts[_cells(token, len(counts))] > slot - low_by
            yield pa.record_batch([pa.array(token), pa.array(keys[row]), pa.array(n[row].astype(np.int32)), pa.array(place[keep].astype(np.int32)), pa.array(hot)], names=["token", "key", "n", "k", "hot"])

    return sets.select("key", "h").mapInArrow(prefixes, "token bigint, key bigint, n int, k int, hot boolean")


def _band(n: Column, t: float) -> Column:
    """The band of a size: two sizes that match are in one band or in neighbouring ones."""
    return F.floor(F.log(n.cast("double")) / F.lit(-math.log(t)) + F.lit(1e-9)).cast("int")


def _checked(small: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """small, broadcast if it has at most ``most`` rows (it is a written table, so counting reads only footers)."""
    return F.broadcast(small) if small.count() <= most else small


def tiles(rows: DataFrame, t: float, slot: int = SLOT) -> DataFrame:
    """(token, band, slot, key, n, k): prefix rows in the tiles where they are found (k is odd) or look for others; k // 2 is the place."""
    members = rows.where("hot").groupBy("token").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > slot)
    hot = _checked(materialise(members.select("token", F.ceil(F.col("members") / slot).cast("int").alias("slots")), "hot"))
    # a hot tile is cut by band and into slots: a row is looked for in its own slot, and looks in all slots of its own and of the next smaller band.
    # the lookup is salted, for where it isn't a broadcast
    salted = rows.withColumn("salt", F.pmod(F.hash("key"), F.lit(SALTS)))
    placed = salted.join(hot.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["token", "salt"], "left").withColumn("band", _band(F.col("n"), t))
    own = F.pmod(F.xxhash64("key"), F.col("slots")).cast("int")
    everywhere = F.transform(F.sequence(F.lit(0), F.col("slots") - 1), lambda s: F.struct(F.col("band").alias("band"), s.alias("slot"), (s == own).alias("there")))
    below = F.transform(F.sequence(F.lit(0), F.col("slots") - 1), lambda s: F.struct((F.col("band") - 1).alias("band"), s.alias("slot"), F.lit(False).alias("there")))
    cold = F.array(F.struct(F.lit(-1).alias("band"), F.lit(0).alias("slot"), F.lit(True).alias("there")))
    tiled = placed.select("token", "key", "n", "k", F.explode(F.when(F.col("slots").isNull(), cold).otherwise(F.concat(everywhere, below))).alias("at"))
    # of a pair the smaller one is found by a shorter prefix
    short = F.col("n") - F.ceil(F.col("n") * F.lit(2 * t / (1 + t)) - F.lit(1e-9)) + 1
    tiled = tiled.select("token", "key", "n", "at.band", "at.slot", (F.col("k") * 2 + (F.col("at.there") & (F.col("k") < short)).cast("int")).alias("k"))
    return tiled


def candidate_pairs(rows: DataFrame, t: float, slot: int = SLOT) -> DataFrame:
    """(a, b): pairs of keys whose prefix rows share a tile and pass the bounds by size and position."""
    tiled = tiles(rows, t, slot)
    # one shuffle serves both sides, so they have the same columns (k: the place, and in the lowest bit whether the row is found here)
    # and what holds for one side alone is asked in the join; two tasks may have emitted one class
    tiled = tiled.repartition("token", "band", "slot")
    left = tiled.select("token", "band", "slot", F.col("key").alias("a"), F.col("n").alias("na"), F.col("k").alias("ka"))
    right = tiled.select("token", "band", "slot", F.col("key").alias("b"), F.col("n").alias("nb"), F.col("k").alias("kb"))
    first = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))
    # what can still be shared if this is the first shingle that they share
    rest = F.when(F.col("ka") % 2 == 1, F.least(F.col("na") - F.shiftright("ka", 1), F.col("nb") - F.shiftright("kb", 1))).otherwise(-1)
    met = left.join(right, ["token", "band", "slot"]).where(first & (F.col("na") >= F.col("nb") * F.lit(t) - F.lit(1e-9)) & (rest >= _need(F.col("na"), F.col("nb"), t)))
    return met.select("a", "b").distinct()


def _bounded(pairs: DataFrame, classes: DataFrame, t: float) -> DataFrame:
    """(a, b) as class ids: the pairs of keys whose bitmaps don't rule the similarity out."""
    side = lambda x: classes.select(F.col("key").alias(f"k{x}"), F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("sig").alias(f"s{x}"))
    full = pairs.toDF("ka", "kb").join(side("a"), "ka").join(side("b"), "kb")
    lacks = lambda x, y: sum((F.bit_count(F.col(x)[k].bitwiseAND(F.bitwise_not(F.col(y)[k]))) for k in range(BITS // 64)), F.lit(0))
    need = _need(F.col("na"), F.col("nb"), t)
    kept = full.where((F.col("na") - lacks("sa", "sb") >= need) & (F.col("nb") - lacks("sb", "sa") >= need))
    return kept.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _overlap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ha, hb = b.column("ha"), b.column("hb")
        va, vb, oa, ob = ha.flatten().to_numpy(), hb.flatten().to_numpy(), ha.offsets.to_numpy(), hb.offsets.to_numpy()
        oa, ob = oa - oa[0] if len(oa) else oa, ob - ob[0] if len(ob) else ob
        both = [len(np.intersect1d(va[oa[i] : oa[i + 1]], vb[ob[i] : ob[i + 1]], assume_unique=True)) for i in range(b.num_rows)]
        yield pa.record_batch([b.column("a"), b.column("b"), b.column("na"), b.column("nb"), pa.array(both, pa.int32())], names=["a", "b", "na", "nb", "overlap"])


def _arrays_of(wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """(cid, n, h) of the wanted ids: a bitmap of fixed size, with no false negatives, thins the scan before the join."""
    spots = wanted.select(F.pmod(F.xxhash64("cid"), F.lit(BLOOM)).alias("spot"))
    bits = F.broadcast(spots.groupBy(F.bitmap_bucket_number(F.col("spot")).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("spot"))).alias("bits")))
    rows = sets.select(F.col("rec_id").alias("cid"), "n", "h").withColumn("spot", F.pmod(F.xxhash64("cid"), F.lit(BLOOM)))
    there = F.expr("shiftright(cast(conv(hex(substring(bits, cast(bitmap_bit_position(spot) div 8 as int) + 1, 1)), 16, 10) as int), cast(bitmap_bit_position(spot) % 8 as int)) & 1")
    thin = rows.withColumn("bucket", F.bitmap_bucket_number(F.col("spot"))).join(bits, "bucket").where(there == 1).select("cid", "n", "h")
    return thin.join(wanted, "cid", "left_semi").dropDuplicates(["cid"])


def similar_classes(sets: DataFrame, classes: DataFrame, t: float, slot: int = SLOT) -> DataFrame:
    """(a, b, similarity): all pairs of classes with Jaccard similarity of at least t, a < b."""
    rows = materialise(prefix_rows(sets, t, slot), "prefixes")
    pairs = materialise(_bounded(candidate_pairs(rows, t, slot), classes, t), "pairs")
    discard(rows)
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cid")).distinct()
    side = _arrays_of(wanted, sets)
    full = pairs.join(side.toDF("a", "na", "ha"), "a").join(side.toDF("b", "nb", "hb"), "b").select("a", "b", "na", "nb", "ha", "hb")
    exact = full.mapInArrow(_overlap, "a bigint, b bigint, na int, nb int, overlap int")
    union = F.col("na") + F.col("nb") - F.col("overlap")
    return exact.where(F.col("overlap") >= F.lit(t) * union - F.lit(1e-9)).select("a", "b", (F.col("overlap") / union).alias("similarity"))


def classes_of(records: DataFrame, id_col: str = "rec_id", text_col: str = "code") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sets, members: rec_id, cid; classes: cid, key, n, sig). Records with equal shingle sets are one class, cid its least rec_id."""
    sets = materialise(shingle_sets(records, id_col, text_col), "shingles")
    least = sets.groupBy("print").agg(F.min("rec_id").alias("cid"))
    members = materialise(sets.select("rec_id", "print").distinct().join(least, "print").select("rec_id", "cid"), "members")
    classes = sets.select("rec_id", "key", "n", "sig").join(members.where("rec_id = cid"), "rec_id", "left_semi").withColumnRenamed("rec_id", "cid").dropDuplicates(["cid"])
    return sets, members, classes


def near_duplicate_pairs(records: DataFrame, id_col: str = "rec_id", text_col: str = "code", t: float = THRESHOLD, slot: int = SLOT) -> DataFrame:
    """(rec_id_a, rec_id_b), rec_id_a < rec_id_b: every pair of records with similarity of at least t, copies included.

    Null, empty and short texts are in no pair. A row repeated whole under the same id is one record.
    Shingles are compared by 64-bit hashes. An empty table gives no pair.
    """
    sets, members, classes = classes_of(records, id_col, text_col)
    sizes = members.groupBy("cid").agg(F.count(F.lit(1)).alias("copies")).withColumn("slots", F.ceil(F.col("copies") / F.lit(COPIES)).cast("int"))
    placed = members.join(sizes, "cid").withColumn("slot", F.pmod(F.xxhash64("rec_id"), F.col("slots")).cast("int"))
    links = similar_classes(sets, classes, t, slot).select("a", "b")
    across = _expanded(_expanded(links, "a", placed, sizes, "x"), "b", placed, sizes, "y").select(F.least("x", "y").alias("rec_id_a"), F.greatest("x", "y").alias("rec_id_b"))
    copied = placed.where("copies > 1").select(F.col("rec_id").alias("x"), F.col("cid").alias("c"))
    within = _expanded(copied, "c", placed.where("copies > 1"), sizes, "y").where("x < y").select(F.col("x").alias("rec_id_a"), F.col("y").alias("rec_id_b"))
    return across.unionAll(within)


def _expanded(rows: DataFrame, key: str, placed: DataFrame, sizes: DataFrame, out: str) -> DataFrame:
    """rows joined with the members of class ``key``, slot by slot, so that a class of very many copies is many tasks."""
    slots = sizes.select(F.col("cid").alias(key), F.explode(F.sequence(F.lit(0), F.col("slots") - 1)).alias("slot"))
    members = placed.select(F.col("cid").alias(key), "slot", F.col("rec_id").alias(out))
    return rows.join(slots, key).join(members, [key, "slot"]).drop("slot")


def near_duplicate_classes(records: DataFrame, id_col: str = "rec_id", text_col: str = "code", t: float = THRESHOLD) -> DataFrame:
    """(rec_id, class_id, copies, links): one row per record of at least MIN_WORDS words.

    class_id is the class of copies, copies its size and links the number of other classes above t.
    """
    sets, members, classes = classes_of(records, id_col, text_col)
    links = similar_classes(sets, classes, t)
    per = links.select(F.col("a").alias("cid")).unionAll(links.select(F.col("b").alias("cid"))).groupBy("cid").agg(F.count(F.lit(1)).alias("links"))
    sizes = members.groupBy("cid").agg(F.count(F.lit(1)).alias("copies"))
    return members.join(sizes, "cid").join(per, "cid", "left").select("rec_id", F.col("cid").alias("class_id"), "copies", F.coalesce("links", F.lit(0)).alias("links"))
