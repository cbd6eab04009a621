import random
import re

import numpy as np
import pytest

from cairn.llm import neardup as nd

SCHEMA = "rec_id bigint, code string, n string, h string, token string, cid string"


def frame(spark, rows):
    # columns with the names of inner ones must not matter
    return spark.createDataFrame([(i, c, "x", "x", "x", "x") for i, c in rows], SCHEMA)


def shingles(code):
    w = re.findall(r"[A-Za-z0-9_]+", code or "")
    return {tuple(w[i : i + 4]) for i in range(len(w) - 3)} if len(w) >= 30 else set()


def brute(rows, t=0.7):
    sets = [(i, s) for i, c in rows if (s := shingles(c))]
    return sorted((min(a, b), max(a, b)) for k, (a, x) in enumerate(sets) for b, y in sets[k + 1 :] if a != b and len(x & y) >= t * len(x | y) - 1e-9)


def edited(rng, words, p):
    return [rng.choice(["alpha", "beta", "gamma", "delta"]) if rng.random() < p else w for w in words if rng.random() > p / 4]


def corpus(seed, families=12, size=7):
    rng, rows, i = random.Random(seed), [], 100
    for f in range(families):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(28, 160))]
        for _ in range(size):
            rows.append((i, " ".join(edited(rng, base, rng.choice([0, 0.005, 0.02, 0.05])))))
            i += 1
    return rows


@pytest.mark.parametrize("slot,copies", [(nd.SLOT, nd.COPIES), (2, 2)])
def test_against_brute_force(spark, monkeypatch, slot, copies):
    monkeypatch.setattr(nd, "COPIES", copies)
    rows = corpus(5)
    got = nd.near_duplicate_pairs(frame(spark, rows), slot=slot).collect()
    assert sorted((r.rec_id_a, r.rec_id_b) for r in got) == brute(rows)


def test_odd_rows(spark):
    base = " ".join(f"v{i}" for i in range(60))
    rows = [(1, base), (2, base), (3, base + "!!"), (4, None), (5, ""), (6, "short text"), (7, "é " * 50), (8, " ".join(["a"] * 40)), (9, " ".join(["a"] * 31)), (10, " ".join(f"v{i}" for i in range(29)))]
    got = nd.near_duplicate_pairs(frame(spark, rows)).collect()
    assert sorted((r.rec_id_a, r.rec_id_b) for r in got) == brute(rows) == [(1, 2), (1, 3), (2, 3), (8, 9)]
    assert nd.near_duplicate_pairs(frame(spark, [])).count() == 0
    again = nd.near_duplicate_pairs(frame(spark, rows + rows[:2])).collect()
    assert sorted((r.rec_id_a, r.rec_id_b) for r in again) == brute(rows)


def test_a_third_are_copies_and_a_hot_shingle(spark):
    rng = random.Random(1)
    head = [f"h{i}" for i in range(25)]
    rows = [(i, " ".join([*head, *(f"c{rng.randrange(10**6)}" for _ in range(30))])) for i in range(60)] + [(1000 + i, " ".join(head * 2)) for i in range(30)]
    got = nd.near_duplicate_pairs(frame(spark, rows), slot=4).collect()
    assert sorted((r.rec_id_a, r.rec_id_b) for r in got) == brute(rows) and len(got) == 30 * 29 // 2


def test_classes(spark):
    rows = corpus(9, 5, 5)
    pairs = brute(rows)
    got = {r.rec_id: r for r in nd.near_duplicate_classes(frame(spark, rows)).collect()}
    assert set(got) == {i for i, c in rows if shingles(c)}
    for a, b in pairs:
        assert got[a].class_id == got[b].class_id or got[a].links > 0 and got[b].links > 0


def test_bit_bound_never_loses(spark):
    rng = np.random.default_rng(0)
    for _ in range(300):
        a, b = (np.unique(rng.integers(-50, 50, rng.integers(1, 80))).astype(np.int64) * 7919 for _ in range(2))
        x, y = nd.bitmap(a, 64).view(np.uint64), nd.bitmap(b, 64).view(np.uint64)
        lacking = int(np.bitwise_count(x & ~y).sum())
        assert len(np.intersect1d(a, b)) <= len(a) - lacking


def test_a_shingle_in_every_class_is_no_single_task(spark):
    rng = random.Random(3)
    head = [f"h{i}" for i in range(12)]
    rows = [(i, " ".join([*head, *(f"c{rng.randrange(10**6)}" for _ in range(20))])) for i in range(200)]
    rows += [(1000 + i, " ".join([*head, *head, "x", f"z{i}", *head])) for i in range(100)]  # hardly anything else: it is in their prefixes
    sets = nd.shingle_sets(frame(spark, rows))
    prefixes = nd.prefix_rows(sets, 0.7, 16)
    tiled = nd.tiles(prefixes, 0.7, slot=16).collect()
    members, found = {}, {}
    rows_of = {r.token: r.hot for r in prefixes.collect()}
    for r in prefixes.collect():
        members.setdefault(r.token, set()).add(r.key)
    for r in tiled:
        if r.k % 2:
            found.setdefault((r.token, r.band, r.slot), set()).add(r.key)
    assert all(rows_of[t] for t, m in members.items() if len(m) > 16)
    assert max(map(len, members.values())) >= 100 and max(map(len, found.values())) < 40
    got = nd.near_duplicate_pairs(frame(spark, rows), slot=16).collect()
    assert sorted((r.rec_id_a, r.rec_id_b) for r in got) == brute(rows)


def test_slices_are_the_batch():
    import pyarrow as pa

    lists = [list(range(k % 5)) for k in range(40)] + [list(range(50)), []]
    b = pa.record_batch([pa.array(range(42)), pa.array(lists, pa.list_(pa.int64()))], names=["key", "h"])
    for batch in (b, b.slice(3, 30), b.slice(41)):
        parts = list(nd._slices(batch, 9))
        assert [r for p in parts for r in p.to_pylist()] == batch.to_pylist()
        assert all(sum(map(len, p.column("h").to_pylist())) <= 9 or p.num_rows == 1 for p in parts)


def test_position_and_sketch_do_not_decide(spark, monkeypatch):
    rows = corpus(11, 8, 6)
    want = brute(rows)
    for width, local in ((2, 1), (1 << 10, 1), (1 << 20, 1 << 30)):
        monkeypatch.setattr(nd, "LOCAL", local)
        monkeypatch.setattr(nd, "WIDTH", width)
        monkeypatch.setattr(nd.frequent_cells, "__defaults__", (width,))
        got = nd.near_duplicate_pairs(frame(spark, rows)).collect()
        assert sorted((r.rec_id_a, r.rec_id_b) for r in got) == want
