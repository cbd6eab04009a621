import random

import numpy as np
import pytest

from cairn.llm import splitting as sp

PARTS = ["word ", "Sentence one. ", "clause, ", "\n", "\n\n", "# head\n", "- item\n", "```py\ncode = 1\n\nmore()\n```\n", "\r\n", "x" * 40, "e\u0301", "\U0001f9f5", "def f():\n", "    y = 2\n", "\u3002", "| a | b |\n", " "]


def texts(seed, n=60):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 90))) for _ in range(n)]


def brute(text, limit, overlap):
    s, out, start, least = sp.strengths(text), [], 0, max(limit // 2, overlap + 1)
    while len(text) - start > limit:
        end = max(range(start + least, start + limit + 1), key=lambda q: (s[q], q))
        out.append((start, end, int(s[end])))
        start = end - overlap
    return [*out, (start, len(text), sp.SECTION)]


@pytest.mark.parametrize("limit,overlap", [(50, 0), (80, 20), (33, 15)])
def test_against_brute_force_and_round_trip(limit, overlap):
    for t in texts(limit):
        pieces = sp.cut(t, limit, overlap)
        assert pieces == (brute(t, limit, overlap) if len(t) > limit else [(0, len(t), sp.SECTION)])
        assert all(b - a <= limit for a, b, _ in pieces)
        assert t[: pieces[0][1]] + "".join(t[a + overlap : b] for a, b, _ in pieces[1:]) == t
        assert all(x[1] - y[0] == overlap for x, y in zip(pieces, pieces[1:]))


def test_range_max():
    rng = np.random.default_rng(1)
    v = rng.integers(0, 5, 400).astype(np.int8)
    table = sp.RangeMax(v, 128)
    for _ in range(500):
        lo = int(rng.integers(0, 399))
        hi = int(min(399, lo + rng.integers(0, 128)))
        assert table.strongest(lo, hi) == max(range(lo, hi + 1), key=lambda q: (v[q], q))


def test_long_text_uses_several_tables(monkeypatch):
    monkeypatch.setattr(sp, "_TABLE", 300)
    t = "".join(texts(2, 40))
    assert sp.cut(t, 100, 10) == brute(t, 100, 10)


def test_natural_cuts():
    para = "A sentence here. " * 50
    assert all(k >= sp.SENTENCE for _, _, k in sp.cut(para, 200, 20))
    code = "".join(f"def f{i}():\n    return {i}\n\n" for i in range(60))
    assert all(code[b:].startswith("def ") for _, b, _ in sp.cut(code, 300, 0)[:-1])
    assert sp.strengths("a\r\nb")[2] == sp.NEVER and sp.strengths("e\u0301x")[1] == sp.NEVER


def test_bad_parameters():
    with pytest.raises(ValueError):
        sp.cut("x", 10, 10)
    with pytest.raises(ValueError):
        sp.cut("x", 10, 2, minimum=11)


def test_operator(spark):
    rows = [("t", 1, "f", "a b " * 30), ("t", 2, "f", None), ("t", 3, "f", ""), ("t", 4, "f", "x" * 100), ("t", 1, "g", "\U0001f9f5" * 101)]
    df = spark.createDataFrame(rows, "tab string, item_id bigint, field string, value string")
    out = sp.split_oversized(df, 100, 10).collect()
    assert {(r.item_id, r.field) for r in out} == {(1, "f"), (1, "g")}
    g = sorted((r.part, r.start, r.end) for r in out if r.field == "g")
    assert g[0][0] == 0 and g[-1][2] == 101
    assert sp.split_oversized(df.limit(0)).count() == 0
    t = spark.createDataFrame([(7, "y" * 101, None, "clash"), (8, None, "short", "c")], "rec bigint, a string, b string, value string")
    assert [(r.item_id, r.field) for r in sp.items_of("t", t, "rec", ["a", "b"], 100).collect()] == [(7, "a")]
