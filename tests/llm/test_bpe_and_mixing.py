import random

import pytest

from cairn.llm import bpe, mixing

ALPHABET = ["a", "b", "the", " ", "  ", "\n", " \n", "\u00e9", "\u65e5\u672c", "\u2019", "'s", "1", "\u0663", "\x1c", "\x85", "\xa0", "\u3000", "\U0001f600", "e\u0301", "!!", "\t", "_", "<|endoftext|>", "\x00", "\u017f", "'S"]


@pytest.fixture(scope="module")
def public():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda s: t.encode(s, add_special_tokens=False).ids


def test_equal_to_the_public_library(public):
    t, rng = bpe.Tokenizer(bpe.vocabulary_path()), random.Random(3)
    for _ in range(4000):
        s = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 16)))
        assert t.encode(s) == public(s), ascii(s)
        assert t.count(s) == len(public(s))


def test_blanks_beside_other_white_space():
    t, rng = bpe.Tokenizer(bpe.vocabulary_path()), random.Random(11)
    assert t.encode("tail \xa0 \xa0") == [13199, 11504]
    texts = ["tail \xa0 \xa0", "a \xa0 \xa0 \xa0b", "a\t b", "a \tb c", " a", "a ", " ", "\t ", "\xa0 a b"]
    texts += ["".join(rng.choice(["a", "b1", "!", " ", "\xa0", "\t", "\n", "\u3000"]) for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    for s in texts:
        whole = [i for w in t.known.find(s) for i in t.known.bpe.encode(w.encode())]  # the pattern over the whole text
        assert t.encode(s) == whole and t.count(s) == len(whole), ascii(s)


def test_merges_against_the_plain_loop():
    t, rng = bpe.Tokenizer(bpe.vocabulary_path()), random.Random(5)
    ranks, tree = t.known.bpe.ranks, t.known.bpe

    def plain(data):
        parts = [data[i : i + 1] for i in range(len(data))]
        while True:
            best = min(((ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks), default=None)
            if best is None:
                return [ranks[p] for p in parts]
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]

    for _ in range(300):
        data = bytes(rng.choice(b"abcdetinors \xe2\x80\x99") for _ in range(rng.randint(0, 70)))
        assert tree.encode(data) == plain(data)
    assert len(tree.encode(b"ab" * 20000)) > 0


def test_encode_texts(spark, public):
    rows = [(1, "Hello world", "x"), (2, None, "x"), (3, "", "x"), (1, "Hello world", "x"), (4, " \n", "x"), (5, "z" * 5000, "x")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, ids string")
    got = bpe.encode_texts(df).collect()
    assert sorted((r.doc_id, list(r.ids)) for r in got) == sorted((i, public(s) if s else []) for i, s, _ in rows)
    assert bpe.encode_texts(df).schema.simpleString() == "struct<doc_id:bigint,ids:array<int>>"
    assert bpe.encode_texts(df.limit(0)).count() == 0


def test_water_filling():
    e = mixing.water_fill({"a": (0.5, 100, 2), "b": (0.5, 1000, 5)}, 1000)
    assert e == {"a": 2.0, "b": 0.8}
    e = mixing.water_fill({"a": (0.25, 100, 4), "b": (0.75, 100, 4)}, 200)
    assert e == {"a": 0.5, "b": 1.5}
    assert mixing.water_fill({"a": (1.0, 0, 4), "b": (0.0, 10, 1), "c": (1.0, 10, 0)}, 50) == {"a": 0.0, "b": 0.0, "c": 0.0}
    assert mixing.water_fill({"a": (0.5, 10, 1), "b": (0.5, 10, 2)}, 1000) == {"a": 1.0, "b": 2.0}  # the caps don't permit the total
    rng = random.Random(2)
    for _ in range(200):
        s = {str(i): (rng.random(), rng.randrange(1, 1000), rng.randrange(1, 6)) for i in range(rng.randrange(1, 8))}
        total = rng.uniform(1, sum(t * c for _, t, c in s.values()))
        e = mixing.water_fill(s, total)
        assert abs(sum(e[k] * s[k][1] for k in s) - total) < 1e-6 * total
        free = [e[k] * s[k][1] / s[k][0] for k in s if e[k] < s[k][2] - 1e-9]
        # the free sources keep the proportions of their shares; no clamped one would get less than its cap
        assert not free or max(free) - min(free) < 1e-6 * max(free)


def test_mix(spark):
    rng = random.Random(8)
    words = "grid mesh axis node tint weld".split()
    rows = [(i, rng.choice(["big"] * 6 + ["small", "other", None]), " ".join(rng.choice(words) for _ in range(rng.randrange(1, 30)))) for i in range(900)]
    rows += [(900, "big", None), (901, "small", ""), (902, "big", rows[0][2])]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, source string, text string, n_tokens string")
    targets = spark.createDataFrame([("big", 0.3, 2), ("small", 0.6, 3), ("absent", 0.1, 5)], "source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(docs, targets, total_tokens=10_000)
    a = sorted((r.doc_id, r.repeats) for r in mixed.collect())
    assert a == sorted((r.doc_id, r.repeats) for r in mixing.mix(docs.repartition(7), targets, total_tokens=10_000)[0].collect())
    got = {r.source: r for r in report.collect()}
    assert set(got) == {"big", "small", "absent"} and abs(sum(r.actual_share for r in got.values()) - 1) < 1e-9
    assert got["small"].epochs == 3.0 and got["absent"].mixed_tokens == 0 and max(r for _, r in a) <= 3
    for s in ("big", "small"):
        want = got[s].epochs * got[s].available_tokens
        longest = max(r.n_tokens for r in mixed.where(f"source = '{s}'").collect())
        assert abs(got[s].mixed_tokens - want) <= longest
    half, rep = mixing.mix(docs, targets.where("source = 'big'"), total_tokens=1000)
    assert abs(rep.collect()[0].mixed_tokens - 1000) < 60 and half.where("source <> 'big'").count() == 0
    none, rep = mixing.mix(docs.limit(0), targets)
    assert none.count() == 0 and all(r.actual_share == 0 for r in rep.collect())


def test_no_document_above_the_cap(spark):
    # a clamped source whose documents are nearly all empty, and one without epochs
    docs = spark.createDataFrame([(i, "a", "word " * 40 if i == 7 else "") for i in range(40)] + [(100 + i, "b", "grid mesh") for i in range(40)] + [(200, "c", "")], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 0.9, 2), ("b", 0.1, 1), ("c", 0.0, 3)], "source string, target_share double, max_repeats int")
    for total in (None, 10**6):
        mixed, report = mixing.mix(docs, targets, total)
        got = {r.source: r for r in report.collect()}
        assert got["a"].most_repeats == 2 and got["b"].most_repeats == 1 and got["c"].most_repeats == 0
        assert mixed.where("source = 'a' and repeats > 2 or source = 'c'").count() == 0


def test_long_documents_at_the_edge(spark):
    rng = random.Random(6)
    docs = spark.createDataFrame([(i, rng.choice("ab"), "grid " * (3000 if i % 97 == 0 else rng.randrange(1, 20))) for i in range(4000)] + [(5000 + i, "c", "mesh " * 4000) for i in range(5)], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.25, 3), ("c", 0.25, 9)], "source string, target_share double, max_repeats int")
    for total in (None, 40_000, 90_000):
        got = {r.source: r for r in mixing.mix(docs, targets, total)[1].collect()}
        for s in "ab":
            assert abs(got[s].mixed_tokens - got[s].epochs * got[s].available_tokens) <= 20, (total, got[s])
        assert abs(got["c"].mixed_tokens - got["c"].epochs * got["c"].available_tokens) <= 4000 / 2 + 1  # all of its documents are long


def test_exact_shares_and_buckets(spark, monkeypatch):
    rng = random.Random(3)
    docs = spark.createDataFrame([(i, rng.choice("aaaaabbbcd"), "grid " * rng.randrange(1, 20)) for i in range(6000)] + [(9999, "e", None)], "doc_id bigint, source string, text string")
    targets = spark.createDataFrame([("a", 0.3, 2), ("b", 0.3, 1), ("c", 0.2, 4), ("d", 0.2, 3), ("e", 0.1, 9)], "source string, target_share double, max_repeats int")
    mixed, report = mixing.mix(docs, targets)
    for r in report.collect():
        assert abs(r.actual_share - (r.target_share if r.source != "e" else 0)) < 3e-4 and r.most_repeats <= r.max_repeats
    monkeypatch.setattr(mixing, "BUCKET", 300)
    again = mixing.mix(docs, targets)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))
    monkeypatch.setattr(mixing, "MAX_SOURCES", 4)
    with pytest.raises(ValueError):
        mixing.mix(docs, targets)
