import random

from cairn.llm import spam

SENTENCES = "The older grid format kept the warp apart from the node, and the newer one does not. Has anyone managed to weld each seam while the chart was open? Use the flat setting if your tree must load slowly; otherwise leave it alone. "
GOOD = {
    "prose": SENTENCES * 3,
    "term": "A closed lattice keeps its own panel, and that is why we register it. When a closed lattice fails, the gateway fails with it. Most readers meet the closed lattice first in the ray chapter. ",
    "glossary": "Glossary\n\nborder\n    If every buffer looks quick, the usual reason is a boundary.\n\npass\n    Nobody has measured whether the fan gains anything from it.\n",
    "reading": "Further reading\n\n" + "".join(f"* https://docs.example/a/{i} - Nothing in the right sweep depends on the sheet, so it is safe to leave it.\n" for i in range(5)),
    "changes": "Changes in 2.3\n\n" + "".join(f"- Fixed the warm basin that could not compare a mask (#{i})\n" for i in range(9)),
    "log": "".join(f"2025-02-{i + 10} 15:47 WARN pocket.unwrap: shallow profile took {i}6 ms while the wide ridge was waiting\n" for i in range(9)),
    "code": "def f(a, b=3):\n    x = lib.core.run(a)\n    for i in b:\n        x += lib.fit.score(i)\n    return x\n" * 3,
    "api": "".join(f"lib.core.Grid{i}.run: Please do not weld a shell stencil by hand, because the weight will do it.\n" for i in range(6)),
    "short": "tiny",
    "japanese": "この文は普通の文であり、処理には約九秒かかりますが、結果は保存されます。" * 5,
}
rng = random.Random(6)
PHRASES = ["free cache viewer", "best stride socket", "marker repair online", "layer download"]
BAD = {
    "commas": ", ".join(rng.choice(PHRASES) for _ in range(60)),
    "spaces": " ".join(rng.choice([str.upper, str.lower])(rng.choice(PHRASES)) for _ in range(60)),
    "lines": "\n".join(rng.choice(PHRASES) for _ in range(60)),
    "cities": " - ".join(f"Visible Beacon {p} {c}" for p in ("of", "in", "near") for c in ("Dunholt", "Tarnwick", "Quenby", "Eastwick")),
    "hashtags": " ".join(rng.choice(["#gridtool", "#meshpro", "#warmdeal"]) for _ in range(60)),
    "links": "Stage links\n\n" + "".join(f"schedule strip » storeroot{i}.test\n" for i in range(20)),
    "anchors": "".join(f'<a href="http://a{i}.test/b.html">best chart</a>\n' for i in range(20)),
    "urls": "".join(f"https://a{i}.invalid/decode/{i}\n" for i in range(20)),
    "stuffed": "Our fresh window is fresh window best spline top fresh window. Best fresh window fresh window for fresh window with fresh window. " * 5,
    "mostly": SENTENCES + ", ".join(rng.choice(PHRASES) for _ in range(80)),
}
FOOTER = SENTENCES * 8 + "\n\n" + ", ".join(rng.choice(PHRASES) for _ in range(12))


def pages(spark, texts, site=lambda i: f"s{i % 3}"):
    return spark.createDataFrame([(i, t, site(i), "x", "x") for i, t in enumerate(texts)], "doc_id bigint, text string, site string, links string, total string")


def test_kinds(spark):
    # phrases count if another host has them as well
    texts = [*GOOD.values(), *BAD.values(), FOOTER, None, "", " \n", "\ufeff"]
    elsewhere = [*GOOD.values(), *BAD.values(), FOOTER]
    got = sorted(r.doc_id for r in spam.stuffed_pages(pages(spark, texts + elsewhere, site=lambda i: f"s{i}")).collect())
    want = list(range(len(GOOD), len(GOOD) + len(BAD)))
    assert got == want + [len(texts) + i for i in want]


def test_hosts_and_density_count_together(spark):
    keywords = [BAD[k] for k in ("commas", "spaces", "lines", "stuffed")]
    links = [BAD[k] for k in ("links", "anchors", "urls", "hashtags")]
    found = lambda site: spam.stuffed_pages(pages(spark, keywords + keywords + links, site=site)).count()
    assert found(lambda i: "one") == len(links) and found(lambda i: f"h{i}") == 2 * len(keywords) + len(links)


def test_phrases_of_other_hosts_decide(spark):
    # short items that don't recur on their page: stuffing only if several hosts have the same ones
    menu = "grid deal, mesh sale, warp shop, node price, tint offer, weld buy, fan cheap, rib hot, arc new, edge top"
    alone = spam.stuffed_pages(pages(spark, [menu, SENTENCES])).count()
    same_host = spam.stuffed_pages(pages(spark, [menu] * 5, site=lambda i: "one")).count()
    spread = spam.stuffed_pages(pages(spark, [menu] * 5, site=lambda i: f"h{i}")).count()
    assert (alone, same_host, spread) == (0, 0, 5)


def test_empty_repeated_and_null_sites(spark):
    df = pages(spark, [BAD["commas"], GOOD["prose"], BAD["commas"]], site=lambda i: "a" if i == 2 else None)
    assert sorted(r.doc_id for r in spam.stuffed_pages(df.union(df)).collect()) == [0, 2]
    assert spam.stuffed_pages(df.limit(0)).count() == 0


def test_long_text_ends():
    for bad in ("<a x" * 50_000, "f(" * 100_000, "[a](" * 50_000, "#" * 100_000, "a.b" * 50_000, "www." * 50_000):
        spam.stretches(bad)
    total, _, found = spam.stretches(("word " * 300_000) + "\n" + "a" * 500_000)
    assert total == 4 * 300_000 + 500_000 and found


def test_keywords_between_full_stops(spark):
    rng = random.Random(8)
    names = ["メッシュ修復jacobian", "点群無料", "形状ソフト比較", "三次元curve激安"]
    bad = [
        " ".join(f"{names[0]} {rng.choice(names)} {names[0]}." for _ in range(20)),
        "\n".join(" ".join(rng.choice(names) for _ in range(9)) + "。" for _ in range(5)),
        "".join(f"{rng.choice(names)}。" for _ in range(40)),
        " ".join(f"Best {rng.choice(PHRASES)}. Top {rng.choice(PHRASES)}!" for _ in range(20)),
    ]
    good = [
        "".join(f"半径を{i}ミリに変えると、面の向きが安定しました。trimの処理には約{i}秒かかりますが、結果は保存されます。" for i in range(12)),
        "Grid notes\n" + "".join(f"- 半径を{i % 3}ミリに変えると、面の向きが安定しました。\n" for i in range(12)),
        "".join(f"第{i}の格子は閉じています。面{i}の向きは安定しました。" for i in range(12)),
        "그물의 꼭짓점을 합칩니다. 면의 방향을 바꿉니다. 결과는 파일에 저장됩니다. 곡선을 더 부드럽게 만듭니다. 경계가 닫혀 있지 않습니다.",
        " ".join(f"Returns the {w}." for w in SENTENCES.replace(".", "").split()),
    ]
    got = sorted(r.doc_id for r in spam.stuffed_pages(pages(spark, [*good, *bad, *good, *bad], site=lambda i: f"h{i}")).collect())
    want = list(range(len(good), len(good) + len(bad)))
    assert got == want + [len(good) + len(bad) + i for i in want]


def test_short_sentences_decide_by_other_hosts(spark):
    # each name twice: the run is list-like, and only hosts that have the same one make it stuffing
    menu = "点群無料 格子比較. 曲線激安 網目修復. 曲線激安 網目修復. 点群無料 格子比較."
    assert spam.stuffed_pages(pages(spark, [menu, SENTENCES])).count() == 0
    assert spam.stuffed_pages(pages(spark, [menu] * 5, site=lambda i: f"h{i}")).count() == 5
