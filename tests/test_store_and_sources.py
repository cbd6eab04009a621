"""Store, search, enrichment, files and fetchers."""

import json

import pytest
from pyspark.sql import functions as F

from cairn.config import Config
from cairn.operators import enrich, policy, search, store
from cairn.schema import VECTOR, columns
from cairn.sources import fetch, files, records

CH = "record_id string, chunk_type string, part int, text string, return_text string, corpus string"


def chunks(spark, *rows):
    return spark.createDataFrame(list(rows), CH)


def test_load_twice_and_change(spark, tmp_path):
    path = f"file://{tmp_path}/store"
    with pytest.raises(LookupError):
        store.VectorStore.open(spark, path)
    s = store.VectorStore.create(spark, path, dim=8)
    embed = lambda df: enrich.embed(df, enrich.HashEmbedder(8))
    first = [("n", "signature", 0, "a", "r", "c"), ("n", "signature", 2, "b", None, "c"), ("m", "doc", None, "t", "", "c")]
    assert s.load(chunks(spark, *first), embed) == 3
    assert s.load(chunks(spark, *first), embed) == 0
    assert {r.chunk_id for r in s.read().collect()} == {"n::signature", "n::signature::2", "m::doc"}
    assert s.load(chunks(spark, ("n", "signature", 0, "a", "changed", "c"), *first[1:]), embed) == 1
    assert s.load(chunks(spark, *first[1:]), embed) == 0 and s.count() == 3  # nothing is deleted
    s.load(chunks(spark, *first[1:]), embed, prune=True)
    assert s.count() == 2 and store.VectorStore.open(spark, path).meta()["metric"] == "cosine"


def test_a_load_writes_its_change_only(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store.VectorStore, "COMPACT", 4)
    s = store.VectorStore.create(spark, f"file://{tmp_path}/s", dim=4)
    embed = lambda df: enrich.embed(df, enrich.HashEmbedder(4))
    rows = [(f"n{i}", "doc", 0, f"t{i}", None, "c") for i in range(50)]
    assert s.load(chunks(spark, *rows), embed) == 50
    for k in range(3):
        rows[k] = (f"n{k}", "doc", 0, f"changed{k}", None, "c")
        assert s.load(chunks(spark, *rows), embed) == 1
        sizes = [spark.read.parquet(str(p)).count() for p in (tmp_path / "s" / "deltas").iterdir()]
        assert sum(sizes) == 50 + k + 1  # in proportion to the change
    assert s.version() == 5 and s._head(5)["deltas"] == [] and s.count() == 50  # folded
    assert {r.document for r in s.read().where("chunk_id in ('n0::doc', 'n1::doc', 'n5::doc')").collect()} == {"changed0", "changed1", "t5"}
    assert s.read(1).where("document = 't0'").count() == 1  # older versions can be read until they are removed
    assert s.vacuum() == 4 and s.count() == 50 and s.version() == 5


def test_scratch_tables(spark, tmp_path):
    from types import SimpleNamespace

    from cairn import runtime

    df = runtime.materialise(spark.range(3), "x")
    where = runtime.filesystem(spark, df.scratch)
    assert df.scratch.startswith(runtime.shared_dir(spark)) and spark.sparkContext.applicationId in df.scratch and df.count() == 3
    runtime.discard(df)
    assert not where[0].exists(where[1](df.scratch))
    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://m:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False)))))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        runtime.shared_dir(cluster)
    runtime.write_once(spark, f"file://{tmp_path}/one", "a")
    with pytest.raises(FileExistsError):
        runtime.write_once(spark, f"file://{tmp_path}/one", "b")
    assert runtime.read_text(spark, f"file://{tmp_path}/one") == "a" and [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["one"]


def test_two_writers(spark, tmp_path):
    a, b = (store.VectorStore.create(spark, f"file://{tmp_path}/s", dim=4) for _ in range(2))
    embed = lambda df: enrich.embed(df, enrich.HashEmbedder(4))

    def slow(df):
        b.load(chunks(spark, ("n", "doc", 0, "other", None, "c")), embed)
        return embed(df)

    with pytest.raises(store.Conflict):
        a.load(chunks(spark, ("n", "doc", 0, "mine", None, "c")), slow)
    assert [r.document for r in a.read().collect()] == ["other"] and a.version() == 1
    assert len(list((tmp_path / "s" / "deltas").iterdir())) == 1


def test_the_last_delivery_counts(spark, tmp_path):
    s = store.VectorStore.create(spark, f"file://{tmp_path}/s", dim=4)
    rows = spark.createDataFrame([(k, "n", "doc", 0, t, None, "c") for k, t in ((1, "zz"), (3, "mm"), (2, "aa"))], "chunk_seq bigint, " + CH)
    s.load(rows, lambda df: enrich.embed(df, enrich.HashEmbedder(4)))
    assert [r.document for r in s.read().collect()] == ["mm"]


def test_failed_embeddings_stay_pending(spark, tmp_path):
    s = store.VectorStore.create(spark, f"file://{tmp_path}/s")

    def broken(texts):
        raise OSError("down")

    rows = chunks(spark, ("n", "doc", 0, "a", None, "c"))
    assert s.load(rows, lambda df: enrich.embed(df, broken, first_pause=0)) == 0
    assert s.load(rows, lambda df: enrich.embed(df, enrich.HashEmbedder(4))) == 1


def test_search_golden(spark):
    rows = [("1", "r1", "explanation", "h", [1.0, 0.0], "d1"), ("2", "r1", "signature", "h", [0.6, 0.8], "d2"), ("3", "r2", "example", "h", [0.8, 0.6], "d3"), ("4", "r3", "doc_section", "h", [0.0, 1.0], "d4")]
    df = spark.createDataFrame(rows, VECTOR)
    near = lambda k: [(r.record_id, r.matched_chunk_type, round(r.distance, 6)) for r in search.search(df, [1.0, 0.0], k).collect()]
    assert near(2) == [("r1", "explanation", 0.0), ("r2", "example", 0.2)]
    assert [x[0] for x in near(99)] == ["r1", "r2", "r3"] and [x[0] for x in near(0)] == ["r1"]
    assert search.search(df.limit(0), [1.0, 0.0]).collect() == []
    assert "TakeOrderedAndProject" in search.search(df, [1.0, 0.0])._jdf.queryExecution().executedPlan().toString()
    odd = spark.createDataFrame([("5", "z", "t", "h", [0.0, 0.0], "d"), ("6", "n", "t", "h", None, "d"), ("7", "s", "t", "h", [1.0], "d")], VECTOR)
    assert [x.distance for x in search.search(odd, [1.0, 0.0]).collect()] == [None] * 3
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id bigint, vector array<double>")
    a = sorted((r.query_id, r["rank"], r.record_id) for r in search.search_batch(df.union(odd), q, 2).collect())
    assert a == [(1, 1, "r1"), (1, 2, "r2"), (2, 1, "r3"), (2, 2, "r1")]
    b = sorted((r.query_id, r["rank"], r.record_id) for r in search.search_batch(df.union(odd), q, 2, block=1, rows=1).collect())
    assert a == b


def test_batch_search_against_brute_force(spark):
    import random

    rng = random.Random(5)
    vector = lambda: [float(rng.choice((-1, 0, 1))) for _ in range(4)]  # few values, so that there are ties
    rows = [(str(i), f"r{rng.randrange(40)}", "t", "h", vector(), "d") for i in range(300)] + [("n", None, "t", "h", [1.0] * 4, "d"), ("m", None, "t", "h", [1.0, 1.0, 1.0, 0.0], "d")]
    asked = [(i, vector()) for i in range(30)] + [(98, None), (99, [1.0])]
    df, q = spark.createDataFrame(rows, VECTOR), spark.createDataFrame(asked, "query_id bigint, vector array<double>")

    def distance(a, b):
        size = (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5
        return 1 - sum(x * y for x, y in zip(a, b)) / size if size else None

    want = []
    for i, v in asked[:30]:
        best = {}
        for _, r, _, _, e, _ in rows:
            if (d := distance(v, e)) is not None and (r not in best or d < best[r]):
                best[r] = d
        want += [(i, round(d, 9)) for _, d in sorted(best.items(), key=lambda x: (x[1], x[0] or ""))[:5]]
    for block, many in ((512, 8192), (7, 50), (1, 20)):
        got = search.search_batch(df.repartition(3), q, 5, block=block, rows=many).collect()
        assert sorted((r.query_id, round(r.distance, 9)) for r in got) == sorted(want)
    assert search.search_batch(df.limit(0), q).count() == search.search_batch(df, q.limit(0)).count() == 0


def test_explanations(spark):
    rows = spark.createDataFrame([("a", "function", None, None), ("b", "example", "code()", ""), ("c", "class", None, "kept")], "name string, kind string, code string, explanation string")
    out = enrich.explain(rows, lambda system, user: f"{len(system) > 0} {user.splitlines()[-1]}", first_pause=0)
    made = enrich.with_explanations(rows, out)
    assert {r.name: r.explanation for r in made.collect()} == {"a": "True Explain `a`.", "b": "True Explain this code.", "c": "kept"}

    def fails(system, user):
        raise TimeoutError("slow")

    bad = enrich.explain(rows, fails, attempts=2, first_pause=0).collect()
    assert {r.error for r in bad} == {"TimeoutError: slow"} and all(r.explanation is None for r in bad)
    pauses = []
    assert enrich.retried(lambda: 1 / 0, sleep=pauses.append)[0] is None and pauses == [1.0, 2.0]
    system, user = enrich.build_prompt({"name": "x", "kind": "example", "code": "a\nb", "explanation": "no"})
    assert "a\nb" in user and "no" not in user.replace("not", "")
    gone = policy.invalidate(made, ["code"])
    assert {r.name for r in gone.where("invalidated").collect()} == {"b"}


def test_jsonl(spark, tmp_path):
    src = tmp_path / "raw_text"
    src.mkdir()
    (src / "api.jsonl").write_text('{"name":"a","kind":"class","parameters":[[{"name":"p","type":null,"required":true,"default":null}]]}\n\n{"name":"é"}\n', encoding="utf-8")
    df = records.read_jsonl(spark, f"file://{src}")
    assert [(r.name, r.corpus) for r in df.orderBy("name").collect()] == [("a", "api"), ("é", "api")]
    records.write_jsonl(df, f"file://{tmp_path}/out")
    lines = [json.loads(x) for p in (tmp_path / "out").glob("part-*") for x in p.read_text(encoding="utf-8").splitlines()]
    a = next(x for x in lines if x["name"] == "a")
    assert a["parameters"] == [[{"name": "p", "type": None, "required": True, "default": None}]] and "doc" not in a
    (src / "bad.jsonl").write_text('{"name": \n')
    with pytest.raises(Exception):
        records.read_jsonl(spark, f"file://{src}/bad.jsonl").collect()
    assert columns(CH) == ["record_id", "chunk_type", "part", "text", "return_text", "corpus"]


def test_trees_and_manifests(spark, tmp_path):
    root = tmp_path / "src"
    for p, t in (("official/a.py", "x = 1"), ("official/sub/b+c %41.py", "é"), ("docs/g.md", "# T"), ("official/_manifest.json", json.dumps({"license": "MIT", "files": {"a.py": "U", "sub/b+c %41.py": "V"}, "licenses": {"sub/b+c %41.py": None}}))):
        (root / p).parent.mkdir(parents=True, exist_ok=True)
        (root / p).write_text(t, encoding="utf-8")
    got = {(r.prefix, r.path): r.content for r in files.read_python(spark, str(root)).collect()}
    assert got == {("official", "a.py"): "x = 1", ("official", "sub/b+c %41.py"): "é"}
    assert [(r.prefix, r.path) for r in files.read_markdown(spark, str(root)).collect()] == [("docs", "g.md")]
    assert sorted((r.path, r.url, r.license) for r in files.read_manifests(spark, str(root)).collect()) == [("a.py", "U", "MIT"), ("sub/b+c %41.py", "V", None)]
    assert files.read_manifests(spark, str(root / "docs")).count() == 0
    assert [s["prefix"] for s in Config(root=str(tmp_path / "none")).sources()] == []


def test_fetchers(spark):
    client = fetch.FixtureFetcher({"s1": [{"repo": "o/r", "branch": "main", "path": "a.py"}, {"repo": "o/r", "branch": "main", "path": "b.md"}], "s2": [], "m/o/r": {"stargazers_count": 7, "license": None, "pushed_at": "2025-01-02T00:00:00Z", "fork": False}, "f/a.py": "import lib"})
    hits = fetch.search_results(spark, client, lambda n: f"s{n}", 2)
    repos = fetch.repo_files(hits)
    assert [(r.repo, r.paths) for r in repos.collect()] == [("o/r", ["a.py"])]
    meta = fetch.repo_metadata(repos.select("repo"), client, lambda r: f"m/{r}").collect()[0]
    assert (meta.stars, meta.license, meta.pushed_at, meta.is_fork) == (7, "NO-LICENSE", "2025-01-02", False)
    got = fetch.file_contents(spark.createDataFrame([("a.py",), ("no.py",)], "path string"), client, F.concat(F.lit("f/"), "path")).collect()
    assert {r.path: r.content for r in got} == {"a.py": "import lib", "no.py": None}


def test_resolution(spark):
    tree = spark.createDataFrame([("examples/a.py",), ("examples/sub/b.py",), ("demo/c.py",), ("examples/conftest.py",)], "path string")
    tags = spark.createDataFrame([("v1",)], "tag string")
    package = {"info": {"project_urls": {"Homepage": "https://x.org", "Source": "https://github.com/o/r.git"}, "license": "MIT"}}
    s = fetch.resolve_source(spark, Config(version="1"), package, tags, tree)
    assert (s.repo, s.ref, s.path, s.license, s.origin["repo"]) == ("o/r", "v1", "examples", "MIT", "resolved")
    assert [(r.path, r.url) for r in fetch.example_files(tree, s).collect()] == [("a.py", "https://github.com/o/r/blob/v1/examples/a.py")]
    with pytest.raises(fetch.Unresolved, match="repo"):
        fetch.resolve_source(spark, Config(version="1"), {}, tags, tree)
    kept = policy.not_ingested(spark.createDataFrame([("o/r", "examples/a.py"), ("o/r", "x.py")], "repo string, path string"), spark.createDataFrame([("o/r", "examples")], "repo string, dir string"))
    assert [r.path for r in kept.collect()] == ["x.py"]
