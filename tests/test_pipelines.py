import pytest
from pyspark.sql import functions as F

from cairn.config import Config
from cairn.operators import enrich
from cairn.operators.store import VectorStore
from cairn.plans import pipelines
from cairn.sources import fetch, records


def test_api_records_of_an_installed_library(spark):
    rows = pipelines.api_records(spark, "colorsys", exclude=["colorsys.ONE_THIRD"])
    got = {r.name: r for r in rows.collect()}
    assert list(got) == sorted(got) and "colorsys.ONE_THIRD" not in got
    assert [p.name for p in got["colorsys.rgb_to_hsv"].parameters[0]] == ["r", "g", "b"]


def test_corpus_to_answers(spark, tmp_path):
    config = Config(library="lib", version="1", root=str(tmp_path), retry_seconds=0)
    src = tmp_path / "lib_1" / "src" / "official"
    src.mkdir(parents=True)
    (src / "weld.py").write_text("import lib\n\ndef weld(a):\n    return lib.core.weld(a)\n")
    (src / "guide.md").write_text("# Guide\nHow seams are welded.\n")
    known = spark.createDataFrame([("lib.core.weld",)], "name string")
    rows, errors = pipelines.source_records(spark, config, known)
    assert errors.count() == 0 and {r.name for r in rows.collect()} == {"official/weld.py::weld", "official/guide::Guide", "official/weld.py"}
    assert {r.kind: r.n for r in pipelines.summary(rows).collect()} == {"example": 2, "doc_section": 1}
    records.write_jsonl(rows, f"file://{config.records_dir}")
    made = pipelines.explained(rows, lambda s, u: "explained", config, skip_kinds=["doc_section"])
    assert made.count() == 2
    full = enrich.with_explanations(rows, made)
    assert pipelines.invalidation_report(full, ["code"]) == {"invalidated": 2, "names": ["official/weld.py", "official/weld.py::weld"], "more": 0}
    model = enrich.HashEmbedder(32)
    store = VectorStore.create(spark, config.store_dir)
    n = pipelines.ingest(full, store, model, config)
    assert n > 4 and pipelines.ingest(full, store, model, config) == 0
    hits = pipelines.answer(spark, config, model.one, "How seams are welded.", 2)
    assert hits[0]["record_id"] == "official/guide::Guide" and len({h["record_id"] for h in hits}) == 2


def test_community_candidates(spark):
    page = [{"repo": r, "branch": "main", "path": p} for r, p in (("o/good", "a.py"), ("o/good", "b.py"), ("o/good", "ex/c.py"), ("o/fork", "a.py"), ("o/gone", "a.py"))]
    code = "import lib\ndef f():\n    lib.a.x(); lib.b.y(); lib.c.z()\n"
    meta = {"stargazers_count": 900, "license": {"spdx_id": "MIT"}, "pushed_at": "2025-11-01T00:00:00Z", "fork": False}
    client = fetch.FixtureFetcher({"p1": page, "m/o/good": meta, "m/o/fork": meta | {"fork": True}, "f/o/good/a.py": code, "f/o/good/b.py": code + "lib.gone.w()\n", "f/o/good/ex/c.py": code})
    # inner parts of a chain are references too, so the modules are known names
    known = spark.createDataFrame([(n,) for n in ("lib.a", "lib.b", "lib.c", "lib.a.x", "lib.b.y", "lib.c.z")], "name string")
    hits = fetch.search_results(spark, client, lambda n: f"p{n}", 1)
    official = spark.createDataFrame([("o/good", "ex")], "repo string, dir string")
    url = F.concat(F.lit("f/"), "repo", F.lit("/"), "path")
    got, away = pipelines.community_candidates(spark, Config(library="lib", politeness_seconds=0), known, hits, client, lambda r: f"m/{r}", url, F.lit("2026-01-01"), official)
    rows = got.collect()
    assert [(r.path, r.recommended, r.qualifying_functions, r.unknown_refs) for r in rows] == [("a.py", True, 1, []), ("b.py", False, 1, ["lib.gone", "lib.gone.w"])]
    assert rows[0].local_path == "o__good/a.py"
    assert {r.repo: r.reason for r in away.collect()} == {"o/fork": "fork", "o/gone": "licence NO-LICENSE"}


def test_official_examples_come_down_with_their_manifest(spark, tmp_path):
    config = Config(library="lib", version="1", root=str(tmp_path), politeness_seconds=0)
    package = {"info": {"project_urls": {"Source": "https://github.com/o/r"}, "license": " MIT "}}
    code = "import lib\n\ndef f():\n    return lib.core.weld()\n"
    client = fetch.FixtureFetcher({"pkg": package, "raw/examples/a.py": code, "raw/examples/é.py": code})
    tags = spark.createDataFrame([("v1",)], "tag string")
    tree = spark.createDataFrame([(f"examples/{n}",) for n in ("a.py", "é.py", "gone.py", "conftest.py", "sub/b.py")], "path string")
    source, got = pipelines.official_source(spark, config, client, "pkg", tags, tree, lambda s, name: f"raw/{s.path}/{name}")
    assert source.license == "MIT" and {r.path: r.fetched for r in got.collect()} == {"a.py": True, "é.py": True, "gone.py": False}
    rows, errors = pipelines.source_records(spark, config, spark.createDataFrame([("lib.core.weld",)], "name string"))
    found = {r.name: (r.source, r.license) for r in rows.collect()}
    assert found["official/a.py::f"] == ("https://github.com/o/r/blob/v1/examples/a.py#L3-L4", "MIT") and "official/é.py::f" in found and len(found) == 4
    blank = fetch.FixtureFetcher({"pkg": {"info": package["info"] | {"license": "  "}}})
    with pytest.raises(fetch.Unresolved, match="license"):
        pipelines.official_source(spark, config, blank, "pkg", tags, tree, lambda s, n: n)
    assert fetch.auth_headers("t")["Authorization"] == "Bearer t" and "Authorization" not in fetch.auth_headers()


def test_community_files_come_down_with_a_licence_each(spark, tmp_path):
    config = Config(library="lib", version="1", root=str(tmp_path), politeness_seconds=0)
    client = fetch.FixtureFetcher({"f/o/r/a.py": "import lib\nlib.core.weld()\n"})
    cols = "repo string, path string, branch string, local_path string, source string, license string, recommended boolean"
    rows = spark.createDataFrame([("o/r", "a.py", "main", "o__r/a.py", "page", "MIT", True), ("o/r", "b.py", "main", "o__r/b.py", "page", "MIT", False)], cols)
    got = pipelines.community_files(spark, config, rows, client, F.concat(F.lit("f/"), "repo", F.lit("/"), "path"))
    assert [(r.path, r.fetched) for r in got.collect()] == [("o__r/a.py", True)]
    made, _ = pipelines.source_records(spark, config, spark.createDataFrame([("lib.core.weld",)], "name string"))
    assert [(r.name, r.source, r.license) for r in made.collect()] == [("community/o__r/a.py", "page#L1-L2", "MIT")]


def test_explanations_are_kept_and_asked_for_once(spark, tmp_path):
    asked = tmp_path / "asked"

    def complete(system, user):
        with open(asked, "a") as f:
            f.write("x")
        if "Explain `b`" in user and asked.stat().st_size < 20:
            raise TimeoutError("slow")
        return "told"

    rows = spark.createDataFrame([(n, "function", None) for n in "abcdef"] + [("g", "class", "kept")], "name string, kind string, explanation string")
    config, table = Config(attempts=1, retry_seconds=0), f"file://{tmp_path}/explanations"
    first = {r.name: r.explanation for r in pipelines.explain_all(rows, complete, table, config, blocks=3).collect()}
    assert first == {n: "told" for n in "acdef"} | {"b": None, "g": "kept"} and asked.stat().st_size == 6
    asked.write_text("x" * 30)
    assert {r.explanation for r in pipelines.explain_all(rows, complete, table, config, blocks=3).collect()} == {"told", "kept"}
    assert asked.stat().st_size == 31  # only what had failed


def test_paths_do_not_depend_on_the_working_folder(tmp_path, monkeypatch):
    (tmp_path / "app").mkdir()
    monkeypatch.chdir("/")
    config = Config(library="lib", version="1", root="../data").anchored(str(tmp_path / "app" / "serve.py"))
    assert config.store_dir == f"{tmp_path}/data/lib_1/store"
    assert Config(root="/x").anchored("/y/z.py").root == "/x" and Config(root="hdfs://n/x").anchored("/y/z.py").root == "hdfs://n/x"


def test_summaries(spark):
    from cairn.operators import pycode

    files = spark.createDataFrame([("x", "a.py", "import lib\nlib.b.c()"), ("x", "b.py", "import os\nos.x()"), ("x", "c.py", "def (")], "prefix string, path string, content string")
    assert [r.path for r in pipelines.import_only(pycode.read_code(files, "lib")).collect()] == ["b.py"]
    rows = spark.createDataFrame([("k", "a"), ("k", "a"), ("l", "a"), ("k", "b")], "corpus string, name string")
    assert [tuple(r) for r in pipelines.duplicates(rows).collect()] == [("k", "a", 2)]
