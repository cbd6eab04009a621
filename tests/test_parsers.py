"""Goldens of the text, Markdown, code and signature parsers."""

import enum
import random
import types

from pyspark.sql import functions as F

from cairn.functions import text as tx
from cairn.operators import chunking, markdown, policy, pycode, signatures
from cairn.sources import introspect

MD = "<!--\nSPDX-License-Identifier: Apache-2.0\n-->\n# Tool\nIntro.\n\n## Install\n```sh\n# not a heading\npip install tool\n```\n## Empty\n### Deep\nBody <!-- note --> end."


def test_sections_of_a_file():
    s = markdown.sections(MD, "docs", "g.md")
    assert [(x["name"], x["heading_level"], x["source"], x["code"]) for x in s] == [
        ("docs/g::Tool", 1, "g.md#L4-L6", None),
        ("docs/g::Tool > Install", 2, "g.md#L7-L11", "# not a heading\npip install tool"),
        ("docs/g::Tool > Empty > Deep", 3, "g.md#L13-L14", None),
    ]
    assert s[2]["section_text"] == "Body  end." and {x["license"] for x in s} == {"Apache-2.0"}
    assert markdown.sections(MD, "docs", "g.md", "leading")[2]["section_text"] == "Body <!-- note --> end."


def test_section_quirks():
    assert markdown.sections("<!-- SPDX-License-Identifier: MIT -->\n# A ##\nx", "p", "d/a.md")[0]["license"] == "MIT -->"
    assert markdown.sections("# A ##\nx", "p", "d/a.md")[0]["heading_path"] == ["A ##"]
    assert markdown.sections("# A\n```\ncode", "p", "a.md")[0]["code"] == "code"
    assert markdown.sections("# A\n````\nx\n~~~\ny\n```\nz", "p", "a.md")[0]["code"] == "x\ny"
    assert markdown.sections("no heading", "p", "a.md") == [] and markdown.sections("# only", "p", "a.md") == []
    assert [x["heading_path"] for x in markdown.sections("### c\n1\n# a\n2\n## b\n3\n## d\n4", "p", "a.md")] == [["c"], ["a"], ["a", "b"], ["a", "d"]]


CODE = """import lib
import lib.sub as ls
from lib import log, Cam

def a():
    c = lib.Cam.make(1)
    lib.run(c)
    return log.info("x")

def b():
    return 1

@deco
def c():
    ls.gone()
    Cam()

if __name__ == "__main__":
    a()
"""


def files(spark, *rows):
    return spark.createDataFrame([("x", p, t) for p, t in rows], "prefix string, path string, content string")


def names(spark, *ns):
    return spark.createDataFrame([(n,) for n in ns], "name string")


def test_code_records(spark):
    known = names(spark, "lib", "lib.Cam", "lib.Cam.make", "lib.run", "lib.log")
    manifest = spark.createDataFrame([("x", "p.py", "U", "MIT")], "prefix string, path string, url string, license string")
    made, errors = pycode.code_records(files(spark, ("p.py", CODE), ("bad.py", "def ("), ("none.py", None)), "lib", known, manifest)
    got = {r.name: r for r in made.collect()}
    used = ["lib.Cam.make", "lib.log", "lib.run"]
    assert {n: (r.source, r.apis_used, r.unknown_refs) for n, r in got.items()} == {
        "x/p.py::a": ("U#L5-L8", used, None),
        "x/p.py::c": ("U#L13-L16", [], ["lib.sub.gone"]),
        "x/p.py": ("U#L1-L19", used, ["lib.sub.gone"]),
    }
    assert got["x/p.py::c"].code.startswith("@deco") and got["x/p.py"].license == "MIT"
    assert "def a" not in got["x/p.py"].code
    assert [r.path for r in errors.collect()] == ["bad.py"]


def test_file_scores(spark):
    known = names(spark, "lib", "lib.Cam", "lib.Cam.make", "lib.run", "lib.log")
    rows = pycode.file_scores(files(spark, ("p.py", CODE), ("q.py", "import lib\nlib.zz.y()")), "lib", known).collect()
    assert [(r.path, r.max_apis_in_function, r.qualifying_functions, r.n_unknown, r.lines) for r in rows] == [("p.py", 3, 1, 1, 19)]


def test_relative_imports_count_and_bare_names_do_not():
    import ast

    assert pycode.import_aliases(ast.parse("from .lib import x\nimport other"), "lib") == {"x": "lib.x"}
    assert pycode.references(ast.parse("Cam()"), {"Cam": "lib.Cam"}) == []
    assert pycode.references(ast.parse("lib.A.b"), {"lib": "lib"}) == ["lib.A", "lib.A.b"]


def test_parameters():
    p = signatures.parameters("(self, a: int, b: List[Tuple[int, str]] = [], *, key='x', **kwargs) -> None")
    assert [(x["name"], x["type"], x["required"], x["default"]) for x in p] == [("a", "int", True, None), ("b", "List[Tuple[int, str]]", False, "[]"), ("key", None, False, "'x'"), ("**kwargs", None, False, None)]
    assert [x["name"] for x in signatures.parameters("(sep=',')")] == ["sep", "'"]
    assert signatures.parameters("f(a") == [] and signatures.parameters("") == [] and signatures.parameters("(/, *, *args)")[0]["name"] == "*args"


def test_doc_and_overloads(spark):
    doc = "run(x)\n\nRuns it.\n1. run(x: int)\nRuns it.\nMore."
    df = spark.createDataFrame([(doc,), (None,)], "d string").select(signatures.prose(F.lit("method"), F.col("d")).alias("p"), signatures.overload_signatures(F.col("d")).alias("o"), signatures.property_type(F.lit("Focal length (float, default: 1.5)")).alias("t"), signatures.property_default(F.lit("Focal length (float, default: 1.5)")).alias("v"))
    a, b = df.collect()
    assert (a.p, a.o, a.t, a.v) == ("Runs it.\nMore.", ["run(x: int)"], "float", "1.5")
    assert (b.p, b.o) == (None, None)


def test_kwargs_become_properties(spark):
    rows = [("L.C.__init__", "method", ["(self, **kwargs)"], None), ("L.C.b", "property", ["B (int, default: 2)"], True), ("L.C.a", "property", ["A"], True), ("L.C.r", "property", ["R"], False), ("L.D.__init__", "method", ["(self, **kwargs)"], None)]
    out = signatures.with_parameters(spark.createDataFrame(rows, "name string, kind string, signatures array<string>, writable boolean"))
    got = {r.name: [p.name for p in r.parameters[0]] for r in out.where("kind = 'method'").collect()}
    assert got == {"L.C.__init__": ["a", "b"], "L.D.__init__": ["**kwargs"]}


def test_introspection(spark):
    lib = types.ModuleType("lib")

    class Color(enum.Enum):
        RED = 1

    class Cam:
        @property
        def size(self):
            """Size (int, default: 3)"""

        def run(self, x: int = 1):
            """run(x)

            Runs."""

    for c in (Color, Cam):
        c.__module__ = "lib"
    lib.Color, lib.Cam, lib.Again, lib.LIMIT, lib._hidden, lib.NOTHING = Color, Cam, Cam, 5, 1, None
    rows = {n: (k, introspect.describe(n, k, o)) for n, k, o in introspect.members(lib, "lib")}
    # the class is entered under the first of its names
    assert rows["lib"][0] == "module" and rows["lib.Again.run"][0] == "method" and rows["lib.Again.size"][0] == "property"
    assert "lib._hidden" not in rows and rows["lib.LIMIT"][1][7:] == ("int", "5") and rows["lib.NOTHING"][1][7:] == (None, None)
    assert rows["lib.Color.RED"][0] == "enum_member" and rows["lib.Color.RED"][1][6] == "lib.Color"
    assert rows["lib.Cam"][0] == "class" and "lib.Cam.run" not in rows
    spark.dataSource.register(introspect.LibraryApi)
    df = spark.read.format("library_api").option("library", "colorsys").load()
    assert df.where("name = 'colorsys.rgb_to_hsv' and kind = 'function'").count() == 1


def test_split_golden():
    lines = ["x" * 250 for _ in range(10)]
    assert [p.count("\n") + 1 for p in chunking.split_text("\n".join(lines), 2000)] == [7, 2, 1]
    assert chunking.split_text(" short ", 2000) == [" short "] and chunking.split_text("y" * 5000, 2000) == ["y" * 5000]


def test_split_properties():
    rng = random.Random(3)
    for _ in range(200):
        text = "".join(rng.choice(["word ", "\n", "\n\n", "# h\n", "- i\n", "```\n", "| c |\n", "\r\n", "\x0b", " ", "   z\n"]) for _ in range(rng.randrange(0, 120)))
        pieces = chunking.cut_lines(text, 60)
        assert "".join(pieces) == text
        assert all(len(p) <= 60 or len(p.splitlines()) == 1 for p in pieces)
        assert "".join(chunking.merge_small(pieces, 60)) == text


def test_text_functions(spark):
    ws = [chr(c) for c in [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, 0x2003, 0x2028, 0x3000]]
    df = spark.createDataFrame([(w + "a" + w,) for w in ws], "s string")
    assert {r[0] for r in df.select(tx.strip(F.col("s"))).collect()} == {"a"}
    md = spark.createDataFrame([("See [Op](#op).\n|a|\n|--|\n\n\n\n|b|",)], "s string")
    assert md.select(tx.clean_markdown(F.col("s"))).collect()[0][0] == "See Op.\n|a|\n\n|b|"


def test_policies(spark):
    rec = names(spark, "a", "a.jit", "a.jit.trace", "a.jitter", None)
    p = policy.prefix_frame(rec, ["a.jit", "a.zzz"])
    assert sorted(r.name or "" for r in policy.by_prefix(rec, p, "exclude").collect()) == ["", "a", "a.jitter"]
    assert sorted(r.name for r in policy.by_prefix(rec, p, "keep").collect()) == ["a.jit", "a.jit.trace"]
    assert {r.prefix: r.n for r in policy.prefix_counts(rec, p).collect()} == {"a.jit": 2, "a.zzz": 0}
    assert "BroadcastNestedLoopJoin" not in policy.by_prefix(rec, p)._jdf.queryExecution().executedPlan().toString()
    assert policy.load_prefixes("A = ['x', 'y']\nB = ('y', 'z')\nC = f()\nD = 3\nA += ['no']") == ["x", "y", "z"]
    _, report = policy.filter_records(rec, p, dry_run=True)
    assert report["dropped"] == 2 and not report["changed"]
    try:
        policy.filter_records(rec, policy.prefix_frame(rec, ["none"]), "keep")
        raise AssertionError("an empty result must be refused")
    except ValueError:
        pass


def test_repo_prefilter(spark):
    rows = [(True, "MIT", 0, None), (False, "NOASSERTION", 999, "2025-06-01"), (False, "MIT", 199, "2025-06-01"), (False, "MIT", 200, "2024-01-01"), (False, "MIT", 200, "2024-01-02"), (False, "MIT", 200, "")]
    df = spark.createDataFrame(rows, "f boolean, l string, s int, p string")
    got = [r[0] for r in df.select(policy.prefilter_reason(F.col("f"), F.col("l"), F.col("s"), F.col("p"), F.lit("2026-01-01"))).collect()]
    assert got == ["fork", "licence NOASSERTION", "199 stars", "stale since 2024-01-01", None, None]


def test_prefix_minimal_and_refs(spark):
    df = spark.createDataFrame([(["a.b", "a.b.c", "a.bc"],)], "x array<string>")
    assert df.select(policy.prefix_minimal(F.col("x"))).collect()[0][0] == ["a.b.c", "a.bc"]
    tags = spark.createDataFrame([("v1.0",), ("2.0",), ("v2.0",)], "tag string")
    assert [r.tag for r in policy.resolve_ref("1.0", tags).collect()] == ["v1.0"]
    assert [r.tag for r in policy.resolve_ref("2.0", tags).collect()] == ["2.0"]
    assert policy.resolve_ref("9", tags).count() == 0


def test_sections_of_doc_files(spark, tmp_path):
    from cairn.plans import catalog

    texts = ["plain", None, " \n", "a\r\n```py\nx = 1\r\n# no heading\n```\nb\r## Inner ##\ninside", "~~~\n```\ny\n~~~\n\n# Next\n```\nopen\n# still code", "<!-- c\n# gone\n-->\nrest"]
    paths = [["A"], ["A", "B"], [], ["A", "B", "C"], None, ["A", "B"]]
    rows = list(enumerate(zip(paths, texts)))
    spark.createDataFrame([(i, p, t) for i, (p, t) in rows], "rec_id bigint, heading_path array<string>, section_text string").write.parquet(f"{tmp_path}/doc_sections.parquet")
    want = []
    for i, (p, t) in rows:  # line by line
        text = "\n".join(["#" * (k + 1) + " " + h for k, h in enumerate(p or [])] + [t or ""]).replace("<!-- c\n# gone\n-->", "\n\n")
        lines, open_titles, fence, found = text.splitlines(), [], None, []
        for k, line in enumerate(lines, 1):
            head = len(line) - len(line.lstrip("#"))
            if fence is None and head and line[head : head + 1] == " ":
                open_titles = [x for x in open_titles if x[0] < head] + [(head, line[head:].strip())]
                found.append([list(open_titles), k, k, [], []])
                continue
            mark = line[:3] if line[:3] in ("```", "~~~") else None
            if found:
                found[-1][2] = k
                found[-1][3].append(line)
                if mark is None and fence:
                    found[-1][4].append(line)
            fence = mark if mark and fence is None else None if mark == fence else fence
        for titles, first, end, body, code in found:
            if "\n".join(body).strip():
                path = " > ".join(x for _, x in titles)
                want.append((f"doc/{i}::{path}", path, titles[-1][0], "\n".join(body).strip(), f"d/{i}.md#L{first}-L{end}", "\n".join(code) or None, None))
    got = [tuple(r) for r in catalog.sections_from_doc_files(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and len(want) >= 5


def test_values_as_python_prints_them(spark):
    import json

    from cairn.functions import fields

    values = [True, False, None, 1, -2.5, "auto", "it's", 'say "x"', "true null", [1, 2], ["a", "it's", 'b"', None, True], {"k": [1.5, "null"], "é": {"z": "a\\b"}}, [], {}, ""]
    df = spark.createDataFrame([(i, json.dumps(v, ensure_ascii=False)) for i, v in enumerate(values)] + [(99, None)], "i int, value string")
    got = {r.i: r.f for r in df.select("i", fields.field("value").alias("f")).collect()}
    assert got == {i: f"value: {v}" for i, v in enumerate(values)} | {99: None}


def test_policy_files_keep_each_string(spark):
    source = "import x\nA = ['a', x, 'b', *more]\nB = ('c', 'a')\nC = 'no'\nD = [1]\ndef f():\n    E = ['no']\n"
    assert policy.load_prefixes(source) == ["a", "b", "c"]


def test_long_docstrings_keep_their_lines(spark):
    doc = "f(x)\n" + "\n".join(f"line {i}" for i in range(3000))
    out = spark.createDataFrame([(doc,), ("",), ("f(x)",)], "d string").select(signatures.prose(F.lit("method"), F.col("d")).alias("p")).collect()
    assert out[0].p.count("\n") == 2999 and out[1].p is None and out[2].p is None
