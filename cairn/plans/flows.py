"""Queries of whole flows: policies, fetching, explaining, embedding, serving and reports, each with the SQL that must agree.

Clients are fixtures made of the API records, which are as many at every scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.config import Config
from cairn.operators import chunking, enrich, policy, search
from cairn.plans import pipelines
from cairn.plans.catalog import _KEYWORDS, _NEAR, _RECIPES, _RECORDS, LIBRARY, PREFIXES, _api_names, _vectors, all_records, table
from cairn.runtime import materialise, scratch
from cairn.sources import fetch, files
from cairn.sources import records as rec

_POLICY = "import os\nCORE = ['tessarine.core', os.name, 'tessarine.view']\nOTHER = ('tessarine.fit.FlatChannel', 'tessarine.none', *CORE, 'tessarine.core')\nNOTE = 'tessarine'\n"
_POLICY_PREFIXES = ("tessarine.core", "tessarine.view", "tessarine.fit.FlatChannel", "tessarine.none")


def prefix_policy_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a policy file that holds more than literals leaves of the API."""
    api = table(spark, sf_dir, "api_records").select("rec_id", "name")
    return policy.by_prefix(api, policy.prefix_frame(api, policy.load_prefixes(_POLICY)), "exclude")


def filter_report(spark, sf_dir):
    api = table(spark, sf_dir, "api_records").select("rec_id", "name")
    prefixes = policy.prefix_frame(api, PREFIXES)
    found = []
    for mode, dry in (("exclude", False), ("keep", True)):
        kept, told = policy.filter_records(api, prefixes, mode, dry)
        found.append((mode, told["before"], told["after"], told["dropped"], told["changed"], kept.count()))
    try:
        policy.filter_records(api, policy.prefix_frame(api, ["nothing"]), "keep")
    except ValueError:
        found.append(("refused", None, None, None, None, None))
    return spark.createDataFrame(found, "mode string, before bigint, after bigint, dropped bigint, changed boolean, kept bigint")


def not_ingested(spark, sf_dir):
    """The paths of code files that don't lie in the scripts or the tools of their repository."""
    paths = table(spark, sf_dir, "code_records").where("name is not null").select(F.split_part("name", F.lit("/"), F.lit(1)).alias("repo"), F.expr("substring(substring_index(name, '::', 1), length(split_part(name, '/', 1)) + 2)").alias("path")).distinct()
    official = paths.select("repo").distinct().select("repo", F.explode(F.array(F.lit("scripts"), F.lit("tools"))).alias("dir"))
    return policy.not_ingested(paths, official)


def version_refs(spark, sf_dir):
    tags = table(spark, sf_dir, "part").select(F.concat(F.when(F.col("p_size") % 2 == 0, F.lit("v")).otherwise(F.lit("")), F.col("p_size").cast("string")).alias("tag"))
    rows = [policy.resolve_ref(v, tags).withColumn("version", F.lit(v)) for v in ("7", "8", "0")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def repo_urls(spark, sf_dir):
    """The repositories that sources name, and where a file of theirs would lie."""
    code = table(spark, sf_dir, "code_records").where("source is not null")
    repo = fetch.repo_of_url(F.regexp_replace("source", r"^https?://[^/]+/", "https://github.com/"))
    return code.select("rec_id", repo.alias("repo"), files.local_path(repo, F.lit("a/b.py")).alias("local"))


def repo_files(spark, sf_dir):
    code = table(spark, sf_dir, "code_records").where("name is not null")
    hits = code.select(F.split_part("name", F.lit("/"), F.lit(1)).alias("repo"), F.coalesce("license", F.lit("main")).alias("branch"), F.substring_index("name", "::", 1).alias("path"))
    return fetch.repo_files(hits).select("repo", "branch", F.md5(F.array_join("paths", ",")).alias("paths_md5"), F.size("paths").alias("n"))


def record_summary(spark, sf_dir):
    return pipelines.summary(all_records(spark, sf_dir)).select("corpus", "kind", "n", "n_unknown", F.array_join("licenses", ",").alias("licenses"))


def name_duplicates(spark, sf_dir):
    return pipelines.duplicates(all_records(spark, sf_dir))


def invalidation_head(spark, sf_dir):
    """The report of an invalidation: how many, the first names, how many more."""
    told = pipelines.invalidation_report(all_records(spark, sf_dir), ["signatures"], shown=7)
    return spark.createDataFrame([(told["invalidated"], ",".join(told["names"]), told["more"])], "n bigint, names string, more bigint")


def explained_records(spark, sf_dir):
    """Every pending API record through a client that repeats the last line of its prompt; the answers are kept in a table and joined back."""
    rows = all_records(spark, sf_dir).where("corpus = 'api'")
    full = pipelines.explain_all(rows, lambda system, user: "told: " + user.splitlines()[-1], scratch(spark, "explanations"), Config(retry_seconds=0), blocks=2)
    return full.select("rec_id", F.md5("explanation").alias("explanation_md5"))


def embedded_lengths(spark, sf_dir):
    """The chunk texts through a model whose vectors are their lengths; it fails for batches that have a text of another kind, which none has."""
    rows = chunking.recipe_rows(all_records(spark, sf_dir)).select("record_id", "chunk_type", "text")
    out = enrich.embed(rows, lambda texts: [[float(len(t)), 1.0] for t in texts], first_pause=0)
    return out.groupBy("chunk_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.element_at("embedding", 1)).cast("bigint").alias("chars"), F.sum(F.size("embedding")).alias("numbers"))


def _first_vector(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").where("vec_id = 0").select("embedding").collect()[0][0]


def knn_clamped(spark, sf_dir):
    """The serving path with k below and above what is allowed."""
    first, vectors = _first_vector(spark, sf_dir), _vectors(spark, sf_dir)
    rows = [search.search(vectors, first, k).select(F.lit(k).alias("k"), "record_id", F.round("distance", 6).alias("distance")) for k in (0, 3, 99)]
    return rows[0].unionAll(rows[1]).unionAll(rows[2])


def served_hits(spark, sf_dir):
    """What the serving call answers, the query being embedded by a client."""
    first = _first_vector(spark, sf_dir)
    hits = search.serve(_vectors(spark, sf_dir), lambda text: first if text == "grid" else None, "grid", 4)
    return spark.createDataFrame([(h["record_id"], h["matched_chunk_type"], round(h["distance"], 6), h["text"]) for h in hits], "record_id string, matched_chunk_type string, distance double, text string")


def record_files(spark, sf_dir):
    """The API records as one file, found by its folder and named by its file."""
    home = scratch(spark, "raw")
    api = rec.align(table(spark, sf_dir, "api_records"), "name string, kind string, doc string, value string, explanation string")
    lines = api.select(F.to_json(F.struct(*api.columns)).alias("line")).agg(F.array_join(F.collect_list("line"), "\n").alias("content"))  # as many as there are at every scale
    materialise(fetch.write_files(lines.select(F.lit("api.jsonl").alias("path"), "content"), home), "written")
    return rec.read_jsonl(spark, home).select("name", "kind", "corpus", F.md5(F.coalesce("doc", F.lit("-"))).alias("doc_md5"), "value", "explanation")


def introspected(spark, sf_dir):
    """A small library of the standard library as API records."""
    out = pipelines.api_records(spark, "colorsys", exclude=["colorsys.TWO_THIRD"])
    return out.select("name", "kind", F.array_join(F.transform(F.flatten("parameters"), lambda p: p.getField("name")), ",").alias("parameters"), "type", "corpus")


def _fixture(spark, sf_dir):
    return [(r.name.split(".")[1], f"{r.kind}/{r.rec_id}.py", r.name) for r in _api_names(spark, sf_dir).collect()]


def community_flow(spark, sf_dir):
    """A repository per module and a file per name, from the pages of a code search to the ranked candidates and the repositories turned away."""
    rows = _fixture(spark, sf_dir)
    answers: dict[str, object] = {f"f/o/{m}/{p}": f"import tessarine\ndef f():\n    {name}()\n" for m, p, name in rows}
    for m in {m for m, _, _ in rows}:
        answers[f"m/o/{m}"] = {"stargazers_count": 50 * sum(x == m for x, _, _ in rows), "license": {"spdx_id": "GPL-3.0" if len(m) % 2 else "MIT"}, "pushed_at": "2025-01-01T10:00:00Z", "fork": False}
    answers |= {f"p{k + 1}": [{"repo": f"o/{m}", "branch": "main", "path": p} for m, p, _ in rows[100 * k : 100 * k + 100]] for k in range(20)}
    client = fetch.FixtureFetcher(answers)
    config = Config(library=LIBRARY, politeness_seconds=0, min_apis_per_function=1)
    hits = fetch.search_results(spark, client, lambda n: f"p{n}", 20)
    got, away = pipelines.community_candidates(spark, config, _api_names(spark, sf_dir), hits, client, lambda r: f"m/{r}", F.concat(F.lit("f/"), "repo", F.lit("/"), "path"), F.lit("2025-06-01"))
    out = got.select("repo", "path", "local_path", "license", "recommended", F.array_join("apis_used", ",").alias("apis_used"), F.array_join("unknown_refs", ",").alias("unknown_refs"), "lines", F.lit(None).cast("string").alias("reason"))
    return out.unionByName(away.select("repo", "reason"), allowMissingColumns=True)


def official_flow(spark, sf_dir):
    """The examples of the library's own repository, resolved, downloaded with their manifest and taken apart."""
    rows = [(f"examples/{p.replace('/', '_')}", name) for _, p, name in _fixture(spark, sf_dir)]
    client = fetch.FixtureFetcher({"pkg": {"info": {"project_urls": {"Docs": "https://x.org", "source": "https://github.com/o/r.git"}, "license": "ISC"}}} | {f"raw/{p}": f"import tessarine\n{name}()\n" for p, name in rows})
    config = Config(library=LIBRARY, version="2", root=scratch(spark, "official"), politeness_seconds=0)
    tree = spark.createDataFrame([(p,) for p, _ in rows] + [("demo/x.py",), ("examples/conftest.py",), ("examples/deep/y.py",)], "path string")
    pipelines.official_source(spark, config, client, "pkg", spark.createDataFrame([("v2",), ("v1",)], "tag string"), tree, lambda s, name: f"raw/{s.path}/{name}")
    made, _ = pipelines.source_records(spark, config, _api_names(spark, sf_dir))
    return made.select("name", "kind", "source", "license", F.array_join("apis_used", ",").alias("apis_used"), "code", "corpus")


QUERIES = {
    f.__name__: f
    for f in (
        prefix_policy_file, filter_report, not_ingested, version_refs, repo_urls, repo_files, record_summary, name_duplicates, invalidation_head, explained_records, embedded_lengths,
        knn_clamped, served_hits, record_files, introspected, community_flow, official_flow,
    )
}

_R = _RECORDS.rstrip().rstrip(",")


def _below(prefixes) -> str:
    return "exists (select 1 from (values " + ", ".join(f"('{p}')" for p in dict.fromkeys(prefixes)) + ") p(prefix) where a.name = p.prefix or starts_with(a.name, p.prefix || '.'))"


#: API names with whether they can be spelled, and the inner parts of each that no known name of two parts or more is above.
_SPELLED = f"""with a as (select rec_id, name, kind, split_part(name, '.', 2) as module, regexp_matches(name, '{_KEYWORDS}') as broken from api_records where starts_with(name, 'tessarine.')),
  p as (select rec_id, unnest(list_transform(range(2, len(string_split(name, '.')) + 1), lambda i: array_to_string(string_split(name, '.')[1:i], '.'))) as ref from a),
  k as (select p.rec_id, p.ref, count(b.name) as n from p left join (select distinct name from a) b on p.ref = b.name or starts_with(p.ref, b.name || '.') group by all),
  u as (select rec_id, coalesce(string_agg(ref, ',' order by ref) filter (n = 0), '') as lost from k group by 1)"""
_HIT = _NEAR + ", b as (select s.record_id, min(list_cosine_distance(s.e, q.e)) as x from s, (select e from s where vec_id = 0) q group by 1), o as (select *, row_number() over (order by x, record_id) as n from b)"

SQL = {
    "prefix_policy_file": f"select a.rec_id, a.name from api_records a where not coalesce({_below(_POLICY_PREFIXES)}, false)",
    "filter_report": f"""with t as (select count(*) as n, count(*) filter ({_below(PREFIXES)}) as hit from api_records a)
  select 'exclude' as mode, n as before, n - hit as after, hit as dropped, hit > 0 as changed, n - hit as kept from t
  union all select 'keep', n, hit, n - hit, false, n from t union all select 'refused', null, null, null, null, null""",
    "not_ingested": "with f as (select distinct split_part(name, '/', 1) as repo, substr(split_part(name, '::', 1), length(split_part(name, '/', 1)) + 2) as path from code_records where name is not null) select * from f where not starts_with(path, 'scripts/') and not starts_with(path, 'tools/')",
    "version_refs": "with t as (select distinct case when p_size % 2 = 0 then 'v' else '' end || p_size as tag from part) select tag, '7' as version from t where tag = '7' union all select tag, '8' from t where tag = 'v8'",
    "repo_urls": r"with r as (select rec_id, nullif(regexp_replace(regexp_extract(source, '^https?://[^/]+/([^/\s]+/[^/\s#?]+)', 1), '\.git$', ''), '') as repo from code_records where source is not null) select rec_id, repo, replace(repo, '/', '__') || '/a/b.py' as local from r",
    "repo_files": "with h as (select split_part(name, '/', 1) as repo, coalesce(license, 'main') as branch, split_part(name, '::', 1) as path from code_records where name is not null and ends_with(split_part(name, '::', 1), '.py')) select repo, min(branch) as branch, md5(array_to_string(list_sort(list_distinct(list(path))), ',')) as paths_md5, count(distinct path)::int as n from h group by 1",
    "record_summary": _R + " select corpus, kind, count(*) as n, count(*) filter (len(unknown_refs) > 0) as n_unknown, coalesce(array_to_string(list_sort(list_distinct(list(license))), ','), '') as licenses from r group by 1, 2",
    "name_duplicates": _R + " select corpus, name, count(*) as n from r group by 1, 2 having count(*) > 1",
    "invalidation_head": _R + ", h as (select name, row_number() over (order by name) as k from r where len(signatures) > 0 and coalesce(explanation, '') <> '') select count(*) as n, string_agg(name, ',' order by name) filter (k <= 7) as names, greatest(count(*) - 7, 0) as more from h",
    "explained_records": "with x as (select name, min('told: Explain `' || name || '`.') as made from api_records where coalesce(explanation, '') = '' group by 1) select a.rec_id, md5(coalesce(nullif(a.explanation, ''), x.made)) as explanation_md5 from api_records a left join x using (name)",
    "embedded_lengths": _RECIPES + " select chunk_type, count(*) as n, sum(length(text))::bigint as chars, (2 * count(*))::bigint as numbers from c group by 1",
    "knn_clamped": _HIT + " select k::int as k, record_id, round(x, 6) as distance from o, (values (0, 1), (3, 3), (99, 5)) v(k, most) where n <= most",
    "served_hits": _HIT + ", d as (select record_id, 'v' || vec_id as id, vec_id::varchar as text, list_cosine_distance(s.e, q.e) as x from s, (select e from s where vec_id = 0) q) select o.record_id, 'example' as matched_chunk_type, round(o.x, 6) as distance, (select text from d where d.record_id = o.record_id order by d.x, d.id limit 1) as text from o where n <= 4",
    "record_files": "select name, kind, 'api' as corpus, md5(coalesce(doc, '-')) as doc_md5, value, explanation from api_records",
    "introspected": """select * from (values ('colorsys', 'module', '', null, 'api'), ('colorsys.ONE_SIXTH', 'constant', '', 'float', 'api'), ('colorsys.ONE_THIRD', 'constant', '', 'float', 'api'),
    ('colorsys.hls_to_rgb', 'function', 'h,l,s', null, 'api'), ('colorsys.hsv_to_rgb', 'function', 'h,s,v', null, 'api'), ('colorsys.rgb_to_hls', 'function', 'r,g,b', null, 'api'),
    ('colorsys.rgb_to_hsv', 'function', 'r,g,b', null, 'api'), ('colorsys.rgb_to_yiq', 'function', 'r,g,b', null, 'api'), ('colorsys.yiq_to_rgb', 'function', 'y,i,q', null, 'api')) v(name, kind, parameters, type, corpus)""",
    "community_flow": _SPELLED + """, m as (select module, 50 * count(*) as stars from a group by 1),
  j as (select module, case when length(module) % 2 = 1 then 'licence GPL-3.0' when stars < 200 then stars || ' stars' end as reason from m)
  select 'o/' || module as repo, kind || '/' || rec_id || '.py' as path, 'o__' || module || '/' || kind || '/' || rec_id || '.py' as local_path, 'MIT' as license, lost = '' as recommended, name as apis_used, lost as unknown_refs, 3 as lines, null as reason
    from a join u using (rec_id) join j using (module) where reason is null and not broken
  union all select 'o/' || module, null, null, null, null, null, null, null, reason from j where reason is not null""",
    "official_flow": _SPELLED + """ select 'official/' || kind || '_' || rec_id || '.py' as name, 'example' as kind, 'https://github.com/o/r/blob/v2/examples/' || kind || '_' || rec_id || '.py#L1-L2' as source, 'ISC' as license, name as apis_used,
    'import tessarine' || chr(10) || name || '()' as code, 'official' as corpus from a where not broken""",
}
