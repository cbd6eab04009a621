"""Queries of the engine's own operators over the whole test tables, each with the SQL that must agree."""

from __future__ import annotations

import keyword

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.config import BOUNDARIES, EXAMPLE_DIRS, LICENSES, RECIPES
from cairn.functions import fields as fl
from cairn.functions import text as tx
from cairn.operators import chunking, enrich, markdown, policy, pycode, search, signatures, store
from cairn.runtime import materialise, scratch
from cairn.schema import RECORD
from cairn.sources import fetch, files
from cairn.sources import records as rec
from cairn.streaming import ingest

LIMIT = 2000
#: The policy that the prefix queries apply.
PREFIXES = ("tessarine.core", "tessarine.view", "tessarine.fit.FlatChannel", "tessarine.none", "tessarine.core.LowerBridge")
LIBRARY = "tessarine"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def all_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    api = table(spark, sf_dir, "api_records").withColumn("corpus", F.lit("api"))
    return rec.union_all([rec.align(df, "rec_id bigint, " + RECORD) for df in (api, table(spark, sf_dir, "code_records"), table(spark, sf_dir, "doc_sections"))])


# ---------------------------------------------------------------- fields and chunks


def field_render(spark, sf_dir):
    names = ("kind", "heading_path", "source", "license", "signatures", "parameter_names", "apis_used", "enum_members", "enum_of", "value")
    return all_records(spark, sf_dir).select("rec_id", *[fl.field(n).alias(f"f_{n}") for n in names], F.md5(F.coalesce(fl.build_text(["name", "doc", "explanation", "code", "section_text"]), F.lit("-"))).alias("text_md5"))


def recipe_gate_counts(spark, sf_dir):
    return chunking.recipe_rows(all_records(spark, sf_dir)).groupBy("chunk_type").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


def recipe_rows(spark, sf_dir):
    return chunking.recipe_rows(all_records(spark, sf_dir)).select("record_id", "chunk_type", F.md5("text").alias("text_md5"), F.md5("return_text").alias("return_md5"), "corpus")


def clean_markdown(spark, sf_dir):
    return table(spark, sf_dir, "doc_sections").where("section_text is not null").select("rec_id", F.md5(tx.clean_markdown(F.col("section_text"))).alias("cleaned_md5"))


def chunk_split_premerge(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.posexplode(chunking.cut_pieces(F.col("text"), LIMIT)).alias("part", "piece")).select("doc_id", F.col("part").cast("int").alias("part"), F.length("piece").alias("chars"), F.md5("piece").alias("piece_md5"))


def chunk_split(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("text is not null")
    return docs.select("doc_id", F.posexplode(chunking.split_pieces(F.col("text"), LIMIT)).alias("part", "piece")).select("doc_id", F.col("part").cast("int").alias("part"), F.length("piece").alias("chars"), F.md5("piece").alias("piece_md5"))


def build_chunks(spark, sf_dir):
    """All chunks of all records, keyed and hashed."""
    return store.keyed(chunking.build_chunks(all_records(spark, sf_dir))).select("chunk_id", "record_id", "chunk_type", "part", "text_hash", "corpus")


# ---------------------------------------------------------------- store


def chunk_ids_hashes(spark, sf_dir):
    from cairn.functions.hashing import stored_document

    return store.keyed(table(spark, sf_dir, "chunks")).select("chunk_seq", "chunk_id", "text_hash", F.md5(stored_document(F.col("text"), F.col("return_text"))).alias("document_md5"))


def _old_and_new(spark, sf_dir):
    rows = store.keyed(table(spark, sf_dir, "chunks"))
    new = store.last_of(rows.select("chunk_id", "record_id", "chunk_type", "text_hash", "chunk_seq", "parsed_at"), ["parsed_at", "chunk_seq"])
    # the snapshot of before: a fifth of the chunks wasn't there, a seventh had another hash
    old = new.where("chunk_seq % 5 <> 0").withColumn("text_hash", F.when(F.col("chunk_seq") % 7 == 0, F.sha2("text_hash", 256)).otherwise(F.col("text_hash")))
    return old, new


def incremental_pending(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    return store.pending(new, old).select("chunk_id", "text_hash")


def upsert_result(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    cols = ["chunk_id", "record_id", "chunk_type", "text_hash"]
    return store.upserted(old.select(cols), store.pending(new, old).select(cols))


def store_count(spark, sf_dir):
    old, new = _old_and_new(spark, sf_dir)
    cols = ["chunk_id", "text_hash"]
    return store.upserted(old.select(cols), store.pending(new, old).select(cols)).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("chunk_id").alias("n_ids"))


def stream_ingest(spark, sf_dir):
    """The chunks as a stream into a vector store, and what the store then holds."""
    home = scratch(spark, "stream")
    vectors = store.VectorStore.create(spark, home, dim=64)
    # four arrivals; all deliveries of a record arrive together
    source = table(spark, sf_dir, "chunks")
    source.repartition(4, "record_id").write.parquet(f"{home}/arrivals")
    stream = ingest.record_stream(spark, f"{home}/arrivals", source.schema, "parquet", files_per_batch=1)
    model = enrich.HashEmbedder()
    query = ingest.load_stream(stream, vectors, lambda rows: enrich.embed(rows, model), f"{home}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return vectors.read().select("chunk_id", "record_id", "chunk_type", "text_hash", F.size("embedding").alias("dim"))


def jsonl_roundtrip(spark, sf_dir):
    """All records written as JSON lines and read again."""
    home = scratch(spark, "jsonl")
    rec.write_jsonl(all_records(spark, sf_dir), home)
    back = rec.read_jsonl(spark, home, "rec_id bigint, " + RECORD)
    return back.select("rec_id", "name", "kind", F.size(F.flatten("parameters")).alias("n_parameters"), F.md5(F.coalesce("section_text", "code", "doc", F.lit("-"))).alias("text_md5"), F.array_join("heading_path", " > ").alias("path"), "corpus")


# ---------------------------------------------------------------- policies


def _prefixes(spark, sf_dir):
    api = table(spark, sf_dir, "api_records").select("rec_id", "name")
    return api, policy.prefix_frame(api, PREFIXES)


def prefix_exclude(spark, sf_dir):
    return policy.by_prefix(*_prefixes(spark, sf_dir), "exclude")


def prefix_keep(spark, sf_dir):
    return policy.by_prefix(*_prefixes(spark, sf_dir), "keep")


def prefix_counts(spark, sf_dir):
    return policy.prefix_counts(*_prefixes(spark, sf_dir))


def public_names(spark, sf_dir):
    api = table(spark, sf_dir, "api_records")
    return api.select("rec_id", policy.is_public(F.regexp_extract("name", r"[^.]*$", 0)).alias("public"))


def _refs(spark, sf_dir):
    code = table(spark, sf_dir, "code_records")
    return code.select("rec_id", F.explode(F.concat(F.coalesce("apis_used", F.array().cast("array<string>")), F.coalesce("unknown_refs", F.array().cast("array<string>")))).alias("ref"))


def longest_prefix_refs(spark, sf_dir):
    return policy.longest_known(_refs(spark, sf_dir), table(spark, sf_dir, "api_records"))


def reference_sets(spark, sf_dir):
    """Per record its references resolved, the most specific of the used ones kept."""
    rows = _refs(spark, sf_dir).groupBy("rec_id").agg(F.collect_set("ref").alias("refs"))
    out = pycode.resolved(rows, ["rec_id"], table(spark, sf_dir, "api_records"))
    return out.select("rec_id", F.array_join("apis_used", ",").alias("apis_used"), F.array_join("unknown_refs", ",").alias("unknown_refs"))


def license_allow(spark, sf_dir):
    code = table(spark, sf_dir, "code_records")
    licence = tx.normal_license(F.col("license"))
    return code.select("rec_id", licence.alias("license"), policy.licence_allowed(licence).alias("allowed"))


def license_lines(spark, sf_dir):
    code = table(spark, sf_dir, "code_records").where("code is not null")
    return code.select("rec_id", tx.spdx_license(F.regexp_replace("code", "\r", "")).alias("license")).where("license is not null")


_SEGMENT_LICENCE = {"BUILDING": "MIT", "AUTOMOBILE": "Apache-2.0", "MACHINERY": "GPL-3.0", "HOUSEHOLD": "ISC", "FURNITURE": "NO-LICENSE"}


def repo_prefilter(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.max("o_orderdate").alias("last"))
    cust = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    licence = F.create_map(*[F.lit(x) for kv in _SEGMENT_LICENCE.items() for x in kv])[F.col("c_mktsegment")]
    reason = policy.prefilter_reason(F.col("c_acctbal") < 0, licence, (F.coalesce("n", F.lit(0)) * 25).cast("int"), F.date_format("last", "yyyy-MM-dd"), F.lit("1999-06-01").cast("date"))
    return cust.select("c_custkey", reason.alias("reason"))


def candidate_rank(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("path"), (F.col("l_linenumber") % 2).alias("function"), F.col("l_partkey").alias("api"))
    unknown = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("path")).agg(F.count_if(F.col("l_returnflag") == "R").alias("n_unknown"))
    scored = policy.score_files(lines, ["path"]).join(unknown, "path").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_custkey").alias("repo")), "path")
    return policy.rank_candidates(scored)


def example_dirs(spark, sf_dir):
    files = table(spark, sf_dir, "code_records").select(F.substring_index("name", "::", 1).alias("path")).distinct()
    return policy.example_dirs(files)


def best_example_dir(spark, sf_dir):
    return policy.best_example_dir(example_dirs(spark, sf_dir))


def invalidate(spark, sf_dir):
    return policy.invalidate(all_records(spark, sf_dir), ["signatures", "enum_of"]).select("rec_id", "invalidated", F.col("explanation").isNotNull().alias("explained"))


def pending_explanations(spark, sf_dir):
    return policy.pending_explanations(all_records(spark, sf_dir)).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def dedupe_first(spark, sf_dir):
    return policy.first_by_name(table(spark, sf_dir, "api_records").select("name", "rec_id", "kind"), "rec_id")


def corpus_summary(spark, sf_dir):
    r = all_records(spark, sf_dir)
    return r.groupBy("corpus", "kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("unknown_refs") > 0).alias("n_unknown"), F.count_if(F.col("code").isNotNull()).alias("n_code"), F.array_join(F.array_sort(F.collect_set("license")), ",").alias("licenses"))


# ---------------------------------------------------------------- parsers


def signature_parameters(spark, sf_dir):
    """The parameters of the signatures of callables, flat."""
    api = table(spark, sf_dir, "api_records").where("kind in ('function', 'method')").select("rec_id", "kind", "name", "signatures")
    parsed = api.select("rec_id", F.posexplode(signatures.parsed_parameters(F.col("signatures"))).alias("overload", "params"))
    return parsed.select("rec_id", "overload", F.posexplode("params").alias("pos", "p")).select("rec_id", F.col("overload").cast("int").alias("overload"), F.col("pos").cast("int").alias("pos"), F.col("p.name").alias("pname"), F.col("p.type").alias("ptype"), F.col("p.required").alias("required"), F.col("p.default").alias("pdefault"))


def property_defaults(spark, sf_dir):
    p = table(spark, sf_dir, "api_records").where("kind = 'property'")
    doc = F.get("signatures", F.lit(0))
    return p.select("rec_id", signatures.property_type(doc).alias("ptype"), signatures.property_default(doc).alias("pdefault"))


def kwargs_expand(spark, sf_dir):
    """Constructors that take keywords, with the writable properties of their class as parameters."""
    api = table(spark, sf_dir, "api_records")
    made = api.where("kind = 'class' and signatures[0] like '%**kwargs%'").select(F.concat("name", F.lit(".__init__")).alias("name"), F.lit("method").alias("kind"), F.array(F.lit("(self, x: int, **kwargs)")).alias("signatures"), F.lit(None).cast("boolean").alias("writable")).distinct()
    rows = made.unionByName(api.where("kind = 'property'").select("name", "kind", "signatures", "writable").distinct())
    out = signatures.with_parameters(rows).where("kind = 'method'")
    return out.select("name", F.array_join(F.transform(F.flatten("parameters"), lambda p: F.concat_ws(":", p.getField("name"), p.getField("type"), p.getField("default"))), ",").alias("params"))


def doc_prose(spark, sf_dir):
    api = table(spark, sf_dir, "api_records").where("doc is not null")
    text = F.concat(F.lit("f(x)\n\n1. f(x: int)\n"), F.col("doc"), F.lit("\n  "), F.col("doc"), F.lit("\nMembers:\n  A"))
    return api.select("rec_id", signatures.prose(F.col("kind"), text).alias("prose"))


def sections_from_markdown(spark, sf_dir):
    """Files written from the API records, parsed back to sections."""
    api = table(spark, sf_dir, "api_records").where("name is not null")
    file = F.concat_ws("\n", F.concat(F.lit("<!-- SPDX-License-Identifier: MIT\n-->\n# "), F.col("name")), F.coalesce("doc", F.lit("")), F.lit("## Empty"), F.lit("### Explained"), F.coalesce("explanation", F.lit("")), F.lit("```sh\n# not a heading\n```"), F.lit("## Last"), F.lit("end"))
    files = api.select(F.lit("api").alias("prefix"), F.concat(F.lit("r/"), F.col("rec_id").cast("string"), F.lit(".md")).alias("path"), file.alias("content"))
    out = markdown.parse_markdown(files)
    return out.select("name", F.array_join("heading_path", " > ").alias("path"), "heading_level", "section_text", "source", "code", "license")


def sections_from_doc_files(spark, sf_dir):
    """Every documentation section as a file of its own, under its headings, parsed back to sections."""
    docs = table(spark, sf_dir, "doc_sections")
    titles = F.transform(F.coalesce("heading_path", F.array().cast("array<string>")), lambda t, i: F.concat(F.repeat(F.lit("#"), F.least(i + 1, F.lit(6))), F.lit(" "), F.coalesce(t, F.lit(""))))
    file = F.array_join(F.concat(titles, F.array(F.coalesce("section_text", F.lit("")))), "\n")
    files = docs.select(F.lit("doc").alias("prefix"), F.concat(F.lit("d/"), F.col("rec_id").cast("string"), F.lit(".md")).alias("path"), file.alias("content"))
    out = markdown.parse_markdown(files)
    return out.select("name", F.array_join("heading_path", " > ").alias("path"), "heading_level", "section_text", "source", "code", "license")


def code_segments(spark, sf_dir):
    """Every code record as a file of its own: segments, references and scores; code that doesn't parse is counted as an error."""
    code = table(spark, sf_dir, "code_records").where("code is not null")
    files = code.select(F.lit("c").alias("prefix"), F.concat(F.col("rec_id").cast("string"), F.lit(".py")).alias("path"), F.concat(F.lit(f"import {LIBRARY}\nimport {LIBRARY} as ts\n"), F.col("code")).alias("content"))
    made, errors = pycode.code_records(files, LIBRARY, table(spark, sf_dir, "api_records"))
    n = errors.select(F.concat("prefix", F.lit("/"), "path").alias("name"), F.lit("error").alias("kind"), F.lit(None).cast("string").alias("apis_used"))
    return made.select("name", "kind", F.array_join("apis_used", ",").alias("apis_used")).unionByName(n)


def _api_names(spark, sf_dir):
    return table(spark, sf_dir, "api_records").where("name like 'tessarine.%'").select("rec_id", "name", "kind")


#: Names that have a keyword as a part can't be spelled in code.
_KEYWORDS = r"\.(" + "|".join(keyword.kwlist) + r")(\.|$)"
#: An example of one API name: a function, a decorated class, and lines that nothing covers.
_EXAMPLE = """import tessarine
import tessarine as ts
def use():
    return {name}()
@deco
class Kit:
    x = ts.{rest}
    def m(self):
        tessarine.nosuch.thing
print({name})"""


def code_from_api(spark, sf_dir):
    """A file of example code per API record, written as a tree with a manifest, read back and taken apart."""
    api = _api_names(spark, sf_dir)
    home = scratch(spark, "src")
    content = F.replace(F.replace(F.lit(_EXAMPLE), F.lit("{name}"), F.col("name")), F.lit("{rest}"), F.expr("substring(name, 11)"))
    path = F.concat("kind", F.lit("/"), F.col("rec_id").cast("string"), F.lit(".py"))
    materialise(fetch.write_files(api.select(path.alias("path"), content.alias("content")), f"{home}/api"), "written")
    listed = {r.path: r for r in api.select(path.alias("path"), "rec_id", "kind").collect()}  # a manifest names all files
    own = {p: None if r.rec_id % 2 else "ISC" for p, r in listed.items() if r.kind == "class"}
    fetch.write_manifest(spark, {"license": "MIT", "files": {p: f"u/{r.rec_id}" for p, r in listed.items() if r.kind != "module"}, "licenses": own}, f"{home}/api")
    made, errors = pycode.code_records(files.read_python(spark, home), LIBRARY, api, files.read_manifests(spark, home))
    out = made.select("name", "kind", "source", "license", F.array_join("apis_used", ",").alias("apis_used"), F.array_join(F.coalesce("unknown_refs", F.array().cast("array<string>")), ",").alias("unknown_refs"), F.md5("code").alias("code_md5"), "corpus")
    return out.unionByName(errors.select("path").select(F.col("path").alias("name"), *[F.lit(None).cast("string").alias(c) for c in out.columns[1:]]))


def code_scores_from_api(spark, sf_dir):
    """A file per module whose one function uses all names of the module that can be spelled: densities, lines and unknown references."""
    api = _api_names(spark, sf_dir)
    uses = api.where(~F.col("name").rlike(_KEYWORDS)).withColumn("module", F.split_part("name", F.lit("."), F.lit(2))).groupBy("module").agg(F.array_sort(F.collect_set("name")).alias("names"))
    body = F.array_join(F.transform("names", lambda n: F.concat(F.lit("    "), n)), "\n")
    files_ = uses.select(F.lit("m").alias("prefix"), F.concat("module", F.lit(".py")).alias("path"), F.concat(F.lit("import tessarine\ndef f():\n"), body, F.lit("\ntessarine.nosuch.thing\n")).alias("content"))
    return pycode.file_scores(files_, LIBRARY, api).select("path", F.size("apis_used").alias("n_apis"), F.array_join("unknown_refs", ",").alias("unknown_refs"), "n_unknown", "lines", "max_apis_in_function", "qualifying_functions")


def tree_roundtrip(spark, sf_dir):
    """Code and documentation written as source trees with their manifests, and read back with what the manifests say; empty files are none."""
    home = scratch(spark, "tree")
    rows = lambda name, text, end: table(spark, sf_dir, name).select("rec_id", "license", F.concat(F.col("rec_id").cast("string"), F.lit(end)).alias("path"), F.coalesce(text, F.lit("")).alias("content"))
    for prefix, name, text, end in (("code", "code_records", "code", ".py"), ("docs", "doc_sections", "section_text", ".md")):
        part = rows(name, F.col(text), end)
        materialise(fetch.write_files(part.withColumn("path", F.concat((F.col("rec_id") % 7).cast("string"), F.lit("/"), "path")), f"{home}/{prefix}"), "written")
    licensed = rows("code_records", F.col("code"), ".py").collect()
    name = lambda r: f"{r.rec_id % 7}/{r.path}"
    fetch.write_manifest(spark, {"license": "none", "files": {name(r): f"u/{r.rec_id}" for r in licensed}, "licenses": {name(r): r.license for r in licensed if r.rec_id % 3}}, f"{home}/code")
    read = files.read_python(spark, home).unionAll(files.read_markdown(spark, home))
    return read.join(files.read_manifests(spark, home), ["prefix", "path"], "left").select("prefix", "path", F.md5("content").alias("content_md5"), "url", "license")


def chunk_files(spark, sf_dir):
    """The chunks written as one folder of chunk files per corpus, discovered and read as one; the corpus is the name of the file."""
    home = scratch(spark, "chunked")
    rows = table(spark, sf_dir, "chunks").select("record_id", "chunk_type", F.coalesce("part", F.lit(0)).alias("part"), "text", "return_text", "corpus")
    corpora = [r.corpus for r in rows.select("corpus").distinct().collect()]  # a folder for each
    for c in corpora:
        rec.write_jsonl(rows.where(F.col("corpus").eqNullSafe(F.lit(c))).drop("corpus"), f"{home}/{c}_chunks.jsonl")
    back = rec.read_chunks(spark, home)
    return back.groupBy("corpus", "chunk_type").agg(F.count(F.lit(1)).alias("n"), F.sum("part").alias("parts"), F.sum(F.length("text")).alias("chars"), F.count("return_text").alias("n_returned"), F.count_distinct("record_id").alias("n_records"))


def code_scores(spark, sf_dir):
    code = table(spark, sf_dir, "code_records").where("code is not null")
    files = code.select(F.lit("c").alias("prefix"), F.concat(F.col("rec_id").cast("string"), F.lit(".py")).alias("path"), F.concat(F.lit(f"import {LIBRARY}\nimport {LIBRARY} as ts\n"), F.col("code")).alias("content"))
    return pycode.file_scores(files, LIBRARY, table(spark, sf_dir, "api_records")).drop("apis_used", "unknown_refs")


# ---------------------------------------------------------------- search


def _vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("chunk_id"), F.col("label").cast("string").alias("record_id"), F.lit("example").alias("chunk_type"), "embedding", F.col("vec_id").cast("string").alias("document"))


def knn_hits(spark, sf_dir):
    first = table(spark, sf_dir, "embeddings").where("vec_id = 0").select("embedding").collect()[0][0]
    return search.search(_vectors(spark, sf_dir), first, 5).select("record_id", "matched_chunk_type", F.round("distance", 6).alias("distance"), "text")


def knn_batch(spark, sf_dir):
    """Every fiftieth vector against all vectors."""
    queries = table(spark, sf_dir, "embeddings").where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return search.search_batch(_vectors(spark, sf_dir), queries, 5).select("query_id", "record_id", F.round("distance", 6).alias("distance"), "rank")


def cosine_pairs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    first = e.where("vec_id = 0").select(F.col("embedding").alias("q"))
    return e.join(F.broadcast(first), F.lit(True)).select("vec_id", F.round(search.cosine_distance(F.col("embedding"), F.col("q")), 6).alias("distance"))


QUERIES = {
    f.__name__: f
    for f in (
        field_render, recipe_gate_counts, recipe_rows, clean_markdown, chunk_split_premerge, chunk_split, build_chunks, chunk_ids_hashes, incremental_pending, upsert_result, store_count,
        stream_ingest, jsonl_roundtrip, prefix_exclude, prefix_keep, prefix_counts, public_names, longest_prefix_refs, reference_sets, license_allow, license_lines, repo_prefilter, candidate_rank,
        example_dirs, best_example_dir, invalidate, pending_explanations, dedupe_first, corpus_summary, signature_parameters, property_defaults, kwargs_expand, doc_prose, sections_from_markdown, sections_from_doc_files,
        code_segments, code_scores, code_from_api, code_scores_from_api, tree_roundtrip, chunk_files, knn_hits, knn_batch, cosine_pairs,
    )
}

# ---------------------------------------------------------------- SQL

#: White space as a class that RE2 knows.
_W = r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{_W}]+|[{_W}]+$', '', 'g')"


_RECORDS = """
  with r as (
    select rec_id, name, kind, signatures, parameters, doc, members, enum_of, value, explanation, null::varchar as source, null::varchar as license,
      null::varchar[] as apis_used, null::varchar[] as unknown_refs, null::varchar as code, null::varchar[] as heading_path, null::varchar as section_text, 'api' as corpus from api_records
    union all select rec_id, name, kind, null, null, null, null, null, null, null, source, license, apis_used, unknown_refs, code, null, null, corpus from code_records
    union all select rec_id, name, kind, null, null, null, null, null, null, null, source, license, null, null, code, heading_path, section_text, corpus from doc_sections),
"""
_F = {
    **{c: f"nullif({c}, '')" for c in ("name", "kind", "explanation", "doc", "code", "section_text")},
    "heading_path": "case when len(heading_path) > 0 then array_to_string(heading_path, ' > ') end",
    "source": "'source: ' || nullif(source, '')",
    "license": "'license: ' || nullif(license, '')",
    "signatures": "case when len(signatures) > 0 then array_to_string(signatures, chr(10)) end",
    "parameter_names": "'parameters: ' || nullif(array_to_string(list_sort(list_distinct(list_transform(flatten(parameters), lambda p: p.name))), ', '), '')",
    "apis_used": "'uses: ' || case when len(apis_used) > 0 then array_to_string(apis_used, ', ') end",
    "enum_members": "'members: ' || case when len(members) > 0 then array_to_string(list_transform(members, lambda m: m.name), ', ') end",
    "enum_of": "'belongs to enum: ' || nullif(enum_of, '')",
    "value": "'value: ' || case when value = 'null' then 'None' when value = 'true' then 'True' when value = 'false' then 'False' when json_type(value) = 'VARCHAR' then value ->> '$' else value end",
}


def _built(names) -> str:
    return "nullif(concat_ws(chr(10), " + ", ".join(_F[n] for n in names) + "), '')"


def _cleaned(x: str) -> str:
    links = rf"regexp_replace({x}, '\[([^\]]*)\]\([^)]*\)', '\1', 'g')"
    rules = rf"regexp_replace({links}, '(?m)^\|[{_W}\-:|]+\|[{_W}]*$', '', 'g')"
    return _strip(rf"regexp_replace({rules}, '\n{{3,}}', chr(10) || chr(10), 'g')")


_RECIPES = _RECORDS + "c as (" + " union all ".join(
    f"select name as record_id, '{r.chunk_type}' as chunk_type, {_cleaned(_built(r.embedded)) if r.cleanup else _built(r.embedded)} as text, "
    f"coalesce({_built(r.returned)}, {_built(r.embedded)}) as return_text, corpus from r where " + " and ".join(f"({_F[n]}) is not null" for n in r.required)
    for r in RECIPES
) + ")"

_LINE_ENDS = r"\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}"
_RANK = "case " + " ".join(f"when regexp_matches(line, '{p.replace(chr(92) + 's', '[' + _W + ']').replace(chr(92) + 'S', '[^' + _W + ']').replace('$', chr(92) + 'n?$')}') then {k}" for k, p in enumerate(BOUNDARIES)) + " end"
_PIECES = rf"""
  l as (select doc_id, unnest(regexp_extract_all(text, '[^{_LINE_ENDS}]*(?:\r\n|[{_LINE_ENDS}])|[^{_LINE_ENDS}]+')) as line, generate_subscripts(regexp_extract_all(text, '[^{_LINE_ENDS}]*(?:\r\n|[{_LINE_ENDS}])|[^{_LINE_ENDS}]+'), 1) - 1 as i
    from d where length(text) > {LIMIT}),
  b as (select doc_id, i, line, {_RANK} as rank, coalesce(sum(length(line)) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as off from l
    union all select doc_id, max(i) + 1, '', {len(BOUNDARIES)}, sum(length(line)) from l group by doc_id),
  nx as (select s.doc_id, s.i, coalesce(arg_min(e.i, e.rank * 1000000 - e.i), s.i + 1) as e from b s
    left join b e on e.doc_id = s.doc_id and e.i > s.i and e.off <= s.off + {LIMIT} where s.line <> '' group by s.doc_id, s.i),
  z as (select doc_id, i, e from nx where i = 0 union all select nx.doc_id, nx.i, nx.e from z join nx on nx.doc_id = z.doc_id and nx.i = z.e),
  p as (select z.doc_id, z.i, string_agg(b.line, '' order by b.i) as piece from z join b on b.doc_id = z.doc_id and b.i >= z.i and b.i < z.e group by z.doc_id, z.i)
"""
_SPLIT = "\n  with recursive d as (select doc_id, text from documents where text is not null)," + _PIECES
_SMALL = _strip("piece")
#: Small pieces join the ones before, the first one the one behind; pieces are stripped.
_MERGED = f"""g as (select *, sum(case when n = 1 or length({_SMALL}) >= {LIMIT // 10} then 1 else 0 end) over (partition by doc_id order by i) as gid from (select *, row_number() over (partition by doc_id order by i) as n from p)),
  m as (select doc_id, gid, string_agg(piece, '' order by i) as piece from g group by doc_id, gid),
  h as (select doc_id, case when gid = 2 and first_small then 1 else gid end as gid, gid as old, piece from (select *, max(case when gid = 1 then length({_SMALL}) < {LIMIT // 10} end) over (partition by doc_id) as first_small from m)),
  t as (select doc_id, gid, {_strip("string_agg(piece, '' order by old)")} as piece from h group by doc_id, gid),
  q as (select doc_id, row_number() over (partition by doc_id order by gid) - 1 as part, piece from t where piece <> '')"""


def _documents_pieces(pieces: str) -> str:
    return f"""{_SPLIT}, {pieces}
  select doc_id, part::int as part, length(piece) as chars, md5(piece) as piece_md5 from q
  union all select doc_id, 0, length(text), md5(text) from d where length(text) <= {LIMIT}"""


_HASH = "sha256(coalesce(text, '') || chr(0) || coalesce(return_text, ''))"
_ID = "concat_ws('::', record_id, chunk_type, case when coalesce(part, 0) > 0 then part end)"
_OLD_NEW = f"""
  with k as (select {_ID} as chunk_id, record_id, chunk_type, {_HASH} as text_hash, chunk_seq, parsed_at from chunks),
  n as (select * from k qualify row_number() over (partition by chunk_id order by parsed_at desc, chunk_seq desc) = 1),
  o as (select * replace (case when chunk_seq % 7 = 0 then sha256(text_hash) else text_hash end as text_hash) from n where chunk_seq % 5 <> 0),
  f as (select n.* from n left join o using (chunk_id, text_hash) where o.chunk_id is null)
"""
_UP = _OLD_NEW + ", u as (select chunk_id, record_id, chunk_type, text_hash from f union all select chunk_id, record_id, chunk_type, text_hash from o where chunk_id not in (select chunk_id from f))"
_P = "(values " + ", ".join(f"('{p}', {i})" for i, p in enumerate(PREFIXES)) + ") p(prefix, ord)"
_BELOW = "(a.name = p.prefix or starts_with(a.name, p.prefix || '.'))"
_REFS = "with x as (select rec_id, unnest(list_concat(coalesce(apis_used, []), coalesce(unknown_refs, []))) as ref from code_records), b as (select d.ref, arg_max(k.name, length(k.name)) as known from (select distinct ref from x) d left join (select distinct name from api_records where contains(name, '.')) k on d.ref = k.name or starts_with(d.ref, k.name || '.') group by d.ref)"
_DIRS = "with f as (select distinct split_part(name, '::', 1) as path from code_records), s as (select path, string_split(path, '/') as parts from f), e as (select parts, unnest(range(1, len(parts))) as i from s), g as (select array_to_string(parts[1:i], '/') as dir, count(*) as n from e where lower(parts[i]) in (" + ", ".join(f"'{d}'" for d in EXAMPLE_DIRS) + ") group by 1)"
_NEAR = "with s as (select vec_id, label::varchar as record_id, embedding::double[] as e from embeddings)"

SQL = {
    "field_render": _RECORDS.rstrip().rstrip(",") + " select rec_id, " + ", ".join(f"{_F[n]} as f_{n}" for n in ("kind", "heading_path", "source", "license", "signatures", "parameter_names", "apis_used", "enum_members", "enum_of", "value")) + f", md5(coalesce({_built(['name', 'doc', 'explanation', 'code', 'section_text'])}, '-')) as text_md5 from r",
    "recipe_gate_counts": _RECIPES + " select chunk_type, count(*) as n, sum(length(text))::bigint as chars from c group by 1",
    "recipe_rows": _RECIPES + " select record_id, chunk_type, md5(text) as text_md5, md5(return_text) as return_md5, corpus from c",
    "clean_markdown": f"select rec_id, md5({_cleaned('section_text')}) as cleaned_md5 from doc_sections where section_text is not null",
    "chunk_split_premerge": _documents_pieces("q as (select doc_id, row_number() over (partition by doc_id order by i) - 1 as part, piece from p)"),
    "chunk_split": _documents_pieces(_MERGED),
    "build_chunks": _RECIPES.replace("with r as", "with recursive r as", 1)
    + ", d as (select distinct md5(text) as doc_id, text from c where text is not null),"
    + _PIECES
    + f""", {_MERGED},
  k as (select record_id, chunk_type, 0 as part, text, return_text, corpus from c where length(text) <= {LIMIT}
    union all select record_id, chunk_type, q.part, q.piece, return_text, corpus from c join q on q.doc_id = md5(c.text) where length(c.text) > {LIMIT})
  select {_ID} as chunk_id, record_id, chunk_type, part::int as part, {_HASH} as text_hash, corpus from k""",
    "chunk_ids_hashes": f"select chunk_seq, {_ID} as chunk_id, {_HASH} as text_hash, md5(coalesce(nullif(return_text, ''), text)) as document_md5 from chunks",
    "incremental_pending": _OLD_NEW + "select chunk_id, text_hash from f",
    "upsert_result": _UP + "select * from u",
    "store_count": _UP + "select count(*) as n, count(distinct chunk_id) as n_ids from u",
    "stream_ingest": f"select chunk_id, record_id, chunk_type, text_hash, 64 as dim from (select {_ID} as chunk_id, record_id, chunk_type, {_HASH} as text_hash, parsed_at, arrived_at, chunk_seq from chunks) qualify row_number() over (partition by chunk_id order by parsed_at desc nulls last, arrived_at desc nulls last, chunk_seq desc) = 1",
    "jsonl_roundtrip": _RECORDS.rstrip().rstrip(",") + " select rec_id, name, kind, len(flatten(parameters))::int as n_parameters, md5(coalesce(section_text, code, doc, '-')) as text_md5, array_to_string(heading_path, ' > ') as path, corpus from r",
    "prefix_exclude": f"select a.rec_id, a.name from api_records a where not exists (select 1 from {_P} where {_BELOW})",
    "prefix_keep": f"select a.rec_id, a.name from api_records a where exists (select 1 from {_P} where {_BELOW})",
    "prefix_counts": f"with f as (select a.rec_id, arg_min(p.prefix, p.ord) as prefix from api_records a join {_P} on {_BELOW} group by 1) select p.prefix, count(f.rec_id) as n from {_P} left join f on f.prefix = p.prefix group by 1",
    "public_names": "select rec_id, not starts_with(n, '_') or n in ('__init__', '__call__') as public from (select rec_id, regexp_extract(name, '[^.]*$') as n from api_records)",
    "longest_prefix_refs": _REFS + " select ref, known from b",
    "reference_sets": _REFS + ", y as (select distinct x.rec_id, b.known, case when b.known is null then x.ref end as u from x join b on b.ref = x.ref), z as (select y.rec_id, y.known from y where known is not null and not exists (select 1 from y o where o.rec_id = y.rec_id and starts_with(o.known, y.known || '.'))) select i.rec_id, coalesce((select string_agg(known, ',' order by known) from (select distinct known from z where z.rec_id = i.rec_id)), '') as apis_used, coalesce((select string_agg(u, ',' order by u) from (select distinct u from y where y.rec_id = i.rec_id and u is not null)), '') as unknown_refs from (select distinct rec_id from x) i",
    "license_allow": "select rec_id, nullif(trim(regexp_replace(license, '\\s*(-->|\\*/)\\s*$', '')), '') as license, coalesce(trim(regexp_replace(license, '\\s*(-->|\\*/)\\s*$', '')) in (" + ", ".join(f"'{x}'" for x in LICENSES) + "), false) as allowed from code_records",
    "license_lines": "select * from (select rec_id, nullif(regexp_extract(replace(code, chr(13), ''), '(?m)SPDX-License-Identifier:\\s*([^\\n]+?)[ \\t]*$', 1), '') as license from code_records where code is not null) where license is not null",
    "repo_prefilter": "with o as (select o_custkey, count(*) as n, max(o_orderdate)::date as last from orders group by 1), x as (select c_custkey, c_acctbal < 0 as fork, case c_mktsegment " + " ".join(f"when '{k}' then '{v}'" for k, v in _SEGMENT_LICENCE.items()) + " end as lic, coalesce(n, 0) * 25 as stars, last from customer left join o on o_custkey = c_custkey) select c_custkey, case when fork then 'fork' when not coalesce(lic in (" + ", ".join(f"'{x}'" for x in LICENSES) + "), false) then 'licence ' || coalesce(lic, 'NO-LICENSE') when stars < 200 then stars || ' stars' when last < date '1999-06-01' - 730 then 'stale since ' || last end as reason from x",
    "candidate_rank": "with f as (select l_orderkey as path, l_linenumber % 2 as fn, count(distinct l_partkey) as n from lineitem group by 1, 2), s as (select path, max(n) as max_apis_in_function, count(*) filter (n >= 3) as qualifying_functions from f group by 1), u as (select l_orderkey as path, count(*) filter (l_returnflag = 'R') as n_unknown from lineitem group by 1) select path, max_apis_in_function, qualifying_functions, n_unknown, o_custkey as repo, qualifying_functions >= 1 and n_unknown <= 0 as recommended from s join u using (path) join orders on o_orderkey = path",
    "example_dirs": _DIRS + " select * from g",
    "best_example_dir": _DIRS + " select * from g order by n desc, dir limit 1",
    "invalidate": _RECORDS.rstrip().rstrip(",") + " select rec_id, (len(signatures) > 0 or coalesce(enum_of, '') <> '') is true and coalesce(explanation, '') <> '' as invalidated, explanation is not null and (len(signatures) > 0 or coalesce(enum_of, '') <> '') is not true as explained from r",
    "pending_explanations": _RECORDS.rstrip().rstrip(",") + " select kind, count(*) as n from r where coalesce(explanation, '') = '' group by 1",
    "dedupe_first": "select name, rec_id, kind from api_records qualify row_number() over (partition by name order by rec_id) = 1",
    "corpus_summary": _RECORDS.rstrip().rstrip(",") + " select corpus, kind, count(*) as n, count(*) filter (len(unknown_refs) > 0) as n_unknown, count(code) as n_code, coalesce(array_to_string(list_sort(list_distinct(list(license))), ','), '') as licenses from r group by 1, 2",
    "signature_parameters": "with o as (select rec_id, unnest(parameters) as ps, generate_subscripts(parameters, 1) - 1 as overload from api_records where kind in ('function', 'method')), p as (select rec_id, overload, unnest(ps) as p, generate_subscripts(ps, 1) - 1 as pos from o) select rec_id, overload::int as overload, pos::int as pos, p.name as pname, p.type as ptype, p.required as required, p.default as pdefault from p",
    "property_defaults": "select rec_id, nullif(trim(regexp_extract(signatures[1], '\\(([^,()]+),\\s*default:\\s*(.+)\\)\\s*$', 1)), '') as ptype, nullif(trim(regexp_extract(signatures[1], '\\(([^,()]+),\\s*default:\\s*(.+)\\)\\s*$', 2)), '') as pdefault from api_records where kind = 'property'",
    "kwargs_expand": "with p as (select distinct regexp_replace(name, '\\.[^.]*$', '') as owner, concat_ws(':', regexp_extract(name, '[^.]*$'), type, nullif(trim(regexp_extract(signatures[1], 'default:\\s*(.+)\\)\\s*$', 1)), '')) as x from api_records where kind = 'property' and writable) select distinct name || '.__init__' as name, 'x:int,' || coalesce((select string_agg(x, ',' order by x) from p where owner = name), '**kwargs') as params from api_records where kind = 'class' and contains(signatures[1], '**kwargs')",
    "doc_prose": "select rec_id, case when kind in ('function', 'method') then doc || chr(10) || 'Members:' || chr(10) || 'A' when kind in ('class', 'module') then 'f(x)' || chr(10) || chr(10) || '1. f(x: int)' || chr(10) || doc || chr(10) || '  ' || doc end as prose from api_records where doc is not null",
    "sections_from_markdown": """with a as (select *, case when doc is null or trim(doc) = '' then 0 else 1 end as has from api_records where name is not null)
  select 'api/' || rec_id || '::' || name as name, name as path, 1 as heading_level, trim(doc) as section_text, 'r/' || rec_id || '.md#L3-L4' as source, null as code, 'MIT' as license from a where has = 1
  union all select 'api/' || rec_id || '::' || name || ' > Empty > Explained', name || ' > Empty > Explained', 3, trim(coalesce(explanation, '') || chr(10) || '```sh' || chr(10) || '# not a heading' || chr(10) || '```', chr(10) || ' '), 'r/' || rec_id || '.md#L6-L10', '# not a heading', 'MIT' from a
  union all select 'api/' || rec_id || '::' || name || ' > Last', name || ' > Last', 2, 'end', 'r/' || rec_id || '.md#L11-L12', null, 'MIT' from a""",
    "code_from_api": f"""with a as (select rec_id, name, kind, substr(name, 11) as rest from api_records where starts_with(name, 'tessarine.')),
  f as (select *, regexp_matches(name, '{_KEYWORDS}') as broken, 'api/' || kind || '/' || rec_id || '.py' as file, case when kind <> 'module' then 'u/' || rec_id end as url,
      case when kind = 'module' then null when kind = 'class' then case when rec_id % 2 = 0 then 'ISC' end else 'MIT' end as license from a),
  -- inner parts of a dotted name are references too: those that are no known name of their own go to the longest known one, or are unknown
  p as (select rec_id, unnest(list_transform(range(2, len(string_split(name, '.')) + 1), lambda i: array_to_string(string_split(name, '.')[1:i], '.'))) as ref from a),
  k as (select p.rec_id, p.ref, max(length(b.name)) as n from p left join (select distinct name from a) b on p.ref = b.name or starts_with(p.ref, b.name || '.') group by all),
  u as (select rec_id, coalesce(string_agg(ref, ',' order by ref) filter (n is null), '') as lost, list_sort(list_distinct(list_append(coalesce(list(ref) filter (n is null), []), 'tessarine.nosuch'))) as l from k group by 1),
  s as (select f.*, lost, array_to_string(list_sort(list_append(l, 'tessarine.nosuch.thing')), ',') as more from f join u using (rec_id))
  select file || '::use' as name, 'example' as kind, url || '#L3-L4' as source, license, name as apis_used, lost as unknown_refs, md5('def use():' || chr(10) || '    return ' || name || '()') as code_md5, 'api' as corpus from s where not broken
  union all select file || '::Kit', 'example', url || '#L5-L9', license, name, more, md5('@deco' || chr(10) || 'class Kit:' || chr(10) || '    x = ts.' || rest || chr(10) || '    def m(self):' || chr(10) || '        tessarine.nosuch.thing'), 'api' from s where not broken
  union all select file, 'example', url || '#L1-L10', license, name, more, md5('import tessarine' || chr(10) || 'import tessarine as ts' || chr(10) || 'print(' || name || ')'), 'api' from s where not broken
  union all select kind || '/' || rec_id || '.py', null, null, null, null, null, null, null from s where broken""",
    "code_scores_from_api": f"""with a as (select distinct name, split_part(name, '.', 2) as module from api_records where starts_with(name, 'tessarine.')),
  w as (select * from a where not regexp_matches(name, '{_KEYWORDS}')),
  p as (select distinct module, unnest(list_transform(range(2, len(string_split(name, '.')) + 1), lambda i: array_to_string(string_split(name, '.')[1:i], '.'))) as ref from w),
  k as (select p.module, p.ref, count(b.name) as n from p left join (select distinct name from a) b on p.ref = b.name or starts_with(p.ref, b.name || '.') group by all),
  u as (select module, list_sort(list_concat(coalesce(list(ref) filter (n = 0), []), ['tessarine.nosuch', 'tessarine.nosuch.thing'])) as l from k group by 1),
  m as (select a.module, count(*) as n from w a where not exists (select 1 from w o where starts_with(o.name, a.name || '.')) group by 1),
  t as (select module, count(*) as n from w group by 1)
  select module || '.py' as path, m.n::int as n_apis, array_to_string(l, ',') as unknown_refs, len(l)::int as n_unknown, (t.n + 3)::int as lines, m.n::int as max_apis_in_function, (m.n >= 3)::int as qualifying_functions from m join u using (module) join t using (module)""",
    "tree_roundtrip": """select 'code' as prefix, rec_id % 7 || '/' || rec_id || '.py' as path, md5(coalesce(code, '')) as content_md5, 'u/' || rec_id as url, case when rec_id % 3 <> 0 then license else 'none' end as license from code_records where code <> ''
  union all select 'docs', rec_id % 7 || '/' || rec_id || '.md', md5(coalesce(section_text, '')), null, null from doc_sections where section_text <> ''""",
    "chunk_files": "select coalesce(corpus, 'None') as corpus, chunk_type, count(*) as n, sum(coalesce(part, 0))::bigint as parts, sum(length(text))::bigint as chars, count(return_text) as n_returned, count(distinct record_id) as n_records from chunks group by 1, 2",
    "knn_hits": _NEAR + ", d as (select s.record_id, s.vec_id, list_cosine_distance(s.e, q.e) as x from s, (select e from s where vec_id = 0) q), b as (select record_id, vec_id, x from d qualify row_number() over (partition by record_id order by x, 'v' || vec_id) = 1) select record_id, 'example' as matched_chunk_type, round(x, 6) as distance, vec_id::varchar as text from b order by x, record_id limit 5",
    "knn_batch": _NEAR + ", d as (select q.vec_id as query_id, s.record_id, min(list_cosine_distance(s.e, q.e)) as x from s, (select * from s where vec_id % 50 = 0) q group by 1, 2) select query_id, record_id, round(x, 6) as distance, row_number() over (partition by query_id order by x, record_id)::int as rank from d qualify rank <= 5",
    "cosine_pairs": _NEAR + " select s.vec_id, round(list_cosine_distance(s.e, q.e), 6) as distance from s, (select e from s where vec_id = 0) q",
}
