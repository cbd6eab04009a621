"""Queries of the operators of this subpackage, with the SQL that must agree."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.llm import bpe, markup, mixing, neardup, provenance, spam, splitting


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_pairs(table(spark, sf_dir, "code_records"))


def p2_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicate_classes(table(spark, sf_dir, "code_records"))


def _items(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = splitting.items_of("chunks", table(spark, sf_dir, "chunks"), "chunk_seq", ["text", "return_text"])
    sections = splitting.items_of("doc_sections", table(spark, sf_dir, "doc_sections"), "rec_id", ["section_text"])
    return chunks.unionAll(sections).unionAll(splitting.items_of("code_records", table(spark, sf_dir, "code_records"), "rec_id", ["code"]))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values that the splitter cut."""
    return splitting.split_oversized(_items(spark, sf_dir), with_text=False).where("part = 1").select("tab", "item_id", "field")


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split_oversized(_items(spark, sf_dir))


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.marked_fields(table(spark, sf_dir, "doc_sections"))


def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return markup.clean_sections(table(spark, sf_dir, "doc_sections")).select("rec_id", "section_text", "heading_path")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.not_handwritten(table(spark, sf_dir, "code_records"))


def p5_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance.not_handwritten(table(spark, sf_dir, "code_records"), reasons=True)


def p5_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of each file and how many of them other repositories have: evidence that doesn't decide."""
    return provenance.shared_rules(table(spark, sf_dir, "code_records"))


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"))


def p7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p7_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.stuffed_pages(table(spark, sf_dir, "documents"))


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spam.stuffed_pages(table(spark, sf_dir, "documents"), scores=True)


_SHINGLES = r"""
  with w as (select rec_id, regexp_extract_all(code, '[A-Za-z0-9_]+') as w from code_records),
  s as (select distinct rec_id, unnest([w[i:i+3] for i in range(1, len(w) - 2)]) as g from w where len(w) >= 30),
  n as (select rec_id, count(*) as n from s group by rec_id),
  o as (select a.rec_id as rec_id_a, b.rec_id as rec_id_b, count(*) as o from s a join s b on a.g = b.g and a.rec_id < b.rec_id group by all),
  p as (select rec_id_a, rec_id_b from o join n x on x.rec_id = rec_id_a join n y on y.rec_id = rec_id_b where o >= 0.7 * (x.n + y.n - o) - 1e-9)
"""

#: Classes are codes with equal sets of shingles; links count the other classes above the threshold.
_CLASSES = r"""
  with w as (select distinct rec_id, regexp_extract_all(code, '[A-Za-z0-9_]+') as w from code_records),
  s as (select distinct rec_id, unnest([w[i:i+3] for i in range(1, len(w) - 2)]) as g from w where len(w) >= 30),
  k as (select rec_id, md5(string_agg(array_to_string(g, ' '), '|' order by g)) as k, count(*) as n from s group by rec_id),
  c as (select rec_id, n, min(rec_id) over (partition by k) as class_id, count(*) over (partition by k) as copies from k),
  r as (select s.rec_id, s.g, c.n from s join c using (rec_id) where c.rec_id = c.class_id),
  o as (select a.rec_id as a, b.rec_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as o from r a join r b on a.g = b.g and a.rec_id <> b.rec_id group by all),
  l as (select a, count(*) as links from o where o >= 0.7 * (na + nb - o) - 1e-9 group by a)
  select c.rec_id, c.class_id, c.copies, coalesce(l.links, 0) as links from c left join l on l.a = c.class_id
"""

QUERIES = {"p2_found": p2_found, "p2_classes": p2_classes, "p3_found": p3_found, "p3_pieces": p3_pieces, "p4_found": p4_found, "p4_clean": p4_clean, "p5_found": p5_found, "p5_reasons": p5_reasons, "p5_rules": p5_rules, "p6_ids": p6_ids, "p7_mix": p7_mix, "p7_shares": p7_shares, "p8_found": p8_found, "p8_shares": p8_shares}

SQL = {
    "p2_found": _SHINGLES + "select rec_id_a, rec_id_b from p",
    "p2_classes": _CLASSES,
    "p3_found": """select 'chunks' as tab, chunk_seq as item_id, 'text' as field from chunks where length(text) > 2000
      union all select 'chunks', chunk_seq, 'return_text' from chunks where length(return_text) > 2000
      union all select 'doc_sections', rec_id, 'section_text' from doc_sections where length(section_text) > 2000
      union all select 'code_records', rec_id, 'code' from code_records where length(code) > 2000""",
}
