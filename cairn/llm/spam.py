"""Keyword-stuffed and link-list pages.

Method: phrase shingles are exploded and their distinct hosts counted; a page is flagged if more than
half of it is stitched from phrases that other hosts repeat, joined with list-density evidence.

A page is cut into stretches. Sentences, code, logs, changes and descriptions are prose; what is left
is list-like: runs of short items, bare links with their anchors, tags, sentences that repeat a
phrase within themselves, or runs of short sentences of hardly any words but the same. A list-like
stretch of words counts as stuffing if enough of its phrase shingles (pairs of words) occur on at least
``HOSTS`` hosts, this one among them: how many it takes depends on its list density, ``DENSE`` of them if its
words or word pairs recur, ``REPLICATED`` if not. Links and tags are list-like by themselves, as what they
point at is hardly ever shared. Only list-like stretches give shingles, each once a page.

Scale: one narrow pass over the texts, then shingles as 64-bit hashes; hosts are counted by two
partial aggregations, so a site with a third of all pages is pre-aggregated before the shuffle.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.runtime import materialise, spread

#: Share of a page above which it is a case.
SHARE = 0.5
#: Hosts on which a shingle must occur to count as replicated elsewhere.
HOSTS = 2
#: Share of replicated shingles that makes a dense list-like stretch stuffing, and any other list-like one.
DENSE, REPLICATED = 0.2, 0.5

_WORD = re.compile(r"\w+")
_LINK = re.compile(
    r"<a\s[^<>]*>[^<]*(?:<(?!/?a[\s>])[^<]*)*</a>|!?\[[^\[\]\n]*\]\([^()\s]*(?:\([^()\s]*\)[^()\s]*)*\)|(?:https?://|www\.)[^\s<>|,;\"')\]]+"
    # a bare host: reserved and usual top-level names, with or without a path
    r"|(?<![\w./@-])(?:[a-z0-9-]+\.)+(?:com|org|net|io|info|biz|co|dev|app|shop|site|online|xyz|example|invalid|test)\b(?:/[^\s<>|,;\"')\]]*)?(?![\w(])",
    re.I | re.S,
)
_SENTENCE_END = re.compile(r"(?<=[.!?…。！？])[\"'”’»)\]]*\s+|(?<=[。！？])(?=\S)")
#: What may follow the end of a sentence.
_CLOSING = "\"'”’»)]"
_ENDS = frozenset(".!?…。！？")
_ITEMS = re.compile(r"\s*[|•;,»·/]\s*|\s+[-–—]\s+|\s*::\s*")
_LOG = re.compile(r"^\W*\d{4}-\d\d-\d\d[ T]\d\d:\d\d")
_CODE = re.compile(r"^\s*(?:(?:async )?def |class |import |from \w|return\b|for \w+.* in |while |if .*:$|elif |else:|with .*:$|try:|except\b|raise |assert |@\w|print\(|#\s)|[\w\])][ ]?[-+*/|]?=[ ]?\S|\w\([^()]*\)|[{}]|==|->|^\s*[\])}]|^\s*File \"")
_TAG = re.compile(r"(?:^|\s)#\w[\w-]*")
#: A quick test that every link passes.
_MAYBE_LINK = re.compile(r"://|www\.|\]\(|<a\s|\w\.[a-z]", re.I)
#: Combining marks and characters without width.
_MARKS = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u2060\ufeff]")
_CJK = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af]")


def _coverage(words: list[str], least: int = 2) -> tuple[float, float]:
    """The shares of words that recur (``least`` times or more), alone and in pairs of neighbours."""
    one = Counter(words)
    pairs = list(zip(words, words[1:]))
    two = Counter(pairs)
    covered = [False] * len(words)
    for i, p in enumerate(pairs):
        if two[p] >= 2:
            covered[i] = covered[i + 1] = True
    n = max(1, len(words))
    return sum(one[w] >= least for w in words) / n, sum(covered) / n


def _size(s: str) -> int:
    """Characters that aren't white space."""
    return len(s) - s.count(" ") - s.count("\t") if s.isascii() else sum(map(len, s.split()))


def _ends(s: str) -> bool:
    return bool(s) and (s[-1] in _ENDS or s[-1] in _CLOSING and s.rstrip(_CLOSING)[-1:] in _ENDS)


def stretches(text: str) -> tuple[int, int, list[tuple[int, bool, list[str]]]]:
    """(characters without white space, those of link and tag stretches, the other list-like stretches: (characters, dense, words))."""
    total, links, found = 0, 0, []
    run: list[str] = []
    run_size = 0
    closed: list[str] = []  # the words of sentences of under 8 words, which are too short to repeat a phrase
    closed_size = 0

    def flush(both: bool = True) -> None:
        nonlocal run, run_size, closed, closed_size
        if both:
            if len(closed) >= 8:
                alone, paired = _coverage(closed)
                if alone >= 0.8 and paired >= 0.5:  # prose has other words in every sentence, however alike they are
                    found.append((closed_size, _coverage(closed, 3)[0] >= 0.8, closed))
            closed, closed_size = [], 0
        if len(run) >= 8:
            alone, paired = _coverage(run, 3 if len(run) >= 30 else 2)
            found.append((run_size, alone >= 0.6 or paired >= 0.5, run))
        run, run_size = [], 0

    if not text.isascii():
        text = _MARKS.sub("", text)
    for line in text.splitlines():
        line = line.strip()
        if not line:
            continue
        size = _size(line)
        total += size
        if line[0].isdigit() and _LOG.match(line):
            flush()
            continue
        if _MAYBE_LINK.search(line):
            bare, n = _LINK.subn(" ", line)
            if n:
                if len(_WORD.findall(bare)) <= 5 * n:
                    links += size
                else:
                    flush()
                continue
        if "#" in line and len(_TAG.findall(line)) >= 3 and _size(_TAG.sub(" ", line)) < 0.4 * size:
            links += size
            continue
        ends = _ends(line)
        if not ends and _CODE.search(line):
            flush()
            continue
        for sentence in _SENTENCE_END.split(line):
            words = _WORD.findall(sentence.lower())
            n, end = len(words), _ends(sentence)
            if end and 1 < n < 12 and not sentence.isascii() and _CJK.search(sentence) and sum(map(bool, map(_WORD.search, sentence.split()))) == 1:
                flush()  # words aren't divided here: clauses that end as a sentence does are prose
                continue
            few = len(set(words)) <= 0.85 * n  # with more distinct words too few pairs can recur
            if end:
                if few and n >= 8 and _coverage(words)[1] >= 0.4:
                    found.append((_size(sentence), True, words))
                elif n < 4 and run:
                    run += words
                    run_size += _size(sentence)
                elif n < 8:
                    flush(both=False)
                    closed += words
                    closed_size += _size(sentence)
                else:
                    flush()
                continue
            if n >= 7 and n >= 5 * len([x for x in _ITEMS.split(sentence) if x]) and not (few and _coverage(words)[1] >= 0.3):
                flush()
                continue
            run += words
            run_size += _size(sentence)
    flush()
    return total, links, found


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        ids, totals, linked, parts = [], [], [], []
        for i, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
            total, links, found = stretches(text)
            if not found and not links:
                continue
            ids.append(i)
            totals.append(total)
            linked.append(links)
            rows = []
            for size, dense, words in found:
                seen = sorted({xxhash.xxh3_64_intdigest(f"{x} {y}") - (1 << 63) for x, y in zip(words, words[1:])})
                rows.append({"size": size, "dense": dense, "shingles": seen})
            parts.append(rows)
        kind = pa.list_(pa.struct([("size", pa.int32()), ("dense", pa.bool_()), ("shingles", pa.list_(pa.int64()))]))
        site = dict(zip(b.column("doc_id").to_pylist(), b.column("site").to_pylist()))
        yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([site[i] for i in ids], pa.string()), pa.array(totals, pa.int64()), pa.array(linked, pa.int64()), pa.array(parts, kind)], names=["doc_id", "site", "total", "links", "parts"])


def page_evidence(docs: DataFrame) -> DataFrame:
    """(doc_id, site, total, links, parts): one row per page that has anything list-like. Null and blank texts have none; a null site counts as one host."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("site").cast("string"), F.lit("")).alias("site"), F.col("text").cast("string").alias("text"))
    return spread(rows.where(F.length("text") > 0)).mapInArrow(_pages, "doc_id bigint, site string, total bigint, links bigint, parts array<struct<size:int,dense:boolean,shingles:array<bigint>>>")


def stuffed_pages(docs: DataFrame, hosts: int = HOSTS, dense: float = DENSE, replicated: float = REPLICATED, share: float = SHARE, scores: bool = False) -> DataFrame:
    """doc_id of the pages of which more than ``share`` is stuffing, with ``scores`` the shares as well.

    doc_id is unique; a row repeated whole comes out once. An empty table gives no row. Phrases of a single
    host are replicated nowhere, so on a crawl of one host only links and tags count.
    """
    pages = materialise(page_evidence(docs), "pages")
    parts = pages.select("doc_id", "site", F.posexplode("parts").alias("part", "p")).select("doc_id", "site", "part", F.col("p.size").alias("size"), F.col("p.dense").alias("dense"), F.col("p.shingles").alias("shingles"))
    one = parts.select("doc_id", "site", "part", F.explode("shingles").alias("shingle"))
    # how many hosts have it: distinct (shingle, host) first, so that a large site is one row a shingle
    elsewhere = one.select("shingle", "site").distinct().groupBy("shingle").agg(F.count(F.lit(1)).alias("hosts")).where(F.col("hosts") >= hosts).select("shingle", F.lit(1).alias("elsewhere"))
    shares = one.join(elsewhere, "shingle", "left").groupBy("doc_id", "part").agg(F.avg(F.coalesce("elsewhere", F.lit(0))).alias("replicated"))
    judged = parts.select("doc_id", "part", "size", "dense").distinct().join(shares, ["doc_id", "part"], "left")
    counts = F.coalesce("replicated", F.lit(0.0)) >= F.when(F.col("dense"), dense).otherwise(replicated)
    mass = judged.groupBy("doc_id").agg(F.sum(F.when(counts, F.col("size")).otherwise(0)).alias("stuffed"))
    out = pages.select("doc_id", "total", "links").distinct().join(mass, "doc_id", "left")
    out = out.withColumn("share", (F.col("links") + F.coalesce("stuffed", F.lit(0))) / F.col("total"))
    return out.select("doc_id", "share") if scores else out.where(F.col("share") > share).select("doc_id")
