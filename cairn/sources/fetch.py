"""Remote sources behind injected clients: code search, repository metadata, files, package metadata.

A ``Fetcher`` maps a URL to text or parsed JSON. The library never opens a connection by itself, so
everything here runs on fixtures; an HTTP client of the user's is passed in where there is a network.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cairn.config import Config
from cairn.operators.policy import best_example_dir, example_dirs, resolve_ref
from cairn.runtime import filesystem, materialise

REPO_KEYS = ("Source", "Source Code", "Repository", "GitHub", "Code", "Homepage")


class Fetcher(Protocol):
    def json(self, url: str) -> object: ...
    def text(self, url: str) -> str: ...


class FixtureFetcher:
    """Answers from a dict; what it lacks is a LookupError."""

    def __init__(self, answers: dict[str, object]):
        self.answers = answers

    def json(self, url: str) -> object:
        if url not in self.answers:
            raise LookupError(url)
        return self.answers[url]

    def text(self, url: str) -> str:
        return str(self.json(url))


class Unresolved(LookupError):
    """A setting that could be worked out neither from the configuration nor from the package."""

    def __init__(self, setting: str, reason: str):
        super().__init__(f"{setting}: {reason}; set it by hand")
        self.setting = setting


def auth_headers(token: str | None = None) -> dict[str, str]:
    """What a client sends to the repository host; without a token the requests are anonymous."""
    return {"Accept": "application/vnd.github+json"} | ({"Authorization": f"Bearer {token}"} if token else {})


def package_metadata(fetcher: Fetcher, url: str) -> dict:
    """The metadata of the package index."""
    found = fetcher.json(url)
    if not isinstance(found, dict):
        raise Unresolved("package", f"{url} gives no metadata")
    return found


def _paced(rows: DataFrame, pause: float, tasks: int = 1) -> tuple[DataFrame, float]:
    """rows in at most ``tasks`` partitions if calls must be paced, and the pause of each task, so that the whole job makes one call per ``pause``."""
    return (rows, 0.0) if pause <= 0 else (rows.repartition(tasks), pause * tasks)


def search_results(spark: SparkSession, fetcher: Fetcher, url_of_page: Callable[[int], str], pages: int, pause: float = 0.0) -> DataFrame:
    """(repo, branch, path): hits of a code search, pages 1..n, one task a page (one in all if paced); stops at nothing, empty pages give none."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for page in pdf["id"]:
                time.sleep(wait)
                yield pd.DataFrame([(h["repo"], h.get("branch"), h["path"]) for h in fetcher.json(url_of_page(int(page) + 1)) or []], columns=["repo", "branch", "path"])

    numbers, wait = _paced(spark.range(pages, numPartitions=max(1, pages)), pause)
    return numbers.mapInPandas(read, "repo string, branch string, path string")


def repo_files(hits: DataFrame) -> DataFrame:
    """(repo, branch, paths): Python files per repository, sorted, with the least branch that was seen."""
    rows = hits.where(F.col("path").endswith(".py"))
    return rows.groupBy("repo").agg(F.min("branch").alias("branch"), F.array_sort(F.collect_set("path")).alias("paths"))


def repo_metadata(repos: DataFrame, fetcher: Fetcher, url_of_repo: Callable[[str], str], pause: float = 0.0) -> DataFrame:
    """repos with stars, license (NO-LICENSE if none), pushed_at (a day), is_fork, archived; a repository that can't be read has nulls."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for repo in pdf["repo"]:
                time.sleep(wait)
                try:
                    m = fetcher.json(url_of_repo(repo))
                except LookupError:
                    rows.append((None,) * 5)
                    continue
                rows.append((m.get("stargazers_count"), (m.get("license") or {}).get("spdx_id") or "NO-LICENSE", (m.get("pushed_at") or "")[:10], bool(m.get("fork")), bool(m.get("archived"))))
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(rows, columns=["stars", "license", "pushed_at", "is_fork", "archived"])], axis=1)

    paced, wait = _paced(repos, pause)
    return paced.mapInPandas(read, _ddl(repos) + ", stars bigint, license string, pushed_at string, is_fork boolean, archived boolean")


def file_contents(files: DataFrame, fetcher: Fetcher, url: Column, pause: float = 0.0) -> DataFrame:
    """files with content; null where the file can't be read."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = []
            for u in pdf["_url"]:
                time.sleep(wait)
                try:
                    got.append(fetcher.text(u))
                except LookupError:
                    got.append(None)
            yield pdf.drop(columns="_url").assign(content=got)

    paced, wait = _paced(files.withColumn("_url", url), pause)
    return paced.mapInPandas(read, _ddl(files) + ", content string")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def repo_of_url(url: Column) -> Column:
    """owner/name of a repository URL of the usual host, without .git; null for other URLs."""
    return F.nullif(F.regexp_replace(F.regexp_extract(url, r"^(?:https?|git)(?:\+https)?://(?:www\.)?github\.com/([^/\s]+/[^/\s#?]+)", 1), r"\.git$", ""), F.lit(""))


def repo_of_urls(urls: dict[str, str], keys: Sequence[str] = REPO_KEYS) -> str | None:
    """The repository that the project's links name, by the order of the keys."""
    lower = {k.lower(): v for k, v in urls.items()}
    for key in keys:
        m = re.match(r"https?://(?:www\.)?github\.com/([^/\s]+/[^/\s#?]+)", lower.get(key.lower()) or "")
        if m:
            return m.group(1).removesuffix(".git")
    return None


@dataclass(frozen=True)
class Source:
    """Where the examples lie; for each part whether it was configured or resolved."""

    repo: str
    license: str
    ref: str
    path: str
    origin: dict[str, str]


def resolve_source(spark: SparkSession, config: Config, package: dict, tags: DataFrame, tree: DataFrame, repo: str | None = None, license: str | None = None, path: str | None = None) -> Source:
    """What is set by hand counts, the rest is worked out: the repository from the package's links, the licence from
    its metadata, the ref from the tags, the directory as the conventional one with most files."""
    origin = {k: "configured" if v else "resolved" for k, v in (("repo", repo), ("license", license), ("path", path))}
    info = package.get("info", package)
    repo = repo or repo_of_urls(info.get("project_urls") or {})
    if not repo:
        raise Unresolved("repo", "no project link names a repository")
    license = (license or "").strip() or (info.get("license") or "").strip() or (info.get("license_expression") or "").strip()
    if not license:
        raise Unresolved("license", "the package metadata names none")
    found = resolve_ref(config.version, tags).collect()
    if not found:
        raise Unresolved("ref", f"no tag is called {config.version} or v{config.version}")
    if not path:
        best = best_example_dir(example_dirs(tree.where(F.col("path").endswith(".py")), config.example_dirs)).collect()
        if not best:
            raise Unresolved("path", "no directory has a conventional name")
        path = best[0].dir
    return Source(repo, license, found[0].tag, path, origin | {"ref": "resolved"})


def is_example_file(path: Column) -> Column:
    name = F.element_at(F.split(path, "/"), -1)
    return name.endswith(".py") & (name != "conftest.py")


def write_files(files: DataFrame, folder: str) -> DataFrame:
    """(path, bytes) written: every (path, content) as a file below a folder that all executors reach, by the tasks; null content writes none.

    A file is written whole under another name first, so a task that is run again leaves what the first one would have.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow.fs import FileSystem

        fs, root = FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")
        for pdf in batches:
            sizes = []
            for path, content in zip(pdf["path"], pdf["content"]):
                if content is None:
                    sizes.append(None)
                    continue
                data, target = content.encode("utf-8"), f"{root}/{path}"
                above, name = target.rsplit("/", 1)
                temp = f"{above}/.{name}.{uuid.uuid4().hex}"
                fs.create_dir(above, recursive=True)
                with fs.open_output_stream(temp) as out:
                    out.write(data)
                fs.move(temp, target)
                sizes.append(len(data))
            yield pd.DataFrame({"path": pdf["path"], "bytes": sizes}).astype({"bytes": "Int64"})

    return files.select("path", "content").mapInPandas(write, "path string, bytes bigint")


def write_manifest(spark: SparkSession, entry: dict, folder: str, name: str = "_manifest.json") -> None:
    """The manifest of a source directory, replacing an older one."""
    fs, to = filesystem(spark, folder)
    fs.mkdirs(to(folder))
    out = fs.create(to(f"{folder}/{name}"), True)
    try:
        out.write(json.dumps(entry, ensure_ascii=False, indent=2).encode("utf-8"))
    finally:
        out.close()


def download(files: DataFrame, fetcher: Fetcher, url: Column, folder: str, pause: float = 0.0) -> DataFrame:
    """(path, url, fetched): the files (path, url) fetched and written below a folder, with whether they could be read."""
    # a call per file: what was fetched is written down before it is read twice
    got = materialise(file_contents(files, fetcher, url, pause), "fetched")
    written = materialise(write_files(got, folder), "written")
    return got.drop("content").join(written.where("bytes is not null").select("path", F.lit(True).alias("fetched")), "path", "left").withColumn("fetched", F.coalesce("fetched", F.lit(False)))


def example_files(tree: DataFrame, source: Source, blob_url: Callable[[Source, str], str] | None = None) -> DataFrame:
    """(path, url): the example files directly in the source's directory."""
    blob = blob_url or (lambda s, d: f"https://github.com/{s.repo}/blob/{s.ref}/{d}")
    below = F.expr(f"substring(path, {len(source.path) + 2})")
    rows = tree.where(F.col("path").startswith(source.path + "/")).select("path", below.alias("name")).where(~F.contains("name", F.lit("/")) & is_example_file(F.col("path")))
    return rows.select(F.col("name").alias("path"), F.concat(F.lit(blob(source, source.path) + "/"), F.col("name")).alias("url"))


def manifest(source: Source, files: DataFrame) -> dict:
    """The manifest of a download; a directory listing is small."""
    return {"repo": source.repo, "ref": source.ref, "path_in_repo": source.path, "license": source.license, "files": {r.path: r.url for r in files.collect()}}
