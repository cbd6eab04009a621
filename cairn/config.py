"""Settings of a corpus: which library, where its files lie, recipes, limits and policies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from pathlib import Path

# ---- fixed values: recipes, boundary patterns and policies that results depend on

BOUNDARIES = (
    r"^\s*$",
    r"^\s*```|^\s*~~~",
    r"^#{1,6}\s",
    r"^\s*\|",
    r"^\s*[-*+]\s",
    r"^\S",
    r"",
)
LICENSES = ("MIT", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "ISC", "0BSD", "Unlicense")
EXAMPLE_DIRS = ("examples", "example", "samples", "sample", "demos", "demo", "tutorials", "tutorial", "cookbook", "recipes")


@dataclass(frozen=True)
class Recipe:
    """One chunk type: fields that a record must have, that are embedded, and that are answered with."""

    chunk_type: str
    required: Sequence[str]
    embedded: Sequence[str]
    returned: Sequence[str] = ()
    cleanup: str | None = None


_ANSWER = ("name", "kind", "signatures", "parameter_names", "doc", "explanation")
RECIPES = (
    Recipe("explanation", ("explanation",), ("name", "doc", "explanation"), _ANSWER),
    Recipe("signature", ("signatures",), ("name", "signatures", "parameter_names"), _ANSWER),
    Recipe("example_workflow", ("code", "apis_used"), ("name", "apis_used"), ("name", "source", "apis_used")),
    Recipe("example", ("code",), ("name", "apis_used", "code"), ("name", "source", "code")),
    Recipe("doc_section", ("section_text",), ("name", "heading_path", "section_text"), ("name", "heading_path", "section_text", "source"), "markdown"),
)

# ---- end of fixed values


@dataclass(frozen=True)
class Config:
    library: str = "lib"
    version: str = "0"
    root: str = "data"
    recipes: Sequence[Recipe] = RECIPES
    boundaries: Sequence[str] = BOUNDARIES
    chunk_chars: int | None = 2000
    top_k: int = 5
    licenses: Sequence[str] = LICENSES
    example_dirs: Sequence[str] = EXAMPLE_DIRS
    min_stars: int = 200
    max_age_days: int = 730
    min_apis_per_function: int = 3
    max_unknown_refs: int = 0
    manifest: str = "_manifest.json"
    metric: str = "cosine"
    attempts: int = 3
    retry_seconds: float = 1.0
    timeout_seconds: float = 60.0
    politeness_seconds: float = 0.5
    token_file: str | None = None
    verify_tls: bool = True
    extra: dict = field(default_factory=dict)

    # where things lie

    def anchored(self, file: str) -> Config:
        """The same with a relative root taken from the folder of ``file`` (the module or script that serves, say), whatever the working folder is."""
        return self if "://" in self.root else replace(self, root=str((Path(file).resolve().parent / self.root).resolve()))

    @property
    def library_dir(self) -> str:
        return f"{self.root}/{self.library}_{self.version}"

    @property
    def src_dir(self) -> str:
        return f"{self.library_dir}/src"

    @property
    def records_dir(self) -> str:
        return f"{self.library_dir}/raw_text"

    @property
    def chunks_dir(self) -> str:
        return f"{self.library_dir}/chunked_text"

    @property
    def store_dir(self) -> str:
        return f"{self.library_dir}/store"

    @property
    def candidates_dir(self) -> str:
        """Beside the records, not among them: a report on a fetch is never indexed."""
        return f"{self.library_dir}/community_candidates"

    @property
    def collection(self) -> str:
        return f"{self.library}_{self.version}"

    def policy_file(self, mode: str, folder: str = "filter") -> str:
        return f"{folder}/{self.library}_{self.version}/{mode}.py"

    def sources(self) -> list[dict[str, str]]:
        """Each directory below src: its records, its documentation records and the prefix of its names."""
        root = Path(self.src_dir)
        names = sorted(p.name for p in root.iterdir() if p.is_dir()) if root.exists() else []
        return [{"dir": f"{self.src_dir}/{n}", "records": f"{self.records_dir}/{n}.jsonl", "docs": f"{self.records_dir}/{n}_docs.jsonl", "prefix": n} for n in names]

    def token(self) -> str | None:
        """The access token, if a token file is set, exists and isn't blank; it is never logged."""
        path = Path(self.token_file) if self.token_file else None
        return (path.read_text(encoding="utf-8").strip() or None) if path and path.exists() else None
