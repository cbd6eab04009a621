"""Explanations and embeddings from models behind injected clients, with retries inside the task."""

from __future__ import annotations

import hashlib
import json
import math
import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cairn.operators.policy import pending_explanations

GROUNDED = "Use only what you are given here; leave out whatever it doesn't say. Answer in one to three plain sentences without markup."
PROMPTS = {
    "api": "Explain one part of a Python library's interface, so that people who search for what it does find it. " + GROUNDED,
    "example": "Explain one piece of example code: the task it does and how it uses the library's interface. Trust the statements above the comments. " + GROUNDED,
}


def build_prompt(record: dict) -> tuple[str, str]:
    """(system prompt, user message): the record as indented JSON without its explanation; example code stands apart, as it is."""
    example = record.get("kind") == "example"
    left = {k: v for k, v in record.items() if v is not None and k != "explanation" and not (example and k == "code")}
    told = json.dumps(left, ensure_ascii=False, indent=2)
    if example:
        return PROMPTS["example"], f"Metadata:\n{told}\n\nCode:\n{record.get('code') or ''}\n\nExplain this code."
    return PROMPTS["api"], f"Metadata:\n{told}\n\nExplain `{record.get('name')}`."


def retried(call: Callable[[], object], attempts: int = 3, first_pause: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> tuple[object | None, str | None]:
    """(the result, null) or (null, the last error) after the attempts, with pauses that double."""
    error = None
    for k in range(attempts):
        try:
            return call(), None
        except Exception as err:  # a client may raise anything
            error = f"{type(err).__name__}: {err}"
            if k + 1 < attempts:
                sleep(first_pause * 2**k)
    return None, error


def explain(records: DataFrame, complete: Callable[[str, str], str], attempts: int = 3, first_pause: float = 1.0) -> DataFrame:
    """(name, explanation, error) for the records without explanation. What fails has an error and stays pending."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for raw in pdf["record"]:
                record = json.loads(raw)
                text, error = retried(lambda r=record: complete(*build_prompt(r)), attempts, first_pause)
                rows.append((record.get("name"), text, error))
            yield pd.DataFrame(rows, columns=["name", "explanation", "error"])

    todo = pending_explanations(records)
    return todo.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in todo.columns])).alias("record")).mapInPandas(run, "name string, explanation string, error string")


def with_explanations(records: DataFrame, explanations: DataFrame) -> DataFrame:
    """records with the explanations that were made for those that had none (the latest table of explanations, one row a name)."""
    made = explanations.where("explanation is not null").groupBy("name").agg(F.max("explanation").alias("_made"))
    return records.join(made, "name", "left").withColumn("explanation", F.coalesce(F.nullif("explanation", F.lit("")), "_made")).drop("_made").select(*records.columns)


def embed(rows: DataFrame, model: Callable[[Sequence[str]], Sequence[Sequence[float]]], text: str = "text", attempts: int = 3, first_pause: float = 1.0) -> DataFrame:
    """rows with ``embedding``; the texts of an Arrow batch go to the model together, null where it failed."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            vectors, _ = retried(lambda p=pdf: list(model(p[text].tolist())), attempts, first_pause)
            yield pdf.assign(embedding=[None] * len(pdf) if vectors is None else [list(map(float, v)) for v in vectors])

    return rows.mapInPandas(run, fields + ", embedding array<float>")


class HashEmbedder:
    """A deterministic stand-in for a model: hashed word counts, normalised."""

    def __init__(self, dim: int = 64):
        self.dim = dim

    def one(self, text: str) -> list[float]:
        v = [0.0] * self.dim
        for word in (text or "").lower().split():
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "big")
            v[h % self.dim] += 1.0 if h >> 63 else -1.0
        n = math.sqrt(sum(x * x for x in v))
        return [x / n for x in v] if n else v

    def __call__(self, texts: Sequence[str]) -> list[list[float]]:
        return [self.one(t) for t in texts]
