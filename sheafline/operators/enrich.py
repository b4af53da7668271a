"""Model-backed steps as pluggable enrichers, and nearest vectors by cosine.

The enrichers here are deterministic stand-ins that need no model: an extractive summary and a hashed embedding.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Enricher(Protocol):
    """Turns a batch of texts into values of ``schema_type``; None for texts it has nothing for."""

    schema_type: str

    def __call__(self, texts: list[str | None]) -> list: ...


class Extractive:
    """The sentences with the most words that the text repeats, in their order."""

    schema_type = "string"

    def __init__(self, sentences: int = 3):
        self.sentences = sentences

    def __call__(self, texts):
        return [self._one(t) for t in texts]

    def _one(self, t):
        if not t or not t.strip():
            return None
        parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", t) if p.strip()]
        words = [re.findall(r"\w{4,}", p.lower()) for p in parts]
        counts: dict[str, int] = {}
        for ws in words:
            for w in ws:
                counts[w] = counts.get(w, 0) + 1
        best = sorted(range(len(parts)), key=lambda i: (-sum(counts[w] for w in set(words[i])) / (len(words[i]) + 3), i))[: self.sentences]
        return " ".join(parts[i].strip() for i in sorted(best))


class HashedEmbedding:
    """Unit vector of signed word hashes; null for blank texts."""

    schema_type = "array<float>"

    def __init__(self, size: int = 64):
        self.size = size

    def __call__(self, texts):
        out = []
        for t in texts:
            if not t or not t.strip():
                out.append(None)
                continue
            v = np.zeros(self.size)
            for w in re.findall(r"\w+", t.lower()):
                h = zlib.crc32(w.encode())
                v[(h >> 1) % self.size] += 1 if h & 1 else -1
            n = np.linalg.norm(v)
            out.append((v / n if n else v).astype(np.float32).tolist())
        return out


def enriched(df: DataFrame, text_col: str, enricher: Enricher, name: str) -> DataFrame:
    """``df`` with the enricher's value; a failure of one batch gives null and ``<name>_error`` instead of ending the job."""
    cols = df.columns
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", `{name}` {enricher.schema_type}, `{name}_error` string"

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            try:
                values, error = enricher(b[text_col].tolist()), None
            except Exception as e:  # noqa: BLE001
                values, error = [None] * len(b), f"{type(e).__name__}: {e}"
            out = b[cols].copy()
            out[name], out[f"{name}_error"] = pd.Series(values, index=b.index, dtype=object), error
            yield out

    return df.mapInPandas(apply, schema)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null if one is null, of another length or all zero."""
    d = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    n = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return F.when((F.size(a) == F.size(b)) & (n(a) > 0) & (n(b) > 0), d / (n(a) * n(b)))
