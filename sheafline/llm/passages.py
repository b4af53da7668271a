"""Passages of texts and their hashed features, shared by the text classifiers."""

from __future__ import annotations

import pickle
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPLIT = re.compile(r"(?<=[.!?…])[\"'”’)\]]*\s+|\n+")
_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|\d+|[{}\[\]<>%$@]{1,3}")


def passages(text: str | None) -> list[str]:
    """Sentences and lines of a text, without blank ones."""
    if not text:
        return []
    return [p for p in (x.strip() for x in _SPLIT.split(text)) if p]


def tokens(passage: str) -> list[str]:
    """Lower-case words; every number is one token; runs of brackets and signs that templates use are tokens."""
    return ["9" if t[0].isdigit() else t for t in _TOKEN.findall(passage.lower())]


def features(ts: list[str], bits: int, pairs: bool = True) -> np.ndarray:
    """Distinct hashed words and, if asked for, pairs of neighbouring words."""
    mask = (1 << bits) - 1
    names = set(ts)
    if pairs:
        names.update(f"{a} {b}" for a, b in zip(["^", *ts], [*ts, "$"]))
    return np.fromiter((xxhash.xxh3_64_intdigest(n) & mask for n in names), np.int64, len(names))


def sample(df: DataFrame, key: str, bound: int, seed: int = 7) -> pd.DataFrame:
    """At most ``bound`` rows for fitting a model, the same ones in every run: those whose key hashes lowest."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(bound).toPandas()


def map_batches(df: DataFrame, f, schema: str) -> DataFrame:
    """``mapInPandas`` with a function of one batch; an empty batch gives an empty one."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield f(b)

    return df.mapInPandas(apply, schema)


def shipped(spark: SparkSession, model: object) -> Callable[[], object]:
    """Broadcasts a model of fixed size with its code; the result gives it on an executor, unpacked once per task."""
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(model))
    kept: dict[int, object] = {}

    def get() -> object:
        if 0 not in kept:
            kept[0] = pickle.loads(sent.value)
        return kept[0]

    return get
