"""Evaluation passages inside a corpus: size-partitioned MinHash containment search, verified by exact shingles.

A shared run of ``run`` words is a shared window of that size. Windows are the size class in which the search runs: items
and documents alike are cut into all their windows of ``run`` words, and each window is the set of its ``gram``-word
shingles. Windows of one class that contain each other are equal, so their MinHash agrees with certainty and one hash
function per class loses nothing, however long the document around the window is. Neighbouring windows mostly share
their minimum, so a text keeps about ``2 / (run - gram + 2)`` values per word. The items' values are sent to the executors in
blocks of at most ``block`` values, and documents are scanned once a block; of a document only the windows whose value an
item has leave the scan, as their words. A pair is kept if such a window equals an item's word by word. So neither the
texts of the corpus nor its fingerprints are shuffled, whatever its size, and the cost of many items is further scans.

Words are maximal runs of letters and digits, lower-cased, after every hyphen directly before a line feed is deleted with
that line feed. Null and empty texts and texts of fewer than ``run`` words match nothing; repeated ids give one row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm import passages as P
from sheafline.session import spread

_WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[str]:
    """The words of a text."""
    if not text:
        return []
    return _WORD.findall(text.replace("-\n", "").replace("‐\n", "").lower())


def _mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values, so that their order is that of a random permutation."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` word hashes."""
    m = len(hashes) - n + 1
    if m < 1:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(n):
        out = (out ^ hashes[i : i + m]) * _MULTIPLIER
        out ^= out >> np.uint64(29)
    return _mix(out)


def window_minima(hashes: np.ndarray, run: int, gram: int, distinct: bool = True) -> np.ndarray:
    """MinHash values of all windows of ``run`` words over their ``gram``-word shingles, distinct or in order."""
    if len(hashes) < run:
        return np.empty(0, np.int64)
    g = shingle_hashes(hashes, gram)
    size = run - gram + 1
    low = g[: len(g) - size + 1].copy()
    for i in range(1, size):
        np.minimum(low, g[i : i + len(low)], out=low)
    return (np.unique(low) if distinct else low).view(np.int64)


class _Hasher:
    """64-bit word hashes; a bounded memo spares the frequent words."""

    def __init__(self, bound: int = 200_000):
        self.memo: dict[str, int] = {}
        self.bound = bound

    def __call__(self, ws: list[str]) -> np.ndarray:
        memo = self.memo
        if len(memo) > self.bound:
            memo.clear()
        out = np.empty(len(ws), np.uint64)
        for i, w in enumerate(ws):
            h = memo.get(w)
            if h is None:
                h = memo[w] = xxhash.xxh3_64_intdigest(w)
            out[i] = h
        return out


def item_values(texts: list[str | None], run: int, gram: int) -> np.ndarray:
    """The sorted distinct values of all windows of the items."""
    hasher = _Hasher()
    found = [window_minima(hasher(words(t)), run, gram) for t in texts]
    return np.unique(np.concatenate(found)) if found else np.empty(0, np.int64)


def matching_windows(ws: list[str], hashes: np.ndarray, known: np.ndarray, run: int, gram: int) -> list[str]:
    """The distinct windows of a text whose value is in the sorted array ``known``, as words joined by blanks."""
    low = window_minima(hashes, run, gram, distinct=False)
    if not len(low) or not len(known):
        return []
    at = np.minimum(np.searchsorted(known, low), len(known) - 1)
    return list(dict.fromkeys(" ".join(ws[i : i + run]) for i in np.flatnonzero(known[at] == low)))


def _windows(df: DataFrame, id_col: str, text_col: str, known, run: int, gram: int) -> DataFrame:
    """``id, window`` of the windows of each text that :func:`matching_windows` gives; ``known`` gives its array on an executor."""

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher, values = _Hasher(), known()
        for b in batches:
            out = []
            for i, text in zip(b["id"], b["text"]):
                ws = words(text)
                if len(ws) >= run:
                    out += [(i, w) for w in matching_windows(ws, hasher(ws), values, run, gram)]
            yield pd.DataFrame(out, columns=["id", "window"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).where("id is not null and text is not null")
    return spread(rows).mapInPandas(apply, "id long, window string")


def leaks(
    items: DataFrame, docs: DataFrame, item_id: str = "item_id", doc_id: str = "doc_id", text: str = "text", run: int = 12, gram: int = 5, block: int = 1_000_000
) -> DataFrame:
    """``item_id, doc_id, shared_runs, item_runs``: each pair that shares at least ``run`` consecutive words.

    The items are read block by block: as many as have about ``block`` words, so that 8 MB of values are sent at once. A
    window that a third of all documents have meets one row per item, so adaptive execution can split it.
    """
    if not 1 <= gram <= run:
        raise ValueError("gram must lie between 1 and run")
    spark = docs.sparkSession
    own = items.select(F.col(item_id).cast("long").alias("id"), F.col(text).cast("string").alias("text")).where("id is not null and text is not null")
    letters = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-letters // (5 * block)))
    result = None
    for k in range(blocks):
        part = own.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == k)
        known = P.shipped(spark, item_values([r["text"] for r in part.select("text").toLocalIterator()], run, gram))
        asked = _windows(part, "id", "text", known, run, gram).distinct().withColumnRenamed("id", "item_id")
        runs = asked.groupBy("item_id").agg(F.count(F.lit(1)).alias("item_runs"))
        found = _windows(docs, doc_id, text, known, run, gram).distinct().withColumnRenamed("id", "doc_id")
        pairs = found.join(asked, "window").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("shared_runs")).join(runs, "item_id")
        result = pairs if result is None else result.unionByName(pairs)
    return result.select("item_id", "doc_id", "shared_runs", "item_runs")
