"""Filling containers of a fixed capacity with texts measured in tokens: harmonic packing.

A text of n tokens belongs to class ``capacity // n``: its length lies in (capacity/(k+1), capacity/k], so k texts of a
class always fit. Every worker packs its own rows, the largest class of lengths first: a container gets k texts of class
k (the longest first), and what space is left is topped up with the longest shorter texts that still fit. Texts of classes
that are not full are put together by length at the end of the worker's rows; its last container that is not well filled
is passed on, and those few texts are packed together by groups of ``fan_in`` workers. Workers keep lengths and ids only, at most
``chunk`` at a time.

Only texts longer than the capacity are split: into full pieces, each a container of its own, and a rest that is packed
like a text. Null and empty texts take no space: they get a row without container. Repeated ids are packed one by one.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.session import cut

# The public splitting pattern that belongs to the byte-level vocabulary.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

_loaded: dict[str, object] = {}


def tokenizer(vocabulary: str):
    """The tokenizer of a file of ranks, loaded once per worker."""
    if vocabulary not in _loaded:
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _loaded[vocabulary] = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _loaded[vocabulary]


class _Pool:
    """Texts by length; gives the longest of at most a given length."""

    def __init__(self, capacity: int):
        self.items: list[list[tuple]] = [[] for _ in range(capacity + 1)]
        self.below = list(range(capacity + 1))
        self.count = 0

    def add(self, n: int, item: tuple) -> None:
        self.items[n].append(item)
        self.count += 1

    def settle(self) -> None:
        """To be called after additions."""
        last = 0
        for n in range(1, len(self.items)):
            last = n if self.items[n] else last
            self.below[n] = last

    def longest(self, n: int) -> int:
        """The largest length of at most ``n`` that is present, else 0."""
        path = []
        while n > 0 and not self.items[n]:
            path.append(n)
            n = self.below[n] if self.below[n] < n else n - 1
        for p in path:
            self.below[p] = n
        return n

    def take(self, n: int) -> tuple:
        self.count -= 1
        return self.items[n].pop()


def pack(lengths: list[tuple[int, tuple]], capacity: int, enough: float = 0.97) -> tuple[list[list[tuple[int, tuple]]], list[tuple[int, tuple]]]:
    """Containers of ``(length, item)`` and the texts of the one that is not filled to ``enough``. Lengths in 1..capacity."""
    pool = _Pool(capacity)
    for n, item in lengths:
        pool.add(n, item)
    pool.settle()
    sizes = [0] * (capacity + 1)
    for n, _ in lengths:
        sizes[capacity // n] += 1
    bins, rest = [], []

    def top_up(box: list, gap: int) -> None:
        while gap > 0 and (n := pool.longest(gap)):
            box.append((n, pool.take(n)))
            sizes[capacity // n] -= 1
            gap -= n

    for k in range(1, capacity + 1):
        if not sizes[k]:
            continue
        while sizes[k] >= k:
            box, room = [], capacity
            for _ in range(k):
                n = pool.longest(capacity // k)
                box.append((n, pool.take(n)))
                sizes[k] -= 1
                room -= n
            top_up(box, room)
            bins.append(box)
        while sizes[k] > 0:  # fewer than the class needs: together, with what else fits
            box: list = []
            top_up(box, capacity)
            bins.append(box)
    bins = [b for b in bins if b]
    kept = []
    for b in bins:
        if sum(n for n, _ in b) >= enough * capacity:
            kept.append(b)
        else:
            rest.append(b)
    # one worker passes on at most one container's worth; others stay as they are
    rest.sort(key=lambda b: sum(n for n, _ in b))
    return kept + rest[1:], rest[0] if rest else []


_SCHEMA = "doc_id long, piece int, start long, n_tokens long, bin_id string, place int, left boolean"
_COLUMNS = ["doc_id", "piece", "start", "n_tokens", "bin_id", "place", "left"]


def _rows(bins: list, name: str, first: int) -> list[tuple]:
    return [(*item, n, f"{name}-{first + i}", place, False) for i, box in enumerate(bins) for place, (n, item) in enumerate(box)]


def packed(docs: DataFrame, capacity: int = 4096, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text", chunk: int = 100_000, fan_in: int = 256) -> DataFrame:
    """``doc_id, piece, start, n_tokens, bin_id, place``: one row per text or piece and the container it is in.

    ``vocabulary``: a file of ranks that every worker can read; else the setting ``spark.sheafline.vocabulary`` names it.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    vocabulary = vocabulary or docs.sparkSession.conf.get("spark.sheafline.vocabulary", VOCABULARY)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = tokenizer(vocabulary)
        waiting: list = []
        made, part = 0, None

        def flush(last: bool) -> pd.DataFrame:
            nonlocal waiting, made
            bins, rest = pack(waiting, capacity)
            out = _rows(bins, f"a{part}", made)
            made += len(bins)
            waiting = [] if last else rest
            if last:
                out += [(*item, n, f"a{part}", None, True) for n, item in rest]  # the worker's name, until a container is found
            return pd.DataFrame(out, columns=_COLUMNS)

        for b in batches:
            out = []
            for i, text, part in zip(b["id"], b["text"], b["part"]):
                n = len(enc.encode_ordinary(text)) if text else 0
                if not n:
                    out.append((i, 0, 0, 0, None, None, False))
                    continue
                pieces, start = 0, 0
                while n - start >= capacity:
                    out.append((i, pieces, start, capacity, f"a{part}-{made}", 0, False))
                    made += 1
                    pieces, start = pieces + 1, start + capacity
                if n > start:
                    waiting.append((n - start, (i, pieces, start)))
            yield pd.DataFrame(out, columns=_COLUMNS)
            if len(waiting) >= chunk:
                yield flush(False)
        if waiting:
            yield flush(True)

    def together(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        items, made, name = [], 0, None
        for b in batches:
            name = name or f"b{b['part'].iloc[0]}" if len(b) else name
            items += [(int(r[3]), (r[0], r[1], r[2])) for r in b.itertuples(index=False)]
            if len(items) >= chunk:
                bins, items = pack(sorted(items, key=lambda x: x[1]), capacity)
                yield pd.DataFrame(_rows(bins, name, made), columns=_COLUMNS)
                made += len(bins)
        bins, rest = pack(sorted(items, key=lambda x: x[1]), capacity)
        yield pd.DataFrame(_rows([*bins, rest] if rest else bins, name, made), columns=_COLUMNS)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")).withColumn("part", F.spark_partition_id())
    first = cut(rows.mapInPandas(measure, _SCHEMA))  # measured once; both parts below read it
    groups = max(1, rows.rdd.getNumPartitions() // fan_in)  # what a group of workers leaves over is a few containers
    part = F.col("bin_id").alias("part")
    rest = first.where("left").select("*", part).repartition(groups, "part").mapInPandas(together, _SCHEMA)
    return first.where("not left").unionByName(rest).drop("left")


def space(bins: DataFrame, capacity: int = 4096) -> DataFrame:
    """One row: containers, texts, tokens, split texts, and the share of the capacity that is unused."""
    per = bins.where("bin_id is not null").groupBy("bin_id").agg(F.sum("n_tokens").alias("used"), F.count(F.lit(1)).alias("parts"))
    total = per.agg(F.count(F.lit(1)).alias("bins"), F.sum("used").alias("tokens"), F.max("used").alias("fullest"), F.sum((F.col("used") > capacity).cast("long")).alias("overfull"))
    return total.withColumn("unused_share", 1 - F.col("tokens") / (F.col("bins") * F.lit(capacity)))
