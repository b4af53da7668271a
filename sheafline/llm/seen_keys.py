"""Has a key been seen before: stored Golomb-coded sets in blocks.

The keys' 64-bit hashes are reduced to a range of ``entries * 2**bits`` values, sorted within blocks of equal width, and
each block stores the gaps as Golomb codes: the quotients by ``2**bits`` in unary (a bit string) and the remainders in
``bits`` bits each. A block holds about ``per_block`` entries whatever the number of keys, because hashes are uniform;
repeated keys become one entry before the shuffle. The coded blocks are written once: a batch that is appended is coded on
its own and earlier ones are neither read nor rewritten. A probe decodes only blocks that some probed key falls into.

A key that occurred is always reported; one that did not is reported with a chance of about ``2**-bits``, which
:func:`wrong_answers` states and audits. Null and blank keys are no keys. Keys are compared after trimming white space and
ignoring letter case. Batches may repeat keys of each other; a batch written again replaces itself.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.session import shared_folder

BITS, PER_BLOCK = 24, 1024


def normal_key(key: Column) -> Column:
    """Key without surrounding white space, in lower case; null if nothing is left."""
    return F.nullif(F.lower(F.regexp_replace(key.cast("string"), r"(?U)^[\s\p{Cf}\x00-\x1f]+|[\s\p{Cf}\x00-\x1f]+$", "")), F.lit(""))


def encode(values: np.ndarray, bits: int) -> bytes:
    """Golomb code of sorted distinct values of one block, relative to the block's start."""
    gaps = np.diff(values, prepend=0).astype(np.uint64)
    q = (gaps >> np.uint64(bits)).astype(np.int64)
    ends = np.cumsum(q + 1) - 1
    unary = np.ones(int(ends[-1]) + 1, np.uint8)
    unary[ends] = 0
    rest = ((gaps[:, None] >> np.arange(bits - 1, -1, -1, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel()
    return np.array([len(values), len(unary)], "<u4").tobytes() + np.packbits(unary).tobytes() + np.packbits(rest).tobytes()


def decode(code: bytes, bits: int) -> np.ndarray:
    """The values of :func:`encode`."""
    n, u = (int(x) for x in np.frombuffer(code, "<u4", 2))
    raw = np.frombuffer(code, np.uint8, offset=8)
    a = (u + 7) // 8
    q = np.diff(np.flatnonzero(np.unpackbits(raw[:a], count=u) == 0), prepend=-1) - 1
    rest = np.unpackbits(raw[a:], count=n * bits).reshape(n, bits).astype(np.uint64)
    r = (rest << np.arange(bits - 1, -1, -1, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
    return np.cumsum((q.astype(np.uint64) << np.uint64(bits)) + r)


class KeyStore:
    """Coded sets of keys in a shared folder, one per appended batch."""

    def __init__(self, spark: SparkSession, folder: str, bits: int = BITS, per_block: int = PER_BLOCK):
        if not 1 <= bits <= 32:
            raise ValueError("bits must lie between 1 and 32")
        self.spark, self.folder, self.bits, self.per_block = spark, folder, bits, per_block
        self.batches: dict[str, int] = {}

    @classmethod
    def temporary(cls, spark: SparkSession, **options) -> KeyStore:
        """A store of its own below the shared folder."""
        return cls(spark, f"{shared_folder(spark)}/keys-{uuid.uuid4()}", **options)

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> KeyStore:
        """A store that was written before."""
        about = spark.read.parquet(f"{folder}/about").collect()  # one row per batch
        store = cls(spark, folder, about[0]["bits"], about[0]["per_block"])
        store.batches = {r["batch"]: r["entries"] for r in about}
        return store

    def places(self, keys: DataFrame, entries: int) -> DataFrame:
        """Adds ``block`` and ``at`` of the column ``key``'s reduced hash."""
        width = self.per_block << self.bits
        count = max(1, -(-entries // self.per_block))
        df = keys.withColumn("at", F.pmod(F.xxhash64("key"), F.lit(count * width)))
        return df.withColumn("block", F.expr(f"at div {width}")).withColumn("at", F.pmod("at", F.lit(width)))

    def append(self, keys: DataFrame, batch: str) -> None:
        """Codes and writes a batch of keys (column ``key``, normal, not null). Earlier batches are not read."""
        entries = max(1, keys.count())
        placed = self.places(keys.select("key"), entries).groupBy("block").agg(F.array_sort(F.collect_set("at")).alias("at"))
        bits = self.bits

        def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                yield pd.DataFrame({"block": b["block"], "code": [encode(np.asarray(v, np.int64), bits) for v in b["at"]]})

        placed.mapInPandas(apply, "block long, code binary").write.mode("overwrite").parquet(f"{self.folder}/blocks/batch={batch}")
        row = self.spark.createDataFrame([(batch, entries, self.bits, self.per_block)], "batch string, entries long, bits int, per_block int")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/about/of={batch}")
        self.batches[batch] = entries

    def theoretical_rate(self) -> float:
        """Chance that a key which never occurred is reported: a filled place in any batch."""
        clean = 1.0
        for entries in self.batches.values():
            clean *= (1 - 1 / float(max(1, -(-entries // self.per_block)) * (self.per_block << self.bits))) ** entries
        return 1 - clean

    def known(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` (distinct; column ``key`` and others) whose place is filled in some batch."""
        bits, found = self.bits, None

        def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                hits = [[bool(x) for x in np.isin(np.asarray(asked, np.int64).astype(np.uint64), decode(code, bits))] for code, asked in zip(b["code"], b["asked"])]
                kept = [[int(a) for a, hit in zip(asked, h) if hit] for asked, h in zip(b["asked"], hits)]
                yield pd.DataFrame({"block": b["block"], "at": kept})

        for batch, entries in self.batches.items():
            placed = self.places(keys, entries)
            asked = placed.groupBy("block").agg(F.collect_set("at").alias("asked"))
            blocks = self.spark.read.schema("block long, code binary").parquet(f"{self.folder}/blocks/batch={batch}")
            filled = blocks.join(asked, "block").mapInPandas(apply, "block long, at array<long>").select("block", F.explode("at").alias("at"))
            hit = placed.join(filled, ["block", "at"], "left_semi").drop("block", "at")
            found = hit if found is None else found.unionByName(hit)
        return keys.limit(0) if found is None else found.dropDuplicates(["key"])


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(normal_key(F.col(key)).alias("key")).where("key is not null")


def stored(history: DataFrame, key: str = "id", bits: int = BITS, per_block: int = PER_BLOCK) -> KeyStore:
    """A new store of the keys of ``history``."""
    store = KeyStore.temporary(history.sparkSession, bits=bits, per_block=per_block)
    store.append(_keys(history, key), "history")
    return store


def seen_before(store: KeyStore, arrivals: DataFrame, key: str = "id", order: str = "arrival_no") -> DataFrame:
    """``arrival_no`` of each arrival whose key is in the store or in an arrival with a smaller number.

    History is not read: the coded set answers for it. Equal keys are probed once; a key that many rows have meets a side
    with one row per key, so adaptive execution can split it.
    """
    new = arrivals.select(F.col(order).cast("long").alias("no"), normal_key(F.col(key)).alias("key")).where("key is not null and no is not null")
    first = new.groupBy("key").agg(F.min("no").alias("first"))
    known = store.known(first).select("key", F.lit(True).alias("known"))
    again = F.col("known").isNotNull() | (F.col("no") > F.col("first"))
    return new.join(first.join(known, "key", "left"), "key").where(again).select(F.col("no").alias("arrival_no")).distinct()


def wrong_answers(store: KeyStore, history: DataFrame, arrivals: DataFrame, key: str = "id") -> DataFrame:
    """One row: keys that never occurred, how many of them the store reports, that rate, and the theoretical one.

    An audit: every distinct arrival key is compared exactly with ``history``, which the store was made from.
    """
    fresh = _keys(arrivals, key).distinct().join(_keys(history, key), "key", "left_anti")
    hit = store.known(fresh).select("key", F.lit(1).alias("hit"))
    rates = fresh.join(hit, "key", "left").agg(F.count(F.lit(1)).alias("new_keys"), F.count("hit").alias("wrongly_reported"))
    rate = F.when(F.col("new_keys") > 0, F.col("wrongly_reported") / F.col("new_keys"))
    return rates.select("new_keys", "wrongly_reported", rate.alias("audited_rate"), F.lit(store.theoretical_rate()).alias("theoretical_rate"), F.lit(store.bits).alias("bits_per_remainder"))
