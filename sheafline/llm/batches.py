"""New batches checked against all history: addresses by their canonical form, headlines by a stored pivot-distance table.

The store keeps one row per address and one per distinct corrected headline, with the row that announced it first and, for
headlines, the edit distances to the store's pivots. It is only appended to: a new batch reads the columns it is joined by,
and nothing stored is computed or written again. What could change with the data, the list of frequent words and the pivots
(beginnings of headlines that lie far from each other), is fixed when the first batch is appended.

Two headlines within a radius differ by at most that radius in the distance to any pivot (triangle inequality). Headlines are
stored in folders by ranges of the first pivot's distance; a new headline asks only in the ranges, of both pivots, that its
distances plus or minus the radius touch, and the true distance of what is met there is then computed. Edit distances of
long headlines vary little between unrelated texts, so the join is also partitioned by what a near copy leaves untouched: a rare
word, what a slip leaves of one, or the frequent words of the headline (slips in them are corrected first, so that they agree)
with a part of its other words. ``near_forms`` says which headlines are near; all such pairs are found.

Links (pairs of row numbers) are stored too; articles are their transitive closure, so a later row can join two articles.

Light words (articles, prepositions) do not count. Numbers of a headline must agree, and so must the words that make an
article of its own (correction, reply, part, case, update). Headlines of fewer than five words, which recurring columns use, identify nothing. Null, blank
or broken addresses and headlines link nothing; rows without sequence number are left out; repeated rows stay one article;
a batch that is appended again replaces itself.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import passages as P
from sheafline.llm.headlines import LIGHT, MARKERS, Speller, without_slips, words
from sheafline.session import cut, shared_folder, spread

RADIUS, NAME_RADIUS, RANGE = 7, 2, 16


_TRACKING = r"^(?:utm_\w+|fbclid|gclid|mc_\w+|ref|referrer|from|source|sessionid|session|sid|jsessionid|phpsessid|cmpid|share|via|output|format|print|amp)="


def page_key(url: Column) -> Column:
    """Canonical address: no scheme, user, port, leading www or m, fragment, tracking parameters or trailing slash; sorted parameters."""
    u = F.regexp_replace(url, r"(?U)^[\s\p{Cf}]+|[\s\p{Cf}]+$", "")
    u = F.regexp_replace(F.regexp_replace(u, r"#.*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*:/*|^//", "")
    host = F.lower(F.regexp_extract(u, r"^([^/?]*)", 1))
    host = F.regexp_replace(F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"(?::\d+)+$", ""), r"^(?:www\d?|m|mobile|amp)\.|\.$", "")
    path = F.regexp_extract(u, r"^[^/?]*(/[^?]*)", 1)
    path = F.regexp_replace(F.regexp_replace(path, r"/{2,}", "/"), r"(?:/(?:amp|print|index\.(?:html?|php)))?/*$", "")
    query = F.regexp_extract(u, r"\?(.*)$", 1)
    kept = F.array_sort(F.array_distinct(F.filter(F.split(query, "[&;]"), lambda p: (F.length(p) > 0) & ~F.lower(p).rlike(_TRACKING))))
    return F.when((F.length(host) > 2) & host.contains("."), F.concat_ws("?", F.concat(host, path), F.nullif(F.array_join(kept, "&"), F.lit(""))))


def headlines(rows: DataFrame, seq: str = "seq", url: str = "url", title: str = "title", source: str = "source", least_words: int = 5) -> DataFrame:
    """``seq, page, head``: hashed canonical address; words of the headline, null if it identifies nothing."""
    df = rows.select(F.col(seq).cast("long").alias("seq"), F.col(url).cast("string").alias("url"), F.col(title).cast("string").alias("title"), F.col(source).cast("string").alias("source"))

    def apply(b: pd.DataFrame) -> pd.DataFrame:
        heads = []
        for t, s in zip(b["title"], b["source"]):
            w = words(t, s)
            heads.append(" ".join(w) if len(w) >= least_words else None)
        return pd.DataFrame({"seq": b["seq"], "url": b["url"], "head": heads})

    made = P.map_batches(spread(df.where("seq is not null")), apply, "seq long, url string, head string")
    # as an array of one, so that the expressions of the address are evaluated once
    made = made.select("seq", F.explode(F.array(page_key(F.col("url")))).alias("key"), "head")
    return made.select("seq", F.when(F.col("key").isNotNull(), F.xxhash64("key")).alias("page"), "head")


def frequent_words(heads: DataFrame, share: float = 0.0005, least: int = 20) -> list[str]:
    """Words that at least this share of the headlines have. Headlines have some 15 words, so there are at most ``15 / share``.

    ``least`` only rules tables of under ``least / share`` headlines. Slips of far more frequent words are left out.
    """
    n = heads.count()
    counts = heads.select(F.explode(F.array_distinct(F.split("head", " "))).alias("w")).groupBy("w").count()
    uses = {r["w"]: r["count"] for r in counts.where(F.col("count") >= max(least, int(share * n))).orderBy("w").collect()}
    return without_slips(uses)


def pivot_table(heads: DataFrame, frequent: list[str]) -> DataFrame:
    """``head`` and other columns with ``form, text, rest, numbers, frame, rare``: corrected form and blocks of each headline; null stays null."""
    known = heads.sparkSession.sparkContext.broadcast(frequent)
    made: dict[int, Speller] = {}

    def apply(b: pd.DataFrame) -> pd.DataFrame:
        if 0 not in made:
            made[0] = Speller(known.value)
        spell = made[0]
        form, rest, frame, rare, numbers = [], [], [], [], []
        for h in b["head"]:
            ws = [spell(w) for w in h.split(" ") if w not in LIGHT] if h else []
            form.append(" ".join(ws) if h else None)
            rest.append("".join(w for w in ws if w not in spell.frequent and not w.isdigit()))
            frame.append(" ".join(w for w in ws if w in spell.frequent or w.isdigit()))
            rare.append(sorted({w for w in ws if w not in spell.frequent and not w.isdigit() and len(w) > 3}))
            numbers.append(" ".join(w for w in ws if w in MARKERS or any(c.isdigit() for c in w)))
        return b.assign(form=form, rest=rest, frame=frame, rare=rare, numbers=numbers)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in heads.schema) + ", form string, rest string, frame string, rare array<string>, numbers string"
    return P.map_batches(heads, apply, schema).withColumn("text", F.replace("form", F.lit(" "), F.lit("")))


def choose_pivots(forms: DataFrame, sample: int = 256, letters: int = 24) -> list[str]:
    """Beginnings of two headlines far from each other, by greedy choice among at most ``sample`` (those that hash lowest).

    Any strings would do; distances to short ones cost less and prune as well.
    """
    some = forms.select("text").distinct().orderBy(F.xxhash64("text"), "text").limit(sample).select(F.substring("text", 1, letters).alias("text")).distinct()
    texts = cut(some)
    first = texts.orderBy("text").limit(1).collect()
    if not first:
        return ["", "effect"]
    far = lambda p: texts.orderBy(F.levenshtein("text", F.lit(p)).desc(), "text").first()[0]
    a = far(first[0][0])
    return [a, far(a)]


def _variants(word: Column) -> Column:
    """The word and what is left of it without one of its letters, for words of at least five letters; shorter ones have no slips."""
    less = F.transform(F.sequence(F.lit(1), F.length(word)), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.length(word))))
    return F.when(F.length(word) > 4, F.concat(F.array(word), less)).otherwise(F.array(word))


def _thirds(text: Column) -> Column:
    """Parts of which two texts at most two edits apart share one: first third, last third, or (an edit in each) what lies between.

    Thirds are of one size within eight lengths, and a text has those of its own length and of two letters more. The middle may be
    shifted by a letter at either end, so nine cuts of it are taken.
    """

    def parts(c: Column) -> Column:
        k = F.greatest(F.lit(2), F.floor((8 * c + 1) / 3).cast("int"))
        ends = [F.concat(F.lit("p"), F.substring(text, F.lit(1), k)), F.concat(F.lit("s"), F.substring(text, F.greatest(F.lit(1), F.length(text) - k + 1), k))]
        inner = [F.concat(F.lit("m"), F.substring(text, k + 1 + i, F.greatest(F.lit(0), F.length(text) - 2 * k - i - j))) for i in range(3) for j in range(3)]
        short = F.when(F.length(text) < 8, F.lit("x")).otherwise(F.lit("p"))
        return F.transform(F.array(*ends, *inner, short), lambda x: F.concat(c.cast("string"), x))

    at = lambda n: F.floor((F.length(text) + n) / 8).cast("int")
    return F.array_distinct(F.concat(parts(at(0)), parts(at(2))))


def _letters(text: Column) -> Column:
    return F.array_join(F.array_sort(F.split(text, "")), "")


def _keyed(forms: DataFrame, new: bool, slips: bool) -> DataFrame:
    """``block, seq, d0, d1, flags``: what near headlines agree in, with flag 1 of new headlines and 2 of those without rare words.

    Rare words and, for ``slips``, what they leave without a letter; for headlines without rare words the same of all their words,
    and thirds and sorted letters of the text.
    """
    bare = F.size("rare") == 0
    flags = F.lit(int(new)) + F.when(bare, 2).otherwise(0)
    words = F.when(bare, F.split("frame", " ")).otherwise(F.col("rare")) if slips else F.col("rare")
    rows = forms.select("seq", "d0", "d1", flags.alias("flags"), "numbers", F.explode(words).alias("w"))
    if not slips:
        return rows.select(F.xxhash64(F.lit("r"), "w", "numbers").alias("block"), "seq", "d0", "d1", "flags")
    # letter 0 leaves the word whole
    rows = rows.withColumn("i", F.explode(F.sequence(F.lit(0), F.when(F.length("w") > 4, F.length("w")).otherwise(0))))
    less = F.concat(F.substring("w", F.lit(1), F.col("i") - 1), F.substring("w", F.col("i") + 1, F.length("w")))
    rows = rows.select(F.xxhash64(F.lit("r"), F.when(F.col("i") == 0, F.col("w")).otherwise(less), "numbers").alias("block"), "seq", "d0", "d1", "flags")
    own = forms.where(bare).select("seq", "d0", "d1", (flags + 4).alias("flags"), "numbers", F.explode(F.concat(_thirds(F.col("text")), F.array(_letters(F.col("text"))))).alias("x"))
    return rows.unionByName(own.select(F.xxhash64(F.lit("t"), "x", "numbers").alias("block"), "seq", "d0", "d1", "flags"))


def _in_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``a, b`` that share a block and differ in neither pivot distance by more than the radius; each has ``block`` with all its rows in one partition."""
    parts = list(batches)
    if not parts:
        return
    block, seq, d0, d1, flags = (np.concatenate([p[c].to_numpy() for p in parts]) for c in ("block", "seq", "d0", "d1", "flags"))
    del parts
    order = np.lexsort((d0, block))
    block, seq, d0, d1, flags = block[order], seq[order], d0[order], d1[order], flags[order]
    # rows of a block lie in the order of the first pivot's distance: each is compared with those that follow within the radius
    at, step, held, n = np.arange(max(0, len(block) - 1)), 1, [], 0
    while len(at):
        to = at + step
        on = to < len(block)
        at, to = at[on], to[on]
        on = (block[at] == block[to]) & (d0[to] - d0[at] <= RADIUS)
        at, to = at[on], to[on]
        # by words, two headlines without rare ones are not compared (their frequent words are no evidence); by texts they are
        hit = (np.abs(d1[at] - d1[to]) <= RADIUS) & ((flags[at] | flags[to]) & 1 > 0) & (seq[at] != seq[to]) & ((flags[at] & flags[to] & 2 == 0) | (flags[at] & flags[to] & 4 > 0))
        held.append(pd.DataFrame({"a": np.minimum(seq[at[hit]], seq[to[hit]]), "b": np.maximum(seq[at[hit]], seq[to[hit]])}))
        n += len(held[-1])
        if n > 200_000:
            yield pd.concat(held)
            held, n = [], 0
        step += 1
    if n:
        yield pd.concat(held).drop_duplicates()


def _parts(rest: str, asks: bool = False) -> set[str]:
    """The same parts as ``_thirds`` and the sorted letters; only the one that asks has all cuts of the middle."""
    found = {"".join(sorted(rest))}
    for c in {len(rest) // 8, (len(rest) + 2) // 8}:
        k = max(2, (8 * c + 1) // 3)
        found |= {f"{c}p{rest[:k]}", f"{c}s{rest[-k:]}"}
        cuts = (0, 1, 2) if asks else (1,)
        found |= {f"{c}m{rest[k + i : max(k + i, len(rest) - k - j)]}" for i in cuts for j in cuts}
    return found


def _in_frames(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``a, b`` of one frame whose other words share a part; rows of a ``block`` lie together."""
    frame, parts, rows, held = None, {}, [], []
    for batch in batches:
        for block, seq, d0, d1, new, rest in zip(*(batch[c].tolist() for c in ("block", "seq", "d0", "d1", "flags", "rest"))):
            if block != frame:
                frame, parts, rows = block, {}, []
            rows.append((seq, d0, d1, new, rest))
            if len(rows) == 1:
                continue
            if len(rows) <= 4:
                met = range(len(rows) - 1)
            else:
                if not parts:
                    for i, r in enumerate(rows[:-1]):
                        for p in _parts(r[4]):
                            parts.setdefault(p, []).append(i)
                met = {i for p in _parts(rest, True) for i in parts.get(p, ())}
                for p in _parts(rest):
                    parts.setdefault(p, []).append(len(rows) - 1)
            for i in met:
                other, e0, e1, was_new, words = rows[i]
                if (new or was_new) and other != seq and abs(len(words) - len(rest)) <= NAME_RADIUS and abs(d0 - e0) <= 2 * NAME_RADIUS and abs(d1 - e1) <= 2 * NAME_RADIUS:
                    held.append((min(seq, other), max(seq, other)))
        if held:
            yield pd.DataFrame(held, columns=["a", "b"])
            held = []


def near_forms(asked: DataFrame, stored: DataFrame, slips: bool = False) -> DataFrame:
    """``a, b`` (numbers of rows) of each headline in ``asked`` and another in ``asked`` or ``stored`` that is near, numbers equal.

    Both: ``seq, text, rest, frame, rare, numbers, d0, d1``, one row per distinct corrected headline. Near are

    * headlines that share a rare word and are within the radius, if no other name is replaced by a different one;
    * headlines of one frame (the same frequent words) whose other words differ in few letters, or mere transpositions;
    * with ``slips``, headlines within the radius that share neither, if a rare word is a slip of one of the other's (one letter
      changed, added, left out or moved, in words of five letters or more) and no other name is replaced; and headlines without rare
      words, or one without and one with a slip of its words, if they differ in as few letters as those of one frame.

    Pairs are looked for among headlines that share a rare word, what a slip leaves of one, or in a frame a part of the other words,
    which loses none of them; there the distances to the pivots are compared first.
    """
    kind = "a long, b long"
    by_words = _keyed(asked, True, slips).unionByName(_keyed(stored, False, slips))
    framed = lambda df, new: df.where(F.size("rare") > 0).select(F.xxhash64(F.lit("f"), "frame", "numbers").alias("block"), "seq", "d0", "d1", F.lit(new).alias("flags"), "rest")
    by_frame = framed(asked, 1).unionByName(framed(stored, 0))
    found = by_words.repartition("block").mapInPandas(_in_blocks, kind)
    found = found.unionByName(by_frame.repartition("block").sortWithinPartitions("block").mapInPandas(_in_frames, kind)).distinct()
    both = asked.unionByName(stored).select("seq", "text", "rest", "frame", "rare", "numbers")
    one_of = lambda n: both.select(F.col("seq").alias("ab"[n - 1]), *[F.col(c).alias(c if n == 1 else f"{c}_2") for c in both.columns[1:]])
    near = found.join(one_of(1), "a").join(one_of(2), "b").where("numbers = numbers_2")
    near = near.withColumn("d", F.levenshtein("text", "text_2", RADIUS)).where(F.col("d").between(0, RADIUS))
    d, least = F.col("d"), F.least(F.size("rare"), F.size("rare_2"))
    close = (d <= NAME_RADIUS) | ((d <= 2 * NAME_RADIUS) & (_letters(F.col("text")) == _letters(F.col("text_2"))))
    own, other = F.array_except("rare", "rare_2"), F.array_except("rare_2", "rare")
    text = lambda words: F.array_join(words, " ")
    # of two headlines with a name in common, another name must not be replaced by a different one
    kept = lambda x, y: (F.size(x) == 0) | (F.size(y) == 0) | F.levenshtein(text(x), text(y), NAME_RADIUS + 1).between(0, NAME_RADIUS + 1)
    named = F.arrays_overlap("rare", "rare_2") & kept(own, other)
    # forms of one frame that differ in one word each are told apart by those words, which are short
    one = (F.size(own) == 1) & (F.size(other) == 1)
    rest = F.levenshtein("rest", "rest_2", NAME_RADIUS).between(0, NAME_RADIUS) | (_letters(F.col("rest")) == _letters(F.col("rest_2")))
    framed = (F.col("frame") == F.col("frame_2")) & (least > 0) & close & rest & (~one | F.levenshtein(text(own), text(other), 2 * NAME_RADIUS).between(0, 2 * NAME_RADIUS))
    same = named | framed
    if slips:
        slip = lambda x, y: (F.length(x) > 4) & (F.length(y) > 4) & F.levenshtein(x, y, 2).between(0, 2) & F.arrays_overlap(_variants(x), _variants(y))
        alone = lambda x, y: F.filter(x, lambda v: ~F.exists(y, lambda w: slip(v, w)))
        slipped = F.exists(own, lambda v: F.exists(other, lambda w: slip(v, w))) & kept(alone(own, other), alone(other, own))
        words = lambda rare, frame: F.when(F.size(rare) > 0, F.col(rare)).otherwise(F.split(frame, " "))
        bare = (least == 0) & close & ((F.greatest(F.size("rare"), F.size("rare_2")) == 0) | F.exists(words("rare", "frame"), lambda v: F.exists(words("rare_2", "frame_2"), lambda w: slip(v, w))))
        same = same | ((least > 0) & ~F.arrays_overlap("rare", "rare_2") & slipped) | bare
    return near.where(same).select("a", "b").distinct()


class ArticleStore:
    """Stored addresses, headlines with their pivot distances, and links, in a shared folder; batches are appended."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.batches: list[str] = []
        self.frequent: list[str] | None = None
        self.pivots: list[str] = []

    @classmethod
    def temporary(cls, spark: SparkSession) -> ArticleStore:
        """A store of its own below the shared folder."""
        return cls(spark, f"{shared_folder(spark)}/articles-{uuid.uuid4()}")

    @classmethod
    def open(cls, spark: SparkSession, folder: str) -> ArticleStore:
        """A store that was written before."""
        store = cls(spark, folder)
        fixed = spark.read.parquet(f"{folder}/fixed").first()
        store.frequent, store.pivots = list(fixed["frequent"]), list(fixed["pivots"])
        store.batches = sorted(r["batch"] for r in spark.read.parquet(f"{folder}/done").collect())
        return store

    def _read(self, what: str, schema: str, before: str | None = None) -> DataFrame:
        """What all batches, or those but one, have stored."""
        names = [b for b in self.batches if b != before]
        parts = [self.spark.read.schema(schema).parquet(f"{self.folder}/{what}/batch={b}") for b in names]
        return functools.reduce(DataFrame.unionByName, parts) if parts else self.spark.createDataFrame([], schema)

    def _write(self, df: DataFrame, what: str, batch: str, *by: str) -> None:
        df.write.mode("overwrite").partitionBy(*by).parquet(f"{self.folder}/{what}/batch={batch}")

    def append(self, rows: DataFrame, batch: str) -> None:
        """Links a batch (``seq, url, title, source``) with itself and with all stored before, then stores it."""
        coded = cut(headlines(rows))
        if self.frequent is None:
            self.frequent = frequent_words(coded.where("head is not null").select("head").distinct())
        coded = cut(pivot_table(coded, self.frequent).withColumn("form", F.when(F.col("form").isNotNull(), F.xxhash64("form"))))
        if not self.pivots:
            self.pivots = choose_pivots(coded.where("form is not null"))
            row = self.spark.createDataFrame([(self.frequent, self.pivots)], "frequent array<string>, pivots array<string>")
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/fixed")
        links = []
        for key in ("page", "form"):
            there = coded.where(F.col(key).isNotNull())
            least = there.groupBy(key).agg(F.min("seq").alias("least"))
            links.append(there.join(least, key).where("seq > least").select(F.col("least").alias("a"), F.col("seq").alias("b")))
            stored = self._read(f"{key}s", f"{key} long, seq long", batch).withColumnRenamed("seq", "earlier")
            met = cut(least.join(stored, key, "left"))  # stored addresses and forms are unique
            links.append(met.where("earlier <> least").select(F.least("earlier", "least").alias("a"), F.greatest("earlier", "least").alias("b")))
            fresh = met.where("earlier is null").select(key, F.col("least").alias("seq"))
            if key == "page":
                self._write(fresh, "pages", batch)
                continue
            # one row of each new form; equal forms have equal columns
            rest = ["text", "rest", "frame", "rare", "numbers"]
            forms = fresh.join(there.groupBy(key).agg(*[F.first(c).alias(c) for c in rest]), key)
            forms = forms.withColumns({f"d{i}": F.levenshtein("text", F.lit(p)) for i, p in enumerate(self.pivots)})
            self._write(forms.withColumn("range", F.floor(F.col("d0") / RANGE)), "forms", batch, "range")
        columns = "seq long, text string, rest string, frame string, rare array<string>, numbers string, d0 int, d1 int, range long"
        asked = self.spark.read.schema(columns).parquet(f"{self.folder}/forms/batch={batch}")
        ranges = [r[0] for r in asked.select("range").distinct().collect()]  # few: headlines are short
        wanted = sorted({x + d for x in ranges for d in (-1, 0, 1)})
        stored = self._read("forms", columns, batch).where(F.col("range").isin(wanted))
        links.append(near_forms(asked.drop("range"), stored.drop("range"), slips=True))
        self._write(functools.reduce(DataFrame.unionByName, links), "links", batch)
        self.spark.createDataFrame([(batch,)], "batch string").coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/done/of={batch}")
        if batch not in self.batches:
            self.batches.append(batch)

    def duplicates(self) -> DataFrame:
        """``first_seq, dup_seq`` of every stored row that announces an article already announced by a smaller ``seq``."""
        first = components(self._read("links", "a long, b long"))
        return first.where("first < seq").select(F.col("first").alias("first_seq"), F.col("seq").alias("dup_seq"))


def jump(now: DataFrame, key: str, label: str) -> DataFrame:
    """Replaces each label by the label of the row it names, so that rounds grow with the logarithm of a chain."""
    onward = now.groupBy(F.col(key).alias("named")).agg(F.min(label).alias("onward"))
    return now.join(onward, F.col(label) == F.col("named"), "left").withColumn(label, F.least(label, F.coalesce("onward", label))).drop("named", "onward")


def components(links: DataFrame) -> DataFrame:
    """``seq, first``: every number in ``links`` (``a, b``) with the smallest that it is linked with, directly or over others."""
    both = links.select(F.col("a").alias("seq"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("seq"), F.col("a").alias("other")))
    both = cut(both.distinct())
    labels = both.groupBy("seq").agg(F.min("other").alias("first")).withColumn("first", F.least("seq", "first"))
    while True:
        now = both.join(labels.withColumnRenamed("seq", "other"), "other").groupBy("seq").agg(F.min("first").alias("least"))
        now = now.join(labels, "seq").select("seq", F.col("first").alias("before"), F.least("first", "least").alias("first"))
        now = cut(jump(cut(now), "seq", "first"))
        changed = now.where("first < before").limit(1).count()
        labels = now.drop("before")
        if not changed:
            break
    return labels


def duplicates(batches: list[DataFrame]) -> DataFrame:
    """``first_seq, dup_seq`` after appending batches, in this order, to a new store."""
    store = ArticleStore.temporary(batches[0].sparkSession)
    for n, rows in enumerate(batches):
        store.append(rows, f"{n:04d}")
    return store.duplicates()
