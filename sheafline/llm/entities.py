"""Matching records of two tables that share no identifier: a cascade of exact joins on ever weaker attributes.

Each rule turns a record into keys that hold all it demands (identifier and title; identifier and a surname; title and a
surname; a rare title word and a surname; ...). Before each pass the records that earlier passes resolved are anti-joined away;
the others are linked to the smallest resolved record with the same key, which stays a target since a paper may have been
summarised twice, else to the smallest of themselves, so a key that many records have costs one link each. Links are closed
transitively.

Confidence is a rule's precision among pairs that can be labelled by an attribute the rule does not use (the identifier for
title rules, title words for identifier rules), smoothed towards ``prior``; a pair gets the lower of its two records' best.

Titles that several identifiers share (yearly editions, column headings) only count together with the identifier. Words
such as correction, reply, part or protocol and the numbers of a title belong to every key, so these papers stay apart.
Null, blank and placeholder attributes give no keys; records without any usable attribute match nothing; repeated ids
and repeated rows give each pair once.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm import passages as P
from sheafline.llm.batches import frequent_words, jump
from sheafline.llm.headlines import LIGHT, MARKERS, UNTITLED, Speller, fold, words
from sheafline.session import cut, spread

_DOI = re.compile(r"10\.\d{4,9}/[-._;()/:a-z0-9]+")
_TITLES = frozenset("dr prof professor mr mrs ms md phd msc bsc".split())
_NOBODY = frozenset("unknown anonymous editorial office staff na none et al and others".split())


def clean_doi(doi: str | None) -> str | None:
    """Identifier in lower case without prefix and trailing punctuation."""
    if not doi or not (m := _DOI.search(fold(doi).replace(" ", ""))):
        return None
    return m.group().rstrip(").,;:") or None


def surnames(authors) -> list[str]:
    """Surnames in whatever order and form the names are written; none for offices and placeholders."""
    out = set()
    for entry in authors if authors is not None else []:
        for name in re.split(r"\s*;\s*|\s+(?:and|und|et|y)\s+(?!al\b)", entry or ""):
            text = fold(name)
            head, comma, _ = text.partition(",")
            ws = [w for w in re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", head if comma else text) if w not in _TITLES]
            if not ws or all(w in _NOBODY for w in ws):
                continue
            if comma or len(ws) == 1:
                last = ws[-1]
            else:
                raw = re.findall(r"[^\W\d_]+(?:['’-][^\W\d_]+)*", name)
                last = ws[0] if len(raw[-1]) <= 2 and raw[-1].isupper() and len(ws[0]) > 2 else ws[-1]
            if len(last) > 1 and last not in _NOBODY:
                out.add(last)
    return sorted(out)


def prepared(records: DataFrame, side: str, id_col: str = "paper_id") -> DataFrame:
    """``id, side, doi, bag, sig, names``: clean attributes of each record."""
    df = records.select(F.col(id_col).cast("long").alias("id"), F.col("title").cast("string").alias("title"), F.col("doi").cast("string").alias("doi"), F.col("authors").cast("array<string>").alias("authors"), F.col("source").cast("string").alias("source"))

    def apply(b: pd.DataFrame) -> pd.DataFrame:
        heads = [h if (h := " ".join(words(t, s))) and h not in UNTITLED else None for t, s in zip(b["title"], b["source"])]
        return pd.DataFrame({"id": b["id"], "side": side, "doi": [clean_doi(d) for d in b["doi"]], "head": heads, "names": [surnames(a) for a in b["authors"]]})

    return P.map_batches(spread(df.where("id is not null")), apply, "id long, side string, doi string, head string, names array<string>")


def _titled(records: DataFrame) -> DataFrame:
    """Adds ``bag`` (corrected words, sorted), ``sig`` (numbers and markers), ``rare`` (words that are no usual ones) and ``frame`` (the usual ones)."""
    heads = records.where("head is not null").select("head").distinct()
    known = records.sparkSession.sparkContext.broadcast(frequent_words(heads, share=0.003))
    made: dict[int, Speller] = {}

    def apply(b: pd.DataFrame) -> pd.DataFrame:
        if 0 not in made:
            made[0] = Speller(known.value)
        spell = made[0]
        bag, sig, rare, frame = [], [], [], []
        for h in b["head"]:
            ws = [spell(w) for w in h.split(" ") if w not in LIGHT] if h else []
            bag.append(" ".join(sorted(set(ws))) or None)
            sig.append(" ".join(w for w in ws if w in MARKERS or (w.isdigit() and len(w) == 4)))
            rare.append(sorted({w for w in ws if w not in spell.frequent and not w.isdigit() and len(w) > 4}))
            frame.append(" ".join(sorted({w for w in ws if w in spell.frequent})) or None)
        return b.assign(bag=bag, sig=sig, rare=rare, frame=frame)

    return P.map_batches(records, apply, "id long, side string, doi string, head string, names array<string>, bag string, sig string, rare array<string>, frame string")


def _keys(r: DataFrame) -> dict[str, DataFrame]:
    """``id, side, key`` per rule, strongest first."""
    c = F.col
    untitled = c("bag").isNull()
    lone = c("shared").isNull()  # a title that stands for one paper
    name, rare, word = F.explode("names"), F.explode("rare"), F.explode(F.split("bag", " "))
    two = F.explode(F.transform(F.sequence(F.lit(0), F.size("names") - 2), lambda i: F.concat_ws(" ", F.get("names", i), F.get("names", i + 1))))
    rules = {
        "doi and title": r.where("doi is not null and bag is not null").select("id", "side", "doi", "bag"),
        "doi, name and kind of title": r.where("doi is not null and bag is not null").select("id", "side", "doi", "sig", name.alias("n")),
        "doi and rare title word": r.where("doi is not null and bag is not null").select("id", "side", "doi", "sig", rare.alias("w")),
        "doi and usual title words": r.where("doi is not null and frame is not null").select("id", "side", "doi", "sig", "frame"),
        "title and name": r.where(c("bag").isNotNull() & lone).select("id", "side", "bag", name.alias("n")),
        "rare title word and two names": r.where(c("bag").isNotNull() & lone & (F.size("names") >= 2)).select("id", "side", "sig", two.alias("n"), "rare").select("id", "side", "sig", "n", rare.alias("w")),
        "rare title word and name": r.where(c("bag").isNotNull() & lone).select("id", "side", "sig", "rare", name.alias("n")).select("id", "side", "sig", "n", rare.alias("w")),
        "doi, one without title": r.where(c("doi").isNotNull()).select("id", "side", "doi", name.alias("n"), untitled.alias("u")),
        "title, one without names": r.where(c("bag").isNotNull() & lone & (F.size(F.split("bag", " ")) >= 6)).select("id", "side", "bag", (F.size("names") == 0).alias("u")),
        "doi, one bare": r.where(c("doi").isNotNull()).select("id", "side", "doi", (untitled & (F.size("names") == 0)).alias("u")),
    }
    out = {}
    for rule, df in rules.items():
        cols = [x for x in df.columns if x not in ("id", "side", "u")]
        df = df.select("id", "side", F.xxhash64(F.lit(rule), *cols).alias("key"), (F.col("u") if "u" in df.columns else F.lit(True)).alias("needed"))
        out[rule] = df.groupBy("id", "side", "key").agg(F.max("needed").alias("needed"))
    return out


def cascade(pdf: DataFrame, html: DataFrame, id_col: str = "paper_id") -> tuple[DataFrame, DataFrame]:
    """Records (``id, side, doi, bag, ...``) and links ``a, b, rule`` (a < b, smallest of the key group first)."""
    records = cut(_titled(cut(prepared(pdf, "pdf", id_col).unionByName(prepared(html, "html", id_col)))))
    # titles under several identifiers, each stated by at least two records or by most of a short list
    stated = records.where("bag is not null and doi is not null").groupBy("bag", "doi").agg(F.count(F.lit(1)).alias("n"))
    shared = stated.groupBy("bag").agg(F.sum((F.col("n") >= 2).cast("int")).alias("firm"), F.count(F.lit(1)).alias("all"))
    shared = shared.where("firm >= 2 or all >= 4").select("bag", F.lit(True).alias("shared"))
    short = F.size(F.split("bag", " ")) < 4
    records = records.join(shared, "bag", "left").withColumn("shared", F.when(F.coalesce("shared", short), True))
    links = None
    for number, (rule, keys) in enumerate(_keys(records).items()):
        if links is None:
            asking = keys.withColumn("open", F.lit(True))
        else:
            done = links.where("sides = 2").select(F.explode(F.array("a", "b")).alias("id")).distinct()
            asking = keys.join(done, "id", "left_anti").withColumn("open", F.lit(True))
            targets = keys.join(done, "id", "left_semi").withColumn("open", F.lit(False))
            asking = asking.unionByName(targets)
        # open records of a key are linked to its smallest resolved record, else to the smallest of themselves
        groups = asking.groupBy("key").agg(
            F.coalesce(F.min(F.when(~F.col("open"), F.col("id"))), F.min("id")).alias("target"), F.count(F.lit(1)).alias("n"), F.max("needed").alias("needed"), F.countDistinct("side").alias("sides"),
        ).where("n > 1 and needed")
        found = asking.where("open").join(groups, "key").select(F.least("target", "id").alias("a"), F.greatest("target", "id").alias("b"), "sides")
        found = cut(found.where("a < b").select("a", "b", "sides", F.lit(rule).alias("rule"), F.lit(number).alias("number")).distinct())
        links = found if links is None else links.unionByName(found)
    return records, links.where("a < b").groupBy("a", "b").agg(F.min(F.struct("number", "rule")).alias("r")).select("a", "b", F.col("r.rule").alias("rule"))


def rule_precision(records: DataFrame, links: DataFrame, prior: float = 0.9, weight: float = 10.0) -> DataFrame:
    """``rule, labelled, agreeing, precision``: agreement on the attribute that the rule leaves out, smoothed."""
    side = lambda p: records.select(F.col("id").alias(p), F.col("doi").alias(f"doi_{p}"), F.col("rare").alias(f"rare_{p}"), F.col("bag").alias(f"bag_{p}"))
    pairs = links.join(side("a"), "a").join(side("b"), "b")
    by_doi = F.when(F.col("doi_a").isNotNull() & F.col("doi_b").isNotNull(), F.col("doi_a") == F.col("doi_b"))
    by_title = F.when(F.col("bag_a").isNotNull() & F.col("bag_b").isNotNull(), (F.col("bag_a") == F.col("bag_b")) | F.arrays_overlap("rare_a", "rare_b"))
    label = F.when(F.col("rule").startswith("doi"), by_title).otherwise(by_doi)
    n, k = F.count(label), F.coalesce(F.sum(label.cast("long")), F.lit(0))
    return pairs.groupBy("rule").agg(n.alias("labelled"), k.alias("agreeing"), ((k + prior * weight) / (n + weight)).alias("precision"))


def matches(pdf: DataFrame, html: DataFrame, id_col: str = "paper_id") -> DataFrame:
    """``pdf_id, html_id, confidence`` of each pair of records that stand for one paper."""
    records, links = cascade(pdf, html, id_col)
    links = cut(links)
    sure = links.join(rule_precision(records, links).select("rule", "precision"), "rule")
    both = sure.select("a", "b", "precision").unionByName(sure.select(F.col("b").alias("a"), F.col("a").alias("b"), "precision"))
    both = cut(both)
    own = both.groupBy(F.col("a").alias("id")).agg(F.max("precision").alias("own"))
    labels = own.select("id", F.col("id").alias("label"))
    while True:
        least = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("least"))
        now = labels.join(least, "id").select("id", F.least("label", "least").alias("label"), (F.col("least") < F.col("label")).alias("moved"))
        now = cut(jump(cut(now), "id", "label"))
        changed = now.where("moved").limit(1).count()
        labels = now.drop("moved")
        if not changed:
            break
    placed = labels.join(own, "id").join(records.select("id", "side").distinct(), "id")
    p = placed.where("side = 'pdf'").select("label", F.col("id").alias("pdf_id"), F.col("own").alias("c1"))
    h = placed.where("side = 'html'").select("label", F.col("id").alias("html_id"), F.col("own").alias("c2"))
    return p.join(h, "label").groupBy("pdf_id", "html_id").agg(F.max(F.least("c1", "c2")).alias("confidence"))
