"""Values cut by a length limit or a broken transfer: self-join by prefix in sorted order, with length and word evidence.

All distinct values are range-partitioned and sorted; the values that a stem begins follow it without a gap, so each stem is
carried forward past values that only add a mark to its first continuation, and no hot prefix can fill a task; the few stems
still carried at the end of a partition are compared with the first values of the next. A value is reported if

* it ends in a damaged character;
* it carries a cut mark and a longer copy exists, or it does not recur on many sites and its length falls where its source's marked values crowd, or (where a
  field's complete values end in sentence punctuation) neither holds but its last word is a fragment;
* it carries no mark and a longer copy goes on within the same word or phrase, or its length is one at which its source's
  values pile up and it does not end as complete values do, or its last word is a fragment of a known word or one that
  complete values never end with;
* in a field of sentences, it lacks the final punctuation and does not end as keyword lists and bracketed figures do.

Counts of lengths and words cover all rows. Null and blank values are no cases; repeated ids give one row.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.session import cut

_MARK = r"\s*(?:\.\.\.|…|\[…\]|\[\.\.\.\])$"
_BROKEN = r"�+\s*$"
_ONLY_MARK = r"\s*(?:\.\.\.|…|\[…\]|\[\.\.\.\])?\s*�*\s*"


def with_longer(values: DataFrame, least: int = 8) -> DataFrame:
    """``field_name, stem, longer``: the text that goes on after each stem that is a strict prefix of another value.

    Of several such values the first in sorted order that adds more than a cut mark counts. ``values``: ``field_name, stem`` (looked up) and ``value``. Stems shorter than ``least`` have no copies.
    """
    # one list of texts; flag 0 marks values that are only looked at as copies
    both = lambda text, asked: F.struct(text.alias("text"), F.lit(asked).alias("asked"))
    stem, value = F.col("stem"), F.col("value")
    each = F.explode(F.when(stem == value, F.array(both(stem, 1))).otherwise(F.array(both(stem, 1), both(value, 0)))).alias("t")
    texts = values.select("field_name", each).select("field_name", "t.*").where(F.length("text") >= least)
    texts = texts.groupBy("field_name", "text").agg(F.max("asked").alias("asked"))
    parts = max(1, int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ordered = texts.repartitionByRange(parts, "field_name", "text").sortWithinPartitions("field_name", "text")

    columns = ["field_name", "stem", "longer", "part", "place"]

    def carried(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only_mark = re.compile(_ONLY_MARK).fullmatch
        field, held = None, []  # stems of which each begins the next, without continuation so far
        part, place, open_ = TaskContext.get().partitionId(), 0, None
        for b in batches:
            out = []
            for name, text, asked in zip(b["field_name"], b["text"], b["asked"]):
                # what earlier partitions' stems go on with: the first text, and those behind it while it may only add a mark to them
                if open_ is None:
                    first, open_ = name, [text[:n] for n in range(len(text)) if only_mark(text, n)]
                    out.append((name, None, text, part, place))
                elif open_:
                    place += 1
                    open_ = [x for x in open_ if name == first and text.startswith(x) and only_mark(text, len(x))]
                    out.append((name, None, text, part, place))
                still = []
                for x in held if name == field else ():
                    if text.startswith(x):
                        if only_mark(text, len(x)):
                            still.append(x)
                        else:
                            out.append((name, x, text[len(x) :], part, None))
                field, held = name, [*still, text] if asked else still
            yield pd.DataFrame(out, columns=columns).astype({"place": "Int64"})
        if held:
            yield pd.DataFrame([(field, x, None, part, None) for x in held], columns=columns).astype({"place": "Int64"})

    seen = cut(ordered.mapInPandas(carried, "field_name string, stem string, longer string, part int, place long"))  # once: another run could draw other borders
    inner = seen.where("stem is not null and longer is not null").select("field_name", "stem", "longer")
    # borders: the stems that a partition leaves (each begins the next one) go on with the first texts of those after it
    ends = seen.where("stem is null or longer is null").orderBy("part", "place").collect()
    firsts, later = [r for r in ends if r["stem"] is None], []
    for r in ends:
        if r["stem"] is not None:
            for f in firsts[bisect.bisect_right(firsts, r["part"], key=lambda f: f["part"]) :]:
                if f["field_name"] != r["field_name"] or not f["longer"].startswith(r["stem"]):
                    break
                if not re.fullmatch(_ONLY_MARK, f["longer"][len(r["stem"]) :]):
                    later.append((r["field_name"], r["stem"], f["longer"][len(r["stem"]) :]))
                    break
    return inner.unionByName(values.sparkSession.createDataFrame(later, inner.schema))


def _words(text: Column) -> Column:
    """Lower-case words; apostrophes and hyphens belong to them."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}'’-]+"), F.lit(0))


def _word(text: Column) -> Column:
    """The last word, looked for among the last three parts of the text."""
    return F.coalesce(F.try_element_at(_words(F.substring_index(text, " ", -3)), F.lit(-1)), F.lit(""))


def evidence(values: DataFrame, others: DataFrame, sentence_fields: tuple[str, ...] = ()) -> DataFrame:
    """All rows of ``values`` (``field_name, row_id, source, value``) with the evidence about each.

    ``others``: ``field_name, value`` of further copies, never reported.
    """
    clean = F.regexp_replace(F.col("value"), r"(?U)^\s+|\s+$", "")
    rows = values.select("field_name", F.col("row_id").cast("long").alias("row_id"), F.coalesce("source", F.lit("")).alias("source"), clean.alias("value"), F.length("value").alias("n"))
    rows = rows.where(F.length("value") > 0)
    rows = rows.withColumn("stem", F.regexp_replace(F.regexp_replace("value", _MARK, ""), _BROKEN, ""))
    sentence = F.col("field_name").isin(*sentence_fields) if sentence_fields else F.lit(False)
    ended = F.col("value").rlike(r"[.!?][\"'”’»)\]]*(?:\s?\[\d+(?:[,–-]\d+)*\])?$")
    kind = F.when(F.col("value").rlike(_BROKEN), "broken").when(F.col("value").rlike(_MARK), "marked").when(sentence & ended, "ended").otherwise("open")
    rows = rows.withColumn("kind", kind)

    # lengths: how many values of the source, of the same kind, have this length, about this length, and in all
    lengths = rows.groupBy("field_name", "source", "kind", "n").agg(F.count(F.lit(1)).alias("same"))
    by = Window.partitionBy("field_name", "source", "kind")
    near = by.orderBy("n")
    lengths = lengths.select(
        "field_name", "source", "kind", "n", "same", F.sum("same").over(near.rangeBetween(-8, 8)).alias("near"), F.sum("same").over(near.rangeBetween(-4, 4)).alias("close"), F.sum("same").over(by).alias("all"),
    )
    rows = rows.join(lengths, ["field_name", "source", "kind", "n"])
    # a pile: about five times as many at one length as at the lengths around it
    rows = rows.withColumn("pile", (F.col("same") >= 6) & (F.col("same") > 0.6 * (F.col("close") - F.col("same"))))
    rows = rows.withColumn("crowd", (F.col("near") >= 3) & (F.col("near") >= 0.12 * F.col("all")))

    rows = cut(rows)  # read by four branches below

    # the same marked value on many sites is a title that its author ended so
    spread = rows.where("kind = 'marked'").groupBy("field_name", "value").agg(F.approx_count_distinct("source").alias("sites")).where("sites >= 3").withColumn("recurring", F.lit(True))
    rows = rows.join(spread.select("field_name", "value", "recurring"), ["field_name", "value"], "left")

    # words: how often each stands inside and at the end of values whose end nothing speaks against
    extra = others.select("field_name", F.lit("open").alias("kind"), F.lit(False).alias("pile"), F.regexp_replace("value", r"(?U)^\s+|\s+$", "").alias("stem")).where("length(stem) > 0")
    texts = rows.select("field_name", "kind", "pile", "stem").unionByName(extra)
    spelled = texts.select("field_name", F.explode(F.array(_words(F.col("stem")))).alias("words"))  # taken once for what follows
    inside = spelled.select("field_name", F.explode(F.slice("words", F.lit(1), F.greatest(F.size("words") - 1, F.lit(0)))).alias("word")).groupBy("field_name", "word").agg(F.count(F.lit(1)).alias("inside"))
    final = texts.where(F.col("kind").isin("open", "ended") & ~F.col("pile")).select("field_name", _word(F.col("stem")).alias("word")).groupBy("field_name", "word").agg(F.count(F.lit(1)).alias("final"))
    words = inside.join(final, ["field_name", "word"], "full").select("field_name", "word", F.coalesce("inside", F.lit(0)).alias("inside"), F.coalesce("final", F.lit(0)).alias("final"))
    words = cut(words)
    known = words.where("inside >= 2 or final >= 3")
    begun = F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.col("word").substr(F.lit(1), i))).alias("word")
    starts = known.where(F.length("word") > 1).select("field_name", begun, (F.col("inside") + F.col("final")).alias("uses"))
    starts = starts.groupBy("field_name", "word").agg(F.max("uses").alias("whole"))  # uses of the most usual word it begins
    words = words.join(starts, ["field_name", "word"], "full")
    rows = rows.withColumn("word", _word(F.col("stem"))).join(words, ["field_name", "word"], "left")
    inside, final = F.coalesce("inside", F.lit(0)), F.coalesce("final", F.lit(0))
    # a fragment's uses are few beside those of a word it begins, however often the table repeats it; its own end is no evidence for it
    others_end = final - (F.col("kind").isin("open", "ended") & ~F.col("pile")).cast("int")
    few = (inside < F.greatest(F.lit(2.0), F.col("whole") * 0.0005)) & (others_end < F.greatest(F.lit(2.0), F.col("whole") * 0.1))
    rows = rows.withColumn("fragment", F.col("whole").isNotNull() & few)
    rows = rows.withColumn("dangling", (inside >= 30) & (final < 0.01 * inside))
    rows = rows.withColumn("ends_well", (final >= 3) & (final >= 0.02 * inside))

    # copies
    # (letter case and white space do not count)
    fold = lambda c: F.trim(F.regexp_replace(F.lower(c), r"(?U)\s+", " "))
    rows = rows.withColumn("folded", fold("stem"))
    asked = rows.select("field_name", F.col("folded").alias("stem"), F.when(F.col("stem") == F.col("value"), F.col("folded")).otherwise(fold("value")).alias("value"))
    found = with_longer(asked.unionByName(others.select("field_name", F.lit("").alias("stem"), fold("value").alias("value")).where("value is not null")))
    rows = rows.join(found.withColumnRenamed("stem", "folded"), ["field_name", "folded"], "left").drop("folded")
    return rows.withColumn("copy", F.regexp_replace("longer", _MARK, "").rlike(r"^[\p{L}\p{N}]|^[ -][\p{L}\p{N}]|^, [\p{Ll}]"))


def cut_values(values: DataFrame, others: DataFrame, sentence_fields: tuple[str, ...] = ()) -> DataFrame:
    """``field_name, row_id, source, why`` of each cut value."""
    e = evidence(values, others, sentence_fields)
    sentence = F.col("field_name").isin(*sentence_fields) if sentence_fields else F.lit(False)
    c = F.col
    closed = c("value").rlike(r"[)\]]$") | c("value").rlike(r"(?i)\b(?:key ?words|schlüsselwörter|mots[- ]clés|palabras clave)\s*:[^.!?]*$")
    copy = F.coalesce(c("copy"), F.lit(False))
    why = (
        F.when(c("kind") == "broken", "damaged end")
        .when((c("kind") == "marked") & copy, "marked, longer copy")
        .when(c("recurring"), None)
        .when((c("kind") == "marked") & c("crowd") & (F.length("stem") >= 40), "marked, at the limit")
        .when((c("kind") == "marked") & (c("fragment") | (c("dangling") & ~sentence)) & (F.length("stem") >= 40), "marked, broken phrase")
        .when(c("kind") == "marked", None)
        .when((c("kind") == "open") & sentence & ~closed, "no end")
        .when((c("kind") == "open") & ~sentence & copy, "longer copy")
        .when((c("kind") == "open") & c("value").rlike(r"[\p{L}\p{N})][:,;(–-]+$"), "broken phrase")
        .when((c("kind") == "open") & c("pile") & ~c("ends_well") & ~(sentence & c("value").rlike(r"[)\]]$")), "at the limit")
        .when((c("kind") == "open") & ~sentence & (c("fragment") | c("dangling")) & (F.length("stem") >= 15), "broken phrase")
    )
    return e.withColumn("why", why).where("why is not null").select("field_name", "row_id", "source", "why").dropDuplicates(["field_name", "row_id"])


def rates(values: DataFrame, found: DataFrame) -> DataFrame:
    """``field_name, source, values, cut, rate``: how often each source cuts."""
    all_ = values.where(F.regexp_replace("value", r"(?U)\s+", "") != "").groupBy("field_name", "source").agg(F.countDistinct("row_id").alias("values"))
    hit = found.groupBy("field_name", "source").agg(F.count(F.lit(1)).alias("cut"))
    joined = all_.withColumn("source", F.coalesce("source", F.lit(""))).join(hit, ["field_name", "source"], "left").fillna(0, ["cut"])
    return joined.withColumn("rate", F.col("cut") / F.col("values"))
