"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.llm import abuse, batches, boilerplate, cutoff, entities, leakage, packing, residue, seen_keys
from sheafline.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query, and its SQL if given."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


_RUNS = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(lower(replace(replace(text, '-' || chr(10), ''), '‐' || chr(10), '')), '[\p{L}\p{N}]+') AS w FROM documents WHERE text IS NOT NULL),
         i AS (SELECT item_id, suite, regexp_extract_all(lower(replace(replace(text, '-' || chr(10), ''), '‐' || chr(10), '')), '[\p{L}\p{N}]+') AS w FROM test_items WHERE text IS NOT NULL),
         dr AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 11], ' ') AS run FROM d, unnest(range(1, greatest(len(w) - 10, 1))) AS t(k)),
         ir AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS run FROM i, unnest(range(1, greatest(len(w) - 10, 1))) AS t(k)),
         f AS (SELECT item_id, doc_id, count(*) AS shared FROM ir JOIN dr USING (run) GROUP BY item_id, doc_id),
         n AS (SELECT item_id, count(*) AS runs FROM ir GROUP BY item_id)
"""


@query("p9_found", _RUNS + "SELECT item_id, doc_id FROM f")
def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each evaluation item with each document that shares at least twelve consecutive words with it."""
    return leakage.leaks(table(spark, folder, "test_items"), table(spark, folder, "documents")).select("item_id", "doc_id")


@query(
    "p9_items",
    _RUNS + "SELECT f.item_id, count(*) AS documents, max(shared / runs) AS largest_share, any_value(suite) AS suite FROM f JOIN n ON f.item_id = n.item_id JOIN i ON f.item_id = i.item_id GROUP BY f.item_id",
)
def p9_items(spark: SparkSession, folder: str) -> DataFrame:
    """Per leaked item: documents that contain some of it, and the largest part found in one document."""
    items = table(spark, folder, "test_items")
    found = leakage.leaks(items, table(spark, folder, "documents"))
    per = found.groupBy("item_id").agg(F.count(F.lit(1)).alias("documents"), F.max(F.col("shared_runs") / F.col("item_runs")).alias("largest_share"))
    return per.join(items.select("item_id", "suite"), "item_id")


@query(
    "p5_found",
    r"""
    WITH a AS (SELECT arrival_no, lower(regexp_replace(id, '^\s+|\s+$', '', 'g')) AS k FROM arrivals WHERE id IS NOT NULL),
         s AS (SELECT DISTINCT lower(regexp_replace(id, '^\s+|\s+$', '', 'g')) AS k FROM seen_articles),
         f AS (SELECT k, min(arrival_no) AS first_no FROM a WHERE k <> '' GROUP BY k)
    SELECT a.arrival_no FROM a JOIN f ON a.k = f.k LEFT JOIN s ON a.k = s.k
    WHERE s.k IS NOT NULL OR a.arrival_no > f.first_no
    """,
)
def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Arrivals whose key occurred before."""
    return seen_keys.seen_before(seen_keys.stored(table(spark, folder, "seen_articles")), table(spark, folder, "arrivals"))


@query("p5_rates")
def p5_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rate of wrong answers of the set that p5_found uses, audited and in theory."""
    history = table(spark, folder, "seen_articles")
    return seen_keys.wrong_answers(seen_keys.stored(history), history, table(spark, folder, "arrivals"))


def _residue(spark: SparkSession, folder: str, names: tuple[str, ...] = ("text", "abstract")) -> DataFrame:
    """p4's rows, also for the queries that leave such values out. The model is always fitted on both fields."""
    found = residue.residue(table(spark, folder, "page_extracts"), names=names, fitted=("text", "abstract"))
    return found.where("residue").select(F.col("id").alias("page_id"), "field_name").distinct()


@query("p4_found")
def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Values without real content, or with unfilled placeholders or filler in it."""
    return _residue(spark, folder)


@query("p6_found")
def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of page text that are not article body."""
    pages = table(spark, folder, "page_extracts").select("page_id", "source", "text")
    bad = _residue(spark, folder, ("text",)).select("page_id")
    return boilerplate.furniture(pages.join(bad, "page_id", "left_anti")).select("page_id", "line_no")


def _titles_and_abstracts(spark: SparkSession, folder: str, with_residue: bool) -> tuple[DataFrame, DataFrame]:
    pages = table(spark, folder, "page_extracts")
    titles = table(spark, folder, "list_links").select(F.lit("title").alias("field_name"), F.col("link_id").alias("row_id"), "source", F.col("title").alias("value"))
    abstracts = pages.select(F.lit("abstract").alias("field_name"), F.col("page_id").alias("row_id"), "source", F.col("abstract").alias("value"))
    if with_residue:
        bad = _residue(spark, folder, ("abstract",)).select(F.col("page_id").alias("row_id"))
        abstracts = abstracts.join(bad, "row_id", "left_anti").select(abstracts.columns)
    others = [table(spark, folder, t).select(F.lit("title").alias("field_name"), F.col("title").alias("value")) for t in ("feed_items", "page_extracts")]
    return titles.unionByName(abstracts), others[0].unionByName(others[1]).where("value is not null")


@query("p7_found")
def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Titles of links and abstracts of pages that were cut."""
    values, others = _titles_and_abstracts(spark, folder, True)
    return cutoff.cut_values(values, others, ("abstract",)).select("field_name", "row_id")


@query("p7_rates")
def p7_rates(spark: SparkSession, folder: str) -> DataFrame:
    """How often each source cuts titles and abstracts."""
    values, others = _titles_and_abstracts(spark, folder, True)
    return cutoff.rates(values, cutoff.cut_values(values, others, ("abstract",)))


@query("p8_bins")
def p8_bins(spark: SparkSession, folder: str) -> DataFrame:
    """Every text, or piece of a text that alone exceeds the capacity, with its container."""
    return packing.packed(table(spark, folder, "documents"))


@query("p8_space")
def p8_space(spark: SparkSession, folder: str) -> DataFrame:
    """Unused space of the containers."""
    return packing.space(packing.packed(table(spark, folder, "documents")))


@query("p2_found")
def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of later batches that announce an article already known, with the row that announced it first."""
    feed = table(spark, folder, "feed_items").select("seq", "batch_no", "url", "title", "source")
    history, later = feed.where("batch_no is null or batch_no < 1"), feed.where("batch_no >= 1")
    found = batches.duplicates([history, later])
    return found.join(later.select(F.col("seq").cast("long").alias("dup_seq")), "dup_seq", "left_semi").select("first_seq", "dup_seq")


@query("p1_found")
def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of records made from the PDF and from the page of one paper."""
    return entities.matches(table(spark, folder, "summaries_pdf"), table(spark, folder, "summaries_html")).select("pdf_id", "html_id")


@query("p1_pairs")
def p1_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with their confidence."""
    return entities.matches(table(spark, folder, "summaries_pdf"), table(spark, folder, "summaries_html"))


@query("p10_found")
def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with an abusive, hateful, threatening or sexually explicit passage."""
    return abuse.scores(table(spark, folder, "documents")).where("abusive").select("doc_id").distinct()


@query("p10_scores")
def p10_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every document."""
    return abuse.scores(table(spark, folder, "documents")).select("doc_id", "score")


@query("p10_rates")
def p10_rates(spark: SparkSession, folder: str) -> DataFrame:
    """Rates per source."""
    docs = table(spark, folder, "documents")
    return abuse.source_rates(docs, abuse.scores(docs))
