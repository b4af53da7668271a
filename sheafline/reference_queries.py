"""Queries of the harvesting operators over the given tables, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sheafline.functions import html, text, url
from sheafline.operators import audit, enrich, failures, fulltext, items, summaries
from sheafline.queries import query
from sheafline.schemas import SUMMARY_KEYS
from sheafline.session import shared_folder, table
from sheafline.sinks import day_path, object_address
from sheafline.sources import readers

_WS = r"[\s\x{85}\x{a0}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{1680}]"
_STRIP = rf"'^{_WS}+|{_WS}+$', '', 'g'"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, {_STRIP})"


@query(
    "items_keep_first",
    f"""SELECT seq, url, source FROM (
      SELECT seq, url, source, row_number() OVER (PARTITION BY md5(split_part(lower({_strip('url')}), '?', 1)) ORDER BY seq) AS n FROM feed_items WHERE url IS NOT NULL) WHERE n = 1""",
)
def items_keep_first(spark: SparkSession, folder: str) -> DataFrame:
    """Items with the first occurrence of each normalised address."""
    return items.deduplicated(table(spark, folder, "feed_items").select("seq", "url", "source"))


@query(
    "links_once_per_page",
    """SELECT link_id, page_url, url FROM (SELECT link_id, page_url, url, row_number() OVER (PARTITION BY page_url, url ORDER BY pos, link_id) AS n FROM list_links WHERE url IS NOT NULL) WHERE n = 1""",
)
def links_once_per_page(spark: SparkSession, folder: str) -> DataFrame:
    """Each link once per page, the topmost."""
    links = table(spark, folder, "list_links").select("link_id", "page_url", "url", "pos").where("url is not null").withColumn("o", F.struct("pos", "link_id"))
    return items.first_by(links, F.struct("page_url", "url"), "o").select("link_id", "page_url", "url")


_HOST = "regexp_extract(coalesce({0}, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"
_PATH = "regexp_extract(regexp_replace(coalesce({0}, ''), '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?', ''), '^[^?#]*')"
_ARTICLE = f"""CASE WHEN coalesce(url, '') = '' THEN false
  WHEN {_HOST.format('url')} <> '' AND NOT contains({_HOST.format('url')}, {_HOST.format('page_url')}) THEN false
  WHEN regexp_matches(url, '(?i){"|".join(url.OTHER_PATTERNS)}') THEN false
  WHEN regexp_matches(url, '(?i){"|".join(url.ARTICLE_PATTERNS)}') THEN true
  ELSE length({_PATH.format('url')}) - length(replace({_PATH.format('url')}, '/', '')) >= 2 AND length({_PATH.format('url')}) > 15 END"""


@query("article_addresses", f"SELECT link_id, {_ARTICLE} AS is_article FROM list_links")
def article_addresses(spark: SparkSession, folder: str) -> DataFrame:
    """Which links look like articles of the page's site."""
    links = table(spark, folder, "list_links")
    return links.select("link_id", url.is_article(F.col("url"), url.netloc(F.col("page_url"))).alias("is_article"))


@query("address_parts", f"SELECT seq, {_HOST.format('url')} AS host, {_PATH.format('url')} AS path, lower(regexp_extract(coalesce(url, ''), '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme FROM feed_items")
def address_parts(spark: SparkSession, folder: str) -> DataFrame:
    """Host, path and scheme of addresses."""
    u = F.col("url")
    return table(spark, folder, "feed_items").select("seq", url.netloc(u).alias("host"), url.path(u).alias("path"), url.scheme(u).alias("scheme"))


@query("absolute_links", "SELECT link_id, url AS absolute, url AS joined FROM list_links WHERE url LIKE 'http%' AND page_url LIKE 'http%'")
def absolute_links(spark: SparkSession, folder: str) -> DataFrame:
    """Site-relative links made absolute again, by expression and by the general resolver."""
    links = table(spark, folder, "list_links").where("url like 'http%' and page_url like 'http%'")
    same = url.netloc(F.col("url")) == url.netloc(F.col("page_url"))
    href = F.when(same, F.regexp_replace("url", r"^[a-z]+://[^/]*", "")).otherwise(F.col("url"))
    href = F.when(F.startswith(href, F.lit("/")), href).otherwise(F.col("url"))
    return links.select("link_id", url.absolute(href, F.col("page_url")).alias("absolute"), url.joined(F.col("page_url"), href).alias("joined"))


@query("clean_titles", f"SELECT link_id, CASE WHEN length({_strip('title')}) > 200 THEN {_strip('title')}[1:200] || '...' ELSE {_strip('title')} END AS title FROM list_links")
def clean_titles(spark: SparkSession, folder: str) -> DataFrame:
    """Titles stripped and cut as list pages do."""
    return table(spark, folder, "list_links").select("link_id", text.clean_title(F.col("title")).alias("title"))


_METHOD = "coalesce(fetch_method, 'rss')"


@query(
    "source_dispatch",
    f"""SELECT name, CASE WHEN {_METHOD} IN ('rss', 'sitemap', 'list_page') THEN {_METHOD} END AS method,
      CASE {_METHOD} WHEN 'rss' THEN nullif(rss, '') WHEN 'sitemap' THEN nullif(sitemap, '') WHEN 'list_page' THEN nullif(url, '') END AS address FROM sources""",
)
def source_dispatch(spark: SparkSession, folder: str) -> DataFrame:
    """How and where each source is read."""
    return items.dispatched(table(spark, folder, "sources"))


_AUDIT = f"""SELECT name, {_METHOD} AS method, coalesce(n, 0) AS article_count,
  CASE WHEN {_METHOD} NOT IN ('rss', 'sitemap', 'list_page') THEN 'error' WHEN coalesce(n, 0) = 0 THEN 'empty' WHEN n < 5 THEN 'low' ELSE 'ok' END AS status
  FROM sources LEFT JOIN (SELECT source, count(*) AS n FROM list_links GROUP BY source) c ON c.source = sources.name"""


def _audited(spark: SparkSession, folder: str) -> DataFrame:
    links = table(spark, folder, "list_links").select(F.col("link_id").alias("seq"), "source", "title", "url")
    return audit.audit(table(spark, folder, "sources"), links)


@query("source_audit", _AUDIT)
def source_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Links and status of every source."""
    return _audited(spark, folder).select("name", "method", "article_count", "status")


@query("audit_totals", f"SELECT status, count(*) AS sources, CAST(sum(article_count) AS BIGINT) AS articles FROM ({_AUDIT}) GROUP BY ROLLUP (status)")
def audit_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Sources and links per status and in all."""
    return audit.totals(_audited(spark, folder))


@query(
    "audit_samples",
    "SELECT source AS name, n AS rank, title[1:80] AS title, url[1:100] AS url FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY link_id) AS n FROM list_links WHERE source IN (SELECT name FROM sources)) WHERE n <= 3",
)
def audit_samples(spark: SparkSession, folder: str) -> DataFrame:
    """The first three links of each source."""
    s = _audited(spark, folder).select("name", F.posexplode("sample_articles").alias("p", "s"))
    return s.select("name", (F.col("p") + 1).cast("long").alias("rank"), "s.title", "s.url")


@query("well_filled_sources", f"SELECT name, article_count FROM ({_AUDIT}) WHERE article_count >= 10 ORDER BY name LIMIT 5")
def well_filled_sources(spark: SparkSession, folder: str) -> DataFrame:
    """The first five sources by name with at least ten links (a top-k report)."""
    return _audited(spark, folder).where("article_count >= 10").select("name", "article_count").orderBy("name").limit(5)


@query(
    "items_together",
    "SELECT 'feed' AS kind, seq AS id, url, source, title, doi FROM feed_items UNION ALL SELECT 'list', link_id, url, source, title, NULL FROM list_links",
)
def items_together(spark: SparkSession, folder: str) -> DataFrame:
    """Items of feeds and list pages by name; the latter have no identifier."""
    feed = table(spark, folder, "feed_items").select(F.lit("feed").alias("kind"), F.col("seq").alias("id"), "url", "source", "title", "doi")
    return items.together(feed, table(spark, folder, "list_links").select(F.lit("list").alias("kind"), F.col("link_id").alias("id"), "url", "source", "title"))


@query("items_with_source", "SELECT seq, source, s.type AS type, s.pdf_strategy AS pdf_strategy, coalesce(f.selectors['article_link'], CASE WHEN f.selectors IS NULL THEN s.selectors['article_link'] END) AS article_link FROM feed_items f JOIN sources s ON s.name = f.source")
def items_with_source(spark: SparkSession, folder: str) -> DataFrame:
    """Items with their source's settings."""
    found = items.annotated(table(spark, folder, "feed_items").select("seq", "source", "selectors"), table(spark, folder, "sources"))
    return found.select("seq", "source", "type", "pdf_strategy", F.try_element_at("selectors", F.lit("article_link")).alias("article_link"))


@query("unseen_arrivals", "SELECT arrival_no, id FROM arrivals WHERE id IS NULL OR id NOT IN (SELECT id FROM seen_articles)")
def unseen_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Arrivals whose key, as written, is not in the table of seen ones."""
    return items.unseen(table(spark, folder, "arrivals").select("arrival_no", "id"), table(spark, folder, "seen_articles"), "id")


@query("keys_to_mark", "SELECT DISTINCT id FROM arrivals WHERE id IS NOT NULL AND id NOT IN (SELECT id FROM seen_articles)")
def keys_to_mark(spark: SparkSession, folder: str) -> DataFrame:
    """Keys to append to the table of seen ones."""
    return items.marked(table(spark, folder, "seen_articles"), table(spark, folder, "arrivals"), "id")


@query("first_dois", f"SELECT paper_id, nullif(regexp_extract(doi, '{text.DOI}'), '') AS doi FROM summaries_pdf")
def first_dois(spark: SparkSession, folder: str) -> DataFrame:
    """Identifier in each field; trailing punctuation stays, as greedy matching keeps it."""
    return table(spark, folder, "summaries_pdf").select("paper_id", text.first_doi(F.col("doi")).alias("doi"))


@query("smallest_dois", f"SELECT DISTINCT lower(regexp_extract(doi, '{text.DOI}')) AS doi FROM summaries_html WHERE regexp_matches(doi, '{text.DOI}') ORDER BY doi LIMIT 10")
def smallest_dois(spark: SparkSession, folder: str) -> DataFrame:
    """The ten smallest distinct identifiers (a top-k report)."""
    found = table(spark, folder, "summaries_html").select(F.lower(text.first_doi(F.col("doi"))).alias("doi")).where("doi is not null")
    return found.distinct().orderBy("doi").limit(10)




@query(
    "page_paragraphs",
    f"""SELECT page_id, array_to_string([x FOR x IN [{_strip('y')} FOR y IN string_split(text, chr(10))] IF length(x) > 30], chr(10) || chr(10)) AS in_container,
      array_to_string([x FOR x IN [{_strip('y')} FOR y IN string_split(text, chr(10))] IF length(x) >= 50 AND NOT regexp_matches(lower(x), '{"|".join(text.PAGE_WORDS)}')], chr(10) || chr(10)) AS in_page
      FROM page_extracts WHERE text IS NOT NULL""",
)
def page_paragraphs(spark: SparkSession, folder: str) -> DataFrame:
    """Paragraphs kept inside and outside a container."""
    lines = F.split("text", "\n")
    return table(spark, folder, "page_extracts").where("text is not null").select("page_id", text.paragraphs(lines, True).alias("in_container"), text.paragraphs(lines, False).alias("in_page"))


_TOPIC = " || ".join(f"CASE WHEN {' OR '.join(f'''contains(lower(coalesce(text, '')), '{w}')''' for w in ws)} THEN '{t},' ELSE '' END" for t, ws in text.TOPICS.items())


@query("document_topics", f"SELECT doc_id, rtrim({_TOPIC}, ',') AS topics FROM documents")
def document_topics(spark: SparkSession, folder: str) -> DataFrame:
    """Topic labels of documents."""
    return table(spark, folder, "documents").select("doc_id", F.array_join(text.topics(F.col("text")), ",").alias("topics"))


@query(
    "notices",
    """SELECT paper_id, '🧪 *New Research Article*' || chr(10) || chr(10) || '*' || coalesce(nullif(title, ''), 'Unknown Title') || '*' || chr(10) || '_' || coalesce(nullif(source, ''), 'Unknown Journal') || ' | '
      || coalesce(nullif(published_date, ''), 'Unknown Date') || '_' || chr(10) || coalesce('DOI: ' || nullif(doi, '') || chr(10), '') || chr(10)
      || CASE WHEN length(coalesce(final_summary, '')) > 1000 THEN final_summary[1:1000] || '...' ELSE coalesce(final_summary, '') END || chr(10) || chr(10) || '🔗 <#|Read full article>' AS payload FROM summaries_html""",
)
def notices(spark: SparkSession, folder: str) -> DataFrame:
    """Notification texts."""
    c = F.col
    return table(spark, folder, "summaries_html").select("paper_id", text.notice(c("title"), c("source"), c("published_date"), c("doi"), F.lit(None).cast("string"), c("final_summary")).alias("payload"))


_SAFE = rf"""regexp_replace(replace(regexp_replace(nullif(title, ''), '[<>:"/\\|?*]', '', 'g'), ' ', '_'), {_STRIP})"""


@query("file_names", f"SELECT paper_id, coalesce({_SAFE}[1:150], md5(CAST(paper_id AS VARCHAR))) || '.pdf' AS name FROM summaries_pdf")
def file_names(spark: SparkSession, folder: str) -> DataFrame:
    """File names from titles, or from the key where there is none."""
    return table(spark, folder, "summaries_pdf").select("paper_id", text.pdf_name(F.col("title"), F.col("paper_id").cast("string")).alias("name"))


@query("day_folders", "SELECT page_id, strftime(fetched_at, '%Y/%m/%d') AS day, 's3://store/papers/' || strftime(fetched_at, '%Y/%m/%d') || '/' || list_extract(string_split(url, '/'), -1) AS address FROM page_extracts WHERE url IS NOT NULL AND fetched_at IS NOT NULL")
def day_folders(spark: SparkSession, folder: str) -> DataFrame:
    """Day folder and object address of fetched pages."""
    pages = table(spark, folder, "page_extracts").where("url is not null and fetched_at is not null")
    return pages.select("page_id", day_path(F.col("fetched_at")).alias("day"), object_address("store", "papers", F.col("fetched_at"), F.col("url")).alias("address"))


@query("content_keys", "SELECT page_id, md5(text) AS md5, sha256(text) AS sha256 FROM page_extracts WHERE text IS NOT NULL")
def content_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of page texts."""
    return table(spark, folder, "page_extracts").where("text is not null").select("page_id", F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"))



def _answers(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries written as a model would answer: fenced, one list field, one key left out in every seventh."""
    s = table(spark, folder, "summaries_pdf")
    fields = [F.split("key_findings", r"\. ").alias(k) if k == "key_findings" else F.col(k) for k in SUMMARY_KEYS]
    full = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    short = F.to_json(F.struct(*[f for k, f in zip(SUMMARY_KEYS, fields) if k != "dataset"]), {"ignoreNullFields": "false"})
    return s.select("paper_id", F.concat(F.lit("```json\n"), F.when(F.col("paper_id") % 7 == 0, short).otherwise(full), F.lit("\n```")).alias("raw"))


@query(
    "validated_summaries",
    """SELECT paper_id, paper_id % 7 <> 0 AS valid, CASE WHEN paper_id % 7 = 0 THEN 'missing: dataset' END AS error,
      CASE WHEN paper_id % 7 <> 0 THEN title END AS title, CASE WHEN paper_id % 7 <> 0 THEN replace(key_findings, '. ', chr(10)) END AS key_findings,
      CASE WHEN paper_id % 7 <> 0 THEN array_to_string(authors, '|') END AS authors FROM summaries_pdf""",
)
def validated_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Model answers after fence, parsing, validation and line fields."""
    v = summaries.validated(_answers(spark, folder))
    s = F.col("summary")
    return v.select("paper_id", F.col("error").isNull().alias("valid"), "error", s["title"].alias("title"), s["key_findings"].alias("key_findings"), F.array_join(s["authors"], "|").alias("authors"))


@query("overridden_summaries", "SELECT paper_id, 'given' AS title, coalesce(doi, NULL) AS doi, coalesce(nullif(source, ''), published_date) AS published_date FROM summaries_pdf WHERE paper_id % 7 <> 0")
def overridden_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries with the caller's title and date in place of the model's."""
    v = summaries.validated(_answers(spark, folder)).join(table(spark, folder, "summaries_pdf").select("paper_id", "source"), "paper_id")
    out = summaries.overridden(F.col("summary"), F.lit("given"), F.lit(""), F.col("source"))
    return v.withColumn("s", out).where("s is not null").select("paper_id", "s.title", "s.doi", "s.published_date")


@query("answer_texts", "SELECT paper_id, coalesce(nullif(final_summary, ''), NULL) AS content FROM summaries_pdf")
def answer_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Content of model responses in their shapes."""
    s = table(spark, folder, "summaries_pdf")
    message = F.to_json(F.struct(F.array(F.struct(F.struct(F.nullif("final_summary", F.lit("")).alias("content")).alias("message"))).alias("choices")))
    plain = F.to_json(F.struct(F.array(F.struct(F.col("final_summary").alias("text"))).alias("choices")))
    return s.select("paper_id", F.when(F.col("final_summary").isNull(), None).otherwise(summaries.answer(F.when(F.col("paper_id") % 2 == 0, message).otherwise(plain))).alias("content"))


@query("failed_records", "SELECT page_id, 'no text' AS error, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S') AS failed_at, url, source, title FROM page_extracts WHERE text IS NULL")
def failed_records(spark: SparkSession, folder: str) -> DataFrame:
    """Records of the failed queue for pages without text."""
    p = table(spark, folder, "page_extracts").withColumn("published", F.col("fetched_at")).withColumn("e", F.when(F.col("text").isNull(), "no text"))
    one = p.where("e is not null").select("page_id", failures_record(p))
    return one.select("page_id", "r.error", "r.failed_at", "r.item.url", "r.item.source", "r.item.title")


def failures_record(p: DataFrame):
    """The record of a row as a struct, for use beside the row's key."""
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    item = F.struct("url", "source", "title", iso(F.col("published")).alias("published"))
    return F.struct(item.alias("item"), F.col("e").alias("error"), iso(F.col("fetched_at")).alias("failed_at")).alias("r")


@query("failure_tally", "SELECT CASE WHEN text IS NULL THEN 'error' ELSE 'ok' END AS status, count(*) AS n FROM page_extracts GROUP BY 1")
def failure_tally(spark: SparkSession, folder: str) -> DataFrame:
    """Results by status."""
    return failures.tally(table(spark, folder, "page_extracts").select(F.when(F.col("text").isNull(), "error").otherwise("ok").alias("status")))


def _escaped(c):
    out = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _pages(spark: SparkSession, folder: str) -> DataFrame:
    """HTML of the pages of ``page_extracts``: meta tags, an overlay, the lines as paragraphs, a PDF and a feed link."""
    p = table(spark, folder, "page_extracts")
    meta = lambda n, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(f'<meta name="{n}" content="'), _escaped(c), F.lit('">'))).otherwise("")
    body = F.array_join(F.transform(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: F.concat(F.lit("<p>"), _escaped(x))), "")
    doc = F.concat(
        F.lit("<html><head>"), meta("citation_title", F.col("title")), meta("description", F.col("abstract")), F.lit('<link rel="alternate" type="application/rss+xml" href="/rss.xml"></head><body><div class="overlay modal"><p>'),
        F.lit("This overlay covers the page and is long enough to be taken for text.</p></div><article><h1>"), _escaped(F.col("title")), F.lit("</h1>"), body, F.lit('</article><a href="/files/'), F.col("page_id").cast("string"), F.lit('.pdf">PDF</a></body></html>'),
    )
    return p.select("page_id", F.col("url").alias("page_url"), "source", doc.alias("html"))


_PARAS = f"[x FOR x IN [{_strip('y')} FOR y IN string_split(coalesce(text, ''), chr(10))] IF length(x) > 0]"
_SUM = f"coalesce(list_sum([length(x) FOR x IN {_PARAS}]), 0) + length({_strip('''coalesce(title, '')''')})"
_KEPT = f"""CASE WHEN {_SUM} > 200 THEN array_to_string([x FOR x IN {_PARAS} IF length(x) > 30], chr(10) || chr(10))
  ELSE array_to_string([x FOR x IN {_PARAS} IF length(x) >= 50 AND NOT regexp_matches(lower(x), '{"|".join(text.PAGE_WORDS)}')], chr(10) || chr(10)) END"""


@query(
    "html_documents",
    f"""SELECT page_id, nullif(title, '') AS title, nullif(abstract, '') AS abstract, coalesce(nullif(t, ''), nullif(abstract, ''), '') AS text,
      CASE WHEN coalesce(nullif(t, ''), nullif(abstract, '')) IS NULL THEN 'no_content' ELSE 'ok' END AS status FROM (SELECT page_id, title, abstract, {_KEPT} AS t FROM page_extracts)""",
)
def html_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Whole pages read by the tolerant parser."""
    found = html.documents(_pages(spark, folder))
    return found.select(F.col("id").alias("page_id"), "title", "abstract", "text", "status")


@query(
    "html_tags",
    """SELECT page_id, nullif(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '') AS title,
      nullif(trim(replace(replace(replace(replace(title, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;')), '') AS heading,
      '/files/' || page_id || '.pdf' AS pdf, '/rss.xml' AS feed FROM page_extracts""",
)
def html_tags(spark: SparkSession, folder: str) -> DataFrame:
    """Single tags by expression: title, heading, PDF link, announced feed."""
    h = F.col("html")
    return _pages(spark, folder).select("page_id", html.attribute(h, "meta", "name", "citation_title").alias("title"), html.heading(h).alias("heading"), html.pdf_link(h).alias("pdf"), F.get(html.feed_links(h), F.lit(0)).alias("feed"))


@query("html_links", "SELECT url AS page_url, '/files/' || page_id || '.pdf' AS href, 'PDF' AS title FROM page_extracts WHERE url IS NOT NULL")
def html_links(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors of pages."""
    return html.links(_pages(spark, folder).where("page_url is not null")).select("page_url", "href", "title")


def _lookup(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Open-access and registry records made of the two summary tables."""
    doi = F.lower(F.regexp_replace(text.first_doi(F.col("doi")), r"[).,;]+$", ""))
    place = F.struct(F.concat(F.lit("https://oa.example/"), doi, F.lit(".pdf")).alias("url_for_pdf"), F.lit("cc-by").alias("license"))
    oa = table(spark, folder, "summaries_pdf").where("doi is not null").select(doi.alias("doi"), F.to_json(F.struct((F.col("paper_id") % 3 != 0).alias("is_oa"), F.col("title"), place.alias("best_oa_location"))).alias("json"))
    registry = table(spark, folder, "summaries_html").where("doi is not null").select(doi.alias("doi"), F.to_json(F.struct(F.struct(F.array("title").alias("title"), F.col("abstract").alias("abstract")).alias("message"))).alias("json"))
    return oa, registry


_DOI_KEY = f"lower(regexp_replace(regexp_extract(doi, '{text.DOI}'), '[).,;]+$', ''))"


@query(
    "full_text_cascade",
    f"""WITH a AS (SELECT paper_id AS article_id, nullif({_DOI_KEY}, '') AS doi FROM summaries_html),
      oa AS (SELECT DISTINCT {_DOI_KEY} AS doi FROM summaries_pdf WHERE regexp_matches(doi, '{text.DOI}') AND paper_id % 3 <> 0),
      r AS (SELECT DISTINCT {_DOI_KEY} AS doi FROM summaries_html WHERE regexp_matches(doi, '{text.DOI}') AND abstract IS NOT NULL)
      SELECT article_id, CASE WHEN article_id % 5 = 0 THEN 'https://files.example/' || article_id || '.PDF' WHEN oa.doi IS NOT NULL THEN 'https://oa.example/' || oa.doi || '.pdf'
        WHEN article_id % 5 = 1 THEN 'https://site.example/get/' || article_id || '.pdf?x=1' END AS pdf_url,
      CASE WHEN article_id % 5 = 0 THEN 'direct' WHEN oa.doi IS NOT NULL THEN 'unpaywall' WHEN article_id % 5 = 1 THEN 'html_anchor' WHEN r.doi IS NOT NULL THEN 'crossref_no_pdf' ELSE 'no_pdf_found' END AS note
      FROM a LEFT JOIN oa ON oa.doi = a.doi LEFT JOIN r ON r.doi = a.doi""",
)
def full_text_cascade(spark: SparkSession, folder: str) -> DataFrame:
    """The first full-text candidate of each paper, over staged lookups."""
    oa, registry = _lookup(spark, folder)
    n = F.col("paper_id")
    link = F.when(n % 5 == 0, F.concat(F.lit("https://files.example/"), n.cast("string"), F.lit(".PDF"))).otherwise(F.concat(F.lit("https://site.example/p/"), n.cast("string")))
    page = F.when(n % 5 == 1, F.concat(F.lit('<p>Text<a class="x" href="/get/'), n.cast("string"), F.lit('.pdf?x=1">get</a>'))).otherwise(F.lit("<p>Text"))
    doi = F.nullif(F.lower(F.regexp_replace(text.first_doi(F.col("doi")), r"[).,;]+$", "")), F.lit(""))
    articles = table(spark, folder, "summaries_html").select(n.alias("article_id"), link.alias("url"), page.alias("html"), doi.alias("doi"))
    found = fulltext.cascade(articles, fulltext.open_access(oa), fulltext.registered(registry).where("registry.abstract is not null"))
    return found.select("article_id", "pdf_url", "note")


@query(
    "nearest_vectors",
    "SELECT vec_id, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), (SELECT CAST(embedding AS DOUBLE[]) FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))), 6) AS cosine FROM embeddings",
)
def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Cosine of every vector with the first one; one vector is sent along, a single row."""
    e = table(spark, folder, "embeddings").select("vec_id", "embedding")
    first = e.agg(F.min_by("embedding", "vec_id").alias("q"))
    return e.join(F.broadcast(first)).select("vec_id", F.round(enrich.cosine(F.col("embedding"), F.col("q")), 6).alias("cosine"))


@query("extractive_summaries")
def extractive_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Summaries and vectors of pages by the stand-in enrichers."""
    p = table(spark, folder, "page_extracts").where("text is not null").select("page_id", "text")
    out = enrich.enriched(enrich.enriched(p, "text", enrich.Extractive(), "summary"), "text", enrich.HashedEmbedding(), "vector")
    return out.select("page_id", "summary", F.size("vector").alias("dimensions"), "summary_error")


def _shared(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"


_CUT = f"CASE WHEN length({_strip('t')}) > 200 THEN {_strip('t')}[1:200] || '...' ELSE {_strip('t')} END"


@query(
    "list_page_items",
    f"""WITH l AS (SELECT *, coalesce(title, '') AS t, row_number() OVER (PARTITION BY page_url ORDER BY pos, link_id) AS i, length(page_url) % 2 = 0 AS chosen, link_id % 2 = 1 AS card
        FROM list_links WHERE coalesce(url, '') <> '' AND page_url IS NOT NULL),
      c AS (SELECT *, max(card::INT) OVER (PARTITION BY page_url) AS any_card FROM l),
      o AS (SELECT *, row_number() OVER (PARTITION BY page_url, url ORDER BY i) AS n FROM c WHERE (NOT chosen OR any_card = 0 OR card) AND url LIKE 'http%')
      SELECT page_url, url, {_CUT} AS title FROM o WHERE n = 1 AND (chosen OR {_ARTICLE})""",
)
def list_page_items(spark: SparkSession, folder: str) -> DataFrame:
    """Items of list pages, read from HTML with and without a selector: every second page has one, for every second of its links."""
    l = table(spark, folder, "list_links").where("coalesce(url, '') <> '' and page_url is not null")
    card = F.when(F.col("link_id") % 2 == 1, F.lit(' class="x c-card__link"')).otherwise("")
    anchor = F.concat(F.lit("<li><a"), card, F.lit(' href="'), _escaped(F.col("url")), F.lit('">'), _escaped(F.col("title")), F.lit("</a>"))
    rows = F.array_sort(F.collect_list(F.struct("pos", "link_id", anchor.alias("a"))))
    pages = l.groupBy("page_url").agg(F.concat(F.lit("<ul>"), F.array_join(F.transform(rows, lambda r: r["a"]), ""), F.lit("</ul>")).alias("html"))
    pages = pages.withColumn("selector", F.when(F.length("page_url") % 2 == 0, "a.c-card__link"))
    found = html.links(pages, selector_col="selector").withColumn("source", F.lit(None).cast("string"))
    return items.page_links(found).select("page_url", "url", "title")


@query(
    "pdf_buttons",
    """SELECT page_id, CASE page_id % 6 WHEN 0 THEN '/own/' || page_id WHEN 1 THEN '/get?f=' || page_id WHEN 2 THEN '/f/' || page_id || '.pdf' WHEN 3 THEN '/v/' || page_id || '.PDF?x=1' WHEN 4 THEN '/b/' || page_id END AS pdf FROM page_extracts""",
)
def pdf_buttons(spark: SparkSession, folder: str) -> DataFrame:
    """The PDF link of pages: by the source's selector, by text, ending, class, or any address with the ending in it."""
    n = F.col("page_id")
    a = lambda more, before, after, label: F.concat(F.lit(f'<p><a href="/about">About</a><a{more} href="{before}'), n.cast("string"), F.lit(f'{after}">{label}</a>'))
    page = (
        F.when(n % 6 == 0, F.concat(a("", "/f/", ".pdf", "PDF"), a(' data-track-action="download"', "/own/", "", "Get"))).when(n % 6 == 1, F.concat(a("", "/x/", "", "Text"), a("", "/get?f=", "", "<b>download</b> pdf")))
        .when(n % 6 == 2, a("", "/f/", ".pdf", "Here")).when(n % 6 == 3, a("", "/v/", ".PDF?x=1", "View")).when(n % 6 == 4, a(' class="a pdf-download"', "/b/", "", "View")).otherwise(a("", "/c/", "", "View"))
    )
    pages = table(spark, folder, "page_extracts").select("page_id", page.alias("html"), F.when(n % 6 == 0, "a[data-track-action='download']").alias("selector"))
    return html.pdf_buttons(pages, selector_col="selector").select(F.col("id").alias("page_id"), "pdf")


@query(
    "linked_data",
    """SELECT page_id, nullif(title, '') AS title, nullif(abstract, '') AS abstract, CASE WHEN page_id % 4 = 3 THEN '' WHEN page_id % 4 = 2 THEN 'One' WHEN page_id % 4 = 1 THEN 'Two' ELSE 'Three|Four' END AS authors FROM page_extracts""",
)
def linked_data(spark: SparkSession, folder: str) -> DataFrame:
    """Title, abstract and authors from linked data: one object or a list, authors as list, object or text; else from meta tags."""
    n = F.col("page_id")
    person = lambda x: F.to_json(F.struct(F.lit(x).alias("name")))
    who = F.when(n % 4 == 2, person("One")).when(n % 4 == 1, F.lit('["Two"]')).when(n % 4 == 0, F.concat(F.lit("["), person("Three"), F.lit(',"Four"]'))).otherwise(F.lit('"Five"'))
    quoted = lambda c: F.regexp_extract(F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)
    kind = F.when(n % 4 == 2, "NewsArticle").otherwise("ScholarlyArticle")
    one = F.concat(F.lit('{"@type":"'), kind, F.lit('","headline":'), quoted(F.col("title")), F.lit(',"description":'), quoted(F.col("abstract")), F.lit(',"author":'), who, F.lit("}"))
    doc = F.when(n % 2 == 1, F.concat(F.lit('[{"@type":"WebSite"},'), one, F.lit("]"))).otherwise(one)
    page = F.concat(F.lit('<script type="application/ld+json">{ broken</script><script type="application/ld+json">'), F.replace(doc, F.lit("</"), F.lit("<\\/")), F.lit("</script><p>x"))
    found = html.documents(table(spark, folder, "page_extracts").select("page_id", page.alias("html")))
    return found.select(F.col("id").alias("page_id"), F.nullif("title", F.lit("")).alias("title"), F.nullif("abstract", F.lit("")).alias("abstract"), F.array_join("authors", "|").alias("authors"))


@query("rss_items", "SELECT CAST(seq AS VARCHAR) AS doi, translate(trim(url, chr(32) || chr(9) || chr(10) || chr(13)), chr(10) || chr(13), '  ') AS url, 'feed' AS source, date_trunc('second', fetched_at) AS published FROM feed_items WHERE url IS NOT NULL AND fetched_at IS NOT NULL")
def rss_items(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of an RSS file that is written from the feed table and read again."""
    f = table(spark, folder, "feed_items").where("url is not null and fetched_at is not null")
    date = F.concat(F.date_format("fetched_at", "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT"))
    entry = F.concat(F.lit("<item><title>"), _escaped(F.col("title")), F.lit("</title><link>"), _escaped(F.col("url")), F.lit("</link><pubDate>"), date, F.lit("</pubDate><dc:identifier>"), F.col("seq").cast("string"), F.lit("</dc:identifier></item>"))
    at = _shared(spark, "rss")
    f.select(F.translate(entry, "\n\r", "  ").alias("value")).write.text(at)
    return readers.rss(spark, at, "feed", F.current_timestamp(), whole_files=False).select("doi", "url", "source", "published")


@query("sitemap_items", "SELECT url, 'site' AS source, TIMESTAMP '2024-05-01 00:00:00' AS published FROM page_extracts WHERE url IS NOT NULL")
def sitemap_items(spark: SparkSession, folder: str) -> DataFrame:
    """Addresses of a sitemap that is written from the page table and read again."""
    entry = F.concat(F.lit("<url><loc> "), _escaped(F.col("url")), F.lit(" </loc><lastmod>2024-05-01</lastmod></url>"))
    at = _shared(spark, "sitemap")
    table(spark, folder, "page_extracts").where("url is not null").select(entry.alias("value")).write.text(at)
    return readers.sitemap(spark, at, "site", F.to_timestamp(F.lit("2024-05-01 00:00:00")), whole_files=False).select("url", "source", "published")


@query("failed_queue", "SELECT url, source, title, 'no text' AS error, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S') AS failed_at FROM page_extracts WHERE text IS NULL")
def failed_queue(spark: SparkSession, folder: str) -> DataFrame:
    """The failed queue written, spoilt by lines that are no records, and read again."""
    p = table(spark, folder, "page_extracts").select("url", "source", "title", F.col("fetched_at").alias("published"), "fetched_at", F.when(F.col("text").isNull(), "no text").alias("e"))
    at = _shared(spark, "failed")
    failures.append(failures.records(p, "e", F.col("fetched_at")), at)
    spark.createDataFrame([("{ no json",), ("",)], "value string").write.mode("append").text(at)
    return failures.read(spark, at).select("item.url", "item.source", "item.title", "error", "failed_at")


@query(
    "rejected_summaries",
    """SELECT paper_id, CASE paper_id % 5 WHEN 0 THEN 'no JSON object' WHEN 1 THEN 'wrong type: title' WHEN 2 THEN 'no JSON object' WHEN 3 THEN 'wrong type: authors' END AS error, CASE WHEN paper_id % 5 = 4 THEN final_summary END AS final_summary FROM summaries_html""",
)
def rejected_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """Model answers that are no JSON, no object, or have a field of the wrong type, beside good ones."""
    n = F.col("paper_id")
    field = lambda k: F.when(n % 5 == 1, 7).cast("int").alias(k) if k == "title" else F.lit(None).cast("string").alias(k)
    base = [F.col(k) for k in SUMMARY_KEYS if k not in ("title", "authors")]
    good = F.to_json(F.struct("title", "authors", *base), {"ignoreNullFields": "false"})
    number = F.to_json(F.struct(field("title"), F.col("authors"), *base), {"ignoreNullFields": "false"})
    flat = F.to_json(F.struct(F.col("title"), F.lit("One").alias("authors"), *base), {"ignoreNullFields": "false"})
    raw = F.when(n % 5 == 0, F.lit("Sorry, I cannot do that.")).when(n % 5 == 1, number).when(n % 5 == 2, F.lit("[1, 2]")).when(n % 5 == 3, flat).otherwise(good)
    v = summaries.validated(table(spark, folder, "summaries_html").select("paper_id", raw.alias("raw")))
    return v.select("paper_id", "error", F.col("summary.final_summary").alias("final_summary"))


@query(
    "open_access_any_location",
    f"""SELECT {_DOI_KEY} AS doi, max(CASE WHEN paper_id % 2 = 0 THEN 'https://a.example/' ELSE 'https://b.example/' END || {_DOI_KEY}) AS pdf_url FROM summaries_pdf WHERE regexp_matches(doi, '{text.DOI}') AND paper_id % 3 <> 0 GROUP BY 1""",
)
def open_access_any_location(spark: SparkSession, folder: str) -> DataFrame:
    """Open-access records by their best location, or else the first of all, with a PDF or page address."""
    doi = F.lower(F.regexp_replace(text.first_doi(F.col("doi")), r"[).,;]+$", ""))
    n = F.col("paper_id")
    best = F.when(n % 2 == 0, F.struct(F.concat(F.lit("https://a.example/"), doi).alias("url_for_pdf")))
    rest = F.array(F.struct(F.lit("").alias("url_for_pdf"), F.concat(F.lit("https://b.example/"), doi).alias("url")), F.struct(F.lit("https://c.example").alias("url_for_pdf"), F.lit(None).cast("string").alias("url")))
    body = F.to_json(F.struct((n % 3 != 0).alias("is_oa"), best.alias("best_oa_location"), rest.alias("oa_locations")))
    lookup = table(spark, folder, "summaries_pdf").where("doi is not null").select(F.nullif(doi, F.lit("")).alias("doi"), body.alias("json"))
    return fulltext.open_access(lookup, any_location=True).select("doi", "oa.pdf_url")


@query("science_links", "SELECT link_id, coalesce(contains(url, '/science/article/') OR contains(url, 'doi.org'), false) AS science FROM list_links")
def science_links(spark: SparkSession, folder: str) -> DataFrame:
    """Links to journal articles and identifiers."""
    return table(spark, folder, "list_links").select("link_id", url.is_science_link(F.col("url")).alias("science"))


@query("elapsed_seconds", "SELECT page_id, round((epoch_us(fetched_at) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1000000, 2) AS seconds FROM page_extracts")
def elapsed_seconds(spark: SparkSession, folder: str) -> DataFrame:
    """Seconds between a fixed time and each fetch."""
    return table(spark, folder, "page_extracts").select("page_id", audit.elapsed(F.to_timestamp(F.lit("2024-01-01 00:00:00")), F.col("fetched_at").cast("timestamp")).alias("seconds"))
