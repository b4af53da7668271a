"""Schemas of every record; nothing is inferred."""

from __future__ import annotations

SOURCE = "name string, type string, fetch_method string, rss string, url string, sitemap string, pdf_strategy string, selectors map<string,string>"
ITEM = "seq bigint, url string, source string, title string, published timestamp, selectors map<string,string>, doi string, authors array<struct<name:string>>"
OPEN_ACCESS = (
    "is_oa boolean, title string, published_date string, best_oa_location struct<url_for_pdf:string,url:string,license:string,host_type:string>,"
    " oa_locations array<struct<url_for_pdf:string,url:string,license:string,host_type:string>>"
)
REGISTRY = "message struct<title:array<string>,abstract:string>"
DOCUMENT = "text string, title string, authors array<string>, abstract string"
FAILED = f"item struct<{', '.join(f'{p.split(' ', 1)[0]}:{p.split(' ', 1)[1]}' for p in ('url string', 'source string', 'title string', 'published string'))}>, error string, failed_at string"

# The keys a summary must have, in order, and those whose lists become lines.
SUMMARY_KEYS = (
    "title", "doi", "published_date", "authors", "abstract", "objective", "methodology", "dataset", "model", "experiments", "key_findings", "limitations", "future_scope", "final_summary",
)
LINE_KEYS = ("objective", "methodology", "dataset", "model", "experiments", "key_findings", "limitations", "future_scope", "final_summary")
SUMMARY = ", ".join(f"{k} {'array<string>' if k == 'authors' else 'string'}" for k in SUMMARY_KEYS) + ", input_token int, output_token int"

RSS_ENTRY = "title string, link string, pubDate string, identifier string, creator array<string>, author string"
ATOM_ENTRY = "title string, link array<struct<_href:string,_rel:string>>, updated string, published string, author array<struct<name:string>>"
SITEMAP_ENTRY = "loc string, lastmod string"
