"""Column functions over addresses."""

from __future__ import annotations

from urllib.parse import urljoin as _join

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from sheafline.functions.text import strip

# What an article's address contains, and what rules it out.
ARTICLE_PATTERNS = (r"/article[s]?/", r"/news/", r"/pii/", r"/PMC\d+", r"/doi/", r"/research/", r"/publication/", r"/press-release", r"/story/", r"/post/", r"/archive/", r"\d{4}/\d{2}/")
OTHER_PATTERNS = (
    "/login", "/signin", "/signup", "/register", r"/search\?", "/tag/", "/category/", "/author/", "/about", "/contact", "/faq", "/privacy", "/terms", "/cookie", "#", "javascript:", "mailto:",
)
FEED_PATHS = ("/rss", "/rss.xml", "/feed", "/feed.xml", "/feeds/rss", "/atom.xml", "/rss/recent.xml", "/news/rss", "/news-events/feed", "/index.xml")


def normalized(url: Column, keep_query: bool = False) -> Column:
    """Stripped, lower-case and without query; the key of an article."""
    u = F.lower(strip(url))
    return u if keep_query else F.split_part(u, F.lit("?"), F.lit(1))


def article_key(url: Column, keep_query: bool = False) -> Column:
    return F.md5(normalized(url, keep_query))


def netloc(url: Column) -> Column:
    """Host with user and port; empty if there is none."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def path(url: Column) -> Column:
    """Path without query and fragment."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?", "")
    return F.regexp_extract(rest, r"^[^?#]*", 0)


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def is_article(url: Column, base: Column, include: tuple[str, ...] = ARTICLE_PATTERNS, exclude: tuple[str, ...] = OTHER_PATTERNS, depth: int = 2, length: int = 15) -> Column:
    """Whether an address looks like an article of the site ``base`` (contained in the host, not necessarily its end)."""
    host, p = netloc(url), path(url)
    slashes = F.length(p) - F.length(F.replace(p, F.lit("/"), F.lit("")))
    return (
        F.when(F.coalesce(url, F.lit("")) == "", False)
        .when((host != "") & ~host.contains(base), False)
        .when(url.rlike("(?i)" + "|".join(exclude)), False)
        .when(url.rlike("(?i)" + "|".join(include)), True)
        .otherwise((slashes >= depth) & (F.length(p) > length))
    )


def absolute(href: Column, base: Column) -> Column:
    """Addresses from the root of the site or with a scheme; null for all others."""
    site = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)//[^/?#]*", 0)
    kind = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    return F.when(href.startswith("//"), F.concat(kind, href)).when(href.startswith("/"), F.concat(site, href)).when(href.startswith("http"), href)


@F.pandas_udf(StringType())
def joined(base: pd.Series, href: pd.Series) -> pd.Series:
    """Any relative address resolved against its page, in batches; null stays null, unparsable ones too."""

    def one(b, h):
        try:
            return None if h is None else _join(b or "", h)
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)


def is_science_link(url: Column) -> Column:
    """Whether an address is that of a journal article or an identifier's resolver."""
    return F.coalesce(url.contains("/science/article/") | url.contains("doi.org"), F.lit(False))


def known_feed(host: Column, known: dict[str, str]) -> Column:
    """Feed of a host or of the domain it belongs to, from a small table; the longest domain wins."""
    out = F.lit(None).cast("string")
    for domain in sorted(known, key=len):
        out = F.when((host == domain) | host.endswith("." + domain), F.lit(known[domain])).otherwise(out)
    return out
