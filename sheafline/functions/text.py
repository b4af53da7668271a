"""Column functions over text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topic labels in output order with the words that give them.
TOPICS = {
    "oncology": ("cancer", "tumor", "oncology"),
    "diabetes": ("diabetes", "glucose", "insulin"),
    "infectious-disease": ("covid", "influenza", "virus"),
    "ai-ml": ("machine learning", "deep learning", "model"),
}
# Words of paragraphs that belong to the page.
PAGE_WORDS = ("cookie", "privacy", "subscribe", "newsletter", "sign up", "log in")
DOI = r"10\.\d{4,9}/[-._;()/:A-Za-z0-9]+"


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def filled(*columns: Column) -> Column:
    """The first column that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns])


def shortened(c: Column, most: int, mark: str = "...") -> Column:
    """At most ``most`` characters, with a mark if anything was cut."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit(mark))).otherwise(c)


def clean_title(c: Column, most: int = 200) -> Column:
    """Stripped and shortened; a blank title becomes empty, not null."""
    return shortened(strip(c), most)


def safe_name(c: Column) -> Column:
    """Text usable as a file name: forbidden characters removed, spaces as underscores."""
    return strip(F.replace(F.regexp_replace(c, r'[<>:"/\\|?*]', ""), F.lit(" "), F.lit("_")))


def pdf_name(title: Column, key: Column, most: int = 150) -> Column:
    """File name from a title, or from the key where there is none."""
    return F.concat(F.coalesce(F.substring(safe_name(F.nullif(title, F.lit(""))), 1, most), F.md5(key)), F.lit(".pdf"))


def first_doi(c: Column) -> Column:
    """First identifier in a text, null without one; trailing punctuation is kept."""
    return F.nullif(F.regexp_extract(c, DOI, 0), F.lit(""))


def unfenced(c: Column) -> Column:
    """Text without the code fence around it."""
    inner = F.regexp_replace(F.regexp_replace(strip(c), r"^```[A-Za-z]*\s*", ""), r"\s*```$", "")
    return F.when(strip(c).startswith("```"), inner).otherwise(strip(c))


def topics(c: Column, table: dict[str, tuple[str, ...]] | None = None) -> Column:
    """Labels whose words the text contains, in table order; an empty list for none or null."""
    low = F.lower(F.coalesce(c, F.lit("")))
    tests = []
    for label, words in (table or TOPICS).items():
        hit = F.lit(False)
        for w in words:
            hit = hit | low.contains(w)
        tests.append(F.when(hit, F.lit(label)))
    return F.array_compact(F.array(*tests))


def page_paragraph(c: Column) -> Column:
    """Whether a paragraph outside any container is kept."""
    low, hit = F.lower(c), F.lit(False)
    for w in PAGE_WORDS:
        hit = hit | low.contains(w)
    return (F.length(c) >= 50) & ~hit


def paragraphs(lines: Column, in_container: bool) -> Column:
    """Kept paragraphs of an array, joined by blank lines."""
    stripped = F.transform(lines, strip)
    kept = F.filter(stripped, (lambda p: F.length(p) > 30) if in_container else page_paragraph)
    return F.array_join(kept, "\n\n")


def lines_of(c: Column) -> Column:
    """A JSON list as lines; anything else as it is."""
    items = F.from_json(c, "array<string>")
    return F.when(c.startswith("[") & items.isNotNull(), F.array_join(items, "\n")).otherwise(c)


def notice(title: Column, journal: Column, published: Column, doi: Column, url: Column, summary: Column, most: int = 1000) -> Column:
    """Notification text with its defaults."""
    head = F.concat(F.lit("🧪 *New Research Article*\n\n*"), F.coalesce(filled(title), F.lit("Unknown Title")), F.lit("*\n_"), F.coalesce(filled(journal), F.lit("Unknown Journal")), F.lit(" | "), F.coalesce(filled(published), F.lit("Unknown Date")), F.lit("_\n"))
    line = F.coalesce(F.concat(F.lit("DOI: "), filled(doi), F.lit("\n")), F.lit(""))
    return F.concat(head, line, F.lit("\n"), shortened(F.coalesce(summary, F.lit("")), most), F.lit("\n\n🔗 <"), F.coalesce(filled(url), F.lit("#")), F.lit("|Read full article>"))
