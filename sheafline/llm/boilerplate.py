"""Page furniture between the lines of an article: tag-path ratios over all pages.

Text extracted from a page keeps no tags, so a line's path is the site and the line's first words with numbers and the
site's own name masked: the leaf that one element of a template would have produced. Over all pages and all lines of a
path these are added up: text length, punctuation, lines that end as sentences do, words by which pages speak of
themselves and their visitors, the site's own name, lines outside the page's span of paragraphs, and the share of the
site's pages that have the very wording. The ratios of a path are smoothed with those of the same leaf on all sites,
fused into one score and thresholded; all lines of a path share its fate, whatever a single line looks like.

Section headings, list entries and box captions carry no sentence punctuation although they are body; their forms count
as sentences, and as they recur by nature their repetition does not count. Null text has no lines; blank lines are no
result; line numbers count blank lines; repeated rows count as one page in repetition and give one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheafline.session import cut, spread

# Names of article sections in English, German, French and Spanish.
HEADINGS = (
    "abstract", "summary", "background", "introduction", "objective", "objectives", "aim", "aims", "purpose", "setting", "design", "methods", "method",
    "materials and methods", "patients and methods", "results", "findings", "what the study found", "main outcome", "outcomes", "discussion", "interpretation",
    "conclusion", "conclusions", "limitations", "strengths and limitations", "implications", "meaning", "funding", "references", "key points", "acknowledgements",
    "hintergrund", "einleitung", "ziel", "ziele", "methode", "methoden", "methodik", "ergebnis", "ergebnisse", "diskussion", "schlussfolgerung", "schlussfolgerungen", "fazit", "grenzen", "einschränkungen",
    "contexte", "introduction", "objectif", "objectifs", "méthode", "méthodes", "résultat", "résultats", "discussion", "conclusion", "conclusions", "limites",
    "antecedentes", "introducción", "objetivo", "objetivos", "método", "métodos", "resultado", "resultados", "discusión", "conclusión", "conclusiones", "limitaciones",
)


# Words by which pages speak of themselves and address their visitors, in English, German, French and Spanish.
VISITOR = frozenset(
    "site website page pages article story stories newsletter subscribe subscriber subscribers subscription account cookie cookies device"
    " partners tracking trackers privacy inbox email mail you your our us join follow share listen read enjoying support advertisement"
    " sponsored rights reserved published copyright © accept agree choices ok menu search home contact terms sign log free offer book buy"
    " sie ihre ihr seite datenschutz klick rechte vorbehalten herausgegeben akzeptieren nutzt verwendet anzeige folgen konto anmelden abonnieren partner einstellungen"
    " vous votre vos traceurs droits réservés publié édité accepter suivez publicité compte partenaires poursuivant abonnez abonner stockent appareil"
    " usted su sus sitio derechos reservados publicación aceptar siga publicidad cuenta socios suscríbase utiliza identificadores navegación".split()
)

#: What is added up for a path, and how the smoothed ratios are fused; the sum is positive for furniture.
WEIGHTS = {"length": -1.0, "marks": -0.5, "said": -5.0, "visitor": 6.0, "named": 2.0, "repeated": 3.0, "outside": 2.0}
BASE = 2.3

_END = r"[.!?…:;][\"'”’»)\]]{0,3}(?:\s?\[\d+(?:[,–-]\s?\d+)*\])?$|\S{3,} \([^()]*\p{L}[^()]{2,80}\)$"


def lines(pages: DataFrame, page_id: str = "page_id", text: str = "text", source: str = "source") -> DataFrame:
    """``page, source, line_no, line, outside`` of every non-blank line; ``outside``: before the page's first or after its last paragraph."""
    rows = spread(pages.select(F.col(page_id).cast("long").alias("page"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), F.col(text).cast("string").alias("text")).where("text is not null"))
    parts = F.transform(F.split("text", "\n", -1), lambda x, i: F.struct((i + 1).cast("long").alias("no"), F.regexp_replace(x, r"(?U)^\s+|\s+$", "").alias("line")))
    rows = rows.select("page", "source", F.filter(parts, lambda x: F.length(x["line"]) > 0).alias("parts"))
    paragraphs = F.transform(F.filter("parts", lambda x: (F.length(x["line"]) >= 100) & F.right(x["line"], F.lit(4)).rlike("[.!?]")), lambda x: x["no"])
    rows = rows.withColumn("_span", F.explode(F.array(F.struct(F.array_min(paragraphs).alias("first"), F.array_max(paragraphs).alias("last")))))
    rows = rows.select("page", "source", "_span", F.explode("parts").alias("part"))
    no, span = F.col("part.no"), F.col("_span")
    outside = F.coalesce((no < span["first"]) | (no > span["last"]), F.lit(True))
    return rows.select("page", "source", no.alias("line_no"), F.col("part.line").alias("line"), outside.cast("double").alias("outside"))


def features(rows: DataFrame) -> DataFrame:
    """``page, source, line_no, leaf, wording, recurs`` and what is added up, from the rows of :func:`lines`."""
    line = F.col("line")
    name = F.lower(F.regexp_replace("source", "[_-]+", " "))
    low = F.lower(line)
    masked = F.regexp_replace(F.regexp_replace(low, r"\d[\d.,:]*", "9"), r"(?U)\s+", " ")
    masked = F.when(F.length(name) > 2, F.replace(masked, name, F.lit("name"))).otherwise(masked)
    site = F.split_part(name, F.lit(" "), F.lit(1))
    masked = F.when(F.length(site) > 2, F.replace(masked, site, F.lit("name"))).otherwise(masked)
    df = rows.withColumn("masked", F.explode(F.array(masked)))
    masked = F.col("masked")
    df = df.withColumn("words", F.explode(F.array(F.filter(F.split(masked, r"[^\p{L}\p{N}©]+"), lambda w: F.length(w) > 0))))
    heading = F.regexp_replace(masked, r"^(?:9\.? ?)+|[:.]$", "").isin(*dict.fromkeys(HEADINGS)) & (F.length(line) < 60)
    entry = line.rlike(r"^(?:[-–—*•◦▪]|\(?[a-z]\))\s+\S")
    caption = masked.rlike(r"^(?:box|table|figure|fig\.|kasten|tabelle|abbildung|encadré|tableau|recuadro|tabla|cuadro|figura) ?9\b")
    df = df.withColumn("form", F.explode(F.array(heading | entry | caption)))
    several = r"[\p{L})][.!?][\"'”’»)\]]{0,3} \p{Lu}.*[\p{L})][.!?][\"'”’»)\]]{0,3} \p{Lu}"  # sentences, the last one without its end
    said = F.col("form") | ((F.size("words") >= 4) & (F.substring(line, -90, 90).rlike(_END) | ((F.length(line) >= 150) & line.rlike(several))))
    hits = F.size(F.array_intersect("words", F.array(*[F.lit(w) for w in sorted(VISITOR)])))
    punct = F.length(line) - F.length(F.translate(line, ".!?;:,", ""))
    return df.select(
        "page", "source", "line_no", "outside",
        F.xxhash64(F.array_join(F.slice(F.split(masked, " "), 1, 4), " ")).alias("leaf"),
        F.xxhash64(masked).alias("wording"),
        (~F.col("form")).alias("recurs"),
        F.least(F.log1p(F.length(line)) / F.log(F.lit(120.0)), F.lit(1.2)).alias("length"),
        (F.least(punct, F.lit(3)) / 3).alias("marks"),
        said.cast("double").alias("said"),
        F.least(3 * hits / F.greatest(F.size("words"), F.lit(1)), F.lit(1.0)).alias("visitor"),
        F.array_contains("words", "name").cast("double").alias("named"),
    )


def fused(value) -> Column:
    """The score from the ratios that ``value`` gives by name."""
    total = F.lit(BASE)
    for name, weight in WEIGHTS.items():
        total = total + weight * value(name)
    return total


def paths(found: DataFrame, sites: DataFrame, prior: float = 3.0, prior_pages: float = 20.0) -> DataFrame:
    """``source, leaf, score`` of each path.

    Sums per wording are built before the shuffle and those per path and leaf come from them, so that no key holds a
    large share of the lines. ``prior``: lines as which the leaf's ratios on all sites count beside the site's own;
    ``prior_pages``: pages without the wording that every site has besides its own.
    """
    sums = [c for c in WEIGHTS if c != "repeated"]
    wordings = found.groupBy("source", "leaf", "wording", "recurs").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("page").alias("pages"), *[F.sum(c).alias(c) for c in sums])
    repeated = F.when(F.col("recurs"), F.col("n") * F.col("pages") / (F.col("all_pages") + prior_pages)).otherwise(0.0)
    own = wordings.join(sites, "source").withColumn("repeated", repeated).groupBy("source", "leaf").agg(*[F.sum(c).alias(c) for c in ["n", *WEIGHTS]])
    leaves = own.groupBy("leaf").agg(*[(F.sum(c) / F.sum("n")).alias(f"{c}_all") for c in WEIGHTS])
    return own.join(leaves, "leaf").select("source", "leaf", fused(lambda c: (F.col(c) + prior * F.col(f"{c}_all")) / (F.col("n") + prior)).alias("score"))


def furniture(pages: DataFrame, page_id: str = "page_id", text: str = "text", source: str = "source", threshold: float = 0.0) -> DataFrame:
    """``page_id, line_no, score`` of each non-blank line that is not body. A source that is null is a site of its own."""
    found = cut(features(lines(pages, page_id, text, source)))  # read twice below
    sites = found.select("source", "page").distinct().groupBy("source").agg(F.count(F.lit(1)).alias("all_pages"))
    low = paths(found, sites).where(F.col("score") > threshold)
    return found.select("page", "line_no", "source", "leaf").join(low, ["source", "leaf"]).select(F.col("page").alias("page_id"), "line_no", "score").distinct()
