"""Mixed date formats and time zones brought to one form.

A value is rewritten by anchored patterns into one record ``#kind|a|b|c|hour|minute|second|half|zone``, split, checked
and converted with column expressions only; nothing leaves the JVM.

Results for odd input: null, blank or undated values, impossible dates and clock times, unknown zone abbreviations,
wall times that a clock change skipped or repeated, and all-number dates without a known day/month order give null.
Values whose source has no known zone use the zone estimated from the source's own rows, and null without evidence.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sheafline.session import cut

# Month names and short forms in English, German, French and Spanish, accents removed.
MONTHS = {
    "january": 1, "jan": 1, "januar": 1, "janvier": 1, "janv": 1, "enero": 1, "ene": 1,
    "february": 2, "feb": 2, "februar": 2, "fevrier": 2, "fevr": 2, "febrero": 2,
    "march": 3, "mar": 3, "marz": 3, "maerz": 3, "mars": 3, "marzo": 3,
    "april": 4, "apr": 4, "avril": 4, "avr": 4, "abril": 4, "abr": 4,
    "may": 5, "mai": 5, "mayo": 5,
    "june": 6, "jun": 6, "juni": 6, "juin": 6, "junio": 6,
    "july": 7, "jul": 7, "juli": 7, "juillet": 7, "juil": 7, "julio": 7,
    "august": 8, "aug": 8, "aout": 8, "agosto": 8, "ago": 8,
    "september": 9, "sep": 9, "sept": 9, "septembre": 9, "septiembre": 9,
    "october": 10, "oct": 10, "oktober": 10, "okt": 10, "octobre": 10, "octubre": 10,
    "november": 11, "nov": 11, "novembre": 11, "noviembre": 11,
    "december": 12, "dec": 12, "dezember": 12, "dez": 12, "decembre": 12, "diciembre": 12, "dic": 12,
}

# Zone abbreviations by the zones that use them, minutes east of UTC.
ZONE_ABBREVIATIONS = {
    "Europe/London": {"GMT": 0, "BST": 60},
    "Europe/Dublin": {"GMT": 0, "IST": 60},
    "Europe/Lisbon": {"WET": 0, "WEST": 60},
    "Europe/Berlin": {"CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120},
    "Europe/Madrid": {"CET": 60, "CEST": 120},
    "Europe/Paris": {"CET": 60, "CEST": 120},
    "Europe/Rome": {"CET": 60, "CEST": 120},
    "Europe/Athens": {"EET": 120, "EEST": 180},
    "Asia/Kolkata": {"IST": 330},
    "Asia/Shanghai": {"CST": 480},
    "Asia/Tokyo": {"JST": 540},
    "Australia/Sydney": {"AEST": 600, "AEDT": 660},
    "America/New_York": {"EST": -300, "EDT": -240},
    "America/Chicago": {"CST": -360, "CDT": -300},
    "America/Denver": {"MST": -420, "MDT": -360},
    "America/Los_Angeles": {"PST": -480, "PDT": -420},
}

#: Offset histories tried for a source whose zone nobody states.
CANDIDATE_ZONES = ("UTC", *ZONE_ABBREVIATIONS)

_CLOCK = r"(\d{1,2})[:h](\d{2})(?::(\d{2})(?:[.,]\d+)?)?"
_ZONE = r"\s?(z|[a-z]{2,5}|[+-]\d{2}:?\d{2})?"
_LINK = r"(?:,? (?:at |a |um |a las |kl )?|, )"
_MONTH = r"([a-z]{3,10})\.?"
_PATTERNS = (
    # year first, with and without separators
    (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})[t ]{_CLOCK}{_ZONE}$", "#T|$1|$2|$3|$4|$5|$6||$7"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})t(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,]\d+)?{_ZONE}$", "#T|$1|$2|$3|$4|$5|$6||$7"),
    (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})$", "#D|$1|$2|$3|||||"),
    (r"^(\d{4})(\d{2})(\d{2})$", "#D|$1|$2|$3|||||"),
    (r"^(\d{4})[-/.](\d{1,2})$", "#M|$1|$2||||||"),
    (r"^(\d{4})$", "#Y|$1|||||||"),
    (r"^(\d{10})$", "#S|$1|||||||"),
    (r"^(\d{10})(?:\d{3})$", "#S|$1|||||||"),
    # numbers with the day or the month first
    (rf"^(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}|\d{{2}}),?[t ]{_CLOCK}(?: ?([ap])\.?m\.?)?{_ZONE}$", "#N|$3|$1|$2|$4|$5|$6|$7|$8"),
    (r"^(\d{1,2})[-/.](\d{1,2})[-/.](\d{4}|\d{2})$", "#O|$3|$1|$2|||||"),
    # day, month name, year
    (rf"^(\d{{1,2}})(?:st|nd|rd|th|er|\.)?[ -](?:de )?{_MONTH}[ -](?:de )?,?(\d{{4}}|\d{{2}}){_LINK}{_CLOCK}(?: ?([ap])\.?m\.?| uhr)?{_ZONE}$", "#T|$3|$2|$1|$4|$5|$6|$7|$8"),
    (rf"^(\d{{1,2}})(?:st|nd|rd|th|er|\.)?[ -](?:de )?{_MONTH},?[ -](?:de )?(\d{{4}}|\d{{2}})$", "#D|$3|$2|$1|||||"),
    # month name, day, year
    (rf"^{_MONTH} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}}){_LINK}{_CLOCK}(?: ?([ap])\.?m\.?)?{_ZONE}$", "#T|$3|$1|$2|$4|$5|$6|$7|$8"),
    (rf"^{_MONTH} (\d{{1,2}})(?:st|nd|rd|th)?,? (\d{{4}})$", "#D|$3|$1|$2|||||"),
    # month name, day, clock, year
    (rf"^{_MONTH} (\d{{1,2}}) {_CLOCK}(?: ([a-z]{{2,5}}|[+-]\d{{2}}:?\d{{2}}))? (\d{{4}})$", "#T|$7|$1|$2|$3|$4|$5||$6"),
    # month name and year; year, month name and day
    (rf"^{_MONTH},? (?:de )?(\d{{4}})$", "#M|$2|$1||||||"),
    (rf"^(\d{{4}}) {_MONTH} (\d{{1,2}})$", "#D|$1|$2|$3|||||"),
    (rf"^(\d{{4}}) {_MONTH}$", "#M|$1|$2||||||"),
)
_NO_DATE = "\u0000"


def _record(value: Column) -> Column:
    """The parts of a value as an array of nine strings; null if no pattern fits."""
    v = F.translate(F.lower(value), "áàâäéèêëíîïóôöúùûüç", "aaaaeeeeiiiooouuuuc")
    v = F.regexp_replace(v, r"(?U)\s+", " ")
    v = F.trim(v)
    v = F.regexp_replace(v, r"^(?:e?pub(?:lished)?|first published|available|issued|posted|accepted)(?: (?:online|ahead of print))?(?: on)? ?:? ?", "")
    v = F.regexp_replace(v, r"^(?:mon|tue|wed|thu|fri|sat|sun)[a-z]{0,6}\.?,? ", "")
    for pattern, parts in _PATTERNS:
        v = F.regexp_replace(v, pattern, parts)
    return F.when(v.startswith("#"), F.split(v, r"\|"))


def _number(text: Column) -> Column:
    return text.try_cast("int")


def _once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that later columns refer to without its expression being repeated in each of them."""
    return df.withColumn(name, F.explode(F.array(value)))


def with_parts(df: DataFrame, value: str, order: str) -> DataFrame:
    """Adds ``p``: ``kind`` (T wall time, S seconds since 1970, D day, M month, Y year; null if unusable), ``stamp``
    (timestamp without zone) and ``zone`` (as written, upper case; null if absent)."""
    part = lambda i: F.get(F.col("_r"), F.lit(i))
    months = F.create_map(*[F.lit(x) for pair in MONTHS.items() for x in pair])
    kinds = {"#N": "T", "#O": "D", "#T": "T", "#D": "D", "#M": "M", "#Y": "Y", "#S": "S"}
    df = _once(df, "_r", _record(F.col(value)))
    numbers = part(0).isin("#N", "#O")
    year = F.when(F.length(part(1)) == 2, _number(part(1)) + 2000).when(part(0) != "#S", _number(part(1)))
    month = F.when(numbers & (F.col(order) == "dmy"), _number(part(3))).when(numbers & (F.col(order) == "mdy"), _number(part(2)))
    month = month.when(~numbers, F.coalesce(_number(part(2)), F.try_element_at(months, part(2))))
    day = F.when(numbers & (F.col(order) == "dmy"), _number(part(2))).when(numbers & (F.col(order) == "mdy"), _number(part(3))).when(~numbers, _number(part(3)))
    hour, half = _number(part(4)), part(7)
    hour = F.when(half == "", hour).when(hour.between(1, 12), F.pmod(hour, F.lit(12)) + F.when(half == "p", 12).otherwise(0))
    fields = F.struct(
        F.try_element_at(F.create_map(*[F.lit(x) for pair in kinds.items() for x in pair]), part(0)).alias("kind"),
        year.alias("year"), month.alias("month"), day.alias("day"), hour.alias("hour"), _number(part(5)).alias("minute"),
        F.coalesce(_number(part(6)), F.lit(0)).alias("second"), F.when(part(0) == "#S", part(1).try_cast("long")).alias("epoch"),
        F.when(part(0).isin("#T", "#N"), F.upper(F.nullif(part(8), F.lit("")))).alias("zone"),
    )
    df = _once(df, "_f", F.when(F.col("_r").isNotNull(), fields)).drop("_r")
    f = F.col("_f")
    zero = F.lit(0)
    stamp = (
        F.when(~f["year"].between(1000, 9999), None)
        .when((f["kind"] == "T") & f["hour"].between(0, 23) & f["minute"].between(0, 59) & f["second"].between(0, 59), F.try_make_timestamp_ntz(f["year"], f["month"], f["day"], f["hour"], f["minute"], f["second"]))
        .when(f["kind"].isin("D", "M", "Y"), F.try_make_timestamp_ntz(
            f["year"], F.when(f["kind"] == "Y", 1).otherwise(f["month"]), F.when(f["kind"] == "D", f["day"]).otherwise(1), zero, zero, zero))
        .when(f["kind"] == "S", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, f["epoch"].cast("decimal(18,6)")))
    )
    df = _once(df, "_s", stamp)
    return _once(df, "p", F.when(F.col("_s").isNotNull(), F.struct(f["kind"].alias("kind"), F.col("_s").alias("stamp"), f["zone"].alias("zone")))).drop("_f", "_s")


def offset(p: Column, tz: Column) -> Column:
    """Minutes east of UTC that the value itself states; an abbreviation is read as the source's own zone uses it."""
    zone = p["zone"]
    digits = F.replace(zone, F.lit(":"), F.lit(""))
    minutes = _number(F.substring(digits, 2, 2)) * 60 + _number(F.substring(digits, 4, 2))
    own = F.create_map(*[F.lit(x) for z, names in ZONE_ABBREVIATIONS.items() for a, m in names.items() for x in (f"{z} {a}", m)])
    meanings: dict[str, set[int]] = {}  # an abbreviation with one meaning stands for it everywhere
    for names in ZONE_ABBREVIATIONS.values():
        for a, m in names.items():
            meanings.setdefault(a, set()).add(m)
    alone = F.create_map(*[F.lit(x) for a, m in meanings.items() if len(m) == 1 for x in (a, min(m))])
    return (
        F.when(p["kind"] == "S", 0)
        .when(zone.isin("Z", "UTC", "UT", "GMT"), 0)
        .when(zone.rlike("^[+-]"), F.when(minutes <= 18 * 60, F.when(zone.startswith("-"), -minutes).otherwise(minutes)))
        .otherwise(F.coalesce(F.try_element_at(own, F.concat_ws(" ", tz, zone)), F.try_element_at(alone, zone)))
    )


def _minutes(n: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), n, F.lit(0).cast("decimal(18,6)"))


def instant(wall: Column, tz: Column) -> Column:
    """UTC time (without zone) of a wall time; null if the zone's clock skipped or repeated it."""
    utc = F.convert_timezone(tz, F.lit("UTC"), wall)
    at = lambda shift: F.convert_timezone(F.lit("UTC"), tz, utc + F.expr(f"INTERVAL '{shift}' MINUTE"))
    twice = (at(30) == wall) | (at(60) == wall) | (at(-30) == wall) | (at(-60) == wall)
    return F.when((at(0) == wall) & ~twice, utc)


def with_iso(df: DataFrame, tz: str) -> DataFrame:
    """Adds ``iso_value``, the normal form of ``p``."""
    p = F.col("p")
    df = _once(df, "_o", offset(p, F.col(tz)))
    moved = F.when(F.col("_o").isNotNull(), p["stamp"] - _minutes(F.col("_o"))).when(p["zone"].isNull(), instant(p["stamp"], F.col(tz)))
    df = _once(df, "_u", F.when(p["kind"].isin("T", "S"), moved).otherwise(p["stamp"]).cast("string"))
    text = lambda n: F.substring(F.col("_u"), 1, n)
    form = F.when(p["kind"] == "D", text(10)).when(p["kind"] == "M", text(7)).when(p["kind"] == "Y", text(4))
    return df.withColumn("iso_value", form.otherwise(F.concat(F.replace(text(19), F.lit(" "), F.lit("T")), F.lit("Z")))).drop("_o", "_u")


def estimate_zones(
    observed: DataFrame, candidates: tuple[str, ...] = CANDIDATE_ZONES, slack_minutes: int = 5, cap_minutes: int = 360, change_cost: float = 3.0
) -> DataFrame:
    """The offset history of each source that its own rows contradict least.

    ``observed``: ``source``, ``p`` (from :func:`with_parts`) and ``ingested`` (timestamp, may be null). What a row says against
    a candidate zone is a number from 0 to 1: for a wall time without zone 1 if it never existed there or would lie after
    its ingestion, else how far its delay until ingestion is from the usual one, ``cap_minutes`` or more counting 1; for a
    written offset 1 if the zone has another one at that instant. So zones too far west fail by rows from the future and those too
    far east by long delays. The usual delay is the median of the rows that state their zone, 0 if none does.

    A source may have moved once: its history is cut at the start of the month where that lowers the sum by more than
    ``change_cost``. Rows are added up per source, month and candidate before the shuffle. Result: ``source, since,
    tz_estimated, violations, evidence``, one row per source, or two of which the later has ``since``; ties go to the earlier candidate;
    sources without evidence have no row.
    """
    p = F.col("p")
    rows = observed.where((p["kind"] == "T") & F.col("source").isNotNull()).select("source", "p", F.col("ingested").cast("timestamp_ntz").alias("ingested"))
    rows = rows.where((p["zone"].isNull() & F.col("ingested").isNotNull()) | p["zone"].rlike(r"^[+-]"))
    minutes = lambda x: F.timestamp_diff("MINUTE", x, F.col("ingested"))
    stated = rows.where(p["zone"].isNotNull() & F.col("ingested").isNotNull())
    usual = stated.agg(F.coalesce(F.percentile_approx(minutes(p["stamp"] - _minutes(offset(p, F.lit(None).cast("string")))), 0.5), F.lit(0)).alias("usual"))
    tried = F.posexplode(F.array(*[F.lit(z) for z in candidates])).alias("rank", "tz")
    month = F.date_trunc("MONTH", F.coalesce("ingested", p["stamp"])).cast("timestamp_ntz").alias("month")
    rows = rows.crossJoin(F.broadcast(usual)).select("source", "p", "ingested", "usual", month, tried)  # one row
    rows = _once(rows, "_utc", F.convert_timezone(F.col("tz"), F.lit("UTC"), p["stamp"]))
    back = F.convert_timezone(F.lit("UTC"), F.col("tz"), F.col("_utc"))
    lag = minutes(F.col("_utc"))
    written = p["stamp"] - _minutes(offset(p, F.col("tz")))
    without = F.when((back != p["stamp"]) | (lag < -slack_minutes), 1.0).otherwise(F.least(F.abs(lag - F.col("usual")) / F.lit(float(cap_minutes)), F.lit(1.0)))
    against = F.when(p["zone"].isNull(), without).otherwise((F.convert_timezone(F.lit("UTC"), F.col("tz"), written) != p["stamp"]).cast("double"))
    counts = cut(rows.groupBy("source", "month", "tz", "rank").agg(F.sum(against).alias("bad"), F.count(F.lit(1)).alias("n")))  # small, read often below
    # sums before each month and from it on; the first month's cut is no cut
    by = Window.partitionBy("source", "tz").orderBy("month")
    every = counts.select("source", "month").distinct().join(counts.select("source", "tz", "rank").distinct(), "source").join(counts, ["source", "month", "tz", "rank"], "left").fillna(0, ["bad", "n"])
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    sums = every.select("source", "month", "tz", "rank", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_1") for c in ("bad", "n")], *[F.sum(c).over(by.rowsBetween(0, Window.unboundedFollowing)).alias(f"{c}_2") for c in ("bad", "n")])
    part = lambda k: F.min(F.struct(F.round(f"bad_{k}", 6).alias("bad"), "rank", "tz", F.col(f"n_{k}").alias("n"))).alias(f"part{k}")
    cuts = sums.groupBy("source", "month").agg(part(1), part(2), F.max(F.col("n_1")).alias("n_before"))
    total = F.col("part1.bad") + F.col("part2.bad") + F.when(F.col("n_before") > 0, change_cost).otherwise(0.0)
    best = cuts.groupBy("source").agg(F.min(F.struct(total.alias("total"), "month", "part1", "part2", "n_before")).alias("b"))
    piece = lambda k, since: F.struct(since.alias("since"), F.col(f"b.part{k}.tz").alias("tz_estimated"), F.col(f"b.part{k}.bad").alias("violations"), F.col(f"b.part{k}.n").alias("evidence"))
    never = F.lit(None).cast("timestamp_ntz")
    pieces = F.when(F.col("b.n_before") > 0, F.array(piece(1, never), piece(2, F.col("b.month")))).otherwise(F.array(piece(2, never)))
    return best.select("source", F.explode(pieces).alias("x")).select("source", "x.*")


def normalise_times(
    df: DataFrame, clock: DataFrame, id_cols: list[str], value_col: str, source_col: str = "source", ingested_col: str | None = None, estimate: bool = True
) -> DataFrame:
    """``id_cols`` and ``iso_value`` for each value of ``value_col`` that can be normalised.

    ``clock``: ``source, tz_name, date_order``, one row per source. Sources that it lacks get the zone estimated from
    ``df``; their all-number dates stay null. ``df`` may have any other columns.
    """
    ids = [F.col(c).alias(f"_id{i}") for i, c in enumerate(id_cols)]
    ingested = (F.col(ingested_col) if ingested_col else F.lit(None)).cast("timestamp")
    rows = df.select(*ids, F.col(source_col).alias("source"), F.col(value_col).alias("value"), ingested.alias("ingested"))
    known = clock.select("source", "tz_name", "date_order").where(F.col("source").isNotNull()).dropDuplicates(["source"])
    joined = rows.where(F.col("value").isNotNull()).join(known, "source", "left")
    joined = joined.withColumn("tz", F.col("tz_name"))
    unknown = with_parts(joined.where(F.col("tz").isNull() & F.col("source").isNotNull()), "value", "date_order").where(F.col("p").isNotNull())
    joined = with_parts(joined, "value", "date_order").where(F.col("p").isNotNull())
    if estimate:
        guessed = estimate_zones(unknown)
        early = guessed.where("since is null").select("source", "tz_estimated")
        late = guessed.where("since is not null").select("source", "since", F.col("tz_estimated").alias("tz_later"))
        moved = F.coalesce(F.col("ingested").cast("timestamp_ntz"), F.col("p.stamp")) >= F.col("since")
        joined = joined.join(early.join(late, "source", "left"), "source", "left").withColumn("tz", F.coalesce("tz", F.when(moved, F.col("tz_later")), "tz_estimated"))
    done = with_iso(joined, "tz").where(F.col("iso_value").isNotNull())
    return done.select(*[F.col(f"_id{i}").alias(c) for i, c in enumerate(id_cols)], "iso_value")
