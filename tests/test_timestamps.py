import datetime as dt

import pytest
from pyspark.sql import functions as F

from sheafline.operators.timestamps import estimate_zones, normalise_times, with_parts

CLOCK = [("ber", "Europe/Berlin", "dmy"), ("ny", "America/New_York", "mdy"), ("sh", "Asia/Shanghai", "dmy"), ("in", "Asia/Kolkata", "dmy"), ("lon", "Europe/London", "dmy")]
CASES = [
    ("ber", "2024-07-01 10:00", "2024-07-01T08:00:00Z"),
    ("ber", "1. April 2023, 00:56 Uhr", "2023-03-31T22:56:00Z"),
    ("ber", "3. März 2021", "2021-03-03"),
    ("ber", "19 juin 2022 à 07h58", "2022-06-19T05:58:00Z"),
    ("ber", "16 de julio de 2025, 15:20", "2025-07-16T13:20:00Z"),
    ("ber", "2024-03-31 02:30:00", None),  # skipped
    ("ber", "2024-10-27 02:30:00", None),  # repeated
    ("ber", "2024-10-27 03:00:00", "2024-10-27T02:00:00Z"),
    ("ber", "2024-10-27T02:30:00+01:00", "2024-10-27T01:30:00Z"),
    ("ny", "02/03/2024", "2024-02-03"),
    ("ny", "13/03/2024", None),
    ("ber", "02/03/2024", "2024-03-02"),
    ("ny", "Mon, 1 Jul 2024 10:00:00 EDT", "2024-07-01T14:00:00Z"),
    ("sh", "Mon, 01 Jul 2024 10:00:00 CST", "2024-07-01T02:00:00Z"),
    ("in", "Mon, 01 Jul 2024 10:00:00 IST", "2024-07-01T04:30:00Z"),
    ("lon", "Mon, 01 Jul 2024 10:00:00 BST", "2024-07-01T09:00:00Z"),
    ("lon", "Mon, 01 Jul 2024 10:00:00 XYZ", None),
    ("ber", "1697461069", "2023-10-16T12:57:49Z"),
    ("ber", "1697461069999", "2023-10-16T12:57:49Z"),
    ("ber", "20250711T234241Z", "2025-07-11T23:42:41Z"),
    ("ber", "2025-01-01T00:00:00.999999999-05:30", "2025-01-01T05:30:00Z"),
    ("lon", " Thu Feb  1 02:38:30 2024 ", "2024-02-01T02:38:30Z"),
    ("lon", "17-Feb-23 06:24:46", "2023-02-17T06:24:46Z"),
    ("lon", "July 21, 2021 12:54 AM", "2021-07-20T23:54:00Z"),
    ("lon", "July 21, 2021 12:54 PM", "2021-07-21T11:54:00Z"),
    ("lon", "July 21, 2021 13:54 PM", None),
    ("lon", "May 24th, 2024", "2024-05-24"),
    ("lon", "Published online: 21 February 2025", "2025-02-21"),
    ("lon", "Epub 2021 Aug 28", "2021-08-28"),
    ("lon", "MAY 2023", "2023-05"),
    ("lon", "2024-10", "2024-10"),
    ("lon", "2022", "2022"),
    ("lon", "20201121", "2020-11-21"),
    ("lon", "2023/10/04", "2023-10-04"),
    ("lon", "2023-02-30", None),
    ("lon", "2023-13-01", None),
    ("lon", "2023-02-30T10:15:00Z", None),
    ("lon", "25:61", None),
    ("lon", "Spring 2024", None),
    ("lon", "0000-00-00 00:00:00", None),
    ("lon", "", None),
    ("lon", "   ", None),
    ("lon", None, None),
    ("lon", "x" * 20000, None),
    ("nowhere", "2024-07-01 10:00", None),
    ("nowhere", "2024-07-01T10:00:00Z", "2024-07-01T10:00:00Z"),
    (None, "2024-07-01", "2024-07-01"),
]


@pytest.fixture(scope="module")
def clock(spark):
    return spark.createDataFrame(CLOCK, "source string, tz_name string, date_order string")


def test_forms(spark, clock):
    rows = spark.createDataFrame([(i, s, v, "clash", 1) for i, (s, v, _) in enumerate(CASES)], "row long, source string, v string, tz string, p int")
    got = {r["row"]: r["iso_value"] for r in normalise_times(rows, clock, ["row"], "v").collect()}
    assert {i: got.get(i) for i in range(len(CASES))} == {i: w for i, (_, _, w) in enumerate(CASES)}


def test_empty_and_repeated_clock(spark, clock):
    rows = spark.createDataFrame([], "row long, source string, v string")
    assert normalise_times(rows, clock, ["row"], "v").count() == 0
    rows = spark.createDataFrame([(1, "ber", "2024")] * 2, "row long, source string, v string")
    assert normalise_times(rows, clock.union(clock), ["row"], "v").count() == 2


def test_zone_estimated_from_rows(spark):
    start = dt.datetime(2024, 1, 1)
    rows = [("tok", str(start + dt.timedelta(days=9 * i)) + "+09:00", None) for i in range(30)]
    rows += [("tok", "2024-05-05 10:00:00", dt.datetime(2024, 5, 5, 2))]
    # wall times just before their ingestion: an earlier zone would put them after it
    rows += [("shang", str(start + dt.timedelta(hours=8, days=9 * i)), start + dt.timedelta(days=9 * i, minutes=1)) for i in range(30)]
    df = with_parts(spark.createDataFrame(rows, "source string, v string, ingested timestamp").withColumn("o", F.lit(None).cast("string")), "v", "o")
    got = {r["source"]: (r["tz_estimated"], r["violations"] < 0.2) for r in estimate_zones(df, ("UTC", "America/New_York", "Asia/Shanghai", "Asia/Tokyo")).collect()}
    assert got == {"tok": ("Asia/Tokyo", True), "shang": ("Asia/Shanghai", True)}
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row long, source string, v string, ingested timestamp")
    none = spark.createDataFrame([], "source string, tz_name string, date_order string")
    out = {r["row"]: r["iso_value"] for r in normalise_times(frame, none, ["row"], "v", ingested_col="ingested").collect()}
    assert out[30] == "2024-05-05T01:00:00Z"


def _moments(n, seed):
    rng = __import__("random").Random(seed)
    return [dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rng.randrange(500 * 1440)) for _ in range(n)]


def test_zones_from_delays_alone(spark):
    """Western, eastern, moved and long delayed sources; no row states a zone."""
    from zoneinfo import ZoneInfo

    rows, want = [], {}
    wall = lambda m, z: m.replace(tzinfo=dt.timezone.utc).astimezone(ZoneInfo(z)).strftime("%Y-%m-%d %H:%M:%S")
    for name, zone in (("west", "America/Chicago"), ("east", "Asia/Tokyo"), ("utc", "UTC"), ("summer", "Europe/Berlin")):
        rows += [(name, wall(m, zone), m + dt.timedelta(minutes=30)) for m in _moments(60, len(name))]
        want[name] = [(None, zone)]
    for m in _moments(200, 9):
        late = m >= dt.datetime(2024, 9, 1)
        rows.append(("moved", wall(m, "America/New_York" if late else "Asia/Kolkata"), m + dt.timedelta(minutes=20)))
    want["moved"] = [(None, "Asia/Kolkata"), (dt.datetime(2024, 9, 1), "America/New_York")]
    rows += [("few", wall(m, "America/Chicago"), m + dt.timedelta(minutes=30)) for m in _moments(8, 3)]
    want["few"] = [(None, "America/Chicago")]
    df = spark.createDataFrame(rows, "source string, value string, ingested timestamp")
    found = {}
    for r in estimate_zones(with_parts(df.withColumn("o", F.lit("dmy")), "value", "o")).orderBy("since").collect():
        found.setdefault(r["source"], []).append((r["since"], r["tz_estimated"]))
    assert found == want
    # rows of unknown sources are converted with the zone of their time
    df = df.withColumn("id", F.monotonically_increasing_id())
    iso = normalise_times(df, spark.createDataFrame([], "source string, tz_name string, date_order string"), ["id"], "value", ingested_col="ingested")
    lag = F.timestamp_diff("MINUTE", F.to_timestamp("iso_value"), F.col("ingested"))
    assert {r[0] for r in iso.join(df, "id").select(lag).distinct().collect()} == {20, 30}
