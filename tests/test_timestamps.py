"""Timestamps against a row-by-row reading with the standard library."""

import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from millrace.operators.timestamps import noncanonical_instants, normalise_timestamps
from millrace.runtime import table

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()


def local_micros(clock: datetime, zone: str) -> int:
    """The first of two equal readings; a skipped one with the offset before the change (that is fold 0)."""
    return (clock.replace(tzinfo=ZoneInfo(zone), fold=0) - EPOCH) // timedelta(microseconds=1)


def read(text, zone, order):
    """Slow reading of one text; None where it denotes nothing."""
    s = (text or "").strip()
    if re.fullmatch(r"[+-]?\d{1,14}", s):
        n = int(s)
        return n * 1_000_000 if abs(n) < 10**11 else n * 1000
    m = re.fullmatch(r"(\d{4})-(\d\d?)-(\d\d?)[ T](.*)", s)
    if m:
        y, mo, d, rest = int(m[1]), int(m[2]), int(m[3]), m[4]
    elif m := re.fullmatch(r"(\d{4})(\d\d)(\d\d)T(\d\d)(\d\d)(\d\d)(.*)", s):
        y, mo, d, rest = int(m[1]), int(m[2]), int(m[3]), f"{m[4]}:{m[5]}:{m[6]}{m[7]}"
    elif m := re.fullmatch(r"(?:[A-Z][a-z]+, )?(\d\d?) ([A-Z][a-z]+) (\d{4}) (.*)", s):
        y, mo, d, rest = int(m[3]), MONTHS.index(m[2][:3].lower()) + 1, int(m[1]), m[4]
    elif m := re.fullmatch(r"[A-Z][a-z]+ ([A-Z][a-z]+) (\d\d?) ([\d:]+ [+-]\d{4}) (\d{4})", s):
        y, mo, d, rest = int(m[4]), MONTHS.index(m[1][:3].lower()) + 1, int(m[2]), m[3]
    elif m := re.fullmatch(r"(\d{4})/(\d\d?)/(\d\d?) (.*)", s):
        y, mo, d, rest = int(m[1]), int(m[2]), int(m[3]), m[4]
    elif (m := re.fullmatch(r"(\d\d?)[/.](\d\d?)[/.](\d{4}|\d\d) (.*)", s)) and order in ("mdy", "dmy"):
        a, b, y, rest = int(m[1]), int(m[2]), int(m[3]), m[4]
        mo, d = (a, b) if order == "mdy" else (b, a)
        y += 2000 if y < 70 else 1900 if y < 100 else 0
    else:
        return None
    m = re.fullmatch(r"(\d\d?):(\d\d)(?::(\d\d)(?:[.,](\d+))?)?(?: ?(AM|PM))?\s*(Z|[+-]\d\d:?\d\d|[A-Z]{2,5})?", rest)
    if not m:
        return None
    h = int(m[1])
    if m[5]:
        if not 1 <= h <= 12:
            return None
        h = h % 12 + (12 if m[5] == "PM" else 0)
    try:
        clock = datetime(y, mo, d, h, int(m[2]), int(m[3] or 0), int((m[4] or "0")[:6].ljust(6, "0")))
    except ValueError:
        return None
    z = m[6]
    if not z:
        return local_micros(clock, zone)
    naive = (clock.replace(tzinfo=timezone.utc) - EPOCH) // timedelta(microseconds=1)
    if z in ("Z", "UTC", "GMT"):
        return naive
    if z[0] in "+-":
        digits = z[1:].replace(":", "")
        return naive - (-1 if z[0] == "-" else 1) * (int(digits[:2]) * 60 + int(digits[2:])) * 60_000_000
    for month in (1, 7):
        probe = datetime(2024, month, 1, tzinfo=ZoneInfo(zone))
        if probe.tzname() == z:
            return naive - probe.utcoffset() // timedelta(microseconds=1)
    return None


def test_every_row_against_slow_reading(spark, medium):
    posts, feeds = table(spark, medium, "synthetic_posts"), table(spark, medium, "feeds")
    got = {r.source_row: r.utc_micros for r in noncanonical_instants(posts, feeds).collect()}
    homes = {r.feed_id: (r.home_zone or "UTC", r.date_order) for r in feeds.collect()}
    want = {}
    for r in posts.select("source_row", "feed_id", "created_at").collect():
        if r.created_at is None or re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\dZ", r.created_at):
            continue
        if (value := read(r.created_at, *homes[r.feed_id])) is not None:
            want[r.source_row] = value
    assert got == want and len(want) > 1000


def one(spark, text, zone="UTC", order="mdy"):
    posts = spark.createDataFrame([(1, "f", text, 9)], "source_row bigint, feed_id string, created_at string, _zone int")
    feeds = spark.createDataFrame([("f", zone, order)], "feed_id string, home_zone string, date_order string")
    row = normalise_timestamps(posts, feeds).collect()[0]
    return row.utc_micros, row.reading


def test_daylight_saving(spark):
    at = lambda *x: int(datetime(*x, tzinfo=timezone.utc).timestamp()) * 1_000_000
    assert one(spark, "2024-11-03 01:30:00", "America/New_York") == (at(2024, 11, 3, 5, 30), "ambiguous")
    assert one(spark, "2024-03-10 02:30:00", "America/New_York") == (at(2024, 3, 10, 7, 30), "skipped")
    assert one(spark, "2024-07-01 12:00:00", "America/New_York") == (at(2024, 7, 1, 16), "local")
    assert one(spark, "1600-07-01 12:00:00", "Europe/Berlin")[0] is not None
    assert one(spark, "2500-07-01 12:00:00", "Europe/Berlin")[0] is not None


def test_what_denotes_nothing(spark):
    for text in (None, "", "  ", "soon", "2023-13-05 08:00:00", "2023-02-30 08:00:00", "2024-01-01 24:00:00", "2024-01-01 10:00:60", "0000-00-00 00:00:00", "2024-01-01 10:00:00 XYZ", "13:00 PM", "x" * 50_000):
        assert one(spark, text) == (None, "none")
    assert one(spark, "01/02/2024 10:00", order=None) == (None, "none")
    assert one(spark, "1/15/24 12:05 AM")[0] == int(datetime(2024, 1, 15, 0, 5, tzinfo=timezone.utc).timestamp()) * 1_000_000


def test_fractions_are_cut(spark):
    assert one(spark, "1970-01-01T00:00:00,1234567899Z") == (123456, "zoned")


def test_missing_feed_and_empty_tables(spark):
    posts = spark.createDataFrame([(1, "gone", "2024-01-01 00:00:00"), (2, None, "2024-01-01 00:00:00")], "source_row bigint, feed_id string, created_at string")
    feeds = spark.createDataFrame([], "feed_id string, home_zone string, date_order string")
    assert {r.utc_micros for r in normalise_timestamps(posts, feeds).collect()} == {1704067200000000}
    assert normalise_timestamps(posts.limit(0), feeds).count() == 0


def test_any_number_of_junk_zone_names(spark):
    feeds = [(f"f{i}", f"Nowhere/{i}", "ymd") for i in range(3000)] + [("z", "Pacific/Apia", "ymd"), ("a", "Africa/Abidjan", "ymd")]
    feeds = spark.createDataFrame(feeds, "feed_id string, home_zone string, date_order string")
    rows = [(1, "z", "2024-01-01 00:00:00"), (2, "a", "2024-01-01 00:00:00"), (3, "f7", "2024-01-01 00:00:00"), (4, "f7", "2024-01-01 00:00:00Z")]
    posts = spark.createDataFrame(rows, "source_row bigint, feed_id string, created_at string")
    got = {r.source_row: r.utc_micros for r in normalise_timestamps(posts, feeds).collect()}
    day = 1704067200 * 10**6
    assert got == {1: day - 13 * 3600 * 10**6, 2: day, 3: None, 4: day}
