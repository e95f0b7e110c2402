"""Timestamps in many spellings and zones to one UTC instant.

A text is laid out by the first shape that fits into ``year|month|day|hour|minute|second|fraction|half|zone``; all
checks and arithmetic then work on numbers. Local readings are looked up as of their clock time in a table of zone
offset intervals (one row for each zone and year, a handful of intervals each): two intervals that hold the reading
mean it is ambiguous, none that it was skipped, one gives the offset.

Defined results: null, blank and unreadable texts, impossible dates (also 24:00 and second 60), abbreviations that
the home zone never had and unknown zones give a null instant; a feed that is missing or has no zone counts as UTC;
an all-numeric date without a known order is unreadable unless its year comes first.
"""

from __future__ import annotations

from bisect import bisect_right
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo, available_timezones

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.runtime import bounded_broadcast

#: Years whose offsets are looked up; readings outside take the rules of the nearest of them.
FIRST_YEAR, LAST_YEAR = 1900, 2200
#: Days between probes of a zone. Changes closer together than this could be missed; no zone has such.
PROBE_DAYS = 6
CANONICAL = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"

# Month names, and the zone names that hold everywhere.
MONTHS = "january february march april may june july august september october november december".split()
ALWAYS_UTC = ("z", "utc", "gmt", "ut")

_ZONE = r"(Z|z|[+-]\d{2}(?::?\d{2})?|[A-Za-z]{1,5}|)"
_HALF = r"(?:\s*([AaPp]\.?[Mm]\.?))?"
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d+))?)?" + _HALF
_DAY = r"(?:[A-Za-z]{3,9}\.?,?\s+)?"
#: (order of an all-numeric date or None, pattern, layout)
SHAPES = (
    ("", rf"^(\d{{4}})-(\d{{1,2}})-(\d{{1,2}})[Tt\s]\s*{_CLOCK}\s*{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    ("", rf"^(\d{{4}})(\d{{2}})(\d{{2}})[Tt](\d{{2}})(\d{{2}})(\d{{2}})(?:[.,](\d+))?\s*{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    ("", rf"^{_DAY}(\d{{1,2}})[\s-]+([A-Za-z]{{3,9}})\.?,?[\s-]+(\d{{4}}),?\s+{_CLOCK}\s*{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    ("", rf"^[A-Za-z]{{3,9}}\s+([A-Za-z]{{3,9}})\s+(\d{{1,2}})\s+{_CLOCK}\s+{_ZONE}\s*(\d{{4}})$", "$9|$1|$2|$3|$4|$5|$6|$7|$8"),
    ("", rf"^{_DAY}([A-Za-z]{{3,9}})\.?\s+(\d{{1,2}}),?\s+(\d{{4}}),?\s+{_CLOCK}\s*{_ZONE}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    ("", rf"^(\d{{4}})[/.](\d{{1,2}})[/.](\d{{1,2}})[,Tt\s]+{_CLOCK}\s*{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    ("mdy", rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}|\d{{2}})[,\s]+{_CLOCK}\s*{_ZONE}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    ("dmy", rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}|\d{{2}})[,\s]+{_CLOCK}\s*{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    ("ymd", rf"^(\d{{2}})[/.-](\d{{1,2}})[/.-](\d{{1,2}})[,\s]+{_CLOCK}\s*{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
)
_EPOCH = r"^[+-]?\d{1,14}$"
#: Bare numbers from here on are milliseconds.
MILLIS_FROM = 100_000_000_000


def zone_intervals(zone: str) -> list[tuple[int, int, int, str]]:
    """(UTC start, UTC end, offset, abbreviation) of a zone, in seconds, without gaps over the years kept."""
    info = ZoneInfo(zone)
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)

    def at(second: int) -> tuple[int, str]:
        t = (epoch + timedelta(seconds=second)).astimezone(info)
        return int(t.utcoffset().total_seconds()), t.tzname()

    start = int(datetime(FIRST_YEAR, 1, 1, tzinfo=timezone.utc).timestamp()) - 86400 * 3
    end = int(datetime(LAST_YEAR + 1, 1, 1, tzinfo=timezone.utc).timestamp()) + 86400 * 3
    out, begun, state, probe = [], start, at(start), start
    while probe < end:
        ahead = min(probe + 86400 * PROBE_DAYS, end)
        if at(ahead) != state:
            low, high = probe, ahead
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if at(middle) == state else (low, middle)
            out.append((begun, high, *state))
            begun, state, probe = high, at(high), high
        else:
            probe = ahead
    out.append((begun, end, *state))
    return out


def zone_table(spark: SparkSession, zones: list[str]) -> tuple[DataFrame, dict[str, int]]:
    """One row for each zone and local year with the intervals that touch it; and offsets by ``zone/abbreviation``.

    The size is bounded by the zone database: about 600 zones times 300 years times a few intervals.
    """
    rows, named = [], {}
    for zone in zones:
        try:
            spans = zone_intervals(zone)
        except Exception:  # not a zone name
            continue
        for _, _, offset, name in spans:
            named[f"{zone}/{name.lower()}"] = offset  # the latest use of an abbreviation holds
        starts = [s[0] for s in spans]
        for year in range(FIRST_YEAR, LAST_YEAR + 1):
            a = int(datetime(year, 1, 1, tzinfo=timezone.utc).timestamp()) - 86400 * 2
            b = int(datetime(year + 1, 1, 1, tzinfo=timezone.utc).timestamp()) + 86400 * 2
            near = spans[max(0, bisect_right(starts, a) - 1) : bisect_right(starts, b)]
            if year == FIRST_YEAR:
                near[0] = (-(1 << 50), *near[0][1:])
            if year == LAST_YEAR:
                near[-1] = (near[-1][0], 1 << 50, *near[-1][2:])
            rows.append((zone, year, [(s + o, e + o, o) for s, e, o, _ in near]))
    schema = "home_zone string, local_year int, spans array<struct<lo:bigint,hi:bigint,off:int>>"
    return spark.createDataFrame(rows, schema), named


def _layout(text: Column, order: Column) -> Column:
    out = None
    for kind, pattern, layout in SHAPES:
        test = F.rlike(text, F.lit(pattern))
        if kind:
            test = (order == kind) & test
        value = F.regexp_replace(text, pattern, layout)
        out = F.when(test, value) if out is None else out.when(test, value)
    return out


def normalise_timestamps(
    df: DataFrame,
    feeds: DataFrame,
    *,
    text: str = "created_at",
    feed: str = "feed_id",
    keep: tuple[str, ...] = ("source_row",),
) -> DataFrame:
    """``keep`` columns with ``utc_micros`` (null where nothing is denoted) and ``reading``.

    ``reading`` is one of zoned, local, ambiguous, skipped, epoch, none. Narrow: one pass over ``df`` with two
    lookups in small tables whose sizes are checked before they are broadcast.
    """
    spark = df.sparkSession
    feeds = feeds.groupBy(F.col(feed).alias("_feed")).agg(
        F.min(F.coalesce("home_zone", F.lit("UTC"))).alias("_zone"), F.min("date_order").alias("_order")
    )
    # The zones in use: no more than the zone database has, whatever other names the feeds hold.
    known = spark.createDataFrame([(z,) for z in sorted(available_timezones())], "_zone string")
    zones = [r[0] for r in feeds.join(F.broadcast(known), "_zone", "left_semi").select("_zone").distinct().collect()]
    table, named = zone_table(spark, sorted({*zones, "UTC"}))
    named_map = F.create_map(*[F.lit(x) for kv in named.items() for x in kv])

    base = df.select(*[F.col(c) for c in keep], strip(F.col(text)).alias("_s"), F.col(feed).alias("_feed"))
    base = base.join(bounded_broadcast(feeds), "_feed", "left")
    base = base.select(*keep, "_s", F.coalesce("_zone", F.lit("UTC")).alias("_zone"), F.lower("_order").alias("_order"))
    p = F.split(_layout(F.col("_s"), F.col("_order")), r"\|")
    base = base.withColumn("_p", p)
    part = lambda i: F.get(F.col("_p"), F.lit(i))
    month_of = F.create_map(*[F.lit(x) for i, m in enumerate(MONTHS) for n in {m, m[:3]} | ({"sept"} if m[0:4] == "sept" else set()) for x in (n, i + 1)])
    number = lambda c: c.try_cast("int")
    year, half = number(part(0)), F.lower(F.substring(part(7), 1, 1))
    hour = number(part(3))
    base = base.select(
        *keep,
        "_s",
        "_zone",
        F.when(F.length(part(0)) == 2, year + F.when(year < 70, 2000).otherwise(1900)).otherwise(year).alias("_y"),
        F.coalesce(number(part(1)), F.try_element_at(month_of, F.lower(part(1)))).alias("_m"),
        number(part(2)).alias("_d"),
        F.when(F.coalesce(half, F.lit("")) == "", F.when(hour < 24, hour))
        .when(hour.between(1, 12), F.pmod(hour, F.lit(12)) + F.when(half == "p", 12).otherwise(0))
        .alias("_h"),
        number(part(4)).alias("_mi"),
        F.when(part(5) == "", 0).otherwise(number(part(5))).alias("_se"),
        F.rpad(F.substring(part(6), 1, 6), 6, "0").try_cast("int").alias("_frac"),
        part(8).alias("_z"),
    )
    day = F.unix_date(F.make_date(F.col("_y"), F.col("_m"), F.lit(1))) + F.col("_d") - 1
    longest = F.day(F.last_day(F.make_date(F.col("_y"), F.col("_m"), F.lit(1))))
    sound = F.col("_y").between(1, 9999) & F.col("_m").between(1, 12)
    sound_day = F.when(sound, F.when(F.col("_d").between(1, longest), day))
    clock = F.when((F.col("_mi") < 60) & (F.col("_se") < 60), (F.col("_h") * 60 + F.col("_mi")) * 60 + F.col("_se"))
    base = base.withColumn("_local", sound_day.cast("bigint") * 86400 + clock)
    digits = F.regexp_replace("_z", "[^0-9]", "")
    minutes = F.substring(digits, 3, 2).try_cast("int")
    offset = (
        F.when(F.lower("_z").isin(*ALWAYS_UTC), 0)
        .when(
            F.rlike("_z", F.lit("^[+-]")),
            F.when(
                F.coalesce(minutes, F.lit(0)) < 60,
                F.when(F.col("_z").startswith("-"), -1).otherwise(1)
                * (F.substring(digits, 1, 2).try_cast("int") * 3600 + F.coalesce(minutes, F.lit(0)) * 60),
            ),
        )
        .when(F.col("_z") != "", F.try_element_at(named_map, F.concat("_zone", F.lit("/"), F.lower("_z"))))
    )
    base = base.withColumn("_off", offset).withColumn(
        "local_year", F.when(F.col("_z") == "", F.least(F.greatest("_y", F.lit(FIRST_YEAR)), F.lit(LAST_YEAR)))
    )
    spans = table.withColumnRenamed("home_zone", "_zone")
    base = base.join(bounded_broadcast(spans, 600 * (LAST_YEAR - FIRST_YEAR + 1)), ["_zone", "local_year"], "left")
    hits = F.filter("spans", lambda s: (s["lo"] <= F.col("_local")) & (F.col("_local") < s["hi"]))
    before = F.filter("spans", lambda s: s["hi"] <= F.col("_local"))
    base = base.withColumn("_hits", hits)
    # The first of two equal readings is the one before the change; a skipped reading keeps the offset before it.
    local_off = F.when(F.size("_hits") > 0, F.get("_hits", F.lit(0))["off"]).otherwise(F.get(before, F.size(before) - 1)["off"])
    epoch = F.when(F.rlike("_s", F.lit(_EPOCH)), F.col("_s").try_cast("bigint"))
    from_epoch = epoch * F.when(F.abs(epoch) < MILLIS_FROM, 1_000_000).otherwise(1_000)
    chosen = F.when(F.col("_z") == "", local_off).otherwise(F.col("_off"))
    utc = F.coalesce(from_epoch, (F.col("_local") - chosen) * 1_000_000 + F.coalesce("_frac", F.lit(0)))
    reading = (
        F.when(from_epoch.isNotNull(), "epoch")
        .when(F.col("_local").isNull() | chosen.isNull(), "none")
        .when(F.col("_z") != "", "zoned")
        .when(F.size("_hits") > 1, "ambiguous")
        .when(F.size("_hits") == 0, "skipped")
        .otherwise("local")
    )
    return base.select(*keep, utc.alias("utc_micros"), reading.alias("reading"))


def noncanonical_instants(posts: DataFrame, feeds: DataFrame) -> DataFrame:
    """Rows whose text denotes an instant but isn't written in the canonical form already."""
    odd = posts.select("source_row", "feed_id", "created_at").where(~F.rlike("created_at", F.lit(CANONICAL)))
    out = normalise_timestamps(odd, feeds)
    return out.where(F.col("utc_micros").isNotNull()).select("source_row", "utc_micros")
