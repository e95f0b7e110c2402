"""Readers that keep the source row of every record: JSON lines, CSV with a header, JSON documents, TOML settings.

All give (source_ref, source_row, payload) with the record as the text of a JSON object. Line numbers are physical
lines from 1 for JSON lines, records from 2 for CSV (the header is 1) and from 1 for JSON documents; a byte order mark
is ignored. Lines are numbered in the JVM where they are read: each input split counts its lines, and the counts of the
splits before it are added, so no file of lines passes through one task. A CSV file whose quoted fields may hold line
breaks and a JSON document can't be cut before they are read: each file of those is one task, so large ones should come
as several files or as JSON lines.

Defined results: blank lines are skipped but counted; a line that is no JSON, and a record that is no object, is an
error that names its row; an empty file gives an empty frame.
"""

from __future__ import annotations

import tomllib
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.prompts import extracted_text
from millrace.sources.errors import DataError

# Where a JSON document keeps its records, in order of preference.
WRAPPERS = ("data", "posts", "tweets", "records")
RECORDS = "source_ref string, source_row bigint, payload string"


def read_settings(path: str) -> dict:
    """Settings from a TOML file."""
    try:
        with open(path, "rb") as f:
            return tomllib.load(f)
    except (OSError, tomllib.TOMLDecodeError) as e:
        raise DataError(f"settings {path}: {e}") from e


def _numbered(rows: DataFrame, first: int) -> DataFrame:
    """``rows`` with ``source_row``: their number in the order of the file, from ``first``.

    The id that Spark gives a row holds its partition, in the order of the file's splits, and its place there. One
    count for each partition is all that reaches the driver.
    """
    marked = rows.withColumn("_id", F.monotonically_increasing_id())
    split = F.shiftright("_id", 33).cast("int")
    counts = {r[0]: r[1] for r in marked.groupBy(split.alias("s")).agg(F.count(F.lit(1)).alias("n")).collect()}
    start, before = {}, 0
    for s in sorted(counts):
        start[s] = before
        before += counts[s]
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in start.items() for x in kv]), split) if start else F.lit(0)
    return marked.withColumn("source_row", (F.col("_id") - F.shiftleft(split.cast("bigint"), 33) + offset + first).cast("bigint")).drop("_id")


def _checked(df: DataFrame, what: str) -> DataFrame:
    """``df`` after an error for the first record that can't be read as an object."""
    bad = df.where("not ok").agg(F.min("source_row").alias("row")).collect()[0].row
    if bad is not None:
        raise DataError(f"{what} {bad} is not a JSON object")
    return df.select("source_row", "payload")


def _with_ref(df: DataFrame, path: str) -> DataFrame:
    name = PurePosixPath(path.split("://")[-1]).name
    return df.select(F.concat(F.lit(f"{name}#row="), "source_row").alias("source_ref"), F.col("source_row").cast("bigint"), "payload")


def _is_object(text) -> "F.Column":
    return F.coalesce(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.lit(False))


def read_json_lines(spark: SparkSession, path: str) -> DataFrame:
    lines = _numbered(spark.read.text(path), 1).withColumn("payload", F.regexp_replace("value", r"^\x{feff}", ""))
    lines = lines.where(F.rlike("payload", F.lit(r"[^\s\p{Z}]"))).withColumn("ok", _is_object(F.col("payload")))
    return _with_ref(_checked(lines, "line"), path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All fields are strings; quoted fields may hold line breaks, which is why a file is one split here."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", None).csv(path)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns]).fillna("")
    names = rows.columns
    rows = _numbered(rows, 2)
    return _with_ref(rows.select("source_row", F.to_json(F.struct(*[F.col(f"`{c}`") for c in names])).alias("payload")), path)


def read_json_document(spark: SparkSession, path: str) -> DataFrame:
    """A list of objects, or an object that holds one under a known name."""
    whole = spark.read.text(path, wholetext=True).select(F.try_parse_json(F.regexp_replace("value", r"^\x{feff}", "")).alias("v"))
    inside = [F.when(F.schema_of_variant(F.try_variant_get("v", f"$.{k}", "variant")).startswith("ARRAY"), F.try_variant_get("v", f"$.{k}", "variant")) for k in WRAPPERS]
    root = F.when(F.schema_of_variant("v").startswith("ARRAY"), F.col("v")).otherwise(F.coalesce(*inside))
    found = whole.select(root.alias("v"))
    if found.where("v is null").limit(1).count():
        raise DataError("no list of records at the top or under " + "/".join(WRAPPERS))
    each = found.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    each = each.select((F.col("pos") + 1).alias("source_row"), F.to_json("value").alias("payload"), F.schema_of_variant("value").startswith("OBJECT").alias("ok"))
    return _with_ref(_checked(each, "record"), path)


READERS = {".jsonl": read_json_lines, ".ndjson": read_json_lines, ".csv": read_csv, ".json": read_json_document}


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Reader by the file's extension."""
    suffix = PurePosixPath(path.split("://")[-1]).suffix.lower()
    if suffix not in READERS:
        raise DataError(f"no reader for files ending in {suffix or 'nothing'}")
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    if not target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target):
        raise DataError(f"nothing to read at {path}")
    return READERS[suffix](spark, path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(idx, text) of a file of records to evaluate; idx is the source row."""
    rows = read_records(spark, path).select("source_row", extracted_text(F.col("payload")).alias("text"))
    missing = rows.where("text is null").agg(F.min("source_row").alias("row")).collect()[0].row
    if missing is not None:
        raise DataError(f"record {missing} has no text field")
    return rows.select(F.col("source_row").alias("idx"), "text")


def read_timeline(spark: SparkSession, path: str, most: int = 200) -> DataFrame:
    """The landed rows of a timeline without retweets: user, text, favourites, retweets and time of the latest rows."""
    rows = read_json_lines(spark, path)
    value = lambda p: F.get_json_object("payload", p)
    out = rows.where(value("$.retweeted_status").isNull()).select(
        value("$.user.screen_name").alias("user"),
        F.coalesce(value("$.full_text"), value("$.text")).alias("text"),
        value("$.favorite_count").alias("favorite_count"),
        value("$.retweet_count").alias("retweet_count"),
        value("$.created_at").alias("created_at"),
        "source_row",
    )
    return out.orderBy("source_row").limit(most).drop("source_row")
