"""The row-wise operators on streams, and duplicate removal within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import fingerprint
from millrace.operators.filters import reject_reason
from millrace.operators.normalise import normalise_posts


def post_stream(spark: SparkSession, folder: str, files_per_batch: int = 64) -> DataFrame:
    """Raw records from a folder of Parquet files with the columns of ``raw_records``."""
    schema = "record_id bigint, stream_id string, file_no int, file_name string, source_row int, payload string, landed_at timestamp"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def normalised_stream(raw: DataFrame, **rules) -> DataFrame:
    """Normalised posts with ``reason``; the same expressions as in batch, no state."""
    ref = F.concat("file_name", F.lit("#row="), "source_row")
    posts = normalise_posts(raw.select(ref.alias("source_ref"), F.regexp_replace("payload", r"^\x{feff}", "").alias("payload")))
    if not rules:
        return posts
    return posts.withColumn("reason", F.coalesce("reason", reject_reason(**rules)))


def first_seen(posts: DataFrame, time: str, delay: str = "1 day", text: str = "text_train") -> DataFrame:
    """The first post of each fingerprint within the watermark: state stays bounded by ``delay``, so a copy that comes
    later than that is kept again (batch removes it)."""
    marked = posts.withColumn("_fp", F.xxhash64(fingerprint(F.col(text)))).withWatermark(time, delay)
    return marked.dropDuplicatesWithinWatermark(["_fp"]).drop("_fp")
