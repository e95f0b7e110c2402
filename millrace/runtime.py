"""Session defaults and the few run-time services that operators share.

* ``stash`` cuts lineage by writing a table into the shared checkpoint folder, so a lost executor costs a re-read
  and not a re-computation, and no copy lives on one machine only.
* ``bounded_broadcast`` broadcasts a side only after its size has been checked.
* ``salted_join`` joins on a key of which single values may hold a large share of the rows.
"""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Most rows of a side that is broadcast, whatever the inputs' size.
BROADCAST_ROWS = 100_000
#: Most bytes that one task of a large shuffle should read.
TASK_BYTES = 64 << 20
#: With it Spark drops the shuffle files of a query when the query ends, and not when the driver collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A key value is hot when it has more rows than this; hot values are split over several tasks.
HOT_ROWS = 50_000


def session(app: str = "millrace", cores: str = "*", **conf: str) -> SparkSession:
    """A session with the defaults that the operators assume: UTC, AQE with skew joins, Arrow."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    made = builder.getOrCreate()
    ship(made)
    return made


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once for each context, for clusters where it isn't installed."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():
        folder = tempfile.mkdtemp(prefix="millrace-code-")  # read by the driver only, which serves it to executors
        archive = Path(folder) / "millrace.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(root.rglob("*.py")):
                z.write(file, file.relative_to(root.parent))
        context.addPyFile(str(archive))
    context._millrace_shipped = True


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """``query`` after the package has been sent."""

    @functools.wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship(spark)
        return query(spark, folder)

    return run


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for cut lineage: ``spark.checkpoint.dir``, or in local mode, where it may be unset, one of
    this session's own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = getattr(spark, "_millrace_scratch", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
            root = "file://" + tempfile.mkdtemp(prefix="millrace-")
            spark._millrace_scratch = root
            atexit.register(_delete_quietly, spark, root)
    return root


def _delete_quietly(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may be gone already
        pass


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return a frame that reads it (lineage ends there, and with it
    the shuffle files)."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/millrace/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    atexit.register(_delete_quietly, spark, path)
    out = spark.read.schema(df.schema).parquet(path)
    out._millrace_path = path
    return out


def unstash(*frames: DataFrame) -> None:
    """Delete stashed tables that no later plan reads."""
    for df in frames:
        if path := getattr(df, "_millrace_path", None):
            _delete_quietly(df.sparkSession, path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def bounded_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``rows`` rows, else unchanged (the join then shuffles)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def shuffle_tasks(spark: SparkSession, size: int) -> int:
    """Partitions for a shuffle of about ``size`` bytes: as configured, and more where they would grow too large."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))


def hot_values(counts: DataFrame, key: str, n: str, least: int | None = None) -> DataFrame | None:
    """(key, _slices): the hot key values with the number of slices each is cut into; None if there is none.

    A value with more than ``least`` rows (``HOT_ROWS``) is hot, or with more than a share of all rows where that is
    more: a task that holds less isn't the longest. So there are at most ``BROADCAST_ROWS`` hot values, at any size.
    """
    least = least or HOT_ROWS
    total = counts.agg(F.sum(n), F.max(n)).collect()[0]
    if not total[1] or total[1] <= least:
        return None
    least = max(least, -(-total[0] // BROADCAST_ROWS))
    return counts.where(F.col(n) > least).select(key, F.ceil(F.col(n) / least).cast("int").alias("_slices"))


def salted_join(big: DataFrame, small: DataFrame, key: str, salt_by: str, hot: DataFrame | None) -> DataFrame:
    """Inner join of ``big`` and ``small`` on ``key`` with the rows of the ``hot`` values spread over slices.

    ``salt_by`` names a column of ``big`` whose hash picks the slice; ``small`` is repeated per slice for hot
    values only, so nothing else grows. ``hot`` comes from ``hot_values``, which bounds it for its broadcast.
    """
    if hot is None:
        return big.join(small, key)
    slices = F.coalesce("_slices", F.lit(1))
    big, small = (side.join(F.broadcast(hot), key, "left") for side in (big, small))
    left = big.withColumn("_salt", F.pmod(F.xxhash64(salt_by), slices).cast("int"))
    right = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
    return left.drop("_slices").join(right.drop("_slices"), [key, "_salt"]).drop("_salt")
