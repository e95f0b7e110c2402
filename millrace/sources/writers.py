"""Sinks: JSON lines in a fixed order, layered publication that becomes visible at once, hashes of what was written.

Defined results: nothing is ever overwritten; an empty split still writes its (empty) file; a publication whose target
exists or isn't empty is refused; the manifest is written last, so its presence marks a complete publication.
"""

from __future__ import annotations

import hashlib
import json
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.runtime import stash
from millrace.sources.errors import DataError

SPLITS = ("train", "validation", "test")
#: Hashes that are hashed together, files copied at a time, and the bytes from which a file isn't read as one row.
FAN, COPIES, ROW_BYTES = 65_536, 16, 1 << 30


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def as_json(df: DataFrame) -> DataFrame:
    """One column ``value``: every row as JSON with its fields in alphabetical order, nulls included."""
    fields = F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias("value"))


def write_json_lines(df: DataFrame, path: str, order: list[str], single: bool = False) -> None:
    """JSON lines in ``order``: files written in parallel, each a range of the order. ``single`` gives one file, through
    one task, for small results that are read by hand."""
    fs, target = _fs(df.sparkSession, path)
    if fs.exists(target):
        raise DataError(f"there is something at {path} already")
    ordered = df.orderBy(*order)
    rows = as_json(ordered)
    (rows.coalesce(1) if single else rows).write.mode("errorifexists").text(path)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file in one go: written beside its place, then renamed."""
    fs, target = _fs(spark, path)
    if fs.exists(target):
        raise DataError(f"there is something at {path} already")
    temporary = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + ".tmp")
    out = fs.create(temporary, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(temporary, target):
        raise DataError(f"cannot rename into place: {path}")


def write_json(spark: SparkSession, path: str, value: object) -> None:
    write_text(spark, path, json.dumps(value, ensure_ascii=False, sort_keys=True, indent=2) + "\n")


def canonical_hash(value: object) -> str:
    """SHA-256 of compact JSON with sorted keys."""
    return hashlib.sha256(json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def file_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of one file, read as a stream of blocks by the driver."""
    fs, target = _fs(spark, path)
    digest = spark.sparkContext._jvm.org.apache.commons.codec.digest.DigestUtils
    stream = fs.open(target)
    try:
        return digest.sha256Hex(stream)
    finally:
        stream.close()


def rows_hash(df: DataFrame, order: str) -> str:
    """SHA-256 tree over all rows by their unique number ``order``, computed in tasks: rows are hashed, then the hashes
    of each ``FAN`` neighbours in their order, until one level fits one call."""
    fields = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(df.columns)]), {"ignoreNullFields": "false"})
    level = df.select(F.col(order).cast("bigint").alias("i"), F.sha2(fields, 256).alias("h"))
    while True:
        groups = level.groupBy(F.floor(F.col("i") / FAN).alias("i")).agg(F.array_sort(F.collect_list(F.struct("i", "h"))).alias("l"))
        level = stash(groups.select("i", F.sha2(F.array_join(F.transform("l", lambda x: x["h"]), ""), 256).alias("h")), "hashes")
        if level.count() <= FAN:
            break
    return hashlib.sha256("".join(r.h for r in level.orderBy("i").collect()).encode()).hexdigest()


def artifact_hashes(spark: SparkSession, root: str) -> dict[str, str]:
    """SHA-256 of every file under ``root`` but manifests and markers, by relative path; files are hashed in parallel.

    A file too large for one row is read by the driver as a stream.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rows = files.where(F.col("length") < ROW_BYTES).select("path", F.sha2("content", 256).alias("h")).collect()  # a row for each file
    hashes = {r.path: r.h for r in rows}
    hashes |= {r.path: file_hash(spark, r.path) for r in files.where(F.col("length") >= ROW_BYTES).select("path").collect()}
    base = root.split("://")[-1].removeprefix("file:").rstrip("/")
    out = {path.split(base, 1)[-1].lstrip("/"): h for path, h in hashes.items()}
    return {k: v for k, v in sorted(out.items()) if k.rsplit("/", 1)[-1][0] not in "._" and not k.endswith("manifest.json")}


def publish_layers(spark: SparkSession, target: str, layers: dict[str, tuple[DataFrame, list[str]]], manifest: dict, single: bool = False) -> dict:
    """Write all layers (name -> frame and order) beside ``target``, the manifest last, then rename the folder."""
    fs, place = _fs(spark, target)
    if fs.exists(place):
        raise DataError(f"there is something at {target} already")
    staging = target.rstrip("/") + ".staging"
    stage_fs, stage = _fs(spark, staging)
    stage_fs.delete(stage, True)
    for name, (df, order) in layers.items():
        write_json_lines(df, f"{staging}/{name}", order, single)
    manifest = manifest | {"artifacts": artifact_hashes(spark, staging)}
    write_json(spark, f"{staging}/manifest.json", manifest)
    parent = place.getParent()
    if parent is not None:
        fs.mkdirs(parent)
    if not fs.rename(stage, place):
        raise DataError(f"cannot rename into place: {target}")
    return manifest


def write_splits(df: DataFrame, root: str, order: list[str], split: str = "split") -> None:
    """A folder of JSON lines for each split, also for an empty one."""
    for name in SPLITS:
        write_json_lines(df.where(F.col(split) == name).drop(split), f"{root}/{name}", order)


def parse_store_uri(uri: str, schemes: tuple[str, ...] = ("s3", "s3a", "file", "hdfs")) -> tuple[str, str, str]:
    """(scheme, bucket or host, prefix) of a target; an error for anything else, also for a prefix that is empty or has
    empty, ``.`` or ``..`` segments."""
    parts = urlparse(uri)
    segments = parts.path.strip("/").split("/")
    if parts.scheme not in schemes or (parts.scheme.startswith("s3") and not parts.netloc) or {"", ".", ".."} & set(segments):
        raise DataError(f"not a supported target: {uri}")
    return parts.scheme, parts.netloc, parts.path.strip("/")


def copy_publication(spark: SparkSession, source: str, target: str) -> list[str]:
    """Copy a published folder to an empty prefix of another store, the manifest last. Returns the copied paths.

    Object stores are asked to encrypt what is written. ``COPIES`` files are under way at a time.
    """
    if parse_store_uri(target)[0].startswith("s3"):
        spark.sparkContext._jsc.hadoopConfiguration().set("fs.s3a.encryption.algorithm", "AES256")
    src_fs, src = _fs(spark, source)
    dst_fs, dst = _fs(spark, target)
    if dst_fs.exists(dst) and len(dst_fs.listStatus(dst)):
        raise DataError(f"target prefix is not empty: {target}")
    names, walk = [], src_fs.listFiles(src, True)
    base = src_fs.makeQualified(src).toUri().getPath()
    while walk.hasNext():
        names.append(walk.next().getPath().toUri().getPath()[len(base) :].lstrip("/"))
    names.sort(key=lambda n: (n == "manifest.json", n))
    if "manifest.json" not in names:
        raise DataError(f"no manifest in {source}")
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path

    def copy(name: str) -> None:
        jvm.org.apache.hadoop.fs.FileUtil.copy(src_fs, path(f"{source}/{name}"), dst_fs, path(f"{target}/{name}"), False, conf)

    with ThreadPoolExecutor(COPIES) as pool:
        list(pool.map(copy, names[:-1]))
    copy(names[-1])
    return names


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, by: list[str] | None = None) -> None:
    """The native layer: compressed Parquet, one folder for each value of ``by``."""
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
