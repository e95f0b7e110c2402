"""Grouped temporal split: rows linked through any of several group keys stay together, groups are cut by time.

Groups are the components over the keys; they are ordered by their least time, then by their least row, and placed by
the midpoint of their share of the rows. With three groups or more the first is train and the last test, and if no
group falls to validation, the inner group whose index is nearest to the train ratio is taken.

Defined results: null and empty keys link nothing; null times come first; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.components import connected_components
from millrace.operators.ordering import running_total
from millrace.runtime import hot_values, salted_join, stash


def link_groups(df: DataFrame, row: str, keys: list[str]) -> DataFrame:
    """(row, group): the group is the least row among those linked by equal values of any of ``keys``."""
    edges = None
    for name in keys:
        has = F.col(name).isNotNull() & (F.col(name).cast("string") != "")
        first = stash(df.where(has).groupBy(name).agg(F.min(row).alias("v"), F.count(F.lit(1)).alias("_n")), "firsts")
        part = salted_join(df.where(has).select(F.col(row).alias("u"), name), first.drop("_n"), name, "u", hot_values(first, name, "_n")).select("u", "v")
        edges = part if edges is None else edges.unionByName(part)
    found = connected_components(edges.where("u <> v"))
    out = df.select(F.col(row).alias("node")).join(found, "node", "left")
    return out.select(F.col("node").alias(row), F.coalesce("component", "node").alias("group"))


def grouped_temporal_split(df: DataFrame, row: str, time: str, keys: list[str], ratios: tuple[float, float, float] = (0.8, 0.1, 0.1)) -> DataFrame:
    """(row, group, split) for every row; ``row`` must be unique."""
    if abs(sum(ratios) - 1) > 1e-9 or min(ratios) < 0:
        raise ValueError("ratios must be non-negative and sum to 1")
    member = stash(link_groups(df, row, keys), "groups")
    times = df.select(row, F.col(time).alias("_at"))
    groups = member.join(times, row).groupBy("group").agg(F.min("_at").alias("at"), F.count(F.lit(1)).alias("n"))
    groups = groups.withColumn("one", F.lit(1).cast("bigint"))
    ranked = running_total(groups, ["at", "group"], "n", "before")
    ranked = running_total(ranked, ["at", "group"], "one", "index")
    ranked = stash(ranked, "ranked")
    n_groups, total = ranked.count(), member.count()
    middle = (F.col("before") + F.col("n") / 2) / max(total, 1)
    split = F.when(middle < ratios[0], "train").when(middle < ratios[0] + ratios[1], "validation").otherwise("test")
    if n_groups >= 3:
        split = F.when(F.col("index") == 0, "train").when(F.col("index") == n_groups - 1, "test").otherwise(split)
    out = ranked.select("group", "index", split.alias("split"))
    if n_groups >= 3 and out.where("split = 'validation'").isEmpty():
        wanted = _nearest(n_groups, ratios[0])
        out = out.withColumn("split", F.when(F.col("index") == wanted, "validation").otherwise(F.col("split")))
    return member.join(out.drop("index"), "group").select(row, "group", "split")


def _nearest(n: int, ratio: float) -> int:
    """Inner index nearest to ``ratio`` of the way, the smaller of equals."""
    low = min(max(int(ratio * (n - 1)), 1), n - 2)
    return min((i for i in (low - 1, low, low + 1) if 1 <= i <= n - 2), key=lambda i: (abs(i / (n - 1) - ratio), i))


def leaking_groups(df: DataFrame, keys: list[str], split: str = "split") -> DataFrame:
    """(field, value, n_splits) of every key value found in more than one split; empty means no leakage."""
    out = None
    for name in keys:
        value = F.col(name).cast("string")
        part = df.where(value.isNotNull() & (value != "")).groupBy(value.alias("value")).agg(F.count_distinct(split).alias("n_splits"))
        part = part.where("n_splits > 1").select(F.lit(name).alias("field"), "value", "n_splits")
        out = part if out is None else out.unionByName(part)
    return out
