"""Splits that keep related posts together.

Method: conversations are the nodes; a post delivered under several conversations and a reply to a post of another
conversation are the edges. Components come from the concurrent breadth-first search of ``operators.components``;
groups are then laid out by time (equal times by the group's hash) and cut at the wanted shares of the posts.

Defined results: a row without a conversation is its own conversation under its post's id; rows without a post id are
left out; replies to posts that never came link nothing; a group without any readable time counts as earliest; empty
tables give empty results; repeated deliveries of a post count once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.operators.components import connected_components
from millrace.operators.ordering import running_total
from millrace.operators.timestamps import normalise_timestamps
from millrace.runtime import stash

RATIOS = (0.8, 0.1, 0.1)


def grouped_posts(posts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct (post_id, conv) of all rows; and (conv, group, n_written) of the conversations.

    ``n_written`` is more than one where the group's rows name their conversation in more than one way.
    """
    written = F.coalesce("conversation_id", "post_id")
    rows = posts.where("post_id is not null").select(
        "post_id", written.alias("raw"), F.lower(strip(written)).alias("conv"), F.col("in_reply_to_post_id").alias("parent")
    )
    links = stash(rows.groupBy("post_id", "conv").agg(F.min("raw").alias("raw1"), F.max("raw").alias("raw2")), "links")
    convs = links.groupBy("conv").agg(F.min("raw1").alias("raw1"), F.max("raw2").alias("raw2"), F.min("post_id").alias("first"))
    home = links.groupBy("post_id").agg(F.min("conv").alias("home"), F.count(F.lit(1)).alias("n"))
    moved = links.join(home.where("n > 1"), "post_id").where("conv <> home").select(F.col("conv").alias("u"), F.col("home").alias("v"))
    # Replies of a conversation to one post are one edge, however many they are.
    replies = rows.where("parent is not null").select("conv", "parent").distinct()
    across = replies.join(home.select(F.col("post_id").alias("parent"), "home"), "parent")
    across = across.where("conv <> home").select(F.col("conv").alias("u"), F.col("home").alias("v"))
    components = connected_components(moved.unionByName(across).distinct())
    convs = convs.join(components.withColumnRenamed("node", "conv"), "conv", "left")
    convs = stash(convs.select("conv", "raw1", "raw2", "first", F.coalesce("component", "conv").alias("root")), "convs")
    groups = convs.groupBy("root").agg(
        F.min("first").alias("group_id"), (F.min("raw1") != F.max("raw2")).alias("several")
    )
    return links, convs.select("conv", "root").join(groups, "root").select("conv", "group_id", "several")


def found_groups(posts: DataFrame) -> DataFrame:
    """(group_id, post_id) of the groups with more than one conversation as written."""
    links, convs = grouped_posts(posts)
    return links.join(convs.where("several"), "conv").select("group_id", "post_id").distinct()


def assign_splits(posts: DataFrame, feeds: DataFrame, ratios: tuple[float, float, float] = RATIOS) -> DataFrame:
    """(post_id, group_id, split) for every post: earlier groups first, no group divided."""
    if abs(sum(ratios) - 1) > 1e-9 or min(ratios) < 0:
        raise ValueError("ratios must be non-negative and sum to 1")
    links, convs = grouped_posts(posts)
    member = stash(links.join(convs, "conv").groupBy("post_id").agg(F.min("group_id").alias("group_id")), "members")
    times = normalise_timestamps(posts.where("post_id is not null"), feeds, keep=("post_id",))
    times = times.groupBy("post_id").agg(F.min("utc_micros").alias("at"))
    groups = member.join(times, "post_id").groupBy("group_id").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("n"))
    groups = groups.withColumn("tie", F.md5("group_id"))
    total = member.count()
    groups = running_total(groups, ["at", "tie", "group_id"], "n", "before")
    middle = (F.col("before") + F.col("n") / 2) / F.lit(max(total, 1))
    split = F.when(middle < ratios[0], "train").when(middle < ratios[0] + ratios[1], "validation").otherwise("test")
    return member.join(groups.select("group_id", split.alias("split")), "group_id").select("post_id", "group_id", "split")
