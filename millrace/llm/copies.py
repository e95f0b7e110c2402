"""Copies hidden by formatting: one row of each text, with the number of its copies.

Method: hashing of nested records from the leaves up, as in a Merkle tree. A text made of labelled fields is an
unordered node with a child for each field, whose digest is taken over the normalised ``label value``; the children's
digests are sorted before the node is hashed, so the order of the fields is lost. Any other text is a single leaf. A
leaf keeps only the letters and digits of the case-folded text. Rows are grouped by root digest; the groups found are
confirmed on the whole normal form, so an accidental equality of digests can't join two texts. A text without fields
that runs exactly like one with fields joins its group.

Defined results: null texts and texts with fewer than ``LEAST`` letters and digits are in no group (each stands for
itself); ties and repeated rows fall to the smallest key; an empty table gives an empty result; other columns are
never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import alnum
from millrace.operators.components import connected_components
from millrace.runtime import hot_values, salted_join, stash, unstash

#: Letters and digits that a text must have to count as a copy of another.
LEAST = 40
# What parts fields, and what a field looks like.
PART, FIELD = r"\s*[|;\r\n]+\s*", r"^\s*[\p{L}\p{N}_]+\s*:"


def fields(text: Column) -> Column:
    """The fields of a text made of nothing but labelled fields (two or more), else null."""
    parts = F.filter(F.split(text, PART), lambda p: F.length(p) > 0)
    return F.when(
        F.rlike(text, F.lit(FIELD)) & (F.size(parts) >= 2) & F.forall(parts, lambda p: F.rlike(p, F.lit(FIELD))), parts
    )


def leaf(text: Column) -> Column:
    return alnum(text)


def node(children: Column) -> Column:
    """Digest (128 bits) of an unordered node from its children's digests."""
    return F.unhex(F.md5(F.array_join(F.array_sort(children), "")))


def canonical_columns(text: str = "text") -> dict[str, Column]:
    """Normal forms of a text: ``_plain`` without regard to fields; ``_fields`` the normalised fields in order."""
    parts = fields(F.col(text))
    return {"_plain": leaf(F.col(text)), "_fields": F.array_sort(F.transform(parts, leaf))}


def digest_columns() -> dict[str, Column]:
    """``_flat`` and ``_tree``: digests of the forms made by ``canonical_columns``; ``_tree`` null without fields."""
    return {
        "_flat": F.unhex(F.md5("_plain")),
        "_tree": F.when(F.col("_fields").isNotNull(), node(F.transform("_fields", lambda p: F.md5(p)))),
    }


def copy_groups(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(keep_row, copy_row, n_copies): every row of a group of two or more, also the kept one, with the group's size.

    For all rows only digests are shuffled, after partial aggregation; normal forms travel for rows of groups of two
    or more. A flat digest with a large share of the rows is joined in slices.
    """
    base = rows.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_key is not null and _text is not null")
    base = base.withColumns(canonical_columns("_text")).where(F.length("_plain") >= LEAST)
    base = base.withColumns(digest_columns())
    cuts = stash(base.groupBy("_flat", "_tree").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("first")), "cuts")
    flats = cuts.groupBy("_flat").agg(F.sum("n").alias("n"), F.min("first").alias("first"), F.min("_tree").alias("tree"), F.max("_tree").alias("tree2"))
    # Orders of the same fields have different flat digests and one tree digest; texts that run alike but are cut into
    # fields in several ways share the flat digest. A group is a component over these links, however long the chain.
    edges = cuts.join(flats.where("tree <> tree2").select("_flat", "tree"), "_flat").where("_tree is not null")
    roots = connected_components(edges, "tree", "_tree")
    rooted = flats.join(roots.select(F.col("node").alias("tree"), F.col("component").alias("root")), "tree", "left")
    rooted = rooted.select("_flat", "n", "first", F.coalesce("root", "tree", "_flat").alias("root"))
    groups = rooted.groupBy("root").agg(F.sum("n").alias("n_copies"), F.min("first").alias("keep_row"))
    groups = groups.where("n_copies > 1")
    wanted = stash(rooted.join(groups, "root").select("_flat", "n", "root", "keep_row", "n_copies"), "groups")
    unstash(cuts)
    hot = hot_values(wanted, "_flat", "n")
    members = salted_join(base.select("_key", "_flat", "_tree", "_plain", "_fields"), wanted, "_flat", "_key", hot)
    members = stash(members, "members")
    # Full comparison of what the digests found equal.
    same_flat = members.groupBy("_flat").agg((F.min("_plain") == F.max("_plain")).alias("ok"))
    form = F.array_join("_fields", "\x1f")
    same_tree = members.where("_tree is not null").groupBy("_tree").agg((F.min(form) == F.max(form)).alias("ok"))
    if not same_flat.select("ok").unionByName(same_tree.select("ok")).where("not ok").isEmpty():
        raise RuntimeError("two different texts have one digest")
    return members.select("keep_row", F.col("_key").alias("copy_row"), "n_copies")


def collapse_copies(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(keep_row, n_copies) of every row that remains; rows in no group remain with one copy."""
    groups = copy_groups(rows, key, text)
    alone = rows.select(F.col(key).alias("keep_row")).where("keep_row is not null")
    alone = alone.join(groups.select(F.col("copy_row").alias("keep_row")), "keep_row", "left_anti")
    kept = groups.where("keep_row = copy_row").select("keep_row", "n_copies")
    return kept.unionByName(alone.select("keep_row", F.lit(1).cast("bigint").alias("n_copies")))


def found_copies(posts: DataFrame) -> DataFrame:
    return copy_groups(posts, "source_row").where("keep_row <> copy_row").select("keep_row", "copy_row")
