"""Filters that name the first rule a row fails, and ordered pattern rules.

Defined results: null text counts as too short; empty allow-lists allow everything; a row that fails nothing has a null
reason. Rules look at whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import is_link_only, strip


def reject_reason(
    languages: list[str] = (),
    authors: list[str] = (),
    references: list[str] = (),
    least_chars: int = 5,
    text: str = "text_train",
    raw: str = "text_raw",
) -> Column:
    """First failing rule in the order language, author, reference type, length, link only; null if none."""
    found = F.array_min(F.array_intersect("reference_types", F.array(*[F.lit(r.lower()) for r in references]).cast("array<string>")))
    never = F.lit(False)
    lang = ~F.coalesce(F.col("lang").isin(*[x.lower() for x in languages]), F.lit(False)) if languages else never
    author = ~F.coalesce(F.col("author_id").isin(*authors), F.lit(False)) if authors else never
    return (
        F.when(lang, F.concat(F.lit("language_not_allowed:"), F.coalesce("lang", F.lit(""))))
        .when(author, F.concat(F.lit("author_not_allowed:"), F.coalesce("author_id", F.lit(""))))
        .when(found.isNotNull(), F.concat(F.lit("reference_type_excluded:"), found))
        .when(F.coalesce(F.length(strip(F.col(text))), F.lit(0)) < least_chars, "text_too_short")
        .when(is_link_only(F.col(raw)), "link_only")
    )


def split_by_reason(df: DataFrame, reason: str = "reason") -> tuple[DataFrame, DataFrame]:
    """(kept without the column, rejected with it)."""
    return df.where(F.col(reason).isNull()).drop(reason), df.where(F.col(reason).isNotNull())


def first_rule(text: Column, rules: dict[str, str]) -> Column:
    """Name of the first pattern that is found in ``text``, null for none. Works on static and streaming frames."""
    out = None
    for name, pattern in rules.items():
        test = F.rlike(text, F.lit(pattern))
        out = F.when(test, name) if out is None else out.when(test, name)
    return out if out is not None else F.lit(None).cast("string")


def all_failures(checks: dict[str, Column]) -> Column:
    """Names of all checks that aren't true, in order: a gate that reports everything at once."""
    return F.array_compact(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in checks.items()]))


def request_failures(lengths: dict[str, tuple[int, int]], allowed: dict[str, list[str]]) -> Column:
    """Names of the columns whose length is out of bounds or whose value isn't among the allowed ones, in order."""
    checks = {c: F.length(F.coalesce(F.col(c), F.lit(""))).between(*b) for c, b in lengths.items()}
    return all_failures(checks | {c: F.col(c).isin(*values) for c, values in allowed.items()})


def sample_size(n: Column, least: int = 500, share: float = 0.10) -> Column:
    """Rows to look at by hand: a share of ``n``, at least ``least``, at most all."""
    return F.least(n, F.greatest(F.lit(least), F.ceil(n * F.lit(share)))).cast("bigint")


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """(stage, n) of several frames."""
    out = None
    for name, df in stages.items():
        part = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("stage"), "n")
        out = part if out is None else out.unionByName(part)
    return out
