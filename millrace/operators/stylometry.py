"""Style features, corpus profiles and their distance; n-gram diversity.

Defined results: null texts are left out; a corpus without texts has a null profile, and its distance to any other is
infinity; distinct-n is 0 without any n-gram.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import WORD, bind, count_characters, count_matches, ngrams, tokens

# The features with the scale of their natural spread, and the cap of a scaled difference.
SCALES = {
    "characters": 100.0,
    "words": 20.0,
    "sentences": 3.0,
    "uppercase_ratio": 0.2,
    "exclamations_per_100_chars": 3.0,
    "questions_per_100_chars": 2.0,
    "hashtags_per_post": 1.0,
    "mentions_per_post": 1.0,
    "repeated_punctuation_per_post": 1.0,
}
MOST = 3.0


def style_features(text: Column) -> dict[str, Column]:
    length = F.length(text)
    cased = F.struct(count_characters(text, r"\p{L}").alias("letters"), count_characters(text, r"\p{Lu}").alias("upper"))
    ratio = bind(cased, lambda c: F.when(c["letters"] > 0, c["upper"] / F.greatest(c["letters"], F.lit(1))).otherwise(F.lit(0.0)))
    per_100 = lambda c: count_matches(text, c) * 100.0 / F.greatest(length, F.lit(1))
    return {
        "characters": length.cast("double"),
        "words": count_matches(text, rf"[{WORD}']+").cast("double"),
        "sentences": F.greatest(F.lit(1), count_matches(text, "[.!?]+")).cast("double"),
        "uppercase_ratio": ratio,
        "exclamations_per_100_chars": per_100("!"),
        "questions_per_100_chars": per_100("[?]"),
        "hashtags_per_post": count_matches(text, rf"(?<![{WORD}])#[{WORD}]+").cast("double"),
        "mentions_per_post": count_matches(text, rf"(?<![{WORD}])@[{WORD}]+").cast("double"),
        "repeated_punctuation_per_post": count_matches(text, r"([!?])\1+").cast("double"),
    }


def corpus_profile(df: DataFrame, text: str = "text", by: list[str] | None = None) -> DataFrame:
    """Mean of every feature, over the whole frame or by the columns ``by``: one pass of partial averages."""
    rows = df.where(F.col(text).isNotNull()).select(*(by or []), *[c.alias(n) for n, c in style_features(F.col(text)).items()])
    return rows.groupBy(*(by or [])).agg(*[F.avg(n).alias(n) for n in SCALES])


def profile_distance(candidate: DataFrame, reference: DataFrame) -> DataFrame:
    """One row with ``distance``: both sides are one-row profiles."""
    a = candidate.select(*[F.col(n).alias(f"a_{n}") for n in SCALES]).limit(1)
    b = reference.select(*[F.col(n).alias(f"b_{n}") for n in SCALES]).limit(1)
    apart = lambda n: F.abs(F.col(f"a_{n}") - F.col(f"b_{n}"))
    # least() would pass over the null of an empty corpus.
    parts = [F.when(apart(n).isNotNull(), F.least(F.lit(MOST), apart(n) / s)) for n, s in SCALES.items()]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    both = a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one")
    return both.select(F.coalesce(total / len(parts), F.lit(float("inf"))).alias("distance"))


def distinct_n(df: DataFrame, sizes: tuple[int, ...] = (2, 3), text: str = "text") -> DataFrame:
    """(n, n_total, n_distinct, ratio) for each n: n-grams are counted by their hash after partial aggregation."""
    toks = df.where(F.col(text).isNotNull()).select(tokens(F.col(text)).alias("_t"))
    each = None
    for n in sizes:
        part = toks.select(F.lit(n).alias("n"), F.explode(ngrams(F.col("_t"), n)).alias("_g"))
        each = part if each is None else each.unionByName(part)
    # Two 64-bit hashes stand for the n-gram, so the shuffle carries 16 bytes and no text.
    counted = each.groupBy("n", F.xxhash64("_g").alias("_h"), F.xxhash64(F.lit(1), "_g").alias("_i")).agg(F.count(F.lit(1)).alias("_c"))
    found = counted.groupBy("n").agg(F.sum("_c").alias("n_total"), F.count(F.lit(1)).alias("n_distinct"))
    wanted = df.sparkSession.createDataFrame([(n,) for n in sizes], "n int")
    out = wanted.join(F.broadcast(found), "n", "left").fillna(0, ["n_total", "n_distinct"])
    return out.withColumn("ratio", F.when(F.col("n_total") > 0, F.col("n_distinct") / F.col("n_total")).otherwise(F.lit(0.0)))
