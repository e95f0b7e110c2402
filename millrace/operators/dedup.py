"""Exact duplicates by token fingerprint, near-duplicate clusters by exact Jaccard similarity, and cluster caps.

Near pairs come from an inverted index of hashed shingles restricted to prefixes: with the shingles of a text ordered
by document frequency, two texts of similarity J or more share one of the first ``n - ceil(J * n) + 1``. The candidates
are verified on whole shingle sets, so the result is that of comparing all pairs. ``lsh_pairs`` is the approximate
mode by banded min-hash, for corpora where that is wanted; its candidates are verified in the same way.

Defined results: null texts are left out; texts without tokens share the empty fingerprint; texts shorter than a
shingle are one shingle; equal positions are ordered by key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import bind, fingerprint, ngrams, tokens
from millrace.operators.components import connected_components
from millrace.runtime import hot_values, salted_join, stash

# The usual settings of the near-duplicate stage.
SHINGLE, SIMILARITY, PERMUTATIONS, BANDS, CLUSTER_CAP = 3, 0.72, 64, 16, 3


def exact_duplicates(df: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """(key, duplicate_of) for every row with a text: null for the first of a fingerprint in ``order``.

    The fingerprint's first row comes from a partial aggregate and a join, so a fingerprint with a large share of the
    rows is neither sorted nor joined in one task.
    """
    rows = df.where(F.col(text).isNotNull()).select(
        F.col(key).alias("_k"), F.col(order).alias("_o"), F.unhex(F.md5(fingerprint(F.col(text)))).alias("_f")
    )
    firsts = stash(rows.groupBy("_f").agg(F.min(F.struct("_o", "_k")).alias("_first"), F.count(F.lit(1)).alias("_n")), "firsts")
    out = salted_join(rows, firsts.drop("_n"), "_f", "_k", hot_values(firsts, "_f", "_n"))
    first = (F.col("_o") == F.col("_first._o")) & (F.col("_k") == F.col("_first._k"))
    return out.select(F.col("_k").alias(key), F.when(~first, F.col("_first._k")).alias("duplicate_of"))


def shingles(text: Column, n: int = SHINGLE) -> Column:
    def sets(t: Column) -> Column:
        short = F.array(F.when(F.size(t) > 0, F.array_join(t, " ")).otherwise("<EMPTY>"))
        return F.array_distinct(F.when(F.size(t) >= n, ngrams(t, n)).otherwise(short))

    return bind(tokens(text), sets)


def _hashed(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    rows = df.where(F.col(text).isNotNull()).select(F.col(key).alias("k"), shingles(F.col(text), n).alias("_s"))
    return rows.select("k", F.array_sort(F.array_distinct(F.transform("_s", lambda s: F.xxhash64(s)))).alias("s"))


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    a = sets.select(F.col("k").alias("a"), F.col("s").alias("sa"))
    b = sets.select(F.col("k").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(a, "a").join(b, "b").withColumn("shared", F.size(F.array_intersect("sa", "sb")).cast("bigint"))
    either = F.size("sa") + F.size("sb") - F.col("shared")
    return both.select("a", "b", "shared", either.alias("either")).where(F.col("shared") >= F.lit(threshold) * F.col("either"))


def near_pairs(df: DataFrame, key: str, text: str = "text", n: int = SHINGLE, threshold: float = SIMILARITY) -> DataFrame:
    """(a, b, shared, either) with a < b for every two rows of Jaccard similarity ``threshold`` or more."""
    return _near_pairs(stash(_hashed(df, key, text, n), "shingles"), threshold)


def _near_pairs(sets: DataFrame, threshold: float) -> DataFrame:
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    each = sets.select("k", F.size("s").alias("n"), F.explode("s").alias("h"))
    often = stash(each.groupBy("h").agg(F.count(F.lit(1)).alias("d")).where("d > 1"), "often")
    hot = hot_values(often, "h", "d")
    # Shingles of one text only can't be shared; their number still counts for the place in the order.
    met = salted_join(each, often, "h", "k", hot)
    alone = F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("k"))
    place = F.row_number().over(Window.partitionBy("k").orderBy("d", "h")) + alone
    prefix = met.withColumn("_p", place).where(F.col("_p") <= F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - 1e-9) + 1)
    a = prefix.select("h", F.col("k").alias("a"), F.col("n").alias("na"))
    b = prefix.select("h", F.col("k").alias("b"), F.col("n").alias("nb"))
    sized = F.least("na", "nb") >= F.lit(threshold) * F.greatest("na", "nb") - 1e-9
    pairs = salted_join(a, b, "h", "a", hot).where((F.col("a") < F.col("b")) & sized).select("a", "b").distinct()
    return _verified(pairs, sets, threshold)


def minhash(sets: Column, permutations: int = PERMUTATIONS) -> Column:
    """Signature: for every permutation the least hash over the set."""
    return F.array(*[F.array_min(F.transform(sets, lambda x: F.xxhash64(F.lit(p), x))) for p in range(permutations)])


def lsh_pairs(
    df: DataFrame,
    key: str,
    text: str = "text",
    n: int = SHINGLE,
    threshold: float = SIMILARITY,
    permutations: int = PERMUTATIONS,
    bands: int = BANDS,
) -> DataFrame:
    """As ``near_pairs``, but only pairs that share a band of their min-hash signatures are compared.

    A pair of similarity J is met with probability 1 - (1 - J ** r) ** bands, r the rows of a band.
    """
    return _lsh_pairs(stash(_hashed(df, key, text, n), "shingles"), threshold, permutations, bands)


def _lsh_pairs(sets: DataFrame, threshold: float, permutations: int = PERMUTATIONS, bands: int = BANDS) -> DataFrame:
    if permutations <= 0 or bands <= 0 or permutations % bands:
        raise ValueError("permutations must be positive and divisible by bands")
    rows = permutations // bands
    signed = sets.select("k", minhash(F.col("s"), permutations).alias("m"))
    band = F.explode(F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), lambda i: F.xxhash64(i, F.slice("m", i * rows + 1, rows))))
    keys = signed.select("k", band.alias("h"))
    pairs = keys.withColumnRenamed("k", "a").join(keys.withColumnRenamed("k", "b"), "h").where("a < b").select("a", "b").distinct()
    return _verified(pairs, sets, threshold)


def near_clusters(df: DataFrame, key: str, text: str = "text", n: int = SHINGLE, threshold: float = SIMILARITY, mode: str = "exact") -> DataFrame:
    """(key, cluster_id, cluster_size) for every row with a text: single-linkage clusters of near pairs.

    The id is the start of the SHA-256 of the sorted members' keys. Rows with the same shingles are one from the start;
    only the first of them is compared with others.
    """
    same = F.unhex(F.md5(F.array_join(F.transform("s", lambda h: h.cast("string")), ",")))
    sets = stash(_hashed(df, key, text, n).withColumn("f", same), "shingles")
    firsts = stash(sets.groupBy("f").agg(F.min("k").alias("first"), F.count(F.lit(1)).alias("m"), F.first("s").alias("s")), "firsts")
    pairs = (_near_pairs if mode == "exact" else _lsh_pairs)(firsts.select(F.col("first").alias("k"), "s"), threshold)
    alike = salted_join(sets.select("k", "f"), firsts.where("m > 1").select("f", "first"), "f", "k", hot_values(firsts, "f", "m"))
    edges = pairs.select("a", "b").unionByName(alike.where("k <> first").select(F.col("first").alias("a"), F.col("k").alias("b")))
    found = connected_components(edges, "a", "b").withColumnRenamed("node", "k")
    rows = sets.select("k").distinct()
    rows = rows.join(found, "k", "left").select("k", F.coalesce("component", "k").alias("c"))
    names = rows.groupBy("c").agg(
        F.array_sort(F.collect_list(F.col("k").cast("string"))).alias("ids"), F.count(F.lit(1)).alias("cluster_size")
    )
    name = F.substring(F.sha2(F.array_join("ids", "\x00"), 256), 1, 16)
    return rows.join(names.select("c", name.alias("cluster_id"), "cluster_size"), "c").select(F.col("k").alias(key), "cluster_id", "cluster_size")


def clusters_with_copies(df: DataFrame, key: str, order: str, text: str = "text") -> DataFrame:
    """(key, cluster_id) for every row with a text: ``near_clusters`` of the first rows of each fingerprint, whose
    cluster holds for their exact copies, too. Copies are never compared in pairs."""
    copies = stash(exact_duplicates(df, key, order, text).withColumn("_first", F.coalesce("duplicate_of", key)), "copies")
    unique = df.join(copies.where("duplicate_of is null").select(key), key, "left_semi")
    named = stash(near_clusters(unique, key, text).select(F.col(key).alias("_first"), "cluster_id"), "clusters")
    counts = copies.groupBy("_first").agg(F.count(F.lit(1)).alias("n"))
    return salted_join(copies.select(key, "_first"), named, "_first", key, hot_values(counts, "_first", "n")).select(key, "cluster_id")


def cap_clusters(df: DataFrame, key: str, order: str, cap: int = CLUSTER_CAP) -> DataFrame:
    """``df`` (with cluster_id and cluster_size) plus ``kept``: evenly spaced members in ``order``, at most ``cap``.

    The places are rounded half to even. A rank is only taken in clusters larger than the cap.
    """
    if cap < 1:
        raise ValueError("cap must be at least 1")
    small = df.where(F.col("cluster_size") <= cap).withColumn("kept", F.lit(True))
    place = F.row_number().over(Window.partitionBy("cluster_id").orderBy(order, key)) - 1
    large = df.where(F.col("cluster_size") > cap).withColumn("_p", place)
    if cap == 1:
        keep = F.col("_p") == 0
    else:
        spots = F.transform(F.sequence(F.lit(0), F.lit(cap - 1)), lambda i: F.bround(i * (F.col("cluster_size") - 1) / (cap - 1)).cast("int"))
        keep = F.array_contains(spots, F.col("_p"))
    return small.unionByName(large.withColumn("kept", keep).drop("_p"))
