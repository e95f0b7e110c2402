"""Filling containers of a fixed capacity with documents measured in tokens.

Method: large-item matching on the histogram of sizes. Documents above the capacity are cut into full containers and
a rest; nothing else is ever cut. Items above half the capacity open a container each and take the largest item above
a third that fits; the other items above a third are matched in pairs, so no container holds more than two of these.
Items up to a third then go into the smallest remaining gap that takes them (best fit), largest first.

The plan is made on counts by size, at most one for each size up to the capacity, so its cost doesn't depend on the
number of documents: a group of containers with equal contents is one entry. Documents find their place by their rank
among the documents of their size, counted in slices of each size, so no size is ordered in one task.

Defined results: documents without tokens (null and empty texts) get a row with a null container; ties between
documents of a size are broken by key; capacities that are null or below one are left out, of several for one kind the
least holds; repeated keys are packed as separate items in any order.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.tokenization import count_tokens
from millrace.runtime import bounded_broadcast, stash

#: Items of a size in one slice when they are ranked.
SLICE = 200_000
#: Kinds of containers that one call packs; more are refused, none is left out.
MOST_KINDS = 1000
#: Rows of a plan that are broadcast; beyond, the plan is joined by a shuffle on the size.
PLAN_ROWS = 200_000


def plan_packing(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Rows (size, first rank, end rank, first container, items in each container), and the number of containers.

    Item number r of a size (first rank <= r < end rank) goes into container first + (r - first rank) // items.
    """
    left = {s: n for s, n in histogram.items() if 0 < s <= capacity and n > 0}
    rank = dict.fromkeys(left, 0)
    rows: list[tuple[int, int, int, int, int]] = []
    gaps: list[tuple[int, int, int]] = []  # (gap, first container, number of containers), ordered
    opened = 0

    def put(size: int, first: int, containers: int, each: int) -> None:
        rows.append((size, rank[size], rank[size] + containers * each, first, each))
        rank[size] += containers * each
        left[size] -= containers * each

    large = sorted((s for s in left if 2 * s > capacity), reverse=True)
    middle = sorted(s for s in left if 2 * s <= capacity and 3 * s > capacity)
    small = sorted((s for s in left if 3 * s <= capacity), reverse=True)
    for size in large:
        while left[size]:
            i = bisect_left(middle, capacity - size + 1) - 1
            while i >= 0 and not left[middle[i]]:
                middle.pop(i)
                i -= 1
            n = min(left[size], left[middle[i]]) if i >= 0 else left[size]
            put(size, opened, n, 1)
            if i >= 0:
                put(middle[i], opened, n, 1)
            gap = capacity - size - (middle[i] if i >= 0 else 0)
            if gap:
                insort(gaps, (gap, opened, n))
            opened += n
    carried = 0  # size of a middle item that waits for a partner
    for size in reversed(middle):
        if not left[size]:
            continue
        if carried:
            put(carried, opened, 1, 1)
            put(size, opened, 1, 1)
            if capacity - carried - size:
                insort(gaps, (capacity - carried - size, opened, 1))
            opened += 1
            carried = 0
        pairs = left[size] // 2
        if pairs:
            put(size, opened, pairs, 2)
            if capacity - 2 * size:
                insort(gaps, (capacity - 2 * size, opened, pairs))
            opened += pairs
        if left[size]:
            carried = size
    if carried:
        put(carried, opened, 1, 1)
        insort(gaps, (capacity - carried, opened, 1))
        opened += 1
    for size in small:
        while left[size]:
            i = bisect_left(gaps, (size, -1, -1))
            if i == len(gaps):
                each = capacity // size
                full = left[size] // each
                if full:
                    insort(gaps, (capacity, opened, full))
                    opened += full
                else:
                    insort(gaps, (capacity, opened, 1))
                    opened += 1
                continue
            gap, first, n = gaps.pop(i)
            each = min(gap // size, left[size])
            used = min(n, left[size] // each)
            put(size, first, used, each)
            if gap - each * size:
                insort(gaps, (gap - each * size, first, used))
            if n > used:
                insort(gaps, (gap, first + used, n - used))
    return rows, opened


def pack(sizes: DataFrame, containers: DataFrame, key: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """(container_kind, container_id, key, piece_no, first_token, n_tokens): where every piece of every item goes."""
    spark = sizes.sparkSession
    named = containers.where("container_kind is not null and capacity_tokens >= 1").groupBy("container_kind")
    rows = named.agg(F.min("capacity_tokens").alias("c")).limit(MOST_KINDS + 1).collect()
    if len(rows) > MOST_KINDS:
        raise ValueError(f"more than {MOST_KINDS} kinds of containers")
    kinds = {r.container_kind: int(r.c) for r in rows}
    schema = f"container_kind string, container_id bigint, `{key}` {dict(sizes.dtypes)[key]}, piece_no int, first_token int, n_tokens int"
    if not kinds:
        return spark.createDataFrame([], schema)
    base = stash(sizes.select(F.col(key).alias("_key"), F.coalesce(F.col(size), F.lit(0)).cast("int").alias("_n")), "sizes")
    kind = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(c).alias("c")) for k, c in kinds.items()]))
    items = base.withColumn("_kind", kind).select("_key", "_n", F.col("_kind.k").alias("container_kind"), F.col("_kind.c").alias("_cap"))
    items = items.withColumn("_full", F.floor(F.col("_n") / F.col("_cap")).cast("int")).withColumn("_rest", F.col("_n") % F.col("_cap"))
    counts = items.groupBy("container_kind", "_rest").agg(F.count(F.lit(1)).alias("n"), F.sum("_full").alias("full")).collect()

    plan, opened = [], {}
    for k, cap in kinds.items():
        rows, opened[k] = plan_packing({r["_rest"]: r["n"] for r in counts if r["container_kind"] == k}, cap)
        plan += [(k, *r) for r in rows]
    plan_df = spark.createDataFrame(plan, "container_kind string, _rest int, _from bigint, _to bigint, _first bigint, _each int")
    base_of = F.try_element_at(F.create_map(*[F.lit(x) for kv in opened.items() for x in kv]), F.col("container_kind")).cast("bigint")

    # Rank of a rest among the rests of its size: the rank in its slice, after the slices before.
    most = max([r["n"] for r in counts], default=1)
    slices = max(1, -(-most // SLICE))
    rests = items.where("_rest > 0").withColumn("_slice", F.pmod(F.xxhash64("_key"), F.lit(slices)).cast("int"))
    rests = rests.withColumn(
        "_in", F.row_number().over(Window.partitionBy("container_kind", "_rest", "_slice").orderBy("_key")) - 1
    )
    if slices > 1:
        per = items.where("_rest > 0").withColumn("_slice", F.pmod(F.xxhash64("_key"), F.lit(slices)).cast("int"))
        per = per.groupBy("container_kind", "_rest", "_slice").agg(F.count(F.lit(1)).alias("_c"))
        # One row for each size and slice: windows over a size hold as many rows as it has slices.
        before = F.sum("_c").over(Window.partitionBy("container_kind", "_rest").orderBy("_slice")) - F.col("_c")
        per = per.withColumn("_before", before).drop("_c")
        rests = rests.join(per, ["container_kind", "_rest", "_slice"]).withColumn("_rank", F.col("_in") + F.col("_before"))
    else:
        rests = rests.withColumn("_rank", F.col("_in").cast("bigint"))
    placed = rests.join(bounded_broadcast(plan_df, PLAN_ROWS), ["container_kind", "_rest"])
    placed = placed.where("_from <= _rank and _rank < _to").select(
        "container_kind",
        (F.col("_first") + F.floor((F.col("_rank") - F.col("_from")) / F.col("_each"))).cast("bigint").alias("container_id"),
        "_key",
        F.col("_full").alias("piece_no"),
        (F.col("_full") * F.col("_cap")).alias("first_token"),
        F.col("_rest").alias("n_tokens"),
    )
    # Full pieces have a container each; their numbers follow those of the plan, in the order of a sum over slices.
    cut = items.where("_full > 0").withColumn("_slice", F.pmod(F.xxhash64("_key", F.lit(7)), F.lit(_pieces(counts))).cast("int"))
    within = F.sum("_full").over(Window.partitionBy("container_kind", "_slice").orderBy("_key", "_n").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_full")
    per = cut.groupBy("container_kind", "_slice").agg(F.sum("_full").alias("_c"))
    per = per.withColumn("_before", F.sum("_c").over(Window.partitionBy("container_kind").orderBy("_slice")) - F.col("_c")).drop("_c")
    cut = cut.withColumn("_within", within).join(per, ["container_kind", "_slice"])
    cut = cut.withColumn("_piece", F.explode(F.sequence(F.lit(0), F.col("_full") - 1))).select(
        "container_kind",
        (base_of + F.col("_before") + F.col("_within") + F.col("_piece")).cast("bigint").alias("container_id"),
        "_key",
        F.col("_piece").cast("int").alias("piece_no"),
        (F.col("_piece") * F.col("_cap")).cast("int").alias("first_token"),
        F.col("_cap").cast("int").alias("n_tokens"),
    )
    nothing = items.where("_n = 0").select(
        "container_kind", F.lit(None).cast("bigint").alias("container_id"), "_key", F.lit(0).alias("piece_no"), F.lit(0).alias("first_token"), F.lit(0).alias("n_tokens")
    )
    out = placed.unionByName(cut).unionByName(nothing)
    return out.select("container_kind", "container_id", F.col("_key").alias(key), "piece_no", "first_token", "n_tokens")


def _pieces(counts: list) -> int:
    """Slices for the documents that are cut: about ``SLICE`` documents each."""
    return max(1, -(-sum(r["n"] for r in counts if r["full"]) // SLICE))


def pack_documents(documents: DataFrame, containers: DataFrame, vocabulary: str | None = None) -> DataFrame:
    return pack(count_tokens(documents, "doc_id", "text", vocabulary), containers)
