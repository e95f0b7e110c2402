"""Long stretches of text that stand word for word in other records.

Method: recompression. A text starts as its tokens (a run of letters and digits with what follows it; single characters
where that is longer than a block). Rounds then
name runs of one symbol and pairs of neighbours: a pair is joined where the first symbol's coin of the round falls on
one side and the second's on the other, so equal substrings are parsed alike but for a symbol or so at their ends. A
name is a hash of what it stands for, hence global without any exchange between tasks; a pair that would become longer
than ``BLOCK`` characters is never joined. The last round's symbols are the blocks.

Blocks reveal repeats: a span of ``LEAST`` characters that holds a block reaches at least ``SIDE`` characters beyond
it on one side, so the block is named once more together with these characters on the left, and once with those on the
right; texts that share a span share one of both names. Names that a count sketch (about a cell for each name, up to a limit
from which all names are sent) has seen once are in no second text and aren't sent. Shared names of up to ``PAIRED``
texts are verified in pairs of texts on the diagonal that the names give, character by character; for a name in more
texts, every window of ``LEAST`` characters around it is grouped instead, so the work stays linear in the group. Windows
are equal if two hashes of different kinds are, 128 bits in all. Both ways give the same stretches.

A copied text is looked at once, whatever the number of its copies: whole texts found in two records, by a 128-bit
digest, are shared as a whole. Names and windows in a large share of the texts are counted and joined in slices. Nothing
is capped or sampled.

Defined results: null keys and texts give no row, nor do texts shorter than ``LEAST``; repeated deliveries of one
record aren't another record; touching spans are one stretch; positions count code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace import runtime
from millrace.llm.kernels import (
    BASE,
    alnum_table,
    binary16,
    code_points,
    count_sketch,
    digest_filter,
    field_hash,
    fresh_rows,
    mix,
    owners,
    prefix_sums,
    shared_table,
    sketch_cells,
    stretch_hash,
    text_digests,
    texts_of,
    total_length,
    value_table,
)
from millrace.runtime import bounded_broadcast, hot_values, salted_join, shuffle_tasks, stash, unstash

#: Characters of a span, the longest block and the rounds of naming.
LEAST, BLOCK, ROUNDS = 120, 32, 7
#: A span reaches this far beyond one of its blocks on the left or on the right.
SIDE = (LEAST - BLOCK + 1) // 2
#: Texts up to which the texts of a name are verified in pairs.
PAIRED = 48
#: From this code point on (scripts written without blanks) every character is a token.
IDEOGRAPHS = 0x2E80


def blocks(codes: np.ndarray, first: np.ndarray, longest: int = BLOCK, rounds: int = ROUNDS):
    """Start, end and text of every block, and the prefix sums of the batch."""
    sums = prefix_sums(value_table()[codes])
    inside = alnum_table()[codes]
    start = inside.copy()
    start[1:] &= ~inside[:-1] | (codes[1:] >= IDEOGRAPHS) | (codes[:-1] >= IDEOGRAPHS)
    start[first[:-1]] = True
    at = np.flatnonzero(start)
    size = np.diff(np.append(at, len(codes)))
    wide = np.flatnonzero(size > longest)
    if len(wide):
        # A token longer than a block (a long address, a row of dashes) is taken character by character.
        part = np.arange(int(size[wide].sum())) - np.repeat(np.cumsum(size[wide]) - size[wide], size[wide])
        start[np.repeat(at[wide], size[wide]) + part] = True
        at = np.flatnonzero(start)
    end = np.append(at[1:], len(codes))
    text = owners(first, at)
    # The line break that parts two texts belongs to none of them.
    end = np.where(end == first[text + 1], end - 1, end)
    empty = end <= at
    at, end, text = at[~empty], end[~empty], text[~empty]
    symbol = stretch_hash(sums, at, end)
    for r in range(rounds):
        n = len(symbol)
        if n < 2:
            break
        joined = text[1:] == text[:-1]
        if r == 0:
            # Runs of one symbol get one name, cut at the longest block.
            same = np.zeros(n, dtype=bool)
            same[1:] = joined & (symbol[1:] == symbol[:-1])
            if same.any():
                head = np.flatnonzero(~same)
                span = np.append(at[head[1:]], 0)
                size = end[np.append(head[1:], n) - 1] - at[head]
                fits = size <= longest
                keep = ~same
                keep |= ~np.repeat(fits, np.diff(np.append(head, n)))
                kept = np.flatnonzero(keep)
                last = np.append(kept[1:], n) - 1
                count = last - kept + 1
                symbol = np.where(count > 1, mix(symbol[kept] * np.uint64(BASE) + count.astype(np.uint64)), symbol[kept])
                at, end, text = at[kept], end[last], text[kept]
                del span
                n = len(symbol)
                joined = text[1:] == text[:-1]
        coin = (mix(symbol + np.uint64(7919 * r + 1)) >> np.uint64(40)) & np.uint64(1)
        pair = np.flatnonzero(joined & (coin[:-1] == 0) & (coin[1:] == 1) & (end[1:] - at[:-1] <= longest))
        symbol[pair] = mix(symbol[pair] * np.uint64(BASE) + mix(symbol[pair + 1] + np.uint64(r)))
        end[pair] = end[pair + 1]
        keep = np.ones(n, dtype=bool)
        keep[pair + 1] = False
        symbol, at, end, text = symbol[keep], at[keep], end[keep], text[keep]
    return at, end, text, sums


def names(texts: list[str], want: np.ndarray | None = None):
    """(name, text, position in the text, length) of all block names of the texts that are long enough."""
    codes, first = code_points(texts)
    at, end, text, sums = blocks(codes, first)
    lo, hi = first[text], first[text + 1] - 1
    long = hi - lo >= LEAST
    if want is not None:
        long &= want[text]
    left, right = long & (at - SIDE >= lo), long & (end + SIDE <= hi)
    start = np.concatenate([at[left] - SIDE, at[right]])
    stop = np.concatenate([end[left], end[right] + SIDE])
    owner = np.concatenate([text[left], text[right]])
    side = np.concatenate([np.zeros(left.sum(), np.uint64), np.ones(right.sum(), np.uint64)])
    name = mix(stretch_hash(sums, start, stop) + side) if len(start) else np.zeros(0, np.uint64)
    return name, owner, start - first[owner], stop - start


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _shared_names(posts: DataFrame) -> DataFrame:
    """(k, c, p, l, m): names k found in m > 1 texts c, with position and length."""
    spark = posts.sparkSession
    column = posts.select("_text")
    length = total_length(column, "_text")
    cells = sketch_cells(length // 6)
    sketch = shared_table(spark, count_sketch(column, lambda b: names(texts_of(b.column(0)))[0], cells)) if cells else None
    hot = runtime.HOT_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = sketch() if sketch else None, set()
        for batch in batches:
            texts = texts_of(batch.column(0))
            c = text_digests(texts)
            name, owner, at, size = names(texts, fresh_rows(c, seen, np.ones(len(texts), dtype=bool)))  # a text once from each task
            slices = np.ones(len(name), dtype=np.uint64)
            if table is not None:
                level = table[(name & np.uint64(len(table) - 1)).astype(np.int64)]
                keep = level > 1
                name, owner, at, size = name[keep], owner[keep], at[keep], size[keep]
                slices = np.ceil(np.exp2((level[keep] - 1.0) / 8) / hot).astype(np.uint64)
            salt = (c[owner, 0] % slices).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [_signed(name), pa.array(slices.astype(np.int32)), pa.array(salt), binary16(c[owner]), pa.array(at.astype(np.int32)), pa.array(size.astype(np.int32))],
                names=["k", "z", "s", "c", "p", "l"],
            )

    # z slices of a name, of which s is one: a name in a large share of the texts isn't counted in one task.
    sent = column.mapInArrow(run, "k bigint, z int, s int, c binary, p int, l int")
    if not sketch:
        often = hot_values(sent.groupBy("k").agg(F.count(F.lit(1)).alias("n")), "k", "n")
        if often is not None:
            sent = sent.join(F.broadcast(often), "k", "left").withColumn("z", F.coalesce("_slices", F.lit(1))).drop("_slices")
            sent = sent.withColumn("s", F.pmod(F.xxhash64("c"), "z").cast("int"))
    sent = sent.repartition(shuffle_tasks(spark, 4 * length), "k", "s").groupBy("k", "s", "z", "c", "p").agg(F.first("l").alias("l"))
    whole = Window.partitionBy("k", "s")
    counted = {"m": F.count(F.lit(1)), "_a": F.min("c"), "_b": F.max("c")}
    sent = stash(sent.withColumns({n: x.over(whole) for n, x in counted.items()}).where("_a <> _b or z > 1").drop("_a", "_b"), "names")
    sliced = sent.where("z > 1").drop("m")
    if sliced.isEmpty():
        return sent
    total = stash(sliced.groupBy("k").agg(*[x.alias(n) for n, x in counted.items()]).where("_a <> _b").select("k", "m"), "totals")
    out = sent.where("z = 1").unionByName(sliced.join(bounded_broadcast(total), "k").select(*sent.columns))
    out._millrace_path = sent._millrace_path
    return out


def _equal_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of at least ``LEAST`` equal characters of two texts along a diagonal, on both texts."""
    for batch in batches:
        ca, cb, diagonal = batch.column(0), batch.column(1), batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
        (xa, fa), (xb, fb) = (code_points(texts_of(batch.column(i))) for i in (3, 4))
        na, nb = np.diff(fa) - 1, np.diff(fb) - 1
        begin = np.maximum(0, diagonal)
        stop = np.minimum(na, nb + diagonal)
        size = np.maximum(0, stop - begin)
        pair = np.repeat(np.arange(len(ca)), size)
        first = np.cumsum(size) - size
        i = np.arange(int(size.sum())) - first[pair] + begin[pair]
        equal = np.zeros(len(i) + 1, dtype=np.int8)
        equal[:-1] = xa[fa[pair] + i] == xb[fb[pair] + i - diagonal[pair]]
        edge = np.diff(equal, prepend=np.int8(0))
        fresh = np.zeros(len(i) + 1, dtype=bool)
        fresh[first[size > 0]] = True  # a run never goes on from one pair to the next
        cut = np.flatnonzero(fresh[:-1] & (equal[:-1] == 1) & (edge[:-1] == 0))
        starts = np.union1d(np.flatnonzero(edge == 1), cut)
        ends = np.union1d(np.flatnonzero(edge == -1), cut)
        long = ends - starts >= LEAST
        starts, ends = starts[long], ends[long]
        p = pair[starts] if len(starts) else np.zeros(0, np.int64)
        s = i[starts] if len(starts) else np.zeros(0, np.int64)
        e = s + (ends - starts)
        ca, cb = ca.take(pa.array(p)), cb.take(pa.array(p))
        c, o = pa.concat_arrays([ca, cb]), pa.concat_arrays([cb, ca])
        s, e = np.concatenate([s, s - diagonal[p]]), np.concatenate([e, e - diagonal[p]])
        yield pa.RecordBatch.from_arrays([c, o, pa.array(s.astype(np.int32)), pa.array(e.astype(np.int32))], names=["c", "o", "s", "e"])


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Both hashes of all windows of ``LEAST`` characters that hold one of a text's crowded names."""
    for batch in batches:
        texts = texts_of(batch.column(1))
        codes, first = code_points(texts)
        sums = prefix_sums(value_table()[codes])
        marks = batch.column(2).to_pylist()
        out_c, out_w = [], []
        for i, spots in enumerate(marks):
            n = int(first[i + 1] - first[i] - 1)
            delta = np.zeros(n + 2, dtype=np.int64)
            for spot in spots:
                low, high = max(0, spot["p"] + spot["l"] - LEAST), min(spot["p"], n - LEAST)
                if low <= high:
                    delta[low] += 1
                    delta[high + 1] -= 1
            w = np.flatnonzero(np.cumsum(delta)[: n + 1] > 0)
            out_w.append(w + first[i])
            out_c.append(np.full(len(w), i))
        w = np.concatenate(out_w) if out_w else np.zeros(0, np.int64)
        i = np.concatenate(out_c).astype(np.int64) if out_c else np.zeros(0, np.int64)
        h = stretch_hash(sums, w, w + LEAST) if len(w) else np.zeros(0, np.uint64)
        both = np.stack([h, field_hash(codes, w, LEAST)], axis=1)
        yield pa.RecordBatch.from_arrays([binary16(both), batch.column(0).take(pa.array(i)), pa.array((w - first[i]).astype(np.int32))], names=["h", "c", "w"])


def shared_stretches(posts: DataFrame, key: str = "post_id", text: str = "text") -> DataFrame:
    """(key, span_start, span_end): the maximal stretches of every record's text that stand in other records."""
    spark = posts.sparkSession
    kind = dict(posts.dtypes)[key]
    posts = posts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where(
        F.col(key).isNotNull() & (F.length(text) >= LEAST)
    )
    shared = _shared_names(posts)
    wanted = digest_filter(stash(shared.select("c").distinct(), "involved"), "c")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wanted() if wanted else None
        for batch in batches:
            texts = batch.column(1)
            c = text_digests(texts_of(texts))
            inside = np.ones(len(c), dtype=bool) if table is None else table[(c[:, 0] & np.uint64(len(table) - 1)).astype(np.int64)] > 0
            n = pa.array(np.fromiter((len(t or "") for t in texts.to_pylist()), dtype=np.int32, count=batch.num_rows))
            sent = pa.array([t if k else None for t, k in zip(texts.to_pylist(), inside)], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), binary16(c), n, sent], names=["_key", "c", "n", "_text"])

    # Who has which text: keys for all, the text itself only where a name is shared.
    owners = posts.mapInArrow(run, f"_key {kind}, c binary, n int, _text string")
    owners = stash(owners, "owners")
    classes = stash(
        owners.groupBy("c").agg(F.min("_key").alias("k1"), F.max("_key").alias("k2"), F.max("n").alias("n"))
        .where(F.col("n") >= LEAST),
        "classes",
    )
    texts = stash(owners.where("_text is not null").groupBy("c").agg(F.min("_text").alias("text")), "texts")
    few, many = shared.where(F.col("m") <= PAIRED), shared.where(F.col("m") > PAIRED)
    a = few.select("k", F.col("c").alias("ca"), F.col("p").alias("pa"))
    b = few.select("k", F.col("c").alias("cb"), F.col("p").alias("pb"))
    pairs = a.join(b, "k").where("ca < cb").select("ca", "cb", (F.col("pa") - F.col("pb")).alias("d")).distinct()
    pairs = pairs.join(texts.select(F.col("c").alias("ca"), F.col("text").alias("ta")), "ca")
    pairs = pairs.join(texts.select(F.col("c").alias("cb"), F.col("text").alias("tb")), "cb").select("ca", "cb", "d", "ta", "tb")
    runs = pairs.mapInArrow(_equal_runs, "c binary, o binary, s int, e int").distinct()
    # Two texts of one and the same record don't share in the sense meant here.
    own = classes.select("c", F.col("k1").alias("x1"), F.col("k2").alias("x2"))
    other = classes.select(F.col("c").alias("o"), F.col("k1").alias("y1"), F.col("k2").alias("y2"))
    twice = classes.where("k1 <> k2").select("c", F.lit(0).alias("s"), F.col("n").alias("e"))
    one = owners.groupBy("_key").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2").select("_key")
    changed = owners.join(one, "_key").select("c").distinct()
    if changed.isEmpty():
        runs = runs.select("c", "s", "e")
    else:
        runs = runs.join(own, "c").join(other, "o").where("not (x1 = x2 and y1 = y2 and x1 = y1)").select("c", "s", "e")
    spots = many.groupBy("c").agg(F.collect_set(F.struct("p", "l")).alias("spots"))  # places within one text
    windows = spots.join(texts, "c").select("c", "text", "spots").mapInArrow(_windows, "h binary, c binary, w int")
    met = windows.groupBy("h").agg(F.min("c").alias("a"), F.max("c").alias("b"), F.count(F.lit(1)).alias("n")).where("a <> b")
    met = stash(met.select("h", "n"), "met")
    crowded = salted_join(windows, met.select("h"), "h", "c", hot_values(met, "h", "n")).select("c", F.col("w").alias("s"), (F.col("w") + LEAST).alias("e"))
    spans = stash(runs.unionByName(twice).unionByName(crowded).distinct(), "spans")
    unstash(shared, texts, met)
    order = Window.partitionBy("c").orderBy("s", "e")
    reach = F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("_new", F.when(F.col("s") <= reach, 0).otherwise(1))
    islands = islands.withColumn("_i", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    stretches = islands.groupBy("c", "_i").agg(F.min("s").alias("span_start"), F.max("e").alias("span_end"))
    keys = owners.select("_key", "c").distinct()
    out = keys.join(stretches, "c").select(F.col("_key").alias(key), "span_start", "span_end")
    return out.distinct()


def shared_amounts(posts: DataFrame, key: str = "post_id", text: str = "text") -> DataFrame:
    """(key, n_stretches, shared_chars, shared_part) of every record with a text; zeros where nothing is shared."""
    length = posts.where(F.col(key).isNotNull() & F.col(text).isNotNull()).groupBy(key).agg(F.max(F.length(text)).alias("n_chars"))
    amount = shared_stretches(posts, key, text).groupBy(key).agg(
        F.count(F.lit(1)).alias("n_stretches"), F.sum(F.col("span_end") - F.col("span_start")).alias("shared_chars")
    )
    out = length.join(amount, key, "left").fillna(0, ["n_stretches", "shared_chars"])
    return out.withColumn("shared_part", F.when(F.col("n_chars") > 0, F.col("shared_chars") / F.col("n_chars")).otherwise(F.lit(0.0)))
