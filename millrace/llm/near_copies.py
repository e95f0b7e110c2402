"""Posts that are nearly the same: pairs with a Jaccard similarity of word shingles of at least a threshold.

Method: pivot distance tables. The set of a text's shingles is a point of a Hamming space with one coordinate for each
possible shingle. That space is cut into ``PARTS`` parts by the shingles' hashes, and the reference fingerprints (pivots)
are all unions of parts, the empty one included: 2 ** ``PARTS`` of them. The distance of a text to a pivot is the size of
both less twice the text's shingles inside, so the number of shingles in each part gives the distances to all pivots;
that is the table. By the triangle inequality a difference of two texts' coordinates is at most their own distance. The
largest difference over all these pivots is found at the union of the parts in which the one text has more: it is the
sum over the parts of the differences in number. Numbers are kept up to ``MOST``, which only makes differences smaller,
in unary, so the sum is a count of unequal bits. A pair of the wanted similarity has a distance of at most
``(1 - J) / (1 + J)`` times the sum of the sizes, so pairs with a larger coordinate difference are discarded without
loss; nothing else discards a pair before the survivors are verified on their whole texts.

A table of distances alone would have to be compared pair by pair. Pairs are therefore formed only where texts meet in
their rarest shingles (prefix filtering, also without loss): two texts of the wanted similarity share one of the
``n - ceil(J * n) + 1`` first shingles of either in one common order. The order is by frequency in all texts, rare
first; any order gives the same result, a good one few candidates. Where the first shared shingle is frequent, the next
shared one is as frequent or more, so frequent shingles are used only in pairs, over a prefix longer by one; texts so
small that one shared shingle is enough (one word over and over) use it alone, too. Shingles of one text only are left
out.

Frequencies come from a count sketch with about as many cells as shingles, and are exact, by a shuffle of the shingles,
for corpora beyond ``kernels.LOAD`` shingles for each cell of the largest sketch. Only where they come from depends on
the size; so a sketch that is too full never decides how many candidates there are.

Texts with the same words are one class from the start, named by a 128-bit digest of the words; a class's pairs are
spread to its posts at the end, where posts that are copies up to layout are left out. Nothing is capped or sampled.

Defined results: null keys and texts, and texts with fewer than ``LEAST_WORDS`` words, are in no pair; repeated
deliveries of a post count once; no post is paired with itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import copies
from millrace.llm.kernels import Words, binary16, count_sketch, digest_filter, fresh, fresh_rows, shared_table, sketch_cells, texts_of, total_length
from millrace.operators.components import connected_components
from millrace.runtime import hot_values, salted_join, shuffle_tasks, stash, unstash

#: Words in a shingle, the least similarity as a fraction, and the least number of words of a text.
SHINGLE, THRESHOLD, LEAST_WORDS = 3, (3, 5), 20
#: Parts of the shingle space whose unions are the pivots, the most shingles that are told apart in a part, and the
#: parts that a column of the table holds.
PARTS, MOST = 96, 2
HELD = 64 // MOST
#: Occurrences from which shingles are used in pairs only.
FREQUENT = 2048
TABLE = [f"t{i}" for i in range(PARTS // HELD)]
SENT = "k bigint, c binary, n int, " + ", ".join(f"{t} bigint" for t in TABLE)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _pivot_table(doc: np.ndarray, value: np.ndarray, texts: int) -> list[np.ndarray]:
    """The table's columns for each text, from the distinct shingles ``value`` of the texts ``doc``."""
    part = ((value >> np.uint64(32)) * np.uint64(PARTS)) >> np.uint64(32)
    inside = np.bincount(doc * PARTS + part.astype(np.int64), minlength=texts * PARTS).reshape(texts, PARTS // HELD, 1, HELD)
    unary = inside >= np.arange(1, MOST + 1).reshape(1, 1, MOST, 1)
    packed = np.packbits(unary.reshape(texts, PARTS // HELD, 64), axis=2, bitorder="little").view(np.uint64)
    return [packed[:, i, 0] for i in range(PARTS // HELD)]


def _shingles_of(words: Words, setting: tuple, seen: set[bytes]) -> tuple:
    """Digests of all texts, and (text, shingle) of the distinct shingles of texts not sent before by this task."""
    n_words, _, least = setting
    key = words.sequence_key()
    send = fresh_rows(key, seen, words.count >= max(least, n_words))
    return key, *words.shingles(n_words, send)


def _prefixes(batch_texts: list[str], sketch: np.ndarray, seen: set[bytes], setting: tuple) -> pa.RecordBatch:
    n_words, (up, down), least = setting
    words = Words(batch_texts)
    key = words.sequence_key()
    doc, value = words.runs(n_words, fresh_rows(key, seen, words.count >= max(least, n_words)))  # a class once from each task
    level = sketch[(value & np.uint64(len(sketch) - 1)).astype(np.int64)]
    order = np.lexsort((value, level, doc))  # equal shingles have equal levels, so they stand together
    doc, value, level = doc[order], value[order], level[order]
    new = fresh(doc, value)
    doc, value, level = doc[new], value[new], level[new]
    size = np.bincount(doc, minlength=len(batch_texts))
    table = _pivot_table(doc, value, len(size))
    place = np.arange(len(doc)) - (np.cumsum(size) - size)[doc]
    prefix = size - (-(-up * size // down)) + 1
    tiny = size * up <= down  # such texts can meet in one shingle alone, and only with each other
    frequent = level >= 1 + int(8 * np.log2(FREQUENT))
    single = (place < prefix[doc]) & (level > 1) & (~frequent | tiny[doc])
    keys, owner = [value[single]], [doc[single]]
    often = np.flatnonzero((place < (prefix + 1)[doc]) & frequent)
    for step in range(1, int(prefix.max(initial=0)) + 1):
        a = often[: len(often) - step]
        b = often[step:]
        same = (doc[a] == doc[b]) & (place[a] < prefix[doc[a]])
        if not same.any():
            break
        a, b = a[same], b[same]
        keys.append(value[a] * np.uint64(0x9E3779B97F4A7C15) + (value[b] ^ np.uint64(0x5851F42D4C957F2D)))
        owner.append(doc[a])
    k, o = np.concatenate(keys), np.concatenate(owner)
    return pa.RecordBatch.from_arrays([_signed(k), binary16(key[o]), pa.array(size[o].astype(np.int32)), *[_signed(t[o]) for t in table]], names=["k", "c", "n", *TABLE])


def _counted_prefixes(column: DataFrame, setting: tuple) -> DataFrame:
    """The rows of ``_prefixes`` for all texts with exact document frequencies: shingles are counted by a shuffle, joined
    back with frequent ones in slices, and put in order for each class, which holds as much as its text."""
    up, down = setting[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            texts = texts_of(batch.column(0))
            key, doc, value = _shingles_of(Words(texts), setting, seen)
            size = np.bincount(doc, minlength=len(texts))
            sent = np.flatnonzero(size)
            offsets = np.concatenate([[0], np.cumsum(size[sent])]).astype(np.int32)
            sets = pa.ListArray.from_arrays(pa.array(offsets), _signed(value))
            table = _pivot_table(doc, value, len(size))
            yield pa.RecordBatch.from_arrays([sets, binary16(key[sent]), pa.array(size[sent].astype(np.int32)), *[_signed(t[sent]) for t in table]], names=["s", "c", "n", *TABLE])

    sets = column.mapInArrow(run, "s array<bigint>, " + SENT.split(", ", 1)[1])
    sets = stash(sets.groupBy("c").agg(*[F.first(x).alias(x) for x in ("s", "n", *TABLE)]), "sets")
    each = sets.select("c", F.explode("s").alias("h"))
    counts = stash(each.groupBy("h").agg(F.count(F.lit(1)).alias("d")).where("d > 1"), "counts")
    met = salted_join(each, counts, "h", "c", hot_values(counts, "h", "d"))
    lists = met.groupBy("c").agg(F.array_sort(F.collect_list(F.struct("d", "h"))).alias("l")).join(sets.drop("s"), "c")
    # Shingles of one text only would come first; the rest of the prefix is a slice of the list.
    n = F.col("n").cast("bigint")
    prefix = n - F.ceil(n * up / down) + 1 - (n - F.size("l"))
    lists = lists.withColumn("p", F.greatest(prefix, F.lit(0)).cast("int")).where("p > 0")
    tiny = F.col("n") * up <= down
    rare = F.transform(F.filter(F.slice("l", 1, F.col("p")), lambda x: (x["d"] < FREQUENT) | tiny), lambda x: x["h"])
    often = F.filter(F.transform(F.slice("l", 1, F.col("p") + 1), lambda x, i: F.struct(x["d"].alias("d"), x["h"].alias("h"), i.alias("i"))), lambda x: x["d"] >= FREQUENT)
    lists = lists.withColumn("o", often)
    after = lambda x: F.transform(F.filter("o", lambda y: y["i"] > x["i"]), lambda y: F.xxhash64(x["h"], y["h"]))
    both = F.flatten(F.transform(F.filter("o", lambda x: x["i"] < F.col("p")), after))
    return lists.select(F.explode(F.concat(rare, both)).alias("k"), "c", "n", *TABLE)


def not_discarded(up: int, down: int) -> Column:
    """Whether no pivot's coordinates rule out the wanted similarity of the sides a and b."""
    largest = F.lit(0)
    for t in TABLE:
        largest = largest + F.bit_count(F.col(t + "a").bitwiseXOR(F.col(t + "b")))
    return largest <= (F.col("na") + F.col("nb")) * (down - up) / (down + up)


def keyed_classes(posts: DataFrame, setting: tuple, text: str = "text") -> DataFrame:
    """(k, c, n, table): the keys under which each class looks for near ones, once each."""
    spark = posts.sparkSession
    n_words, _, least = setting
    column = posts.select(text).where(F.col(text).isNotNull())
    length = total_length(column, text)
    cells = sketch_cells(length // 6)  # a shingle for each word
    if cells is None:
        return _counted_prefixes(column, setting)

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        words = Words(texts_of(batch.column(0)))
        return words.runs(n_words, words.count >= max(least, n_words))[1]

    sketch = shared_table(spark, count_sketch(column, hashes, cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, seen = sketch(), set()
        for batch in batches:
            yield _prefixes(texts_of(batch.column(0)), table, seen, setting)

    sent = column.mapInArrow(run, SENT)
    return sent.repartition(shuffle_tasks(spark, 4 * length), "k").groupBy("k", "c").agg(*[F.first(x).alias(x) for x in ("n", *TABLE)])


def candidate_classes(posts: DataFrame, setting: tuple, text: str = "text") -> DataFrame:
    """(ca, cb), ca < cb: classes that meet under a key and that no pivot rules out."""
    sent = keyed_classes(posts, setting, text)
    a, b = (sent.select("k", *[F.col(x).alias(x + side) for x in ("c", "n", *TABLE)]) for side in "ab")
    return a.join(b, "k").where((F.col("ca") < F.col("cb")) & not_discarded(*setting[1])).select("ca", "cb").distinct()


def _verify(n_words: int, up: int, down: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [Words(texts_of(batch.column(i))) for i in (2, 3)]
            n = batch.num_rows
            every = np.ones(n, dtype=bool)
            (da, va), (db, vb) = (s.shingles(n_words, every) for s in sides)
            sizes = np.bincount(da, minlength=n) + np.bincount(db, minlength=n)
            doc, value = np.concatenate([da, db]), np.concatenate([va, vb])
            order = np.lexsort((value, doc))
            doc, value = doc[order], value[order]
            both = np.bincount(doc[1:][(doc[1:] == doc[:-1]) & (value[1:] == value[:-1])], minlength=n)
            good = (both * down >= (sizes - both) * up) & (sizes > 0)
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both), pa.array(sizes - both)], names=["ca", "cb", "both", "either"])
            yield out.filter(pa.array(good))

    return run


def near_classes(
    posts: DataFrame,
    key: str = "post_id",
    text: str = "text",
    shingle: int = SHINGLE,
    threshold: tuple[int, int] = THRESHOLD,
    least_words: int = LEAST_WORDS,
) -> tuple[DataFrame, DataFrame]:
    """Verified pairs of classes (ca, cb, both, either), and the members (key, c, text digests) of these classes.

    Also among the members: texts too short to be copies up to layout, whose posts pair within their class.
    """
    spark = posts.sparkSession
    setting = (shingle, threshold, least_words)
    posts = posts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_key is not null and _text is not null")
    pairs = stash(candidate_classes(posts, setting, "_text"), "candidates")
    involved = pairs.select(F.explode(F.array("ca", "cb")).alias("c"))
    wanted = digest_filter(involved, "c")
    kind = dict(posts.dtypes)["_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = wanted() if wanted else None
        for batch in batches:
            words = Words(texts_of(batch.column(1)))
            c = words.sequence_key()
            keep = words.count >= max(least_words, shingle)
            if table is not None:
                inside = table[(c[:, 0] & np.uint64(len(table) - 1)).astype(np.int64)] > 0
                keep &= inside | (words.letters < 2 * copies.LEAST)
            out = pa.RecordBatch.from_arrays([batch.column(0), binary16(c), batch.column(1)], names=["_key", "c", "_text"])
            yield out.filter(pa.array(keep))

    members = stash(posts.mapInArrow(run, f"_key {kind}, c binary, _text string"), "members")
    texts = members.groupBy("c").agg(F.min("_text").alias("text"))
    ab = pairs.join(texts.select(F.col("c").alias("ca"), F.col("text").alias("ta")), "ca")
    ab = ab.join(texts.select(F.col("c").alias("cb"), F.col("text").alias("tb")), "cb").select("ca", "cb", "ta", "tb")
    good = stash(ab.mapInArrow(_verify(shingle, *threshold), "ca binary, cb binary, both bigint, either bigint"), "near")
    unstash(pairs)
    digests = members.withColumns(copies.canonical_columns("_text")).withColumns(copies.digest_columns())
    long = F.length("_plain") >= copies.LEAST
    people = digests.select("_key", "c", F.when(long, F.col("_flat")).alias("flat"), F.when(long, F.col("_tree")).alias("tree"))
    return good, people.distinct()


def found_pairs(posts: DataFrame) -> DataFrame:
    """(post_id_a, post_id_b): near pairs of different posts that are no copies up to layout."""
    good, people = near_classes(posts)
    a = people.select(F.col("_key").alias("a"), F.col("c").alias("ca"), F.col("flat").alias("fa"), F.col("tree").alias("ra"))
    b = people.select(F.col("_key").alias("b"), F.col("c").alias("cb"), F.col("flat").alias("fb"), F.col("tree").alias("rb"))
    copy = F.coalesce(F.col("fa") == F.col("fb"), F.lit(False)) | F.coalesce(F.col("ra") == F.col("rb"), F.lit(False))
    across = good.join(a, "ca").join(b, "cb").where(~copy & (F.col("a") != F.col("b"))).select("a", "b")
    short = people.where("flat is null")
    inside = short.select(F.col("_key").alias("a"), "c").join(short.select(F.col("_key").alias("b"), "c"), "c").where("a < b").select("a", "b")
    out = across.unionByName(inside)
    return out.select(F.least("a", "b").alias("post_id_a"), F.greatest("a", "b").alias("post_id_b")).distinct()


def post_classes(posts: DataFrame, key: str = "post_id", text: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """(key, cs): the classes of every post's texts; empty where no text has ``least_words`` words."""
    posts = posts.select(F.col(key).alias("_key"), F.col(text).alias("_text")).where("_key is not null")
    kind = dict(posts.dtypes)["_key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = Words(texts_of(batch.column(1)))
            c = binary16(words.sequence_key())
            c = pc.if_else(pa.array(words.count >= least_words), c, pa.scalar(None, pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), c], names=["_key", "c"])

    found = posts.withColumn("_text", F.coalesce("_text", F.lit(""))).mapInArrow(run, f"_key {kind}, c binary")
    return found.groupBy("_key").agg(F.collect_set("c").alias("cs")).withColumnRenamed("_key", key)


def post_groups(posts: DataFrame) -> DataFrame:
    """(post_id, group_id, n_links), one row for every post: posts of the same words or with near texts are one group,
    named by its least post id; a post without either is its own. The links are the different texts (other than copies
    of its own words) that are near."""
    good, _ = near_classes(posts)
    rows = stash(post_classes(posts), "classes")
    each = rows.select("post_id", F.explode("cs").alias("c"))
    several = rows.where(F.size("cs") > 1).select(F.get("cs", F.lit(0)).alias("ca"), F.explode("cs").alias("cb"))  # one post's texts
    components = connected_components(good.select("ca", "cb").unionByName(several), "ca", "cb").withColumnRenamed("node", "c")
    both = good.select(F.col("ca").alias("c")).unionByName(good.select(F.col("cb").alias("c")))
    links = both.groupBy("c").agg(F.count(F.lit(1)).alias("n_links"))
    classes = stash(each.groupBy("c").agg(F.min("post_id").alias("least"), F.count(F.lit(1)).alias("n")), "least")
    named = classes.join(components, "c", "left").withColumn("component", F.coalesce("component", "c")).join(links, "c", "left")
    names = named.groupBy("component").agg(F.min("least").alias("group_id"))
    named = named.join(names, "component").select("c", "group_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    found = salted_join(each, named, "c", "post_id", hot_values(classes, "c", "n"))
    found = found.groupBy("post_id").agg(F.min("group_id").alias("group_id"), F.max("n_links").alias("n_links"))
    alone = rows.where(F.size("cs") == 0).select("post_id", F.col("post_id").alias("group_id"), F.lit(0).cast("bigint").alias("n_links"))
    return found.unionByName(alone)


def near_groups(posts: DataFrame) -> DataFrame:
    """The rows of ``post_groups`` of the posts with a near text of other words."""
    return post_groups(posts).where("n_links > 0")
