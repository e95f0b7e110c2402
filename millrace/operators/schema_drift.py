"""Schemas that drift between the files of a stream.

``profile_fields`` reduces every file to one row per spelled key: JSON types seen, min-hash sketches of the values and of
their shapes (what kinds of characters stand where), the mean length of a value and the number of records with the key.
``match_versions`` compares a file with the one before it by a maximum-weight bipartite matching of all their keys, on
sketches, types, name similarity and how many records have the key. A field that the alias table (case and underscores
ignored) knows in both files has the highest score; one known in one file only can be matched with any other key.
``unify_posts`` reads every payload into one table.

Defined results: null, blank and unreadable payloads and payloads that are no JSON object count as not readable and
give no profile rows (``unify_posts`` returns them with ``readable`` false and null fields); a byte order mark is
ignored; a file landed twice counts once; a first file, and one whose predecessor is missing, has no changes.
"""

from __future__ import annotations

from collections import defaultdict
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import strip
from millrace.runtime import bounded_broadcast, stash

#: Hash functions in a value sketch, and the least score at which unknown keys count as one renamed key.
SKETCH, RENAME_SCORE = 8, 0.55
#: Weights of values, shapes, types, names, lengths and shares of the records in a score.
WEIGHTS = (0.15, 0.3, 0.1, 0.2, 0.1, 0.15)
#: Files of a stream that are compared in one group.
FILES = 64
MARKS = "^[\\x{feff}\\s]+"

PROFILE = (
    "stream_id string, file_no int, spelling string, field_name string, n bigint, types array<string>, "
    "sketch array<bigint>, shapes array<bigint>, mean_length double"
)
CHANGES = (
    "stream_id string, file_no int, field_name string, change_kind string, before string, after string, evidence string"
)


#: With whether the field is one of the alias table, and the key outside it that was matched with the field.
KNOWN_CHANGES = CHANGES + ", known boolean, key string"
#: Score of a key with itself: more than two other pairs together, so no other pair can displace it.
SAME = 3.0


class Node(NamedTuple):
    """One side of the matching: a field of the alias table under all its spellings in a file, or any other key."""

    field: str | None
    spelling: str
    spelled: set[str]
    types: set[str]
    sketch: list
    shapes: list
    mean_length: float
    share: float


def canonical_key(key: Column) -> Column:
    return F.replace(F.lower(key), F.lit("_"), F.lit(""))


def readable(payload: Column) -> Column:
    """The payload as a VARIANT object, or null. A record with a repeated key keeps the last value."""
    value = F.try_parse_json(F.regexp_replace(payload, MARKS, ""))
    return F.when(F.schema_of_variant(value).startswith("OBJECT"), value)


def json_kind(schema: Column) -> Column:
    """string, integer, number, boolean, object, array of ...; null where the value says nothing."""
    inner = F.regexp_extract(schema, r"^ARRAY<(\w+)", 1)
    word = lambda c: (
        F.when(c == "STRING", "string")
        .when(c == "BOOLEAN", "boolean")
        .when(c.isin("BIGINT", "INT", "SMALLINT", "TINYINT"), "integer")
        .when(F.rlike(c, F.lit("^(DECIMAL|DOUBLE|FLOAT)")), "number")
        .when(F.rlike(c, F.lit("^OBJECT")), "object")
    )
    return F.when(F.rlike(schema, F.lit("^ARRAY")), F.concat(F.lit("array of "), word(inner), F.lit("s"))).otherwise(word(schema))


def value_shape(value: Column) -> Column:
    """The kinds of characters of a JSON value without its quotes: 9 for a digit, a for a run of letters, and one shape
    for everything that has four words in a row. Empty lists and objects have none."""
    shape = F.regexp_replace(F.regexp_replace(value, r'^"|"$', ""), r"\p{L}+", "a")
    shape = F.regexp_replace(shape, r"\p{N}", "9")
    shape = F.when(F.rlike(shape, F.lit(r"a[ ,;]+a[ ,;]+a[ ,;]+a")), "text").otherwise(shape)
    return F.when(~value.isin("[]", "{}", '""'), shape)


def aliases_frame(aliases: DataFrame) -> DataFrame:
    """One row for each known key in its canonical spelling."""
    known = aliases.select(canonical_key(F.col("alias_name")).alias("_canon"), "field_name").where("_canon is not null")
    return known.groupBy("_canon").agg(F.min("field_name").alias("field_name"))


def profile_fields(records: DataFrame, aliases: DataFrame) -> DataFrame:
    """Value profile of every key of every file. One shuffle of partial aggregates, no Python."""
    spark = records.sparkSession
    rec = records.select("stream_id", "file_no", readable(F.col("payload")).alias("_v")).where("_v is not null")
    each = rec.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).select(
        "stream_id",
        "file_no",
        F.col("key").alias("spelling"),
        json_kind(F.schema_of_variant("value")).alias("_type"),
        F.when(F.schema_of_variant("value") != "VOID", F.to_json("value")).alias("_value"),
    )
    each = each.withColumn("_shape", value_shape(F.col("_value")))
    sketch, shapes = ([F.min(F.xxhash64(F.lit(i), c)) for i in range(SKETCH)] for c in ("_value", "_shape"))
    out = each.groupBy("stream_id", "file_no", "spelling").agg(
        F.count(F.lit(1)).alias("n"),
        F.array_sort(F.collect_set("_type")).alias("types"),
        F.array(*sketch).alias("sketch"),
        F.array(*shapes).alias("shapes"),
        F.avg(F.length("_value")).alias("mean_length"),
    )
    out = out.withColumn("_canon", canonical_key(F.col("spelling")))
    return out.join(bounded_broadcast(aliases_frame(aliases)), "_canon", "left").select(*[c.split()[0] for c in PROFILE.split(", ")])


def _name_similarity(a: str, b: str) -> float:
    a, b = a.lower().replace("_", ""), b.lower().replace("_", "")
    if a == b:
        return 1.0
    grams = lambda s: {s[i : i + 2] for i in range(max(1, len(s) - 1))}
    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


def _nodes(rows: list) -> list[Node]:
    grouped: dict[tuple, list] = defaultdict(list)
    for r in rows:
        field = r.field_name if isinstance(r.field_name, str) else None
        grouped[field, "" if field else r.spelling].append(r)
    out = []
    most = max(r.n for r in rows)  # about the number of records
    for (field, _), group in sorted(grouped.items(), key=lambda kv: (kv[0][0] is None, kv[0][0] or kv[0][1])):
        # The sketch of several spellings is the least of each coordinate; their length is the mean over records.
        least = lambda lists: [min((v for v in x if v is not None and v == v), default=None) for x in zip(*lists)]
        sketch, shapes = least(r.sketch for r in group), least(r.shapes for r in group)
        sized = [(r.n, r.mean_length) for r in group if r.mean_length is not None and r.mean_length == r.mean_length]
        length = sum(n * x for n, x in sized) / max(1, sum(n for n, _ in sized))
        spelled = {r.spelling for r in group}
        out.append(Node(field, min(spelled), spelled, {t for r in group for t in r.types}, sketch, shapes, length, min(1.0, sum(r.n for r in group) / most)))
    return out


def _score(a: Node, b: Node) -> float:
    """How much two nodes look like one: the same field or key, or else equal sketch coordinates of values and shapes,
    shared types, names, value lengths and shares of the records. Two different fields of the alias table never match."""
    if a.field and b.field:
        return SAME if a.field == b.field else 0.0
    if a.field is b.field and a.spelling == b.spelling:
        return SAME
    kinds = len(a.types & b.types) / max(1, len(a.types | b.types))
    lengths = _ratio(a.mean_length, b.mean_length)
    names = max(_name_similarity(x, y) for x in a.spelled | {a.field or a.spelling} for y in b.spelled | {b.field or b.spelling})
    parts = (_equal(a.sketch, b.sketch), _equal(a.shapes, b.shapes), kinds, names, lengths, _ratio(a.share, b.share))
    return sum(w * x for w, x in zip(WEIGHTS, parts))


def _ratio(a: float, b: float) -> float:
    return min(a, b) / max(a, b) if max(a, b) > 0 else 0.0


def _equal(a: list, b: list) -> float:
    pairs = [(x, y) for x, y in zip(a, b) if x is not None and y is not None]
    return sum(x == y for x, y in pairs) / len(pairs) if pairs else 0.0


def best_matching(weights: list[list[float]], least: float) -> list[tuple[int, int]]:
    """Maximum-weight bipartite matching of rows and columns over entries of at least ``least``.

    Shortest augmenting paths on the square matrix padded with zeros; the sides are the keys of one file each.
    """
    n = max(len(weights), max((len(r) for r in weights), default=0))
    cost = [[0.0] * n for _ in range(n)]
    for i, row in enumerate(weights):
        for j, w in enumerate(row):
            cost[i][j] = -w if w >= least else 0.0
    row_pot, col_pot, owner = [0.0] * n, [0.0] * n, [-1] * n
    for start in range(n):
        slack, via, seen = [float("inf")] * n, [-1] * n, [False] * n
        current, column = start, -1
        while True:
            step, nearest = float("inf"), -1
            for j in range(n):
                if seen[j]:
                    continue
                d = cost[current][j] - row_pot[current] - col_pot[j]
                if d < slack[j]:
                    slack[j], via[j] = d, column
                if slack[j] < step:
                    step, nearest = slack[j], j
            row_pot[start] += step
            for j in range(n):
                if seen[j]:
                    col_pot[j] -= step
                    row_pot[owner[j]] += step
                else:
                    slack[j] -= step
            seen[nearest] = True
            column = nearest
            if owner[nearest] < 0:
                break
            current = owner[nearest]
        while column >= 0:
            previous = via[column]
            owner[column] = owner[previous] if previous >= 0 else start
            column = previous
    return [(i, j) for j, i in enumerate(owner) if i < len(weights) and j < len(weights[i]) and weights[i][j] >= least]


def _stream_changes(profiles: pd.DataFrame) -> pd.DataFrame:
    """Changes along ``FILES`` files of a stream; the file before them comes along as a predecessor only."""
    files: dict[int, list] = defaultdict(list)
    for row in profiles.itertuples():
        files[int(row.file_no)].append(row)
    out = []
    text = lambda xs: ",".join(sorted(xs))
    for no in sorted(files):
        if no - 1 not in files or no // FILES != profiles["_part"].iloc[0]:
            continue
        old, new = _nodes(files[no - 1]), _nodes(files[no])
        pairs = best_matching([[_score(x, y) for y in new] for x in old], RENAME_SCORE)
        stream = files[no][0].stream_id

        def say(kind, a, b, x, y):
            # A field of the alias table gives its name to the key that is matched with it.
            field = next((z.field for z in (x, y) if z and z.field), None)
            why = "matched" if any(z and not z.field for z in (x, y)) else "alias"
            key = next((z.spelling for z in (x, y) if z and not z.field), None) if field else None
            out.append((stream, no, field or (y or x).spelling, kind, a, b, why, field is not None, key))

        for x, y in [(old[i], new[j]) for i, j in pairs]:
            if x.spelled != y.spelled:
                say("renamed", text(x.spelled), text(y.spelled), x, y)
            if x.types and y.types and x.types != y.types:
                say("type_changed", text(x.types), text(y.types), x, y)
        for i, x in enumerate(old):
            if i not in {p[0] for p in pairs}:
                say("removed", text(x.spelled), None, x, None)
        for j, y in enumerate(new):
            if j not in {p[1] for p in pairs}:
                say("added", None, text(y.spelled), None, y)
    return pd.DataFrame(out, columns=[c.split()[0] for c in KNOWN_CHANGES.split(", ")])


def _known_changes(records: DataFrame, aliases: DataFrame) -> DataFrame:
    part, last = F.floor(F.col("file_no") / FILES), F.col("file_no") % FILES == FILES - 1
    profiles = profile_fields(records, aliases)
    profiles = profiles.withColumn("_part", F.explode(F.when(last, F.array(part, part + 1)).otherwise(F.array(part))))
    return profiles.groupBy("stream_id", "_part").applyInPandas(_stream_changes, KNOWN_CHANGES)


def match_versions(records: DataFrame, aliases: DataFrame) -> DataFrame:
    """All changes of every file against its predecessor, with the evidence: alias, or matched by profile.

    A task never holds more than the profiles of ``FILES`` + 1 files, however many files a stream has.
    """
    return _known_changes(records, aliases).drop("known", "key")


def found_changes(records: DataFrame, aliases: DataFrame) -> DataFrame:
    """Changes of the fields in the alias table, renames to and from keys outside it included."""
    return _known_changes(records, aliases).where("known").select("stream_id", "file_no", "field_name", "change_kind")


def _stream_names(renames: pd.DataFrame) -> pd.DataFrame:
    """The fields of a stream's keys outside the alias table, through renames from key to key; a key that leads to two
    fields has none."""
    fields: dict[str, set] = defaultdict(set)
    near: dict[str, set] = defaultdict(set)
    for r in renames.itertuples():
        if r.known:
            fields[r.key].add(r.field_name)
        else:
            near[r.before].add(r.after)
            near[r.after].add(r.before)
    todo = list(fields)
    while todo:
        key = todo.pop()
        for other in near[key]:
            if not fields[key] <= fields[other]:
                fields[other] |= fields[key]
                todo.append(other)
    found = [(renames["stream_id"].iloc[0], k, min(f)) for k, f in fields.items() if len(f) == 1]
    return pd.DataFrame(found, columns=["stream_id", "key", "field_name"])


def learned_names(records: DataFrame, aliases: DataFrame) -> DataFrame:
    """(stream_id, learned): for each stream with such keys, a map from keys outside the alias table to their fields."""
    renames = _known_changes(records, aliases).where("change_kind = 'renamed' and evidence = 'matched'")
    renames = renames.select("stream_id", "field_name", "before", "after", "known", "key").distinct()
    found = renames.groupBy("stream_id").applyInPandas(_stream_names, "stream_id string, key string, field_name string")
    return found.groupBy("stream_id").agg(F.map_from_entries(F.collect_list(F.struct("key", "field_name"))).alias("learned"))


def unify_posts(records: DataFrame, aliases: DataFrame) -> DataFrame:
    """One consistent table of posts: a row for each record, known fields as strings whatever the file's spelling.

    Every spelling of a field is looked up case- and underscore-blind; the first alias in the table's order that
    has a value wins, and after the aliases a key of the stream that was matched with the field. All keys outside the
    alias table, matched or not, are kept in the map ``other_keys``, so none is lost where two claim one field.
    """
    names: dict[str, list[str]] = defaultdict(list)
    for row in aliases.select("field_name", "alias_name").collect():  # a dictionary of field names, fixed in size
        if row.field_name is not None and row.alias_name is not None:
            names[row.field_name].append(row.alias_name.lower().replace("_", ""))
    known = sorted({k for keys in names.values() for k in keys})
    learned = stash(learned_names(records, aliases), "learned")
    rec = records.select(
        "record_id", "stream_id", "file_no", "source_row", readable(F.col("payload")).alias("_v")
    ).join(bounded_broadcast(learned), "stream_id", "left")
    # A record's keys in canonical spelling, once for all fields; a learned key is its field after a mark.
    entries = F.map_entries(F.from_json(F.to_json("_v"), "map<string,string>"))
    told = lambda key: F.concat(F.lit("\x00"), F.try_element_at("learned", key))
    inside = lambda key: canonical_key(key).isin(known) if known else F.lit(False)
    name = lambda key: F.when(inside(key), canonical_key(key)).otherwise(told(key))
    rec = rec.withColumn("_e", F.transform(entries, lambda e: F.struct(name(e["key"]).alias("k"), e["value"].alias("v"), e["key"].alias("key"))))
    hit = lambda key: F.get(F.filter("_e", lambda e: (e["k"] == key) & e["v"].isNotNull()), F.lit(0))["v"]
    pick = lambda keys: F.coalesce(*[hit(k) for k in dict.fromkeys(keys)])
    fields = []
    for field, keys in names.items():
        value = pick([*keys, "\x00" + field])
        if field == "reference_types":
            value = _reference_text(value)
        fields.append(value.alias(field))
    rest = F.transform(F.filter("_e", lambda e: ~inside(e["key"])), lambda e: F.struct(e["key"], e["v"]))
    return rec.select(
        "record_id", "stream_id", "file_no", "source_row", F.col("_v").isNotNull().alias("readable"), *fields, F.map_from_entries(rest).alias("other_keys")
    )


def _reference_text(value: Column) -> Column:
    """Sorted distinct labels from the JSON text of a reference list, or from a comma list."""
    listed = F.from_json(value, "array<string>")
    items = F.when(F.rlike(value, F.lit(r"^\s*\[")), listed).otherwise(F.split(value, ","))
    label = lambda x: F.lower(strip(F.when(F.rlike(x, F.lit(r"^\s*\{")), F.get_json_object(x, "$.type")).otherwise(x)))
    return F.array_sort(F.array_distinct(F.filter(F.transform(items, label), lambda x: x.isNotNull() & (x != ""))))
