"""Posts in any of the known field names to one schema, with a reason for every record that can't be read.

All of it is one projection: no shuffle, and Python only for texts with entities or characters beyond ASCII.

Defined results: an alias counts when its value is neither null nor the empty string, so a blank first alias wins and
then fails; the first failing rule is the reason; a language that is missing is und, a conversation that is missing
the post itself; other keys of a record are kept in its raw envelope only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import normalise_text, strip

# Known names of each field, in order of preference.
ALIASES = {
    "post_id": ["post_id", "tweet_id", "id_str", "id"],
    "author_id": ["author_id", "user_id", "username", "user", "screen_name"],
    "created_at": ["created_at_utc", "created_at", "timestamp", "date"],
    "text": ["text_raw", "full_text", "text", "content"],
    "lang": ["lang", "language"],
    "conversation_id": ["conversation_id", "thread_id"],
    "in_reply_to_post_id": ["in_reply_to_post_id", "in_reply_to_status_id_str"],
    "quoted_post_id": ["quoted_post_id", "quoted_status_id_str"],
}
REFERENCES = ["reference_types", "referenced_tweets"]
ENTITIES = ["entities", "entities_json"]
# Spellings of a time, as patterns with the parts year to offset.
_ISO = r"^(\d{4})-(\d{2})-(\d{2})(?:[Tt ](\d{2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?(Z|[+-]\d{2}:?\d{2}|))?$"
_BASIC = r"^(\d{4})(\d{2})(\d{2})[Tt](\d{2})(\d{2})(\d{2})(?:[.,](\d{1,9}))?(Z|[+-]\d{2}:?\d{2}|)$"
_CTIME = r"^(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun) (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) (\d{1,2}) (\d{2}):(\d{2}):(\d{2}) ([+-]\d{2}:?\d{2}) (\d{4})$"
_MONTHS = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()


def json_value(record: Column, name: str) -> Column:
    return F.get_json_object(record, f"$.{name}")


def first_alias(record: Column, field: str) -> Column:
    """The first alias with a value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(json_value(record, a), F.lit("")) for a in ALIASES[field]])


def first_present(record: Column, names: list[str]) -> Column:
    """The value under the first of ``names`` that the record has, also where that is a JSON null."""
    keys = F.json_object_keys(record)
    out = json_value(record, names[-1])
    for name in reversed(names[:-1]):
        out = F.when(F.array_contains(keys, name), json_value(record, name)).otherwise(out)
    return out


def parse_time(raw: Column) -> Column:
    """A time in one of the accepted spellings as TIMESTAMP, UTC where no zone is given; null if unreadable."""
    s = strip(raw)
    laid = (
        F.when(F.rlike(s, F.lit(_ISO)), F.regexp_replace(s, _ISO, "$1|$2|$3|$4|$5|$6|$7|$8"))
        .when(F.rlike(s, F.lit(_BASIC)), F.regexp_replace(s, _BASIC, "$1|$2|$3|$4|$5|$6|$7|$8"))
        .when(F.rlike(s, F.lit(_CTIME)), F.regexp_replace(s, _CTIME, "$7|$1|$2|$3|$4|$5||$6"))
    )
    p = F.split(laid, r"\|")
    part = lambda i: F.get(p, F.lit(i))
    number = lambda i: F.coalesce(F.nullif(part(i), F.lit("")).try_cast("int"), F.lit(0))
    months = F.create_map(*[F.lit(x) for i, m in enumerate(_MONTHS) for x in (m, i + 1)])
    month = F.coalesce(part(1).try_cast("int"), F.try_element_at(months, part(1)))
    digits = F.regexp_replace(part(7), "[^0-9]", "")
    offset = F.when(part(7).isin("", "Z"), 0).otherwise(
        F.when(part(7).startswith("-"), -1).otherwise(1) * (F.substring(digits, 1, 2).try_cast("int") * 60 + F.substring(digits, 3, 2).try_cast("int"))
    )
    whole = F.when((number(3) < 24) & (number(4) < 60) & (number(5) < 60) & (part(0).try_cast("int") > 0), F.try_make_timestamp_ltz(part(0).try_cast("int"), month, part(2).try_cast("int"), number(3), number(4), number(5).cast("decimal(8,6)"), F.lit("UTC")))
    micros = F.coalesce(F.rpad(F.substring(part(6), 1, 6), 6, "0").try_cast("int"), F.lit(0))
    return F.timestamp_micros(F.unix_micros(whole) + micros - offset.cast("bigint") * 60_000_000)


def render_time(at: Column) -> Column:
    """ISO text with Z; six digits of a fraction only where there is one."""
    fraction = F.when(F.pmod(F.unix_micros(at), F.lit(1_000_000)) != 0, F.date_format(at, ".SSSSSS")).otherwise("")
    return F.concat(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def reference_labels(listed: Column, text: Column, reply: Column, quoted: Column) -> Column:
    """Sorted distinct labels from a JSON list of names or objects, a JSON text of one, or a comma list; retweets,
    replies and quotes are added when the post shows them."""
    inner = F.when(F.rlike(listed, F.lit(r"^\s*\[")), listed)
    items = F.when(inner.isNotNull(), F.from_json(inner, "array<string>")).otherwise(F.split(listed, ","))
    name = lambda x: F.lower(strip(F.when(F.rlike(x, F.lit(r"^\s*\{")), F.get_json_object(x, "$.type")).otherwise(x)))
    given = F.filter(F.transform(items, name), lambda x: x.isNotNull() & (x != ""))
    shown = F.array_compact(
        F.array(
            F.when(F.rlike(text, F.lit(r"^[\s\p{Z}]*RT @")), "retweeted"),
            F.when(reply.isNotNull(), "replied_to"),
            F.when(quoted.isNotNull(), "quoted"),
        )
    )
    return F.array_sort(F.array_distinct(F.concat(F.coalesce(given, F.array().cast("array<string>")), shown)))


def entities_json(value: Column) -> Column:
    """Entities as the JSON text of an object: text that is no JSON becomes ``unparsed``, anything else ``value``."""
    parsed = F.try_parse_json(value)
    is_object = F.schema_of_variant(parsed).startswith("OBJECT")
    return (
        F.when(value.isNull(), "{}")
        .when(parsed.isNull(), F.to_json(F.struct(value.alias("unparsed"))))
        .when(is_object, F.to_json(parsed))
        .otherwise(F.concat(F.lit('{"value":'), F.to_json(parsed), F.lit("}")))
    )


def normalise_posts(records: DataFrame, version: str = "none", urls: bool = True, mentions: bool = True) -> DataFrame:
    """``records`` (source_ref, payload as the text of a JSON object) to the fixed schema, with ``reason``.

    ``reason`` is null for readable posts; the others keep their source_ref and payload.
    """
    # A payload that is no JSON is a record without fields.
    r = F.when(F.try_parse_json("payload").isNotNull(), F.col("payload"))
    base = records.select(
        "source_ref",
        "payload",
        strip(first_alias(r, "post_id")).alias("post_id"),
        strip(first_alias(r, "author_id")).alias("author_id"),
        first_alias(r, "text").alias("text_raw"),
        first_alias(r, "created_at").alias("_at"),
        F.lower(strip(F.coalesce(first_alias(r, "lang"), F.lit("und")))).alias("lang"),
        strip(first_alias(r, "conversation_id")).alias("_conv"),
        first_alias(r, "in_reply_to_post_id").alias("_reply"),
        first_alias(r, "quoted_post_id").alias("_quoted"),
        first_present(r, REFERENCES).alias("_refs"),
        F.when(F.arrays_overlap(F.json_object_keys(r), F.lit(ENTITIES)), F.coalesce(first_present(r, ENTITIES), F.lit("null"))).alias("_entities"),
    )
    base = base.withColumn("_time", parse_time(F.col("_at")))
    missing = lambda c: F.coalesce(strip(F.col(c)), F.lit("")) == ""
    # The reasons.
    reason = (
        F.when(missing("post_id"), "post_id is required")
        .when(missing("author_id"), F.concat(F.lit("post "), "post_id", F.lit(": author_id is required")))
        .when(missing("text_raw"), F.concat(F.lit("post "), "post_id", F.lit(": text is required")))
        .when(missing("_at"), "created_at is required")
        .when(F.col("_time").isNull(), "unsupported created_at value")
    )
    filled = lambda c: F.nullif(strip(F.col(c)), F.lit(""))
    return base.select(
        "post_id",
        "author_id",
        render_time(F.col("_time")).alias("created_at_utc"),
        "text_raw",
        normalise_text(F.col("text_raw"), urls, mentions).alias("text_train"),
        "lang",
        F.coalesce(filled("_conv"), F.col("post_id")).alias("conversation_id"),
        filled("_reply").alias("in_reply_to_post_id"),
        filled("_quoted").alias("quoted_post_id"),
        reference_labels(F.col("_refs"), F.col("text_raw"), F.col("_reply"), F.col("_quoted")).alias("reference_types"),
        entities_json(F.col("_entities")).alias("entities_json"),
        "source_ref",
        F.lit(version).alias("manifest_version"),
        F.array().cast("array<string>").alias("quality_flags"),
        reason.alias("reason"),
        "payload",
    )
