"""Registered queries of the core: name -> callable(spark, folder), and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from html.entities import html5
from zoneinfo import ZoneInfo, available_timezones

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as text_fn
from millrace.operators import dedup, filters, labels, normalise, overlap, prompts, schema_drift, stylometry, temporal_split, timestamps
from millrace.runtime import shipped, stash, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = shipped(f)
        if sql:
            ORACLES[name] = sql
        return f

    return register


# Fixed values: the names of JSON types here and in the comparison engine.
_JSON_KINDS = {"VARCHAR": "string", "BIGINT": "integer", "DOUBLE": "number", "BOOLEAN": "boolean", "OBJECT": "object"}
_JSON_KINDS |= {"ARRAY " + a: f"array of {b}s" for a, b in _JSON_KINDS.items()} | {"ARRAY UBIGINT": "array of integers"}

_P5 = r"""
WITH j AS (SELECT stream_id, file_no, CASE WHEN json_valid(p) AND p <> '' THEN p::JSON END AS j FROM (SELECT *, regexp_replace(payload, '^[\x{feff}\s]+', '') AS p FROM raw_records)),
k AS (SELECT stream_id, file_no, j, unnest(json_keys(j)) AS k FROM j WHERE json_type(j) = 'OBJECT'),
v AS (SELECT stream_id, file_no, k, json_extract(j, '$."' || k || '"') AS v FROM k),
t AS (SELECT stream_id, file_no, k, replace(lower(k), '_', '') AS c, CASE json_type(v) WHEN 'NULL' THEN NULL WHEN 'UBIGINT' THEN 'BIGINT'
  WHEN 'ARRAY' THEN 'ARRAY ' || json_type(v, '$[0]') ELSE json_type(v) END AS type FROM v),
n AS (SELECT DISTINCT replace(lower(alias_name), '_', '') AS c, field_name FROM field_aliases),
f AS (SELECT stream_id, file_no, field_name, list_sort(list(DISTINCT k)) AS keys, list_sort(list(DISTINCT type) FILTER (WHERE type IS NOT NULL)) AS types FROM t JOIN n USING (c) GROUP BY ALL),
files AS (SELECT DISTINCT stream_id, file_no FROM k),
pairs AS (SELECT a.stream_id, a.file_no FROM files a JOIN files b ON a.stream_id = b.stream_id AND a.file_no = b.file_no + 1),
now AS (SELECT f.* FROM f JOIN pairs USING (stream_id, file_no)),
old AS (SELECT f.stream_id, f.file_no + 1 AS file_no, field_name, keys, types FROM f JOIN pairs p ON p.stream_id = f.stream_id AND p.file_no = f.file_no + 1),
b AS (SELECT stream_id, file_no, field_name, o.keys AS k0, o.types AS t0, w.keys AS k1, w.types AS t1 FROM old o FULL JOIN now w USING (stream_id, file_no, field_name))
{select}"""
_P5_ROWS = """SELECT stream_id, file_no, field_name, 'added' AS change_kind FROM b WHERE k0 IS NULL
UNION ALL SELECT stream_id, file_no, field_name, 'removed' FROM b WHERE k1 IS NULL
UNION ALL SELECT stream_id, file_no, field_name, 'renamed' FROM b WHERE k0 <> k1
UNION ALL SELECT stream_id, file_no, field_name, 'type_changed' FROM b WHERE len(t0) > 0 AND len(t1) > 0 AND t0 <> t1"""


_P5_KIND = "list_sort(list_transform({}, lambda x: CASE x " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _JSON_KINDS.items()) + " END))"
_P5_CHANGES = f"""SELECT stream_id, file_no, field_name, 'added' AS change_kind, NULL AS before, array_to_string(k1, ',') AS after, 'alias' AS evidence FROM b WHERE k0 IS NULL
UNION ALL SELECT stream_id, file_no, field_name, 'removed', array_to_string(k0, ','), NULL, 'alias' FROM b WHERE k1 IS NULL
UNION ALL SELECT stream_id, file_no, field_name, 'renamed', array_to_string(k0, ','), array_to_string(k1, ','), 'alias' FROM b WHERE k0 <> k1
UNION ALL SELECT stream_id, file_no, field_name, 'type_changed', array_to_string({_P5_KIND.format('t0')}, ','), array_to_string({_P5_KIND.format('t1')}, ','), 'alias' FROM b WHERE len(t0) > 0 AND len(t1) > 0 AND t0 <> t1"""


@query("p5_found", _P5.replace("{select}", _P5_ROWS))
def p5_found(spark, d):
    return schema_drift.found_changes(table(spark, d, "raw_records"), table(spark, d, "field_aliases"))


@query("p5_changes", _P5.replace("{select}", _P5_CHANGES))
def p5_changes(spark, d):
    return schema_drift.match_versions(table(spark, d, "raw_records"), table(spark, d, "field_aliases"))


# Test data names every field of the alias table in every file and has no other key, so the fields are listed here.
_P5_FIELDS = "author_id client_app conversation_id created_at edit_count entities geo_note in_reply_to_post_id is_quote lang like_count post_id reference_types review_state text".split()
_LABELS_OF = r"""list_sort(list_distinct(list_filter(list_transform(CASE WHEN regexp_matches({0}, '^\s*\[') AND json_valid({0}) THEN list_transform(json_extract(CASE WHEN json_valid({0}) THEN {0} ELSE '[]' END, '$[*]'),
  lambda x: CASE WHEN json_type(x) = 'OBJECT' THEN json_extract_string(x, '$.type') ELSE json_extract_string(x, '$') END) ELSE string_split({0}, ',') END, lambda x: lower(trim(x))), lambda x: x <> '')))"""
_P5_POSTS = (
    r"""WITH j AS (SELECT *, CASE WHEN json_valid(p) AND p <> '' THEN p::JSON END AS j FROM (SELECT *, regexp_replace(payload, '^[\x{feff}\s]+', '') AS p FROM raw_records)),
n AS (SELECT field_name, replace(lower(alias_name), '_', '') AS c, row_number() OVER () AS pos FROM field_aliases),
k AS (SELECT record_id, j, unnest(json_keys(j)) AS k FROM j WHERE json_type(j) = 'OBJECT'),
e AS (SELECT record_id, k, json_extract_string(j, '$."' || k || '"') AS v, replace(lower(k), '_', '') AS c FROM k),
f AS (SELECT record_id, field_name, first(v ORDER BY pos, k) AS v FROM e JOIN n USING (c) WHERE v IS NOT NULL GROUP BY ALL),
o AS (SELECT record_id, """
    + ", ".join(f"max(v) FILTER (WHERE field_name = '{x}') AS {x}" for x in _P5_FIELDS)
    + """ FROM f GROUP BY record_id)
SELECT record_id, stream_id, file_no, source_row, coalesce(json_type(j) = 'OBJECT', false) AS readable, """
    + ", ".join(f"array_to_string({_LABELS_OF.replace('{0}', x)}, ',') AS {x}" if x == "reference_types" else x for x in _P5_FIELDS)
    + """, CASE WHEN json_type(j) = 'OBJECT' THEN '{}' END AS other_keys FROM j LEFT JOIN o USING (record_id)"""
)


@query("p5_posts", _P5_POSTS)
def p5_posts(spark, d):
    out = schema_drift.unify_posts(table(spark, d, "raw_records"), table(spark, d, "field_aliases"))
    return out.withColumns({"reference_types": F.array_join("reference_types", ","), "other_keys": F.to_json("other_keys")})


# SQL fragments shared by the comparison statements.
_FOLD = "replace(replace(lower({0}), 'ß', 'ss'), 'ς', 'σ')"
_TOKENS = "regexp_extract_all(" + _FOLD + r", '[\p{L}\p{N}_'']+|[!?]+')"
_STRIP = r"regexp_replace({0}, '^[\s\x{{85}}\x{{1c}}-\x{{1f}}\x{{0b}}\p{{Z}}]+|[\s\x{{85}}\x{{1c}}-\x{{1f}}\x{{0b}}\p{{Z}}]+$', '', 'g')"


def _t(expression: str) -> str:
    return _TOKENS.replace("{0}", expression)


def _strip_sql(expression: str) -> str:
    return _STRIP.replace("{{", "{").replace("}}", "}").replace("{0}", expression)


def _abbreviations() -> str:
    """VALUES (zone, abbreviation, offset in seconds) of all zones, read off the zone database; the latest use holds."""
    found = {}
    for zone in sorted(available_timezones()):
        info = ZoneInfo(zone)
        for year in range(1990, 2031):
            for month in (1, 7):
                t = datetime(year, month, 1, tzinfo=info)
                found[zone, t.tzname().lower()] = int(t.utcoffset().total_seconds())
    return ", ".join(f"('{z}', '{a}', {o})" for (z, a), o in found.items())


def _layout_sql() -> str:
    """The first shape that fits, laid out into its nine parts."""
    cases = []
    for kind, pattern, layout in timestamps.SHAPES:
        order = f"ord = '{kind}' AND " if kind else ""
        cases.append(f"WHEN {order}regexp_matches(s, '{pattern}') THEN regexp_replace(s, '{pattern}', '{layout.replace('$', chr(92))}')")
    return "CASE " + " ".join(cases) + " END"


_MONTH_SQL = "CASE " + " ".join(f"WHEN lower(p[2]) IN ('{m}', '{m[:3]}'{', ' + repr(m[:4]) if m == 'september' else ''}) THEN {i + 1}" for i, m in enumerate(timestamps.MONTHS)) + " END"
#: A local reading's instant is looked for this many seconds before the one that the zone library gives.
_BACK = "[0, 900, 1200, 1800, 2400, 2700, 3600, 5400, 7200, 10800]"
INSTANTS = rf"""
raw AS (SELECT source_row, post_id, created_at, {_strip_sql('created_at')} AS s, coalesce(home_zone, 'UTC') AS zone, lower(date_order) AS ord FROM synthetic_posts
  LEFT JOIN (SELECT feed_id, min(coalesce(home_zone, 'UTC')) AS home_zone, min(date_order) AS date_order FROM feeds GROUP BY feed_id) USING (feed_id)),
laid AS (SELECT *, string_split({_layout_sql()}, '|') AS p FROM raw),
part AS (SELECT *, try_cast(p[1] AS INT) + CASE WHEN length(p[1]) > 2 THEN 0 WHEN try_cast(p[1] AS INT) < 70 THEN 2000 ELSE 1900 END AS y, coalesce(try_cast(p[2] AS INT), {_MONTH_SQL}) AS m,
  try_cast(p[3] AS INT) AS d, try_cast(p[4] AS INT) AS h0, try_cast(p[5] AS INT) AS mi, CASE WHEN p[6] = '' THEN 0 ELSE try_cast(p[6] AS INT) END AS se,
  coalesce(try_cast(substr(rpad(p[7], 6, '0'), 1, 6) AS INT), 0) AS frac, lower(substr(p[8], 1, 1)) AS half, p[9] AS z FROM laid),
hour AS (SELECT *, CASE WHEN half = '' AND h0 < 24 THEN h0 WHEN half <> '' AND h0 BETWEEN 1 AND 12 THEN h0 % 12 + CASE WHEN half = 'p' THEN 12 ELSE 0 END END AS h FROM part),
clock AS (SELECT *, CASE WHEN mi < 60 AND se < 60 THEN try_strptime(printf('%04d-%02d-%02d', y, m, d), '%Y-%m-%d') + to_seconds(h * 3600 + mi * 60 + se) END AS t FROM hour),
guess AS (SELECT *, CASE WHEN z = '' THEN epoch(timezone(zone, t)) END AS g FROM clock),
near AS (SELECT *, list_filter(list_transform({_BACK}, lambda k: CAST(g - k AS BIGINT)), lambda x: timezone(zone, to_timestamp(x)) = t) AS hits FROM guess),
abbr(zone, z, off) AS (VALUES {_abbreviations()}),
offs AS (SELECT n.*, CASE WHEN lower(n.z) IN ('z', 'utc', 'gmt', 'ut') THEN 0
  WHEN regexp_matches(n.z, '^[+-]') THEN CASE WHEN coalesce(try_cast(substr(regexp_replace(n.z, '[^0-9]', '', 'g'), 3, 2) AS INT), 0) < 60 THEN
    CASE WHEN n.z[1] = '-' THEN -1 ELSE 1 END * (try_cast(n.z[2:3] AS INT) * 3600 + coalesce(try_cast(substr(regexp_replace(n.z, '[^0-9]', '', 'g'), 3, 2) AS INT), 0) * 60) END
  WHEN n.z <> '' THEN abbr.off END AS off FROM near n LEFT JOIN abbr ON abbr.zone = n.zone AND abbr.z = lower(n.z)),
instants AS (SELECT source_row, post_id, created_at, CASE
  WHEN regexp_matches(s, '^[+-]?\d{{1,14}}$') THEN CAST(s AS BIGINT) * CASE WHEN abs(CAST(s AS BIGINT)) < 100000000000 THEN 1000000 ELSE 1000 END
  WHEN z = '' THEN CAST(coalesce(list_min(hits), g) AS BIGINT) * 1000000 + frac ELSE CAST(epoch(t) - off AS BIGINT) * 1000000 + frac END AS utc_micros,
  CASE WHEN regexp_matches(s, '^[+-]?\d{{1,14}}$') THEN 'epoch' WHEN t IS NULL OR (z <> '' AND off IS NULL) OR z IS NULL THEN 'none' WHEN z <> '' THEN 'zoned'
    WHEN len(hits) > 1 THEN 'ambiguous' WHEN len(hits) = 0 THEN 'skipped' ELSE 'local' END AS reading FROM offs)"""


@query("p7_found", rf"WITH {INSTANTS} SELECT source_row, utc_micros FROM instants WHERE utc_micros IS NOT NULL AND NOT regexp_full_match(created_at, '\d{{4}}-\d\d-\d\dT\d\d:\d\d:\d\dZ')")
def p7_found(spark, d):
    return timestamps.noncanonical_instants(table(spark, d, "synthetic_posts"), table(spark, d, "feeds"))


@query("p7_instants", f"WITH {INSTANTS} SELECT source_row, utc_micros, reading FROM instants")
def p7_instants(spark, d):
    return timestamps.normalise_timestamps(table(spark, d, "synthetic_posts"), table(spark, d, "feeds"))


# --- the corpus engine's own operators -------------------------------------------------------------------------------


@query("doc_tokens", f"SELECT doc_id, CAST(len({_t('text')}) AS BIGINT) AS n_tokens, array_to_string({_t('text')}, ' ') AS fingerprint FROM documents WHERE text IS NOT NULL")
def doc_tokens(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    toks = text_fn.tokens(F.col("text"))
    return docs.select("doc_id", F.size(toks).cast("bigint").alias("n_tokens"), F.array_join(toks, " ").alias("fingerprint"))


_EXACT = f"""
WITH f AS (SELECT doc_id, array_to_string({_t('text')}, ' ') AS fp FROM documents WHERE text IS NOT NULL)
SELECT doc_id, CASE WHEN first <> doc_id THEN first END AS duplicate_of
FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY fp) AS first FROM f)"""


@query("exact_dedup", _EXACT)
def exact_dedup(spark, d):
    return dedup.exact_duplicates(table(spark, d, "documents"), "doc_id", "doc_id")


@query("exact_dedup_counts", f"SELECT count(*) AS n_rows, count(*) FILTER (WHERE duplicate_of IS NULL) AS n_kept, count(duplicate_of) AS n_rejected FROM ({_EXACT})")
def exact_dedup_counts(spark, d):
    out = dedup.exact_duplicates(table(spark, d, "documents"), "doc_id", "doc_id")
    return out.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("duplicate_of").isNull()).alias("n_kept"), F.count("duplicate_of").alias("n_rejected"))


_H = r"[ \t\x{0b}\x{0c}\r\x{1c}-\x{1f}\x{85}\p{Z}]*"
_SQUEEZE = _strip_sql(
    "regexp_replace("
    + _strip_sql(
        "regexp_replace(regexp_replace(regexp_replace(text, '\\r\\n?', chr(10), 'g'), '[ \\t\\x{0b}\\x{0c}]+', ' ', 'g'), '"
        + _H
        + "\\n"
        + _H
        + "', chr(10), 'g')"
    )
    + ", '\\n{3,}', chr(10) || chr(10), 'g')"
)


@query("squeeze_space", f"SELECT doc_id, {_SQUEEZE} AS squeezed FROM documents")
def squeeze_space(spark, d):
    return table(spark, d, "documents").select("doc_id", text_fn.squeeze_space(F.col("text")).alias("squeezed"))


def _entities() -> str:
    """VALUES (name, characters) of the named character references of HTML."""
    quote = lambda t: "'" + t.replace("'", "''") + "'"  # noqa: E731
    return ", ".join(f"({quote(n)}, {quote(v)})" for n, v in html5.items())


def _resolved(source: str) -> str:
    """CTE resolved(id, text): references of ``source`` (id, text) resolved and the text composed."""
    return rf"""
ref(n, v) AS (VALUES {_ENTITIES}),
split AS (SELECT id, unnest(x) AS t, generate_subscripts(x, 1) AS i FROM (SELECT id, regexp_extract_all(text, '&[^&]*|[^&]+') AS x FROM {source} WHERE contains(text, '&'))),
named AS (SELECT *, regexp_extract(t, '^&([^	
 <&#;]{{1,32}};?)', 1) AS n, regexp_extract(t, '^&#([0-9]+|[xX][0-9a-fA-F]+);?', 1) AS d FROM split),
whole AS (SELECT id, string_agg(CASE WHEN d <> '' THEN chr(CAST(CASE WHEN lower(d[1]) = 'x' THEN '0' || d ELSE d END AS INT)) || regexp_replace(t, '^&#([0-9]+|[xX][0-9a-fA-F]+);?', '')
  WHEN v IS NOT NULL THEN v || substr(t, 2 + length(n)) ELSE t END, '' ORDER BY i) AS text FROM named LEFT JOIN ref USING (n) GROUP BY id),
resolved AS (SELECT id, nfc_normalize(coalesce(w.text, s.text)) AS text FROM {source} s LEFT JOIN whole w USING (id)),
trained AS (SELECT id, {_TEXT_TRAIN} AS text_train FROM (SELECT id, {_SQUEEZE} AS text FROM resolved))"""


_ENTITIES = _entities()
_URL_SQL = r"regexp_replace(text, '(?i)https?://[^\s\x{0b}\x{85}\x{1c}-\x{1f}\p{Z}]+', '<URL>', 'g')"
_TEXT_TRAIN = r"regexp_replace(" + _URL_SQL + r", '(^|[^\p{L}\p{N}_])@[A-Za-z0-9_]+', '\1<USER>', 'g')"


@query("normalise_text", f"WITH src AS (SELECT doc_id AS id, text FROM documents), {_resolved('src')} SELECT id AS doc_id, text_train FROM trained")
def normalise_text(spark, d):
    return table(spark, d, "documents").select("doc_id", text_fn.normalise_text(F.col("text")).alias("text_train"))


@query(
    "placeholders",
    rf"SELECT source_row, {_URL_SQL} AS no_urls, regexp_replace({_URL_SQL}, '(^|[^\p{{L}}\p{{N}}_])@[A-Za-z0-9_]+', '\1<USER>', 'g') AS no_handles FROM synthetic_posts",
)
def placeholders(spark, d):
    urls = text_fn.replace_urls(F.col("text"))
    return table(spark, d, "synthetic_posts").select("source_row", urls.alias("no_urls"), text_fn.replace_mentions(urls).alias("no_handles"))


_REASON = rf"""
SELECT source_row, CASE
  WHEN NOT coalesce(lower({_strip_sql('lang')}) IN ('en', 'de'), false) THEN 'language_not_allowed:' || coalesce(lower({_strip_sql('lang')}), '')
  WHEN list_contains(refs, 'quoted') THEN 'reference_type_excluded:quoted'
  WHEN list_contains(refs, 'retweeted') THEN 'reference_type_excluded:retweeted'
  WHEN coalesce(length({_strip_sql(_TEXT_TRAIN)}), 0) < 12 THEN 'text_too_short'
  WHEN regexp_full_match({_strip_sql('text')}, '(?i)(https?://[^\s\x{{0b}}\x{{85}}\x{{1c}}-\x{{1f}}\p{{Z}}]+[\s\x{{0b}}\x{{85}}\x{{1c}}-\x{{1f}}\p{{Z}}]*)+') THEN 'link_only' END AS reason
FROM (SELECT *, list_transform(reference_types, lambda x: lower(x)) AS refs FROM synthetic_posts)"""


def _rejects(spark, d):
    posts = table(spark, d, "synthetic_posts").withColumns(
        {
            "lang": F.lower(text_fn.strip(F.col("lang"))),
            "reference_types": F.transform("reference_types", lambda x: F.lower(x)),
            "text_train": text_fn.replace_mentions(text_fn.replace_urls(F.col("text"))),
        }
    )
    reason = filters.reject_reason(["en", "de"], [], ["retweeted", "quoted"], 12, "text_train", "text")
    return posts.select("source_row", reason.alias("reason"))


@query("reject_reasons", _REASON)
def reject_reasons(spark, d):
    return _rejects(spark, d)


_AUTHORS = ["quillmark_desk", "author_00002", "author_00050"]


@query(
    "reject_authors",
    f"""SELECT source_row, CASE WHEN NOT coalesce(author_id IN ({', '.join(repr(a) for a in _AUTHORS)}), false) THEN 'author_not_allowed:' || coalesce(author_id, '')
  WHEN coalesce(length({_strip_sql('text')}), 0) < 5 THEN 'text_too_short'
  WHEN regexp_full_match({_strip_sql('text')}, '(?i)(https?://[^\\s\\x{{0b}}\\x{{85}}\\x{{1c}}-\\x{{1f}}\\p{{Z}}]+[\\s\\x{{0b}}\\x{{85}}\\x{{1c}}-\\x{{1f}}\\p{{Z}}]*)+') THEN 'link_only' END AS reason FROM synthetic_posts""",
)
def reject_authors(spark, d):
    reason = filters.reject_reason(authors=_AUTHORS, text="text", raw="text")
    return table(spark, d, "synthetic_posts").select("source_row", reason.alias("reason"))


@query("stage_counts", f"SELECT 'source' AS stage, count(*) AS n FROM synthetic_posts UNION ALL SELECT 'kept', count(*) FROM ({_REASON}) WHERE reason IS NULL UNION ALL SELECT 'rejected', count(*) FROM ({_REASON}) WHERE reason IS NOT NULL")
def stage_counts(spark, d):
    out = _rejects(spark, d)
    kept, rejected = filters.split_by_reason(out)
    return filters.stage_counts({"source": table(spark, d, "synthetic_posts"), "kept": kept, "rejected": rejected})


def _hits(k: str) -> str:
    return f"CAST((length(l) - length(replace(l, '{k}', ''))) / {len(k)} AS INT)"


_SCORES = ", ".join(f"{{'score': {' + '.join(_hits(k) for k in keys)}, 'topic': '{name}'}}" for name, keys in labels.TOPICS.items())
_INTENT = " ".join("WHEN " + " OR ".join(f"contains(l, '{w}')" for w in words) + f" THEN '{name}'" for name, words in labels.INTENTS.items())
_LETTERS, _UPPERS = (rf"length(regexp_extract_all(text, '\p{{{c}}}'))" for c in ("L", "Lu"))


def _word_in(words: str) -> str:
    return r"regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])(" + words + r")([^\p{L}\p{N}_]|$)')"


_LABELS = rf"""
SELECT doc_id,
  CASE WHEN best.score > 0 THEN best.topic ELSE 'other' END AS topic,
  CASE {_INTENT} WHEN contains(text, '?') THEN 'question_or_challenge' ELSE 'comment' END AS intent,
  coalesce(nullif(concat_ws(',', CASE WHEN contains(text, '!') THEN 'emphatic' END, CASE WHEN contains(text, '?') THEN 'rhetorical' END,
    CASE WHEN {_LETTERS} > 0 AND {_UPPERS} / {_LETTERS} >= 0.15 THEN 'uppercase_emphasis' END,
    CASE WHEN {_word_in(labels.INTENSIFIERS)} THEN 'intensifier' END,
    CASE WHEN {_word_in(labels.CONFRONTING)} THEN 'confrontational' END), ''), 'neutral') AS tone_tags,
  CASE WHEN words <= 8 THEN 'very_short' WHEN words <= 20 THEN 'short' WHEN words <= 40 THEN 'medium' ELSE 'long' END AS length_bucket,
  strftime(created_at AT TIME ZONE 'UTC', '%Y-%m') AS period_bucket
FROM (SELECT *, list_max([{_SCORES}]) AS best FROM (
  SELECT *, lower(text) AS l, length(regexp_extract_all(text, '[^\s\x{{0b}}\x{{85}}\x{{1c}}-\x{{1f}}\p{{Z}}]+')) AS words FROM documents WHERE text IS NOT NULL))"""


@query("labels", _LABELS)
def label_documents(spark, d):
    docs = table(spark, d, "documents").where("text is not null").withColumn("created", normalise.render_time(F.col("created_at")))
    out = docs.select("doc_id", *[c.alias(n) for n, c in labels.label_columns("text", "created").items()])
    return out.withColumn("tone_tags", F.array_join("tone_tags", ","))


def _count(pattern: str) -> str:
    return f"length(regexp_extract_all(text, '{pattern}'))"


_W = r"\p{L}\p{N}_"
_FEATURES = {
    "characters": "CAST(length(text) AS DOUBLE)",
    "words": f"CAST({_count('[' + _W + chr(39) * 2 + ']+')} AS DOUBLE)",
    "sentences": f"CAST(greatest(1, {_count('[.!?]+')}) AS DOUBLE)",
    "uppercase_ratio": f"CASE WHEN {_LETTERS} > 0 THEN {_UPPERS} / {_LETTERS} ELSE 0.0 END",
    "exclamations_per_100_chars": f"{_count('!')} * 100.0 / greatest(1, length(text))",
    "questions_per_100_chars": f"{_count('[?]')} * 100.0 / greatest(1, length(text))",
    "hashtags_per_post": f"CAST({_count('(?:^|[^' + _W + '])#[' + _W + ']+')} AS DOUBLE)",
    "mentions_per_post": f"CAST({_count('(?:^|[^' + _W + '])@[' + _W + ']+')} AS DOUBLE)",
    "repeated_punctuation_per_post": f"CAST({_count('!!+|[?][?]+')} AS DOUBLE)",
}
_FEATURE_LIST = ", ".join(f"round({x}, 6) AS {n}" for n, x in _FEATURES.items())
_PROFILE_LIST = ", ".join(f"round(avg({x}), 6) AS {n}" for n, x in _FEATURES.items())


@query("style_features", f"SELECT doc_id, {_FEATURE_LIST} FROM documents WHERE text IS NOT NULL")
def style_features(spark, d):
    docs = table(spark, d, "documents").where("text is not null")
    return docs.select("doc_id", *[F.round(c, 6).alias(n) for n, c in stylometry.style_features(F.col("text")).items()])


@query("style_profile", f"SELECT source, {_PROFILE_LIST} FROM documents WHERE text IS NOT NULL GROUP BY source")
def style_profile(spark, d):
    out = stylometry.corpus_profile(table(spark, d, "documents"), by=["source"])
    return out.select("source", *[F.round(n, 6).alias(n) for n in stylometry.SCALES])


_RAW_PROFILE = ", ".join(f"avg({x}) AS {n}" for n, x in _FEATURES.items())
_DISTANCE = " + ".join(f"least(3.0, abs(a.{n} - b.{n}) / {s})" for n, s in stylometry.SCALES.items())
_DISTANCE_SQL = f"SELECT round(({_DISTANCE}) / {len(stylometry.SCALES)}, 6) AS distance FROM (SELECT {_RAW_PROFILE} FROM synthetic_posts WHERE text IS NOT NULL) a, (SELECT {_RAW_PROFILE} FROM documents WHERE text IS NOT NULL) b"


@query("style_distance", _DISTANCE_SQL)
def style_distance(spark, d):
    a, b = (stylometry.corpus_profile(table(spark, d, t)) for t in ("synthetic_posts", "documents"))
    return stylometry.profile_distance(a, b).select(F.round("distance", 6).alias("distance"))


def _gram_sql(n: int, name: str) -> str:
    return (
        f"SELECT unnest(list_transform(range(1, len(t) - {n} + 2), lambda i: array_to_string(t[i:i + {n} - 1], ' '))) AS g "
        f"FROM (SELECT {_t('text')} AS t FROM {name} WHERE text IS NOT NULL)"
    )


_DISTINCT = " UNION ALL ".join(
    f"SELECT {n} AS n, count(*) AS n_total, count(DISTINCT g) AS n_distinct, round(CASE WHEN count(*) > 0 THEN count(DISTINCT g) / count(*) ELSE 0 END, 6) AS ratio FROM ({_gram_sql(n, 'documents')})"
    for n in (2, 3)
)


@query("distinct_n", _DISTINCT)
def distinct_n(spark, d):
    return stylometry.distinct_n(table(spark, d, "documents")).withColumn("ratio", F.round("ratio", 6))


_SHINGLES = f"""
s AS (SELECT doc_id, list_distinct(CASE WHEN len(t) = 0 THEN ['<EMPTY>'] WHEN len(t) < 3 THEN [array_to_string(t, ' ')]
        ELSE list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], ' ')) END) AS g
      FROM (SELECT doc_id, {_t('text')} AS t FROM documents WHERE text IS NOT NULL)),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared, any_value(a.n + b.n) - count(*) AS either
      FROM e a JOIN e b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL
      HAVING count(*) >= 0.72 * (any_value(a.n + b.n) - count(*)))"""


@query("near_dup_pairs", f"WITH {_SHINGLES} SELECT a, b, shared, CAST(either AS BIGINT) AS \"either\" FROM p")
def near_dup_pairs(spark, d):
    return dedup.near_pairs(table(spark, d, "documents"), "doc_id").withColumn("either", F.col("either").cast("bigint"))


_CLUSTERS = f"""
WITH RECURSIVE {_SHINGLES},
edge AS (SELECT a AS u, b AS v FROM p UNION SELECT b, a FROM p),
reach(u, v) AS (SELECT doc_id, doc_id FROM s UNION SELECT r.u, edge.v FROM reach r JOIN edge ON r.v = edge.u),
comp AS (SELECT u AS doc_id, min(v) AS c FROM reach GROUP BY u),
named AS (SELECT c, substr(sha256(string_agg(CAST(doc_id AS VARCHAR), chr(0) ORDER BY CAST(doc_id AS VARCHAR))), 1, 16) AS cluster_id, count(*) AS cluster_size FROM comp GROUP BY c),
clustered AS (SELECT doc_id, cluster_id, cluster_size FROM comp JOIN named USING (c))"""


@query("near_dup_clusters", f"{_CLUSTERS} SELECT * FROM clustered")
def near_dup_clusters(spark, d):
    return dedup.near_clusters(table(spark, d, "documents"), "doc_id")


@query(
    "near_dup_cap",
    f"""{_CLUSTERS}, placed AS (SELECT c.doc_id, cluster_id, cluster_size, row_number() OVER (PARTITION BY cluster_id ORDER BY created_at, c.doc_id) - 1 AS pos FROM clustered c JOIN documents d ON c.doc_id = d.doc_id)
SELECT doc_id, cluster_id, cluster_size <= 3 OR pos IN (0, cluster_size - 1, CAST(round_even((cluster_size - 1) / 2, 0) AS BIGINT)) AS kept FROM placed""",
)
def near_dup_cap(spark, d):
    docs = table(spark, d, "documents")
    out = dedup.near_clusters(docs, "doc_id").join(docs.select("doc_id", "created_at"), "doc_id")
    return dedup.cap_clusters(out, "doc_id", "created_at").select("doc_id", "cluster_id", "kept")


# The verified pairs; the approximate mode meets all of them on the test tables.
@query("near_dup_lsh", f"WITH {_SHINGLES} SELECT a, b FROM p")
def near_dup_lsh(spark, d):
    return dedup.lsh_pairs(table(spark, d, "documents"), "doc_id").select("a", "b")


def _grams_sql(side: str, name: str, key: str) -> str:
    return f"""
g{side} AS (SELECT id, t, list_transform(CASE WHEN len(t) = 0 THEN []::BIGINT[] ELSE range(1, greatest(len(t) - 4, 1) + 1) END, lambda i: array_to_string(t[i:i + 4], ' ')) AS g
  FROM (SELECT {key} AS id, {_t('text')} AS t FROM {name} WHERE text IS NOT NULL)),
x{side} AS (SELECT id, unnest(range(1, len(g) + 1)) AS p, unnest(g) AS h FROM g{side}),
n{side} AS (SELECT id, array_to_string(t, ' ') AS whole, len(t) AS tokens, len(list_distinct(g)) AS grams FROM g{side})"""


_OVERLAP = f"""
WITH {_grams_sql('a', 'synthetic_posts', 'source_row')}, {_grams_sql('b', 'documents', 'doc_id')},
hit AS (SELECT xa.id AS gen, xb.id AS train, xa.p AS i, xa.p - xb.p AS d, xa.h FROM xa JOIN xb ON xa.h = xb.h),
shared AS (SELECT gen, train, count(DISTINCT h) AS k FROM hit GROUP BY ALL),
run AS (SELECT gen, train, max(n) AS run FROM (SELECT gen, train, d, i - r AS k, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY gen, train, d ORDER BY i) AS r FROM hit) GROUP BY ALL) GROUP BY ALL),
same AS (SELECT na.id AS gen, nb.id AS train FROM na JOIN nb ON na.whole = nb.whole),
cand AS (SELECT gen, train FROM shared UNION SELECT gen, train FROM same),
m AS (SELECT c.gen, c.train, same.gen IS NOT NULL AS exact,
  CAST(CASE WHEN same.gen IS NOT NULL THEN na.tokens WHEN least(na.tokens, nb.tokens) < 5 THEN least(na.tokens, nb.tokens) ELSE run + 4 END AS BIGINT) AS span,
  CASE WHEN na.grams + nb.grams - coalesce(k, 0) > 0 THEN coalesce(k, 0) / (na.grams + nb.grams - coalesce(k, 0)) ELSE 1.0 END AS jaccard
  FROM cand c LEFT JOIN shared s ON c.gen = s.gen AND c.train = s.train LEFT JOIN run r ON c.gen = r.gen AND c.train = r.train
  LEFT JOIN same ON c.gen = same.gen AND c.train = same.train JOIN na ON na.id = c.gen JOIN nb ON nb.id = c.train),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY gen ORDER BY exact DESC, span DESC, jaccard DESC, train) AS r FROM m) WHERE r = 1),
matched AS (SELECT na.id AS gen, train, coalesce(exact, false) AS exact, coalesce(span, 0) AS span, coalesce(jaccard, 0.0) AS jaccard FROM na LEFT JOIN best ON best.gen = na.id),
total AS (SELECT count(*) AS generated_count, count(*) FILTER (WHERE exact) AS exact_match_count, count(*) FILTER (WHERE f) AS flagged_count, avg(CAST(f AS INT)) AS flagged_rate, max(span) AS max_span, max(jaccard) AS max_jaccard
  FROM (SELECT *, exact OR span >= 20 OR jaccard >= 0.5 AS f FROM matched))"""


def _candidates(spark, d):
    return overlap.overlap_candidates(table(spark, d, "synthetic_posts"), table(spark, d, "documents"), "source_row", "doc_id")


def _matches(spark, d):
    return overlap.find_best_matches(table(spark, d, "synthetic_posts"), table(spark, d, "documents"), "source_row", "doc_id")


@query("overlap_candidates", f"{_OVERLAP} SELECT gen, train, exact, span, round(jaccard, 6) AS jaccard FROM m")
def overlap_candidates(spark, d):
    # What round() gives in SQL, without the decimal of each row that Spark's goes through.
    return _candidates(spark, d).select("gen", "train", "exact", "span", (F.floor(F.col("jaccard") * 1e6 + 0.5) / 1e6).alias("jaccard"))


@query("overlap_best_match", f"{_OVERLAP} SELECT gen, train, exact, span, round(jaccard, 6) AS jaccard FROM matched")
def overlap_best_match(spark, d):
    return _matches(spark, d).withColumn("jaccard", F.round("jaccard", 6))


@query("overlap_summary", f"{_OVERLAP} SELECT generated_count, exact_match_count, flagged_count, round(flagged_rate, 6) AS flagged_rate, max_span, round(max_jaccard, 6) AS max_jaccard FROM total")
def overlap_summary(spark, d):
    out = overlap.overlap_summary(_matches(spark, d))
    return out.withColumns({c: F.round(c, 6) for c in ("flagged_rate", "max_jaccard")})


def _metrics(spark, d):
    summary = overlap.overlap_summary(_matches(spark, d))
    posts, docs = table(spark, d, "synthetic_posts"), table(spark, d, "documents")
    distance = stylometry.profile_distance(stylometry.corpus_profile(posts), stylometry.corpus_profile(docs))
    two = stylometry.distinct_n(posts, (2,)).select(F.col("ratio").alias("distinct_2"))
    one = F.lit(1)
    frames = [x.withColumn("_one", one) for x in (summary, distance, two)]
    return frames[0].join(frames[1], "_one").join(frames[2], "_one").drop("_one")


_TWO = f"SELECT count(DISTINCT g) / count(*) AS distinct_2 FROM ({_gram_sql(2, 'synthetic_posts')})"


@query(
    "evaluation_gate",
    f"""{_OVERLAP}, dist AS ({_DISTANCE_SQL}), two AS ({_TWO}),
c AS (SELECT distance <= 0.45 AS ok_distance, distinct_2 >= 0.2 AS ok_distinct_2, flagged_rate <= 0.005 AS ok_flagged_rate, exact_match_count = 0 AS ok_exact FROM total, dist, two)
SELECT *, ok_distance AND ok_distinct_2 AND ok_flagged_rate AND ok_exact AS passed FROM c""",
)
def evaluation_gate(spark, d):
    return overlap.evaluation_gate(_metrics(spark, d))


_SPLIT = f"""{_CLUSTERS},
grp AS (SELECT doc_id, coalesce(c, doc_id) AS "group" FROM documents LEFT JOIN comp USING (doc_id)),
g AS (SELECT "group", min(created_at) AS began, count(*) AS n FROM grp JOIN documents USING (doc_id) GROUP BY "group"),
o AS (SELECT *, sum(n) OVER w - n AS before, row_number() OVER w - 1 AS i, count(*) OVER () AS gs, sum(n) OVER () AS total FROM g WINDOW w AS (ORDER BY began NULLS FIRST, "group")),
s2 AS (SELECT *, CASE WHEN gs >= 3 AND i = 0 THEN 'train' WHEN gs >= 3 AND i = gs - 1 THEN 'test' WHEN (before + n / 2) / total < 0.8 THEN 'train' WHEN (before + n / 2) / total < 0.8 + 0.1 THEN 'validation' ELSE 'test' END AS split FROM o)"""


def _split(spark, d):
    """The documents with their whole group key, the near-duplicate cluster, and their split."""
    docs = table(spark, d, "documents")
    near = dedup.clusters_with_copies(docs, "doc_id", "doc_id").withColumnRenamed("cluster_id", "near_dup_cluster_id")
    keyed = stash(docs.select("doc_id", "created_at", "author_id").join(near, "doc_id", "left"), "keyed")
    return keyed, temporal_split.grouped_temporal_split(keyed, "doc_id", "created_at", ["near_dup_cluster_id"])


@query("temporal_split", f'{_SPLIT} SELECT doc_id, "group", split FROM grp JOIN s2 USING ("group")')
def split_documents(spark, d):
    return _split(spark, d)[1]


@query("split_counts", f'{_SPLIT} SELECT split, count(*) AS n FROM grp JOIN s2 USING ("group") GROUP BY split')
def split_counts(spark, d):
    return _split(spark, d)[1].groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query(
    "leakage_check",
    f"""{_SPLIT}, t AS (SELECT doc_id, split, author_id, "group" FROM grp JOIN s2 USING ("group") JOIN documents USING (doc_id))
SELECT 'near_dup_cluster_id' AS field, CAST("group" AS VARCHAR) AS value, count(DISTINCT split) AS n_splits FROM t GROUP BY "group" HAVING count(DISTINCT split) > 1
UNION ALL SELECT 'author_id', author_id, count(DISTINCT split) FROM t WHERE author_id <> '' GROUP BY author_id HAVING count(DISTINCT split) > 1""",
)
def leakage_check(spark, d):
    """Near-duplicate clusters are never divided; authors, who are no group key here, are."""
    keyed, split = _split(spark, d)
    return temporal_split.leaking_groups(split.join(keyed, "doc_id"), ["near_dup_cluster_id", "author_id"])


GROUP_KEYS = ["conversation_id", "near_dup_cluster_id"]


def _post_split(spark, d):
    """The posts' whole group keys, and their split."""
    posts = table(spark, d, "synthetic_posts")
    at = timestamps.normalise_timestamps(posts, table(spark, d, "feeds")).select("source_row", "utc_micros")
    near = dedup.clusters_with_copies(posts, "source_row", "source_row").withColumnRenamed("cluster_id", "near_dup_cluster_id")
    keyed = posts.select("source_row", F.lower(text_fn.strip(F.col("conversation_id"))).alias("conversation_id"))
    keyed = stash(keyed.join(at, "source_row").join(near, "source_row", "left"), "keyed")
    return keyed, temporal_split.grouped_temporal_split(keyed, "source_row", "utc_micros", GROUP_KEYS)


@query("post_split")
def post_split(spark, d):
    return _post_split(spark, d)[1]


@query("post_leakage")
def post_leakage(spark, d):
    """(field, n_values, n_leaking) of each group key: its values, and those found in more than one split."""
    keyed, split = _post_split(spark, d)
    placed = stash(split.join(keyed, "source_row"), "placed")
    leaking = temporal_split.leaking_groups(placed, GROUP_KEYS).groupBy("field").agg(F.count(F.lit(1)).alias("n_leaking"))
    values = placed.select(F.explode(F.array(*[F.struct(F.lit(k).alias("field"), F.col(k).alias("value")) for k in GROUP_KEYS])).alias("x"))
    values = values.select("x.*").where("value <> ''").groupBy("field").agg(F.count_distinct("value").alias("n_values"))
    return values.join(leaking, "field", "left").select("field", "n_values", F.coalesce("n_leaking", F.lit(0)).alias("n_leaking"))


@query(
    "alias_coalesce",
    "SELECT record_id, "
    + ", ".join(
        "coalesce(" + ", ".join(f"nullif(json_extract_string(j, '$.{a}'), '')" for a in normalise.ALIASES[f]) + f") AS {f}"
        for f in ("post_id", "author_id", "text", "lang", "conversation_id")
    )
    + r" FROM (SELECT record_id, CASE WHEN json_valid(p) THEN p::JSON END AS j FROM (SELECT record_id, regexp_replace(payload, '^\x{feff}', '') AS p FROM raw_records))",
)
def alias_coalesce(spark, d):
    text = F.regexp_replace("payload", r"^\x{feff}", "")
    record = F.when(F.try_parse_json(text).isNotNull(), text)
    raw = table(spark, d, "raw_records").select("record_id", record.alias("_r"))
    return raw.select("record_id", *[normalise.first_alias(F.col("_r"), f).alias(f) for f in ("post_id", "author_id", "text", "lang", "conversation_id")])


@query(
    "raw_envelope",
    r"SELECT file_name || '#row=' || source_row AS source_ref, payload, coalesce(json_valid(p) AND json_type(CASE WHEN json_valid(p) THEN p ELSE 'null' END) = 'OBJECT', false) AS readable FROM (SELECT *, regexp_replace(payload, '^\x{feff}', '') AS p FROM raw_records)",
)
def raw_envelope(spark, d):
    ok = F.coalesce(schema_drift.readable(F.col("payload")).isNotNull(), F.lit(False))
    ref = F.concat("file_name", F.lit("#row="), "source_row")
    return table(spark, d, "raw_records").select(ref.alias("source_ref"), "payload", ok.alias("readable"))


_S = _strip_sql("created_at")
_TIME_CASE = rf"""CASE
  WHEN regexp_full_match(s, '\d{{4}}-\d\d-\d\d') THEN try_strptime(s, '%Y-%m-%d')
  WHEN regexp_full_match(s, '\d{{4}}-\d\d-\d\d[Tt ]\d\d:\d\d(:\d\d([.,]\d{{1,9}})?)?(Z|[+-]\d\d:?\d\d)?') THEN
    try_strptime(replace(substr(s, 1, 10) || ' ' || regexp_extract(s, '[Tt ](\d\d:\d\d)', 1) || coalesce(nullif(regexp_extract(s, '[Tt ]\d\d:\d\d(:\d\d)', 1), ''), ':00'), 't', 'T'), '%Y-%m-%d %H:%M:%S')
    + to_microseconds(CAST(substr(rpad(regexp_extract(s, '[.,](\d+)', 1), 6, '0'), 1, 6) AS INT))
    - to_minutes(coalesce(CASE WHEN regexp_matches(s, '-\d\d:?\d\d$') AND regexp_matches(s, '[Tt ].*-\d\d:?\d\d$') THEN -1 ELSE 1 END * (try_cast(regexp_extract(s, '[Tt ].*[+-](\d\d):?(\d\d)$', 1) AS INT) * 60 + try_cast(regexp_extract(s, '[Tt ].*[+-](\d\d):?(\d\d)$', 2) AS INT)), 0))
  WHEN regexp_full_match(s, '\d{{8}}[Tt]\d{{6}}Z?') THEN try_strptime(replace(substr(s, 1, 15), 't', 'T'), '%Y%m%dT%H%M%S')
  WHEN regexp_full_match(s, '(Mon|Tue|Wed|Thu|Fri|Sat|Sun) (Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec) \d\d? \d\d:\d\d:\d\d [+-]\d{{4}} \d{{4}}') THEN
    try_strptime(substr(s, 5, length(s) - 14) || right(s, 4), '%b %d %H:%M:%S %Y')
    - to_minutes(CASE WHEN s[-10] = '-' THEN -1 ELSE 1 END * (CAST(s[-9:-8] AS INT) * 60 + CAST(s[-7:-6] AS INT))) END"""
_TIME = f"SELECT source_row, epoch_us({_TIME_CASE}) AS utc_micros FROM (SELECT source_row, {_S} AS s FROM synthetic_posts)"


@query("timestamp_parse", _TIME)
def timestamp_parse(spark, d):
    at = normalise.parse_time(F.col("created_at"))
    return table(spark, d, "synthetic_posts").select("source_row", F.unix_micros(at).alias("utc_micros"))


@query(
    "reference_types",
    r"""SELECT source_row, array_to_string(list_sort(list_distinct(list_concat(coalesce(list_filter(list_transform(reference_types, lambda x: lower(trim(x))), lambda x: x <> ''), []),
  list_filter([CASE WHEN regexp_matches(text, '^[\s\x{0b}\p{Z}]*RT @') THEN 'retweeted' END, CASE WHEN in_reply_to_post_id IS NOT NULL THEN 'replied_to' END], lambda x: x IS NOT NULL)))), ',') AS labels FROM synthetic_posts""",
)
def reference_types(spark, d):
    labels_ = normalise.reference_labels(F.to_json("reference_types"), F.col("text"), F.col("in_reply_to_post_id"), F.lit(None).cast("string"))
    return table(spark, d, "synthetic_posts").select("source_row", F.array_join(labels_, ",").alias("labels"))


def _alias_sql(field: str) -> str:
    return "coalesce(" + ", ".join(f"nullif(json_extract_string(j, '$.{a}'), '')" for a in normalise.ALIASES[field]) + ")"


def _present_sql(names: list[str]) -> str:
    """The value under the first of ``names`` that is there, a JSON null included; null if none is."""
    return "CASE " + " ".join(f"WHEN list_contains(json_keys(j), '{n}') THEN json_extract(j, '$.{n}')" for n in names) + " END"


_NORMALISED = rf"""
WITH j AS (SELECT record_id AS id, file_name || '#row=' || source_row AS source_ref, p AS payload, CASE WHEN json_valid(p) AND json_type(CASE WHEN json_valid(p) THEN p ELSE 'null' END) = 'OBJECT' THEN p::JSON ELSE '{{}}'::JSON END AS j
  FROM (SELECT *, regexp_replace(payload, '^\x{{feff}}', '') AS p FROM raw_records)),
v AS (SELECT id, source_ref, payload, {_strip_sql(_alias_sql('post_id'))} AS post_id, {_strip_sql(_alias_sql('author_id'))} AS author_id, {_alias_sql('text')} AS text, {_alias_sql('created_at')} AS created_at,
  lower({_strip_sql("coalesce(" + _alias_sql('lang') + ", 'und')")}) AS lang, nullif({_strip_sql(_alias_sql('conversation_id'))}, '') AS conv, {_alias_sql('in_reply_to_post_id')} AS reply, {_alias_sql('quoted_post_id')} AS quoted,
  json_extract_string({_present_sql(normalise.REFERENCES)}, '$') AS refs, {_present_sql(normalise.ENTITIES)} AS ent FROM j),
t AS (SELECT *, {_TIME_CASE} AS made FROM (SELECT *, {_S} AS s FROM v)),
{_resolved('v')}
SELECT post_id, author_id, strftime(made, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(made) % 1000000 <> 0 THEN strftime(made, '.%f') ELSE '' END || 'Z' AS created_at_utc, text AS text_raw, text_train, lang,
  coalesce(conv, post_id) AS conversation_id, nullif({_strip_sql('reply')}, '') AS in_reply_to_post_id, nullif({_strip_sql('quoted')}, '') AS quoted_post_id,
  array_to_string(list_sort(list_distinct(list_concat(coalesce({_LABELS_OF.replace('{0}', 'refs')}, []), list_filter([CASE WHEN regexp_matches(text, '^[\s\x{{0b}}\p{{Z}}]*RT @') THEN 'retweeted' END,
    CASE WHEN reply IS NOT NULL THEN 'replied_to' END, CASE WHEN quoted IS NOT NULL THEN 'quoted' END], lambda x: x IS NOT NULL)))), ',') AS reference_types,
  CASE WHEN ent IS NULL THEN '{{}}' WHEN json_type(ent) = 'OBJECT' THEN CAST(ent AS VARCHAR) ELSE '{{"value":' || CAST(ent AS VARCHAR) || '}}' END AS entities_json,
  source_ref, 'none' AS manifest_version, '' AS quality_flags,
  CASE WHEN coalesce(post_id, '') = '' THEN 'post_id is required' WHEN coalesce(author_id, '') = '' THEN 'post ' || post_id || ': author_id is required'
    WHEN coalesce({_strip_sql('text')}, '') = '' THEN 'post ' || post_id || ': text is required' WHEN coalesce(s, '') = '' THEN 'created_at is required' WHEN made IS NULL THEN 'unsupported created_at value' END AS reason, payload
FROM t JOIN trained USING (id)"""


@query("normalised_posts", _NORMALISED)
def normalised_posts(spark, d):
    raw = table(spark, d, "raw_records").select(
        F.concat("file_name", F.lit("#row="), "source_row").alias("source_ref"), F.regexp_replace("payload", r"^\x{feff}", "").alias("payload")
    )
    out = normalise.normalise_posts(raw)
    return out.withColumns({c: F.array_join(c, ",") for c in ("reference_types", "quality_flags")})


_SYSTEM, _CONTEXT = "Write a short post in the configured style.", "historical/general"


@query(
    "sft_records",
    f"""SELECT doc_id, 'Topic: ' || topic || chr(10) || 'Intent: ' || intent || chr(10) || 'Length: ' || length_bucket || chr(10) || 'Time context: {_CONTEXT}' AS user_prompt,
  text AS completion, 2 AS n_messages FROM ({_LABELS}) JOIN documents USING (doc_id)""",
)
def sft_records(spark, d):
    docs = table(spark, d, "documents").where("text is not null").withColumn("created", normalise.render_time(F.col("created_at")))
    docs = docs.withColumns(labels.label_columns("text", "created"))
    out = docs.select("doc_id", prompts.prompt(_SYSTEM, _CONTEXT).alias("p"), prompts.completion("text").alias("c"))
    return out.select("doc_id", F.col("p")[1]["content"].alias("user_prompt"), F.element_at("c", -1)["content"].alias("completion"), F.size("p").alias("n_messages"))


_RULES = {"deadline": r"(?i)\b(today|tonight|deadline)\b", "numbers": r"[0-9]{3,}", "question": r"[?]"}


@query(
    "first_rule",
    "SELECT request_id, CASE " + " ".join(f"WHEN regexp_matches(t, '{p}') THEN '{n}'" for n, p in _RULES.items()) + " END AS rule FROM (SELECT request_id, concat_ws(chr(10), topic, intent, historical_context) AS t FROM generation_requests)",
)
def first_rule(spark, d):
    text = F.concat_ws("\n", "topic", "intent", "historical_context")
    return table(spark, d, "generation_requests").select("request_id", filters.first_rule(text, _RULES).alias("rule"))


_INTENTS, _LENGTHS = ["announce", "reply", "comment", "question"], ["very_short", "short", "medium", "long"]


def _in_sql(column: str, values: list[str]) -> str:
    return f"CASE WHEN NOT coalesce({column} IN ({', '.join(repr(v) for v in values)}), false) THEN '{column}' END"


@query(
    "request_bounds",
    f"""SELECT request_id, concat_ws(',', CASE WHEN NOT length(coalesce(topic, '')) BETWEEN 2 AND 200 THEN 'topic' END,
  CASE WHEN NOT length(coalesce(historical_context, '')) BETWEEN 0 AND 300 THEN 'historical_context' END, {_in_sql('intent', _INTENTS)}, {_in_sql('target_length', _LENGTHS)}) AS failures FROM generation_requests""",
)
def request_bounds(spark, d):
    found = filters.request_failures({"topic": (2, 200), "historical_context": (0, 300)}, {"intent": _INTENTS, "target_length": _LENGTHS})
    return table(spark, d, "generation_requests").select("request_id", F.array_join(found, ",").alias("failures"))


@query("sample_sizes", "SELECT source, count(*) AS n, CAST(least(count(*), greatest(20, ceil(count(*) * 0.1))) AS BIGINT) AS n_sample FROM documents GROUP BY source")
def sample_sizes(spark, d):
    counts = table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("n_sample", filters.sample_size(F.col("n"), 20))
