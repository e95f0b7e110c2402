"""Registered queries of the llm subpackage."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import copies, languages, lookalikes, near_copies, packing, spans, splits, tokenization
from millrace.plans import queries as core
from millrace.runtime import shipped, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(f):
        QUERIES[name] = shipped(f)
        if sql:
            ORACLES[name] = sql
        return f

    return register


# SQL fragments shared by the comparison statements: the folded text, its letters and digits, the fields in order.
_FOLDED = "replace(replace(lower({0}), 'ß', 'ss'), 'ς', 'σ')"
_PLAIN = "regexp_replace(" + _FOLDED + r", '[^\p{L}\p{N}]+', '', 'g')"
_FORMS = (
    "forms AS (SELECT *, CASE WHEN len(parts) >= 2 AND len(list_filter(parts, lambda p: NOT regexp_matches(p, '"
    + copies.FIELD
    + "'))) = 0 THEN array_to_string(list_sort(list_transform(parts, lambda p: "
    + _PLAIN.replace("{0}", "p")
    + ")), chr(31)) END AS tree FROM (SELECT *, "
    + _PLAIN.replace("{0}", "text")
    + " AS plain, list_filter(regexp_split_to_array(text, '"
    + copies.PART
    + "'), lambda p: length(p) > 0) AS parts FROM base))"
)

_P1 = (
    "WITH base AS (SELECT DISTINCT post_id, text FROM synthetic_posts WHERE post_id IS NOT NULL AND text IS NOT NULL), "
    + _FORMS
    + ", w AS (SELECT post_id, plain, tree, regexp_extract_all("
    + _FOLDED.replace("{0}", "text")
    + r""", '[\p{L}\p{N}]+') AS w FROM forms),
s AS (SELECT post_id, plain, tree, list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM w WHERE len(w) >= 20),
e AS (SELECT post_id, plain, tree, len(g) AS n, unnest(g) AS h FROM s),
p AS (SELECT a.post_id AS x, b.post_id AS y, a.plain AS pa, b.plain AS pb, a.tree AS ta, b.tree AS tb, a.n AS na, b.n AS nb, count(*) AS k
  FROM e a JOIN e b ON a.h = b.h AND a.post_id < b.post_id GROUP BY ALL)
SELECT DISTINCT x AS post_id_a, y AS post_id_b FROM p WHERE 5 * k >= 3 * (na + nb - k)
  AND NOT (length(pa) >= 40 AND length(pb) >= 40 AND (pa = pb OR coalesce(ta = tb, false)))"""
)

_P2 = """
WITH t AS (SELECT DISTINCT post_id, text FROM synthetic_posts WHERE post_id IS NOT NULL AND length(text) >= 120),
w AS (SELECT post_id, i, substr(text, i + 1, 120) AS s FROM (SELECT post_id, text, unnest(range(length(text) - 119)) AS i FROM t)),
hit AS (SELECT s FROM w GROUP BY s HAVING min(post_id) <> max(post_id)),
c AS (SELECT DISTINCT post_id, i FROM w JOIN hit USING (s)),
f AS (SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY post_id ORDER BY i) + 120 THEN 0 ELSE 1 END AS fresh FROM c),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY post_id ORDER BY i) AS k FROM f)
SELECT post_id, CAST(min(i) AS INT) AS span_start, CAST(max(i) + 120 AS INT) AS span_end FROM g GROUP BY post_id, k"""

_P3 = (
    "WITH base AS (SELECT source_row, text FROM synthetic_posts WHERE text IS NOT NULL), "
    + _FORMS
    + """, r AS (SELECT source_row, coalesce('=' || tree, plain) AS form FROM forms WHERE length(plain) >= 40)
SELECT keep_row, source_row AS copy_row FROM (SELECT source_row, min(source_row) OVER (PARTITION BY form) AS keep_row FROM r) WHERE keep_row <> source_row"""
)

_P6 = r"""
WITH RECURSIVE r AS (SELECT post_id, coalesce(conversation_id, post_id) AS raw, in_reply_to_post_id AS parent FROM synthetic_posts WHERE post_id IS NOT NULL),
l AS (SELECT DISTINCT post_id, lower(trim(raw)) AS conv FROM r),
edge AS (SELECT DISTINCT a.conv AS u, b.conv AS v FROM l a JOIN l b ON a.post_id = b.post_id WHERE a.conv <> b.conv
  UNION SELECT lower(trim(r.raw)), l.conv FROM r JOIN l ON r.parent = l.post_id WHERE lower(trim(r.raw)) <> l.conv
  UNION SELECT l.conv, lower(trim(r.raw)) FROM r JOIN l ON r.parent = l.post_id WHERE lower(trim(r.raw)) <> l.conv),
reach(u, v) AS (SELECT DISTINCT conv, conv FROM l UNION SELECT reach.u, edge.v FROM reach JOIN edge ON reach.v = edge.u),
root AS (SELECT u AS conv, min(v) AS root FROM reach GROUP BY u),
grp AS (SELECT root, min(post_id) AS group_id FROM root JOIN l USING (conv) GROUP BY root),
many AS (SELECT root FROM root JOIN (SELECT lower(trim(raw)) AS conv, raw FROM r) USING (conv) GROUP BY root HAVING count(DISTINCT raw) > 1)
SELECT DISTINCT group_id, post_id FROM l JOIN root USING (conv) JOIN many USING (root) JOIN grp USING (root)"""


_P1_GROUPS = (
    "WITH RECURSIVE base AS (SELECT DISTINCT post_id, text FROM synthetic_posts WHERE post_id IS NOT NULL), "
    "w AS (SELECT post_id, regexp_extract_all("
    + _FOLDED.replace("{0}", "text")
    + r""", '[\p{L}\p{N}]+') AS w FROM base),
cls AS (SELECT DISTINCT post_id, md5(array_to_string(w, ' ')) AS c, w FROM w WHERE len(w) >= 20),
s AS (SELECT DISTINCT c, list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM cls),
e AS (SELECT c, len(g) AS n, unnest(g) AS h FROM s),
p AS (SELECT a.c AS x, b.c AS y FROM e a JOIN e b ON a.h = b.h AND a.c < b.c GROUP BY a.c, b.c, a.n, b.n HAVING 5 * count(*) >= 3 * (a.n + b.n - count(*))),
links AS (SELECT c, count(*) AS n FROM (SELECT x AS c FROM p UNION ALL SELECT y FROM p) GROUP BY c),
half AS (SELECT 'p' || post_id AS u, 'c' || c AS v FROM cls UNION SELECT 'c' || x, 'c' || y FROM p),
edge AS (SELECT u, v FROM half UNION SELECT v, u FROM half),
reach(u, v) AS (SELECT DISTINCT 'p' || post_id, 'p' || post_id FROM base UNION SELECT reach.u, edge.v FROM reach JOIN edge ON reach.v = edge.u),
grp AS (SELECT substr(u, 2) AS post_id, min(substr(v, 2)) AS group_id FROM reach WHERE v LIKE 'p%' GROUP BY u),
most AS (SELECT post_id, max(coalesce(n, 0)) AS n FROM cls LEFT JOIN links USING (c) GROUP BY post_id)
SELECT post_id, group_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links FROM grp LEFT JOIN most USING (post_id)"""
)

_P2_AMOUNTS = f"""
WITH own AS (SELECT post_id, CAST(max(length(text)) AS INT) AS n_chars FROM synthetic_posts WHERE post_id IS NOT NULL AND text IS NOT NULL GROUP BY post_id),
found AS ({_P2}), met AS (SELECT post_id, count(*) AS n, CAST(sum(span_end - span_start) AS BIGINT) AS c FROM found GROUP BY post_id)
SELECT post_id, n_chars, coalesce(n, 0) AS n_stretches, coalesce(c, 0) AS shared_chars, CASE WHEN n_chars > 0 THEN coalesce(c, 0) / n_chars ELSE 0.0 END AS shared_part
FROM own LEFT JOIN met USING (post_id)"""

_P3_KEPT = (
    "WITH base AS (SELECT source_row, text FROM synthetic_posts WHERE source_row IS NOT NULL), "
    + _FORMS
    + """, r AS (SELECT source_row, CASE WHEN length(plain) >= 40 THEN coalesce('=' || tree, plain) ELSE chr(31) || source_row END AS form FROM forms)
SELECT min(source_row) AS keep_row, count(*) AS n_copies FROM r GROUP BY coalesce(form, chr(31) || source_row)"""
)

_P6_ALL = _P6[: _P6.index("many AS")].rstrip().rstrip(",")
_P6_SPLITS = f"""
{_P6_ALL}, {core.INSTANTS},
own AS (SELECT post_id, min(group_id) AS group_id FROM l JOIN root USING (conv) JOIN grp USING (root) GROUP BY post_id),
times AS (SELECT post_id, min(utc_micros) AS began FROM instants WHERE post_id IS NOT NULL GROUP BY post_id),
g AS (SELECT group_id, min(began) AS began, count(*) AS n FROM own JOIN times USING (post_id) GROUP BY group_id),
o AS (SELECT group_id, (sum(n) OVER (ORDER BY began NULLS FIRST, md5(group_id), group_id) - n / 2) / sum(n) OVER () AS middle FROM g)
SELECT post_id, group_id, CASE WHEN middle < {splits.RATIOS[0]} THEN 'train' WHEN middle < {splits.RATIOS[0] + splits.RATIOS[1]} THEN 'validation' ELSE 'test' END AS split
FROM own JOIN o USING (group_id)"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _forms_sql() -> str:
    """(doc_id, text, form): every code point written out in plain Latin shape by Unicode's own tables, then composed."""
    plain = {}
    for c in range(0x80, 0x110000):
        char = chr(c)
        ruled = unicodedata.decomposition(char) or unicodedata.category(char) in ("Cf", "Zs") or c in lookalikes.WITHOUT_WIDTH or char in lookalikes.SHAPED
        if ruled and (shape := lookalikes.plain_shape(char)) != unicodedata.normalize("NFD", char):
            plain[c] = shape
    values = ", ".join(f"({c}, {_quoted(t)})" for c, t in plain.items())
    return rf"""
shape(c, t) AS (VALUES {values}),
runs AS (SELECT doc_id, regexp_extract_all(text, '[\x{{00}}-\x{{7f}}]+|[^\x{{00}}-\x{{7f}}]') AS r FROM documents WHERE regexp_matches(text, '[^\x{{00}}-\x{{7f}}]')),
chars AS (SELECT doc_id, unnest(r) AS c, generate_subscripts(r, 1) AS i FROM runs),
odd AS (SELECT doc_id, nfc_normalize(string_agg(coalesce(t, chars.c), '' ORDER BY i)) AS form FROM chars LEFT JOIN shape ON shape.c = ord(chars.c) GROUP BY doc_id),
forms AS (SELECT doc_id, text, coalesce(form, text) AS form FROM documents LEFT JOIN odd USING (doc_id))"""


_FORMS_SQL = _forms_sql()
_P10 = rf"""
WITH {_FORMS_SQL}, seen AS (SELECT * FROM forms WHERE regexp_matches(form, '[^\s\p{{Z}}\p{{C}}]'))
SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM seen a JOIN seen b ON a.form = b.form AND a.doc_id < b.doc_id WHERE a.text <> b.text"""


@query("p1_found", _P1)
def p1_found(spark, d):
    return near_copies.found_pairs(table(spark, d, "synthetic_posts"))


@query("p1_groups", _P1_GROUPS)
def p1_groups(spark, d):
    return near_copies.post_groups(table(spark, d, "synthetic_posts"))


@query("p2_found", _P2)
def p2_found(spark, d):
    return spans.shared_stretches(table(spark, d, "synthetic_posts"))


@query("p2_amounts", _P2_AMOUNTS)
def p2_amounts(spark, d):
    return spans.shared_amounts(table(spark, d, "synthetic_posts"))


@query("p3_found", _P3)
def p3_found(spark, d):
    return copies.found_copies(table(spark, d, "synthetic_posts"))


@query("p3_kept", _P3_KEPT)
def p3_kept(spark, d):
    return copies.collapse_copies(table(spark, d, "synthetic_posts"), "source_row")


@query("p4_found")
def p4_found(spark, d):
    return languages.found_cases(table(spark, d, "synthetic_posts"))


@query("p4_segments")
def p4_segments(spark, d):
    out = languages.detect(table(spark, d, "synthetic_posts"))
    return out.select("post_id", "segment_no", "lang", F.round("confidence", 6).alias("confidence")).distinct()


@query("p6_found", _P6)
def p6_found(spark, d):
    return splits.found_groups(table(spark, d, "synthetic_posts"))


@query("p6_splits", _P6_SPLITS)
def p6_splits(spark, d):
    return splits.assign_splits(table(spark, d, "synthetic_posts"), table(spark, d, "feeds"))


@query("p8_ids")
def p8_ids(spark, d):
    return tokenization.encode_texts(table(spark, d, "documents"))


@query("p9_containers")
def p9_containers(spark, d):
    return packing.pack_documents(table(spark, d, "documents"), table(spark, d, "container_sizes"))


@query("p10_found", _P10)
def p10_found(spark, d):
    return lookalikes.found_lookalikes(table(spark, d, "documents"))


@query("p10_forms", f"WITH {_FORMS_SQL} SELECT doc_id, form FROM forms")
def p10_forms(spark, d):
    return lookalikes.consistent_forms(table(spark, d, "documents")).drop("_text")
