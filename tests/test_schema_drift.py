import json
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators.schema_drift import best_matching, found_changes, match_versions, unify_posts
from millrace.runtime import table


def kind(v):
    if v is None or v == []:
        return None
    if isinstance(v, list):
        inner = {kind(x) for x in v}
        return f"array {inner}"
    return type(v).__name__


def test_found_changes_against_plain_loops(spark, medium):
    raw, aliases = table(spark, medium, "raw_records"), table(spark, medium, "field_aliases")
    names = {r.alias_name.lower().replace("_", ""): r.field_name for r in aliases.collect()}
    files = defaultdict(lambda: defaultdict(lambda: (set(), set())))
    for r in raw.collect():
        try:
            value = json.loads((r.payload or "").lstrip("\ufeff"))
        except ValueError:
            continue
        if isinstance(value, dict):
            fields = files[r.stream_id, r.file_no]
            for k, v in value.items():
                if (field := names.get(k.lower().replace("_", ""))) is not None:
                    fields[field][0].add(k)
                    if kind(v):
                        fields[field][1].add(kind(v))
    want = set()
    for (stream, no), new in list(files.items()):
        if (stream, no - 1) in files:
            old = files[stream, no - 1]
            for f in {*old, *new}:
                if f not in old or f not in new:
                    want.add((stream, no, f, "added" if f in new else "removed"))
                    continue
                if old[f][0] != new[f][0]:
                    want.add((stream, no, f, "renamed"))
                if old[f][1] and new[f][1] and old[f][1] != new[f][1]:
                    want.add((stream, no, f, "type_changed"))
    got = [tuple(r) for r in found_changes(raw, aliases).collect()]
    assert set(got) == want and len(got) == len(want) > 0


RAW = "record_id bigint, stream_id string, file_no int, file_name string, source_row int, payload string, landed_at timestamp, field_name string"


def rows(spark, *payloads):
    data = [(i, "s", no, f"s-{no}", i, p, None, "clash") for i, (no, p) in enumerate(payloads)]
    return spark.createDataFrame(data, RAW)


def alias_frame(spark):
    return spark.createDataFrame([("post_id", "post_id"), ("post_id", "id"), ("text", "text"), ("reference_types", "reference_types")], "field_name string, alias_name string")


def test_unknown_keys_are_matched_by_profile(spark):
    old = [(1, json.dumps({"post_id": str(i), "colour_code": f"c{i}"})) for i in range(20)]
    new = [(2, json.dumps({"Id": i, "colourCode2": f"c{i}", "other": True})) for i in range(20)]
    got = {(r.field_name, r.change_kind, r.evidence) for r in match_versions(rows(spark, *old, *new), alias_frame(spark)).collect()}
    assert got == {("post_id", "renamed", "alias"), ("post_id", "type_changed", "alias"), ("colourCode2", "renamed", "matched"), ("other", "added", "matched")}


def test_known_fields_renamed_to_unknown_keys_and_back(spark):
    first = [(1, json.dumps({"post_id": f"a{i}", "text": f"t{i % 3}"})) for i in range(20)]
    second = [(2, json.dumps({"post_id": f"b{i}", "body": f"t{i % 3}"})) for i in range(20)]
    third = [(3, json.dumps({"id": f"c{i}", "Text": f"t{i % 3}", "body2": 1})) for i in range(20)]
    raw = rows(spark, *first, *second, *third)
    got = sorted(tuple(r)[1:] for r in found_changes(raw, alias_frame(spark)).collect())
    assert got == [(2, "text", "renamed"), (3, "post_id", "renamed"), (3, "text", "renamed")]
    got = {(r.file_no, r.field_name, r.change_kind, r.before, r.after, r.evidence) for r in match_versions(raw, alias_frame(spark)).collect()}
    assert got == {
        (2, "text", "renamed", "text", "body", "matched"),
        (3, "text", "renamed", "body", "Text", "matched"),
        (3, "post_id", "renamed", "post_id", "id", "alias"),
        (3, "body2", "added", None, "body2", "matched"),
    }


def test_matched_keys_are_unified_and_others_kept(spark):
    files = [("text", "mood"), ("body", "mood"), ("body_", "mood"), ("Text", "mood")]
    raw = rows(spark, *[(no, json.dumps({"post_id": f"{no}-{i}", a: f"t{i % 3}", b: i % 2})) for no, (a, b) in enumerate(files, 1) for i in range(12)])
    got = sorted((r.file_no, r.post_id, r.text, tuple(sorted(r.other_keys.items()))) for r in unify_posts(raw, alias_frame(spark)).collect())
    more = lambda no, i: tuple((k, v) for k, v in ((files[no - 1][0], f"t{i % 3}"), ("mood", str(i % 2))) if k.lower() != "text")
    assert got == sorted((no, f"{no}-{i}", f"t{i % 3}", more(no, i)) for no in range(1, 5) for i in range(12))


def test_broken_empty_and_null_payloads(spark):
    raw = rows(spark, (1, None), (1, ""), (1, "{"), (1, "null"), (1, "[1]"), (1, '\ufeff{"id": "7"}'), (3, '{"id": 7}'))
    assert found_changes(raw, alias_frame(spark)).count() == 0  # the predecessor of file 3 never came
    got = unify_posts(raw, alias_frame(spark)).orderBy("record_id").collect()
    assert [r.readable for r in got] == [False] * 5 + [True] * 2
    assert [r.post_id for r in got][-2:] == ["7", "7"]
    assert unify_posts(raw.limit(0), alias_frame(spark)).count() == 0
    assert found_changes(raw, alias_frame(spark).limit(0)).count() == 0


def test_reference_types_in_all_encodings(spark):
    values = ['["Quoted"]', '[{"type": "quoted"}]', '"quoted"', '"[\\"quoted\\"]"', '"quoted, QUOTED"']
    raw = rows(spark, *[(1, f'{{"id": 1, "reference_types": {v}}}') for v in values])
    assert [r.reference_types for r in unify_posts(raw, alias_frame(spark)).collect()] == [["quoted"]] * 5


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 100), min_size=3, max_size=3), min_size=1, max_size=3))
def test_matching_is_optimal(weights):
    from itertools import permutations

    w = [[x / 100 for x in row] for row in weights]
    got = best_matching(w, 0.3)
    value = lambda pairs: sum(w[i][j] for i, j in pairs if w[i][j] >= 0.3)
    best = max(value(list(enumerate(p[: len(w)]))) for p in permutations(range(3)))
    assert abs(value(got) - best) < 1e-9
    assert len({i for i, _ in got}) == len(got) == len({j for _, j in got})


def test_renames_with_half_of_the_names_unknown(spark):
    """Renames that the alias table doesn't tell, because one of the spellings is missing there."""
    records, aliases = (table(spark, "/root/testdata/sf0.1", n) for n in ("raw_records", "field_aliases"))
    gone = ["tweet_id", "id", "full_text", "thread_id", "referenced_tweets", "favorite_count", "language", "username", "user_id", "timestamp", "date", "in_reply_to_status_id_str", "entities_json"]
    less = aliases.where(~aliases.alias_name.isin(gone))
    plain = lambda k: k.lower().replace("_", "")
    known = {plain(r.alias_name) for r in less.collect()}
    want = set()
    for r in match_versions(records, aliases).where("change_kind = 'renamed'").collect():
        if len({plain(r.before) in known, plain(r.after) in known}) == 2:
            want.add((r.stream_id, r.file_no, r.field_name))
    everything = {tuple(r)[:3] for r in found_changes(records, aliases).where("change_kind = 'renamed'").collect()}
    got = {tuple(r)[:3] for r in found_changes(records, less).where("change_kind = 'renamed'").collect()}
    assert len(want) > 30 and len(want & got) >= 0.8 * len(want) and got <= everything
