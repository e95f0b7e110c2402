"""The curation steps on rows of our own, end to end and one by one."""

import json

import pytest
from hypothesis import given
from hypothesis import strategies as st

from millrace.operators import dedup, filters, overlap, stylometry, temporal_split
from millrace.operators.normalise import normalise_posts, parse_time, render_time
from millrace.plans.pipeline import BuildSettings, build, evaluate, guard_outputs, guard_requests
from millrace.plans.queries import QUERIES
from millrace.sources.errors import DataError
from millrace.sources.readers import read_records, read_texts
from millrace.sources.writers import copy_publication, parse_store_uri

TOPICS = ["harbour", "lantern", "orchard", "railway", "theatre", "glacier", "pottery", "meadow", "compass", "chimney"]


def post(i, text, **more):
    return {"post_id": f"p{i:03}", "author_id": "a", "created_at": f"2025-01-{i:02}T09:00:00Z", "text": text, "lang": "en"} | more


POSTS = [post(i + 1, f"The {w} opens at noon and the {w} keeper sells {i} tickets to visitors.") for i, w in enumerate(TOPICS)] + [
    post(11, "RT @someone: the harbour opens", reference_types=["retweeted"]),
    post(12, "https://example.invalid/a"),
    post(13, "the HARBOUR opens at noon, and the harbour keeper sells 0 tickets to visitors"),
    post(14, "Nobody expected the violin shop to move.", conversation_id="t"),
    post(15, "It moved anyway!", conversation_id="t", in_reply_to_post_id="p014"),
    post(16, "Zu spät.", lang="de"),
]


@pytest.fixture()
def source(tmp_path):
    path = tmp_path / "posts.jsonl"
    path.write_text("\ufeff" + "\n\n".join(json.dumps(p) for p in POSTS) + "\n", encoding="utf-8")
    return str(path)


def test_build(spark, source, tmp_path):
    out = str(tmp_path / "built")
    manifest = build(spark, source, out, BuildSettings())
    assert manifest["counts"]["source"] == 16 and manifest["counts"]["curated"] == 12 and manifest["counts"]["rejected"] == 4
    assert sum(manifest["counts"]["splits"].values()) == 12 and set(manifest["counts"]["splits"]) == {"train", "validation", "test"}
    curated = spark.read.json(f"{out}/curated/posts")
    thread = {r.split for r in curated.where("conversation_id = 't'").collect()}
    assert thread == {"test"}
    reasons = {r.reason for r in spark.read.json(f"{out}/rejected/posts").collect()}
    assert reasons == {"language_not_allowed:de", "reference_type_excluded:retweeted", "link_only", "exact_duplicate"}
    raw = [json.loads(json.loads(line)["payload"]) for line in spark.read.text(f"{out}/raw/source").toPandas()["value"]]
    assert raw == POSTS
    with pytest.raises(DataError):
        build(spark, source, out, BuildSettings())
    again = build(spark, source, str(tmp_path / "again"), BuildSettings())
    assert again["dataset_id"] == manifest["dataset_id"]
    assert sorted(again["artifacts"].values()) == sorted(manifest["artifacts"].values())
    copied = copy_publication(spark, out, "file://" + str(tmp_path / "copy"))
    assert copied[-1] == "manifest.json"
    with pytest.raises(DataError):
        copy_publication(spark, out, "file://" + str(tmp_path / "copy"))


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,user,text\n1,u,"two\nlines"\n2,v,"say ""hi"""\n', encoding="utf-8")
    rows = read_records(spark, str(tmp_path / "a.csv")).orderBy("source_row").collect()
    assert [r.source_row for r in rows] == [2, 3] and json.loads(rows[0].payload)["text"] == "two\nlines"
    assert json.loads(rows[1].payload)["text"] == 'say "hi"'
    (tmp_path / "a.json").write_text(json.dumps({"posts": [{"id": 1}, {"id": 2}]}), encoding="utf-8")
    rows = read_records(spark, str(tmp_path / "a.json")).orderBy("source_row").collect()
    assert [(r.source_ref, r.source_row) for r in rows] == [("a.json#row=1", 1), ("a.json#row=2", 2)]
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n\n[2]\n', encoding="utf-8")
    with pytest.raises(DataError, match="line 3"):
        read_records(spark, str(tmp_path / "bad.jsonl"))
    (tmp_path / "bad.json").write_text('{"x": 1}', encoding="utf-8")
    for name in ("bad.json", "none.jsonl", "a.txt"):
        with pytest.raises(DataError):
            read_records(spark, str(tmp_path / name))
    (tmp_path / "t.jsonl").write_text('{"text": " ", "content": "x"}\n{"completion": [{"role": "assistant", "content": "y"}]}\n{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "z"}]}\n', encoding="utf-8")
    assert [r.text for r in read_texts(spark, str(tmp_path / "t.jsonl")).orderBy("idx").collect()] == ["x", "y", "z"]


def test_normalisation_rules(spark):
    payloads = [
        {"tweet_id": 5, "username": "u", "created_at": "Wed Oct 10 20:19:24 +0000 2018", "text": "see https://x.invalid/a @friend &amp; go"},
        {"post_id": " ", "id": "7", "author_id": "u", "text": "t", "created_at": "2024-01-01"},
        {"id": "8", "text": "t", "created_at": "2024-01-01"},
        {"id": "9", "author_id": "u", "text": " ", "created_at": "2024-01-01"},
        {"id": "10", "author_id": "u", "text": "t", "created_at": "yesterday"},
    ]
    raw = spark.createDataFrame([(f"r{i}", json.dumps(p)) for i, p in enumerate(payloads)] + [("r5", None)], "source_ref string, payload string")
    got = {r.source_ref: r for r in normalise_posts(raw).collect()}
    assert got["r0"].text_train == "see <URL> <USER> & go" and got["r0"].created_at_utc == "2018-10-10T20:19:24Z" and got["r0"].reason is None
    assert got["r1"].reason == "post_id is required" and got["r5"].reason == "post_id is required"
    assert got["r2"].reason == "post 8: author_id is required" and got["r3"].reason == "post 9: text is required"
    assert got["r4"].reason == "unsupported created_at value"
    assert got["r0"].conversation_id == "5" and got["r0"].lang == "und"


def test_the_first_key_that_is_there_wins(spark):
    payloads = [
        {"reference_types": None, "referenced_tweets": ["quoted"], "entities": None, "entities_json": {"a": 1}},
        {"referenced_tweets": [{"type": "Quoted"}, "b"], "entities_json": {"a": 1}},
        {"reference_types": '["x", "Y"]', "entities": "no json"},
        {"reference_types": "p, q", "entities": [1]},
    ]
    raw = spark.createDataFrame([(f"r{i}", json.dumps(p)) for i, p in enumerate(payloads)] + [("r4", '{"entities": 1')], "source_ref string, payload string")
    got = {r.source_ref: (r.reference_types, r.entities_json) for r in normalise_posts(raw).collect()}
    want = [([], '{"value":null}'), (["b", "quoted"], '{"a":1}'), (["x", "y"], '{"unparsed":"no json"}'), (["p", "q"], '{"value":[1]}'), ([], "{}")]
    assert got == {f"r{i}": w for i, w in enumerate(want)}


def test_numbers_over_several_splits(spark, tmp_path):
    from millrace.sources.writers import rows_hash, write_csv

    (tmp_path / "a.jsonl").write_text("".join(json.dumps({"n": i, "x": "y" * (i % 90)}) + "\n" * (1 + i % 2) for i in range(3000)), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        records = read_records(spark, str(tmp_path / "a.jsonl"))
        rows = {json.loads(r.payload)["n"]: r.source_row for r in records.collect()}
        assert records.rdd.getNumPartitions() > 4 and rows == {i: 1 + i + i // 2 for i in range(3000)}
        assert rows_hash(records, "source_row") == rows_hash(records.repartition(7), "source_row") != rows_hash(records.where("source_row > 1"), "source_row")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    write_csv(records.select("source_row"), str(tmp_path / "rows"))
    assert spark.read.option("header", True).csv(str(tmp_path / "rows")).count() == 3000


def test_settings(tmp_path):
    good = '''[dataset]
version = "1"
allowed_languages = ["en"]
min_text_chars = 5
exclude_reference_types = []
replace_urls = true
replace_mentions = true
max_per_near_duplicate_cluster = 2
[dedup]
ngram_size = 3
similarity_threshold = 0.8
mode = "lsh"
minhash_permutations = 32
minhash_bands = 8
[split]
train_ratio = 0.8
validation_ratio = 0.1
test_ratio = 0.1
[prompt]
system = "s"
time_context = "t"
'''
    (tmp_path / "a.toml").write_text(good)
    made = BuildSettings.from_toml(str(tmp_path / "a.toml"))
    assert (made.mode, made.permutations, made.bands, made.cluster_cap) == ("lsh", 32, 8, 2)
    for bad in (good.replace("ngram_size", "other"), good.replace("[split]", "[cut]"), good.replace("= 5", '= "x"'), "["):
        (tmp_path / "b.toml").write_text(bad)
        with pytest.raises(DataError):
            BuildSettings.from_toml(str(tmp_path / "b.toml"))


def test_times(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00.5Z",), ("2024-01-01 01:00:00+0100",), ("20240101T000000Z",), ("2024-01-01",), ("2024-02-30",), (None,)], "s string")
    got = [r[0] for r in df.select(render_time(parse_time(df.s))).collect()]
    assert got == ["2024-01-01T00:00:00.500000Z", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", "2024-01-01T00:00:00Z", None, None]


def jaccard(a, b):
    def sets(t):
        w = t.split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)} or {tuple(w)}

    x, y = sets(a), sets(b)
    return len(x & y) / len(x | y)


def test_near_pairs_equal_all_pairs(spark, medium):
    docs = [r.text for r in spark.read.parquet(f"{medium}/synthetic_posts.parquet").limit(150).collect() if r.text]
    docs = [" ".join(t.lower().split()[:30]) for t in docs]
    docs = ["".join(c for c in t if c.isascii() and (c.isalnum() or c == " ")) for t in docs]
    docs += [d + " and more" for d in docs[:40]] + [" ".join(d.split()[3:]) for d in docs[:40]] + ["", "one", "one", "one two"]
    docs = [" ".join(d.split()) for d in docs]
    df = spark.createDataFrame(list(enumerate(docs)), "k bigint, text string")
    got = {(r.a, r.b) for r in dedup.near_pairs(df, "k").collect()}
    want = {(i, j) for i in range(len(docs)) for j in range(i + 1, len(docs)) if jaccard(docs[i], docs[j]) >= 0.72}
    assert got == want and len(want) > 20
    lsh = {(r.a, r.b) for r in dedup.lsh_pairs(df, "k").collect()}
    assert lsh <= want and len(lsh) >= 0.9 * len(want)


def test_cluster_cap_rounds_half_to_even(spark):
    rows = [(f"c{n}", n, i, f"t{i:02}") for n in (1, 3, 4, 6, 8) for i in range(n)]
    df = spark.createDataFrame(rows, "cluster_id string, cluster_size bigint, k int, at string")
    kept = {}
    for r in dedup.cap_clusters(df, "k", "at", 3).where("kept").collect():
        kept.setdefault(r.cluster_id, set()).add(r.k)
    assert kept == {"c1": {0}, "c3": {0, 1, 2}, "c4": {0, 2, 3}, "c6": {0, 2, 5}, "c8": {0, 4, 7}}
    assert {r.k for r in dedup.cap_clusters(df.where("cluster_id = 'c4'"), "k", "at", 1).where("kept").collect()} == {0}


def test_exact_duplicates_keep_the_first(spark):
    df = spark.createDataFrame([(3, "A b!"), (1, "a B !"), (2, "🙂"), (4, "..."), (5, None), (6, "a b!")], "k bigint, text string")
    got = {r.k: r.duplicate_of for r in dedup.exact_duplicates(df, "k", "k").collect()}
    assert got == {1: None, 3: 1, 6: 1, 2: None, 4: 2}


def test_joins_with_hot_values(spark, monkeypatch):
    from millrace import runtime

    monkeypatch.setattr(runtime, "HOT_ROWS", 10)
    texts = ["the same words"] * 300 + ["another"] * 5 + [f"text {i}" for i in range(50)] + [None]
    df = spark.createDataFrame([(i, t, f"{i:04}") for i, t in enumerate(texts)], "k bigint, text string, at string")
    got = {r.k: r.duplicate_of for r in dedup.exact_duplicates(df, "k", "k").collect()}
    assert got == {i: None if texts.index(t) == i else texts.index(t) for i, t in enumerate(texts) if t}
    groups = {r.k: r.group for r in temporal_split.link_groups(df, "k", ["text"]).collect()}
    assert groups == {i: texts.index(t) if t else i for i, t in enumerate(texts)}
    counts = df.groupBy("text").count()
    hot = runtime.hot_values(counts, "text", "count").collect()
    assert [tuple(r) for r in hot] == [("the same words", 30)] and runtime.hot_values(counts, "text", "count", 1000) is None
    salted = runtime.salted_join(df, counts, "text", "k", runtime.hot_values(counts, "text", "count"))
    assert salted.count() == 355


def test_split_of_few_groups_and_bridges(spark):
    def split(rows):
        df = spark.createDataFrame(rows, "k bigint, at string, a string, b string")
        return {r.k: (r.group, r.split) for r in temporal_split.grouped_temporal_split(df, "k", "at", ["a", "b"]).collect()}

    assert split([(1, "1", "x", None), (2, "2", "y", None)]) == {1: (1, "train"), 2: (2, "train")}
    got = split([(1, "1", "x", "p"), (2, "2", "y", "p"), (3, "3", "y", None), (4, "4", "", None), (5, "5", "", None), (6, "6", None, None)])
    assert {got[k][0] for k in (1, 2, 3)} == {1} and len({got[k][0] for k in (4, 5, 6)}) == 3
    assert got[1][1] == "train" and got[6][1] == "test" and "validation" in {v[1] for v in got.values()}
    with pytest.raises(ValueError):
        temporal_split.grouped_temporal_split(spark.createDataFrame([], "k bigint, at string, a string"), "k", "at", ["a"], (0.5, 0.1, 0.1))


def longest_run(a, b):
    best, before = 0, [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for j, y in enumerate(b):
            now.append(before[j] + 1 if x == y else 0)
            best = max(best, now[-1])
        before = now
    return best


def test_overlap_against_brute_force(spark):
    import random

    rng = random.Random(5)
    words = "ab ba cd dc ef fe".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 2, 4, 5, 9, 14]))) for _ in range(60)]
    gen = spark.createDataFrame(list(enumerate(texts[:30])), "idx bigint, text string")
    train = spark.createDataFrame(list(enumerate(texts[20:])), "idx bigint, text string")
    cand = overlap.overlap_candidates(gen, train, "idx", "idx")
    as_dict = lambda df: {r.gen: (r.train, r.exact, r.span, round(r.jaccard, 9)) for r in df.collect()}
    got = as_dict(overlap.best_matches(gen, cand, "idx"))
    assert as_dict(overlap.find_best_matches(gen, train, "idx", "idx")) == got

    def grams(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())

    for i, t in enumerate(texts[:30]):
        best = None
        for j, u in enumerate(texts[20:]):
            a, b = grams(t), grams(u)
            if not (a & b or t == u):
                continue
            score = (t == u, longest_run(t.split(), u.split()), len(a & b) / len(a | b) if a | b else 1.0)
            if best is None or score > best[0]:
                best = (score, j)
        want = (best[1], best[0][0], best[0][1], round(best[0][2], 9)) if best else (None, False, 0, 0.0)
        assert got[i] == want, (t, got[i], want)


def test_candidates_are_finished_where_they_meet(spark, monkeypatch):
    import random

    monkeypatch.setattr(overlap, "TEXTS", 7)
    rng = random.Random(6)
    texts = [" ".join(rng.choice(("ab", "ba", "cd", "!")) for _ in range(rng.choice([0, 1, 2, 4, 5, 9, 14, 60]))) for _ in range(80)] + ["ab " * 30, None, "", "?!", "ab ba cd"]
    gen = spark.createDataFrame([*enumerate(texts[:45] + texts[80:])], "idx bigint, text string").repartition(2)
    train = spark.createDataFrame([(f"t{j}", t) for j, t in enumerate(texts[30:])], "idx string, text string").repartition(2)
    out = overlap.overlap_candidates(gen, train, "idx", "idx")
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()  # the hits of all pairs would be on disk
    rows = out.collect()
    got = {(r.gen, r.train): (r.exact, r.span, r.shared, round(r.jaccard, 9)) for r in rows}
    assert len(got) == len(rows)

    def grams(w):
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}

    want = {}
    for i, t in enumerate(texts[:45] + texts[80:]):
        for j, u in enumerate(texts[30:]):
            if t is None or u is None:
                continue
            t_, u_ = t.split(), u.split()
            a, b = grams(t_), grams(u_)
            if a & b or t_ == u_:
                want[i, f"t{j}"] = (t_ == u_, longest_run(t_, u_), len(a & b), round(len(a & b) / len(a | b) if a | b else 1.0, 9))
    assert got == want


def test_only_the_longest_shared_grams_are_paired(spark, monkeypatch):
    made = {}

    def record(df, name, write=overlap.stash):
        out = write(df, name)
        made[name] = made.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(overlap, "stash", record)
    common = "one two three four five"
    gen = spark.createDataFrame([(i, f"{common} w{i} g{i}") for i in range(20)], "idx bigint, text string")
    train = spark.createDataFrame([(i, f"t{i} {common} w{i} u{i}") for i in range(20)], "idx bigint, text string")
    got = {r.gen: (r.train, r.span) for r in overlap.find_best_matches(gen, train, "idx", "idx").collect()}
    assert got == {i: (i, 6) for i in range(20)}
    assert made["pairs"] == 20  # all 400 share the common five


def test_evaluate_and_guard(spark):
    text = "The lighthouse keeper counted every boat twice before the storm came in."
    one = spark.createDataFrame([(0, text)], "idx bigint, text string")
    report = evaluate(one, one, one, span=5)
    assert report["memorization"]["exact_match_count"] == 1 and not report["automatic_gate"]["passed"]
    assert report["style"]["distance"] == 0 and text not in str({k: v for k, v in report.items() if k != "flagged"})
    other = spark.createDataFrame([(0, "An unrelated sentence about cheese.")], "idx bigint, text string")
    assert evaluate(one, one, other)["automatic_gate"]["passed"]
    with pytest.raises(DataError):
        evaluate(one.limit(0), one, one)
    out = spark.createDataFrame([(1, text), (2, " "), (3, None), (4, "an official note"), (5, "fine")], "request_id bigint, text string")
    codes = {r.request_id: r.code for r in guard_outputs(out, one, {"official": r"(?i)\bofficial\b"}).collect()}
    assert codes == {1: "training_overlap", 2: "empty_generation", 3: "empty_generation", 4: "official", 5: "allowed"}


def test_streams(spark, small, tmp_path):
    from millrace.runtime import table
    from millrace.streaming.streams import first_seen, normalised_stream, post_stream

    raw = table(spark, small, "raw_records")
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    posts = normalised_stream(post_stream(spark, str(tmp_path / "in")), languages=["en"])
    query = posts.writeStream.format("memory").queryName("posts").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    batch = normalised_stream(raw, languages=["en"])
    count = lambda df: {(r.reason, r["count"]) for r in df.groupBy("reason").count().collect()}
    assert count(spark.table("posts")) == count(batch)
    timed = posts.where("reason is null").selectExpr("*", "timestamp(created_at_utc) as at")
    query = first_seen(timed, "at", "3650 days").writeStream.format("memory").queryName("firsts").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "d")).start()
    query.awaitTermination()
    kept = spark.table("firsts").count()
    assert kept == dedup.exact_duplicates(batch.where("reason is null"), "source_ref", "source_ref", "text_train").where("duplicate_of is null").count()
    requests = table(spark, small, "generation_requests")
    assert guard_requests(requests, {"digit": "[0-9]"}).where("code not in ('digit', 'allowed')").count() == 0


def test_filters_and_metrics_on_nothing(spark):
    empty = spark.createDataFrame([], "k bigint, text string, lang string, author_id string, reference_types array<string>, text_train string, text_raw string")
    assert empty.select(filters.reject_reason(["en"])).count() == 0
    assert stylometry.corpus_profile(empty).collect()[0].words is None
    assert stylometry.profile_distance(stylometry.corpus_profile(empty), stylometry.corpus_profile(empty)).collect()[0].distance == float("inf")
    assert [r.ratio for r in stylometry.distinct_n(empty).collect()] == [0.0, 0.0]
    assert dedup.near_clusters(empty, "k").count() == 0
    row = spark.createDataFrame([(1, None, None, None, None, None, None)], empty.schema)
    assert row.select(filters.reject_reason(["en"]).alias("r")).collect()[0].r == "language_not_allowed:"
    assert row.select(filters.reject_reason().alias("r")).collect()[0].r == "text_too_short"


@given(st.sampled_from(["s3://b/p", "s3a://b/p/q/", "file:///x"]))
def test_store_uri(uri):
    assert parse_store_uri(uri)[0] in ("s3", "s3a", "file")
    for bad in ("http://x", "s3://", "plain/path", "s3://b", "s3://b/", "s3://b/a/../c", "s3://b/./c", "s3a://b/a//c"):
        with pytest.raises(DataError):
            parse_store_uri(bad)


def test_posts_are_split_by_whole_keys(spark, tmp_path):
    base = " ".join(f"word{i}" for i in range(60))
    other = base[:45] + " " + " ".join(f"thing{i}" for i in range(60))  # the same opening, otherwise unrelated
    texts = [(0, base, None), (1, "Quite another opening of forty characters: " + base, None), (2, other, None), (3, base, "c1"), (4, "alone here", "C1 ")]
    texts += [(5, "nothing like it at all", "c2"), (6, None, "c2"), (7, None, None), (8, "x y z", None)]
    rows = [(i, "f", f"2024-05-{i + 1:02}T00:00:00Z", t, c) for i, t, c in texts]
    spark.createDataFrame(rows, "source_row bigint, feed_id string, created_at string, text string, conversation_id string").write.parquet(f"{tmp_path}/synthetic_posts.parquet")
    spark.createDataFrame([("f", None, "ymd")], "feed_id string, home_zone string, date_order string").write.parquet(f"{tmp_path}/feeds.parquet")
    got = {r.source_row: (r.group, r.split) for r in QUERIES["post_split"](spark, str(tmp_path)).collect()}
    assert {k: g for k, (g, _) in got.items()} == {0: 0, 1: 0, 2: 2, 3: 0, 4: 0, 5: 5, 6: 5, 7: 7, 8: 8}
    assert len(set(got.values())) == len({g for g, _ in got.values()})
    leaks = {r.field: (r.n_values, r.n_leaking) for r in QUERIES["post_leakage"](spark, str(tmp_path)).collect()}
    assert leaks == {"conversation_id": (2, 0), "near_dup_cluster_id": (5, 0)}
