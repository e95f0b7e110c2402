"""Whole pipelines: build a corpus from a file of records, evaluate generated texts, guard generated texts.

A gate on rights or approvals is a rule of the business that runs the engine and isn't part of it: ``build`` takes the
version of an approval as a plain string for the lineage columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import nfkc, strip
from millrace.operators import dedup, filters, labels, overlap, prompts, stylometry, temporal_split
from millrace.operators.normalise import normalise_posts
from millrace.runtime import stash
from millrace.sources.errors import DataError
from millrace.sources.readers import read_records, read_settings
from millrace.sources.writers import SPLITS, canonical_hash, publish_layers, rows_hash


@dataclass
class BuildSettings:
    version: str = "0.1.0"
    languages: list[str] = field(default_factory=lambda: ["en"])
    authors: list[str] = field(default_factory=list)
    least_chars: int = 5
    references: list[str] = field(default_factory=lambda: ["retweeted"])
    urls: bool = True
    mentions: bool = True
    cluster_cap: int = dedup.CLUSTER_CAP
    shingle: int = dedup.SHINGLE
    similarity: float = dedup.SIMILARITY
    mode: str = "exact"
    permutations: int = dedup.PERMUTATIONS
    bands: int = dedup.BANDS
    ratios: tuple[float, float, float] = (0.8, 0.1, 0.1)
    system: str = "Write one short post."
    context: str = "historical/general"

    @classmethod
    def from_toml(cls, path: str) -> "BuildSettings":
        """Sections dataset, dedup, split and prompt of a settings file."""
        raw = read_settings(path)
        for name in ("dataset", "dedup", "split", "prompt"):
            if not isinstance(raw.get(name), dict):
                raise DataError(f"the settings lack the section [{name}]")
        d, n, s, p = (raw[x] for x in ("dataset", "dedup", "split", "prompt"))
        try:
            return cls._of(d, n, s, p)
        except (KeyError, TypeError, ValueError) as e:
            raise DataError(f"the settings lack a key or have a wrong value: {e}") from e

    @classmethod
    def _of(cls, d: dict, n: dict, s: dict, p: dict) -> "BuildSettings":
        return cls(
            version=str(d["version"]),
            languages=list(d["allowed_languages"]),
            authors=list(d.get("allowed_author_ids", [])),
            least_chars=int(d["min_text_chars"]),
            references=list(d["exclude_reference_types"]),
            urls=bool(d["replace_urls"]),
            mentions=bool(d["replace_mentions"]),
            cluster_cap=int(d["max_per_near_duplicate_cluster"]),
            shingle=int(n["ngram_size"]),
            similarity=float(n["similarity_threshold"]),
            mode=str(n.get("mode", "exact")),
            permutations=int(n.get("minhash_permutations", dedup.PERMUTATIONS)),
            bands=int(n.get("minhash_bands", dedup.BANDS)),
            ratios=(float(s["train_ratio"]), float(s["validation_ratio"]), float(s["test_ratio"])),
            system=str(p["system"]),
            context=str(p["time_context"]),
        )


def curate(records: DataFrame, settings: BuildSettings, version: str = "none") -> dict[str, DataFrame]:
    """Layers raw, normalized, rejected and curated from (source_ref, source_row, payload)."""
    s = settings
    read = stash(normalise_posts(records.select("source_ref", "payload"), version, s.urls, s.mentions).join(records.select("source_ref", "source_row"), "source_ref"), "normalised")
    readable, unreadable = read.where("reason is null").drop("reason", "payload"), read.where("reason is not null")
    tested = readable.withColumn("reason", filters.reject_reason(s.languages, s.authors, s.references, s.least_chars))
    kept, filtered = filters.split_by_reason(tested)
    kept = stash(kept, "filtered")
    firsts = dedup.exact_duplicates(kept, "source_row", "source_row", "text_train")
    ids = kept.select(F.col("source_row").alias("duplicate_of"), F.col("post_id").alias("_first"))
    marked = kept.join(firsts, "source_row").join(ids, "duplicate_of", "left")
    unique = stash(marked.where("duplicate_of is null").drop("duplicate_of", "_first"), "unique")
    copies = marked.where("duplicate_of is not null").withColumn("quality_flags", F.array(F.concat(F.lit("exact_duplicate_of:"), "_first"))).drop("duplicate_of", "_first")
    clusters = _clusters(unique, s)
    placed = unique.join(clusters, "source_row").withColumnRenamed("cluster_id", "near_dup_cluster_id")
    over = placed.where("not kept").withColumn("quality_flags", F.array(F.concat(F.lit("near_duplicate_cluster_cap:"), "near_dup_cluster_id")))
    chosen = placed.where("kept").drop("kept", "cluster_size").withColumns(labels.label_columns())
    chosen = stash(chosen, "labelled")
    split = temporal_split.grouped_temporal_split(chosen, "source_row", "created_at_utc", ["conversation_id", "near_dup_cluster_id"], s.ratios)
    curated = stash(chosen.join(split.select("source_row", "split"), "source_row"), "curated")
    if not temporal_split.leaking_groups(curated, ["conversation_id", "near_dup_cluster_id"]).isEmpty():
        raise DataError("a group of related posts was divided between splits")
    found = {r.split: r.n for r in curated.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    if sum(found.values()) >= 3 and set(found) != set(SPLITS):
        raise DataError(f"a split is empty: {found}")
    body = [c for c in readable.columns if c != "source_row"]
    as_record = F.struct(*[F.col(c) for c in body])
    none = F.lit(None)
    rejected = unreadable.select(F.lit("normalize").alias("stage"), "reason", "source_ref", "source_row", "payload", none.cast(readable.select(as_record.alias("r")).schema["r"].dataType).alias("record"))
    for stage, reason, df in (("filter", F.col("reason"), filtered), ("exact_dedup", F.lit("exact_duplicate"), copies), ("near_dedup", F.lit("near_duplicate_cluster_cap"), over)):
        rejected = rejected.unionByName(df.select(F.lit(stage).alias("stage"), reason.alias("reason"), "source_ref", "source_row", none.cast("string").alias("payload"), as_record.alias("record")))
    return {"raw": records, "normalized": readable, "rejected": rejected, "curated": curated}


def _clusters(unique: DataFrame, s: BuildSettings) -> DataFrame:
    """(source_row, cluster_id, cluster_size, kept): clusters over rows, named by their posts' ids."""
    sized = () if s.mode == "exact" else (s.permutations, s.bands)
    pairs = (dedup.near_pairs if s.mode == "exact" else dedup.lsh_pairs)(unique, "source_row", "text_train", s.shingle, s.similarity, *sized)
    found = dedup.connected_components(pairs, "a", "b").withColumnRenamed("node", "source_row")
    rows = unique.select("source_row", "post_id", "created_at_utc").join(found, "source_row", "left")
    rows = rows.withColumn("c", F.coalesce("component", "source_row")).drop("component")
    names = rows.groupBy("c").agg(F.array_sort(F.collect_list("post_id")).alias("ids"), F.count(F.lit(1)).alias("cluster_size"))
    name = F.substring(F.sha2(F.array_join("ids", "\x00"), 256), 1, 16)
    rows = rows.join(names.select("c", name.alias("cluster_id"), "cluster_size"), "c")
    return dedup.cap_clusters(rows, "source_row", "created_at_utc", s.cluster_cap).select("source_row", "cluster_id", "cluster_size", "kept")


def build(spark: SparkSession, source: str, target: str, settings: BuildSettings, version: str = "none") -> dict:
    """Read, curate and publish. Returns the manifest; its dataset_id depends on the input and the settings only."""
    records = read_records(spark, source)
    if records.isEmpty():
        raise DataError(f"no records in {source}")
    layers = curate(records, settings, version)
    curated = layers["curated"]
    sft = curated.select(*prompts.sft_record(settings.system, settings.context), "split", "created_at_utc", "post_id")
    out = {
        "raw/source": (records, ["source_row"]),
        "normalized/posts": (layers["normalized"], ["source_row"]),
        "rejected/posts": (layers["rejected"], ["stage", "source_row"]),
        "curated/posts": (curated, ["created_at_utc", "post_id", "source_row"]),
    }
    for name in SPLITS:
        out[f"curated/{name}"] = (sft.where(F.col("split") == name).select("prompt", "completion", "metadata"), ["metadata.created_at_utc", "metadata.post_id"])
    identity = {"dataset_version": settings.version, "input_sha256": rows_hash(records, "source_row"), "config_sha256": canonical_hash(settings.__dict__), "approval": version}
    counts = {name: df.count() for name, df in layers.items()}
    splits = {r.split: r.n for r in curated.groupBy("split").agg(F.count(F.lit(1)).alias("n")).collect()}
    manifest = identity | {
        "dataset_id": canonical_hash(identity)[:20],
        "counts": {"source": counts["raw"], "normalized": counts["normalized"], "curated": counts["curated"], "rejected": counts["rejected"], "splits": splits},
        "quality": {"group_leakage": 0, "raw_is_lossless_envelope": True},
    }
    return publish_layers(spark, target, out, manifest)


def evaluate(generated: DataFrame, reference: DataFrame, training: DataFrame, *, key: str = "idx", text: str = "text", span: int = overlap.SPAN, jaccard: float = overlap.SIMILARITY, **gate: float) -> dict:
    """Report on generated texts: style distance, diversity, overlap with training texts, gate. No text is echoed."""
    for name, df in (("generated", generated), ("reference", reference)):
        if df.isEmpty():
            raise DataError(f"no {name} texts")
    profiles = {name: stylometry.corpus_profile(df, text) for name, df in (("candidate", generated), ("reference", reference))}
    distance = stylometry.profile_distance(profiles["candidate"], profiles["reference"])
    diversity = {f"distinct_{r.n}": r.ratio for r in stylometry.distinct_n(generated, (2, 3), text).collect()}
    matches = stash(overlap.find_best_matches(generated, training, key, key, text, text), "matches")
    summary = overlap.overlap_summary(matches, span, jaccard)
    one = summary.withColumn("_one", F.lit(1)).join(distance.withColumn("_one", F.lit(1)), "_one").withColumn("distinct_2", F.lit(float(diversity["distinct_2"])))
    checks = overlap.evaluation_gate(one, **gate).collect()[0].asDict()
    flagged = matches.where(overlap.flagged(span, jaccard)).withColumn("jaccard", F.round("jaccard", 6)).orderBy("gen")
    return {
        "counts": {"generated": generated.count(), "reference": reference.count(), "training": training.count()},
        "style": {f"{n}_profile": p.collect()[0].asDict() for n, p in profiles.items()} | {"distance": one.collect()[0].distance},
        "diversity": diversity,
        "memorization": summary.collect()[0].asDict(),
        "flagged": flagged,
        "automatic_gate": {"passed": checks.pop("passed"), "checks": checks},
    }


def guard_outputs(outputs: DataFrame, training: DataFrame, rules: dict[str, str], *, key: str = "request_id", text: str = "text", train_key: str = "idx", span: int = overlap.SPAN, jaccard: float = overlap.SIMILARITY) -> DataFrame:
    """(key, code) for every generated text: empty_generation, the first rule found, training_overlap or allowed."""
    clean = outputs.select(key, strip(nfkc(F.coalesce(text, F.lit("")))).alias("_text"))
    best = overlap.find_best_matches(clean, training, key, train_key, "_text", "text").withColumnRenamed("gen", key)
    code = F.when(F.col("_text") == "", "empty_generation").otherwise(
        F.coalesce(filters.first_rule(F.col("_text"), rules), F.when(overlap.flagged(span, jaccard), "training_overlap"), F.lit("allowed"))
    )
    return clean.join(best, key).select(key, code.alias("code"))


def guard_requests(requests: DataFrame, rules: dict[str, str], columns: tuple[str, ...] = ("topic", "intent", "historical_context")) -> DataFrame:
    """``requests`` with ``code``: the first rule found in the normalised request, else allowed. Also for streams."""
    text = nfkc(F.concat_ws("\n", *columns))
    return requests.withColumn("code", F.coalesce(filters.first_rule(text, rules), F.lit("allowed")))
