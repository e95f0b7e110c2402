"""Nested prompt and completion records from labelled posts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def prompt(system: str, context: str) -> Column:
    """System and user message from the columns topic, intent and length_bucket; null labels are skipped lines."""
    lines = [("Topic: ", F.col("topic")), ("Intent: ", F.col("intent")), ("Length: ", F.col("length_bucket")), ("Time context: ", F.lit(context))]
    user = F.concat_ws("\n", *[F.concat(F.lit(name), value) for name, value in lines])
    return F.array(_message("system", F.lit(system)), _message("user", user))


def completion(text: str = "text_train") -> Column:
    return F.array(_message("assistant", F.col(text)))


def sft_record(system: str, context: str) -> list[Column]:
    """Columns prompt, completion and metadata of a curated post."""
    meta = "post_id created_at_utc topic intent tone_tags near_dup_cluster_id conversation_id manifest_version".split()
    return [prompt(system, context).alias("prompt"), completion().alias("completion"), F.struct(*meta).alias("metadata")]


def extracted_text(record: Column) -> Column:
    """The text of a JSON record to evaluate: the first non-blank of the text fields, else the last completion, else
    the last assistant message; null if there is none."""
    fields = [F.get_json_object(record, f"$.{k}") for k in ("generated_text", "text", "text_train", "content")]
    filled = [F.when(F.rlike(f, F.lit(r"[^\s\p{Z}]")), f) for f in fields]
    messages = "array<struct<role:string,content:string>>"
    done = F.try_element_at(F.from_json(F.get_json_object(record, "$.completion"), messages), F.lit(-1))["content"]
    said = F.filter(F.from_json(F.get_json_object(record, "$.messages"), messages), lambda m: m["role"] == "assistant")
    return F.coalesce(*filled, done, F.try_element_at(said, F.lit(-1))["content"])
