"""Weak labels from rules, as column expressions only.

Defined results: a null text has null labels (tone tags included); an empty text is topic other, intent comment, tone
neutral, length very_short.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import WORD, bind, count_characters, count_matches

# Keywords, in the order in which the rules are tried.
TOPICS = {
    "economy": "economy jobs cost budget business tax numbers".split(),
    "media": "media report headline coverage press".split(),
    "election": "election vote ballot campaign".split(),
    "foreign_policy": "border country foreign trade treaty".split(),
    "event": "meeting event launch conference rally".split(),
    "education": "student teacher school education".split(),
}
INTENTS = {
    "thank_or_congratulate": ["thank", "congratulations", "congrats"],
    "criticize_or_rebut": ["critic", "excuse", "unfair", "wrong", "failed"],
    "announce_or_update": ["new ", "today", "announce", "report:"],
    "praise": ["great", "fantastic", "beautiful", "achievement"],
}
INTENSIFIERS = "very|great|big|record|tremendous|fantastic"
CONFRONTING = "critic|excuse|unfair|wrong|failed"
UPPER_SHARE = 0.15
LENGTHS = ((8, "very_short"), (20, "short"), (40, "medium"))


def topic(text: Column) -> Column:
    """The topic with most keyword hits; the alphabetically last of equals; other without any hit."""

    def best(low: Column) -> Column:
        hits = lambda k: (F.length(low) - F.length(F.replace(low, F.lit(k), F.lit("")))) / len(k)
        total = lambda keys: functools.reduce(lambda a, b: a + b, [hits(k) for k in keys]).cast("int")
        return F.array_max(F.array(*[F.struct(total(keys).alias("score"), F.lit(name).alias("topic")) for name, keys in TOPICS.items()]))

    name = bind(bind(F.lower(text), best), lambda b: F.when(b["score"] > 0, b["topic"]).otherwise("other"))
    return F.when(text.isNotNull(), name)


def intent(text: Column) -> Column:
    def first(low: Column) -> Column:
        out = F
        for name, words in INTENTS.items():
            out = out.when(functools.reduce(lambda a, b: a | b, [F.contains(low, F.lit(w)) for w in words]), name)
        return out.when(F.contains(low, F.lit("?")), "question_or_challenge").otherwise("comment")

    return F.when(text.isNotNull(), bind(F.lower(text), first))


def whole_word(words: str) -> str:
    return rf"(?i)(?<![{WORD}])(?:{words})(?![{WORD}])"


def tone_tags(text: Column) -> Column:
    cased = F.struct(count_characters(text, r"\p{L}").alias("letters"), count_characters(text, r"\p{Lu}").alias("upper"))
    loud = bind(cased, lambda c: (c["letters"] > 0) & (c["upper"] / F.greatest(c["letters"], F.lit(1)) >= UPPER_SHARE))
    tags = F.array(
        F.when(F.contains(text, F.lit("!")), "emphatic"),
        F.when(F.contains(text, F.lit("?")), "rhetorical"),
        F.when(loud, "uppercase_emphasis"),
        F.when(F.rlike(text, F.lit(whole_word(INTENSIFIERS))), "intensifier"),
        F.when(F.rlike(text, F.lit(whole_word(CONFRONTING))), "confrontational"),
    )
    shown = bind(F.array_compact(tags), lambda t: F.when(F.size(t) > 0, t).otherwise(F.array(F.lit("neutral"))))
    return F.when(text.isNotNull(), shown)


def length_bucket(text: Column) -> Column:
    def name_of(n: Column) -> Column:
        out = F
        for most, name in LENGTHS:
            out = out.when(n <= most, name)
        return out.otherwise("long")

    return F.when(text.isNotNull(), bind(count_matches(text, r"[^\s\x{85}\x{1c}-\x{1f}\p{Z}]+"), name_of))


def period_bucket(created: Column) -> Column:
    return F.substring(created, 1, 7)


def label_columns(text: str = "text_train", created: str = "created_at_utc") -> dict[str, Column]:
    t = F.col(text)
    return {
        "topic": topic(t),
        "intent": intent(t),
        "tone_tags": tone_tags(t),
        "length_bucket": length_bucket(t),
        "period_bucket": period_bucket(F.col(created)),
    }
