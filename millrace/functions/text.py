"""Column expressions on text. All stay in the JVM but normal forms, entities and exact case folding, which are Arrow UDFs."""

from __future__ import annotations

import html
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Character classes. WORD is the class of word characters, SPACE every kind of white space.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x{85}\x{1c}-\x{1f}\p{Z}"
TOKEN = r"[\p{L}\p{N}_']+|[!?]+"


def fold(text: Column) -> Column:
    """Case folding: upper case expands the sharp s and ligatures, then lower case; both small sigmas become one."""
    return F.replace(F.lower(F.replace(F.upper(text), F.lit("ẞ"), F.lit("SS"))), F.lit("ς"), F.lit("σ"))


def simple_fold(text: Column) -> Column:
    """Lower case with sharp s as ss and final sigma as sigma; SQL engines can follow it exactly."""
    return F.replace(F.replace(F.lower(text), F.lit("ß"), F.lit("ss")), F.lit("ς"), F.lit("σ"))


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, f"^[{SPACE}]+|[{SPACE}]+$", "")


def alnum(text: Column) -> Column:
    """Only the letters and digits of the folded text."""
    return F.regexp_replace(fold(text), r"[^\p{L}\p{N}]+", "")


def tokens(text: Column) -> Column:
    """Words and runs of ! or ? of the folded text, in order."""
    return F.regexp_extract_all(simple_fold(text), F.lit(TOKEN), F.lit(0))


def fingerprint(text: Column) -> Column:
    return F.array_join(tokens(text), " ")


def bind(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f(value)`` with ``value`` computed once, however often ``f`` uses it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def ngrams(toks: Column, n: int) -> Column:
    """All runs of ``n`` tokens joined by blanks; empty when there are fewer than ``n``."""

    def runs(t: Column) -> Column:
        some = F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)), lambda i: F.array_join(F.slice(t, i, n), " "))
        return F.when(F.size(t) >= n, some).otherwise(F.array().cast("array<string>"))

    return bind(toks, runs)


# White space that isn't a line feed, links, mentions and hashtags.
INLINE = r" \t\x{0b}\x{0c}\r\x{1c}-\x{1f}\x{85}\p{Z}"
URL = r"(?i)https?://[^\s\x{85}\x{1c}-\x{1f}\p{Z}]+"
MENTION = rf"(?<![{WORD}])@[A-Za-z0-9_]+"
LINK_ONLY = r"(?i)^(?:https?://[^\s\x{85}\x{1c}-\x{1f}\p{Z}]+[\s\x{85}\x{1c}-\x{1f}\p{Z}]*)+$"


@F.pandas_udf(StringType())
def _unescape_nfc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", html.unescape(t)))


@F.pandas_udf(StringType())
def _nfkc(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


@F.pandas_udf(StringType())
def _casefold(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: None if t is None else t.casefold())


def _where(odd: str, text: Column, udf) -> Column:
    """``udf`` on the texts that match ``odd``; only these are sent to Python."""
    return F.coalesce(udf(F.when(F.rlike(text, F.lit(odd)), text)), text)


def unescape_nfc(text: Column) -> Column:
    """HTML entities resolved, then canonical composition."""
    return _where(r"[^\x{00}-\x{7f}]|&", text, _unescape_nfc)


def nfkc(text: Column) -> Column:
    return _where(r"[^\x{00}-\x{7f}]", text, _nfkc)


def casefold_exact(text: Column) -> Column:
    """Full case folding of all code points, where ``simple_fold`` leaves the rarest."""
    return _where(r"[^\x{00}-\x{7f}]", F.lower(text), _casefold)


def squeeze_space(text: Column) -> Column:
    """Line feeds only, blanks squeezed within lines, lines stripped, at most one empty line in a row."""
    value = F.regexp_replace(text, r"\r\n?", "\n")
    value = F.regexp_replace(value, r"[ \t\x{0b}\x{0c}]+", " ")
    value = F.regexp_replace(value, rf"[{INLINE}]*\n[{INLINE}]*", "\n")
    return strip(F.regexp_replace(strip(value), r"\n{3,}", "\n\n"))


def replace_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL, "<URL>")


def replace_mentions(text: Column) -> Column:
    return F.regexp_replace(text, MENTION, "<USER>")


def normalise_text(text: Column, urls: bool = True, mentions: bool = True) -> Column:
    value = squeeze_space(unescape_nfc(text))
    value = replace_urls(value) if urls else value
    return replace_mentions(value) if mentions else value


def is_link_only(text: Column) -> Column:
    return F.rlike(strip(text), F.lit(LINK_ONLY))


def count_matches(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def count_characters(text: Column, kind: str) -> Column:
    """Number of characters of a class, given as its inside: whole runs of others are dropped at once."""
    return F.length(F.regexp_replace(text, f"[^{kind}]+", ""))
