"""One form for texts that look the same.

Method: look-alike classes are the transitive classes, by union-find, of strings and code points: a code point and its
compatibility form, a special blank and the plain blank, a character without width and the empty string, a Cyrillic or
Greek letter and the Latin letter of the same shape. A class may hold single code points and one spelling in atoms,
that is, in code points that no rule takes apart any further. Among a class's atoms the representative is the one of
the script with the most letters in the whole corpus, then the most frequent; a class that is spelled in several atoms
is represented by their representatives. Texts are rewritten greedily from left to right by an automaton over all code
points that aren't representatives, after accents have been parted from their letters (so that a letter under an accent
is seen) and before they are joined again.

Every pattern is one code point and every representative consists of code points that aren't patterns, so a text's
form doesn't depend on where a match begins: two texts with one spelling in atoms' representatives have one form.

Defined results: a null text has a null form; case, accents, line breaks, tabs and the number of blanks stay; a form
may be empty; repeated keys and texts are kept as rows; an empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.kernels import code_points, texts_of
from millrace.runtime import stash

# Letters shaped like a Latin letter, as pairs of the letter and the Latin one.
CYRILLIC = "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ҮY ԚQ ԜW ӀI аa еe оo рp сc уy хx ѕs іi јj һh ԁd ԛq ԝw ӏl ѵv ҽe"
GREEK = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ͿJ οo νv ρp ϲc ϳj αa ιi κk υu χx"
SHAPED = {pair[0]: pair[1] for pair in (CYRILLIC + " " + GREEK).split()}
# Format characters that are visible all the same, and other characters without width.
VISIBLE_FORMAT = {*range(0x0600, 0x0606), 0x06DD, 0x070F, 0x08E2, 0x110BD, 0x110CD}
WITHOUT_WIDTH = {0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}


def plain_of(char: str) -> str:
    """What a single code point looks like by the rules that aren't about shape."""
    category = unicodedata.category(char)
    code = ord(char)
    if code in WITHOUT_WIDTH or (category == "Cf" and code not in VISIBLE_FORMAT):
        return ""
    if category == "Zs":
        return " "
    return unicodedata.normalize("NFKD", char)


class Classes:
    """Union-find over strings."""

    def __init__(self) -> None:
        self.parent: dict[str, str] = {}

    def find(self, x: str) -> str:
        self.parent.setdefault(x, x)
        root = x
        while self.parent[root] != root:
            root = self.parent[root]
        while self.parent[x] != root:
            self.parent[x], x = root, self.parent[x]
        return root

    def union(self, a: str, b: str) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[b] = a

    def members(self) -> list[list[str]]:
        out: dict[str, list[str]] = {}
        for x in self.parent:
            out.setdefault(self.find(x), []).append(x)
        return list(out.values())


def atoms_of(char: str) -> str:
    """The spelling of a code point in atoms."""
    plain = plain_of(char)
    return char if plain == char else "".join(atoms_of(c) for c in unicodedata.normalize("NFD", plain))


def script_of(atom: str) -> str:
    return unicodedata.name(atom, "?").split()[0] if unicodedata.category(atom)[0] == "L" else ""


def plain_shape(char: str) -> str:
    """A code point in atoms of Latin shape: what the class of each atom holds if Latin is the frequent script."""
    return "".join(SHAPED.get(a, a) for part in unicodedata.normalize("NFD", char) for a in atoms_of(part))


def rewriting(counts: dict[str, int]) -> dict[str, str]:
    """Every code point that isn't its class's representative, with the representative."""
    classes = Classes()
    spelled: dict[str, str] = {}
    often: Counter = Counter()
    for char in {*counts, *SHAPED, *SHAPED.values()}:
        for part in unicodedata.normalize("NFD", char):
            spelled[part] = atoms_of(part)
            classes.union(part, spelled[part])
            for atom in spelled[part]:
                often[atom] += counts.get(char, 0)
                classes.union(atom, SHAPED.get(atom, atom))
    scripts: Counter = Counter()
    for atom, n in often.items():
        scripts[script_of(atom)] += n
    best: dict[str, str] = {}
    for members in classes.members():
        atoms = [m for m in members if len(m) == 1 and spelled.get(m, m) == m]
        first = min(atoms, key=lambda a: (-scripts[script_of(a)], -often[a], a), default=None)
        best |= {m: first for m in atoms}
    settle = lambda part: "".join(best[a] for a in spelled[part])
    return {part: settle(part) for part in spelled if settle(part) != part}


class Rewriter:
    """Greedy rewriting, longest match first, with an Aho-Corasick automaton."""

    def __init__(self, table: dict[str, str]) -> None:
        import ahocorasick

        self.machine = ahocorasick.Automaton()
        for member, best in table.items():
            self.machine.add_word(member, (len(member), best))
        self.machine.make_automaton()
        self.empty = not table
        self.ascii_stays = not any(member.isascii() for member in table)

    def form(self, text: str | None) -> str | None:
        if text is None or (self.ascii_stays and text.isascii()):
            return text
        text = unicodedata.normalize("NFD", text)
        if not self.empty:
            out, at = [], 0
            for end, (length, best) in self.machine.iter_long(text):
                out += (text[at : end + 1 - length], best)
                at = end + 1
            out.append(text[at:])
            text = "".join(out)
        return unicodedata.normalize("NFC", text)


def character_counts(df: DataFrame, text: str = "text") -> dict[str, int]:
    """How often every character occurs in the whole column: at most as many entries as Unicode has code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, dtype=np.int64)
        for batch in batches:
            codes = code_points(texts_of(batch.column(0)))[0]
            some = np.bincount(codes)
            total[: len(some)] += some
            total[10] -= batch.num_rows  # the line breaks between texts
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"c": pa.array([chr(c) for c in found], pa.string()), "n": pa.array(total[found], pa.int64())})

    rows = df.select(F.col(text)).mapInArrow(run, "c string, n bigint").groupBy("c").agg(F.sum("n").alias("n")).collect()
    return {r.c: r.n for r in rows if r.c}


def consistent_forms(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, form) for every row."""
    table = rewriting(character_counts(df, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rewriter = Rewriter(table)
        for batch in batches:
            forms = [rewriter.form(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(forms, pa.string())], names=[key, "_text", "form"])

    kind = dict(df.dtypes)[key]
    return df.select(F.col(key), F.col(text).alias("_text")).mapInArrow(run, f"`{key}` {kind}, _text string, form string")


def found_lookalikes(documents: DataFrame) -> DataFrame:
    """Pairs of documents with visible text that differ but have one form.

    Only digests are shuffled. Equal texts of a form are one side, so a large group of copies is never compared with
    itself; a pair is made for each two documents of different texts, as the result asks.
    """
    digest = lambda c: F.unhex(F.md5(c))
    forms = consistent_forms(documents).where("doc_id is not null and _text is not null")
    forms = forms.where(F.rlike("form", F.lit(r"[^\s\p{Z}\p{C}]")))
    rows = stash(forms.select("doc_id", digest("form").alias("f"), digest("_text").alias("t")), "forms")
    sides = rows.groupBy("f", "t").agg(F.count(F.lit(1)).alias("n"))
    several = sides.groupBy("f").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    sides = stash(sides.join(several, "f").select("f", "t"), "sides")
    docs = rows.join(sides, ["f", "t"])
    pairs = sides.select("f", F.col("t").alias("ta")).join(sides.select("f", F.col("t").alias("tb")), "f").where("ta < tb")
    a = docs.select("f", F.col("t").alias("ta"), F.col("doc_id").alias("a"))
    b = docs.select("f", F.col("t").alias("tb"), F.col("doc_id").alias("b"))
    out = pairs.join(a, ["f", "ta"]).join(b, ["f", "tb"]).where("a <> b")
    return out.select(F.least("a", "b").alias("doc_id_a"), F.greatest("a", "b").alias("doc_id_b")).distinct()
