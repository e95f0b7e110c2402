"""Vectorised text kernels: whole Arrow batches as arrays of code points, no Python loop over words or characters."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Base of the rolling hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Most cells of a count sketch, hashes for each of them up to which it is used, and the slices in which partial
#: sketches are merged. Beyond that load callers count exactly, by a shuffle.
CELLS, LOAD, SLICES = 1 << 25, 64, 64
#: Least cells of a sketch.
FEWEST = 1 << 16
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values (finaliser with two multiplications)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 20), base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have)
    return have[:n]


@lru_cache(8)
def _field(p: int) -> tuple[int, int]:
    """A base of the prime field ``p`` and its inverse."""
    base = 0x5851F42D % p
    return base, pow(base, -1, p)


_field_powers: dict[tuple[int, int], np.ndarray] = {}


def field_powers(p: int, base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) in the prime field ``p`` (under 2**32), by doubling."""
    have = _field_powers.get((p, base))
    if have is None or len(have) < n:
        have, step = np.ones(1, dtype=np.uint64), base
        while len(have) < n:
            have = np.concatenate([have, have * np.uint64(step) % np.uint64(p)])
            step = step * step % p
        _field_powers[p, base] = have
    return have[:n]


#: Prime fields of the second hash of a stretch.
PRIMES = (4294967291, 4294967279)


def field_hash(codes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """Second hash of the stretches of ``size`` code points: polynomials over two prime fields."""
    out = np.zeros(len(starts), dtype=np.uint64)
    for p in PRIMES:
        base, inverse = _field(p)
        terms = (codes.astype(np.uint64) + np.uint64(1)) * field_powers(p, base, len(codes)) % np.uint64(p)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])  # below 2**64 for 2**32 characters
        value = (sums[starts + size] - sums[starts]) % np.uint64(p) * field_powers(p, inverse, len(codes))[starts] % np.uint64(p)
        out = (out << np.uint64(32)) | value
    return out


def digests(parts: list) -> np.ndarray:
    """128-bit digest of each bytes-like part, as two words: equal digests are taken as equal parts."""
    made = b"".join(blake2b(x, digest_size=16).digest() for x in parts)
    return np.frombuffer(made, dtype=np.uint64).reshape(-1, 2)


def text_digests(texts: list[str]) -> np.ndarray:
    return digests([t.encode("utf-8", "surrogatepass") for t in texts])


def binary16(words: np.ndarray) -> pa.Array:
    """Two words for each row as a binary column."""
    n = len(words)
    offsets = np.arange(0, 16 * (n + 1), 16, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(words))])


def fresh_rows(words: np.ndarray, seen: set[bytes], keep: np.ndarray) -> np.ndarray:
    """True where ``keep`` and the digest comes up for the first time; remembers it."""
    out = np.zeros(len(words), dtype=bool)
    data = words.tobytes()
    for i in np.flatnonzero(keep):
        if (k := data[16 * i : 16 * i + 16]) not in seen:
            seen.add(k)
            out[i] = True
    return out


@lru_cache(1)
def alnum_table() -> np.ndarray:
    """True for letters and digits (categories L and N), by code point."""
    return np.array([unicodedata.category(chr(c))[0] in "LN" for c in range(0x110000)])


@lru_cache(1)
def value_table() -> np.ndarray:
    """A random-looking 64-bit value for every code point."""
    return mix(np.arange(1, 0x110001, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by one line break, and the first position of each text (and the end)."""
    joined = "\n".join(texts) + "\n" if texts else ""
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    return codes, np.concatenate([[0], np.cumsum(lengths)])


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """Sums of values times powers of the base: the hash of any stretch is a difference of two of them."""
    out = np.empty(len(values) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(values * powers(BASE, len(values)), out=out[1:])
    return out


def stretch_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = int(starts.max()) + 1 if len(starts) else 1
    return mix((sums[ends] - sums[starts]) * powers(INVERSE, n)[starts] + (ends - starts).astype(np.uint64))


def owners(first: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The text of each of the ordered positions ``starts``."""
    return np.repeat(np.arange(len(first) - 1), np.diff(np.searchsorted(starts, first)))


class Words:
    """Words (runs of letters and digits, case folded) of a batch: ``hash`` and ``doc`` of each, ``count`` by text."""

    def __init__(self, texts: list[str]) -> None:
        codes, self.first = code_points([t.casefold() for t in texts])
        inside = alnum_table()[codes]
        step = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        starts, ends = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.doc = owners(self.first, starts)
        self.count = np.bincount(self.doc, minlength=len(texts))
        self.letters = np.bincount(self.doc, weights=ends - starts, minlength=len(texts)).astype(np.int64)
        # A word's hash is the sum of a random-looking value of each character at its place in the word.
        size = ends - starts
        self.chars = codes[inside]
        self.ends = np.cumsum(size)
        place = np.arange(len(self.chars), dtype=np.uint64) - np.repeat((self.ends - size).astype(np.uint64), size)
        sums = np.zeros(len(self.chars) + 1, dtype=np.uint64)
        np.cumsum(mix(value_table()[self.chars] + place * np.uint64(BASE)), out=sums[1:])
        self.hash = mix(sums[self.ends] - sums[self.ends - size] + size.astype(np.uint64))

    def sequence_key(self) -> np.ndarray:
        """128-bit digest of each text's sequence of words."""
        # Every word is followed by a line break, which is part of no word.
        flat = np.full(len(self.chars) + len(self.hash), 10, dtype=np.uint32)
        at = np.ones(len(flat), dtype=bool)
        at[self.ends + np.arange(len(self.ends))] = False
        flat[at] = self.chars
        last = np.cumsum(self.count)
        edge = np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=len(self.count), weights=np.diff(self.ends, prepend=0)).astype(np.int64))]) + np.concatenate([[0], last])
        data = memoryview(flat).cast("B")
        return digests([data[4 * a : 4 * b] for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())])

    def runs(self, n: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of all runs of ``n`` words of the texts where ``keep``, in order and with repeats."""
        if len(self.hash) < n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        at = np.flatnonzero((self.doc[: len(self.doc) - n + 1] == self.doc[n - 1 :]) & keep[self.doc[: len(self.doc) - n + 1]])
        value = np.zeros(len(at), dtype=np.uint64)
        for i in range(n):
            value = mix(value * np.uint64(BASE) + self.hash[at + i])
        return self.doc[at], value

    def shingles(self, n: int, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(text, hash) of the distinct runs, ordered by text and hash."""
        doc, value = self.runs(n, keep)
        order = np.lexsort((value, doc))
        doc, value = doc[order], value[order]
        new = fresh(doc, value)
        return doc[new], value[new]


def fresh(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """True at the first of each row of equal (doc, value)."""
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return new


def texts_of(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def sketch_cells(hashes: int) -> int | None:
    """Cells for so many hashes: a power of two with about one hash a cell; None where the load would be too high."""
    if hashes > CELLS * LOAD:
        return None
    return min(CELLS, max(min(FEWEST, CELLS), 1 << max(0, hashes - 1).bit_length()))


def total_length(column: DataFrame, text: str) -> int:
    """Characters of the whole column."""
    return int(column.agg(F.sum(F.length(text))).collect()[0][0] or 0)


def count_sketch(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], cells: int) -> np.ndarray:
    """How often each cell of a table is hit by the hashes of the whole frame.

    One byte for each cell: 0 never, 1 once, and from there 1 + 8 times the binary logarithm of the count. Collisions
    only make counts larger. Every task sends its cells compressed, slices are summed apart, and ``cells`` bytes (see
    ``sketch_cells``) reach the driver.
    """
    import zstandard

    width = cells // SLICES

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(cells, dtype=np.uint16)
        for batch in batches:
            hit = (hashes(batch) & np.uint64(cells - 1)).astype(np.int64)
            hit.sort()
            cell = np.flatnonzero(np.diff(hit, prepend=-1))
            more = counts[hit[cell]] + np.diff(np.append(cell, len(hit)))
            counts[hit[cell]] = np.minimum(more, 65535).astype(np.uint16)
        pack = zstandard.ZstdCompressor(level=1).compress
        slices, blobs = [], []
        for s in range(SLICES):
            part = counts[s * width : (s + 1) * width]
            at = np.flatnonzero(part).astype(np.uint32)
            if len(at):
                gaps = np.diff(at, prepend=np.uint32(0)).astype(np.uint32)
                slices.append(s)
                # Bytes of equal weight side by side compress better.
                planes = np.concatenate([gaps, part[at].astype(np.uint32)]).view(np.uint8).reshape(-1, 4).T
                blobs.append(pack(np.ascontiguousarray(planes).tobytes()))
        yield pa.RecordBatch.from_pydict({"s": pa.array(slices, pa.int32()), "b": pa.array(blobs, pa.binary())})

    def merge(pdf):
        import pandas as pd

        total = np.zeros(width, dtype=np.uint64)
        unpack = zstandard.ZstdDecompressor().decompress
        for blob in pdf["b"]:
            raw = np.frombuffer(unpack(blob), dtype=np.uint8).reshape(4, -1)
            both = np.ascontiguousarray(raw.T).reshape(-1).view(np.uint32)
            half = len(both) // 2
            total[np.cumsum(both[:half], dtype=np.int64)] += both[half:]
        out = np.zeros(width, dtype=np.uint8)
        hit = total > 0
        out[hit] = np.minimum(255, 1 + np.floor(8 * np.log2(total[hit].astype(np.float64)))).astype(np.uint8)
        return pd.DataFrame({"s": [int(pdf["s"].iloc[0])], "b": [zstandard.ZstdCompressor(level=1).compress(out.tobytes())]})

    rows = df.mapInArrow(partial, "s int, b binary").groupBy("s").applyInPandas(merge, "s int, b binary").collect()
    table = np.zeros(cells, dtype=np.uint8)
    for r in rows:
        table[r.s * width : (r.s + 1) * width] = np.frombuffer(zstandard.ZstdDecompressor().decompress(r.b), dtype=np.uint8)
    return table


def first_words(column: pa.Array) -> np.ndarray:
    """The first word of each digest of a binary column."""
    if len(column) == 0:
        return np.zeros(0, np.uint64)
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(-1, 2)[:, 0]


def digest_filter(digests: DataFrame, column: str):
    """Broadcast table that is positive for the first words of all digests of ``column``, and some others; None where
    they are too many for one."""
    n = digests.count()
    if 16 * n > CELLS * LOAD:
        return None
    rows = digests.select(column)
    return shared_table(digests.sparkSession, count_sketch(rows, lambda b: first_words(b.column(0)), sketch_cells(16 * n)))


_tables: dict[str, np.ndarray] = {}


def shared_table(spark: SparkSession, table: np.ndarray):
    """Broadcast of a sketch (a fixed number of bytes); a Python worker unpacks it once and keeps the last two."""
    import uuid

    import zstandard

    name = uuid.uuid4().hex
    blob = spark.sparkContext.broadcast(zstandard.ZstdCompressor(level=1).compress(table.tobytes()))

    def get() -> np.ndarray:
        from millrace.llm import kernels

        if name not in kernels._tables:
            while len(kernels._tables) > 1:
                kernels._tables.pop(next(iter(kernels._tables)))
            kernels._tables[name] = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.value), dtype=np.uint8)
        return kernels._tables[name]

    return get
