"""Encoding of whole texts with a byte-level BPE vocabulary.

Method: forced boundaries. The byte pairs that occur inside no token of the vocabulary are read off the vocabulary
itself. A text is cut before a blank or line break that follows a visible character where that byte pair is among
them: no token can span the cut, and the pattern that splits text before the merges never matches across it (only
white space may be followed by white space in one match, and the look-ahead for the end of white space is decided on
the right side of the cut alone). The fragments are encoded independently and each distinct fragment of a batch only
once; the ids are then concatenated.

Defined results: null and empty texts get an empty list; special tokens' strings are ordinary text; rows are kept
as they come, repeated keys included; other columns are never read.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most fragments that a Python worker remembers from batch to batch.
REMEMBERED = 200_000
BLANKS = b" \n\r\t"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def never_inside(ranks: dict[bytes, int]) -> np.ndarray:
    """Table of 256 x 256: true where the byte pair occurs inside no token."""
    joined = np.ones((256, 256), dtype=bool)
    for token in ranks:
        if len(token) > 1:
            b = np.frombuffer(token, dtype=np.uint8)
            joined[b[:-1], b[1:]] = False
    return joined


class Encoder:
    """Encodes Arrow string arrays; made once in each Python worker from the vocabulary's bytes."""

    _made: dict[int, "Encoder"] = {}

    def __init__(self, data: bytes, pattern: str) -> None:
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        never = never_inside(ranks)
        # Cuts come only before these blanks; the byte before must be the end of a visible character.
        self.cut = np.zeros((256, 256), dtype=bool)
        visible = np.array([b > 0x20 and b != 0x7F for b in range(256)])
        for blank in BLANKS:
            self.cut[:, blank] = visible & never[:, blank]
        self.known: dict[str, np.ndarray] = {}

    @classmethod
    def of(cls, data: bytes, pattern: str) -> "Encoder":
        key = hash((data, pattern))
        if key not in cls._made:
            cls._made[key] = cls(data, pattern)
        return cls._made[key]

    def fragments(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All fragments of the texts in order, and the number of fragments of each text."""
        texts = texts.cast(pa.large_string()).fill_null("")
        n = len(texts)
        if n == 0:
            return pa.array([], pa.large_string()), np.zeros(0, np.int64)
        buffers = texts.buffers()
        ends = np.frombuffer(buffers[1], dtype=np.int64)[texts.offset : texts.offset + n + 1]
        if ends[-1] == ends[0]:
            return pa.array([], pa.large_string()), np.zeros(n, np.int64)
        data = np.frombuffer(buffers[2], dtype=np.uint8)
        lo, hi = int(ends[0]), int(ends[-1])
        part = data[lo:hi]
        blank = np.flatnonzero((part == 32) | (part == 10) | (part == 13) | (part == 9))
        blank = blank[blank > 0]
        before = part[blank - 1]
        good = self.cut[before, part[blank]]
        # A multi-byte character before the cut must not be a blank itself: two-byte characters from C3 on never are,
        # others are left uncut.
        wide = before >= 0x80
        lead = part[np.maximum(blank - 2, 0)]
        good &= ~wide | ((lead >= 0xC3) & (lead <= 0xDF))
        cuts = blank[good] + lo
        starts = ends[:-1][ends[:-1] < ends[1:]]
        points = np.union1d(cuts, starts)
        counts = np.searchsorted(points, ends[1:]) - np.searchsorted(points, ends[:-1])
        offsets = np.append(points, hi).astype(np.int64)
        pieces = pa.LargeStringArray.from_buffers(len(points), pa.py_buffer(offsets), buffers[2])
        return pieces, counts.astype(np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the number of ids of each text."""
        pieces, counts = self.fragments(texts)
        if len(pieces) == 0:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        coded = pieces.dictionary_encode()
        if len(self.known) > REMEMBERED:
            self.known.clear()
        values = []
        for piece in coded.dictionary.to_pylist():
            ids = self.known.get(piece)
            if ids is None:
                ids = np.array(self.encoding.encode_ordinary(piece), dtype=np.int32)
                if len(piece) < 64:
                    self.known[piece] = ids
            values.append(ids)
        lengths = np.array([len(v) for v in values], dtype=np.int64)
        flat = np.concatenate(values)
        first = np.cumsum(lengths) - lengths
        which = coded.indices.to_numpy(zero_copy_only=False)
        each = lengths[which]
        total = np.cumsum(each)
        # Position of every id in ``flat``: the fragment's first id plus the place within the fragment.
        ids = flat[np.repeat(first[which] - (total - each), each) + np.arange(int(total[-1]))]
        edge = np.concatenate([[0], total])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(edge)


def _encode_with(df: DataFrame, key: str, text: str, vocabulary: str | None, pattern: str | None, ids: bool) -> DataFrame:
    with open(vocabulary or vocabulary_path(), "rb") as f:
        data = f.read()
    shared = df.sparkSession.sparkContext.broadcast(data)  # one vocabulary file, a few MB at most
    pattern = pattern or split_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(shared.value, pattern)
        for batch in batches:
            values, counts = encoder.encode(batch.column(1))
            if ids:
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                second = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            else:
                second = pa.array(counts.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), second], names=[key, "ids" if ids else "n_tokens"])

    kind = dict(df.dtypes)[key]
    out = f"`{key}` {kind}, " + ("ids array<int>" if ids else "n_tokens int")
    return df.select(F.col(key), F.col(text)).mapInArrow(run, out)


def encode_texts(
    df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(key, ids) for every row. Narrow: one scan of two columns, nothing is shuffled."""
    return _encode_with(df, key, text, vocabulary, pattern, ids=True)


def count_tokens(
    df: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str | None = None, pattern: str | None = None
) -> DataFrame:
    """(key, n_tokens) for every row."""
    return _encode_with(df, key, text, vocabulary, pattern, ids=False)
