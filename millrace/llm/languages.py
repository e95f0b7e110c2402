"""Language of every text and of every segment of a mixed text, with a confidence.

Method: classification by compression. For each language a zstandard compressor holds a raw-content dictionary of that
language; a sentence belongs to the language whose dictionary makes it smallest. The confidence is the margin: the
part of the second smallest size that the smallest saves. Sentences with a margin under ``MARGIN`` are rejected and
take the language of the decided sentence before them, else of the one after; if no sentence of a text is decided, the
text is tried as a whole, and where that is narrow too (under a fifth of ``MARGIN``) it is rejected: it gets the nearest
language (null where all are equally near) with that low confidence, and is in no found case.

The dictionaries are the only thing fitted: on a sample of about ``SAMPLE_ROWS`` labelled rows, chosen by the hash of
their key over the whole table. Labels are wrong in part, so rows that the first dictionaries put elsewhere are left
out of the second. A dictionary holds sentences of frequent words only, each bringing a word or a pair of
neighbours that the ones before it lack, up to ``DICTIONARY_BYTES``. Everything else runs over all rows and whole texts.

Defined results: null texts and texts with fewer than ``LEAST_WORDS`` words outside links, mentions and hashtags get no
language; a table without readable labels gives no languages at all; repeated deliveries of a post count once.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import strip

#: Rows of the labelled sample, bytes of a dictionary, compression level, least margin, least words of a text.
SAMPLE_ROWS, DICTIONARY_BYTES, LEVEL, MARGIN, LEAST_WORDS = 20_000, 131_072, 1, 0.05, 5
#: A word is frequent in a language's sample from this many texts on, and from one in so many texts.
FREQUENT, ONE_IN = 3, 2000
#: A word belongs to a language if its share there is at least this part of its largest share in any.
OWN = 0.5

# Languages with their usual codes and English names.
NAMES = {
    "en": "en eng english",
    "de": "de deu ger german",
    "fr": "fr fra fre french",
    "es": "es spa spanish",
    "pt": "pt por portuguese",
    "it": "it ita italian",
    "nl": "nl nld dut dutch",
    "ru": "ru rus russian",
}
CODES = {name: code for code, names in NAMES.items() for name in names.split()}

JUNK = re.compile(r"https?://\S+|www\.\S+|(?<!\w)[@#]\w+|&\w+;", re.IGNORECASE)
MARKS = ("@", "#", "&", "://", "www.", "WWW.")  # without any of these there is no junk
SENTENCE = re.compile(r"(?<=[.!?…])[\"»”’)\]]*\s+")
WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
COUNTED = re.compile(r"[^\W_]+")


def label_code(label: Column) -> Column:
    """The two-letter code that a label names, whatever its case, blanks and region; null for none of the eight."""
    names = F.create_map(*[F.lit(x) for kv in CODES.items() for x in kv])
    return F.try_element_at(names, F.lower(F.regexp_extract(strip(label), r"^([A-Za-z]+)(?:[-_ (].*)?$", 1)))


def own_words(samples: dict[str, list[str]]) -> dict[str, set[str]]:
    """Frequent words of each language's sample that aren't far more frequent in another's: what wrong labels bring
    into a sample is rarer there than in the sample it belongs to."""
    shares: dict[str, dict[str, float]] = {}
    counts: dict[str, Counter] = {}
    for code, texts in samples.items():
        often: Counter = Counter()
        for t in texts:
            often.update(set(WORD.findall(t)))
        counts[code] = often
        shares[code] = {w: n / len(texts) for w, n in often.items()}
    most: dict[str, float] = {}
    for share in shares.values():
        for w, x in share.items():
            most[w] = max(most.get(w, 0.0), x)
    return {
        code: {w for w, n in counts[code].items() if n >= max(FREQUENT, len(texts) // ONE_IN) and shares[code][w] >= OWN * most[w]}
        for code, texts in samples.items()
    }


def dense_dictionary(texts: list[str], words: set[str], size: int = DICTIONARY_BYTES) -> bytes:
    """Sentences cut to the given words: those with a new word, and before them, as far as there is room, those with a
    new pair of neighbours. The earliest stand last, nearest to the text that is compressed."""
    seen: set = set()
    with_word: list[bytes] = []
    with_pair: list[bytes] = []
    for t in texts:
        for sentence in SENTENCE.split(t):
            kept = [w for w in WORD.findall(sentence) if w in words]
            pairs = set(zip(kept, kept[1:])) - seen
            fresh = set(kept) - seen
            if fresh or pairs:
                seen |= fresh | pairs
                (with_word if fresh else with_pair).append(" ".join(kept).encode("utf-8", "replace"))
    room = size - sum(len(x) + 1 for x in with_word)
    for i, x in enumerate(with_pair):
        room -= len(x) + 1
        if room < 0:
            with_pair = with_pair[:i]
            break
    return b" ".join([*reversed(with_pair), *reversed(with_word)])[-size:]


def dictionaries_of(samples: dict[str, list[str]]) -> dict[str, bytes]:
    words = own_words(samples)
    return {code: dense_dictionary(texts, words[code]) for code, texts in samples.items()}


class Compressors:
    """One compressor for each language's dictionary."""

    def __init__(self, dictionaries: dict[str, bytes]) -> None:
        import zstandard as z

        self.made = []
        for code, data in sorted(dictionaries.items()):
            d = z.ZstdCompressionDict(data, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            c = z.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
            self.made.append((code, c.compress))

        # A dictionary without a Latin letter saves nothing on ASCII words, which can't hold one of its letters.
        self.latin = [x for x in self.made if re.search(rb"[a-z]", dictionaries[x[0]])]

    def decide(self, words: list[str]) -> tuple[str | None, float]:
        """The language with the smallest size and its margin over the second."""
        joined = " ".join(words)
        data = joined.encode("utf-8", "replace")
        best, low, second = None, 1 << 60, 1 << 60
        for code, compress in self.latin if joined.isascii() else self.made:
            n = len(compress(data))
            if n < low:
                best, low, second = code, n, low
            elif n < second:
                second = n
        return best, (second - low) / second if second < 1 << 60 else 0.0

    def segments(self, text: str) -> list[tuple[str | None, float, str]]:
        """(language, confidence, text) of every longest run of whole sentences of one language."""
        odd = any(mark in text for mark in MARKS)
        words_of = lambda s: WORD.findall((JUNK.sub(" ", s) if odd else s).lower())
        sentences = [s for s in SENTENCE.split(text) if s and s.strip()]
        found: list[tuple[str | None, float, int]] = []
        for s in sentences:
            words = words_of(s)
            code, margin = self.decide(words) if len(words) > 1 else (None, 0.0)
            found.append((code if margin >= MARGIN else None, margin, len(words)))
        if sum(n for _, _, n in found) < LEAST_WORDS and len(COUNTED.findall(JUNK.sub(" ", text))) < LEAST_WORDS:
            return []
        if not any(code for code, _, _ in found):
            code, margin = self.decide(words_of(text))
            return [(code if margin > 0 else None, margin, text.strip())]
        current = next(code for code, _, _ in found if code)
        runs: list[list] = []
        for s, (code, margin, n) in zip(sentences, found):
            current = code or current
            if not runs or runs[-1][0] != current:
                runs.append([current, 0.0, 0, []])
            run = runs[-1]
            if code:
                run[1] += margin * n
                run[2] += n
            run[3].append(s)
        return [(code, total / max(1, n), " ".join(parts)) for code, total, n, parts in runs]


def fit_dictionaries(rows: DataFrame, key: str, text: str, label: str) -> dict[str, bytes]:
    """Raw-content dictionaries by language, from a bounded sample of labelled rows."""
    labelled = rows.select(key, F.col(text).alias("t"), label_code(F.col(label)).alias("l")).where("l is not null and t is not null")
    n = labelled.count()
    if n == 0:
        return {}
    space = 1 << 20
    share = min(space, max(1, SAMPLE_ROWS * space // n))
    sample = labelled.where(F.pmod(F.xxhash64(key), F.lit(space)) < share).limit(2 * SAMPLE_ROWS)
    texts: dict[str, list[str]] = defaultdict(list)
    for r in sorted(sample.collect(), key=lambda r: str(r[0])):
        texts[r.l].append(JUNK.sub(" ", r.t).lower())
    first = Compressors(dictionaries_of(texts))
    clean = {code: [t for t in v if first.decide(WORD.findall(t))[0] == code] or v for code, v in texts.items()}
    return dictionaries_of(clean)


def detect(rows: DataFrame, key: str = "post_id", text: str = "text", label: str = "lang") -> DataFrame:
    """(key, label_code, n_segments, segment_no, lang, confidence, segment) of every text with enough words."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)[key]
    once = rows.where(F.col(key).isNotNull() & F.col(text).isNotNull())
    schema = f"_key {kind}, label_code string, n_segments int, segment_no int, lang string, confidence double, segment string"
    dictionaries = fit_dictionaries(once, key, text, label)
    if not dictionaries:
        return spark.createDataFrame([], schema).withColumnRenamed("_key", key)
    shared = spark.sparkContext.broadcast(dictionaries)  # DICTIONARY_BYTES for each language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = Compressors(shared.value)
        for batch in batches:
            at, count, no, langs, sure, parts = [], [], [], [], [], []
            for i, t in enumerate(batch.column(2).to_pylist()):
                found = compressors.segments(t)
                for j, (code, margin, part) in enumerate(found, 1):
                    at.append(i)
                    count.append(len(found))
                    no.append(j)
                    langs.append(code)
                    sure.append(margin)
                    parts.append(part)
            which = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), batch.column(1).take(which), pa.array(count, pa.int32()), pa.array(no, pa.int32()), pa.array(langs, pa.string()), pa.array(sure, pa.float64()), pa.array(parts, pa.string())],
                names=[c.split()[0] for c in schema.split(", ")],
            )

    out = once.select(F.col(key).alias("_key"), label_code(F.col(label)).alias("label_code"), F.col(text)).mapInArrow(run, schema)
    return out.withColumnRenamed("_key", key)


def found_cases(posts: DataFrame) -> DataFrame:
    """(post_id, segment_no, true_lang): mixed posts, and posts whose label doesn't name their language."""
    found = detect(posts)
    wrong = F.col("label_code").isNull() | (F.col("label_code") != F.col("lang"))
    out = found.where(((F.col("n_segments") > 1) | wrong) & (F.col("confidence") >= MARGIN / 5))
    return out.select("post_id", "segment_no", F.col("lang").alias("true_lang")).distinct()
