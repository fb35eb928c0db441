"""Language ID with language-bitmask n-gram filters: a bit-sliced Bloom filter per model.

Every slot of the filter holds one bit per language.  An n-gram (four bytes
of normalised UTF-8) is looked up once: the AND of its slots is the set of all
languages that contain it.  Per language the hits over a whole text are
counted, the share that false positives explain is taken out, and the largest
corrected share decides.

Learning counts n-grams over every learning row (partial counts per task,
summed by key).  An n-gram belongs to a language if it makes up at least
``min_share`` of the n-grams of that language, so a language has at most
``1 / min_share`` members and the filter a proven size, whatever the corpus;
with 0 every n-gram of the learning rows is a member.  A filter beyond
``FILTER_BYTES`` is an error before anything is gathered, never a silent cut.

Edge cases: a null text, or one without a letter, is ``und`` with score 0.
Rows with a null language are predicted but not learned from.  Ties, and
texts without a known n-gram, go to the language with more learning text,
then to the first by name.  With nothing learned every text is ``und``.  A
null id counts as the empty string when rows are held out.  Repeated rows
count as often as they occur.  Very long texts become n-grams a piece at a
time.  Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop_table, write_table

UNKNOWN = "und"
GRAM = 4
#: Least share of a language's n-grams for membership; bounds a language to 1 / MIN_SHARE members.
MIN_SHARE = 5e-5
#: Most bytes of a filter (every Python worker holds one).
FILTER_BYTES = 256 << 20
SLOTS_PER_GRAM = 16
#: Odd multipliers of the slot hashes (from the golden ratio and its powers).
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
FOLDS = 5
#: A text is rejected below this share of this quantile of its language's learning scores.
LOW_QUANTILE, LOW_SHARE = 0.001, 0.5
#: Bytes of text that a task turns into n-grams at once.
CHUNK_BYTES = 4 << 20
#: Characters of a text that are normalised at once; a piece ends at white space if there is some in as many more.
PIECE_CHARS = 1 << 19
#: Distinct n-grams that a task holds before it hands on its partial counts.
FLUSH_GRAMS = 500_000

#: ASCII bytes other than letters become spaces.
_FOLD = bytes(b if b >= 0x80 or chr(b).isalpha() else 0x20 for b in range(256))


SPACE = re.compile(r"[ \t\n\r]")


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _text_pieces(text: str) -> Iterator[str]:
    at = 0
    while at < len(text):
        end = at + PIECE_CHARS
        if end < len(text):
            gap = SPACE.search(text, end, end + PIECE_CHARS)
            end = gap.start() if gap else end
        yield text[at:end]
        at = end


def gram_parts(text: str) -> Iterator[np.ndarray]:
    """The four-byte n-grams of ``text``, lower-cased, with runs of non-letters as one space, as 32-bit words, a piece at a time."""
    carry, gap = b" ", False  # the line begins with a space; a gap is a space still to come
    for piece in _text_pieces(text):
        raw = piece.lower().encode("utf-8", "replace").translate(_FOLD)
        words = raw.split()
        if not words:
            gap = gap or bool(raw)
            continue
        begins = carry != b" " and (gap or raw[:1] == b" ")
        line = carry + b" " * begins + b" ".join(words)
        gap = raw[-1:] == b" "
        yield _words(line)
        carry = line[1 - GRAM :]
    if carry != b" ":
        yield _words(carry + b" ")


def _words(line: bytes) -> np.ndarray:
    raw = np.frombuffer(line, np.uint8).astype(np.uint32)
    if len(raw) < GRAM:
        return np.empty(0, np.uint32)
    return raw[:-3] | raw[1:-2] << np.uint32(8) | raw[2:-1] << np.uint32(16) | raw[3:] << np.uint32(24)


def grams(text: str) -> np.ndarray:
    """All n-grams of a text, in order."""
    parts = list(gram_parts(text))
    return np.concatenate(parts) if parts else np.empty(0, np.uint32)


@dataclass(frozen=True)
class LanguageFilter:
    """``languages`` in bit order; ``slices[w]``: the slots with the bits of languages 64w .. 64w + 63."""

    languages: tuple[str, ...]
    slices: tuple[np.ndarray, ...]
    false_rate: np.ndarray
    fallback: int

    @classmethod
    def build(cls, languages: list[str], members: dict[str, np.ndarray], volume: dict[str, int]) -> "LanguageFilter":
        size = cls.slots(sum(len(m) for m in members.values()))
        slices = []
        for lo in range(0, len(languages), 64):
            slots = np.zeros(size, np.uint64)
            for bit, lang in enumerate(languages[lo : lo + 64]):
                for at in cls.places(members.get(lang, np.empty(0, np.uint32)), size):
                    slots[at] |= np.uint64(1 << bit)
            slices.append(slots)
        full = [np.count_nonzero(slices[i // 64] >> np.uint64(i % 64) & np.uint64(1)) / size for i in range(len(languages))]
        best = min(range(len(languages)), key=lambda i: (-volume.get(languages[i], 0), languages[i])) if languages else -1
        return cls(tuple(languages), tuple(slices), np.array(full) ** len(MULTIPLIERS), best)

    @staticmethod
    def slots(members: int) -> int:
        return 1 << max(10, (SLOTS_PER_GRAM * members).bit_length())

    @staticmethod
    def places(words: np.ndarray, size: int) -> list[np.ndarray]:
        shift = np.uint64(64 - size.bit_length() + 1)
        with np.errstate(over="ignore"):
            return [(words.astype(np.uint64) * np.uint64(m)) >> shift for m in MULTIPLIERS]

    def hits(self, words: np.ndarray) -> np.ndarray:
        """Per language, how many of ``words`` the filter says it contains."""
        at = self.places(words, len(self.slices[0]))
        counts = []
        for i, slots in enumerate(self.slices):
            mask = slots[at[0]] & slots[at[1]] & slots[at[2]]
            sets, n = np.unique(mask, return_counts=True)
            for bit in range(min(64, len(self.languages) - 64 * i)):
                counts.append(int(n[(sets >> np.uint64(bit) & np.uint64(1)).astype(bool)].sum()))
        return np.array(counts)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.languages or not has_letter(text):
            return UNKNOWN, 0.0
        found, n = np.zeros(len(self.languages), np.int64), 0
        for words in gram_parts(text):
            if len(words):
                found += self.hits(words)
                n += len(words)
        if not n:
            return self.languages[self.fallback], 0.0
        # of n grams, s belong: hits = s + (n - s) * false_rate
        share = (found / n - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9)
        share = np.clip(share, 0.0, 1.0)
        best = max(range(len(share)), key=lambda i: (share[i], i == self.fallback, -i))
        return self.languages[best], float(share[best])


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> partial (lang, gram, n); what a task holds is bounded by FLUSH_GRAMS and CHUNK_BYTES."""
    held: dict[str, list] = {}
    counts: dict[str, tuple] = {}

    def settle(lang: str) -> None:
        parts = held.pop(lang, [])
        if parts:
            seen = pc.value_counts(pa.array(np.concatenate(parts)))
            old = counts.get(lang)
            keys, n = seen.field(0).to_numpy(), seen.field(1).to_numpy()
            if old is not None:
                keys, n = np.concatenate((old[0], keys)), np.concatenate((old[1], n))
                order, inverse = np.unique(keys, return_inverse=True)
                keys, n = order, np.bincount(inverse, n).astype(np.int64)
            counts[lang] = (keys, n)

    def flush() -> Iterator[pa.RecordBatch]:
        for lang in list(held):
            settle(lang)
        for lang, (keys, n) in counts.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])
        counts.clear()

    waiting = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for words in gram_parts(text):
                held.setdefault(lang, []).append(words)
                waiting += len(words)
                if waiting > CHUNK_BYTES:
                    for name in list(held):
                        settle(name)
                    waiting = 0
        if sum(len(k) for k, _ in counts.values()) > FLUSH_GRAMS:
            yield from flush()
    yield from flush()


def held_out(id_col: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_share: float = MIN_SHARE) -> LanguageFilter:
    """The filter learned from the rows that are not held out and have a language and a text."""
    rows = docs.filter(~held_out(id_col)).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = rows.mapInArrow(_count_grams, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    counts = write_table(counts, "language_grams")
    sums = write_table(counts.groupBy("lang").agg(F.sum("n").alias("volume")), "language_volumes")
    chosen = counts.join(F.broadcast(sums) if sums.count() <= 10_000 else sums, "lang").filter(F.col("n") >= F.col("volume") * min_share).select("lang", "gram")
    n, languages = chosen.count(), sums.count()
    if 8 * LanguageFilter.slots(n) * -(-languages // 64) > FILTER_BYTES:
        raise ValueError(f"a filter of {n} n-grams of {languages} languages exceeds {FILTER_BYTES} bytes; raise min_share")
    volume = {r["lang"]: r["volume"] for r in sums.collect()}
    found = chosen.toArrow()
    drop_table(counts)
    drop_table(sums)
    names = sorted(volume)
    lang = np.asarray(pc.index_in(found["lang"], value_set=pa.array(names, pa.string())))
    words = np.asarray(found["gram"]).astype(np.uint32)
    return LanguageFilter.build(names, {name: np.sort(words[lang == i]) for i, name in enumerate(names)}, volume)


def predictor(docs: DataFrame, model: LanguageFilter):
    """Arrow function: text -> struct(lang_pred, score)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("lang_pred string, score double")
    def predict(texts: pa.Array) -> pa.Array:
        found = [shared.value.predict(t) for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())], ["lang_pred", "score"])

    return predict


def languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_share: float = MIN_SHARE) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score."""
    predict = predictor(docs, learn(docs, id_col, text_col, lang_col, min_share))
    rows = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), predict(F.col(text_col)).alias("p"))
    return rows.select("doc_id", "held_out", "p.lang_pred", "p.score")


def score_bounds(docs: DataFrame, model: LanguageFilter, quantile: float, share: float) -> dict[str, float]:
    """Per language, ``share`` of a low quantile of the scores of the learning rows that are put in it."""
    rows = docs.filter(~held_out()).filter(F.col("lang").isNotNull()).select(predictor(docs, model)(F.col("text")).alias("p"))
    low = rows.filter("p.score > 0").groupBy("p.lang_pred").agg(F.percentile_approx("p.score", quantile, 10_000).alias("low"))
    return {r["lang_pred"]: share * r["low"] for r in low.collect()}  # one row per language


def keep_identified(docs: DataFrame, quantile: float = LOW_QUANTILE, share: float = LOW_SHARE) -> DataFrame:
    """The rows of ``docs`` whose text is put in some learned language, all columns as they are.

    Rejected are ``und``, texts without one n-gram of any language (which only
    the fallback would name), and those that score below ``share`` of what
    nearly all learning rows of their language reach: another language or
    script, or noise.
    """
    model = learn(docs)
    bounds = score_bounds(docs, model, quantile, share)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), predictor(docs, model)(F.col("text")).alias("p"))
    bound = F.coalesce(*[F.when(F.col("p.lang_pred") == lang, F.lit(b)) for lang, b in sorted(bounds.items())], F.lit(0.0))
    return rows.filter((F.col("p.lang_pred") != UNKNOWN) & (F.col("p.score") > 0) & (F.col("p.score") >= bound)).select("row.*")
