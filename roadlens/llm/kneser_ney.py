"""Quality classifier: interpolated modified Kneser-Ney n-gram models of trusted text, one per language.

Tokens are the bytes of the UTF-8 text, so the vocabulary is closed; a text
is preceded by ``ORDER - 1`` begin tokens.  An n-gram is one 64-bit word.

1. Trusted texts (labelled good and not toxic) are counted: partial counts
   per task, summed by (language, n-gram).  No n-gram is left out.
2. Lower orders hold continuation counts: distinct n-grams per suffix.
   Discounts come from the counts of counts of each order and language.
3. ``asked``: the distinct n-grams of all documents, reduced per task before
   they are shuffled.  Sharded joins with the count tables of each order, by
   (language, n-gram), (language, context) and (language, suffix), give the
   log-probability of each n-gram that any document asks for.
4. Texts are dealt into batches of about ``BATCH_BYTES`` (by a hash, so no batch
   is hot), compressed, in one shuffle.  A batch asks for its distinct n-grams
   once, a join with the answers by (language, n-gram) fetches them, and the
   batch meets its own answers in a cogroup, where its texts are scored.  The
   model itself never passes through the driver or one task.
5. Perplexity is per byte.  A document is kept if it lies between two quantiles
   of the trusted documents of its language.  The upper one comes from a fifth of
   the trusted documents that the model never saw (by a hash of the text without
   letter case, so that copies of a training text are not among them); its own
   training texts would look too good.  The lower one comes from all of them, as
   the training texts lie lowest and are good.  The upper quantile is the one of
   ``HIGH_QUANTILES`` with the best balanced accuracy on that fifth and the
   documents labelled bad that the same hash picks (ties: the highest).

Edge cases: a null language is the language ``und``.  Null and empty texts
have no perplexity and are not kept.  In a language without trusted text
nothing can be judged: no perplexity, kept; without an unseen trusted text there are no
bounds: kept; without a document labelled bad the upper quantile is ``HIGH_QUANTILE``.  Labels that repeat a document
must all call it good.  Null labels are not good.  Null ids match no label.
Repeated rows are scored each.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import BinaryType

from .common import drop_table, lower_ascii, small_side, write_table

ORDER = 5
TOKEN_BITS = 9
VOCABULARY = 256
#: One in so many trusted documents sets the bounds instead of training the model.
BOUND_FOLDS = 5
LOW_QUANTILE, HIGH_QUANTILE = 0.002, 0.99
#: The upper quantiles that labelled documents choose from, per language.
HIGH_QUANTILES = (0.9, 0.92, 0.94, 0.95, 0.96, 0.97, 0.98, 0.99, 0.995)
#: Bytes of text that a task turns into n-grams at once.
PIECE_BYTES = 1 << 20
#: Distinct n-grams that a task holds before it hands on its partial counts.
FLUSH_GRAMS = 1_000_000
#: Bytes of text of one scoring batch; a longer text is a batch of its own size.
BATCH_BYTES = 32 << 20
CODEC = "zstd"


def suffix(gram: Column, order: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << (TOKEN_BITS * order)) - 1))


def context(gram: Column) -> Column:
    return F.shiftright(gram, TOKEN_BITS)


# ---- n-grams of texts

def pieces(texts: Iterable[bytes | None]) -> Iterator[list[tuple[int, bytes | None, bytes]]]:
    """Lists of (row, bytes before or None at the beginning, bytes) of PIECE_BYTES or less each; whole texts are covered."""
    held, size = [], 0
    for row, text in enumerate(texts):
        for at in range(0, len(text or b""), PIECE_BYTES):
            body = text[at : at + PIECE_BYTES]
            if held and size + len(body) > PIECE_BYTES:
                yield held
                held, size = [], 0
            held.append((row, text[max(0, at - ORDER + 1) : at] if at else None, body))
            size += len(body)
    if held:
        yield held


def grams(piece: list[tuple[int, bytes | None, bytes]]) -> np.ndarray:
    """The n-grams that end at each byte of the bodies, in order."""
    lead = ORDER - 1
    line = np.frombuffer(b"".join(part for _, before, body in piece for part in (before or bytes(lead), body)), np.uint8)
    codes = line.astype(np.int64) + 1
    sizes = np.array([len(body) + lead for _, _, body in piece])
    starts = np.cumsum(sizes) - sizes
    leads = (starts[:, None] + np.arange(lead)).reshape(-1)
    first = np.repeat([before is None for _, before, _ in piece], lead)
    codes[leads[first]] = 0
    words = np.zeros(len(codes), np.int64)
    for back in range(ORDER):
        words[back:] |= codes[: len(codes) - back] << (TOKEN_BITS * back)
    body = np.ones(len(codes), bool)
    body[leads] = False
    return words[body]


def _by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, list[int], list[bytes | None]]]:
    rows: dict[str, list[int]] = {}
    for i, lang in enumerate(batch.column(0).to_pylist()):
        rows.setdefault(lang, []).append(i)
    texts = batch.column(1)
    for lang, at in rows.items():
        yield lang, at, texts.take(pa.array(at)).to_pylist()


def _merge(old: tuple | None, keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if old is None:
        order = np.argsort(keys)
        return keys[order], n[order]
    found, inverse = np.unique(np.concatenate((old[0], keys)), return_inverse=True)
    return found, np.bincount(inverse, np.concatenate((old[1], n))).astype(np.int64)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> partial (lang, gram, n)."""
    held: dict[str, tuple] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, (keys, n) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys), pa.array(n)], ["lang", "gram", "n"])
        held.clear()

    for batch in batches:
        for lang, _, texts in _by_language(batch):
            for piece in pieces(texts):
                seen = pc.value_counts(pa.array(grams(piece)))
                held[lang] = _merge(held.get(lang), seen.field(0).to_numpy(), seen.field(1).to_numpy())
                if sum(len(k) for k, _ in held.values()) > FLUSH_GRAMS:
                    yield from flush()
    yield from flush()


def gram_counts(texts: DataFrame) -> DataFrame:
    """(lang, gram, n) over all of ``texts(lang, text)``; ``text`` is binary."""
    return texts.mapInArrow(_counts, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


# ---- the model, as tables

def discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3) of one order from its counts of counts (absolute discounts where these are too few)."""
    n = [F.sum((F.col("n") == i).cast("double")).alias(f"n{i}") for i in range(1, 5)]
    c = counts.groupBy("lang").agg(*n)
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    d = [F.col("n1"), F.col("n2"), F.col("n3"), F.col("n4")]
    found = [F.when((d[i] > 0) & (d[i + 1] > 0), F.greatest(F.lit(0.05 * (i + 1)), (i + 1) - (i + 2) * y * d[i + 1] / d[i])).otherwise(F.lit(0.5 * (i + 1))) for i in range(3)]
    return c.select("lang", *[f.alias(f"d{i + 1}") for i, f in enumerate(found)])


def _answers(asked: DataFrame, counts: DataFrame, lower: DataFrame | None, order: int) -> DataFrame:
    """(lang, gram, p) of the ``asked`` n-grams of one order, interpolated with ``lower``, the order below."""
    d = small_side(discounts(counts), 64)
    groups = counts.groupBy("lang", context(F.col("gram")).alias("ctx")).agg(
        F.sum("n").alias("total"),
        *[F.sum((F.col("n") == i).cast("long")).alias(f"t{i}") for i in (1, 2)],
        F.sum((F.col("n") >= 3).cast("long")).alias("t3"),
    )
    rows = asked.withColumn("ctx", context(F.col("gram"))).join(counts, ["lang", "gram"], "left").join(groups, ["lang", "ctx"], "left").join(d, "lang")
    if lower is None:
        rows = rows.withColumn("below", F.lit(1.0 / VOCABULARY))
    else:
        low = lower.select("lang", F.col("gram").alias("low"), F.col("p").alias("below"))
        rows = rows.withColumn("low", suffix(F.col("gram"), order - 1)).join(low, ["lang", "low"])
    n = F.col("n")
    cut = F.when(n == 1, F.col("d1")).when(n == 2, F.col("d2")).otherwise(F.col("d3"))
    own = F.when(n.isNotNull(), F.greatest(n - cut, F.lit(0.0))).otherwise(F.lit(0.0))
    spare = F.col("d1") * F.col("t1") + F.col("d2") * F.col("t2") + F.col("d3") * F.col("t3")
    seen = (own + spare * F.col("below")) / F.col("total")
    return rows.select("lang", "gram", F.when(F.col("total").isNull(), F.col("below")).otherwise(seen).alias("p"))


def log_probabilities(trusted: DataFrame, texts: DataFrame) -> DataFrame:
    """Written table (lang, gram, logp): every distinct n-gram of ``texts`` in the languages of ``trusted``."""
    counts = [write_table(gram_counts(trusted), "grams")]
    for order in range(ORDER - 1, 0, -1):
        counts.append(write_table(counts[-1].groupBy("lang", suffix(F.col("gram"), order).alias("gram")).agg(F.count(F.lit(1)).alias("n")), "grams"))
    counts.reverse()
    known = small_side(counts[0].select("lang").distinct(), 64)
    asked = [write_table(gram_counts(texts).drop("n").join(known, "lang", "left_semi"), "asked")]
    for order in range(ORDER - 1, 0, -1):
        asked.append(write_table(asked[-1].select("lang", suffix(F.col("gram"), order).alias("gram")).distinct(), "asked"))
    asked.reverse()
    answers = None
    for order in range(1, ORDER + 1):
        answers = write_table(_answers(asked[order - 1], counts[order - 1], answers, order), "answers")
    logs = write_table(answers.select("lang", "gram", F.log("p").cast("float").alias("logp")), "log_probabilities")
    for done in (*counts, *asked):
        drop_table(done)
    return logs


# ---- scoring

def _pack(texts: pa.Array) -> pa.Array:
    codec = pa.Codec(CODEC)
    return pa.array([None if t is None else codec.compress(t, asbytes=True) for t in texts.to_pylist()], pa.binary())


def _unpacked(rows: pa.RecordBatch | pa.Table) -> Iterator[tuple[str, list[int], Iterator[bytes]]]:
    """(lang, row numbers, their texts) per language; a text is unpacked when it is asked for and not held."""
    codec, sizes, packed = pa.Codec(CODEC), rows["n_bytes"].to_pylist(), rows["packed"]
    packed = packed.combine_chunks() if isinstance(packed, pa.ChunkedArray) else packed
    by_lang: dict[str, list[int]] = {}
    for i, lang in enumerate(rows["lang"].to_pylist()):
        by_lang.setdefault(lang, []).append(i)
    for lang, at in by_lang.items():
        yield lang, at, (codec.decompress(packed[i].as_py(), sizes[i], asbytes=True) if sizes[i] else b"" for i in at)


def _asked_by_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by batch -> (batch, lang, gram): the distinct n-grams of each batch and language."""
    now, seen = None, {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, keys in seen.items():
            yield pa.RecordBatch.from_arrays([pa.array([now] * len(keys), pa.int64()), pa.array([lang] * len(keys)), pa.array(keys)], ["batch", "lang", "gram"])
        seen.clear()

    for rows in batches:
        numbers = rows.column("batch").to_numpy()
        cuts = np.flatnonzero(np.diff(numbers)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(numbers)]):
            if now is not None and numbers[lo] != now:
                yield from flush()
            now = int(numbers[lo])
            part = rows.slice(lo, hi - lo)
            for lang, _, bodies in _unpacked(part):
                for piece in pieces(bodies):
                    keys = pc.unique(pa.array(grams(piece))).to_numpy()
                    seen[lang] = np.union1d(seen[lang], keys) if lang in seen else np.sort(keys)
    if now is not None:
        yield from flush()


def _scorer(id_type: pa.DataType):
    def score(texts: pa.Table, answers: pa.Table) -> pa.Table:
        """One batch: its texts and the answers to what they ask; sums of log-probabilities per text."""
        known = answers["lang"].combine_chunks().dictionary_encode()
        names, codes = known.dictionary.to_pylist(), known.indices.to_numpy()
        gram, logp = answers["gram"].to_numpy(), answers["logp"].to_numpy()
        sums = np.zeros(len(texts))
        for lang, at, some in _unpacked(texts):
            mine = np.flatnonzero(codes == names.index(lang)) if lang in names else ()
            if not len(mine):
                continue
            mine = mine[np.argsort(gram[mine])]
            keys, values = gram[mine], logp[mine].astype(np.float64)
            for piece in pieces(some):
                words = pa.array(grams(piece)).dictionary_encode()
                found = values[np.searchsorted(keys, words.dictionary.to_numpy())]
                starts = np.cumsum([0] + [len(body) for _, _, body in piece])[:-1]
                rows = np.array([at[row] for row, _, _ in piece])
                np.add.at(sums, rows, np.add.reduceat(found[words.indices.to_numpy()], starts))
        return pa.table({"doc_id": texts["doc_id"].cast(id_type), "lang": texts["lang"], "unseen": texts["unseen"], "n_bytes": texts["n_bytes"], "log_sum": pa.array(sums)})

    return score


def dealt_rows(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The rows of ``docs(doc_id, lang, unseen, text)``, packed, in batches of about ``batch_bytes`` of text."""
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-total // batch_bytes))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    # the place of a row is part of the hash: rows that repeat id and text are dealt out like any others
    batch = F.pmod(F.xxhash64("doc_id", "text", F.monotonically_increasing_id()), F.lit(n)).alias("batch")
    return docs.select("doc_id", "lang", "unseen", size, batch, F.arrow_udf(_pack, BinaryType())("text").alias("packed")).repartition("batch").sortWithinPartitions("batch")


def text_scores(docs: DataFrame, logs: DataFrame, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(doc_id, lang, unseen, n_bytes, log_sum) of every row of ``docs(doc_id, lang, unseen, text)``; ``text`` is binary; 0 without a model."""
    dealt = dealt_rows(docs, batch_bytes)  # both uses below read this one shuffle
    asked = dealt.mapInArrow(_asked_by_batch, "batch long, lang string, gram long")
    answers = asked.join(logs, ["lang", "gram"]).select("batch", "lang", "gram", "logp")
    id_type = docs.schema["doc_id"].dataType
    return dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(
        _scorer(to_arrow_type(id_type)), f"doc_id {id_type.simpleString()}, lang string, unseen boolean, n_bytes long, log_sum double"
    )


def good_documents(labels: DataFrame) -> DataFrame:
    """Written table (good_id): documents that all their labels call good and not toxic."""
    fine = F.coalesce((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0), F.lit(False))
    marks = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(fine).alias("fine"))
    return write_table(marks.filter("fine").select(F.col("doc_id").alias("good_id")), "good_documents")


def bad_documents(labels: DataFrame) -> DataFrame:
    """Written table (bad_id): documents that a label calls bad or toxic."""
    return write_table(labels.filter("doc_id IS NOT NULL AND (quality = 0 OR toxic = 1)").select(F.col("doc_id").alias("bad_id")).distinct(), "bad_documents")


def bounds_of(reference: DataFrame, low: float = LOW_QUANTILE, highs: tuple[float, ...] = HIGH_QUANTILES) -> DataFrame:
    """(lang, low, high) from labelled documents ``reference(lang, perplexity, fine, unseen)``.

    ``low`` is a quantile of all good documents: those that the model was
    trained on lie lowest, and are no worse for it.  ``high`` is one of the
    unseen good documents.
    """
    names = [f"h{i}" for i in range(len(highs))]
    tail = HIGH_QUANTILE if len(highs) > 1 else highs[0]
    q = reference.filter("fine").groupBy("lang").agg(
        F.percentile_approx(F.when(F.col("unseen"), F.col("perplexity")), [*highs, tail], 10_000).alias("q"),
        F.percentile_approx("perplexity", low, 10_000).alias("low"),
    )
    q = q.filter("q IS NOT NULL")
    inside = [F.col("perplexity").between(F.col("low"), F.col("q")[i]) for i in range(len(highs))]
    rates = [(F.avg(F.when(F.col("fine"), i.cast("double"))) + F.avg(F.when(~F.col("fine"), (~i).cast("double")))).alias(n) for i, n in zip(inside, names)]
    rated = reference.filter("unseen").join(small_side(q, 160), "lang").groupBy("lang", "low").agg(F.first("q").alias("q"), *rates)
    # without bad documents there is no rate
    best = F.array_max(F.array(*[F.when(F.col(n).isNotNull(), F.struct(F.col(n).alias("rate"), F.col("q")[i].alias("high"))) for i, n in enumerate(names)]))
    return rated.select("lang", "low", F.coalesce(best["high"], F.col("q")[len(highs)]).alias("high"))


def classify(docs: DataFrame, labels: DataFrame, low: float = LOW_QUANTILE, high: float | None = None, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per input row: doc_id, lang, perplexity, low and high (the bounds of its language), kept; without ``high`` the labels choose it."""
    unseen = F.pmod(F.xxhash64(lower_ascii(F.col("text").cast("string"))), F.lit(BOUND_FOLDS)) == 0  # all copies of a text on one side
    rows = docs.select("doc_id", F.coalesce(F.col("lang"), F.lit("und")).alias("lang"), unseen.alias("unseen"), F.col("text").cast("binary").alias("text"))
    good = good_documents(labels)
    n_good = good.count()
    trusted = rows.filter((F.octet_length("text") > 0) & ~F.col("unseen")).join(small_side(good, 16, n_good), F.col("doc_id") == F.col("good_id"))
    logs = log_probabilities(trusted.select("lang", "text"), rows.select("lang", "text"))
    scores = text_scores(rows, logs, batch_bytes)
    judged = F.when((F.col("n_bytes") > 0) & (F.col("log_sum") < 0), F.exp(-F.col("log_sum") / F.col("n_bytes")))
    scores = write_table(scores.select("doc_id", "lang", "unseen", "n_bytes", judged.alias("perplexity")), "perplexities")
    judged = scores.filter("perplexity IS NOT NULL")
    reference = judged.join(small_side(good, 16, n_good), F.col("doc_id") == F.col("good_id"), "left_semi")
    bad = bad_documents(labels)
    wrong = judged.join(small_side(bad, 16, bad.count()), F.col("doc_id") == F.col("bad_id"), "left_semi")
    reference = reference.withColumn("fine", F.lit(True)).unionByName(wrong.withColumn("fine", F.lit(False)))
    bounds = write_table(bounds_of(reference, low, HIGH_QUANTILES if high is None else (high,)), "bounds")
    inside = F.col("perplexity").between(F.col("low"), F.col("high"))
    kept = (F.col("n_bytes") > 0) & F.coalesce(inside, F.col("low").isNull())
    return scores.join(small_side(bounds, 96), "lang", "left").select("doc_id", "lang", "perplexity", "low", "high", kept.alias("kept"))
