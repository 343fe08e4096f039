"""Quality classifier by importance resampling (operator 8).

Two generative models over hashed byte n-grams and hashed words with their
stems: one of target text (labelled good and not toxic), one of the raw text
of all documents.  A document's log weight is the log ratio of the two models
over its worst stretch of ``WINDOW`` n-grams plus that over its worst stretch
of ``WORDS`` words: a document is as good as its worst passages, and long
documents do not outweigh short ones.  N-grams show garbled text; words show
vocabulary whose letters are common in other words too.  A stretch of words is
long, so of a word's ratio only what lies below ``-MARGIN`` counts (times
``WORD_WEIGHT``): the rest is what unsuspicious words scatter.
Documents are resampled without replacement by Gumbel top-k: log weight plus
Gumbel noise (a hash of id and text, so runs agree), counted from the cut of
the document's language (column ``lang``, if there is one): the k largest stay.

k is the number of documents whose log weight reaches their cut.  A cut is
what best separates good labels of a held-out fifth from bad labels, which
neither model is told of: in each language with ``LEAST`` labels of both
kinds, and over all languages for the others.  Both models and k cover all documents.  The target model reads at most
``MAX_TARGET`` labelled documents (lowest id hashes first); without usable
labels every document stays.

The models are two counter arrays of 2**BITS cells, the lower half for n-grams
and the upper for words: their size, the only thing that comes to the driver,
does not depend on the input.

Words are runs of letters, digits and marks of any script, in lower case.

Defined results: a null or empty text has no n-grams and log weight 0;
repeated rows share their fate; an empty table gives no rows.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import counter_slices, kth_largest, small_batches, staged, worker_caches

BITS = 20
GRAM = 5
WINDOW = 24
WORDS = 128
STEMS = (3, 5, 7)  # letters of a word that are features besides the whole word
MARGIN = 0.5
WORD_WEIGHT = 2.0
PSEUDO = 2.0
MAX_TARGET = 200_000
HELD_OUT = 5
SEED = 20
SCORE_BINS = 512
LEAST = 5  # held-out good and bad labels that a language needs for a cut of its own
_MIX = np.uint64(0x9E3779B97F4A7C15)


#: which code points belong to words; those beyond the basic plane all do
_IN_WORD = np.array([chr(i).isalnum() or unicodedata.category(chr(i))[0] == "M" for i in range(1 << 16)] + [True])


def words(text: str) -> np.ndarray:
    """Hash cells of each word's stems and of the whole word, in the order of the text."""
    points = np.frombuffer(text.lower().encode("utf-32-le"), dtype="<u4")
    at = np.flatnonzero(_IN_WORD[np.minimum(points, 1 << 16)])
    if not len(at):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.diff(at, prepend=-2) > 1)
    place = np.arange(len(at)) - np.repeat(first, np.diff(first, append=len(at)))
    letters = points[at].astype(np.uint64) + (place.astype(np.uint64) << np.uint64(32))
    letters = (letters + np.uint64(1)) * _MIX
    letters = (letters ^ (letters >> np.uint64(29))) * _MIX
    codes = [np.add.reduceat(np.where(place < n, letters, np.uint64(0)), first) + np.uint64(n) for n in STEMS]
    codes = np.stack([*codes, np.add.reduceat(letters, first)], axis=1).reshape(-1)
    codes = (codes ^ (codes >> np.uint64(32))) * _MIX
    return (codes >> np.uint64(64 - BITS + 1)).astype(np.int64) + (1 << (BITS - 1))


def grams(text: str | None) -> np.ndarray:
    """Hash cells of the byte 5-grams of a text (padded with spaces, so every non-empty text has one), then of its words."""
    raw = (text or "").encode("utf-8")
    if not raw:
        return np.zeros(0, np.int64)
    b = np.frombuffer(raw + b" " * (GRAM - 1), dtype=np.uint8).astype(np.uint64)
    n = len(raw)
    code = b[:n].copy()
    for i in range(1, GRAM):
        code <<= np.uint64(8)
        code |= b[i: n + i]
    code *= _MIX
    return np.concatenate(((code >> np.uint64(64 - BITS + 1)).astype(np.int64), words(text)))


def log_ratio(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Log of target over raw probability per cell; counts expected under the raw model are smoothed alike.

    Two columns: the ratio of an n-gram's cell, what counts of a word's; the other one is NaN."""
    expected = raw * (target.sum() / max(1, raw.sum()))
    ratio = np.log((target + PSEUDO) / (expected + PSEUDO)).astype(np.float32)
    half = len(ratio) // 2
    out = np.full((len(ratio), 2), np.nan, np.float32)
    out[:half, 0] = ratio[:half]
    out[half:, 1] = WORD_WEIGHT * np.minimum(ratio[half:] + MARGIN, 0)
    return out


def worst_window(values: np.ndarray) -> float:
    """Least sum of a window of n-grams plus least sum of a window of words."""
    n = int(np.isnan(values[:, 1]).sum())
    return _least_sum(values[:n, 0], WINDOW) + _least_sum(values[n:, 1], WORDS * (len(STEMS) + 1))


def _least_sum(values: np.ndarray, window: int) -> float:
    if not len(values):
        return 0.0
    sums = np.concatenate(([0.0], np.cumsum(values, dtype=np.float64)))
    w = min(window, len(values))
    return float((sums[w:] - sums[:-w]).min())


class Resampler:
    """Fitted classifier: ``ratio`` scores texts, ``cuts`` are the languages' cuts and the one for all others,
    ``cut`` is the smallest key that stays."""

    def __init__(self, ratio, cuts=None, cut: float | None = None):
        self.ratio, self.cuts, self.cut = ratio, cuts, cut

    def key(self, weight: Column, lang: Column, noise: Column) -> Column:
        return weight + noise if self.cuts is None else weight - cut_of(self.cuts, lang) + noise


def _labelled(labels: DataFrame) -> DataFrame:
    """One row per labelled id: good 1/0 and a fold by id hash; ids with contradicting rows count as bad."""
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    rows = labels.where("doc_id is not null and quality is not null")
    return rows.groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.min(good.cast("int")).alias("good")).withColumn(
        "fold", F.pmod(F.xxhash64(F.lit(SEED), "label_id"), F.lit(HELD_OUT)))


def weight_udf(ratio_broadcast):
    @F.pandas_udf(T.DoubleType())
    def weigh(texts):
        worker_caches("importance")
        table = ratio_broadcast.value
        return texts.map(lambda t: worst_window(table[grams(t)]))

    return weigh


def cut_of(cuts: tuple[dict[str, float], float], lang: Column) -> Column:
    """The cut of a language: a column without Python, so that scoring takes one Python worker per task and not two."""
    own, other = cuts
    if not own:
        return F.lit(other)
    known = F.create_map(*[F.lit(x) for pair in sorted(own.items()) for x in pair])
    return F.coalesce(F.try_element_at(known, lang), F.lit(other))


def _lang(docs: DataFrame) -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit("")) if "lang" in docs.columns else F.lit("")


def gumbel() -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), F.col("doc_id").cast("long"), F.col("text")), 11) + F.lit(0.5)) / F.lit(float(1 << 53))
    return -F.log(-F.log(u))


def fit(docs: DataFrame, labels: DataFrame) -> tuple["Resampler", DataFrame | None]:
    """Train on ``docs`` (doc_id, text) and ``labels`` (doc_id, quality, toxic); also returns the scored slim table."""
    spark = docs.sparkSession
    small_batches(spark)
    known = staged(_labelled(labels), "labels")
    # the bounded sample: a top-k by id hash, at most MAX_TARGET ids (8 bytes each)
    target = known.where("good = 1 and fold > 0").orderBy(F.xxhash64(F.lit(SEED + 1), "label_id"), "label_id").limit(MAX_TARGET)
    marked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        F.broadcast(target.select(F.col("label_id").alias("doc_id"), F.lit(1).alias("hit"))), "doc_id", "left")

    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        worker_caches("importance")
        cells = np.zeros(2 << BITS, np.int64)
        for b in batches:
            hits = b.column(1).to_pylist()
            found = [grams(t) for t in b.column(0).to_pylist()]
            cells[: 1 << BITS] += np.bincount(np.concatenate(found or [np.zeros(0, np.int64)]), minlength=1 << BITS)
            chosen = [g for g, h in zip(found, hits) if h]
            if chosen:
                cells[1 << BITS:] += np.bincount(np.concatenate(chosen), minlength=1 << BITS)
        return cells

    cells = counter_slices(marked, ["text", "hit"], count, 2 << BITS)
    raw, good = cells[: 1 << BITS], cells[1 << BITS:]
    ratio = spark.sparkContext.broadcast(log_ratio(raw, good))  # 2 * 2**BITS floats
    if not good.sum():
        return Resampler(ratio), None
    scored = staged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), _lang(docs).alias("lang"),
                                weight_udf(ratio)("text").alias("log_weight"), gumbel().alias("noise")), "scores")
    held = scored.join(known.where("fold = 0 or good = 0"), scored["doc_id"] == known["label_id"])
    span = held.agg(F.min("log_weight").alias("lo"), F.max("log_weight").alias("hi")).first()
    if span["lo"] is None:
        return Resampler(ratio), scored
    step = max((span["hi"] - span["lo"]) / SCORE_BINS, 1e-9)
    hist = staged(held.groupBy("lang", "good", F.floor((F.col("log_weight") - span["lo"]) / step).alias("cell")).count(), "label-bins")
    own = hist.groupBy("lang").agg(*[F.sum(F.when(F.col("good") == g, F.col("count"))).alias(f"n{g}") for g in (0, 1)])
    own = own.where((F.col("n0") >= LEAST) & (F.col("n1") >= LEAST)).select("lang")

    def cut_in(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": [key[0]], "cell": [best_cut(cells.to_dict("records"))]})

    found = hist.join(own, "lang").groupBy("lang").applyInPandas(cut_in, "lang string, cell int").collect()  # a row per language
    cuts = {r["lang"]: span["lo"] + step * r["cell"] for r in found}
    other = span["lo"] + step * best_cut(hist.groupBy("good", "cell").agg(F.sum("count").alias("count")).collect())
    model = Resampler(ratio, (cuts, other))
    k = scored.where(F.col("log_weight") >= cut_of(model.cuts, F.col("lang"))).count()
    key = scored.select(model.key(F.col("log_weight"), F.col("lang"), F.col("noise")).alias("key"))
    model.cut = kth_largest(key, "key", k)
    return model, scored


def best_cut(hist) -> int:
    """The bin border with the best sum of good kept (counted fourfold: clean documents must stay) and bad rejected."""
    n = {g: sum(r["count"] for r in hist if r["good"] == g) or 1 for g in (0, 1)}
    below = {0: 0, 1: 0}
    best, at = 0.0, 0
    for cell in range(SCORE_BINS + 1):
        score = 4 * (1 - below[1] / n[1]) + below[0] / n[0]
        if score > best:
            best, at = score, cell
        for r in hist:
            if r["cell"] == cell:
                below[r["good"]] += r["count"]
    return at


def resample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, gumbel_key, selected: one row per document."""
    model, scored = fit(docs, labels)
    if scored is None:
        scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lit("").alias("lang"), F.lit(0.0).alias("log_weight"),
                             gumbel().alias("noise"))
    keyed = scored.withColumn("gumbel_key", model.key(F.col("log_weight"), F.col("lang"), F.col("noise")))
    stays = F.lit(True) if model.cut is None else F.col("gumbel_key") >= model.cut
    return keyed.select("doc_id", "log_weight", "gumbel_key", stays.alias("selected"))


def select_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the resampling keeps."""
    model, _ = fit(docs, labels)
    if model.cut is None:
        return docs
    return docs.where(model.key(weight_udf(model.ratio)("text"), _lang(docs), gumbel()) >= model.cut)
