"""Quality selection by importance resampling.

Two generative models over hashed word unigrams and bigrams, one of target text and one of all text, give each
document a log ratio of likelihoods, per token and scaled to a nominal length so that long texts are not
favoured. Adding Gumbel noise that depends on seed and document alone and taking the largest sums is sampling
without replacement in proportion to the ratios.

The raw model counts every document; the target model counts a bounded sample of documents labelled good. The
largest keys are found by counts over ever narrower ranges, never by a global sort.

Defined results: a null or blank text has ratio 0; without labelled target rows every ratio is 0, so
that the sample is uniform; labels with a null are ignored; a document labelled both ways is good; ties of
keys at the border go to the smaller id; repeated rows of an id have one key each and are taken alike; an
empty table gives no rows; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import doc_key, find_words, mix, store, text_slices, window_hashes, word_hashes

FEATURES = 1 << 16
#: Bound of the labelled sample that the target model counts.
TARGET_ROWS = 5000
NOMINAL_TOKENS = 100
KEEP_SHARE = 0.5
SEED = 29
_RANGES = 1024


def _features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text number and bucket of every unigram and bigram."""
    starts, ends, begins = find_words(data, offsets)
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    words = word_hashes(lowered, starts, ends)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(begins))
    pairs = window_hashes(words, 2)
    inside = owner[:-1] == owner[1:] if len(owner) > 1 else np.zeros(0, bool)
    buckets = np.concatenate((mix(words ^ np.uint64(1)), pairs[inside])) % np.uint64(FEATURES)
    return np.concatenate((owner, owner[:-1][inside] if len(owner) > 1 else owner[:0])), buckets.astype(np.int64)


def _counts(texts: DataFrame) -> np.ndarray:
    """Count per bucket over all texts; each task sums first and at most FEATURES rows reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(FEATURES, dtype=np.int64)
        for batch in batches:
            for _, _, data, offsets in text_slices(batch.column(0)):
                total += np.bincount(_features(data, offsets)[1], minlength=FEATURES)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["feature", "n"])

    table = texts.select("text").mapInArrow(run, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(FEATURES)
    counts[table["feature"].to_numpy()] = table["n"].to_numpy()
    return counts


def fit(documents: DataFrame, labels: DataFrame) -> np.ndarray:
    """Log ratio of each bucket."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    chosen = good.orderBy(F.xxhash64("doc_id"), "doc_id").limit(TARGET_ROWS).select("doc_id")
    raw = _counts(documents)
    target = _counts(documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))
    if not target.sum() or not raw.sum():
        return np.zeros(FEATURES, dtype=np.float32)
    shares = [(c + 0.5) / (c + 0.5).sum() for c in (target, raw)]
    return (np.log(shares[0]) - np.log(shares[1])).astype(np.float32)


def score(documents: DataFrame, ratios: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, key of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            means = np.zeros(len(batch))
            for low, high, data, offsets in text_slices(batch.column(1)):
                owner, buckets = _features(data, offsets)
                sums = np.bincount(owner, weights=ratios[buckets], minlength=high - low)
                means[low:high] = sums / np.maximum(np.bincount(owner, minlength=high - low), 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(means * NOMINAL_TOKENS)], names=["doc_id", "log_weight"])

    scored = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, log_weight double")
    chance = (F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    return scored.withColumn("key", F.col("log_weight") - F.log(-F.log(chance)))


def _border(rows: DataFrame, column: str, count: int) -> tuple[float | int | None, int]:
    """Value of the ``count``-th largest row, and the number of rows above that value.

    Each round counts rows in 1,024 ranges of what is left and keeps the range that holds the border.
    """
    low, high = rows.agg(F.min(column), F.max(column)).first()
    above = 0
    while low is not None and low < high:
        width = (high - low) // _RANGES + 1 if isinstance(low, int) else (high - low) / _RANGES
        steps = (F.col(column).cast("decimal(20,0)") - F.lit(low)) / width if isinstance(low, int) else (F.col(column) - low) / width
        place = F.least(F.floor(steps), F.lit(_RANGES - 1)).cast("int")
        own = rows.where(F.col(column).between(low, high)).groupBy(place.alias("place"))
        # at most one row for each range
        ranges = own.agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).orderBy(F.desc("place")).collect()
        for r in ranges:
            if above + r.n >= count:
                low, high = r.low, r.high
                break
            above += r.n
    return low, above


def largest(rows: DataFrame, key: str, count: int) -> Column:
    """Condition that holds for the ``count`` rows with the largest key; of equal keys the smaller ids.

    Rows that agree in key and id are taken alike.
    """
    if count <= 0:
        return F.lit(False)
    border, above = _border(rows, key, count)
    if border is None:
        return F.lit(False)
    at_border = rows.where(F.col(key) == F.lit(border)).select((-doc_key()).alias("turn"))
    last, _ = _border(at_border, "turn", count - above)
    return (F.col(key) > F.lit(border)) | ((F.col(key) == F.lit(border)) & (-doc_key() >= F.lit(last)))


def resample(documents: DataFrame, labels: DataFrame, share: float = KEEP_SHARE, seed: int = SEED) -> DataFrame:
    """doc_id, log_weight, key, selected: a sample of ``share`` of the documents in proportion to their ratios."""
    base = documents.select("doc_id", "text")
    scored = store(score(base, fit(base, labels), seed), "scored")
    count = -(-scored.count() * int(share * 1000) // 1000)
    return scored.withColumn("selected", largest(scored, "key", count))
