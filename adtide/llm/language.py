"""Language identification by error-correcting output codes.

Every learned language has a codeword. For each bit a binary naive Bayes classifier over hashed byte
n-grams tells the languages with a one from those with a zero; its counts come from every training row,
summed by Spark per language and feature. Decoding sums the logistic loss of each bit, weighted by how
well the bit separates its two sides, and takes the codeword of the least loss. ``ambiguous`` marks
a text whose two best codewords are close.

Defined results: a null text, or one without a letter, gets ``und`` with score 0, as does every text when
no row can be learned from; repeated rows repeat; ties between codewords go to the first language by code
point; other columns are ignored; a text of any length is read whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import held_out, identity, mix, text_slices

UNKNOWN = "und"
GRAMS = (1, 2, 3, 4)
#: Hashed features; the model has one weight for each of them and each bit of a codeword.
FEATURES = 1 << 15
MARGIN = 0.2


def _features(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each n the hashed n-grams that start at each byte, and which of them stay inside a text."""
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint64)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    value = np.zeros(len(data), dtype=np.uint64)
    for n in range(1, max(GRAMS) + 1):
        end = len(data) - n + 1
        if end <= 0:
            return
        value = value[:end] * np.uint64(256) + lowered[n - 1 :]
        if n in GRAMS:
            bucket = (mix(value ^ np.uint64(n << 40)) % np.uint64(FEATURES)).astype(np.int64)
            yield bucket, owner[:end] == owner[n - 1 :]


def codewords(languages: int, seed: int = 11) -> np.ndarray:
    """+1/-1 matrix: all splits of up to six languages, else random balanced columns."""
    if languages < 2:
        return np.ones((languages, 1), dtype=np.float32)
    if languages <= 6:
        columns = [[1 if language == 0 or not (split >> (language - 1)) & 1 else -1 for language in range(languages)] for split in range(1, 1 << (languages - 1))]
        return np.array(columns, dtype=np.float32).T
    bits = math.ceil(15 * math.log2(languages))
    random = np.random.default_rng(seed)
    columns = [np.where(random.permutation(languages) < languages // 2, -1, 1) for _ in range(bits)]
    return np.array(columns, dtype=np.float32).T


@dataclass
class Model:
    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    bit_weights: np.ndarray


def _counts(rows: DataFrame) -> DataFrame:
    """lang, feature, n over all rows; each task sums what it has read before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, total in sums.items():
                used = np.flatnonzero(total)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(total[used], pa.int64())], names=["lang", "feature", "n"])
            sums.clear()

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for first, end, data, offsets in text_slices(batch.column(1)):
                names, codes = np.unique(langs[first:end].astype(str), return_inverse=True)
                if len(sums) + len(names) > 512:
                    yield from flush()
                owner = np.repeat(codes, np.diff(offsets))
                for bucket, inside in _features(data, offsets):
                    at = owner[: len(bucket)][inside] * FEATURES + bucket[inside]
                    total = np.bincount(at, minlength=len(names) * FEATURES).reshape(len(names), FEATURES)
                    for name, row in zip(names.tolist(), total, strict=True):
                        sums[name] = sums[name] + row if name in sums else row.copy()
        yield from flush()

    summed = rows.select("lang", "text").mapInArrow(count, "lang string, feature int, n long")
    return summed.groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def fit(documents: DataFrame) -> Model:
    """Learn from every row with text and lang that is not held out.

    What reaches the driver is a count per language and feature, whatever the number of rows.
    """
    rows = documents.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null").where(~held_out())
    table = _counts(rows).toArrow()
    languages = sorted(set(table["lang"].to_pylist()), key=lambda s: s.encode())
    codes = codewords(len(languages))
    place = {name: at for at, name in enumerate(languages)}
    counts = np.zeros((len(languages), FEATURES))
    counts[[place[x] for x in table["lang"].to_pylist()], table["feature"].to_numpy()] = table["n"].to_numpy()
    if not languages:
        return Model([], codes, np.zeros((FEATURES, 1), np.float32), np.ones(1))
    # every language weighs the same, however many documents it has
    chance = (counts + 0.1) / (counts + 0.1).sum(axis=1, keepdims=True)
    weights, bit_weights = [], []
    for bit in codes.T:
        one = chance[bit > 0].mean(axis=0)
        zero = chance[bit < 0].mean(axis=0) if (bit < 0).any() else one
        log_odds = np.log(one) - np.log(zero)
        weights.append(log_odds)
        bit_weights.append(float(((one - zero) * log_odds).sum()))
    spread = np.array(bit_weights)
    spread = spread / spread.sum() * len(spread) if spread.sum() > 0 else np.ones(len(spread))
    return Model(languages, codes, np.array(weights, dtype=np.float32).T.copy(), spread)


def decode(margins: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Language index, score and ambiguity of rows of bit margins."""
    losses = np.stack([(np.logaddexp(0, -margins * code) * model.bit_weights).sum(axis=1) for code in model.codes], axis=1)
    likely = np.exp(losses.min(axis=1, keepdims=True) - losses)
    likely /= likely.sum(axis=1, keepdims=True)
    best = likely.argmax(axis=1)
    ranked = np.sort(likely, axis=1)
    second = ranked[:, -2] if likely.shape[1] > 1 else np.zeros(len(likely))
    return best, ranked[:, -1], ranked[:, -1] - second < MARGIN


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score, ambiguous of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        # a Unicode letter: a word character that is neither a digit nor an underscore
        letter = re.compile(r"[^\W\d_]")
        bits = model.codes.shape[1]
        for batch in batches:
            texts = batch.column(1)
            for first, end, data, offsets in text_slices(texts, 1 << 18):
                margins = np.zeros((end - first, bits))
                grams = np.zeros(end - first)
                for bucket, inside in _features(data, offsets):
                    owner = np.repeat(np.arange(end - first), np.diff(offsets))[: len(bucket)][inside]
                    own = bucket[inside]
                    grams += np.bincount(owner, minlength=end - first)
                    for bit in range(bits):
                        margins[:, bit] += np.bincount(owner, weights=model.weights[own, bit], minlength=end - first)
                margins /= np.sqrt(np.maximum(grams, 1))[:, None]
                plain = [t.as_py() for t in texts.slice(first, end - first)]
                known = np.array([bool(t and letter.search(t)) for t in plain], dtype=bool) & bool(model.languages)
                if model.languages:
                    best, score, unsure = decode(margins, model)
                    names = np.array(model.languages, dtype=object)[best]
                else:
                    score, unsure, names = np.zeros(len(plain)), np.ones(len(plain), bool), np.array([UNKNOWN] * len(plain), dtype=object)
                names = [n if k else UNKNOWN for n, k in zip(names, known, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, end - first), pa.array(names, pa.string()), pa.array(np.where(known, score, 0.0)), pa.array(unsure | ~known)],
                    names=["doc_id", "lang_pred", "score", "ambiguous"],
                )

    return identity(documents).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")
