"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash over the last seven bytes ends a chunk wherever it is a multiple of the block size. Each
chunk's hash gives one of 64 letters, and the letters of at most 64 chunks are a signature. The block size
is the smallest power of two at which the text makes no more than 64 chunks on average, halved while there
are too few chunks. A fingerprint holds the signatures at that size, twice and four times that size, so that
texts whose block sizes are near each other can be compared. Likeness is one minus the normalised number of letters
inserted and deleted between signatures of one block size; signatures without any common run of letters
have likeness 0.

Defined results: a null text is an empty one, whose fingerprint is ``1:::``; equal fingerprints of equal
texts have likeness 1, an empty text has likeness 0 to any other; rows with equal or null ids follow each
other by a hash of their text, null ids first; the last document is followed by the first, a single one by itself; other
columns are ignored; a text of any length is read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import _ranges, identity, mix, store

LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
LENGTH = 64
#: Block sizes in a fingerprint, each twice the one before.
SIZES = 3
WINDOW = 7
#: Signatures must have a run of so many letters in common to be alike at all.
COMMON_RUN = 4
_WEIGHTS = mix(np.arange(1, WINDOW + 1, dtype=np.uint64))


def _signature(data: np.ndarray, rolling: np.ndarray, size: int) -> tuple[bytes, int]:
    """Letters at a block size, and the number of chunks before the cut to LENGTH."""
    ends = np.flatnonzero((rolling & np.uint64(size - 1)) == 0) + 1
    if not len(ends) or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    count = len(ends)
    if count > LENGTH:
        # the last letter stands for all the rest
        ends = np.append(ends[: LENGTH - 1], len(data))
    starts = np.concatenate(([0], ends[:-1]))
    hashes = mix(_ranges(data, starts, ends) ^ (ends - starts).astype(np.uint64))
    return LETTERS[(hashes >> np.uint64(58)).astype(np.int64)].tobytes(), count


def fingerprint(text: bytes) -> str:
    """``block size:signature`` and the signatures at twice and four times the size."""
    if not text:
        return "1:::"
    data = np.frombuffer(text, dtype=np.uint8).astype(np.uint64) + np.uint64(1)
    padded = np.concatenate((np.zeros(WINDOW - 1, dtype=np.uint64), data))
    rolling = np.zeros(len(data), dtype=np.uint64)
    for at in range(WINDOW):
        rolling += padded[at : at + len(data)] * _WEIGHTS[at]
    # the upper half is better mixed than the lower
    rolling = (rolling ^ (rolling >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(20)
    size = 1
    while size * LENGTH < len(data):
        size *= 2
    small, count = _signature(data, rolling, size)
    while count < LENGTH // 2 and size > 1:
        size //= 2
        small, count = _signature(data, rolling, size)
    larger = [_signature(data, rolling, size << k)[0].decode() for k in range(1, SIZES)]
    return ":".join([str(size), small.decode(), *larger])


def _common_run(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of two padded letter matrices share a run of COMMON_RUN letters."""
    keys = []
    for side, filler in ((a, 1), (b, 2)):
        width = side.shape[1] - COMMON_RUN + 1
        key = np.zeros((len(side), width), dtype=np.int64)
        whole = np.ones((len(side), width), dtype=bool)
        for at in range(COMMON_RUN):
            part = side[:, at : at + width].astype(np.int64)
            key = key * 256 + part
            whole &= part > 0
        keys.append(np.where(whole, key, -filler))
    left, right = keys
    shared = np.zeros(len(a), dtype=bool)
    for at in range(left.shape[1]):
        shared |= (left[:, at : at + 1] == right).any(axis=1)
    return shared


def _alike(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Likeness of pairs of signatures: 2 * longest common subsequence over the sum of lengths.

    The subsequence is found bit by bit, all pairs at once.
    """
    rows = len(a)
    sides = []
    for letters in (a, b):
        matrix = np.zeros((rows, LENGTH), dtype=np.uint8)
        for at, x in enumerate(letters):
            matrix[at, : len(x)] = np.frombuffer(x, dtype=np.uint8)
        sides.append(matrix)
    left, right = sides
    lengths = (left > 0).sum(axis=1), (right > 0).sum(axis=1)
    masks = np.zeros((rows, 256), dtype=np.uint64)
    every = np.arange(rows)
    for at in range(LENGTH):
        masks[every, left[:, at]] |= np.uint64(1 << at)
    masks[:, 0] = 0
    state = np.full(rows, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(LENGTH):
        match = state & masks[every, right[:, at]]
        state = (state + match) | (state - match)
    used = np.where(lengths[0] >= 64, np.uint64(0xFFFFFFFFFFFFFFFF), (np.uint64(1) << np.minimum(lengths[0], 63).astype(np.uint64)) - np.uint64(1))
    common = np.bitwise_count(~state & used).astype(float)
    total = np.maximum(lengths[0] + lengths[1], 1)
    short = np.minimum(*lengths) < COMMON_RUN
    return np.where(_common_run(left, right) | short, 2 * common / total, 0.0)


def likeness(first: list[str], second: list[str]) -> np.ndarray:
    """Of pairs of fingerprints, from 0 to 1; the best over the block sizes that both have."""
    result = np.array([1.0 if a == b else 0.0 for a, b in zip(first, second, strict=True)])
    at, left, right = [], [], []
    for row, (a, b) in enumerate(zip(first, second, strict=True)):
        if a == b:
            continue
        size_a, *signatures_a = a.split(":")
        size_b, *signatures_b = b.split(":")
        have = {int(size_a) << k: letters for k, letters in enumerate(signatures_a)}
        for k, letters in enumerate(signatures_b):
            size = int(size_b) << k
            if have.get(size) and letters:
                at.append(row)
                left.append(have[size].encode())
                right.append(letters.encode())
    if at:
        np.maximum.at(result, np.array(at), _alike(left, right))
    return result


def edited(text: str, following: str) -> str:
    """The last half of the text's code points replaced by as many of the following text's first."""
    cut = len(text) // 2
    return text[: len(text) - cut] + following[:cut]


_OUTPUT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])
_COLUMNS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _compare(keys: list, texts: list[str], following: list[str], prints: list[str], next_prints: list[str]) -> pa.RecordBatch:
    changed = [edited(t, f) for t, f in zip(texts, following, strict=True)]
    changed_prints = [fingerprint(c.encode()) for c in changed]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(keys, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(c.encode()).hexdigest() for c in changed]), pa.array(prints), pa.array(changed_prints),
            pa.array(likeness(prints, changed_prints)), pa.array(likeness(prints, next_prints)),
        ],
        schema=_OUTPUT,
    )


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint((t.as_py() or "").encode()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], names=["doc_id", "fingerprint"])

    return identity(documents).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fingerprint string")


def in_order(documents: DataFrame) -> DataFrame:
    """doc_id, text, turn, row in ranges of ascending doc_id, null first.

    Rows of one id go by a hash of their text and equal rows by a number, so that an id with a third of all
    rows, equal or not, is spread over as many ranges as its share asks for.
    """
    order = ["doc_id", "turn", "row"]
    frame = identity(documents).select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    frame = frame.withColumn("turn", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    return frame.repartitionByRange(*order).sortWithinPartitions(*order)


def edit_trial(documents: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, compared with each other and with the next.

    One range shuffle brings neighbours together; a task reads its range in order and leaves its first and
    last text for the few pairs that lie in two ranges.
    """
    spark = documents.sparkSession
    ranged = in_order(documents).select("doc_id", "text").withColumn("part", F.spark_partition_id())
    edge_schema = pa.schema([*_OUTPUT, ("part", pa.int32()), ("first", pa.string()), ("last_id", pa.int64()), ("last", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = held = None
        part = None
        for batch in batches:
            for at in range(0, len(batch), 500):
                own = batch.slice(at, 500)
                part = own.column(2)[0].as_py()
                keys, texts = own.column(0).to_pylist(), own.column(1).to_pylist()
                prints = [fingerprint(t.encode()) for t in texts]
                if first is None:
                    first = texts[0]
                if held is not None:
                    keys, texts, prints = [held[0], *keys], [held[1], *texts], [held[2], *prints]
                if len(keys) > 1:
                    compared = _compare(keys[:-1], texts[:-1], texts[1:], prints[:-1], prints[1:])
                    none = [pa.nulls(len(compared), f.type) for f in list(edge_schema)[len(_OUTPUT) :]]
                    yield pa.RecordBatch.from_arrays([*compared.columns, *none], schema=edge_schema)
                held = keys[-1], texts[-1], prints[-1]
        if held is not None:
            yield pa.RecordBatch.from_pylist([{"part": part, "first": first, "last_id": held[0], "last": held[1]}], schema=edge_schema)

    stored = store(ranged.mapInArrow(run, f"{_COLUMNS}, part int, first string, last_id long, last string"), "trial")
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    # a number per range, not per document
    ranges = sorted(r[0] for r in stored.where("part is not null").select("part").collect())
    follows = spark.createDataFrame([(a, b) for a, b in zip(ranges, [*ranges[1:], *ranges[:1]], strict=True)], "part int, next_part int")
    edges = stored.where("part is not null").select("part", "first", "last_id", "last")
    heads = edges.select(F.col("part").alias("next_part"), F.col("first").alias("following"))
    pairs = edges.join(follows, "part").join(heads, "next_part").select("last_id", "last", "following")

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts, following = (batch.column(i).to_pylist() for i in range(3))
            if keys:
                yield _compare(keys, texts, following, [fingerprint(t.encode()) for t in texts], [fingerprint(f.encode()) for f in following])

    return stored.where("part is null").select(*names).unionByName(pairs.mapInArrow(close, _COLUMNS))
