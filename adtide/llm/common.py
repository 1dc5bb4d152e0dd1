"""Shared helpers: stored intermediates, text slices, word and window hashes, splits."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adtide.session import new_workspace

#: Bytes of text handled at once; bounds the numpy buffers of a task.
SLICE_BYTES = 1 << 20
#: Rows that a Python worker gets at once.
BATCH_ROWS = 2000
#: Stands for a null doc_id inside the operators: later than every other id.
LAST_ID = 2**63 - 1


def prepare_workers(spark: SparkSession) -> None:
    """Settings of a session that runs the registered queries or the pipeline.

    Python workers started from now on import this package from where the driver did; where executors do
    not have that folder, the package goes along with ``--py-files``. Batches of rows with whole texts or
    sets are kept small.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    folder = str(Path(__file__).resolve().parents[2])
    environment = spark.sparkContext.environment
    parts = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if folder not in parts:
        environment["PYTHONPATH"] = os.pathsep.join([folder, *parts])


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write below the shared folder and read back, which cuts the lineage."""
    path = new_workspace(df.sparkSession, purpose)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(stored: DataFrame) -> None:
    """Remove the files of a stored frame that nothing reads any more."""
    spark = stored.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in stored.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def identity(documents: DataFrame, *extra: str) -> DataFrame:
    """Only the columns an operator reads, whatever else the table carries."""
    return documents.select("doc_id", "text", *extra)


def doc_key() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))


def one_row_each(documents: DataFrame) -> DataFrame:
    """doc, tid and all columns of the documents, with one row of those that agree in id and text.

    Without such rows, as a count over ids and hashes tells, nothing is grouped.
    """
    keyed = documents.select(doc_key().alias("doc"), F.xxhash64("text").alias("tid"), *documents.columns)
    repeated = keyed.groupBy("doc", "tid").agg(F.count("*").alias("rows")).where("rows > 1")
    return keyed if repeated.isEmpty() else keyed.dropDuplicates(["doc", "tid"])


def held_out() -> Column:
    """Documents whose crc32(doc_id as text) mod 4 is 2; a null id is never held out."""
    part = F.crc32(F.col("doc_id").cast("string")) % 4
    return F.coalesce(part == 2, F.lit(False))


def text_slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``limit`` bytes of text: first row, end row, bytes, offsets.

    A null text is an empty one. A text longer than the limit forms a run of its own.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = column.cast(pa.large_string()).fill_null("")
    if not len(values):
        return
    _, offset_buffer, data_buffer = values.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(data_buffer, dtype=np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(values):
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), len(values))
        own = offsets[first : end + 1]
        yield first, end, data[own[0] : own[-1]], own - own[0]
        first = end


_MULTIPLIER = 0x9E3779B97F4A7C15
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd multiplier and of its inverse modulo 2**64, at least n of each."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 64)
        _powers[:] = []
        for factor in (_MULTIPLIER, _INVERSE):
            table = np.full(size, np.uint64(factor), dtype=np.uint64)
            table[0] = 1
            _powers.append(np.multiply.accumulate(table))
    return _powers[0], _powers[1]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _ranges(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Position-independent polynomial value of each half-open range."""
    power, inverse = _power_tables(len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * power[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * inverse[starts]


def find_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of each text's first word.

    Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and return.
    """
    blank = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    solid = ~blank
    opens = solid.copy()
    closes = solid.copy()
    if len(data):
        opens[1:] &= blank[:-1]
        closes[:-1] &= blank[1:]
        edges = offsets[(offsets > 0) & (offsets < len(data))]
        opens[edges] = solid[edges]
        closes[edges - 1] = solid[edges - 1]
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    raw = _ranges(data.astype(np.uint64) + np.uint64(1), starts, ends)
    return mix(raw ^ ((ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive words, without regard to text borders."""
    if len(words) < size:
        return np.zeros(0, dtype=np.uint64)
    first = np.arange(len(words) - size + 1)
    return mix(_ranges(words, first, first + size) ^ np.uint64(size))


def span_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each given range of words."""
    return mix(_ranges(words, starts, ends) ^ (ends - starts).astype(np.uint64))


def unit(*values: object) -> float:
    """A number in (0, 1) that depends on the values alone."""
    import zlib

    text = ":".join(map(str, values)).encode()
    low, high = zlib.crc32(text), zlib.crc32(text, 0x5BD1E995)
    bits = int(mix(np.array([(high << 32) | low], dtype=np.uint64))[0])
    return ((bits >> 11) + 0.5) / (1 << 53)


def lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, type=kind))
