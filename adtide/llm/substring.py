"""Substring dedup by relative Lempel-Ziv parsing.

Every document is parsed against the blocks of all documents. A document falls into blocks at places
that its own words choose: each window of ``window`` words has an anchor, the smallest hash among its
runs of half as many words, and a block is the longest stretch of windows with one anchor. Equal
passages therefore fall into equal blocks wherever they stand, and an index of block hashes, spread by
Spark over the anchors, is the reference: for each block it knows the smallest doc_id. The parse joins a
document's consecutive blocks that an earlier document holds into one factor, greedily. A factor is at least
a window long, so that all of it is a duplicate span. At the borders of factors a block may agree with
an indexed one only in part; there each window is looked up by its own hash.

Both lookups compare 64-bit hashes of the same words twice, of the anchor and of the block or window.

Defined results: a null text has no words; a text shorter than a window loses none; a window counts as
repeated if it starts in a document of a smaller doc_id, a null doc_id being later than every other,
so that rows of one doc_id do not repeat each other; repeated rows are kept and judged alike; an empty table
gives no rows; other columns are kept by ``without_repeats`` and ignored elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import doc_key, find_words, identity, lists, one_row_each, span_hashes, store, text_slices, window_hashes, word_hashes

WINDOW = 50


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of ``width`` values, by doubling."""
    done, result = 1, values
    while done * 2 <= width:
        result = np.minimum(result[: len(result) - done], result[done:])
        done *= 2
    if done < width:
        rest = width - done
        result = np.minimum(result[: len(result) - rest], result[rest:])
    return result


def _keyed(documents: DataFrame) -> DataFrame:
    """Documents by id and a hash of the text, which tells rows of one id apart; one row of equal ones."""
    return one_row_each(identity(documents)).select("doc", "tid", "text")


def parse_blocks(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc, tid, anchor, block, first, windows: the blocks of every document, by the number of their first word."""
    return _blocks(_keyed(documents), window)


def _blocks(texts: DataFrame, window: int) -> DataFrame:
    run_words = window // 2
    schema = "doc long, tid long, first array<int>, windows array<int>, anchor array<long>, block array<long>"

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column(2)):
                starts, ends, begins = find_words(data, offsets)
                hashes = word_hashes(data, starts, ends)
                runs = window_hashes(hashes, run_words)
                if len(hashes) < window:
                    continue
                anchors = _smallest(runs, window - run_words + 1)
                owner = np.repeat(np.arange(high - low), np.diff(begins))
                inside = owner[: len(anchors)] == owner[window - 1 :]
                opens = inside.copy()
                opens[1:] &= ~inside[:-1] | (anchors[1:] != anchors[:-1]) | (owner[1 : len(anchors)] != owner[: len(anchors) - 1])
                first = np.flatnonzero(opens)
                if not len(first):
                    continue
                changes = np.flatnonzero(opens | ~inside)
                following = np.append(changes[1:], len(anchors))
                count = following[np.searchsorted(changes, first)] - first
                blocks = span_hashes(hashes, first, first + count + window - 1)
                docs = owner[first]
                used, at = np.unique(docs, return_index=True)
                bounds = np.append(at, len(first))
                local = (first - begins[docs]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low).take(pa.array(used)), batch.column(1).slice(low, high - low).take(pa.array(used)),
                        lists(local, bounds, pa.int32()), lists(count.astype(np.int32), bounds, pa.int32()),
                        lists(anchors[first].view(np.int64), bounds, pa.int64()), lists(blocks.view(np.int64), bounds, pa.int64()),
                    ],
                    names=["doc", "tid", "first", "windows", "anchor", "block"],
                )

    packed = texts.mapInArrow(parse, schema)
    return packed.select("doc", "tid", F.inline(F.arrays_zip("first", "windows", "anchor", "block")))


def _border_windows(texts: DataFrame, window: int) -> DataFrame:
    """doc, tid, first, anchor, hash of each window of the given blocks (``wanted``) of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted_all = batch.column(3)
            for low, high, data, offsets in text_slices(batch.column(2)):
                starts, ends, begins = find_words(data, offsets)
                hashes = window_hashes(word_hashes(data, starts, ends), window)
                wanted = wanted_all.slice(low, high - low)
                sizes = np.diff(wanted.offsets.to_numpy())
                flat = wanted.flatten()
                first, count, anchor = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                owner = np.repeat(np.arange(high - low), sizes)
                total = int(count.sum())
                step = np.arange(total) - np.repeat(np.cumsum(count) - count, count)
                local = np.repeat(first, count) + step
                docs = np.repeat(owner, count)
                rows = pa.array(docs)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low).take(rows), batch.column(1).slice(low, high - low).take(rows), pa.array(local, pa.int32()),
                        pa.array(np.repeat(anchor, count), pa.int64()), pa.array(hashes[begins[docs] + local].view(np.int64), pa.int64()),
                    ],
                    names=["doc", "tid", "first", "anchor", "hash"],
                )

    return texts.select("doc", "tid", "text", "wanted").mapInArrow(run, "doc long, tid long, first int, anchor long, hash long")


def duplicate_spans(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc, tid, spans: per document that repeats anything, its duplicate spans of words, in order."""
    # repeated rows are judged alike, so that one of them stands for all
    texts = _keyed(documents)
    blocks = store(_blocks(texts, window), "blocks")
    # anchors that more than one document has: everything else is dropped before any further shuffle
    anchors = blocks.groupBy("anchor").agg(F.min("doc").alias("low"), F.max("doc").alias("high"), (F.min("block") != F.max("block")).alias("borders"))
    # results of groupings are stored before a join on the same key, so that a hot key's rows can be split there
    shared = store(anchors.where("low < high").select("anchor", "borders"), "shared-anchors")
    common = store(blocks.join(shared.hint("merge"), "anchor"), "shared-blocks")
    # the index: the first document of each block
    index = store(common.groupBy("anchor", "block").agg(F.min("doc").alias("owner")), "index")
    looked_up = store(common.join(index, ["anchor", "block"]), "parsed-blocks")
    factors = looked_up.where("doc > owner").select("doc", "tid", "first", "windows")
    # the first document of a block stands for all that hold it
    borders = looked_up.where("doc = owner and borders").groupBy("doc", "tid").agg(F.collect_list(F.struct("first", "windows", "anchor")).alias("wanted"))
    windows = store(_border_windows(texts.join(borders.hint("merge"), ["doc", "tid"]), window), "border-windows")
    owners = windows.groupBy("anchor", "hash").agg(F.min("doc").alias("owner"), F.max("doc").alias("last")).where("owner < last")
    owners = store(owners.select("anchor", "hash", "owner"), "owners")
    singles = windows.join(owners, ["anchor", "hash"]).where("doc > owner").select("doc", "tid", "first", F.lit(1).alias("windows"))
    found = factors.unionByName(singles).groupBy("doc", "tid").agg(F.sort_array(F.collect_set(F.struct("first", "windows"))).alias("parts"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            merged = []
            for parts in batch.column(2).to_pylist():
                spans: list[dict] = []
                for part in parts:
                    start, end = part["first"], part["first"] + part["windows"] + window - 1
                    if spans and start <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], end)
                    else:
                        spans.append({"start": start, "end": end})
                merged.append(spans)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(merged, kind)], names=["doc", "tid", "spans"])

    return found.mapInArrow(merge, "doc long, tid long, spans array<struct<start:int,end:int>>")


def without_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of the documents plus n_words, n_removed, spans and kept_text, the words left joined by a space."""
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    added = ("n_words", "n_removed", "spans", "kept_text")
    own = [c for c in documents.columns if c not in added]
    spans = store(duplicate_spans(documents.select("doc_id", "text"), window), "spans")
    keys = {c: f"own_{at}" for at, c in enumerate(own)}
    renamed = documents.select(doc_key().alias("doc"), F.xxhash64("text").alias("tid"), *(F.col(f"`{c}`").alias(n) for c, n in keys.items()))
    joined = renamed.join(spans.hint("merge"), ["doc", "tid"], "left").select(*keys.values(), "spans")
    at = list(keys).index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for text, spans in zip(batch.column(at), batch.column(len(keys)), strict=True):
                words = (text.as_py() or "").encode().split()
                own_spans = spans.as_py() or []
                totals.append(len(words))
                removed.append(sum(s["end"] - s["start"] for s in own_spans))
                for span in reversed(own_spans):
                    del words[span["start"] : span["end"]]
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], names=[*batch.schema.names, "n_words", "n_removed", "kept_text"])

    schema = StructType([*joined.schema.fields, StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())])
    return joined.mapInArrow(cut, schema).select(*(F.col(n).alias(c) for c, n in keys.items()), *added)
