"""Ranked lexical search: the best documents of a set of items by an integer term score.

Best Position Algorithm: within a shard of documents each term has an impact list, from its highest local
score to its lowest. The lists of an item are read side by side; a document met in one list is looked up
in all others by direct access, and the positions seen there are marked too. The best position of a list
ends its contiguous run of seen positions; the local scores at the best positions add up to a bound for
every unseen document, and a shard is left once that bound is strictly below the k-th best score.

Shards are runs of stored rows of one task, so no text and no posting is shuffled: only counts by term
and the best k rows of each item and task. Items are taken in blocks of bounded size; what a block sends
to the tasks are its terms and their weights.

Defined results: a text that is null or without terms is no document and an item without terms has no
rows. Every row of the documents is one, so repeated rows rank as often as they occur; a null doc_id
comes after all others of its score. Equal rows of the items count once; different texts of one item_id
are ranked each on their own. A text of any length counts as a whole, read in slices. Empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtide.llm.common import LAST_ID, store

#: Documents kept for each item.
BEST = 20
#: Bytes of item texts that make a block, about.
BLOCK_BYTES = 4 << 20
#: Postings and documents of a shard.
SHARD_POSTINGS = 2_000_000
SHARD_DOCUMENTS = 65_536
#: Positions read from each list in a first step and at most; steps double.
FIRST_STEP, LAST_STEP = 32, 4096
#: Bytes of text that are split at once.
SLICE = 1 << 22
#: Capital ASCII letters become small, other ASCII signs than letters and digits part terms.
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
#: Local scores lie below this.
_SCORES = 1_000_000


def terms_of(text: str | None) -> Iterator[list[bytes]]:
    """Terms of a text, in slices."""
    folded = (text or "").encode().translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b" ", at + SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def local_scores(tf: np.ndarray, margin: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * margin)


def margins(sizes: np.ndarray, documents: int, total: int) -> np.ndarray:
    """100 - 25 + 25 n N div L of each document."""
    return 75 + (25 * sizes * documents) // max(total, 1)


@dataclass
class Items:
    """Items of a block: for each its id and its terms with how often they occur there."""

    keys: list[int | None]
    terms: list[np.ndarray]
    repeats: list[np.ndarray]
    numbers: dict[bytes, int]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    @classmethod
    def of(cls, rows: list[tuple[int | None, str]]) -> Items:
        numbers: dict[bytes, int] = {}
        keys, terms, repeats = [], [], []
        for key, text in rows:
            found: Counter = Counter()
            for words in terms_of(text):
                found.update(words)
            if found:
                keys.append(key)
                terms.append(np.array([numbers.setdefault(w, len(numbers)) for w in found], dtype=np.int64))
                repeats.append(np.array(list(found.values()), dtype=np.int64))
        return cls(keys, terms, repeats, numbers)


def postings(documents: DataFrame, numbers: dict[bytes, int]) -> DataFrame:
    """doc_id, size, terms, tfs of every row with a term: numbers of the known terms and how often they occur."""
    sent = documents.sparkSession.sparkContext.broadcast(numbers)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = sent.value.get
        for batch in batches:
            ids, sizes, lengths = [], [], [0]
            terms: list[int] = []
            tfs: list[int] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                size, found = 0, Counter()
                for words in terms_of(text.as_py()):
                    size += len(words)
                    found.update(map(number, words))
                if not size:
                    continue
                found.pop(None, None)
                ids.append(key)
                sizes.append(size)
                terms.extend(found)
                tfs.extend(found.values())
                lengths.append(len(terms))
            offsets = pa.array(lengths, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32()))],
                names=["doc_id", "size", "terms", "tfs"],
            )

    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return frame.mapInArrow(run, "doc_id long, size long, terms array<int>, tfs array<int>")


class Shard:
    """Impact lists of a run of documents, with the place of each document in them."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, lengths: np.ndarray, terms: np.ndarray, tfs: np.ndarray, documents: int, total: int, count: int):
        self.ids = ids
        owner = np.repeat(np.arange(len(ids)), lengths)
        self.begins = np.r_[0, np.cumsum(lengths)]
        self.terms = terms
        self.local = local_scores(tfs, margins(sizes, documents, total)[owner])
        order = np.argsort(terms * _SCORES + (_SCORES - 1 - self.local), kind="stable")
        self.docs, self.scores = owner[order], self.local[order]
        sizes_of = np.bincount(terms, minlength=count)
        self.starts = np.r_[0, np.cumsum(sizes_of)]
        self.place = np.empty(len(terms), dtype=np.int64)
        self.place[order] = np.arange(len(terms))
        self.place -= self.starts[terms]
        self.slot = np.full(count, -1, dtype=np.int64)

    def entries(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the postings of some documents, and where each document's begin among them."""
        lengths = self.begins[docs + 1] - self.begins[docs]
        ends = np.cumsum(lengths)
        firsts = ends - lengths
        return np.repeat(self.begins[docs] - firsts, lengths) + np.arange(ends[-1] if len(ends) else 0), firsts

    def best(self, terms: np.ndarray, factors: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the k best documents; those strictly below ``floor`` may be missing.

        factors: weight times repeats of each term.
        """
        kept = (self.starts[terms + 1] > self.starts[terms]) & (factors > 0)
        terms, factors = terms[kept], factors[kept]
        lists, lengths = self.starts[terms], self.starts[terms + 1] - self.starts[terms]
        shift = np.r_[0, np.cumsum(lengths)]
        seen_places = np.zeros(shift[-1], dtype=bool)
        seen_docs = np.zeros(len(self.ids), dtype=bool)
        best_places = np.zeros(len(terms), dtype=np.int64)
        self.slot[terms] = np.arange(len(terms))
        scores, found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        depth, step = 0, FIRST_STEP
        while len(terms) and depth < lengths.max():
            # sorted access to all lists, the same positions in each
            parts = [self.docs[s + depth : s + min(depth + step, n)] for s, n in zip(lists, lengths, strict=True) if n > depth]
            met = np.unique(np.concatenate(parts))
            met = met[~seen_docs[met]]
            seen_docs[met] = True
            # direct access of each new document to the item's lists
            entry, firsts = self.entries(met)
            slot = self.slot[self.terms[entry]]
            own = slot >= 0
            gained = np.where(own, factors[slot] * self.local[entry], 0)
            seen_places[shift[slot[own]] + self.place[entry[own]]] = True
            if len(met):
                scores = np.concatenate([scores, np.add.reduceat(gained, firsts)])
                found = np.concatenate([found, met])
                scores, found = self._top(scores, found, k)
            depth += step
            step = min(2 * step, LAST_STEP)
            bound = 0
            for at, size in enumerate(lengths):
                place = int(best_places[at])
                rest = seen_places[shift[at] + place : shift[at + 1]]
                ahead = int(rest.argmin()) if len(rest) else 0
                place += len(rest) if len(rest) and rest[ahead] else ahead
                best_places[at] = place
                if place < size:
                    # the last seen position before the first gap
                    bound += int(factors[at]) * int(self.scores[lists[at] + max(place - 1, 0)])
            least = max(floor, int(scores[k - 1]) if len(scores) == k else 0)
            if bound < least or bound == 0:
                break
        self.slot[terms] = -1
        return scores, self.ids[found]

    def _top(self, scores: np.ndarray, found: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The k best by score, then id."""
        if len(scores) > k:
            near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            scores, found = scores[near], found[near]
        order = np.lexsort((self.ids[found], -scores))[:k]
        return scores[order], found[order]


def _shards(batches: Iterator[pa.RecordBatch], documents: int, total: int, count: int) -> Iterator[Shard]:
    held: list[tuple[np.ndarray, ...]] = []
    size = rows = 0

    def made() -> Shard:
        return Shard(*(np.concatenate(part) for part in zip(*held, strict=True)), documents, total, count)

    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column(0).fill_null(LAST_ID).to_numpy(zero_copy_only=False)
        lengths = np.diff(batch.column(2).offsets.to_numpy())
        terms, tfs = (batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(np.int64) for at in (2, 3))
        held.append((ids, batch.column(1).to_numpy(zero_copy_only=False), lengths, terms, tfs))
        size, rows = size + len(terms), rows + len(ids)
        if size > SHARD_POSTINGS or rows > SHARD_DOCUMENTS:
            yield made()
            held, size, rows = [], 0, 0
    if held:
        yield made()


def _search_block(documents: DataFrame, items: Items, k: int) -> DataFrame:
    """item (its place in the block), doc_id and score of the k best of each task."""
    spark = documents.sparkSession
    stored = store(postings(documents, items.numbers), "postings")
    sums = stored.agg(F.count("*").alias("documents"), F.sum("size").alias("total")).first()
    count, total = sums["documents"], sums["total"] or 0
    # as many rows as the block has terms
    held = stored.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    holding = np.zeros(len(items.numbers), dtype=np.int64)
    holding[held.column(0).to_numpy()] = held.column(1).to_numpy()
    weights = [math.floor(1000 * math.log((2 * count + 2) / (2 * df + 1))) for df in holding.tolist()]
    items.weights = np.array(weights, dtype=np.int64)
    sent = spark.sparkContext.broadcast((items.terms, items.repeats, items.weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, repeats, weights = sent.value
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int64))] * len(terms)
        for shard in _shards(batches, count, total, len(weights)):
            for at, (own, times) in enumerate(zip(terms, repeats, strict=True)):
                scores, ids = best[at]
                # what an earlier shard of the task holds need not be found again
                floor = int(scores[-1]) if len(scores) == k else 0
                more = shard.best(own, weights[own] * times, k, floor)
                scores, ids = (np.concatenate(pair) for pair in zip(best[at], more, strict=True))
                order = np.lexsort((ids, -scores))[:k]
                best[at] = scores[order], ids[order]
        for at, (scores, ids) in enumerate(best):
            if len(scores):
                found = pa.array(ids, pa.int64(), mask=ids == LAST_ID)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), at), pa.int64()), found, pa.array(scores, pa.int64())], names=["item", "doc_id", "score"])

    return stored.mapInArrow(run, "item long, doc_id long, score long")


def search(documents: DataFrame, items: DataFrame, k: int = BEST, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of each item, score above 0.

    items: item_id and text.
    """
    spark = documents.sparkSession
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string")).where("text is not null").distinct()
    size = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    if blocks > 1:
        asked = store(asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "items")
    found = spark.createDataFrame([], "block long, item long, item_id long, doc_id long, score long")
    for block in range(blocks):
        own = asked.where(F.col("block") == block) if blocks > 1 else asked
        # a block of the query set, of bounded size
        rows = own.select("item_id", "text").toArrow().to_pylist()
        some = Items.of(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1])))
        if not some.keys:
            continue
        names = spark.createDataFrame(list(enumerate(some.keys)), "item long, item_id long")
        best = _search_block(documents, some, k).join(names, "item")
        found = found.unionByName(best.select(F.lit(block).cast("long").alias("block"), "item", "item_id", "doc_id", "score"))
    order = Window.partitionBy("block", "item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.where("score > 0").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
