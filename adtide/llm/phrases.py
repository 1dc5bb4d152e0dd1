"""Phrase collocations by language.

Dynamic itemset counting: the documents are dealt into shards that are scanned in a cycle, one shard a
step. Words are counted from the first step; a longer phrase is counted from the step after both its
subphrases, without the last and without the first word, have reached the threshold, in the middle of a
cycle as well, and until it has been counted in every shard once. All lengths are counted in the same
scans. What has reached the threshold, and in which step, is kept in a table of bytes of bounded size by
two hashes of a phrase; a phrase that shares its places with others is counted without need, never too
little. Counters are rows, merged by a grouping after each step; they name a phrase by the hash of all
words but the last and the hash of that, so that words are found again by joins of frequent phrases.

Of the phrases the cut with the lowest score counts; one that is part of a longer phrase with the same
count is dropped; each language keeps its first phrases.

Defined results: a null text is empty, a null lang is ``und``; repeated rows count as often as they occur;
null ids and other columns play no part; an empty table gives no rows. A text of any length counts as a
whole; it is read in slices that end where a piece ends. Phrases are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from adtide.llm.common import mix, store
from adtide.session import new_workspace
from adtide.sources.tables import delete_path

LONGEST = 5
THRESHOLD = 100
FIRST = 2000
UNKNOWN = "und"
#: Shards of the cycle.
SHARDS = 3
#: Places of the table of reached phrases, at least and at most (64 MB), and words of the corpus for each.
PLACES = (1 << 16, 1 << 26)
WORDS_A_PLACE = 8
#: Words that a task counts at once.
BATCH_WORDS = 1_000_000
#: Bytes of text that are split at once.
SLICE = 1 << 22
#: Words whose hashes a worker remembers.
MEMORY_WORDS = 500_000
_NEVER = 255
_PIECE_ENDS = b".,;:!?\n\v\f\r"
_FOLD = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x0A if c in _PIECE_ENDS else 0x20 if c == 0x09 else c for c in range(256))
_BORDER, _BLANK = 0, 1


class WordHashes(dict):
    """Hashes of the words of one language; piece borders and the blanks between words have numbers of their own.

    ``new`` lists the words met for the first time since it was emptied, with their hashes.
    """

    def __init__(self, lang: str) -> None:
        import xxhash

        super().__init__({b"\n": _BORDER, b"": _BLANK})
        self.seed = xxhash.xxh64_intdigest(lang.encode())
        #: names the language in the counters of its words
        self.salt = int(np.uint64(self.seed).view(np.int64))
        self.new: list[tuple[int, bytes]] = []

    def __missing__(self, word: bytes) -> int:
        import xxhash

        self[word] = value = max(xxhash.xxh64_intdigest(word, seed=self.seed), 2)
        self.new.append((value, word))
        return value


def split(text: str | None, known: WordHashes) -> Iterator[np.ndarray]:
    """Hashes of the words of a text, a border after each piece; in slices of whole pieces."""
    folded = (text or "").encode().translate(_FOLD)
    at = 0
    while at < len(folded):
        end = folded.find(b"\n", at + SLICE)
        end = len(folded) if end < 0 else end + 1
        parts = (folded[at:end] + b"\n").replace(b"\n", b" \n ").split(b" ")
        hashes = np.fromiter(map(known.__getitem__, parts), dtype=np.uint64, count=len(parts))
        yield hashes[hashes != _BLANK]
        at = end


def _languages() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))


def encode(documents: DataFrame, shards: int) -> DataFrame:
    """Rows of a language: the hashes of the words as bytes, a zero after each piece, and the words new to the task.

    Written by shard.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, WordHashes] = {}
        turn = 0
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                if sum(map(len, known.values())) > MEMORY_WORDS:
                    known = {}
                some = batch.slice(first, 256)
                out: dict[str, list] = {n: [] for n in schema.names}
                for lang, text in zip(some.column(0).to_pylist(), some.column(1), strict=True):
                    if lang not in known:
                        known[lang] = WordHashes(lang)
                    own = known[lang]
                    for hashes in split(text.as_py(), own):
                        out["lang"].append(lang)
                        out["salt"].append(own.salt)
                        out["n"].append(int((hashes != _BORDER).sum()))
                        out["shard"].append(turn % shards)
                        out["words"].append(hashes.tobytes())
                        out["hashes"].append(np.array([h for h, _ in own.new], dtype=np.uint64).view(np.int64))
                        out["names"].append([w.decode() for _, w in own.new])
                        own.new.clear()
                        turn += 1
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    numbers, texts = pa.list_(pa.int64()), pa.list_(pa.string())
    schema = pa.schema([("lang", pa.string()), ("salt", pa.int64()), ("n", pa.int64()), ("shard", pa.int32()), ("words", pa.binary()), ("hashes", numbers), ("names", texts)])
    frame = documents.select(_languages().alias("lang"), F.col("text").cast("string"))
    encoded = frame.mapInArrow(run, "lang string, salt long, n long, shard int, words binary, hashes array<long>, names array<string>")
    path = new_workspace(documents.sparkSession, "words")
    encoded.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return documents.sparkSession.read.schema(encoded.schema).parquet(path)


def joined(prefixes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash of a phrase from those of all but its last word and of that word."""
    return mix(prefixes * np.uint64(0x9E3779B97F4A7C15) + words)


class Reached:
    """In which step a phrase has reached the threshold, by two places of a table."""

    def __init__(self, places: int):
        self.table = np.full(places, _NEVER, dtype=np.uint8)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        last = np.uint64(len(self.table) - 1)
        return np.maximum(self.table[(hashes & last).astype(np.int64)], self.table[((hashes >> np.uint64(32)) & last).astype(np.int64)])

    def add(self, phrases: DataFrame, step: int) -> None:
        """Mark the places of the given phrases; what comes to the driver is a bit for each place at most."""
        last = np.uint64(len(self.table) - 1)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hashes = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                places = np.unique(np.concatenate([hashes & last, (hashes >> np.uint64(32)) & last]))
                yield pa.RecordBatch.from_arrays([pa.array(places.view(np.int64) + 1)], names=["place"])

        places = phrases.select("hash").mapInArrow(run, "place long")
        bits = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        for bucket, content in zip(*(c.to_pylist() for c in bits.toArrow().columns), strict=True):
            own = self.table[(bucket - 1) * 32768 : bucket * 32768]
            marked = np.unpackbits(np.frombuffer(content, dtype=np.uint8), bitorder="little")[: len(own)].astype(bool)
            own[marked & (own == _NEVER)] = step


def hashed(counters: DataFrame) -> DataFrame:
    """Counters with the hash of the whole phrase."""
    columns = ["hash", *counters.columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prefix, word = (batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64) for c in ("prefix", "word"))
            one = batch.column("length").to_numpy(zero_copy_only=False) == 1
            own = np.where(one, word, joined(prefix, word)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(own), *batch.columns], names=columns)

    return counters.mapInArrow(run, StructType([StructField("hash", LongType()), *counters.schema.fields]))


def active(words: np.ndarray, reached: Reached, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Length, hashes of the prefixes, last words and first counting step of all phrases whose subphrases have reached the threshold."""
    at = np.flatnonzero(words != _BORDER)
    hashes = words
    since = np.full(len(words), _NEVER, dtype=np.uint8)
    since[at] = reached(words[at])
    yield 1, np.zeros(len(at), dtype=np.uint64), words[at], np.zeros(len(at), dtype=np.uint8)
    for length in range(2, longest + 1):
        if len(since) < 2:
            return
        later = np.maximum(since[:-1], since[1:])
        at = np.flatnonzero(later < _NEVER)
        prefixes, ends = hashes[at], words[at + length - 1]
        # a place shared with another phrase may be marked before the phrase is counted at all
        begins = later[at] + np.uint8(1)
        yield length, prefixes, ends, begins
        own = joined(prefixes, ends)
        since = np.full(len(later), _NEVER, dtype=np.uint8)
        since[at] = np.maximum(reached(own), begins)
        hashes = np.zeros(len(later), dtype=np.uint64)
        hashes[at] = own


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Hashes of the words of many rows at once, the salts of the rows and where each ends."""
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def run() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum([len(w) for _, w in held])
        return np.concatenate([w for _, w in held]), np.array([s for s, _ in held], dtype=np.int64), ends

    for batch in batches:
        for salt, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            held.append((salt, np.frombuffer(words.as_buffer(), dtype=np.uint64)))
            size += len(held[-1][1])
            if size > BATCH_WORDS:
                yield run()
                held, size = [], 0
    if size:
        yield run()


def count_step(shard: DataFrame, reached: Reached, step: int, shards: int, longest: int) -> DataFrame:
    """prefix, word, kind and count of the phrases that are counted in this step.

    kind: 256 times the length plus the first counting step.
    """
    sent = shard.sparkSession.sparkContext.broadcast(reached)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words, salts, row_ends in _runs(batches):
            for length, prefixes, ends, since in active(words, sent.value, longest):
                counted = np.flatnonzero((since <= step) & (step < since.astype(np.int64) + shards))
                if not len(counted):
                    continue
                hashes = joined(prefixes[counted], ends[counted]) if length > 1 else ends[counted]
                _, firsts, counts = np.unique(hashes, return_index=True, return_counts=True)
                own = counted[firsts]
                if length > 1:
                    prefix = prefixes[own].view(np.int64)
                else:
                    solid = np.flatnonzero(words != _BORDER)
                    prefix = salts[np.searchsorted(row_ends, solid[own], side="right")]
                kinds = length * 256 + since[own].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(prefix), pa.array(ends[own].view(np.int64)), pa.array(kinds, pa.int32()), pa.array(counts.astype(np.int64))], names=["prefix", "word", "kind", "count"])

    return shard.select("salt", "words").mapInArrow(run, "prefix long, word long, kind int, count long")


def frequent_phrases(encoded: DataFrame, threshold: int, longest: int, shards: int) -> DataFrame:
    """hash, prefix, word, length and count of all phrases with the threshold.

    prefix: hash of all words but the last; of a single word the salt of its language. word: hash of the last word.
    """
    spark = encoded.sparkSession
    words = encoded.agg(F.sum("n")).first()[0] or 0
    reached = Reached(min(max(PLACES[0], 1 << (words // WORDS_A_PLACE).bit_length()), PLACES[1]))
    running, complete, before = None, [], None
    step, last = 0, -1
    keys = ["prefix", "word", "kind"]
    length, since = F.shiftright("kind", 8).alias("length"), F.col("kind").bitwiseAND(255)
    while step < shards or step <= last + shards:
        counted = count_step(encoded.where(F.col("shard") == step % shards), reached, step, shards, longest)
        counted = counted.withColumn("known", F.lit(False))
        merged = (counted if running is None else running.unionByName(counted)).groupBy(*keys).agg(F.sum("count").alias("count"), F.max("known").alias("known"))
        kept = merged.withColumn("done", since + shards == step + 1).where(~F.col("done") | (F.col("count") >= threshold))
        path = new_workspace(spark, f"phrases-{step}")
        kept.write.partitionBy("done").option("compression", "zstd").parquet(path)
        if before:
            # counters that this step has merged
            delete_path(spark, f"{before}/done=false")
        before = path
        stored = spark.read.schema(kept.schema).parquet(path)
        new = stored.where((F.col("count") >= threshold) & ~F.col("known")).select("prefix", "word", length)
        reached.add(hashed(new), step)
        if not new.where(F.col("length") < longest).isEmpty():
            last = step
        complete.append(stored.where("done").select("prefix", "word", length, "count"))
        running = stored.where("not done").select(*keys, "count", (F.col("count") >= threshold).alias("known"))
        step += 1
    return hashed(functools.reduce(DataFrame.unionByName, complete))


def spelled(frequent: DataFrame, longest: int) -> DataFrame:
    """hash, salt, length, count and the hashes of the words, of the first parts and of the rests of all frequent phrases."""

    def parted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("length").to_numpy(zero_copy_only=False)
            flat = batch.column("words").flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            starts = np.r_[0, np.cumsum(sizes)]
            lefts, rights = ([np.zeros(0, np.int64)] * len(sizes) for _ in range(2))
            for length in np.unique(sizes[sizes > 1]).tolist():
                rows = np.flatnonzero(sizes == length)
                words = flat[starts[rows][:, None] + np.arange(length)]

                def of(first: int, end: int, words: np.ndarray = words) -> np.ndarray:
                    value = words[:, first]
                    for at in range(first + 1, end):
                        value = joined(value, words[:, at])
                    return value.view(np.int64)

                left = np.stack([of(0, k) for k in range(1, length)], axis=1)
                right = np.stack([of(k, length) for k in range(1, length)], axis=1)
                for row, own_left, own_right in zip(rows.tolist(), left, right, strict=True):
                    lefts[row], rights[row] = own_left, own_right
            numbers = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lefts, numbers), pa.array(rights, numbers)], names=[*batch.schema.names, "lefts", "rights"])

    frequent = store(frequent, "phrases")
    level = frequent.where("length = 1").select("hash", F.col("prefix").alias("salt"), "length", "count", F.array("word").alias("words"))
    levels = [level]
    for length in range(2, longest + 1):
        shorter = level.select(F.col("hash").alias("prefix"), "salt", F.col("words").alias("begin"))
        own = frequent.where(F.col("length") == length).join(shorter, "prefix")
        level = store(own.select("hash", "salt", "length", "count", F.concat("begin", F.array("word")).alias("words")), f"words-{length}")
        levels.append(level)
    every = functools.reduce(DataFrame.unionByName, levels)
    return every.mapInArrow(parted, "hash long, salt long, length int, count long, words array<long>, lefts array<long>, rights array<long>")


def named(encoded: DataFrame, wanted: DataFrame) -> DataFrame:
    """hash and name of the wanted words."""
    filled = Reached(PLACES[0] << 4)
    filled.add(wanted, 0)
    sent = encoded.sparkSession.sparkContext.broadcast(filled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).flatten()
            found = np.flatnonzero(sent.value(hashes.to_numpy(zero_copy_only=False).view(np.uint64)) < _NEVER)
            yield pa.RecordBatch.from_arrays([hashes.take(found), batch.column(1).flatten().take(found)], names=["hash", "name"])

    near = encoded.select("hashes", "names").mapInArrow(run, "hash long, name string")
    return near.join(wanted, "hash", "left_semi").dropDuplicates(["hash"])


def score() -> Column:
    """floor(1000 a n / (l r)), exact where the products pass 64 bits."""
    wide = {c: f"cast({c} as decimal(19,0))" for c in "alrn"}
    return F.expr(f"({wide['a']} * {wide['n']} * cast(1000 as decimal(4,0))) div ({wide['l']} * {wide['r']})").alias("score")


def collocations(documents: DataFrame, threshold: int = THRESHOLD, first: int = FIRST, longest: int = LONGEST, shards: int = SHARDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the first phrases of each language."""
    encoded = encode(documents, shards)
    every = store(spelled(frequent_phrases(encoded, threshold, longest, shards), longest), "phrases")
    counts = every.select("hash", "length", "count")
    sizes = encoded.groupBy("lang", "salt").agg(F.sum("n").alias("n"))
    candidates = every.where("length > 1").withColumnRenamed("count", "a")
    # a phrase inside a longer one of the same count: then also in one with one word more
    longer = candidates.where("length > 2").select(F.explode(F.array(F.element_at("lefts", -1), F.element_at("rights", 1))).alias("hash"), (F.col("length") - 1).alias("length"), "a").distinct()
    cuts = candidates.join(longer, ["hash", "length", "a"], "left_anti").select("hash", "salt", "length", "a", "words", F.posexplode(F.arrays_zip("lefts", "rights")).alias("before", "cut"))
    cuts = cuts.select("*", F.col("cut.lefts").alias("left"), F.col("cut.rights").alias("right"), (F.col("before") + 1).alias("left_length"), (F.col("length") - F.col("before") - 1).alias("right_length"))
    for side, letter in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select(F.col("hash").alias(side), F.col("length").alias(f"{side}_length"), F.col("count").alias(letter)), [side, f"{side}_length"])
    cuts = cuts.join(sizes, "salt")
    lowest = F.min(F.struct(score(), "before", "l", "r")).alias("cut")
    scored = cuts.groupBy("hash", "length", "lang", "a", "n").agg(lowest, F.first("words").alias("words")).select("hash", "length", "lang", "a", "cut.l", "cut.r", "n", "cut.score", "words")
    order = [F.desc("score"), F.desc("a")]
    # what may be among the first, ties included, gets its text
    near = scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("place") <= first).drop("place")
    near = store(near, "phrases-near")
    spelt = near.select("hash", "length", F.posexplode("words").alias("at", "word"))
    names = named(encoded, store(spelt.select(F.col("word").alias("hash")).distinct(), "words-near"))
    spelt = spelt.join(names.withColumnRenamed("hash", "word"), "word")
    texts = spelt.groupBy("hash", "length").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "name"))), lambda e: e["name"]), " ").alias("phrase"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy(*order, F.asc("phrase")))
    ranked = near.join(texts, ["hash", "length"]).withColumn("rank", number).where(F.col("rank") <= first)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
