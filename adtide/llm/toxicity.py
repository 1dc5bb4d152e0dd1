"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on ordinary text and one on the words that set toxic text
apart. A window, which is one word with its blanks, is compressed with both. It speaks for toxicity if
its length under the toxic dictionary is at most one threshold and if it saves at least another against
the ordinary dictionary. Both thresholds are calibrated on labelled documents that trained neither
dictionary, and so is the score of a document whose densest stretch of words has none, one or more such windows;
the more stretches, the more of them chance explains.

A short word has too few bytes for a compressed block to gain anything. Each byte is therefore written
as four bytes of a fixed random code, which leaves the information as it is and scales the lengths.

Defined results: null and empty texts have no window and get the score of such documents; every row is
scored on its own, so repeated rows repeat; without toxic or without ordinary labelled rows no window
counts and the score is 0; labels with a null are ignored, and a document labelled both ways is toxic;
other columns of either table are ignored; a text of any length is read whole.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adtide.llm.common import held_out, identity, store

#: Bounds of the labelled sample: rows of each class, and bytes of all its texts.
TOXIC_ROWS, ORDINARY_ROWS, SAMPLE_BYTES = 3000, 4000, 1 << 25
#: Different texts of one id that may be in the sample.
TEXTS_OF_ID = 4
#: Words of a stretch; the densest one of a text counts.
STRETCH = 1000
#: A score from here on predicts toxicity.
THRESHOLD = 0.3
TOXIC_DICTIONARY, ORDINARY_DICTIONARY = 1 << 15, 3 << 14
#: Words whose verdict a worker remembers.
MEMORY_WORDS = 300_000
#: Bytes of the pieces of words that are compared between the classes, besides whole words.
GRAMS = (5, 8)
EDGES = b'.,;:!?"()[]|*#$'
_CODE = [row.tobytes() for row in np.random.default_rng(7).integers(0, 256, (256, 4), dtype=np.uint8)]


def _written(word: bytes) -> bytes:
    return b"".join([_CODE[c] for c in b" " + word + b" "])


def _words(text: str) -> list[bytes]:
    return [w.strip(EDGES) for w in text.encode().lower().split()]


def _stretches(words: list[bytes]) -> list[set[bytes]]:
    return [set(words[at : at + STRETCH]) for at in range(0, len(words), STRETCH)] or [set()]


def _grams(word: bytes) -> set[bytes]:
    padded = b" " + word + b" "
    pieces = {padded[i : i + n] for n in GRAMS for i in range(len(padded) - n + 1)}
    pieces.add(padded)
    return pieces


@dataclass
class Model:
    """What a task needs: about 80 KB of dictionaries, two thresholds and a few rates."""

    toxic: bytes = b""
    ordinary: bytes = b""
    longest: int = -1
    least_saving: int = 1
    #: labelled documents of each class, toxic first
    counts: tuple[float, float] = (0, 0)
    #: share of toxic texts, and of stretches of ordinary ones, with at least one and at least two telling windows
    toxic_rates: tuple[float, ...] = (0.0, 0.0)
    ordinary_rates: tuple[float, ...] = (0.0, 0.0)
    memory: dict = field(default_factory=dict, repr=False)

    @property
    def scores(self) -> tuple[float, ...]:
        return self.scores_of(1)

    def scores_of(self, stretches: int) -> tuple[float, ...]:
        """Scores of a text of so many stretches whose densest one has none, one or more telling windows.

        Chance hits of the other stretches are in both classes alike, so that they say less of a long text.
        """
        if not self.toxic:
            return 0.0, 0.0, 0.0
        if stretches not in self.memory:
            levels = []
            for rates, others in ((self.toxic_rates, stretches - 1), (self.ordinary_rates, stretches - 1)):
                one, two = (1 - (1 - p) * (1 - q) ** others for p, q in zip(rates, self.ordinary_rates, strict=True))
                levels.append((1 - one, one - two, two))
            shares = []
            for own, other in zip(*levels, strict=True):
                total = self.counts[0] * own + self.counts[1] * other
                shares.append(self.counts[0] * own / total if total > 0 else 0.0)
            self.memory[stretches] = tuple(np.maximum.accumulate(shares).tolist())
        return self.memory[stretches]

    def compressors(self):
        import zstandard

        made = []
        for content in (self.ordinary, self.toxic):
            shape = zstandard.ZstdCompressionParameters(
                format=zstandard.FORMAT_ZSTD1_MAGICLESS, strategy=zstandard.STRATEGY_LAZY2, min_match=5, window_log=17, hash_log=17, chain_log=17, search_log=4, target_length=64, write_content_size=0, write_checksum=0, write_dict_id=0
            )
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(compression_params=shape)
            made.append(zstandard.ZstdCompressor(dict_data=dictionary, compression_params=shape))
        return made

    def lengths(self) -> "WindowLengths":
        return WindowLengths(*self.compressors())


class WindowLengths:
    """Compressed lengths of a window under the ordinary and the toxic dictionary."""

    def __init__(self, ordinary, toxic):
        self.ordinary, self.toxic = ordinary, toxic

    def __call__(self, word: bytes) -> tuple[int, int]:
        data = _written(word)
        return min(len(data), len(self.ordinary.compress(data))), min(len(data), len(self.toxic.compress(data)))


class Verdicts(dict):
    """1 for a window that speaks for toxicity, else 0."""

    def __init__(self, model: Model):
        self.model, self.lengths = model, model.lengths()

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMORY_WORDS:
            self.clear()
        core = word.strip(EDGES)
        ordinary, toxic = self.lengths(core) if core else (0, 1 << 30)
        self[word] = verdict = int(toxic <= self.model.longest and ordinary - toxic >= self.model.least_saving)
        return verdict


def _dictionaries(own: list[set[bytes]], other: list[set[bytes]]) -> tuple[bytes, bytes]:
    """Toxic and ordinary dictionary of the words of toxic and of ordinary texts."""
    import zstandard

    words = [Counter(w for text in texts for w in text) for texts in (own, other)]
    grams: Counter = Counter()
    for text in own:
        grams.update(set().union(*map(_grams, text)))
    grams = Counter({g: c for g, c in grams.items() if c >= max(3, 0.015 * len(own))})
    # ordinary text only counts for grams that are frequent in toxic text
    wanted = grams.keys()
    holding = {w: found for w in words[1] if (found := _grams(w) & wanted)}
    against: Counter = Counter()
    for text in other:
        against.update(set().union(*(holding[w] for w in text if w in holding)))
    # grams of toxic text that ordinary text hardly has
    rate = 30 * len(own) / len(other)
    telling = {g for g, c in grams.items() if c > rate * (against[g] + 0.5)}
    # words with such a gram that ordinary text does not have, the most frequent last, where a match is cheapest
    ranked = sorted(words[0], key=lambda w: (words[0][w], w))
    marking = [w for w in ranked if w and words[0][w] > rate * words[1][w] and _grams(w) & telling]
    content = b"".join(map(_written, marking))[-TOXIC_DICTIONARY:]
    common = [w for w, _ in sorted(words[1].items(), key=lambda x: (-x[1], x[0]))[:8000] if w]
    samples = [_written(w) for w in common for _ in range(1 + min(20, words[1][w] // 20))]
    try:
        base = zstandard.train_dictionary(ORDINARY_DICTIONARY, samples, k=48, d=8).as_bytes()
    except zstandard.ZstdError:
        # too little text for training: the text itself
        base = b"".join(samples)[:ORDINARY_DICTIONARY]
    return content, base


def train(toxic: list[str], ordinary: list[str], counts: tuple[int, int] | None = None) -> Model:
    """Thresholds and scores are calibrated on every fourth text, with dictionaries of the others.

    counts: labelled documents of each class that the texts stand for, as many as there are texts if not given.
    """
    toxic, ordinary = list(dict.fromkeys(toxic)), list(dict.fromkeys(ordinary))
    if len(toxic) < 2 or len(ordinary) < 2:
        return Model()
    # one object for each word, however many texts hold it
    known: dict[bytes, bytes] = {}
    parted = [[_stretches([known.setdefault(w, w) for w in _words(t)]) for t in texts] for texts in (toxic, ordinary)]
    own, other = ([parts[0] if len(parts) == 1 else set().union(*parts) for parts in texts] for texts in parted)
    # toxic texts count as a whole, ordinary ones by their stretches
    held = [own[3::4] or own[-1:], [part for parts in parted[1][3::4] or parted[1][-1:] for part in parts]]
    dense = parted[0][3::4] or parted[0][-1:]
    model = Model(*_dictionaries([w for i, w in enumerate(own) if i % 4 != 3], [w for i, w in enumerate(other) if i % 4 != 3]))
    if not model.toxic:
        return Model()
    lengths, seen = model.lengths(), {}
    measured = []
    for texts in held:
        group = []
        for text in texts:
            for word in text.difference(seen):
                seen[word] = lengths(word) if word else (0, 1 << 30)
            group.append([seen[w] for w in text])
        measured.append(group)
    best = (-1.0, 0, 0)
    for longest in range(10, 20):
        for saving in (4, 6, 8, 10, 12):
            caught = [sum(any(t <= longest and o - t >= saving for o, t in text) for text in group) / len(group) for group in measured]
            # a false alarm costs five misses
            best = max(best, (caught[0] - 5 * caught[1], saving, -longest))
    model.longest, model.least_saving = -best[2], best[1]
    def level(text: list[tuple[int, int]]) -> int:
        return min(2, sum(t <= model.longest and o - t >= model.least_saving for o, t in text))

    totals = [[0.5] * 3, [0.5] * 3]
    for parts in dense:
        totals[0][max(level([seen[w] for w in part]) for part in parts)] += 1
    for text in measured[1]:
        totals[1][level(text)] += 1
    # each class weighs as much as it has labelled documents, however many of them are in the sample
    model.counts = counts or (len(own), len(other))
    model.toxic_rates, model.ordinary_rates = (((t[1] + t[2]) / sum(t), t[2] / sum(t)) for t in totals)
    # with thresholds and scores set, the dictionaries learn from the held texts too
    model.toxic, model.ordinary = _dictionaries(own, other)
    return model


def sample(documents: DataFrame, labels: DataFrame) -> tuple[DataFrame, tuple[int, int]]:
    """doc_id, text, toxic of the labelled rows to learn from, and the labelled documents of each class, toxic first.

    Of each class the rows with the smallest hash of the id, none held out, so that reruns agree.
    """
    marked = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    marked = marked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # one row for each class
    sizes = {r["toxic"]: r["count"] for r in marked.where("toxic in (0, 1)").groupBy("toxic").count().collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    some = [marked.where(f"toxic = {kind}").orderBy(*order).limit(rows) for kind, rows in ((1, TOXIC_ROWS), (0, ORDINARY_ROWS))]
    # at most 7,000 pairs of numbers
    chosen = some[0].unionByName(some[1])
    texts = identity(documents).where("text is not null").join(F.broadcast(chosen), "doc_id")
    keyed = texts.select("doc_id", "toxic", "text", F.xxhash64("doc_id").alias("turn"), F.xxhash64("text").alias("tid"))
    # repeated rows of an id are one, and of different texts of an id a few count
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("tid"))
    few = keyed.dropDuplicates(["doc_id", "tid"]).withColumn("number", number).where(F.col("number") <= TEXTS_OF_ID).drop("number")
    stored = store(few, "labelled")
    # texts of every length, in the same order, until the bytes are used up
    sizes_of = stored.select("toxic", "turn", "doc_id", "tid", F.octet_length("text").alias("size")).distinct().toArrow()
    left, taken = {0: SAMPLE_BYTES, 1: SAMPLE_BYTES}, []
    for kind, turn, doc, tid, size in sorted(zip(*(c.to_pylist() for c in sizes_of.columns), strict=True)):
        if size <= left[kind]:
            left[kind] -= size
            taken.append((doc, tid))
    fitting = documents.sparkSession.createDataFrame(taken, "doc_id long, tid long")
    chosen_texts = stored.join(F.broadcast(fitting), ["doc_id", "tid"]).select("doc_id", "text", "toxic")
    return chosen_texts, (sizes.get(1, 0), sizes.get(0, 0))


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """Train on a bounded sample of labelled rows that are not held out.

    One task learns from it, and only the model comes to the driver.
    """
    rows, counts = sample(documents, labels)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = sorted(row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        parts = ([text for _, text, kind in texts if kind == 1], [text for _, text, kind in texts if kind == 0])
        texts.clear()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(train(*parts, counts))], pa.binary())], names=["model"])

    made = rows.repartition(1).mapInArrow(learn, "model binary").first()
    return pickle.loads(bytes(made["model"])) if made else Model()


def score(documents: DataFrame, model: Model) -> DataFrame:
    """All columns of the documents plus ``toxic_windows`` and ``toxicity``."""
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType

    own = [c for c in documents.columns if c not in ("toxic_windows", "toxicity")]
    frame = documents.select(*own)
    at = own.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdicts = Verdicts(model) if model.toxic else None
        for batch in batches:
            hits, scores = [], []
            for text in batch.column(at):
                body = text.as_py()
                if not body or verdicts is None:
                    hits.append(0)
                    scores.append(model.scores[0])
                    continue
                parts = _stretches(body.encode().lower().split())
                found = [sum(map(verdicts.__getitem__, part)) for part in parts]
                hits.append(sum(map(verdicts.__getitem__, set().union(*parts))) if len(parts) > 1 else found[0])
                scores.append(model.scores_of(len(parts))[min(2, max(found))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hits, pa.int64()), pa.array(scores, pa.float64())], names=[*batch.schema.names, "toxic_windows", "toxicity"])

    schema = StructType([*frame.schema.fields, StructField("toxic_windows", LongType()), StructField("toxicity", DoubleType())])
    return frame.mapInArrow(run, schema)
