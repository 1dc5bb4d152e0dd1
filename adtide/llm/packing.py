"""Best-fit packing of tokenized documents into sequences.

Bounded-space online best-fit: each task keeps a fixed number of open bins, indexed by a bitset
over free space; a piece goes to the open bin that it fills best, and when no bin fits and all
places are taken, the fullest bin closes. The bins still open at a task's end become items of a
smaller packing, in rounds, until few enough are left for one task to have packed them all.

Defined results: a null or empty text is the end token alone; every row is a document of its own, so
repeated rows are packed as often as they occur; an empty table gives no rows; other columns are
ignored; a text of any length is cut into full pieces and one rest.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import identity, store
from adtide.llm.tokens import NO_RANK, Merges, alternate, byte_symbols

CAPACITY = 4096
END_TOKEN = 1
OPEN_BINS = 256
#: Pieces that one task packs.
TASK_PIECES = 50_000
#: Open bins that one task of a later round repacks.
ROUND_BINS = 32 * OPEN_BINS
#: Bytes of text whose unknown words are learned at once, about.
LEARNED_BYTES = 4 << 20
#: Bytes of the longest run that is merged with others.
LONGEST_RUN = 256
#: Words whose ids a worker remembers.
MEMORY_WORDS = 1_000_000


#: Small letters of ASCII and Latin-1 alone, which the tokenizer's normalizer leaves as they are.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+")


class LetterRuns(Merges):
    """Token ids of runs of small letters, each of which is one pre-token that ends with a word-end sign.

    The ragged arrays are merged as for counts; pairs are looked up in a table by a product of their
    symbols instead of by bisection.
    """

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str):
        super().__init__(vocabulary, merges)
        symbols = byte_symbols()
        self.last = np.array([vocabulary.get(symbols[b] + suffix, -1) for b in range(256)], dtype=np.int64)
        bits = max(4, (4 * len(self.keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot_keys = np.full(1 << bits, -1, dtype=np.int64)
        self.slot_ranks = np.full(1 << bits, NO_RANK, dtype=np.int64)
        for key, rank, place in zip(self.keys.tolist(), self.order.tolist(), self._places(self.keys).tolist(), strict=True):
            while self.slot_keys[place] >= 0:
                place = (place + 1) & self.mask
            self.slot_keys[place], self.slot_ranks[place] = key, rank

    def _places(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left << 32) | right
        places = self._places(keys)
        held = self.slot_keys[places]
        found = np.where(held == keys, self.slot_ranks[places], NO_RANK)
        rest = np.flatnonzero((held != keys) & (held >= 0))
        while len(rest):
            places[rest] = (places[rest] + 1) & self.mask
            held = self.slot_keys[places[rest]]
            same = held == keys[rest]
            found[rest[same]] = self.slot_ranks[places[rest[same]]]
            rest = rest[~same & (held >= 0)]
        return found

    def ids(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in turn, and where each word's begin, with the end of the last."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        symbols, ends = self.first[data], np.cumsum(sizes) - 1
        symbols[ends] = self.last[data[ends]]
        owner = np.repeat(np.arange(len(words)), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            rank = np.full(len(symbols), NO_RANK)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same] = self.ranks(symbols[same], symbols[same + 1])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(owner)]))
            over = lowest == NO_RANK
            done.append((owner[over], symbols[over]))
            chosen = np.flatnonzero((rank == lowest) & ~over)
            chosen = alternate(chosen, chosen[1:] == chosen[:-1] + 1)
            symbols[chosen] = self.made[rank[chosen]]
            keep = ~over
            keep[chosen + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        owners = np.concatenate([o for o, _ in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(owners, kind="stable")
        flat = np.concatenate([s for _, s in done])[order] if done else np.zeros(0, np.int64)
        return flat, np.r_[0, np.cumsum(np.bincount(owners, minlength=len(words)))]


class WordIds(dict):
    """Token ids, as little-endian bytes, of words between ASCII white space.

    The tokenizer drops white space and no token crosses it, so that a text's ids are those of
    its words in turn. Unknown words of a batch are encoded together.
    """

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.mark = "<|endoftext|>"
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.letters = LetterRuns(model["vocab"], merges, model["end_of_word_suffix"] or "")

    def encode(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8"), add_special_tokens=False).ids
        return np.array(ids, dtype="<u4").tobytes()

    def learn(self, words: set[bytes]) -> None:
        if len(self) > MEMORY_WORDS:
            self.clear()
        plain, runs, fits = {}, set(), _RUN.fullmatch
        for word in words.difference(self):
            if fits(word) and len(word) <= LONGEST_RUN:
                runs.add(word)
                continue
            if b"<|" in word:
                # may hold a special token, which is matched before letters are lowered
                self[word] = self.encode(word)
                continue
            core = word.lower()
            tail = core[-1:]
            if tail in b".," and len(core) > 1 and core[-2:-1].isalnum():
                core = core[:-1]
            else:
                tail = b""
            plain[word] = (core, tail)
        for tail in (b".", b","):
            if tail not in self:
                self[tail] = self.encode(tail)
        cores = {c for c, _ in plain.values() if c not in self}
        runs.update(c for c in cores if fits(c) and len(c) <= LONGEST_RUN)
        # a run of letters is one pre-token; long ones are left to the library
        wanted = list(runs)
        for first in range(0, len(wanted), 100_000):
            some = wanted[first : first + 100_000]
            flat, starts = self.letters.ids(some)
            data, at = flat.astype("<u4").tobytes(), (starts * 4).tolist()
            self.update((c, data[a:b]) for c, a, b in zip(some, at, at[1:], strict=False))
        cores = list(cores - runs)
        for first in range(0, len(cores), 20_000):
            some = cores[first : first + 20_000]
            joined = self.mark.join(c.decode("utf-8") for c in some)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            marks = np.flatnonzero(ids == self.mark_id)
            if len(marks) != len(some) - 1:
                self.update((c, self.encode(c)) for c in some)
                continue
            data = ids.tobytes()
            starts = [0, *((marks + 1) * 4).tolist()]
            ends = [*(marks * 4).tolist(), len(data)]
            self.update((c, data[a:b]) for c, a, b in zip(some, starts, ends, strict=True))
        for word, (core, tail) in plain.items():
            self[word] = self[core] + (self[tail] if tail else b"")


_known: dict[str, WordIds] = {}


def tokenize(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of at most ``capacity`` tokens with their place in the document and their checksum."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _known:
            _known[tokenizer] = WordIds(tokenizer)
        known = _known[tokenizer]
        end = END_TOKEN.to_bytes(4, "little")
        for batch in batches:
            # bytes as they are: words end at ASCII white space, which no other character contains
            keys, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            # rows with some MB of text at once: a word is then looked for once in many texts
            edges = np.cumsum(np.r_[0, pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)]) // LEARNED_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(edges[:-1])) + 1).tolist(), len(keys)] if len(keys) else [0]
            for first, end_row in zip(cuts, cuts[1:], strict=False):
                bodies = [(t or b"").split() for t in texts.slice(first, end_row - first).to_pylist()]
                known.learn(set().union(*bodies))
                out: dict[str, list] = {n: [] for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
                for key, words in zip(keys[first:end_row], bodies, strict=True):
                    data = b"".join(map(known.__getitem__, words)) + end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        out["doc_id"].append(key)
                        out["piece"].append(piece)
                        out["start"].append(at // 4)
                        out["length"].append(len(part) // 4)
                        out["ids_crc32"].append(zlib.crc32(part))
                schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), *((n, pa.int64()) for n in ("start", "length", "ids_crc32"))])
                yield pa.RecordBatch.from_pydict(out, schema=schema)

    frame = identity(documents).select(F.col("doc_id").cast("long"), "text")
    return frame.mapInArrow(pieces, "doc_id long, piece int, start long, length long, ids_crc32 long")


class OpenBins:
    """A fixed number of open bins; bit f of the set says that a bin with free space f is open."""

    def __init__(self, capacity: int, limit: int):
        self.capacity, self.limit = capacity, limit
        self.free_set, self.by_free, self.count, self.made = 0, {}, 0, 0

    def _take(self, free: int) -> int:
        stack = self.by_free[free]
        number = stack.pop()
        if not stack:
            del self.by_free[free]
            self.free_set &= ~(1 << free)
        self.count -= 1
        return number

    def put(self, length: int) -> tuple[int, int]:
        """Bin number and offset of a piece."""
        fitting = self.free_set >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            if self.count == self.limit:
                fullest = (self.free_set & -self.free_set).bit_length() - 1
                self._take(fullest)
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            self.by_free.setdefault(left, []).append(number)
            self.free_set |= 1 << left
            self.count += 1
        return number, self.capacity - free

    def open(self) -> dict[int, int]:
        return {number: self.capacity - free for free, stack in self.by_free.items() for number in stack}


def _pack(keyed: DataFrame, capacity: int, open_bins: int, group: str) -> DataFrame:
    """Pack the items of each group in the frame's sorted order.

    keyed: group, item columns and ``length``, with all rows of a group together. Adds ``bin``, ``shift``
    and, once a group is over, a row per bin still open (``item`` null, ``length`` its fill).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, bins = None, None
        schema = pa.schema([("grp", pa.int64()), ("item", pa.int64()), ("length", pa.int64()), ("bin", pa.int64()), ("shift", pa.int64())])

        def leftovers() -> pa.RecordBatch:
            rest = sorted(bins.open().items())
            rows = [{"grp": current, "item": None, "length": fill, "bin": number, "shift": None} for number, fill in rest]
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            groups, lengths = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            items, placed, shifts = [], [], []
            pending = 0
            for at, (key, length) in enumerate(zip(groups, lengths, strict=True)):
                if key != current:
                    if bins is not None:
                        if at > pending:
                            part = slice(pending, at)
                            yield _rows(batch, part, placed, shifts, schema)
                            placed, shifts, pending = [], [], at
                        yield leftovers()
                    current, bins = key, OpenBins(capacity, open_bins)
                number, shift = bins.put(length)
                placed.append(number)
                shifts.append(shift)
            if len(groups) > pending:
                yield _rows(batch, slice(pending, len(groups)), placed, shifts, schema)
        if bins is not None:
            yield leftovers()

    def _rows(batch, part, placed, shifts, schema):
        own = batch.slice(part.start, part.stop - part.start)
        return pa.RecordBatch.from_arrays([own.column(0), own.column(1), own.column(2), pa.array(placed, pa.int64()), pa.array(shifts, pa.int64())], schema=schema)

    return keyed.select(F.col(group).alias("grp"), "item", "length").mapInArrow(run, "grp long, item long, length long, bin long, shift long")


def pack(pieces: DataFrame, capacity: int = CAPACITY, open_bins: int = OPEN_BINS, task_pieces: int = TASK_PIECES) -> DataFrame:
    """Give each piece its sequence and its offset there: adds ``sequence_id`` and ``offset``.

    pieces: any frame with ``length`` between 1 and the capacity. Every sequence is filled without gaps.
    """
    columns = pieces.columns
    numbered = pieces.withColumn("item", F.monotonically_increasing_id())
    # the numbers hold once they are written
    stored = store(numbered, "pieces")
    whole = stored.where(F.col("length") == capacity)
    rest = stored.where(F.col("length") < capacity)
    count = rest.count()
    tasks = max(1, -(-count // task_pieces))
    placed = _round(rest.select("item", "length"), "pieces", tasks, capacity, open_bins)
    items = placed.where("item is not null").select("item", "bin", "shift")
    left = placed.where("item is null").select(F.col("bin").alias("item"), "length")
    moves = []
    groups = tasks
    # the last tasks' open bins meet in ever fewer groups
    while groups > 1:
        groups = max(1, -(-groups * open_bins // ROUND_BINS))
        placed = _round(left, f"bins-{len(moves)}", groups, capacity, open_bins)
        moves.append(placed.where("item is not null").select(F.col("item").alias("bin"), F.col("bin").alias("to"), F.col("shift").alias("by")))
        left = placed.where("item is null").select(F.col("bin").alias("item"), "length")
    for move in moves:
        items = items.join(move, "bin", "left").select("item", F.coalesce("to", "bin").alias("bin"), (F.col("shift") + F.coalesce("by", F.lit(0))).alias("shift"))
    full = whole.select(*columns, (-F.col("item") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    mixed = rest.join(items, "item").select(*columns, F.col("bin").alias("sequence_id"), F.col("shift").alias("offset"))
    return full.unionByName(mixed)


def _round(items: DataFrame, name: str, groups: int, capacity: int, open_bins: int) -> DataFrame:
    """One packing over ``groups`` groups; bin numbers are unique over groups and rounds."""
    spread = F.xxhash64("item", F.lit(name))
    keyed = items.withColumn("grp", F.pmod(spread, F.lit(groups))).withColumn("turn", F.xxhash64("item", F.lit("turn")))
    keyed = keyed.repartition(groups, "grp").sortWithinPartitions("grp", "turn", "item")
    packed = _pack(keyed, capacity, open_bins, "grp")
    number = int(name.rpartition("-")[2]) + 1 if name.startswith("bins-") else 0
    tag = F.lit(number << 56).cast("long") + F.col("grp") * (1 << 28)
    return store(packed.withColumn("bin", F.col("bin") + tag).drop("grp"), f"packed-{name}")


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, open_bins: int = OPEN_BINS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document."""
    return pack(tokenize(documents, tokenizer, capacity), capacity, open_bins)
