"""Token counts of whole texts under a byte-level BPE vocabulary.

Rank-synchronous array merging: the distinct pre-tokens of a batch lie in one ragged numpy array of
symbols; each round finds the lowest-ranked pair of every sequence and applies it everywhere in that
sequence at once; a sequence without a mergeable pair is done and what is left of it is counted. Very
long pre-tokens are merged rank by rank over linked arrays instead, so that their cost is linear-log.

Defined results: a null or empty text has no bytes and no tokens; special tokens inside a text count as
one each, as the library has it; every row gets a row, repeated rows and null ids too; an empty table
gives no rows; other columns are ignored. A text of any length is read in slices that end where a
pre-token ends; a single pre-token is held whole.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import identity

#: Tokens above which a document is marked.
LIMIT = 1024
#: Pre-tokens whose counts a worker remembers, and the longest of them.
MEMORY_WORDS = 1_000_000
MEMORY_LENGTH = 64
#: Characters of text that are split at once.
SLICE = 1 << 20
#: Bytes from which a pre-token is merged over linked arrays.
LONG = 512
#: Symbols that one ragged array holds.
ROUND_SYMBOLS = 1 << 21
#: Above every rank.
NO_RANK = np.int64(1 << 40)


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Merges:
    """Ranks of symbol pairs and what a pair becomes."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]]):
        symbols = byte_symbols()
        self.first = np.array([vocabulary[symbols[b]] for b in range(256)], dtype=np.int64)
        pairs = np.array([(vocabulary[a], vocabulary[b]) for a, b in merges], dtype=np.int64).reshape(-1, 2)
        self.made = np.array([vocabulary[a + b] for a, b in merges], dtype=np.int64)
        ranks = np.arange(len(merges), dtype=np.int64)
        born = np.full(max(vocabulary.values()) + 1, -1, dtype=np.int64)
        born[self.made[::-1]] = ranks[::-1]
        if len(merges) and (born[pairs].max(axis=1) >= ranks).any():
            raise ValueError("a merge uses a symbol that no earlier merge makes")
        keys = (pairs[:, 0] << 32) | pairs[:, 1]
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, a number above all ranks where there is none."""
        if not len(self.keys):
            return np.full(len(left), NO_RANK)
        wanted = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.order[at], NO_RANK)

    def count(self, words: list[bytes]) -> np.ndarray:
        """Surviving symbols of each word."""
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        counts = np.zeros(len(words), dtype=np.int64)
        for at in np.flatnonzero(sizes > LONG):
            counts[at] = self._count_long(words[at])
        short = np.flatnonzero((sizes <= LONG) & (sizes > 0))
        ends = np.cumsum(sizes[short])
        for part in np.split(short, np.searchsorted(ends, np.arange(ROUND_SYMBOLS, ends[-1] if len(ends) else 0, ROUND_SYMBOLS))):
            if len(part):
                counts[part] = self._count_ragged(b"".join(words[i] for i in part), sizes[part])
        return counts

    def _count_ragged(self, data: bytes, sizes: np.ndarray) -> np.ndarray:
        counts = np.zeros(len(sizes), dtype=np.int64)
        symbols = self.first[np.frombuffer(data, dtype=np.uint8)]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            lengths = np.diff(np.r_[starts, len(owner)])
            rank = np.full(len(symbols), NO_RANK)
            same = np.flatnonzero(owner[1:] == owner[:-1])
            rank[same] = self.ranks(symbols[same], symbols[same + 1])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), lengths)
            done = lowest == NO_RANK
            ready = done[starts]
            counts[owner[starts[ready]]] = lengths[ready]
            chosen = np.flatnonzero((rank == lowest) & ~done)
            chosen = alternate(chosen, chosen[1:] == chosen[:-1] + 1)
            symbols[chosen] = self.made[rank[chosen]]
            keep = ~done
            keep[chosen + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        return counts

    def _count_long(self, word: bytes) -> int:
        symbols = self.first[np.frombuffer(word, dtype=np.uint8)]
        size = len(symbols)
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        alive = np.ones(size, dtype=bool)
        buckets: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def offer(places: np.ndarray) -> None:
            places = places[(places >= 0) & (after[places] < size)]
            rank = self.ranks(symbols[places], symbols[after[places]])
            order = np.argsort(rank, kind="stable")[: int((rank < NO_RANK).sum())]
            places, rank = places[order], rank[order]
            if len(rank):
                for group in np.split(np.arange(len(rank)), np.flatnonzero(np.diff(rank)) + 1):
                    key = int(rank[group[0]])
                    if key not in buckets:
                        buckets[key] = []
                        heapq.heappush(waiting, key)
                    buckets[key].append(places[group])

        offer(np.arange(size))
        while waiting:
            key = heapq.heappop(waiting)
            places = np.unique(np.concatenate(buckets.pop(key)))
            places = places[alive[places]]
            places = places[after[places] < size]
            places = places[self.ranks(symbols[places], symbols[after[places]]) == key]
            places = alternate(places, after[places[:-1]] == places[1:])
            gone = after[places]
            symbols[places] = self.made[key]
            alive[gone] = False
            after[places] = after[gone]
            follows = after[places] < size
            before[after[places][follows]] = places[follows]
            offer(np.unique(np.concatenate([places, before[places]])))
        return int(alive.sum())


def alternate(places: np.ndarray, joined: np.ndarray) -> np.ndarray:
    """Every other place of each run, the first included; ``joined`` tells which places follow on the one before.

    Pairs of one rank overlap only in runs of one symbol, where the leftmost pair is merged first.
    """
    if not joined.any():
        return places
    index = np.arange(len(places))
    since = index - np.maximum.accumulate(np.where(np.r_[True, ~joined], index, 0))
    return places[since % 2 == 0]


class TokenCounts(dict):
    """Token count by pre-token of one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            shape = json.load(file)
        splitter = {k: v for k, v in (shape["pre_tokenizer"] or {}).items() if k in ("type", "add_prefix_space", "use_regex")}
        added = shape["added_tokens"]
        if shape["normalizer"] or splitter != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}:
            raise ValueError(f"{path} is no plain byte-level BPE")
        if any(token["lstrip"] or token["rstrip"] or token["single_word"] for token in added):
            raise ValueError(f"{path} has added tokens that take their surroundings")
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in shape["model"]["merges"]]
        self.merges = Merges(shape["model"]["vocab"], merges)
        contents = sorted((token["content"] for token in added), key=len, reverse=True)
        self.added = regex.compile("|".join(map(regex.escape, contents))) if contents else None
        self.strange = self._unknown(library)
        self.words = self._pattern(r"\p{L}", r"\p{N}")
        listed = "".join(map(regex.escape, sorted(self.strange)))
        # slow, for texts with such characters only
        self.older_words = self._pattern(rf"[\p{{L}}--[{listed}]]", rf"[\p{{N}}--[{listed}]]") if listed else self.words
        self.border = regex.compile(r"\S(?=\s)")

    @staticmethod
    def _pattern(letter: str, number: str):
        import regex

        return regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?{letter}+| ?{number}+| ?[^\s{letter}{number}]+|\s+(?!\S)|\s+", flags=regex.V1)

    @staticmethod
    def _unknown(library) -> set[str]:
        """Letters and numbers of a newer Unicode than the library's, for which they are other characters."""
        import regex

        characters = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
        unknown = set()
        for kind, lead in (("L", "a"), ("N", "1")):
            every = regex.compile(rf"\p{{{kind}}}").findall(characters)
            # a character of the class goes on with the run before it
            parts = library.pre_tokenizer.pre_tokenize_str("\n".join(lead + c for c in every))
            joined = {span[0] for _, span in parts if span[1] - span[0] == 2}
            unknown.update(c for at, c in enumerate(every) if at * 3 not in joined)
        return unknown

    def split(self, text: str) -> Iterator[list[str]]:
        """Pre-tokens of a text without added tokens, in slices."""
        words = self.words if text.isascii() or self.strange.isdisjoint(text) else self.older_words
        at = 0
        while at < len(text):
            found = self.border.search(text, at + SLICE) if len(text) - at > SLICE else None
            end = found.end() if found else len(text)
            yield words.findall(text, at, end)
            at = end

    def learn(self, words: Iterable[str]) -> dict[str, int]:
        """Counts of the given distinct words; the short ones are remembered."""
        if len(self) > MEMORY_WORDS:
            self.clear()
        new = [w for w in words if w not in self]
        counts = dict(zip(new, self.merges.count([w.encode() for w in new]).tolist(), strict=True))
        self.update((w, c) for w, c in counts.items() if len(w) <= MEMORY_LENGTH)
        return {w: c for w, c in counts.items() if len(w) > MEMORY_LENGTH}

    def count(self, texts: list[str | None]) -> list[int]:
        totals = [0] * len(texts)
        held: list[tuple[int, list[str]]] = []
        size = 0

        def settle() -> None:
            seen = set().union(*(words for _, words in held)) if held else set()
            long = self.learn(seen)
            for at, words in held:
                if long:
                    totals[at] += sum(self[w] if w in self else long[w] for w in words)
                else:
                    totals[at] += sum(map(self.__getitem__, words))
            held.clear()

        for at, text in enumerate(texts):
            parts = [text or ""]
            if self.added is not None and text and self.added.search(text):
                parts = self.added.split(text)
                totals[at] += len(parts) - 1
            for part in parts:
                for words in self.split(part):
                    held.append((at, words))
                    size += sum(map(len, words))
                    if size > SLICE:
                        settle()
                        size = 0
        settle()
        return totals


_known: dict[str, TokenCounts] = {}


def token_counts(documents: DataFrame, tokenizer: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if tokenizer not in _known:
            _known[tokenizer] = TokenCounts(tokenizer)
        counts = _known[tokenizer]
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(2), pa.array(counts.count(some.column(1).to_pylist()), pa.int64())], names=["doc_id", "n_bytes", "n_tokens"]
                )

    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    frame = identity(documents).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"), size.alias("n_bytes"))
    counted = frame.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
