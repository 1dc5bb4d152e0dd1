"""N-gram Jaccard join through a token-group matrix.

The tokens of a document are the hashes of its distinct word shingles. A partner at similarity 0.8 misses
at most a fifth of them, so that two linked documents share a token among the first n - ceil(0.8 n) + 1 of any
order of tokens common to all. The order here puts tokens below a fixed hash first and, among these, the rarer
ones; a document passes on only as many of its tokens as that order can need. This bounds the overlap twice:

* against all documents at once: a document whose first tokens are all its own has no partner and is done;
* against groups: those left are partitioned by a minimum hash of their shared tokens into groups of at most
  GROUP_DOCS. A matrix has a row for each token and group whose union holds it, with the sizes in the group.
  A document opens a group only if one of its first tokens is in the union and the sizes allow a link.

Equal sets form one class beforehand. The members of a group are compared first; every part of
a large group also holds the group's first document, which joins the parts. What one component already connects is
not compared again. From then on a token that only one component has counts as a token of a single document, which
closes all that share less than a link's part with other components. Those still open pass on all their tokens for
an order by rarity alone and are compared with the document of their group, under other hashes, that has the
least tokens alone. Last a group is opened by documents of other components whose first tokens are in its union at
places and in sizes that allow a link, the smaller component asking the larger. An opened group compares whole
sets. Links lose no pair that could connect two components.

Defined results: null and blank texts have an empty set, are linked with nothing and are their own
component; a text of fewer words than a shingle has one shingle; repeated rows repeat in the result;
a null doc_id is later than every other and is the component of rows with null ids only; an empty table gives
no rows; other columns are ignored; texts of any length are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import LAST_ID, discard, doc_key, find_words, mix, one_row_each, span_hashes, store, text_slices, window_hashes, word_hashes
from adtide.llm.graph import components

SHINGLE = 5
#: A link needs this share of the union, in percent.
PERCENT = 80
#: Shares of all hashes up to which tokens come first in the order.
LEVELS = (0.3, 0.5, 1.0)
GROUP_DOCS = 64
#: Documents that one task compares with a group.
ASKING_DOCS = 256
#: Further groupings in which documents are compared with one of their group.
STAR_ROUNDS = 2
_EDGES = np.array([int(share * 2.0**64) - 1 if share < 1 else 2**64 - 1 for share in LEVELS], dtype=np.uint64)


def least_overlap(count: int) -> int:
    """Tokens of a set that any linked set shares at least."""
    return -(-count * PERCENT // 100)


def first_tokens(count: int) -> int:
    return count - least_overlap(count) + 1


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text, ASCII letters lowered."""
    for low, high, data, offsets in text_slices(column):
        lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        starts, ends, begins = find_words(lowered, offsets)
        words = word_hashes(lowered, starts, ends)
        runs = window_hashes(words, SHINGLE)
        for at in range(high - low):
            first, end = int(begins[at]), int(begins[at + 1])
            if end - first >= SHINGLE:
                yield np.unique(runs[first : end - SHINGLE + 1])
            elif end > first:
                yield span_hashes(words, np.array([first]), np.array([end]))
            else:
                yield runs[:0]


def _summaries(documents: DataFrame) -> DataFrame:
    """doc, tid, n, two set fingerprints, and the tokens passed on with their number on each level."""
    schema = pa.schema([
        ("doc", pa.int64()), ("tid", pa.int64()), ("n", pa.int32()), ("f1", pa.int64()), ("f2", pa.int64()),
        ("counts", pa.list_(pa.int32())), ("tokens", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, ones, twos, counts, tokens = [], [], [], [], []
            for own in shingle_sets(batch.column(2)):
                sizes.append(len(own))
                spread = mix(own)
                ones.append(int(spread.sum(dtype=np.uint64).view(np.int64)))
                twos.append(int(mix(spread ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64)))
                upto = np.searchsorted(own, _EDGES, side="right")
                need = first_tokens(len(own))
                last = int(np.argmax(upto >= need)) if len(own) else 0
                kept = np.diff(upto[: last + 1], prepend=0)
                counts.append(kept.tolist())
                tokens.append(own[: upto[last]].view(np.int64))
            ends = np.concatenate(([0], np.cumsum([len(t) for t in tokens])))
            flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(ones, pa.int64()), pa.array(twos, pa.int64()),
                 pa.array(counts, pa.list_(pa.int32())), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
                schema=schema,
            )

    keyed = documents.select(doc_key().alias("doc"), F.xxhash64("text").alias("tid"), "text")
    return keyed.mapInArrow(run, "doc long, tid long, n int, f1 long, f2 long, counts array<int>, tokens array<long>")


def _first(n: int, counts: list[int], found: np.ndarray, often: np.ndarray) -> np.ndarray:
    """The shared ones among a set's first tokens. found: its shared tokens, often: documents that have them.

    counts: tokens passed on per level; a single count stands for a whole set in an order without levels.
    """
    room = first_tokens(n)
    whole = counts == [n]
    level = np.zeros(len(found), dtype=int) if whole else np.searchsorted(_EDGES, found.view(np.uint64), side="left")
    taken = []
    for at, count in enumerate(counts):
        own = np.flatnonzero(level == at)
        # tokens that no other document passes on come first
        room -= count - len(own)
        if room <= 0:
            break
        order = own[np.lexsort((found[own].view(np.uint64), often[own]))][:room]
        taken.append(order)
        room -= len(order)
        if room <= 0:
            break
    return found[np.concatenate(taken)] if taken else found[:0]


def _still_open(tokens: DataFrame, sets: DataFrame, seed: int = 0, by: str = "v") -> DataFrame:
    """v, doc, tid, n, counts, found, first, grp of sets that may have a partner.

    tokens: v, token and, for components, ``by``. A token is shared if more than one set (or component) passes it on.
    grp is a minimum hash of the shared tokens under ``seed``.
    """
    # written before the join on the same key, so that a hot token's rows can be split there
    often = tokens.select("token", by).distinct() if by != "v" else tokens
    often = store(often.groupBy("token").agg(F.count("*").alias("often")).where("often > 1"), "often")
    found = tokens.join(often.hint("merge"), "token").groupBy("v").agg(F.collect_list(F.struct("token", "often")).alias("shared"))
    joined = sets.join(found.hint("merge"), "v").select("v", "doc", "tid", "n", "counts", "shared")
    salt = mix(np.array([0x5851F42D4C957F2D + seed], dtype=np.uint64))[0]
    kinds = pa.schema([
        ("v", pa.int64()), ("doc", pa.int64()), ("tid", pa.int64()), ("n", pa.int32()), ("counts", pa.list_(pa.int32())),
        ("found", pa.list_(pa.int64())), ("first", pa.list_(pa.int64())), ("grp", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            counts = batch.column(4).to_pylist()
            for at in range(len(batch)):
                shared = batch.column(5)[at].values
                own, often = (shared.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                first = _first(batch.column(3)[at].as_py(), counts[at], own, often)
                if len(first):
                    group = int(mix(own.view(np.uint64) ^ salt).min().view(np.int64))
                    out.append((batch.column(0)[at].as_py(), batch.column(1)[at].as_py(), batch.column(2)[at].as_py(), batch.column(3)[at].as_py(), counts[at], own, first, group))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), kinds, strict=True)], schema=kinds)

    return joined.mapInArrow(run, "v long, doc long, tid long, n int, counts array<int>, found array<long>, first array<long>, grp long")


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = sorted((len(a), len(b)))
    if small * 100 < large * PERCENT:
        return False
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= PERCENT * (small + large - common)


class _Parts:
    """Union-find over a task's few hundred documents."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, v: int) -> int:
        while self.up.setdefault(v, v) != v:
            self.up[v] = self.up[self.up[v]]
            v = self.up[v]
        return v

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        self.up[max(a, b)] = min(a, b)


def _within(table: pa.Table) -> pa.Table:
    """Compare the members of a group unless they are connected already; adds each member's root."""
    numbers = table["v"].to_pylist()
    sets = [np.frombuffer(x, dtype=np.uint64) for x in table["tokens"].to_pylist()]
    parts = _Parts()
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), numbers[i]))
    for at, i in enumerate(order):
        for j in order[at + 1 :]:
            if len(sets[i]) * 100 < len(sets[j]) * PERCENT:
                break
            if parts.root(numbers[i]) != parts.root(numbers[j]) and _linked(sets[i], sets[j]):
                parts.join(numbers[i], numbers[j])
    return table.append_column("root", pa.array([parts.root(v) for v in numbers], pa.int64()))


def _across(table: pa.Table) -> pa.Table:
    """Compare the asking documents with a group's members of other components; one link per pair of components."""
    rows = table.select(["asks", "v", "label", "tokens"]).to_pylist()
    sets = {r["v"]: np.frombuffer(r["tokens"], dtype=np.uint64) for r in rows}
    parts, links = _Parts(), []
    members = [r for r in rows if not r["asks"]]
    for query in (r for r in rows if r["asks"]):
        for member in members:
            if parts.root(query["label"]) != parts.root(member["label"]) and _linked(sets[query["v"]], sets[member["v"]]):
                parts.join(query["label"], member["label"])
                links.append((query["label"], member["label"]))
    return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})


def _with_sets(texts: DataFrame) -> DataFrame:
    """v, n, own, gid, tokens: one row for each group of a document, with its whole set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, len(batch), 200):
                part = batch.slice(first, 200)
                blobs = [s.tobytes() for s in shingle_sets(part.column(1))]
                gids = part.column(2).to_pylist()
                rows = [(v, len(b) // 8, at == 0, gid, b) for v, b, own in zip(part.column(0).to_pylist(), blobs, gids, strict=True) for at, gid in enumerate(own)]
                types = (pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["v", "n", "own", "gid", "tokens"])

    return texts.select("v", "text", "gids").mapInArrow(run, "v long, n int, own boolean, gid long, tokens binary")


def _whole_sets(sets: DataFrame) -> DataFrame:
    """v, doc, tid, n, all: the set of each document as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            arrays = [np.frombuffer(b.as_py(), dtype=np.int64) for b in batch.column(4)]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), pa.array(arrays, pa.list_(pa.int64()))], names=["v", "doc", "tid", "n", "all"])

    return sets.select("v", "doc", "tid", "n", "tokens").mapInArrow(run, "v long, doc long, tid long, n int, all array<long>")


def _relabelled(labels: DataFrame, joined: DataFrame) -> DataFrame:
    """v, gid, label after components named ``a`` became part of ``b``."""
    return labels.join(joined, F.col("label") == F.col("a"), "left").select("v", "gid", F.coalesce("b", "label").alias("label"))


def _stars(labelled: DataFrame, own: DataFrame) -> DataFrame:
    """Links (a, b) of components whose documents are linked to the one of their group with the least tokens alone."""
    hubs = labelled.groupBy("grp").agg(F.min(F.struct("alone", "v", "label")).alias("hub"), F.min("label").alias("low"), F.max("label").alias("high"))
    hubs = store(hubs.where("low < high").select("grp", F.col("hub.v").alias("hub"), F.col("hub.label").alias("b")), "hubs")
    pairs = labelled.select("v", F.col("label").alias("a"), "grp").join(hubs, "grp").where("a <> b")
    hub_sets = own.select(F.col("v").alias("hub"), F.col("tokens").alias("hub_tokens"))
    pairs = pairs.join(own.select("v", "tokens"), "v").join(hub_sets.hint("merge"), "hub").select("a", "b", "tokens", "hub_tokens")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            one, two = ([np.frombuffer(x.as_py(), dtype=np.uint64) for x in batch.column(i)] for i in (2, 3))
            keep = pa.array([_linked(a, b) for a, b in zip(one, two, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])

    return pairs.mapInArrow(compare, "a long, b long").distinct()


def _may_link(uses: DataFrame) -> DataFrame:
    """Uses of tokens that more than one component has and whose sizes and places there allow a link."""
    kept = uses.groupBy("token").agg(F.min("n").alias("least"), F.max("room").alias("most"), F.min("label").alias("low"), F.max("label").alias("high"))
    # written before the join on the same key, so that a hot token's rows can be split there
    kept = store(kept.where("low < high").select("token", "least", "most"), "bounds")
    return uses.join(kept.hint("merge"), "token").where(f"room >= least * {PERCENT} and most >= n * {PERCENT}").drop("least", "most")


def _asks(labelled: DataFrame) -> DataFrame:
    """v, label, gid: the groups of larger components a document may have a link to, once for each token that says so.

    At the first token that two linked sets share, in the common order, each still has as many tokens left as they
    share at least, PERCENT / (100 + PERCENT) of the sum of their sizes. Tokens of one component alone come first and
    leave fewer, so that documents that share too little are done by the least and the greatest value of each token.
    """
    left = (F.col("shared") - F.col("at")) * (100 + PERCENT)
    uses = labelled.select("v", "n", "gid", "label", "weight", "shared", F.posexplode("first").alias("at", "token"))
    uses = uses.select("v", "n", "gid", "label", "weight", "token", (left - F.col("n") * PERCENT).alias("room"))
    # once more, now that only uses that may lead to a link are counted
    uses = store(_may_link(store(_may_link(uses), "uses")), "uses")
    matrix = uses.groupBy("token", "gid", "label", "weight").agg(F.min("n").alias("least"), F.max("room").alias("most"))
    matrix = matrix.select("token", F.col("gid").alias("to"), F.col("label").alias("to_label"), F.col("weight").alias("to_weight"), "least", "most")
    asks = uses.join(matrix, "token").where("gid <> to and label <> to_label and (weight, label) < (to_weight, to_label)")
    return asks.where(f"room >= least * {PERCENT} and most >= n * {PERCENT}").select("v", "label", F.col("to").alias("gid"))


def jaccard_components(documents: DataFrame) -> DataFrame:
    """doc_id, tid, n_shingles, component_id, component of every row.

    tid is a hash of the text; component numbers the components, also those without an id.
    """
    base = documents.select("doc_id", "text")
    summaries = store(_summaries(base).withColumn("v", F.monotonically_increasing_id()), "summaries")
    rows = summaries.select("v", "doc", "tid", "n", "f1", "f2")
    # equal sets are one class, named by the row of its smallest doc
    named = rows.where("n > 0").groupBy("n", "f1", "f2").agg(F.min(F.struct("doc", "tid", "v")).alias("named"))
    classes = store(named.select("n", "f1", "f2", "named.doc", "named.tid", "named.v"), "classes")

    tokens = summaries.select("v", F.explode("tokens").alias("token"))
    sets = classes.join(summaries.select("v", "counts"), "v").select("v", "doc", "tid", "n", "counts")
    opened = store(_still_open(tokens, sets), "open")
    # once more, now that only class names that may have a partner are counted
    left = store(_still_open(opened.select("v", F.explode("found").alias("token")), opened.select("v", "doc", "tid", "n", "counts")), "left")
    members = store(rows, "rows")
    discard(summaries)
    discard(opened)

    groups = left.groupBy("grp").agg(F.ceil(F.count("*") / GROUP_DOCS).cast("int").alias("parts"), F.min(F.struct("doc", "v")).alias("hub"))
    placed = left.join(groups, "grp").withColumn("part", F.pmod(F.xxhash64("v"), F.col("parts")).cast("int"))
    # a hub is a member of its own part and a guest of all others
    others = F.when(F.col("v") == F.col("hub.v"), F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: p != F.col("part"))).otherwise(F.array().cast("array<int>"))
    every = F.concat(F.array("part"), others)
    placed = placed.select("v", "doc", "tid", "n", "first", F.transform(every, lambda p: F.xxhash64("grp", p)).alias("gids"))
    placed = store(placed, "placed")
    grouped = _with_sets(one_row_each(base).join(placed.select("v", "doc", "tid", "gids"), ["doc", "tid"]))
    cells = store(grouped.groupBy("gid").applyInArrow(_within, "v long, n int, own boolean, gid long, tokens binary, root long"), "cells")

    near = components(cells.select("v", "root"))
    homes = placed.select("v", F.col("gids")[0].alias("gid"))
    labels = store(homes.join(near, F.col("v") == F.col("a"), "left").select("v", "gid", F.coalesce("b", "v").alias("label")), "labels")
    own = cells.where("own").select("v", "tokens", F.col("gid").alias("home"))
    base_sets = left.select("v", "doc", "tid", "n", "counts")
    used = left.select("v", F.explode("found").alias("token"))
    # documents that share much across components are few and pass on all tokens, for an order by rarity alone
    wide = _still_open(used.join(labels.select("v", "label"), "v"), base_sets, 0, "label").select("v", "doc", "tid", "n")
    wide = store(_whole_sets(wide.join(own.select("v", "tokens"), "v")), "wide")
    whole_sets = wide.select("v", "doc", "tid", "n", F.array("n").alias("counts"))
    used = wide.select("v", F.explode("all").alias("token"))
    for seed in range(1, STAR_ROUNDS + 1):
        labelled = _still_open(used.join(labels.select("v", "label"), "v"), whole_sets, seed, "label")
        alone = (1 - F.size("found") / F.col("n")).alias("alone")
        labelled = store(labelled.select("v", alone, "grp").join(labels, "v"), "labelled")
        labels = store(_relabelled(labels, components(_stars(labelled, own))), "labels")
    labelled = _still_open(used.join(labels.select("v", "label"), "v"), whole_sets, 0, "label")
    labelled = labelled.select("v", "n", F.size("found").alias("shared"), "first").join(labels, "v")
    labelled = store(labelled, "labelled")
    sizes = labelled.groupBy("label").agg(F.count("*").alias("weight"))
    labelled = store(labelled.join(sizes, "label"), "weighed")
    asks = _asks(labelled).distinct()
    asks = store(asks, "asks")
    asking = asks.join(own.drop("home"), "v").withColumn("turn", F.xxhash64("v"))
    load = asks.groupBy("gid").agg(F.ceil(F.count("*") / ASKING_DOCS).cast("int").alias("turns"))
    asking = asking.join(load, "gid").select("gid", F.pmod("turn", "turns").cast("int").alias("turn"), F.lit(True).alias("asks"), "v", "label", "tokens")
    asked = own.withColumnRenamed("home", "gid").join(labels.select("v", "label"), "v").join(load, "gid")
    asked = asked.select("gid", F.explode(F.sequence(F.lit(0), F.col("turns") - 1)).alias("turn"), F.lit(False).alias("asks"), "v", "label", "tokens")
    links = asking.unionByName(asked).groupBy("gid", "turn").applyInArrow(_across, "a long, b long")
    label = _relabelled(labels, components(links)).select("v", F.col("label").alias("component"))
    ends = classes.join(label, "v", "left").select("n", "f1", "f2", "doc", F.coalesce("component", "v").alias("component"))
    smallest = ends.groupBy("component").agg(F.min("doc").alias("first_doc"))
    ends = ends.join(smallest, "component").select("n", "f1", "f2", "first_doc", "component")
    result = members.join(ends, ["n", "f1", "f2"], "left")
    known = lambda c: F.when(c < LAST_ID, c)
    return result.select(known(F.col("doc")).alias("doc_id"), "tid", F.col("n").cast("long").alias("n_shingles"), known(F.coalesce("first_doc", "doc")).alias("component_id"), F.coalesce("component", "v").alias("component"))
