"""Mixing sources to target weights by pivotal dependent rounding.

A source's documents share one fractional number of copies, target over size. Its whole part is taken as it
is. The fractional parts are rounded in pairs: two documents exchange words at random, one gaining what
the other loses, until one of them has a whole number of copies; the other meets the next document. Each
expected number of copies stays as it was and the words of a pair stay the same, so that a source ends
within one document of its target. Groups of documents are rounded in parallel, and the one document
that each leaves undecided goes on to the next level of a tree of ever fewer groups per source. Documents
with a hundredth of their source or more are rounded first, and what they miss of their part of the target
is spread over the others, so that the document left undecided at the end is a small one where there is any.

Defined results: a null text has no words; a document without words is rounded on its own; a null source
is a source of its own, the last; a source without words has target 0; repeated rows are documents of
their own; an empty table gives no rows; other columns are ignored. Random numbers come from a seed and
the group alone.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtide.llm.common import identity, store
from adtide.operators.ranking import positions

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
#: No source is repeated more often than this.
MOST_COPIES = 3
#: Documents that one task rounds together.
GROUP_ROWS = 5000
#: Documents of at least this part of their source are large; a source has no more of them than this.
LARGE_PART = 100
SEED = 17


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """source, source_rank, source_size, n, target: shares by weight, none above ``most`` times its size.

    sizes: a row per document with ``source`` and ``size``. What a source may not take is shared by weight
    among the others, again until all hold; each round is one sum over the sources.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    ordered = totals.orderBy(F.col("source").asc_nulls_last())
    ranked = ordered.rdd.zipWithIndex().map(lambda pair: (pair[0][0], pair[0][1], pair[0][2], pair[1]))
    sources = store(spark.createDataFrame(ranked, "source string, source_size long, n long, source_rank long"), "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("source_rank") % len(weights) + 1).cast("int"))
    first = sources.agg(F.sum("source_size"), F.sum(weight)).first()
    total, level = first[0] or 0, (first[0] or 0) / (first[1] or 1)
    while True:
        capped = weight * F.lit(float(level)) > F.col("source_size") * most
        held, free = sources.agg(F.sum(F.when(capped, F.col("source_size") * most)), F.sum(F.when(~capped, weight))).first()
        if not free or not held:
            break
        raised = (total - held) / free
        if raised <= level:
            break
        level = raised
    target = F.least(weight * F.lit(float(level)), (F.col("source_size") * most).cast("double"))
    return sources.withColumn("target", target)


def _round_group(rows: pd.DataFrame, level: int) -> pd.DataFrame:
    """Decide all rows of a group but one; a decided row has share 0 or 1."""
    rows = rows.sort_values(["size", "turn", "row"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    shares, sizes = rows["share"].to_numpy(dtype=float).copy(), rows["size"].to_numpy(dtype=float)
    if len(rows):
        seed = [SEED, level, int(rows["source_rank"].iloc[0]), int(rows["grp"].iloc[0])]
        chances = np.random.default_rng(seed).random(len(rows))
    open_row = -1
    for at in range(len(rows)):
        if not 0 < shares[at] < 1:
            continue
        if open_row < 0:
            open_row = at
            continue
        i, j = open_row, at
        gain = min((1 - shares[i]) * sizes[i], shares[j] * sizes[j])
        loss = min(shares[i] * sizes[i], (1 - shares[j]) * sizes[j])
        move = gain if chances[at] * (gain + loss) < loss else -loss
        shares[i] += move / sizes[i]
        shares[j] -= move / sizes[j]
        for k in (i, j):
            if shares[k] < 1e-9:
                shares[k] = 0.0
            elif shares[k] > 1 - 1e-9:
                shares[k] = 1.0
        open_row = i if 0 < shares[i] < 1 else j if 0 < shares[j] < 1 else -1
    rows["share"] = shares
    return rows


def _rounder(level: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        return _round_group(rows, level)

    return run


def round_shares(rows: DataFrame, group_rows: int = GROUP_ROWS) -> DataFrame:
    """row, taken (0 or 1) for rows of source_rank, n (rows of the source), row, turn, size > 0, share."""
    schema = "source_rank long, n long, row long, turn long, size long, share double, grp long"
    columns = [c.split()[0] for c in schema.split(", ")]
    done = []
    level, groups = 0, F.ceil(F.col("n") / group_rows)
    while True:
        grouped = rows.withColumn("grp", F.pmod(F.xxhash64("turn", F.lit(level)), F.greatest(groups, F.lit(1))).cast("long"))
        decided = grouped.select(*columns).groupBy("source_rank", "grp").applyInPandas(_rounder(level), schema)
        stored = store(decided, f"rounded-{level}")
        done.append(stored.where("share = 0 or share = 1").select("row", F.col("share").cast("int").alias("taken")))
        rows = stored.where("share > 0 and share < 1").select(*columns[:-1])
        most = stored.agg(F.max(groups)).first()[0]
        if not most or most <= 1:
            break
        level, groups = level + 1, F.ceil(groups / group_rows)
    # one document of each source at most is left: it goes to the side nearer to the target
    done.append(rows.select("row", (F.col("share") >= 0.5).cast("int").alias("taken")))
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def with_turns(rows: DataFrame) -> DataFrame:
    """Rows of a source with ``turn``, by which they are dealt into groups; equal ones get different turns.

    rows: source_rank, doc_id, tid, size, row. Rows of one source, id and size are numbered, in ranges,
    so that however many there are they fall into groups as others do. Which of equal rows gets which
    number makes no difference.
    """
    plain = rows.withColumn("turn", F.xxhash64("doc_id", "size"))
    keyed = plain.select("row", "tid", F.xxhash64("source_rank", "turn").alias("key"))
    repeated = keyed.groupBy("key").agg(F.count("*").alias("rows")).where("rows > 1")
    if repeated.isEmpty():
        return plain
    equal = keyed.join(store(repeated.select("key"), "repeated"), "key", "left_semi")
    numbers = positions(equal, "key", [F.asc("tid"), F.asc("row")], "number").where("number > 1").select("row", "number")
    numbered = plain.join(numbers, "row", "left")
    return numbered.withColumn("turn", F.when(F.col("number").isNull(), F.col("turn")).otherwise(F.xxhash64("turn", "number"))).drop("number")


def _decide_large(rows: pd.DataFrame) -> pd.DataFrame:
    """Whole copies of a source's large documents; the last undecided one goes to the nearer side."""
    decided = _round_group(rows.assign(grp=0), 0)
    return pd.DataFrame({"source_rank": decided["source_rank"], "row": decided["row"], "words": decided["size"], "large_copies": (decided["whole"] + (decided["share"] >= 0.5)).astype(int)})


def _with_copies(rows: DataFrame, rate: Column) -> DataFrame:
    """Whole copies and the fraction left of a rate."""
    rows = rows.withColumn("whole", F.floor(rate + 1e-9)).withColumn("share", F.greatest(rate - F.col("whole"), F.lit(0.0)))
    return rows.withColumn("share", F.when(F.col("share") < 1e-9, 0.0).otherwise(F.col("share")))


def large_copies(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """source_rank, row, words, large_copies of the documents with a large part of their source, at most LARGE_PART each."""
    joined = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    large = joined.where(F.col("size") > 0).where(F.col("size") * LARGE_PART >= F.col("source_size"))
    large = _with_copies(large, F.col("target") / F.col("source_size"))
    large = large.select("source_rank", "row", F.xxhash64("doc_id", "size", "tid").alias("turn"), "size", "whole", "share")
    return large.groupBy("source_rank").applyInPandas(_decide_large, "source_rank long, row long, words long, large_copies int")


def mix_sources(documents: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES, group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, tid, source, size, source_size, target, copies of every document; tid is a hash of the text."""
    source = F.col("source").cast("string").alias("source")
    sizes = identity(documents, "source").select(F.col("doc_id").cast("long"), source, word_count("text").alias("size"), F.xxhash64("text").alias("tid"))
    sizes = store(sizes.withColumn("row", F.monotonically_increasing_id()), "sizes")
    targets = source_targets(sizes, weights, most)
    large = store(large_copies(sizes, targets), "large")
    sums = large.groupBy("source_rank").agg(F.sum("words").alias("words"), F.sum(F.col("words") * F.col("large_copies")).alias("taken_words"))
    held, gone = F.coalesce("words", F.lit(0)), F.coalesce("taken_words", F.lit(0))
    left = F.col("source_size") - held
    rate = F.when(left > 0, F.greatest(F.lit(0.0), F.least((F.col("target") - gone) / left, F.lit(float(most))))).otherwise(F.lit(0.0))
    # what large documents leave of a source's target, for the others
    targets = store(targets.join(sums, "source_rank", "left").withColumn("rate", rate).drop("words", "taken_words"), "targets")
    joined = sizes.join(targets, sizes["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    joined = _with_copies(joined, F.col("rate")).join(large.select("row", "large_copies"), "row", "left")
    joined = with_turns(joined)
    parts = joined.where("size > 0 and large_copies is null").select("source_rank", "n", "row", "turn", "size", "share")
    taken = round_shares(parts, group_rows)
    alone = (F.pmod(F.xxhash64("turn", F.lit(SEED + 1)), F.lit(1 << 52)) + 0.5) / float(1 << 52)
    extra = F.coalesce(F.col("taken"), (alone < F.col("share")).cast("int"))
    return joined.join(taken, "row", "left").select("doc_id", "tid", "source", "size", "source_size", "target", F.coalesce("large_copies", F.col("whole") + extra).cast("int").alias("copies"))
