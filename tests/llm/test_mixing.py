from __future__ import annotations

import random

from cases import SCHEMA, frame, rows
from pyspark.sql import functions as F

from adtide.llm import mixing


def water(sizes: dict, most: int = 3) -> dict:
    names = sorted((n for n in sizes if n is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {n: (1, 2, 3)[i % 3] for i, n in enumerate(names)}
    target, free, left = {}, set(names), float(sum(sizes.values()))
    while free:
        share = {n: left * weight[n] / sum(weight[f] for f in free) for n in free}
        over = {n for n in free if share[n] > most * sizes[n]}
        if not over:
            target |= share
            break
        for n in over:
            target[n] = most * sizes[n]
            left -= target[n]
        free -= over
    return target


def test_targets_and_words_taken(spark):
    rng = random.Random(5)
    data = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.randint(0, 90))), "aa", rng.choice(["a"] * 6 + ["b", "É", "z", None]), 1) for i in range(900)]
    data += rows()
    got = mixing.mix_sources(frame(spark, data), group_rows=40).collect()
    sizes: dict = {}
    for row in data:
        sizes[row[3]] = sizes.get(row[3], 0) + len((row[1] or "").encode().split())
    targets = water(sizes)
    assert len(got) == len(data)
    taken: dict = {}
    largest: dict = {}
    for r in got:
        assert 0 <= r.copies <= 3 and r.source_size == sizes[r.source]
        assert abs(r.target - targets[r.source]) < 1e-6 * max(1, r.target)
        taken[r.source] = taken.get(r.source, 0) + r.copies * r.size
        largest[r.source] = max(largest.get(r.source, 0), r.size)
    for source, words in taken.items():
        assert abs(words - targets[source]) <= largest[source]
    again = mixing.mix_sources(frame(spark, data, 5), group_rows=40).collect()
    key = lambda rs: sorted((str(r.doc_id), r.size, r.copies) for r in rs)
    assert key(got) == key(again)


def test_a_hot_id_is_dealt_into_groups_like_others(spark):
    data = [(None, "one two three", "aa", "a", 1)] * 3000 + [(i, "w " * (1 + i % 7), "aa", "a", 1) for i in range(3000)]
    rows = frame(spark, data).select(F.lit(0).alias("source_rank"), "doc_id", F.xxhash64("text").alias("tid"), F.when(F.col("doc_id").isNull(), 3).otherwise(F.col("doc_id") % 7 + 1).alias("size"))
    turned = mixing.with_turns(rows.withColumn("row", F.monotonically_increasing_id()))
    groups = turned.groupBy(F.pmod(F.xxhash64("turn", F.lit(0)), F.lit(60)).alias("grp")).count()
    assert turned.select("turn").distinct().count() == 6000
    assert groups.agg(F.max("count")).first()[0] < 2 * 100
    got = mixing.mix_sources(frame(spark, data), group_rows=100).collect()
    assert len(got) == 6000 and {r.copies for r in got} == {1}


def test_large_documents_are_made_up_for_by_small_ones(spark):
    rng = random.Random(8)
    data = []
    for at, source in enumerate("abcdef"):
        lengths = [20000, 9000, 3000] + [rng.randint(20, 200) for _ in range(600)]
        data += [(1000 * at + i, "w " * n, "aa", source, 1) for i, n in enumerate(lengths)]
    got = mixing.mix_sources(frame(spark, data), group_rows=100).collect()
    assert len(got) == len(data)
    for source in "abcdef":
        own = [r for r in got if r.source == source]
        assert abs(sum(r.copies * r.size for r in own) - own[0].target) <= 200


def test_one_large_document_alone(spark):
    data = [(1, "w " * 100, "aa", "a", 1), (2, "w " * 100, "aa", "b", 1), (2, "w " * 100, "aa", "b", 1), (3, "", "aa", "b", 1)]
    got = sorted((r.doc_id, r.size, r.copies) for r in mixing.mix_sources(frame(spark, data)).collect())
    # targets of 100 and 200 words
    assert [r for r in got if r[1]] == [(1, 100, 1), (2, 100, 1), (2, 100, 1)]


def test_no_rows(spark):
    assert mixing.mix_sources(spark.createDataFrame([], SCHEMA)).count() == 0
