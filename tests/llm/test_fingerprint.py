from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import xxhash
from cases import SCHEMA, frame, rows
from pyspark.sql import functions as F

from adtide.llm import fingerprint as fp


def subsequence(a: str, b: str) -> int:
    best = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for at, y in enumerate(b):
            row.append(best[at] + 1 if x == y else max(best[at + 1], row[at]))
        best = row
    return best[-1]


def test_likeness_is_the_edit_distance_of_common_block_sizes(spark):
    texts = [(r[1] or "") for r in rows(count=40)]
    prints = [fp.fingerprint(t.encode()) for t in texts]
    pairs = [(a, b) for a in prints[:25] for b in prints[10:40]]
    got = fp.likeness([a for a, _ in pairs], [b for _, b in pairs])
    for (a, b), value in zip(pairs, got, strict=True):
        if a == b:
            assert value == 1
            continue
        size_a, *own_a = a.split(":")
        size_b, *own_b = b.split(":")
        best = 0.0
        for i, x in enumerate(own_a):
            for j, y in enumerate(own_b):
                if int(size_a) << i == int(size_b) << j and x and y:
                    runs = {x[k : k + 4] for k in range(len(x) - 3)} & {y[k : k + 4] for k in range(len(y) - 3)}
                    if runs or min(len(x), len(y)) < 4:
                        best = max(best, 2 * subsequence(x, y) / (len(x) + len(y)))
        assert value == pytest.approx(best)


def test_trial_equals_brute_force(spark):
    data = [r for r in rows(count=50) if r[0] is not None]
    got = fp.edit_trial(frame(spark, data)).collect()
    ordered = sorted(((d, t or "") for d, t, *_ in data), key=lambda r: (r[0], r[1].encode()))
    expected = []
    for at, (doc, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        cut = len(text) // 2
        changed = text[: len(text) - cut] + following[:cut]
        prints = [fp.fingerprint(x.encode()) for x in (text, changed, following)]
        near = fp.likeness([prints[0]] * 2, prints[1:])
        expected.append((doc, len(text), hashlib.sha256(changed.encode()).hexdigest(), prints[0], prints[1], *near.tolist()))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)
    long = [r for r in got if r.n_chars > 300]
    assert sum(r.near_edited > 0.3 for r in long) >= 0.95 * len(long)


def test_null_and_repeated_ids_follow_by_a_hash_of_the_text(spark):
    data = [*rows(count=30), *((None, f"text {i % 9} " * 20, None, None, 1) for i in range(40)), (3, "other", "aa", "s", 1)]
    got = fp.edit_trial(frame(spark, data)).collect()
    turn = lambda t: (xxhash.xxh64_intdigest(t.encode(), 42) + 2**63) % 2**64
    ordered = sorted(((d, t or "") for d, t, *_ in data), key=lambda r: (r[0] is not None, r[0] or 0, turn(r[1])))
    expected = []
    for at, (doc, text) in enumerate(ordered):
        expected.append((doc, hashlib.sha256(fp.edited(text, ordered[(at + 1) % len(ordered)][1]).encode()).hexdigest()))
    assert Counter((r.doc_id, r.edited_sha256) for r in got) == Counter(expected)


@pytest.mark.parametrize("doc", [None, 5])
def test_a_hot_id_is_spread_over_ranges(spark, doc):
    hot = [(doc, "the same text", None, None, 1)] * 3000 + [(doc, f"text {i}", None, None, 1) for i in range(1000)]
    data = hot + [(1000 + i, f"plain {i}", "aa", "s", 1) for i in range(2000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in fp.in_order(frame(spark, data)).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 6000 and len(sizes) >= 4 and max(sizes) <= 3 * 6000 / len(sizes)


def test_few_rows(spark):
    assert fp.edit_trial(spark.createDataFrame([], SCHEMA)).count() == 0
    (one,) = fp.edit_trial(spark.createDataFrame([(3, "abcdef", "a", "s", 1)], SCHEMA)).collect()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and one.near_next == 1
