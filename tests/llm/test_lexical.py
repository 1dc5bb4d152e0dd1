from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import SCHEMA, frame, rows, sentence

from adtide.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = {c: c + 32 for c in range(0x41, 0x5B)}


def brute_force(documents, items, k=20):
    counted = [(doc, Counter(TERM.findall((text or "").translate(SMALL)))) for doc, text in documents]
    counted = [(doc, c) for doc, c in counted if c]
    whole, df = sum(c.total() for _, c in counted), Counter(t for _, c in counted for t in c)
    found = []
    for item, text in set(items):
        scored = []
        for doc, c in counted:
            margin = 100 - 25 + (25 * c.total() * len(counted)) // whole
            score = 0
            for term in TERM.findall((text or "").translate(SMALL)):
                if term in c:
                    weight = math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[term] + 1)))
                    score += weight * ((1000000000 * c[term]) // (1000 * c[term] + 12 * margin))
            if score > 0:
                scored.append((-score, doc is None, doc))
        best = sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k]
        found += [(item, rank, doc, -score) for rank, (score, _, doc) in enumerate(best, 1)]
    return sorted(found, key=str)


def asked(data, count=12):
    rng = random.Random(4)
    texts = [t for _, t, *_ in data if t and len(t.split()) > 20]
    items = [(i, " ".join(rng.choice(texts).split()[3:40])) for i in range(count)]
    return items + [(90, "Été, DE of-de 日本語 WÖRTER wörter"), (91, None), (92, "... !"), (93, "unheard of"), (None, texts[0]), items[0], (1, texts[1])]


def result(spark, data, items, **sizes):
    table = spark.createDataFrame(items, "item_id long, text string")
    return sorted(map(tuple, lexical.search(frame(spark, data), table, **sizes).collect()), key=str)


@pytest.fixture(scope="module")
def data():
    return rows(count=120) + [(700, "de", "aa", "s1", 1), (701, "DE!", "aa", "s1", 1), (702, "de\x00de_De", "aa", "s1", 1)]


def test_query_equals_brute_force(spark, data, tmp_path):
    items = asked(data)
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op13_search(spark, str(tmp_path))
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect()), key=str) == brute_force([(d, t) for d, t, *_ in data], items)


def test_shards_steps_slices_and_blocks_do_not_change_the_result(spark, data, monkeypatch):
    items = asked(data)
    monkeypatch.setattr(lexical, "SHARD_DOCUMENTS", 7)
    monkeypatch.setattr(lexical, "FIRST_STEP", 1)
    monkeypatch.setattr(lexical, "SLICE", 40)
    expected = brute_force([(d, t) for d, t, *_ in data], items, 3)
    assert result(spark, data, items, k=3, block_bytes=700) == expected


def shard_of(data, words):
    numbers = {w: i for i, w in enumerate(words)}
    counts = [Counter(numbers[w] for w in text if w in numbers) for text in data]
    sizes = np.array([len(t) for t in data])
    terms, tfs = (np.array([x for c in counts for x in part(c)], dtype=np.int64) for part in (Counter.keys, Counter.values))
    return lexical.Shard(np.arange(len(data)), sizes, np.array([len(c) for c in counts]), terms, tfs, len(data), int(sizes.sum()), len(words))


def test_reading_stops_strictly_below_the_kth_score(monkeypatch):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(30)]
    data = [[rng.choice(words) for _ in range(rng.randint(5, 60))] for _ in range(6000)]
    data[4321] = words[:4] * 5
    shard = shard_of(data, words)
    looked_up = []
    entries = shard.entries
    monkeypatch.setattr(shard, "entries", lambda docs: looked_up.append(len(docs)) or entries(docs))
    terms, factors = np.arange(4), np.array([900, 800, 700, 600])
    scores, ids = shard.best(terms, factors, 5, 0)
    every = np.zeros(len(data), dtype=np.int64)
    for term, factor in zip(terms, factors, strict=True):
        own = slice(shard.starts[term], shard.starts[term + 1])
        np.add.at(every, shard.docs[own], factor * shard.scores[own])
    order = np.lexsort((np.arange(len(data)), -every))[:5]
    assert ids.tolist() == order.tolist() and scores.tolist() == every[order].tolist() and ids[0] == 4321
    assert sum(looked_up) < 0.5 * (every > 0).sum()
    # with a floor nothing at or above it is lost
    high, _ = shard.best(terms, factors, 5, int(scores[2]))
    assert [s for s in high.tolist() if s >= scores[2]] == [s for s in scores.tolist() if s >= scores[2]]


def test_ties_go_to_the_smaller_id_however_far_they_reach(spark):
    same = [(doc, "alpha beta", "aa", "s1", 1) for doc in range(300, 0, -1)] + [(None, "alpha beta", "aa", "s1", 1)]
    other = [(1000 + i, sentence(random.Random(i), 20), "aa", "s1", 1) for i in range(400)]
    got = result(spark, same + other, [(1, "beta alpha alpha")])
    assert [row[2] for row in sorted(got, key=lambda r: r[1])] == list(range(1, 21)) and len({row[3] for row in got}) == 1


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(none, items).count() == 0
    assert lexical.search(spark.createDataFrame([(1, "a b", "aa", "s", 1)], SCHEMA), items.limit(0)).count() == 0
    assert lexical.search(spark.createDataFrame([(1, None, "aa", "s", 1), (2, "!", "aa", "s", 1)], SCHEMA), items).count() == 0
