from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest
from cases import SCHEMA, frame, rows

from adtide.llm import phrases, queries

SMALL = {c: c + 32 for c in range(0x41, 0x5B)}


def brute_force(data, threshold, first=2000, longest=5):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in data:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(SMALL)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                for at in range(len(words) - size + 1):
                    f[lang or "und", tuple(words[at : at + size])] += 1
    candidates = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= threshold}
    inside = defaultdict(int)
    for (lang, p), a in candidates.items():
        for size in range(2, len(p)):
            for at in range(len(p) - size + 1):
                inside[lang, p[at : at + size]] = max(a, inside[lang, p[at : at + size]])
    by_lang = defaultdict(list)
    for (lang, p), a in candidates.items():
        if inside[lang, p] < a:
            cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
            value, k = min(cuts)
            by_lang[lang].append((-value, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n[lang], -value)
        for lang, found in by_lang.items()
        for rank, (value, a, phrase, left, right) in enumerate(sorted(found)[:first], 1)
    )


def sample():
    rng = random.Random(11)
    words = ["the", "The", "of", "a", "\u00c9t\u00e9", "\u00e9t\u00e9", "x\x00y", "z\u00a0z", "o'", "-"]
    data = [(i, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", "\n", ",", "!?"]) for _ in range(rng.randint(0, 40))), rng.choice(["aa", "aa", "bb", "und", None]), "s", 1) for i in range(150)]
    # one word over and over, a group of copies, a phrase that crosses no border
    return data + [(500, "ha " * 60, "bb", "s", 1), (501, "Ha ha\x0bha ha", "bb", "s", 1)] + [(600, "one two three four five six; seven", "aa", "s", 1)] * 25


@pytest.mark.parametrize(("shards", "places"), [(1, 1 << 16), (3, 1 << 16), (4, 64), (2, 4)])
def test_counts_equal_brute_force_however_many_phrases_share_a_place(spark, monkeypatch, shards, places):
    data = sample()
    monkeypatch.setattr(phrases, "PLACES", (places, places))
    got = phrases.collocations(frame(spark, data, 4), threshold=12, shards=shards)
    assert sorted(map(tuple, got.collect())) == brute_force(data, 12)


def test_first_phrases_only_and_small_batches(spark, monkeypatch):
    data = sample() + rows(count=40)
    monkeypatch.setattr(phrases, "BATCH_WORDS", 100)
    monkeypatch.setattr(phrases, "SLICE", 30)
    monkeypatch.setattr(phrases, "MEMORY_WORDS", 4)
    got = phrases.collocations(frame(spark, data), threshold=4, first=9, longest=4)
    assert sorted(map(tuple, got.collect())) == brute_force(data, 4, 9, 4)


def test_query_keeps_its_contract(spark, tmp_path):
    data = [(i, f"new york city, {i} ways. New York", None, "s", 1) for i in range(120)] + sample()
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op11_phrases(spark, str(tmp_path))
    assert got.dtypes == [("lang", "string"), ("rank", "bigint"), ("phrase", "string"), *((c, "bigint") for c in ("a", "l", "r", "n", "score"))]
    found = sorted(map(tuple, got.collect()))
    assert found == brute_force(data, 100) and any(row[2] == "new york city" for row in found)


def test_products_beyond_64_bits_are_exact(spark):
    rng = random.Random(3)
    numbers = [tuple(sorted(rng.randrange(1, 10**13) for _ in range(4))) for _ in range(200)] + [(7, 7 * 10**6, 10**12, 3 * 10**13), (10**12 - 1, 10**12, 10**12, 10**13)]
    table = spark.createDataFrame(numbers, "a long, l long, r long, n long")
    for row in table.select("*", phrases.score()).collect():
        assert row.score == 1000 * row.a * row.n // (row.l * row.r)


def test_phrases_join_while_a_cycle_is_under_way(spark):
    seen = []
    data = [(i, "hot pair of words", "aa", "s", 1) for i in range(90)] + [(100 + i, "rare pair", "aa", "s", 1) for i in range(30)]
    encoded = phrases.encode(spark.createDataFrame(data, SCHEMA).coalesce(1), 3)
    step = phrases.count_step

    def spy(shard, reached, at, shards, longest):
        counted = step(shard, reached, at, shards, longest)
        seen.append({r.kind >> 8 for r in counted.select("kind").distinct().collect()})
        return counted

    phrases.count_step, kept = spy, step
    try:
        complete = phrases.frequent_phrases(encoded, 20, 5, 3)
    finally:
        phrases.count_step = kept
    # shards of 30 documents: each step that counts words in a shard counts one length more
    assert seen[:4] == [{1}, {1, 2}, {1, 2, 3}, {2, 3, 4}]
    assert sorted(r["count"] for r in complete.collect()) == sorted([90, 120, 90, 90, 30] + [90, 90, 90, 30] + [90, 90] + [90])


def test_no_rows(spark):
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).count() == 0
    assert phrases.collocations(spark.createDataFrame([(1, None, None, None, None)], SCHEMA)).count() == 0
