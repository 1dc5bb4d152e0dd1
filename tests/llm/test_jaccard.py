from __future__ import annotations

import random

from cases import SCHEMA, frame, rows, sentence

from adtide.llm import graph, jaccard


def sets(data):
    out = []
    for row in data:
        words = (row[1] or "").encode().lower().split()
        out.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set())
    return out


def brute(data):
    own = sets(data)
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(data)):
        for j in range(i):
            if own[i] and own[j] and 100 * len(own[i] & own[j]) >= 80 * len(own[i] | own[j]):
                root[find(i)] = find(j)
    last = float("inf")
    low = {}
    for i, row in enumerate(data):
        low[find(i)] = min(low.get(find(i), last), last if row[0] is None else row[0])
    return sorted(((r[0], len(own[i]), None if low[find(i)] == last else low[find(i)]) for i, r in enumerate(data)), key=str)


def families(seed):
    """Chains of ever more edited copies, so that similarities lie on both sides of the bound."""
    rng = random.Random(seed)
    made, doc = rows(seed, 40), 1000
    passage = sentence(rng, 60)
    for _ in range(12):
        words = sentence(rng, rng.randint(3, 200)).split()
        if rng.random() < 0.5:
            words = words + passage.split()
        for _ in range(rng.randint(1, 14)):
            made.append((doc, " ".join(words), "aa", "s1", 1))
            doc += 1
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                words[rng.randrange(len(words))] = sentence(rng, 1)
    rng.shuffle(made)
    return made


def test_equals_brute_force(spark, monkeypatch):
    for seed, size in ((1, 64), (2, 3), (5, 2)):
        monkeypatch.setattr(jaccard, "GROUP_DOCS", size)
        data = families(seed)
        got = jaccard.jaccard_components(frame(spark, data, 4)).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(data)


def copies(count, edits, seed=7):
    """Near copies of one page, each with one of the given numbers of words replaced."""
    rng = random.Random(seed)
    page = sentence(rng, 150).split()
    made = []
    for doc in range(count):
        words = list(page)
        for at in rng.sample(range(0, 150, 6), rng.choice(edits)):
            words[at] = sentence(rng, 2).replace(" ", "")
        made.append((doc, " ".join(words), "aa", "s1", 1))
    return made


def test_copies_that_share_too_little_open_no_group(spark, monkeypatch):
    asked, plain = [], jaccard.store

    def watched(df, purpose):
        out = plain(df, purpose)
        if purpose == "asks":
            asked.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "store", watched)
    monkeypatch.setattr(jaccard, "GROUP_DOCS", 8)
    # five replaced words leave at most 125 of 146 shingles of the page; two linked sets of 146 share 130
    data = copies(120, [5])
    got = jaccard.jaccard_components(frame(spark, data, 4)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(data)
    assert asked == [0]


def test_copies_on_both_sides_of_the_bound(spark, monkeypatch):
    for rounds in (0, 2):
        monkeypatch.setattr(jaccard, "GROUP_DOCS", 4)
        monkeypatch.setattr(jaccard, "STAR_ROUNDS", rounds)
        data = copies(110, [0, 1, 1, 2, 3, 3, 4, 5])
        data += [(1000 + r[0], " ".join(r[1].split()[: 150 - r[0] % 31]), *r[2:]) for r in copies(70, [1, 2, 3], 7)]
        got = jaccard.jaccard_components(frame(spark, data, 4)).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(data)


def test_no_rows(spark):
    assert jaccard.jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def test_components_of_chains_and_stars(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 150)] + [(200, 200)]
    links = [(b, a) if rng.random() < 0.5 else (a, b) for a, b in links] + links[:5]
    got = {r.a: r.b for r in graph.components(spark.createDataFrame(links, "x long, y long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 150)}}
