from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from cases import SCHEMA, frame, rows, sentence
from pyspark.sql import functions as F

from adtide.llm import language, quality, toxicity
from adtide.llm.common import held_out, mix


def is_held(doc) -> bool:
    return doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2


def spoken(seed=1, count=500):
    rng = random.Random(seed)
    words = {"aa": ["the", "and", "thing", "over", "with"], "bb": ["der", "und", "nicht", "über", "mit"], "cc": ["les", "été", "pour", "avec", "où"]}
    made = []
    for doc in range(count):
        lang = rng.choice(list(words))
        made.append((doc, " ".join(rng.choice(words[lang]) for _ in range(rng.randint(4, 60))), lang if doc % 9 else None, "s", 1))
    return made


def test_language_on_held_out_documents(spark):
    data = spoken() + [(9000, None, "aa", "s", 1), (9001, " 123 .. ", "bb", "s", 1), (9001, " 123 .. ", "bb", "s", 1), (None, "the and thing", "aa", "s", 1)]
    documents = frame(spark, data)
    model = language.fit(documents)
    assert model.languages == ["aa", "bb", "cc"]
    got = language.predict(documents, model).withColumn("held", held_out()).collect()
    assert len(got) == len(data)
    truth = {r[0]: r[2] for r in data}
    held = [r for r in got if r.held and truth[r.doc_id]]
    assert all(is_held(r.doc_id) for r in held) and len(held) > 60
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    assert {(r.lang_pred, r.score) for r in got if r.doc_id in (9000, 9001)} == {("und", 0.0)}
    assert all(0 <= r.score <= 1 for r in got)


def test_language_counts_equal_brute_force(spark):
    documents = spark.createDataFrame([(0, "Abc", "aa", "s", 1), (1, "é", "aa", "s", 1)], SCHEMA)
    counted = {r.feature: r.n for r in language._counts(documents).collect()}
    assert sum(counted.values()) == (3 + 2 + 1) + (2 + 1)


def grams(text: str) -> list[int]:
    """Buckets of the n-grams of a text, one by one."""
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
    found = []
    for n in language.GRAMS:
        for at in range(len(data) - n + 1):
            value = int.from_bytes(data[at : at + n], "big") ^ (n << 40)
            found.append(int(mix(np.array([value], dtype=np.uint64))[0]) % language.FEATURES)
    return found


def test_language_predictions_equal_brute_force(spark):
    data = spoken(seed=4, count=90) + [(9000, "the nicht OÙ und", None, "s", 1), (9001, "Über les", None, "s", 1), (9002, "a", None, "s", 1)]
    documents = frame(spark, data)
    got = {r.doc_id: r for r in language.predict(documents, language.fit(documents)).collect()}
    counts: dict[str, Counter] = {}
    for doc, text, lang, *_ in data:
        if lang and not is_held(doc):
            counts.setdefault(lang, Counter()).update(grams(text))
    names = sorted(counts)
    total = {n: sum(counts[n].values()) + 0.1 * language.FEATURES for n in names}
    chance = {n: (lambda f, n=n: (counts[n][f] + 0.1) / total[n]) for n in names}
    codes = language.codewords(len(names))
    bits = []
    for code in codes.T:
        ones, zeros = ([n for n, c in zip(names, code, strict=True) if c * side > 0] for side in (1, -1))
        share = lambda group, f: sum(chance[n](f) for n in group) / len(group)
        odds = lambda f, a=ones, b=zeros: math.log(share(a, f) / share(b, f))
        used = set().union(*counts.values())
        unused = language.FEATURES - len(used)
        quiet = next(f for f in range(language.FEATURES) if f not in used)
        gap = lambda f, a=ones, b=zeros: (share(a, f) - share(b, f)) * odds(f, a, b)
        bits.append((odds, sum(map(gap, used)) + unused * gap(quiet)))
    weight = [w * len(bits) / sum(w for _, w in bits) for _, w in bits]
    for doc, text, *_ in data:
        found = grams(text)
        margins = [sum(map(odds, found)) / math.sqrt(len(found)) for odds, _ in bits]
        losses = [sum(w * math.log1p(math.exp(-m * c)) for m, c, w in zip(margins, code, weight, strict=True)) for code in codes.tolist()]
        likely = [math.exp(min(losses) - loss) for loss in losses]
        best = max(range(len(names)), key=lambda i: (likely[i], -i))
        assert got[doc].lang_pred == names[best] and got[doc].score == pytest.approx(likely[best] / sum(likely), rel=1e-3)


def test_language_without_anything_to_learn(spark):
    nothing = spark.createDataFrame([(1, "abc", None, "s", 1)], SCHEMA)
    assert [r.lang_pred for r in language.predict(nothing, language.fit(nothing)).collect()] == ["und"]
    empty = spark.createDataFrame([], SCHEMA)
    assert language.predict(empty, language.fit(empty)).count() == 0


def test_codewords_tell_every_pair_apart():
    for count in (2, 3, 6, 7, 40):
        codes = language.codewords(count)
        assert all((codes[i] != codes[j]).any() for i in range(count) for j in range(i))


def test_toxicity_on_held_out_documents(spark):
    rng = random.Random(7)
    bad = ["zorgblat", "quuxfrob", "vlimpish"]
    data, marks = [], []
    for doc in range(900):
        words = sentence(rng, rng.randint(20, 120)).split()
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(bad)
        data.append((doc, " ".join(words), "aa", "s", 1))
        marks.append((doc, int(toxic)))
    truth = dict(marks)
    data += [(5000, None, "aa", "s", 1), (5001, "", "aa", "s", 1), data[0]]
    labels = spark.createDataFrame([(d, 1, t) for d, t in marks] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    documents = frame(spark, data)
    got = toxicity.score(documents, toxicity.fit(documents, labels)).collect()
    assert len(got) == len(data) and {"row", "spans"} <= set(got[0].asDict())
    held = [r for r in got if is_held(r.doc_id) and r.doc_id in truth]
    caught = [r.toxicity >= toxicity.THRESHOLD for r in held if truth[r.doc_id]]
    alarms = [r.toxicity >= toxicity.THRESHOLD for r in held if not truth[r.doc_id]]
    assert np.mean(caught) >= 0.95 and np.mean(alarms) <= 0.02
    none = toxicity.score(documents, toxicity.fit(documents, labels.where("toxic = 0")))
    assert {r.toxicity for r in none.collect()} == {0.0}


def test_toxicity_scores_do_not_depend_on_the_caps(spark, monkeypatch):
    rng = random.Random(11)
    data, marks = [], []
    for doc in range(1200):
        words = sentence(rng, 30).split()
        toxic = doc % 10 == 0
        # some toxic texts without a telling word, some ordinary ones with one
        if rng.random() < (0.8 if toxic else 0.01):
            words[3] = "zorgblat"
        data.append((doc, " ".join(words), "aa", "s", 1))
        marks.append((doc, 1, int(toxic)))
    documents, labels = frame(spark, data), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    whole = toxicity.fit(documents, labels).scores
    # ordinary rows are capped to as many as toxic ones
    monkeypatch.setattr(toxicity, "ORDINARY_ROWS", 90)
    capped = toxicity.fit(documents, labels).scores
    assert whole[0] < 0.1 and capped[0] < 0.1


def test_a_chance_hit_says_less_of_a_long_text(spark):
    rng = random.Random(12)
    toxic, ordinary = [], []
    for at in range(1000):
        words = sentence(rng, 30).split()
        bad = at % 4 == 0
        if rng.random() < (0.9 if bad else 0):
            words[3] = "zorgblat"
        (toxic if bad else ordinary).append(" ".join(words))
    model = toxicity.train(toxic, ordinary)
    filler = sentence(rng, 20 * toxicity.STRETCH)
    got = toxicity.score(spark.createDataFrame([(1, "a zorgblat b"), (2, f"zorgblat {filler}")], "doc_id long, text string"), model)
    scores = {r.doc_id: r.toxicity for r in got.collect()}
    assert scores[1] > toxicity.THRESHOLD and scores[2] < 0.9 * scores[1]


def test_toxic_windows_equal_brute_force(spark):
    rng = random.Random(17)
    toxic, ordinary = ([" ".join([*sentence(rng, 30).split(), *extra]) for _ in range(200)] for extra in (["zorgblat"], []))
    model = toxicity.train(toxic, ordinary)
    # a text of several stretches, repeated words, punctuation, blanks and no-break spaces
    texts = [*toxic[:5], *ordinary[:5], "", None, " \n ", "zorgblat, Zorgblat! (zorgblat) zorg\u00a0blat", sentence(rng, 2500) + " zorgblat " + sentence(rng, 900)]
    got = {r.doc_id: r for r in toxicity.score(frame(spark, [(i, t, "aa", "s", 1) for i, t in enumerate(texts)]), model).collect()}
    ordinary_zip, toxic_zip = model.compressors()
    for at, text in enumerate(texts):
        words, telling = (text or "").encode().lower().split(), {}
        for word in set(words):
            core = word.strip(toxicity.EDGES)
            coded = toxicity._written(core)
            plain, bad = (min(len(coded), len(z.compress(coded))) for z in (ordinary_zip, toxic_zip))
            telling[word] = bool(core) and bad <= model.longest and plain - bad >= model.least_saving
        stretches = [set(words[i : i + toxicity.STRETCH]) for i in range(0, len(words), toxicity.STRETCH)] or [set()]
        densest = max(sum(telling[w] for w in part) for part in stretches)
        assert got[at].toxic_windows == sum(telling.values())
        assert got[at].toxicity == model.scores_of(len(stretches))[min(2, densest)]
    assert all(got[i].toxicity >= toxicity.THRESHOLD for i in range(5))


def test_long_labelled_texts_are_learned_from(spark):
    rng = random.Random(13)
    data = [(d, f"{sentence(rng, 4000)} {'zorgblat' if d % 2 else ''}", "aa", "s", 1) for d in range(120)]
    labels = spark.createDataFrame([(d, 1, d % 2) for d in range(120)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(frame(spark, data), labels).toxic


def test_repeated_ids_are_cut_before_the_driver(spark, monkeypatch):
    data = [(1, "same text", "aa", "s", 1)] * 300 + [(3, f"text {i}", "aa", "s", 1) for i in range(50)] + [(4, "other", "aa", "s", 1)]
    labels = spark.createDataFrame([(1, 1, 1), (3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert not any(map(is_held, (1, 3, 4)))
    rows, counts = toxicity.sample(frame(spark, data), labels)
    texts = [(r["text"], r["toxic"]) for r in rows.collect()]
    taken = [[t for t, kind in texts if kind == 1], [t for t, kind in texts if kind == 0], counts]
    assert taken[0] == ["same text"] and len(taken[1]) == toxicity.TEXTS_OF_ID + 1 and taken[2] == (1, 2)


def test_quality_sample_and_border(spark):
    rng = random.Random(9)
    good = "clear plain sound useful text".split()
    data = [(i, " ".join(rng.choice(good) for _ in range(40)) if i % 2 else sentence(rng, 40), "aa", "s", 1) for i in range(400)]
    data += rows(count=10)[-8:]
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(0, 400, 3)], "doc_id long, quality int, toxic int")
    documents = frame(spark, data)
    got = quality.resample(documents, labels).collect()
    assert len(got) == len(data)
    plain = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.selected]
    assert sum(r.doc_id % 2 for r in plain) >= 0.95 * min(len(plain), 200)
    chosen = sorted((r.key for r in got), reverse=True)[: sum(r.selected for r in got)]
    assert min(r.key for r in got if r.selected) == chosen[-1]
    uniform = quality.resample(documents, labels.where("quality = 0")).collect()
    assert {r.log_weight for r in uniform} == {0.0}
    assert quality.resample(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_quality_ratios_equal_brute_force(spark):
    rng = random.Random(21)
    data = [(i, " ".join(rng.choice("Alpha beta gamma delta eps Zeta".split()) for _ in range(rng.randint(0, 25))), "aa", "s", 1) for i in range(60)]
    data += [(100, None, "aa", "s", 1), (101, " \t", "aa", "s", 1)]
    marks = [(i, int(i % 3 == 0), 0) for i in range(60)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    features = lambda text: [w.lower() for w in (text or "").split()] + list(zip((text or "").lower().split(), (text or "").lower().split()[1:], strict=False))
    # two different grams share a bucket so rarely that none of these few do
    raw, target = Counter(), Counter()
    for doc, text, *_ in data:
        raw.update(features(text))
        if doc < 60 and doc % 3 == 0:
            target.update(features(text))
    sums = [sum(c.values()) + 0.5 * quality.FEATURES for c in (target, raw)]
    got = {r.doc_id: r.log_weight for r in quality.resample(frame(spark, data), labels).collect()}
    for doc, text, *_ in data:
        own = [math.log((target[f] + 0.5) / sums[0]) - math.log((raw[f] + 0.5) / sums[1]) for f in features(text)]
        assert got[doc] == pytest.approx(quality.NOMINAL_TOKENS * sum(own) / max(1, len(own)), abs=1e-3)


def test_largest_equals_a_sort(spark):
    rng = random.Random(3)
    values = [(i, rng.choice([rng.random(), 0.5, rng.gauss(0, 1e6)])) for i in range(5000)]
    frame_ = spark.createDataFrame(values, "doc_id long, key double")
    for count in (1, 700, 2500, 4999, 5000):
        got = frame_.where(quality.largest(frame_, "key", count)).select("doc_id").collect()
        expected = sorted(values, key=lambda r: (-r[1], r[0]))[:count]
        assert sorted(r[0] for r in got) == sorted(i for i, _ in expected)
    assert frame_.where(quality.largest(frame_, "key", 0)).count() == 0


def test_held_out_is_the_crc_of_the_id(spark):
    got = spark.range(50).select(F.col("id").alias("doc_id")).withColumn("h", held_out()).collect()
    assert all(r.h == is_held(r.doc_id) for r in got)
