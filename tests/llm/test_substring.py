from __future__ import annotations

import random

from cases import SCHEMA, frame, rows, sentence

from adtide.llm import substring

WINDOW = 12


def brute(data: list[tuple], window: int) -> list[tuple]:
    owners: dict[tuple, float] = {}
    last = float("inf")
    split = [(last if r[0] is None else r[0], (r[1] or "").encode().split(), r[0]) for r in data]
    for key, words, _ in split:
        for at in range(len(words) - window + 1):
            run = tuple(words[at : at + window])
            owners[run] = min(owners.get(run, last), key)
    out = []
    for key, words, doc in split:
        gone = set()
        for at in range(len(words) - window + 1):
            if owners[tuple(words[at : at + window])] < key:
                gone.update(range(at, at + window))
        out.append((doc, len(words), len(gone), " ".join(w.decode() for i, w in enumerate(words) if i not in gone)))
    return sorted(out, key=str)


def test_equals_brute_force(spark):
    data = rows(count=90)
    for window in (WINDOW, 50):
        got = substring.without_repeats(frame(spark, data), window)
        kept = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got.collect()), key=str)
        assert kept == brute(data, window)
    assert {"row", "size", "doc", "score"} <= set(got.columns)


def test_blocks_cover_every_window_once(spark):
    data = rows(count=30)
    for row in substring.parse_blocks(frame(spark, data), WINDOW).groupBy("doc", "tid").agg({"windows": "sum"}).collect():
        words = [len((r[1] or "").split()) for r in data if r[0] == row.doc]
        if words:
            assert row["sum(windows)"] % (words[0] - WINDOW + 1) == 0


def test_copies_of_a_row_are_parsed_once(spark, monkeypatch):
    rng = random.Random(8)
    shared, own = sentence(rng, 200), sentence(rng, 40)
    one = (5, f"{shared} {own}", "aa", "s", 1)
    windows = substring._border_windows

    def counted(texts, window):
        found = windows(texts, window)
        made.append(found.count())
        return found

    monkeypatch.setattr(substring, "_border_windows", counted)
    sizes = []
    for copies in (1, 1000):
        made = []
        data = [one] * copies + [(9, f"{sentence(random.Random(1), 30)} {shared}", "aa", "s", 1)]
        got = substring.without_repeats(frame(spark, data), 50).collect()
        assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got), key=str) == brute(data, 50)
        sizes.append(made[0])
    assert sizes[0] == sizes[1] > 0


def test_no_rows(spark):
    assert substring.without_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
