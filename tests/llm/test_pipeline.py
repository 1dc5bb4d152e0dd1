from __future__ import annotations

import random

from cases import SCHEMA, rows, sentence

import corpus_pipeline as pipeline


def test_stages_take_effect(spark, tmp_path):
    rng = random.Random(1)
    bad = ["zorgblat", "quuxfrob"]
    data = rows(count=150)
    toxic = {}
    for doc in range(1000, 1200):
        words = sentence(rng, 80).split()
        toxic[doc] = doc % 4 == 0
        if toxic[doc]:
            words[5], words[50] = bad
        data.append((doc, " ".join(words), "aa", "s1", 1))
    folder = str(tmp_path)
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, 1, int(t)) for d, t in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    results = [docs]
    for at, (_, stage) in enumerate(pipeline.STAGES):
        stage(spark, results[-1], folder).write.parquet(f"{folder}/stage-{at}")
        results.append(spark.read.parquet(f"{folder}/stage-{at}"))
    for frame in results[:-1]:
        assert frame.columns == list(pipeline.COLUMNS)
    clean = {r.doc_id for r in results[1].collect()}
    assert not clean & {d for d, t in toxic.items() if t} and {d for d, t in toxic.items() if not t} <= clean
    shingles = [{tuple((r.text or "").lower().split()[i : i + 5]) for i in range(len((r.text or "").split()) - 4)} for r in results[2].collect()]
    sets = [s for s in shingles if s]
    for i, one in enumerate(sets):
        for two in sets[:i]:
            assert 100 * len(one & two) < 80 * len(one | two)
    windows: dict = {}
    for r in results[3].collect():
        words = (r.text or "").split()
        for i in range(len(words) - 49):
            windows.setdefault(tuple(words[i : i + 50]), set()).add(r.doc_id)
    assert all(len(ids) == 1 for ids in windows.values())
    assert {r.doc_id for r in results[4].collect()} <= {r.doc_id for r in results[3].collect()}
    packed = results[5].collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in results[4].collect()}
    assert sum(r.piece == 0 for r in packed) == results[4].count()


def test_stages_of_empty_tables_and_of_clashing_columns(spark, tmp_path):
    from cases import frame

    folder = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    none = spark.createDataFrame([], SCHEMA)
    for _, stage in pipeline.STAGES[:-1]:
        empty = stage(spark, none, folder)
        assert empty.columns == list(pipeline.COLUMNS) and empty.count() == 0
    assert pipeline.STAGES[-1][1](spark, none, folder).count() == 0
    clashing = frame(spark, rows(count=25))
    for _, stage in pipeline.STAGES[:-1]:
        assert stage(spark, clashing, folder).columns == list(pipeline.COLUMNS)
    assert pipeline.pack(spark, clashing, folder).count() >= clashing.count()
