from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from cases import SCHEMA, frame, rows

from adtide.llm import packing
from adtide.llm.queries import tokenizer_path

pytest.importorskip("tokenizers")


def test_pieces_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_path())
    data = rows(count=20) + [
        (900, "It's <|endoftext|> the <|ENDOFTEXT|> END. a.b, c!, !. X1,2. x\x1cy \x85z Straße ΑΣ. ΣΑΣ, é É. q ... ,", "aa", "s1", 1),
        (901, "Word, word. WORD .word" * 40, "aa", "s1", 1),
    ]
    got = packing.tokenize(frame(spark, data), tokenizer_path(), 64).collect()
    expected = []
    for doc, text, *_ in data:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 1], dtype="<u4")
        for piece, at in enumerate(range(0, len(ids), 64)):
            part = ids[at : at + 64]
            expected.append((doc, piece, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted(map(tuple, got), key=str) == sorted(expected, key=str)


def check(packed, capacity):
    by: dict[int, list] = {}
    for row in packed:
        by.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_bins_are_gapless_and_nearly_full_over_several_rounds(spark):
    rng = random.Random(2)
    lengths = [rng.choice([rng.randint(1, 60), rng.randint(1, 100), 100]) for _ in range(4000)]
    pieces = spark.createDataFrame([(i, n) for i, n in enumerate(lengths)], "doc_id long, length long")
    packed = packing.pack(pieces, 100, open_bins=64, task_pieces=150).collect()
    assert sorted(r.doc_id for r in packed) == list(range(4000))
    assert check(packed, 100) <= sum(lengths) / 100 * 1.03 + 1


def test_best_fit_takes_the_fullest_bin_and_closes_it_first():
    bins = packing.OpenBins(10, 2)
    assert [bins.put(n) for n in (6, 5, 4, 3)] == [(0, 0), (1, 0), (0, 6), (1, 5)]
    assert bins.put(7) == (2, 0) and bins.put(9) == (3, 0)
    assert set(bins.open()) == {2, 3} and bins.put(3) == (2, 7)


def test_no_rows_and_empty_texts(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0
    one = packing.pack_documents(spark.createDataFrame([(1, None, "a", "s", 1), (1, "", "a", "s", 1)], SCHEMA), tokenizer_path())
    assert [(r.doc_id, r.length) for r in one.collect()] == [(1, 1), (1, 1)]
