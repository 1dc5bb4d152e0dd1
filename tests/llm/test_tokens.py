from __future__ import annotations

import random

import pytest
from cases import SCHEMA, frame, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from adtide.llm import queries, tokens
from adtide.llm.queries import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
PATH = tokenizer_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counts():
    return tokens.TokenCounts(PATH)


def number(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


ODD = [
    "", " \n\t  x  \n\n y ", "<|endoftext|>", "a<|endoftext|><|endoftext|> b <|endoftext", "it's we'll I'D don't 'S 's", "12\u0969\u096a \u2167\u00bd", "x\u0085y\u00a0z\u2003 w",
    "\x00\x01\x1c a\x1f", "\U0001f642\U0001f642\U0001f3fd ", "a\u0558\u0c5c b\U0001246f1",
]


def test_query_equals_the_library(spark, library, tmp_path):
    data = rows(count=30) + [(900 + i, t, "aa", "s1", 1) for i, t in enumerate(ODD)]
    frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_tokens(spark, str(tmp_path))
    assert got.dtypes == [("doc_id", "bigint"), ("n_bytes", "bigint"), ("n_tokens", "bigint"), ("over_limit", "boolean")]
    expected = [(doc, len((text or "").encode()), n := number(library, text), n > 1024) for doc, text, *_ in data]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected, key=str)


def test_long_pre_tokens_and_slices(library, counts, monkeypatch):
    rng = random.Random(5)
    word = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz\u00e9") for _ in range(20_000))
    texts = [word, "a" * 5000, "ab" * 3000 + "aaa" * 999, "\u65e5\u672c\u8a9e" * 2000, " " * 3001 + "x", "\u00e9t\u00e9 la " * 900, word + "<|endoftext|>" + word]
    expected = [number(library, t) for t in texts]
    assert counts.count(texts) == expected
    monkeypatch.setattr(tokens, "SLICE", 50)
    assert counts.count(texts) == expected
    monkeypatch.setattr(tokens, "MEMORY_WORDS", 3)
    monkeypatch.setattr(tokens, "ROUND_SYMBOLS", 64)
    assert counts.count(texts + ODD) == expected + [number(library, t) for t in ODD]


def test_both_forms_of_merging_agree(counts):
    rng = random.Random(8)
    words = ["".join(rng.choice("aabetinrs'\u00e9 ") for _ in range(rng.randint(1, 60))).encode() for _ in range(300)]
    assert counts.merges.count(words).tolist() == [counts.merges._count_long(w) for w in words]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from("aabe tin\n '.<|>"))))
def test_any_text(library, counts, text):
    assert counts.count([text]) == [number(library, text)]


def test_every_letter_and_number_is_classed_as_by_the_library(library, counts):
    import regex

    characters = regex.compile(r"[\p{L}\p{N}\p{M}\s]").findall("".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000))
    texts = [f"a{c}1{c}!{c} {c}" for c in characters[:: 7] + sorted(counts.strange)[::40]]
    expected = [len(e.ids) for e in library.encode_batch_fast(texts, add_special_tokens=False)]
    assert counts.count(texts) == expected


def test_a_merge_of_an_unmade_symbol_is_refused():
    symbols = list(tokens.byte_symbols().values())
    vocabulary = {s: i for i, s in enumerate([*symbols, "ab", "abc"])}
    tokens.Merges(vocabulary, [("a", "b"), ("ab", "c")])
    with pytest.raises(ValueError, match="no earlier merge"):
        tokens.Merges(vocabulary, [("ab", "c"), ("a", "b")])


def test_no_rows(spark):
    assert tokens.token_counts(spark.createDataFrame([], SCHEMA), PATH).count() == 0
