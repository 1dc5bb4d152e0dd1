"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtide.llm.common import held_out, prepare_workers


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import substring

    kept = substring.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import license

    pages = license.scan(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    # documents have no path: they state a licence of their own or none
    unplaced = table(spark, sf_dir, "documents").select("doc_id", F.lit(None).cast("string").alias("url"), "text")
    documents = license.scan(unplaced, "doc_id", "url", "text")
    none = F.lit(None).cast("long")
    stated = ("license", "score", "origin", "declared_by")
    rows = pages.select(F.lit("pages").alias("table"), F.col("id").alias("page_id"), none.alias("doc_id"), *stated)
    return rows.unionByName(documents.select(F.lit("documents").alias("table"), none.alias("page_id"), F.col("id").alias("doc_id"), *stated))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import language

    documents = table(spark, sf_dir, "documents")
    found = language.predict(documents, language.fit(documents))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import mixing

    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import quality

    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import ann

    found = ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import toxicity

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, toxicity.fit(documents, table(spark, sf_dir, "labels")))
    predicted = (F.col("toxicity") >= toxicity.THRESHOLD).cast("int")
    return scored.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), predicted.alias("predicted"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import packing

    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import fingerprint

    return fingerprint.edit_trial(table(spark, sf_dir, "documents"))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import jaccard

    return jaccard.jaccard_components(table(spark, sf_dir, "documents")).drop("tid", "component")


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import phrases

    return phrases.collocations(table(spark, sf_dir, "documents"))


def op12_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import tokens

    return tokens.token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adtide.llm import lexical

    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring": op1_substring,
    "op2_license": op2_license,
    "op3_language": op3_language,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_neighbours": op6_neighbours,
    "op7_toxicity": op7_toxicity,
    "op8_packing": op8_packing,
    "op9_fingerprints": op9_fingerprints,
    "op10_jaccard": op10_jaccard,
    "op11_phrases": op11_phrases,
    "op12_tokens": op12_tokens,
    "op13_search": op13_search,
}

_SMALL_ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TERMS = rf"regexp_extract_all({_SMALL_ASCII.format('text')}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES: dict[str, str] = {
    "op11_phrases": f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_SMALL_ASCII.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
),
words AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
runs AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
phrases AS (SELECT lang, w[i : i + size - 1] AS p FROM runs, range(1, 6) AS lengths(size) WHERE i + size - 1 <= len(w)),
counts AS (SELECT lang, p, count(*) AS f FROM phrases GROUP BY ALL),
sizes AS (SELECT lang, sum(f) AS n FROM counts WHERE len(p) = 1 GROUP BY ALL),
candidates AS (SELECT lang, p, f AS a FROM counts WHERE len(p) > 1 AND f >= 100),
inside AS (
    SELECT DISTINCT lang, longer.p[i : i + size - 1] AS p, a
    FROM candidates AS longer, range(2, 5) AS lengths(size), range(1, 6) AS places(i)
    WHERE size < len(longer.p) AND i + size - 1 <= len(longer.p)
),
left_over AS (SELECT * FROM candidates AS c WHERE NOT EXISTS (SELECT 1 FROM inside AS o WHERE o.lang = c.lang AND o.p = c.p AND o.a >= c.a)),
cuts AS (SELECT lang, p, a, k, p[1 : k] AS head, p[k + 1 : len(p)] AS tail FROM left_over, range(1, 5) AS places(k) WHERE k < len(p)),
scored AS (
    SELECT c.lang, c.p, c.a, k, h.f AS l, t.f AS r, n, (1000::HUGEINT * a * n) // (h.f::HUGEINT * t.f) AS score
    FROM cuts AS c JOIN counts AS h ON h.lang = c.lang AND h.p = c.head JOIN counts AS t ON t.lang = c.lang AND t.p = c.tail JOIN sizes AS s ON s.lang = c.lang
),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
ranked AS (
    SELECT lang, array_to_string(p, ' ') AS phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score,
        row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank
    FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""",
    "op13_search": f"""
WITH numbered AS (SELECT row_number() OVER () AS row_no, doc_id, text FROM documents),
words AS (SELECT row_no, doc_id, unnest({_TERMS}) AS term FROM numbered),
sizes AS (SELECT row_no, doc_id, count(*) AS n FROM words GROUP BY ALL),
whole AS (SELECT count(*) AS documents, sum(n)::BIGINT AS total FROM sizes),
tfs AS (SELECT row_no, term, count(*) AS tf FROM words GROUP BY ALL),
dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * documents + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM dfs, whole),
asked AS (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark),
repeats AS (SELECT item_id, term, count(*) AS times FROM asked GROUP BY ALL),
scored AS (
    SELECT item_id, row_no, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * documents) // total))))::BIGINT AS score
    FROM repeats JOIN weights USING (term) JOIN tfs USING (term) JOIN sizes USING (row_no), whole
    GROUP BY ALL
),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 20
""",
}
