"""Small tables of documents with the awkward cases every operator must take."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def sentence(rng: random.Random, words: int) -> str:
    return " ".join("".join(rng.choice("abcdeoknrst") for _ in range(rng.randint(2, 7))) for _ in range(words))


def rows(seed: int = 3, count: int = 60) -> list[tuple]:
    """Plain texts, exact and near copies, shared passages, nulls, blanks, repeated rows and one long text."""
    rng = random.Random(seed)
    passage = sentence(rng, 70)
    made = []
    for doc in range(count):
        text = sentence(rng, rng.randint(0, 260))
        if doc % 7 == 3:
            text = f"{sentence(rng, rng.randint(0, 30))} {passage}\n{sentence(rng, rng.randint(0, 40))}"
        if doc % 5 == 4 and made:
            words = (rng.choice(made)[1] or "").split(" ")
            if len(words) > 3:
                words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        if doc % 11 == 6 and made:
            text = rng.choice(made)[1]
        made.append((doc, text, rng.choice(["aa", "bb", None]), rng.choice(["s1", "s2", "Ä", None]), 5))
    made += [
        (count, None, None, None, None), (count + 1, "", "aa", "s1", 0), (count + 2, " \t\n", "aa", "s1", 3), (None, made[3][1], "aa", "s9", 1),
        (count + 3, sentence(rng, 6000), "bb", "s2", 1), made[3], made[3], (count + 4, "été ÑANDÚ wörter 日本語 " * 30, "aa", "s1", 1),
    ]
    return made


def frame(spark: SparkSession, data: list[tuple], partitions: int = 3) -> DataFrame:
    """The rows with additional columns whose names clash with inner ones."""
    from pyspark.sql import functions as F

    base = spark.createDataFrame(data, SCHEMA).repartition(partitions)
    return base.withColumn("row", F.lit("x")).withColumn("size", F.lit("y")).withColumn("doc", F.lit(1)).withColumn("spans", F.lit(2)).withColumn("score", F.lit("z"))
