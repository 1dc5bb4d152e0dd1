"""Corpus pipeline: stages over documents, each written before the next one reads it.

In every stage a null text is an empty one, a text of any length is read whole, other columns of the
input are left out and an empty table gives an empty one with the same columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtide.llm import jaccard, mixing, packing, substring, toxicity
from adtide.llm.common import prepare_workers, one_row_each, store
from adtide.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: The stages score, parse, round at random or pack, which SQL cannot express.
ORACLE_SQL = None


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold; the classifier learns from those of the input with labels.

    Every row is judged on its own, so that repeated rows stay or go together; empty texts and null ids
    are judged like others. Without toxic or without ordinary labels every document stays.
    """
    prepare_workers(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs.select(*COLUMNS), model)
    return scored.where(F.col("toxicity") < toxicity.THRESHOLD).select(*COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id, then the smallest hash of the text.

    Of repeated rows one stays; a null id comes after all others; texts without words link with nothing,
    so that each of them stays.
    """
    prepare_workers(spark)
    found = jaccard.jaccard_components(docs)
    key = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), "tid")
    first = found.groupBy("component").agg(F.min(key).alias("kept")).select("kept.doc", "kept.tid")
    return one_row_each(docs.select(*COLUMNS)).join(first, ["doc", "tid"], "left_semi").select(*COLUMNS)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that an earlier document holds are cut; other texts stay as they are.

    Repeated rows are cut alike, a null id is later than all others, and a text that is cut whole stays as
    an empty one.
    """
    prepare_workers(spark)
    cut = substring.without_repeats(docs.select(*COLUMNS))
    changed = F.col("n_removed") > 0
    text = F.when(changed, F.col("kept_text")).otherwise(F.col("text"))
    size = F.when(changed, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return cut.select("doc_id", text.alias("text"), "lang", "source", size.alias("n_chars"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it.

    Documents without words and those of a null source take part like others; a document that the mix
    does not take goes.
    """
    prepare_workers(spark)
    mixed = mixing.mix_sources(docs).where("copies > 0")
    # rows that agree in id, text and source are one row with their copies added
    doc = F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc")
    copies = mixed.groupBy(doc, "tid", F.col("source").alias("of")).agg(F.sum("copies").alias("copies"))
    keyed = docs.select(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("doc"), F.xxhash64("text").alias("tid"), *COLUMNS)
    if not keyed.groupBy("doc", "tid", "source").count().where("count > 1").isEmpty():
        keyed = keyed.dropDuplicates(["doc", "tid", "source"])
    same = (keyed["doc"] == copies["doc"]) & (keyed["tid"] == copies["tid"]) & keyed["source"].eqNullSafe(copies["of"])
    taken = keyed.join(copies, same).select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    return taken.select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and offsets; an empty text is its end token alone."""
    prepare_workers(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", reject_toxic),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("substring dedup", cut_repeats),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every result but the last is written and read again."""
    prepare_workers(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = store(docs, f"stage-{at}")
    return docs
