"""Corpus pipeline: toxic and undetermined documents go, one of each group of
near copies stays, sources are mixed to their target weights, and the result
is packed into training sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet to the shared folder and read again as the next stage's docs.  All
but the last return the columns of documents.  Stages that call Python bound the
Arrow batches of their session, so what a task holds does not depend on how long
10,000 texts are.

Defined cases, besides those of the operators: rows without doc_id are copies
by their text as any other; rows that share a doc_id and have different texts
are different documents; rows that are equal in doc_id and text are one for the
join stage, with or without shingles; other columns, whatever their names, pass
through all stages but the last; empty tables pass through.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillroll.llm import language, mixing, ngram_join, packing, toxicity
from tillroll.llm.common import bound_batches, read, save

TOXIC_FROM = 0.5     # calibrated score from which a document is rejected
LANGUAGE_FROM = 0.4  # calibrated probability that a document's language must reach
COPY_WORDS, COPY_PERCENT = 5, 80  # near copies: Jaccard of five-word shingles of 0.8 or more


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below TOXIC_FROM by a model of this input's labelled ones."""
    bound_batches(spark)
    model = toxicity.fit(docs.select("doc_id", "text"), read(spark, sf_dir, "labels"))
    return docs.where(toxicity.scorer(spark, model)("text") < TOXIC_FROM)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter and a language that the model is not at odds about."""
    bound_batches(spark)
    found = language.identifier(spark, language.fit(docs.select("doc_id", "lang", "text")))("text")
    return docs.where((found["lang_pred"] != language.UNKNOWN) & (found["score"] >= LANGUAGE_FROM))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    bound_batches(spark)
    return ngram_join.one_of_each(docs, COPY_WORDS, COPY_PERCENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it: whole epochs,
    and once more up to the cut.  The document in which the cut falls stays
    whole if at least half of it is inside the budget."""
    taken = mixing.mix(docs.select("doc_id", "source", "text"))
    part = F.col("taken") - F.col("epochs") * F.col("size")
    copies = F.col("epochs") + F.when((part > 0) & (2 * part >= F.col("size")), 1).otherwise(0)
    # rows of equal doc_id, source and size are interchangeable; their number tells them apart
    number = F.row_number().over(Window.partitionBy("doc_id", "source", "size").orderBy("epochs", "taken"))
    taken = taken.select(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_source"), F.col("size").alias("_mix_of"),
                         number.alias("_mix_which"), copies.cast("int").alias("_mix_copies")).where("_mix_copies > 0")
    sized = docs.withColumn("_mix_size", mixing.word_count(F.col("text")))
    sized = sized.withColumn("_mix_number", F.row_number().over(Window.partitionBy("doc_id", "source", "_mix_size").orderBy(F.xxhash64("text"))))
    same = (F.col("doc_id").eqNullSafe(F.col("_mix_id")) & F.col("source").eqNullSafe(F.col("_mix_source"))
            & (F.col("_mix_size") == F.col("_mix_of")) & (F.col("_mix_number") == F.col("_mix_which")))
    out = sized.join(taken, same).withColumn("_mix_copy", F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies"))))
    return out.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    bound_batches(spark)
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("language", keep_language), ("near_copies", drop_copies), ("mixing", mix_sources), ("packing", pack)]

# Learned models and a tokenizer: not expressible in SQL; tested against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = save(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
