"""A training corpus from documents: language, near duplicates, repeated spans, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept; its
result is written as Parquet and read again for the next one. All but the last return the
columns of documents. Null texts are no language's and go in the first stage. Empty
tables pass through all stages. Columns beyond those of documents are kept up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from kinrate.llm import language_id
from kinrate.llm.jaccard_join import Jaccard, jaccard_classes
from kinrate.llm.packing import pack_documents
from kinrate.llm.substring_dedup import remove_repeats
from kinrate.plans.storage import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with enough confidence; the others go.

    Learnt from the labelled documents at hand. A null doc_id is as good as any.
    """
    labelled = docs.where(language_id.fold(F.col("doc_id")) != 2)
    model = language_id.train(labelled.select(F.col("doc_id").alias("key"), "text", "lang"))
    # all but the text as one column, so that the text goes to Python once and no name clashes
    others = [F.col(f"`{name}`") for name in docs.columns if name != "text"]
    rows = docs.select(F.struct(*others).alias("row"), "text")
    kept = language_id.predict(rows, model).where("NOT rejected")
    return kept.select(*[F.col(name if name == "text" else f"row.`{name}`").alias(name) for name in docs.columns])


def first_of_like(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: its first, by doc_id.

    Five-word shingles, linked from a similarity of 0.8. Of repeated rows one stays.
    Documents without words are like no other, and those with a null doc_id have no class; both stay.
    """
    classes = jaccard_classes(docs, Jaccard(width=5, percent=80))
    stays = classes.where("stays AND doc_id IS NOT NULL").select("doc_id", "row_key").distinct()
    rows = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), F.hash("text").alias("row_key")
    )
    one = Window.partitionBy("doc_id", "row_key").orderBy("doc_id")
    kept = rows.join(stays, ["doc_id", "row_key"]).withColumn("n", F.row_number().over(one)).where("n = 1")
    return kept.select("row.*").unionByName(docs.where("doc_id IS NULL"))


def without_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without spans of 50 words or more that an earlier document has.

    A text that loses words has the others joined by one space, and its new length. A
    document that loses all its words goes.
    """
    result = remove_repeats(docs, k=50).where("n_removed = 0 OR n_removed < n_words")
    changed = F.col("n_removed") > 0
    columns = []
    for name in docs.columns:
        if name == "doc_id":
            columns.append(F.col("doc_id").cast(docs.schema[name].dataType).alias(name))
        elif name == "text":
            columns.append(F.col("kept_text").alias(name))
        elif name == "n_chars":
            length = F.length("kept_text").cast(docs.schema[name].dataType)
            columns.append(F.when(changed, length).otherwise(F.col("other.n_chars")).alias(name))
        else:
            columns.append(F.col(f"other.`{name}`").alias(name))
    return result.select(*columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the texts, as token ids, with their places in sequences of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)


STAGES = [
    ("language_id", known_language),
    ("near_duplicates", first_of_like),
    ("substring_dedup", without_repeated_spans),
    ("packing", packed),
]

# A trained model decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
