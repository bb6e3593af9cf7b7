"""Rare languages are learned at every size."""

import pytest
from pyspark.sql import functions as F

from kinrate.llm import language_id

RARE = "kissa ja koira juoksevat metsässä"


@pytest.mark.parametrize("rare", [1, 3])
def test_a_rare_language_is_learned(spark, rare):
    learn = spark.range(20_000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 2 == 0, "the cat and the dog run in the wood")
        .otherwise("le chat et le chien courent dans le bois")
        .alias("text"),
        F.when(F.col("id") % 2 == 0, "en").otherwise("fr").alias("lang"),
    )
    some = spark.range(rare).select((F.col("id") + 50_000).alias("key"), F.lit(RARE).alias("text"), F.lit("fi").alias("lang"))
    none = spark.createDataFrame([(60_000, "12 34", "xx"), (60_001, "text", None)], "key bigint, text string, lang string")
    model = language_id.train(learn.unionByName(some).unionByName(none), sample_rows=200)
    assert model.languages == ["en", "fi", "fr"]
    row = language_id.predict(some.select("text"), model).first()
    assert (row.lang_pred, row.rejected) == ("fi", False)
