"""An order book seen as ratings: customers rate the parts they bought."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinrate.sources import files

# Newest purchase first; no two lines of one customer and part tie on all three.
RECENCY = ("timestamp", "orderId", "lineId")


# Declared, so that no job opens a file before the query itself does.
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_shipdate TIMESTAMP_NTZ",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING",
}


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def fingerprint(spark: SparkSession, folder: str) -> tuple[int, int]:
    """Identity of the files that ratings come from."""
    return files.fingerprint(spark, f"{folder}/lineitem.parquet", f"{folder}/orders.parquet")


def _raw(spark: SparkSession, folder: str, rating: Column) -> DataFrame:
    lines = _table(spark, folder, "lineitem")
    orders = _table(spark, folder, "orders")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").cast("bigint").alias("userId"),
        F.col("l_partkey").cast("bigint").alias("movieId"),
        rating.cast("double").alias("rating"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_orderkey").alias("orderId"),
        F.col("l_linenumber").alias("lineId"),
    )


def _quantity_rating() -> Column:
    return F.lit(0.5) + F.lit(0.5) * F.floor((F.col("l_quantity") - 1) / 5)


def raw_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One rating per order line: quantities 1..50 map to 0.5..5.0."""
    return _raw(spark, folder, _quantity_rating())


# Items that every customer rates in the skewed ratings; no part has such an id.
EVERYBODYS = (-1, -2, -3, -4)


def skewed_ratings(ratings: DataFrame) -> DataFrame:
    """Cleaned ratings, and one of each customer for some items that everybody rates.

    The added ratings run through all values from 0.5 to 5.0, by customer and item.
    """
    users = ratings.select("userId").distinct()
    ids = F.array(*[F.lit(i).cast("bigint") for i in EVERYBODYS])
    step = F.pmod(F.col("userId") * 7 - F.col("movieId") * 3, F.lit(10))
    added = users.select("userId", F.explode(ids).alias("movieId")).select(
        "userId", "movieId", ((step + 1) / 2.0).cast("double").alias("rating")
    )
    return ratings.select("userId", "movieId", "rating").unionByName(added)


def dirty_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The same with missing ratings on lines 7 and out-of-range ones on lines 6."""
    line = F.col("l_linenumber")
    return _raw(
        spark, folder, F.when(line == 6, 9.0).when(line != 7, _quantity_rating())
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    """Part names as titles; type and brand as the genre text."""
    return _table(spark, folder, "part").select(
        F.col("p_partkey").cast("bigint").alias("movieId"),
        F.col("p_name").alias("title"),
        F.concat_ws("|", "p_type", "p_brand").alias("genres"),
    )
