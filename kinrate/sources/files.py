"""Readers for rating and item files, and writers for result tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}
FORMATS = ("csv", "parquet", "json")

# Fixed value: schema of the stored user means.
AVERAGES = "userId BIGINT, avg_rating DOUBLE, num_ratings BIGINT"


def _read_text(spark: SparkSession, path: str, columns: tuple[str, ...]) -> DataFrame:
    """The named columns of a CSV with a header, as text; absent ones are NULL.

    Nothing is inferred: columns are found by header name in any order, and each
    is cast later, so that one bad value becomes one NULL.
    """
    raw = spark.read.options(**CSV_OPTIONS).csv(path)
    present = set(raw.columns)
    return raw.select(
        *[
            (F.col(name) if name in present else F.lit(None).cast("string")).alias(name)
            for name in columns
        ]
    )


def _id(name: str) -> Column:
    # Through a decimal, so that "7.0" is 7 and no digit is lost; text that is no number
    # becomes NULL.
    return F.expr(f"try_cast(try_cast(trim({name}) AS DECIMAL(38,18)) AS BIGINT)")


def _path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Ratings CSV as ``userId BIGINT, movieId BIGINT, rating FLOAT, timestamp BIGINT``."""
    raw = _read_text(spark, path, ("userId", "movieId", "rating", "timestamp"))
    return raw.select(
        _id("userId").alias("userId"),
        _id("movieId").alias("movieId"),
        F.expr("try_cast(trim(rating) AS FLOAT)").alias("rating"),
        F.expr("try_cast(trim(timestamp) AS BIGINT)").alias("timestamp"),
    )


def read_items(spark: SparkSession, path: str) -> DataFrame | None:
    """Item CSV as ``movieId BIGINT, title, genres``; None where there is no file."""
    try:
        raw = _read_text(spark, path, ("movieId", "title", "genres"))
    except AnalysisException as error:
        if not _path_missing(error):
            raise
        return None
    return raw.select(_id("movieId").alias("movieId"), "title", "genres")


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table at ``path``; every task writes its own part file."""
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.format(fmt).save(path)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame | None:
    """A stored table with its known schema; None where none was written.

    Parquet tables carry their schema and may do without.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, not {fmt!r}")
    if schema is None and fmt != "parquet":
        raise ValueError(f"{fmt} tables need a schema")
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    try:
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if not _path_missing(error):
            raise
        return None


def fingerprint(spark: SparkSession, *paths: str) -> tuple[int, int]:
    """Identity of the files below the paths, by name, size and time.

    Spark lists the files and hashes the listing; none is opened.
    """
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(list(paths))
    )
    seen = F.xxhash64("path", "modificationTime", "length")
    return tuple(listing.agg(F.count(F.lit(1)), F.bit_xor(seen)).first())
