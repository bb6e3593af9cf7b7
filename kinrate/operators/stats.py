"""Profiles of rating tables and of result columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from kinrate.config import DEFAULTS
from kinrate.functions.scores import percent, round_half_up
from kinrate.operators.joins import top_per


def _sparsity(cells: Column, rated: Column) -> Column:
    return round_half_up(
        F.lit(100.0) - F.try_divide(rated * F.lit(100.0), cells.cast("double")), 2
    )


def _sizes(ratings: DataFrame) -> DataFrame:
    """Distinct users and items, rows and mean rating, in one row and one pass.

    Ids are counted by bitmaps of 64 neighbouring ones: a task hands on one row for each
    word of bits, words of all tasks are merged by OR, and what is set is counted. Ids that
    are dense take a sixty-fourth of the rows of a distinct count, ids far apart as many.
    """
    none = F.lit(None).cast("double")
    ids = F.array(
        F.struct(
            F.lit(True).alias("user"),
            F.col("userId").cast("bigint").alias("id"),
            F.col("rating").cast("double").alias("rating"),
        ),
        F.struct(F.lit(False).alias("user"), F.col("movieId").cast("bigint").alias("id"), none.alias("rating")),
    )
    word = F.shiftright("id", 6).alias("word")
    bit = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(id & 63 AS INT))")
    words = (
        ratings.select(F.inline(ids))
        .groupBy("user", word)
        .agg(
            F.bit_or(bit).alias("bits"),
            F.count(F.lit(1)).alias("rows"),
            F.count("rating").alias("rated"),
            F.sum("rating").alias("total"),
        )
    )
    user = F.col("user")

    def of(kind: Column, value: Column) -> Column:
        return F.coalesce(F.sum(F.when(kind, value)), F.lit(0)).cast("bigint")

    return words.agg(
        of(user, F.bit_count("bits")).alias("num_users"),
        of(~user, F.bit_count("bits")).alias("num_movies"),
        of(user, F.col("rows")).alias("total_ratings"),
        F.try_divide(F.sum("total"), F.sum("rated")).alias("mean"),
    )


def dataset_stats(ratings: DataFrame) -> DataFrame:
    """Users, items, rows, mean rating and sparsity in percent, in one row."""
    return _sizes(ratings).select(
        "num_users",
        "num_movies",
        "total_ratings",
        round_half_up(F.col("mean"), 3).alias("avg_rating"),
        _sparsity(F.col("num_users") * F.col("num_movies"), F.col("total_ratings")).alias(
            "sparsity_pct"
        ),
    )


def rating_distribution(ratings: DataFrame) -> DataFrame:
    """Rows and share of all rows per rating value, in order of the value."""
    counts = ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select(
        "rating", "count", percent(F.col("count"), total).alias("percentage")
    ).orderBy("rating")


def matrix_info(ratings: DataFrame) -> DataFrame:
    """Size and fill of the user-by-item matrix, which itself is never built."""
    cells, rated = F.col("total_cells"), F.col("total_ratings")
    return (
        _sizes(ratings)
        .withColumn("total_cells", F.col("num_users") * F.col("num_movies"))
        .select(
            "num_users",
            "num_movies",
            "total_ratings",
            "total_cells",
            (cells - rated).alias("null_cells"),
            _sparsity(cells, rated).alias("sparsity_pct"),
            percent(rated, cells).alias("density_pct"),
        )
    )


def matrix_sample(ratings: DataFrame, item_ids: Sequence[int], users: int = 5) -> DataFrame:
    """A corner of the matrix: the lowest user ids against the given items.

    Naming the items makes the columns known before the data is read; users
    without any of them have no row.
    """
    corner = ratings.select("userId").distinct().orderBy("userId").limit(users)
    wanted = [int(i) for i in item_ids]
    pivoted = (
        ratings.filter(F.col("movieId").isin(wanted))
        .join(corner, "userId", "left_semi")
        .groupBy("userId")
        .pivot("movieId", wanted)
        .agg(F.first("rating"))
    )
    return pivoted.select(
        "userId", *[F.col(f"`{i}`").alias(f"movie_{i}") for i in wanted]
    )


def user_averages(ratings: DataFrame, digits: int | None = DEFAULTS.mean_digits) -> DataFrame:
    """Mean (rounded) and number of ratings per user."""
    return ratings.groupBy("userId").agg(
        round_half_up(F.avg("rating"), digits).alias("avg_rating"),
        F.count("rating").alias("num_ratings"),
    )


def eligible_users(
    averages: DataFrame, min_ratings: int = DEFAULTS.min_candidate_ratings
) -> DataFrame:
    """Users with enough ratings to serve as neighbours."""
    return averages.filter(F.col("num_ratings") >= min_ratings)


def column_summary(
    df: DataFrame, column: str, by: Sequence[str] = (), digits: int | None = None
) -> DataFrame:
    """Mean, sample deviation, minimum and maximum; 0 where there is none."""
    measures = {
        "mean": F.avg(column),
        "std_dev": F.stddev_samp(column),
        "min": F.min(column),
        "max": F.max(column),
    }
    return df.groupBy(*by).agg(
        *[
            round_half_up(F.coalesce(value.cast("double"), F.lit(0.0)), digits).alias(name)
            for name, value in measures.items()
        ]
    )


def top_bottom_users(averages: DataFrame, n: int = 5) -> DataFrame:
    """The users with the highest and with the lowest means."""
    parts = []
    for side, mean in (
        ("highest", F.col("avg_rating").desc()),
        ("lowest", F.col("avg_rating").asc()),
    ):
        order = [mean, F.col("num_ratings").desc(), F.col("userId")]
        parts.append(
            top_per(averages, (), order, n).select(F.lit(side).alias("side"), "rank", *averages.columns)
        )
    return parts[0].unionByName(parts[1])


def item_popularity(ratings: DataFrame) -> DataFrame:
    """Number and mean of ratings per item."""
    return ratings.groupBy("movieId").agg(
        F.count("rating").alias("num_ratings"),
        F.avg("rating").alias("avg_rating"),
    )


def value_counts(df: DataFrame, value: Column, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Rows per value of a column expression."""
    return df.groupBy(*by, value.alias(name)).agg(F.count(F.lit(1)).alias("count"))


def histogram(
    df: DataFrame,
    column: str,
    low: float,
    high: float,
    bins: int = DEFAULTS.histogram_bins,
    by: Sequence[str] = (),
) -> DataFrame:
    """Rows per bin of equal width; the last bin includes ``high``.

    Values outside the range count in the nearest bin; empty bins have no row.
    """
    width = (high - low) / bins
    # Multiplied, not divided by the width: 0.15 then falls in the bin from 0.15.
    place = F.floor((F.col(column) - low) * F.lit(bins / (high - low))).cast("int")
    within = F.greatest(F.lit(0), F.least(F.lit(bins - 1), place))
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(*by, within.alias("bin"))
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            *by,
            "bin",
            round_half_up(F.lit(low) + F.col("bin") * F.lit(width), 4).alias("bin_start"),
            round_half_up(F.lit(low) + (F.col("bin") + 1) * F.lit(width), 4).alias("bin_end"),
            "count",
        )
    )
