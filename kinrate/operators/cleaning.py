"""Cleaning of rating tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from kinrate.config import DEFAULTS
from kinrate.functions.scores import percent
from kinrate.operators.joins import top_per

KEYS = ("userId", "movieId")
VALID_RANGE = (DEFAULTS.rating_low, DEFAULTS.rating_high)


def _complete() -> Column:
    return F.col("userId").isNotNull() & F.col("movieId").isNotNull() & F.col("rating").isNotNull()


def drop_incomplete(ratings: DataFrame) -> DataFrame:
    """Rows with a user, an item and a rating."""
    return ratings.filter(_complete())


def in_range(ratings: DataFrame, rating_range: tuple[float, float] = VALID_RANGE) -> DataFrame:
    """Rows whose rating lies in the closed range."""
    return ratings.filter(F.col("rating").between(*rating_range))


def newest_per_pair(ratings: DataFrame, recency: Sequence[str] = ("timestamp",)) -> DataFrame:
    """One row per user and item: the newest by ``recency``.

    The rating itself breaks the last tie, so the survivor never depends on the
    order in which rows arrive. Each task keeps one row per pair before the
    shuffle, so a pair holding a third of all rows is no hot spot.
    """
    order = [F.col(name).desc() for name in (*recency, "rating")]
    return top_per(ratings, KEYS, order, 1, "_place").select(*KEYS, "rating")


def clean_ratings(
    ratings: DataFrame,
    rating_range: tuple[float, float] | None = VALID_RANGE,
    recency: Sequence[str] = ("timestamp",),
    range_first: bool = True,
) -> DataFrame:
    """Complete, in-range ratings, one per user and item.

    ``rating_range=None`` keeps every rating. With ``range_first=False`` the range
    is applied to the survivors only, so that an out-of-range newest row removes
    its pair.
    """
    kept = drop_incomplete(ratings)
    if rating_range is not None and range_first:
        kept = in_range(kept, rating_range)
    kept = newest_per_pair(kept, recency)
    if rating_range is not None and not range_first:
        kept = in_range(kept, rating_range)
    return kept


def cleaning_audit(
    ratings: DataFrame,
    rating_range: tuple[float, float] = VALID_RANGE,
    recency: Sequence[str] = ("timestamp",),
) -> DataFrame:
    """Row counts after the null, duplicate and range steps, in that order.

    One shuffle on the pair gives all counts: every pair knows its rows, its
    complete rows and the rating that survives.
    """
    newest = F.max(F.when(_complete(), F.struct(*recency, "rating")))
    pairs = ratings.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(_complete()).alias("complete"),
        newest["rating"].alias("survivor"),
    )
    counts = pairs.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("initial_rows"),
        F.coalesce(F.sum("complete"), F.lit(0)).alias("after_nulls"),
        F.count("survivor").alias("after_duplicates"),
        F.count_if(F.col("survivor").between(*rating_range)).alias("final_rows"),
    )
    initial, final = F.col("initial_rows"), F.col("final_rows")
    return counts.select(
        "initial_rows",
        "after_nulls",
        (initial - F.col("after_nulls")).alias("removed_nulls"),
        "after_duplicates",
        (F.col("after_nulls") - F.col("after_duplicates")).alias("removed_duplicates"),
        "final_rows",
        (F.col("after_duplicates") - final).alias("removed_out_of_range"),
        (initial - final).alias("removed_total"),
        percent(initial - final, initial).alias("removed_pct"),
    )
