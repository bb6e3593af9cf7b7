"""Comparing a user's ratings with those of others, and exploring neighbours.

``left`` holds the ratings of the comparing side, ``targetId, movieId,
target_rating, target_mean``; the other side is every other user in ``ratings``,
or those in ``pairs(targetId, userId)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kinrate.config import DEFAULTS, SHARE_ROWS, SIDE_ROWS
from kinrate.functions.labels import RATING_TYPES, similarity_band
from kinrate.functions.scores import percent, round_half_up
from kinrate.operators.joins import join_side, top_per
from kinrate.operators.similarity import (
    PAIR,
    _centred,
    _other_means,
    _pair_sums,
    _similarity,
    co_ratings,
)


def common_items(
    ratings: DataFrame,
    left: DataFrame,
    pairs: DataFrame | None = None,
    broadcast_left: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
) -> DataFrame:
    """Items rated on both sides: ``rating1`` is the comparing user's."""
    if pairs is not None:
        ratings = ratings.join(pairs.select("userId").distinct(), "userId", "left_semi")
    shared = co_ratings(ratings, left, broadcast_left, share_rows, side_rows)
    if pairs is not None:
        shared = shared.join(pairs.select(*PAIR), list(PAIR), "left_semi")
    return shared.select(
        *PAIR,
        "movieId",
        F.col("target_rating").cast("double").alias("rating1"),
        F.col("rating").cast("double").alias("rating2"),
        "target_mean",
    )


def compare_users(
    common: DataFrame,
    averages: DataFrame,
    min_common: int = DEFAULTS.min_common,
    digits: int | None = DEFAULTS.similarity_digits,
    agreement_gap: float = DEFAULTS.agreement_gap,
) -> DataFrame:
    """Similarity, shared items and agreement of each pair, in one row.

    The similarity is NULL below ``min_common`` items or without variance; a pair
    without any common item has no row.
    """
    gap = F.abs(F.col("rating1") - F.col("rating2"))
    sums = (
        common.groupBy(*PAIR)
        .agg(
            *_pair_sums(F.col("rating1"), F.col("rating2")),
            F.max("target_mean").alias("m_u"),
            F.count_if(gap <= agreement_gap).alias("agreements"),
        )
        .join(_other_means(averages), "userId")
    )
    enough = F.when(F.col("n") >= min_common, _similarity("null"))
    return _centred(sums).select(
        *PAIR,
        round_half_up(enough, digits).alias("similarity"),
        similarity_band(enough).alias("interpretation"),
        F.col("n").alias("common_movies"),
        percent(F.col("agreements"), F.col("n")).alias("agreement_pct"),
    )


def agreement_lists(
    common: DataFrame,
    loved: float = DEFAULTS.loved,
    disliked: float = DEFAULTS.disliked,
) -> DataFrame:
    """Items that both sides loved or both disliked, labelled."""
    one, two = F.col("rating1"), F.col("rating2")
    verdict = F.when((one >= loved) & (two >= loved), "both_loved").when(
        (one <= disliked) & (two <= disliked), "both_disliked"
    )
    return common.select(
        *PAIR, "movieId", "rating1", "rating2", verdict.alias("verdict")
    ).filter(F.col("verdict").isNotNull())


def biggest_disagreements(common: DataFrame, n: int = 10) -> DataFrame:
    """The common items each pair rated most differently."""
    apart = common.select(
        *PAIR,
        "movieId",
        "rating1",
        "rating2",
        F.abs(F.col("rating1") - F.col("rating2")).alias("difference"),
    )
    return top_per(apart, PAIR, [F.col("difference").desc(), F.col("movieId")], n)


def rating_regression(common: DataFrame, digits: int = 6) -> DataFrame:
    """Least-squares line of the other side's ratings over one's own, per pair."""
    return common.groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("points"),
        round_half_up(F.regr_slope("rating2", "rating1"), digits).alias("slope"),
        round_half_up(F.regr_intercept("rating2", "rating1"), digits).alias("intercept"),
        round_half_up(F.regr_r2("rating2", "rating1"), digits).alias("r2"),
    )


def loved_unseen(
    ratings: DataFrame,
    left: DataFrame,
    pairs: DataFrame,
    loved: float = DEFAULTS.loved,
    n: int = 10,
    broadcast_pairs: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
) -> DataFrame:
    """What one side loved and the other has not rated, both ways, ``n`` each."""
    pairs = pairs.select(*PAIR)
    rated = ratings.select("userId", "movieId", "rating")
    how = broadcast_pairs, share_rows, side_rows
    theirs = join_side(rated, pairs, "userId", "movieId", "targetId", *how)
    mine = left.select("targetId", "movieId", F.col("target_rating").alias("rating"))
    mine_per_pair = join_side(mine, pairs, "targetId", "movieId", "userId", *how)
    parts = []
    for side, wanted, known in (
        ("theirs", theirs, mine.select("targetId", "movieId")),
        ("mine", mine_per_pair, theirs.select(*PAIR, "movieId")),
    ):
        wanted = wanted.select(*PAIR, "movieId", "rating")
        fresh = wanted.filter(F.col("rating") >= loved).join(known, known.columns, "left_anti")
        parts.append(
            top_per(fresh, PAIR, [F.col("rating").desc(), F.col("movieId")], n).select(
                *PAIR,
                F.lit(side).alias("loved_by"),
                "movieId",
                F.col("rating").cast("double").alias("rating"),
                "rank",
            )
        )
    return parts[0].unionByName(parts[1])


def explore_neighbors(
    neighbors: DataFrame,
    min_similarity: float = 0.5,
    min_common: int = 5,
    rating_types=RATING_TYPES,
    sort_by: str = "similarity",
) -> DataFrame:
    """Neighbours that pass three filters, ranked per target in one of three orders.

    ``neighbors`` carries ``avg_rating, rating_type, target_mean``; ``sort_by`` is
    ``similarity``, ``common`` or ``mean_gap``.
    """
    gap = round_half_up(F.abs(F.col("avg_rating") - F.col("target_mean")), 6)
    described = neighbors.withColumn("mean_gap", gap)
    orders = {
        "similarity": F.col("similarity").desc(),
        "common": F.col("common_movies").desc(),
        "mean_gap": F.col("mean_gap").asc(),
    }
    if sort_by not in orders:
        raise ValueError(f"sort_by must be one of {sorted(orders)}")
    place = Window.partitionBy("targetId").orderBy(orders[sort_by], "userId")
    passed = described.filter(
        (F.col("similarity") >= min_similarity)
        & (F.col("common_movies") >= min_common)
        & F.col("rating_type").isin(*rating_types)
    )
    return passed.withColumn("rank", F.row_number().over(place)).orderBy("targetId", "rank")
