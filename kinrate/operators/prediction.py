"""Predicted ratings for items that a target has not rated.

``neighbors`` has ``targetId, userId, similarity``; ``seen`` has
``targetId, movieId``. Both may cover any number of targets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinrate.config import DEFAULTS, SHARE_ROWS, SIDE_ROWS
from kinrate.functions.labels import confidence_band
from kinrate.functions.scores import clamp, round_half_up
from kinrate.operators.joins import join_side, top_per

RATING_RANGE = (DEFAULTS.rating_low, DEFAULTS.rating_high)
ITEM = ("targetId", "movieId")


def _unseen(candidates: DataFrame, seen: DataFrame, broadcast_seen: bool) -> DataFrame:
    """Drop what the target has rated.

    Applied to rows already grouped on the join keys: without a broadcast the
    left side needs no further shuffle.
    """
    seen = seen.select(*ITEM)
    return candidates.join(F.broadcast(seen) if broadcast_seen else seen, list(ITEM), "left_anti")


def _neighbor_ratings(
    ratings: DataFrame,
    neighbors: DataFrame,
    broadcast_neighbors: bool,
    share_rows: int,
    side_rows: int,
) -> DataFrame:
    return join_side(
        ratings.select("userId", "movieId", "rating"),
        neighbors,
        "userId",
        "movieId",
        "targetId",
        broadcast_neighbors,
        share_rows,
        side_rows,
    )


def unseen_items(
    ratings: DataFrame,
    neighbors: DataFrame,
    seen: DataFrame,
    broadcast_neighbors: bool = False,
    broadcast_seen: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
) -> DataFrame:
    """Items that some neighbour of the target rated and the target did not."""
    rated = _neighbor_ratings(
        ratings,
        neighbors.select("targetId", "userId"),
        broadcast_neighbors,
        share_rows,
        side_rows,
    )
    return _unseen(rated.select(*ITEM).distinct(), seen, broadcast_seen)


def _with_means(
    neighbors: DataFrame, averages: DataFrame, means: DataFrame, broadcast_neighbors: bool
) -> DataFrame:
    """Neighbours with their own mean and their target's.

    Both are joined to the neighbours, a few rows per target, and not to ratings
    or predictions, all of which may belong to one target.
    """
    wanted = neighbors.select("targetId", "userId", "similarity").join(means, "targetId")
    own = averages.select("userId", F.col("avg_rating").alias("user_mean"))
    return own.join(F.broadcast(wanted) if broadcast_neighbors else wanted, "userId")


def _predicted(mean: Column, weighted: Column, weights: Column, value_range, digits) -> Column:
    """Mean plus weighted deviation; NULL where all weights are 0."""
    return round_half_up(clamp(mean + F.try_divide(weighted, weights), *value_range), digits)


def predict_ratings(
    ratings: DataFrame,
    averages: DataFrame,
    neighbors: DataFrame,
    means: DataFrame,
    seen: DataFrame,
    digits: int | None = DEFAULTS.rating_digits,
    value_range: tuple[float, float] = RATING_RANGE,
    drop_undefined: bool = False,
    broadcast_neighbors: bool = False,
    broadcast_seen: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
) -> DataFrame:
    """Predicted rating per target and unseen item.

    ``means`` has ``targetId, target_mean``. Neighbours' means are joined to the
    neighbours, not to their ratings, and the weighted sum is taken per item in
    one aggregation. An item whose neighbours all have similarity 0 is NULL, or
    left out with ``drop_undefined``.
    """
    deviation = F.col("rating") - F.col("user_mean")
    sums = (
        _neighbor_ratings(
            ratings,
            _with_means(neighbors, averages, means, broadcast_neighbors),
            broadcast_neighbors,
            share_rows,
            side_rows,
        )
        .groupBy(*ITEM)
        .agg(
            F.sum(F.col("similarity") * deviation).alias("weighted"),
            F.sum(F.abs("similarity")).alias("weights"),
            F.count(F.lit(1)).alias("num_raters"),
            F.avg("similarity").alias("mean_similarity"),
            F.max("target_mean").alias("target_mean"),
        )
    )
    predicted = _unseen(sums, seen, broadcast_seen).select(
        *ITEM,
        _predicted(
            F.col("target_mean"), F.col("weighted"), F.col("weights"), value_range, digits
        ).alias("predicted_rating"),
        "num_raters",
        round_half_up(F.col("mean_similarity"), 4).alias("avg_similarity"),
    )
    return predicted.filter(F.col("predicted_rating").isNotNull()) if drop_undefined else predicted


def profile_predictions(
    ratings: DataFrame,
    averages: DataFrame,
    neighbors: DataFrame,
    means: DataFrame,
    seen: DataFrame,
    max_contributors: int = DEFAULTS.max_contributors,
    explain: int = DEFAULTS.explained_contributors,
    digits: int | None = DEFAULTS.rating_digits,
    value_range: tuple[float, float] = RATING_RANGE,
    broadcast_neighbors: bool = False,
    broadcast_seen: bool = False,
    share_rows: int = SHARE_ROWS,
    side_rows: int = SIDE_ROWS,
) -> DataFrame:
    """Predictions with the neighbours that moved each one most.

    Only a target's ``max_contributors`` most similar neighbours count, which
    also bounds the list gathered per item. Undefined predictions are left out.
    """
    nearest = top_per(
        neighbors.select("targetId", "userId", "similarity"),
        ["targetId"],
        [F.col("similarity").desc(), F.col("userId")],
        max_contributors,
        "_place",
    ).drop("_place")
    rated = _neighbor_ratings(
        ratings,
        _with_means(nearest, averages, means, broadcast_neighbors),
        broadcast_neighbors,
        share_rows,
        side_rows,
    ).withColumn("contribution", F.col("similarity") * (F.col("rating") - F.col("user_mean")))
    contributor = F.struct(
        # Ordered as a struct: largest effect first, then the lower user id. The
        # effect is rounded for the order, so that noise cannot swap two users.
        (-F.abs(round_half_up(F.col("contribution"), 10))).alias("order"),
        "userId",
        "similarity",
        F.col("rating").cast("double").alias("rating"),
        F.col("user_mean").alias("avg_rating"),
        "contribution",
    )
    sums = rated.groupBy(*ITEM).agg(
        F.sum("contribution").alias("weighted"),
        F.sum(F.abs("similarity")).alias("weights"),
        F.count(F.lit(1)).alias("num_contributors"),
        F.sort_array(F.collect_list(contributor)).alias("all"),
        F.max("target_mean").alias("target_mean"),
    )
    return (
        _unseen(sums, seen, broadcast_seen)
        .select(
            *ITEM,
            _predicted(
                F.col("target_mean"), F.col("weighted"), F.col("weights"), value_range, digits
            ).alias("predicted_rating"),
            "num_contributors",
            "target_mean",
            F.transform(
                F.slice("all", 1, explain),
                lambda c: F.struct(
                    *[
                        c[name].alias(name)
                        for name in ("userId", "similarity", "rating", "avg_rating", "contribution")
                    ]
                ),
            ).alias("contributors"),
        )
        .filter(F.col("predicted_rating").isNotNull())
    )


def explain_contributors(predictions: DataFrame) -> DataFrame:
    """One row per prediction and listed contributor, in order of effect.

    ``adjustment`` is what the neighbours together add to the target's mean.
    """
    return predictions.select(
        *ITEM,
        "predicted_rating",
        "num_contributors",
        round_half_up(F.col("predicted_rating") - F.col("target_mean"), 4).alias("adjustment"),
        F.posexplode("contributors").alias("position", "c"),
    ).select(
        *ITEM,
        "predicted_rating",
        "num_contributors",
        "adjustment",
        (F.col("position") + 1).alias("position"),
        "c.userId",
        round_half_up(F.col("c.similarity"), 4).alias("similarity"),
        "c.rating",
        "c.avg_rating",
        round_half_up(F.col("c.contribution"), 4).alias("contribution"),
    )


def top_predictions(predictions: DataFrame, n: int = 20) -> DataFrame:
    """The highest predictions of each target."""
    order = [F.col("predicted_rating").desc_nulls_last(), F.col("movieId")]
    return top_per(predictions, ["targetId"], order, n)


def prediction_distribution(predictions: DataFrame, n: int = 20) -> DataFrame:
    """Items per predicted value and target, for the ``n`` highest values."""
    counts = predictions.groupBy("targetId", "predicted_rating").agg(
        F.count(F.lit(1)).alias("count")
    )
    return top_per(counts, ["targetId"], [F.col("predicted_rating").desc_nulls_last()], n)


def confidence_distribution(predictions: DataFrame, raters: str = "num_raters") -> DataFrame:
    """Predictions per confidence band and target."""
    return predictions.groupBy(
        "targetId", confidence_band(F.col(raters)).alias("confidence")
    ).agg(F.count(F.lit(1)).alias("count"))
