"""Ranked recommendations, favourites and popular items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kinrate.config import DEFAULTS, RANK_BLOCK
from kinrate.functions.labels import rating_type, title_or_default
from kinrate.functions.scores import round_half_up
from kinrate.operators.joins import join_side, top_per
from kinrate.operators.similarity import target_ratings
from kinrate.operators.stats import item_popularity


def with_items(
    ranked: DataFrame, items: DataFrame | None, title_fallback: bool = False
) -> DataFrame:
    """Add the item columns to ranked rows, keeping rows without any.

    Looked up after ranking, so that only the few ranked rows meet the items;
    ``rank`` keeps their order through the join.
    """
    if items is not None:
        ranked = ranked.join(items, "movieId", "left")
    if title_fallback:
        title = F.col("title") if items is not None else F.lit(None).cast("string")
        ranked = ranked.withColumn("title", title_or_default(title, F.col("movieId")))
    return ranked


def top_n(
    predictions: DataFrame,
    items: DataFrame | None = None,
    n: int = DEFAULTS.recommendations,
    min_prediction: float | None = None,
    title_fallback: bool = False,
    raters: str | None = "num_raters",
) -> DataFrame:
    """Each target's ``n`` best predictions, with ``rank`` and item columns.

    Ties go to the item with more raters (where ``raters`` names them), then to
    the lower item id. ``min_prediction`` leaves out lower predictions.
    """
    if min_prediction is not None:
        predictions = predictions.filter(F.col("predicted_rating") >= min_prediction)
    order: list[Column] = [F.col("predicted_rating").desc_nulls_last()]
    if raters is not None:
        order.append(F.col(raters).desc())
    order.append(F.col("movieId").asc())
    return with_items(top_per(predictions, ["targetId"], order, n), items, title_fallback)


def user_favorites(
    ratings: DataFrame,
    targets: DataFrame,
    items: DataFrame | None = None,
    n: int = 10,
    title_fallback: bool = False,
) -> DataFrame:
    """Each target's ``n`` highest own ratings."""
    best = top_per(
        target_ratings(ratings, targets),
        ["targetId"],
        [F.col("rating").desc(), F.col("movieId")],
        n,
    )
    return with_items(best, items, title_fallback)


def user_profiles(
    ratings: DataFrame,
    averages: DataFrame,
    items: DataFrame | None = None,
    n: int = 5,
    title_fallback: bool = False,
) -> DataFrame:
    """Mean, count, rating type and the ``n`` best items of every user given.

    ``averages`` selects the users; one row per user and listed item.
    """
    best = top_per(
        ratings.select("userId", "movieId", "rating"),
        ["userId"],
        [F.col("rating").desc(), F.col("movieId")],
        n,
    )
    described = averages.select(
        "userId",
        "avg_rating",
        "num_ratings",
        rating_type(F.col("avg_rating")).alias("rating_type"),
    )
    return with_items(described.join(best, "userId"), items, title_fallback)


def popular_items(
    ratings: DataFrame,
    items: DataFrame | None = None,
    n: int = 30,
    title_fallback: bool = False,
) -> DataFrame:
    """The ``n`` most-rated items with their unrounded means."""
    order = [F.col("num_ratings").desc(), F.col("movieId")]
    return with_items(top_per(item_popularity(ratings), (), order, n), items, title_fallback)


def free_ranks(
    cold: DataFrame, seen_ranks: DataFrame, n: int, block_ranks: int = RANK_BLOCK
) -> DataFrame:
    """The ``n`` lowest ranks that each target's seen items leave free: ``targetId, place, rank``.

    ``cold`` has ``targetId, num_ratings`` and ``seen_ranks`` the ranks ``place`` of seen
    items, other targets' too. m seen items leave n of the first m + n ranks free. These are
    looked at in blocks: a block's seen ranks are an array of at most ``block_ranks``,
    and what it lacks is free. So a target has one row for each block, mostly one in all,
    and neither a target with very many ratings nor a rank that everybody is
    offered comes together in one group.
    """
    reach = F.floor((F.col("num_ratings") + (n - 1)) / block_ranks)
    marks = cold.select(
        "targetId",
        F.explode(F.sequence(F.lit(0).cast("bigint"), reach)).alias("block"),
        F.lit(None).cast("bigint").alias("place"),
    )
    held = seen_ranks.select(
        "targetId", F.floor((F.col("place") - 1) / block_ranks).alias("block"), "place"
    )
    first = F.col("block") * block_ranks
    free = F.array_except(F.sequence(first + 1, first + block_ranks), F.col("held"))
    blocks = (
        marks.unionByName(held)
        .groupBy("targetId", "block")
        .agg(F.collect_list("place").alias("held"), F.count_if(F.col("place").isNull()).alias("marks"))
        .filter(F.col("marks") > 0)
    )
    places = blocks.select("targetId", F.explode(F.slice(free, 1, n)).alias("place"))
    return top_per(places, ["targetId"], [F.col("place")], n)


def cold_start_items(
    cold: DataFrame,
    seen: DataFrame,
    popular: DataFrame,
    n: int = DEFAULTS.recommendations,
    broadcast_popular: bool = False,
    block_ranks: int = RANK_BLOCK,
) -> DataFrame:
    """Popular items that a target without neighbours has not rated.

    ``cold`` has ``targetId, num_ratings`` and ``popular`` the item columns with a
    ``rank`` from 1. A target's seen items are looked up for their ranks, the ranks they
    leave free are found without the popular items (:func:`free_ranks`), and only those n a target
    are looked up again. ``popular`` must reach rank m + n for the m ratings of any target.
    ``broadcast_popular`` states that its size was checked.
    """
    places = popular.select("movieId", F.col("rank").cast("bigint").alias("place"))
    seen_ranks = join_side(
        seen.select("targetId", "movieId"), places, "movieId", "targetId", "movieId", broadcast_popular
    ).select("targetId", "place")
    offered = popular.withColumn("place", F.col("rank").cast("bigint")).drop("rank")
    free = free_ranks(cold, seen_ranks, n, block_ranks)
    found = join_side(free, offered, "place", "targetId", "movieId", broadcast_popular)
    return found.select("targetId", *[c for c in popular.columns if c != "rank"], "rank")


def one_rating_per_item(profiles: DataFrame) -> DataFrame:
    """New-user profiles with the highest rating of each repeated item."""
    return profiles.groupBy("profileId", "movieId").agg(F.max("rating").alias("rating"))


def profile_summary(profiles: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean and size of each new-user profile, with its rating type.

    The mean is not rounded unless asked: a new user's similarity uses it as is. Of an
    item that a profile repeats, the highest rating counts.
    """
    profiles = one_rating_per_item(profiles)
    mean = F.avg(F.col("rating").cast("double"))
    return profiles.groupBy("profileId").agg(
        round_half_up(mean, digits).alias("avg_rating"),
        F.count(F.lit(1)).alias("num_ratings"),
        rating_type(mean).alias("rating_type"),
    )
