"""Every operator as a query over the order book in one folder.

The targets are user 10 and the most active user. The new-user profile ``-1``
holds the most active user's ratings, and that user is left out of its neighbours.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinrate.config import BROADCAST_ROWS, DEFAULTS
from kinrate.functions.labels import rating_type, similarity_band, stars
from kinrate.functions.scores import round_half_up
from kinrate.operators import cleaning, comparison, prediction, recommendation, similarity, stats
from kinrate.plans.batch import FINAL_RECOMMENDATIONS, run_batch
from kinrate.plans.comparing import Comparison
from kinrate.plans.maintained import MaintainedAverages, rating_changes
from kinrate.plans.prepared import (
    Prepared,
    Targets,
    all_pairs,
    find_similar_users,
    load_prepared,
    load_targets,
    nearest_of_all,
    pooled_similarities,
    popular_for,
    prepare,
    recommend,
    user_ids,
)
from kinrate.plans.profiles import NewUsers
from kinrate.plans.storage import new_path, shared_dir, stage
from kinrate.sources import files, orders

NEW_USER = -1
Query = Callable[[SparkSession, str], DataFrame]


# --- inputs -------------------------------------------------------------------


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return orders.raw_ratings(spark, folder)


# Where this application has stored the cleaned ratings of which files.
_STORED: dict[tuple, str] = {}


def prepared(spark: SparkSession, folder: str) -> Prepared:
    """Cleaned ratings and means, stored once for all queries of an application.

    They are used again only while the source files are the same by name, size
    and time, and while what was stored is still there.
    """
    key = (
        spark.sparkContext.applicationId,
        shared_dir(spark),
        folder,
        orders.fingerprint(spark, folder),
    )
    stored = load_prepared(spark, _STORED[key]) if key in _STORED else None
    if stored is None:
        place = new_path(spark, "prepared")
        stored = prepare(_raw(spark, folder), orders.RECENCY, folder=place)
        _STORED[key] = place
    return stored


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return prepared(spark, folder).ratings


def _averages(spark: SparkSession, folder: str) -> DataFrame:
    return prepared(spark, folder).averages


def _most_active(base: Prepared) -> DataFrame:
    return (
        base.averages.orderBy(F.col("num_ratings").desc(), "userId")
        .limit(1)
        .select(F.col("userId").alias("targetId"))
    )


def _target_ids(spark: SparkSession, base: Prepared) -> DataFrame:
    return user_ids(spark, [DEFAULTS.target_user]).union(_most_active(base)).distinct()


def _targets(spark: SparkSession, folder: str) -> Targets:
    base = prepared(spark, folder)
    return load_targets(base, _target_ids(spark, base))


def _similarities(spark: SparkSession, folder: str) -> DataFrame:
    return _targets(spark, folder).similarities()


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    targets = _targets(spark, folder)
    nearest = similarity.top_k_neighbors(targets.similarities())
    return targets.predictions(nearest)


def _recommendations(spark: SparkSession, folder: str, **options) -> DataFrame:
    base = prepared(spark, folder)
    items = orders.items(spark, folder)
    return recommend(base, _target_ids(spark, base), items, fallback=False, **options)


def _new_user(spark: SparkSession, folder: str) -> NewUsers:
    base = prepared(spark, folder)
    active = stage(_most_active(base), "most_active")
    profile = base.ratings.join(
        F.broadcast(active), base.ratings.userId == active.targetId
    ).select(F.lit(NEW_USER).cast("bigint").alias("profileId"), "movieId", "rating")
    others, by_user, means = (
        table.join(F.broadcast(active), table.userId == active.targetId, "left_anti")
        for table in (base.ratings, base.of_users(None), base.averages)
    )
    return NewUsers.load(Prepared(others, means, by_user), profile)


def _profile_predictions(spark: SparkSession, folder: str) -> tuple[NewUsers, DataFrame]:
    user = _new_user(spark, folder)
    return user, user.predictions(user.neighbors())


def _common(spark: SparkSession, folder: str) -> tuple[NewUsers, DataFrame]:
    user = _new_user(spark, folder)
    return user, user.targets.common_items()


def _titled(rows: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    items = orders.items(spark, folder).drop("genres")
    return recommendation.with_items(rows, items, title_fallback=True)


# --- sources and sinks --------------------------------------------------------


def ratings_load(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "ratings_csv")
    epoch = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', timestamp)")
    files.write_table(
        _raw(spark, folder).select("userId", "movieId", "rating", epoch.alias("timestamp")),
        path,
        "csv",
    )
    return files.read_ratings(spark, path).withColumn("rating", F.col("rating").cast("double"))


def items_load(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "items_csv")
    files.write_table(orders.items(spark, folder), path, "csv")
    return files.read_items(spark, path)


def _round_trip(fmt: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        path = new_path(spark, f"averages_{fmt}")
        files.write_table(_averages(spark, folder), path, fmt)
        return files.read_table(spark, path, files.AVERAGES, fmt)

    return query


# --- cleaning and profiles of the data ----------------------------------------


def clean_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_ratings(orders.dirty_ratings(spark, folder), recency=orders.RECENCY)


def clean_ratings_any_range(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.clean_ratings(
        orders.dirty_ratings(spark, folder), rating_range=None, recency=orders.RECENCY
    )


def cleaning_audit(spark: SparkSession, folder: str) -> DataFrame:
    return cleaning.cleaning_audit(orders.dirty_ratings(spark, folder), recency=orders.RECENCY)


def matrix_sample(spark: SparkSession, folder: str) -> DataFrame:
    ratings = prepared(spark, folder).ratings
    lowest = ratings.select("movieId").distinct().orderBy("movieId").limit(10)
    return stats.matrix_sample(ratings, [row.movieId for row in lowest.collect()])


def user_average_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.column_summary(_averages(spark, folder), "avg_rating", digits=6)


def maintained_averages(spark: SparkSession, folder: str) -> DataFrame:
    """User averages after three batches of changes, one of them sent twice.

    The first inserts the ratings of the order lines up to 4, the second what all lines change,
    and the third takes out the ratings of 0.5.
    """
    raw = stage(_raw(spark, folder), "raw")
    steps = [
        cleaning.clean_ratings(rows, recency=orders.RECENCY, rating_range=kept)
        for rows, kept in (
            (raw.filter("lineId <= 4"), cleaning.VALID_RANGE),
            (raw, cleaning.VALID_RANGE),
            (raw, (1.0, 5.0)),
        )
    ]
    versions = [stage(step, "version") for step in steps]
    store = MaintainedAverages(spark, new_path(spark, "averages"))
    for name, old, new in (
        ("insert", versions[0].limit(0), versions[0]),
        ("revise", versions[0], versions[1]),
        ("revise", versions[0], versions[1]),
        ("remove", versions[1], versions[2]),
    ):
        store.commit(name, rating_changes(old, new))
    return store.averages()


def rating_type_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return stats.value_counts(
        _averages(spark, folder), rating_type(F.col("avg_rating")), "rating_type"
    )


def star_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return _averages(spark, folder).select("userId", stars(F.col("avg_rating")).alias("stars"))


# --- similarity ---------------------------------------------------------------


def target_ratings(spark: SparkSession, folder: str) -> DataFrame:
    seen = _targets(spark, folder).profiles
    return seen.select("targetId", "movieId", F.col("target_rating").alias("rating"))


def pearson_pooled(spark: SparkSession, folder: str) -> DataFrame:
    base = prepared(spark, folder)
    return pooled_similarities(base, _target_ids(spark, base))


def top_k_neighbors_above(spark: SparkSession, folder: str) -> DataFrame:
    base = prepared(spark, folder)
    return find_similar_users(base, _target_ids(spark, base), min_similarity=0.0)


# Raters from which items of the skewed ratings are deferred: at every scale, those that all rate.
SKEWED_RATERS = 100


def _skewed(spark: SparkSession, folder: str) -> Prepared:
    ratings = stage(orders.skewed_ratings(_clean(spark, folder)), "skewed")
    return Prepared(ratings, stage(stats.user_averages(ratings), "skewed_averages"))


def co_rated_counts_skewed(spark: SparkSession, folder: str) -> DataFrame:
    """Shared items of the most active users with everybody, where some items are everybody's."""
    base = _skewed(spark, folder)
    order = [F.col("num_ratings").desc(), F.col("userId")]
    most = base.averages.orderBy(*order).limit(20).select(F.col("userId").alias("targetId"))
    return load_targets(base, most, SKEWED_RATERS).co_rated_counts(min_common=5)


def all_pairs_skewed(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest users of every user, where some items are everybody's."""
    return nearest_of_all(_skewed(spark, folder), 10, min_common=5, large_raters=SKEWED_RATERS)


def similarity_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.column_summary(
        _similarities(spark, folder), "similarity", by=["targetId"], digits=6
    )


def similarity_band_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return stats.value_counts(
        _similarities(spark, folder), similarity_band(F.col("similarity")), "band", ["targetId"]
    )


# --- prediction and recommendation --------------------------------------------


def unseen_items(spark: SparkSession, folder: str) -> DataFrame:
    targets = _targets(spark, folder)
    nearest = similarity.top_k_neighbors(targets.similarities())
    return targets.unseen_items(nearest)


def prediction_stats(spark: SparkSession, folder: str) -> DataFrame:
    return stats.column_summary(
        _predictions(spark, folder), "predicted_rating", by=["targetId"], digits=6
    )


def user_favorites(spark: SparkSession, folder: str) -> DataFrame:
    base = prepared(spark, folder)
    ids = stage(_target_ids(spark, base), "targets")
    return recommendation.user_favorites(base.ratings, ids, orders.items(spark, folder))


def popular_items(spark: SparkSession, folder: str) -> DataFrame:
    popular = recommendation.popular_items(_clean(spark, folder), orders.items(spark, folder))
    return popular.withColumn("avg_rating", round_half_up(F.col("avg_rating"), 6))


def _everybody(base: Prepared) -> DataFrame:
    return base.averages.select(F.col("userId").alias("targetId"))


def cold_start_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """Popular items for every user who has no neighbour."""
    base = prepared(spark, folder)
    targets = load_targets(base, _everybody(base))
    near = targets.co_rated_counts().select("targetId").distinct()
    return popular_for(base, _everybody(base), near, targets.seen, orders.items(spark, folder))


def recommendations_for_everybody(spark: SparkSession, folder: str) -> DataFrame:
    """Best unseen items of every user; popular ones for those without neighbours."""
    base = prepared(spark, folder)
    return recommend(base, _everybody(base), orders.items(spark, folder))


def staged_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    raw = _raw(spark, folder)
    ids = stage(_target_ids(spark, prepared(spark, folder)), "targets")
    tables = run_batch(
        raw, ids, new_path(spark, "batch"), orders.items(spark, folder), orders.RECENCY
    )
    return tables[FINAL_RECOMMENDATIONS]


# --- new users ----------------------------------------------------------------


def profile_summary(spark: SparkSession, folder: str) -> DataFrame:
    profile = _new_user(spark, folder).targets.profiles
    return recommendation.profile_summary(
        profile.select(
            F.col("targetId").alias("profileId"), "movieId", F.col("target_rating").alias("rating")
        ),
        digits=6,
    )


def profile_favorites(spark: SparkSession, folder: str) -> DataFrame:
    return _new_user(spark, folder).favorites(orders.items(spark, folder))


def profile_neighbors(spark: SparkSession, folder: str) -> DataFrame:
    return (
        _new_user(spark, folder)
        .neighbors()
        .withColumn("similarity", round_half_up(F.col("similarity"), 6))
        .drop("target_mean")
    )


def profile_predictions(spark: SparkSession, folder: str) -> DataFrame:
    _, predicted = _profile_predictions(spark, folder)
    return predicted.drop("target_mean", "contributors")


def explain_predictions(spark: SparkSession, folder: str) -> DataFrame:
    _, predicted = _profile_predictions(spark, folder)
    return prediction.explain_contributors(predicted)


def explain_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    user, predicted = _profile_predictions(spark, folder)
    return prediction.explain_contributors(user.recommendations(predicted))


def profile_recommendations(spark: SparkSession, folder: str) -> DataFrame:
    user, predicted = _profile_predictions(spark, folder)
    return user.recommendations(predicted, orders.items(spark, folder)).select(
        "targetId", "rank", "movieId", "title", "predicted_rating", "num_contributors"
    )


def profile_confidence(spark: SparkSession, folder: str) -> DataFrame:
    _, predicted = _profile_predictions(spark, folder)
    return prediction.confidence_distribution(predicted, "num_contributors")


# --- comparing and exploring --------------------------------------------------


def user_profile(spark: SparkSession, folder: str) -> DataFrame:
    base = prepared(spark, folder)
    return recommendation.user_profiles(
        base.ratings, base.averages, orders.items(spark, folder), title_fallback=True
    )


def compare_common_items(spark: SparkSession, folder: str) -> DataFrame:
    return _common(spark, folder)[1].drop("target_mean")


def compare_users(spark: SparkSession, folder: str) -> DataFrame:
    user, common = _common(spark, folder)
    return comparison.compare_users(common, user.targets.prepared.averages)


def compare_agreement_lists(spark: SparkSession, folder: str) -> DataFrame:
    return _titled(comparison.agreement_lists(_common(spark, folder)[1]), spark, folder)


def compare_disagreements(spark: SparkSession, folder: str) -> DataFrame:
    return _titled(comparison.biggest_disagreements(_common(spark, folder)[1]), spark, folder)


def rating_regression(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.rating_regression(_common(spark, folder)[1])


def loved_unseen(spark: SparkSession, folder: str) -> DataFrame:
    user = _new_user(spark, folder)
    pairs = stage(user.neighbors().select("targetId", "userId"), "neighbors")
    few = pairs.count() <= BROADCAST_ROWS
    loved = comparison.loved_unseen(
        user.targets.prepared.ratings, user.targets.profiles, pairs, broadcast_pairs=few
    )
    return _titled(loved, spark, folder)


def compare_chosen_users(spark: SparkSession, folder: str) -> DataFrame:
    """User 10 with the users of most ratings, by the public call for chosen pairs."""
    base = prepared(spark, folder)
    order = [F.col("num_ratings").desc(), F.col("userId")]
    most = base.averages.orderBy(*order).limit(20).select("userId")
    pairs = most.withColumn("targetId", F.lit(DEFAULTS.target_user).cast("bigint"))
    return Comparison.of_users(base, pairs, orders.items(spark, folder)).summary(min_common=1)


def _explore(sort_by: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        found = comparison.explore_neighbors(
            _new_user(spark, folder).neighbors(), min_common=3, sort_by=sort_by
        )
        return found.drop("target_mean").withColumn(
            "similarity", round_half_up(F.col("similarity"), 6)
        )

    return query


def similarity_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """All positive similarities of the new user, twenty bins on 0..1."""
    return stats.histogram(_new_user(spark, folder).neighbors(k=None), "similarity", 0.0, 1.0)


QUERIES: dict[str, Query] = {
    "ratings_load": ratings_load,
    "items_load": items_load,
    "stage_csv": _round_trip("csv"),
    "stage_parquet": _round_trip("parquet"),
    "stage_json": _round_trip("json"),
    "clean_ratings": clean_ratings,
    "clean_ratings_any_range": clean_ratings_any_range,
    "cleaning_audit": cleaning_audit,
    "dataset_stats": lambda s, d: stats.dataset_stats(_raw(s, d)),
    "rating_distribution": lambda s, d: stats.rating_distribution(_raw(s, d)),
    "matrix_info": lambda s, d: stats.matrix_info(_clean(s, d)),
    "matrix_sample": matrix_sample,
    "user_averages": lambda s, d: stats.user_averages(_clean(s, d)),
    "maintained_averages": maintained_averages,
    "user_average_stats": user_average_stats,
    "top_bottom_users": lambda s, d: stats.top_bottom_users(_averages(s, d)),
    "eligible_users": lambda s, d: stats.eligible_users(_averages(s, d)),
    "rating_type_distribution": rating_type_distribution,
    "star_ratings": star_ratings,
    "target_ratings": target_ratings,
    "co_rated_counts": lambda s, d: _targets(s, d).co_rated_counts(),
    "top_overlap_users": lambda s, d: similarity.top_overlap_users(
        _targets(s, d).co_rated_counts()
    ),
    "pearson_neighbors": _similarities,
    "pearson_pooled": pearson_pooled,
    "all_pairs_similarity": lambda s, d: all_pairs(prepared(s, d)),
    "co_rated_counts_skewed": co_rated_counts_skewed,
    "all_pairs_skewed": all_pairs_skewed,
    "similarity_stats": similarity_stats,
    "similarity_extremes": lambda s, d: similarity.similarity_extremes(_similarities(s, d)),
    "similarity_band_distribution": similarity_band_distribution,
    "top_k_neighbors": lambda s, d: similarity.top_k_neighbors(_similarities(s, d)),
    "top_k_neighbors_above": top_k_neighbors_above,
    "unseen_items": unseen_items,
    "predicted_ratings": _predictions,
    "prediction_stats": prediction_stats,
    "prediction_distribution": lambda s, d: prediction.prediction_distribution(
        _predictions(s, d)
    ),
    "top_predictions": lambda s, d: prediction.top_predictions(_predictions(s, d)),
    "confidence_distribution": lambda s, d: prediction.confidence_distribution(
        _predictions(s, d)
    ),
    "top_n_recommendations": _recommendations,
    "top_n_recommendations_above": lambda s, d: _recommendations(s, d, n=10, min_prediction=3.5),
    "staged_recommendations": staged_recommendations,
    "user_favorites": user_favorites,
    "popular_items": popular_items,
    "cold_start_fallback": cold_start_fallback,
    "recommendations_for_everybody": recommendations_for_everybody,
    "profile_summary": profile_summary,
    "profile_favorites": profile_favorites,
    "profile_neighbors": profile_neighbors,
    "profile_predictions": profile_predictions,
    "explain_predictions": explain_predictions,
    "explain_recommendations": explain_recommendations,
    "profile_recommendations": profile_recommendations,
    "profile_confidence": profile_confidence,
    "user_profile": user_profile,
    "compare_common_items": compare_common_items,
    "compare_users": compare_users,
    "compare_chosen_users": compare_chosen_users,
    "compare_agreement_lists": compare_agreement_lists,
    "compare_disagreements": compare_disagreements,
    "rating_regression": rating_regression,
    "loved_unseen": loved_unseen,
    "explore_neighbors": _explore("similarity"),
    "explore_neighbors_by_common": _explore("common"),
    "explore_neighbors_by_mean_gap": _explore("mean_gap"),
    "similarity_histogram": similarity_histogram,
}
