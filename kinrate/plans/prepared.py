"""Cleaned ratings and targets as stage tables, shared by all later steps."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kinrate.config import (
    BROADCAST_ROWS,
    DEFAULTS,
    FEW_TARGETS,
    LARGE_RATERS,
    LOOKUP_IDS,
    PAIR_ROWS,
    PREDICTION_VALUES,
    ROUND_VALUES,
    ROUND_VALUES_EACH,
    ROW_GROUP_BYTES,
)
from kinrate.operators.cleaning import VALID_RANGE, clean_ratings
from kinrate.operators.comparison import common_items
from kinrate.operators.joins import one_of, sorted_by
from kinrate.operators.prediction import predict_ratings, profile_predictions, unseen_items
from kinrate.operators.recommendation import (
    cold_start_items,
    one_rating_per_item,
    popular_items,
    top_n,
    with_items,
)
from kinrate.operators.similarity import (
    Found,
    co_rated_counts,
    co_rated_counts_of_all,
    item_totals,
    large_items,
    pearson_neighbors,
    pearson_of_all,
    pearson_pooled,
    similarity_matrix,
    target_means,
    target_profiles,
    top_k_join,
    top_k_neighbors,
)
from kinrate.operators.stats import user_averages
from kinrate.plans.storage import (
    committed,
    few_rows,
    new_path,
    read_stage,
    rows_of,
    scratch,
    stage,
    stage_parts,
    staged,
)
from kinrate.sources.files import AVERAGES, read_table

# Names of the stored tables.
RATINGS_CLEAN = "ratings_clean"
RATINGS_BY_USER = "ratings_by_user"
USER_AVERAGES = "user_averages"


@dataclass(frozen=True)
class Prepared:
    """Cleaned ratings and user means, both stored.

    ``ratings`` stand in order of items. ``by_user`` has the same rows in order of users,
    if they were stored that way, too.
    """

    ratings: DataFrame
    averages: DataFrame
    by_user: DataFrame | None = None

    def of_items(self, ids: Sequence[int] | None) -> DataFrame:
        """Ratings of the given items, of which scans read only their row groups; None: all."""
        return self.ratings if ids is None else self.ratings.filter(one_of("movieId", ids))

    def of_users(self, ids: Sequence[int] | None) -> DataFrame:
        """Ratings of the given users, likewise; None: of all, in order of users."""
        rows = self.ratings if self.by_user is None else self.by_user
        return rows if ids is None else rows.filter(one_of("userId", ids))


def few_ids(table: DataFrame, column: str) -> list[int] | None:
    """The distinct ids of a stored table of at most LOOKUP_IDS rows, else None."""
    if rows_of(table) > LOOKUP_IDS:
        return None
    return [r[0] for r in table.select(column).distinct().collect()]


def prepare(
    raw: DataFrame,
    recency: Sequence[str] = ("timestamp",),
    rating_range: tuple[float, float] | None = VALID_RANGE,
    folder: str | None = None,
) -> Prepared:
    """Clean once and store; everything else reads the stored tables.

    Ratings are stored twice, in order of items and of users. Without a ``folder`` the
    tables go to a new one in the shared folder.
    """
    folder = folder or new_path(raw.sparkSession, "prepared")
    size = {"parquet.block.size": ROW_GROUP_BYTES}
    with scratch():
        clean = stage(clean_ratings(raw, rating_range, recency), "clean")
        ratings = stage(sorted_by(clean, "movieId", "userId"), RATINGS_CLEAN, folder, **size)
        by_user = stage(sorted_by(clean, "userId", "movieId"), RATINGS_BY_USER, folder, **size)
    return Prepared(ratings, stage(user_averages(by_user), USER_AVERAGES, folder), by_user)


def load_prepared(spark: SparkSession, folder: str) -> Prepared | None:
    """What :func:`prepare` or a batch run has stored in ``folder``; None if it is not there.

    Tables count only if they were published by a manifest, or committed by Spark.
    """

    def load(name: str, schema: str | None = None) -> DataFrame | None:
        path = f"{folder}/{name}"
        table = read_stage(spark, path)
        return read_table(spark, path, schema) if table is None and committed(spark, path) else table

    ratings, averages = load(RATINGS_CLEAN), load(USER_AVERAGES, AVERAGES)
    if ratings is None or averages is None:
        return None
    return Prepared(ratings, averages, load(RATINGS_BY_USER))


@dataclass(frozen=True)
class Targets:
    """Targets with their ratings, stored, and whether these may be broadcast.

    ``large`` lists popular items, where there are many targets and such items.
    ``items`` lists the rated ones, where they are few. ``everybody`` says that the
    targets' ratings are all ratings, so that pairs of targets and users come both ways round.
    """

    prepared: Prepared
    profiles: DataFrame
    means: DataFrame
    count: int
    small: bool
    large: DataFrame | None = None
    items: list[int] | None = None
    everybody: bool = False

    @property
    def shared(self) -> DataFrame:
        """All ratings that may be of an item that some target rated."""
        return self.prepared.of_items(self.items)

    @property
    def seen(self) -> DataFrame:
        return self.profiles.select("targetId", "movieId")

    @property
    def few(self) -> bool:
        """Whether the targets themselves are few enough to be broadcast."""
        return self.count <= BROADCAST_ROWS

    def few_neighbors(self, k: int | None) -> bool:
        """Whether a cut to k rows per target leaves few enough to be broadcast."""
        return k is not None and self.count * k <= BROADCAST_ROWS

    def common_items(self, users: DataFrame | Sequence[int] | None = None) -> DataFrame:
        """Items that the targets share with the chosen users, or with everybody."""
        ratings = self.shared
        if users is not None:
            chosen = _as_targets(self.prepared, users).select(F.col("targetId").alias("userId"))
            ratings = ratings.join(chosen, "userId", "left_semi")
        return common_items(ratings, self.profiles, broadcast_left=self.small)

    def co_rated_counts(self, min_common: int = DEFAULTS.min_common) -> DataFrame:
        if self.everybody:
            return co_rated_counts_of_all(
                self.prepared.ratings, min_common, self.large, **BY_ROUNDS
            )
        return co_rated_counts(
            self.shared,
            self.profiles,
            min_common,
            self.large,
            broadcast_profiles=self.small,
            **BY_ROUNDS,
        )

    def similarities(self, **options) -> DataFrame:
        if self.everybody and not self.small:
            return pearson_of_all(
                self.prepared.ratings,
                self.prepared.averages,
                large=self.large,
                **BY_ROUNDS,
                **options,
            )
        return pearson_neighbors(
            self.shared,
            self.prepared.averages,
            self.profiles,
            large=self.large,
            broadcast_profiles=self.small,
            **BY_ROUNDS,
            **options,
        )

    def unseen_items(self, neighbors: DataFrame) -> DataFrame:
        near = staged(neighbors, "neighbors")
        return unseen_items(
            self.prepared.of_users(few_ids(near, "userId")),
            near,
            self.seen,
            broadcast_neighbors=few_rows(near),
            broadcast_seen=self.small,
        )

    def predictions(self, neighbors: DataFrame, stored: bool = False, **options) -> DataFrame:
        """Predictions from neighbours, which are stored first unless they are ``stored`` already."""
        near = neighbors if stored else staged(neighbors, "neighbors")
        return predict_ratings(
            self.prepared.of_users(few_ids(near, "userId")),
            self.prepared.averages,
            near,
            self.means,
            self.seen,
            broadcast_neighbors=few_rows(near),
            broadcast_seen=self.small,
            **options,
        )

    def explained_predictions(self, neighbors: DataFrame, **options) -> DataFrame:
        near = staged(neighbors, "neighbors")
        return profile_predictions(
            self.prepared.of_users(few_ids(near, "userId")),
            self.prepared.averages,
            near,
            self.means,
            self.seen,
            broadcast_neighbors=few_rows(near),
            broadcast_seen=self.small,
            **options,
        )


def _large_items(ratings: DataFrame, large_raters: int = LARGE_RATERS) -> DataFrame | None:
    large = stage(large_items(ratings, large_raters), "large_items")
    return large if rows_of(large) else None


def _checked(
    prepared: Prepared,
    profiles: DataFrame,
    means: DataFrame,
    count: int,
    large_raters: int = LARGE_RATERS,
    everybody: bool = False,
) -> Targets:
    large = _large_items(prepared.ratings, large_raters) if count > FEW_TARGETS else None
    items = few_ids(profiles, "movieId")
    return Targets(prepared, profiles, means, count, few_rows(profiles), large, items, everybody)


def load_targets(
    prepared: Prepared, targets: DataFrame, large_raters: int = LARGE_RATERS
) -> Targets:
    """Store the targets' means and ratings and check their sizes.

    ``targets`` has one column ``targetId``; any number of rows. With many, items that
    more than ``large_raters`` users rated are deferred.
    """
    wanted = targets.select("targetId").distinct()
    means = stage(target_means(prepared.averages, wanted), "target_means")
    count = rows_of(means)
    profiles = stage(
        target_profiles(
            prepared.of_users(few_ids(means, "targetId")),
            means,
            broadcast_targets=count <= BROADCAST_ROWS,
        ),
        "target_profiles",
    )
    # each rating is at most once among those of the targets
    everybody = count > FEW_TARGETS and rows_of(profiles) == rows_of(prepared.ratings)
    return _checked(prepared, profiles, means, count, large_raters, everybody)


def load_profiles(
    prepared: Prepared, profiles: DataFrame, min_size: int = DEFAULTS.min_profile_size
) -> Targets:
    """New-user profiles as targets: one row ``profileId, movieId, rating`` per item.

    A rating of 0 means not rated; of a repeated item the highest rating counts. Profiles
    of fewer than ``min_size`` ratings are left out. Means are those of the profile, unrounded.
    """
    rated = one_rating_per_item(profiles.filter(F.col("rating") > 0))
    means = stage(
        rated.groupBy(F.col("profileId").alias("targetId"))
        .agg(
            F.avg(F.col("rating").cast("double")).alias("target_mean"),
            F.count(F.lit(1)).alias("size"),
        )
        .filter(F.col("size") >= min_size)
        .drop("size"),
        "profile_means",
    )
    rows = stage(
        rated.withColumnRenamed("profileId", "targetId")
        .join(means, "targetId")
        .select(
            "targetId", "movieId", F.col("rating").alias("target_rating"), "target_mean"
        ),
        "profiles",
    )
    return _checked(prepared, rows, means, rows_of(means))


def user_ids(spark: SparkSession, users: Sequence[int]) -> DataFrame:
    """A few given users as ``targetId``; a literal, so Spark knows it is small."""
    ids = F.lit([int(u) for u in users]).cast("array<bigint>")
    return spark.range(1).select(F.explode(F.array_distinct(ids)).alias("targetId"))


def _as_targets(prepared: Prepared, users: DataFrame | Sequence[int]) -> DataFrame:
    if isinstance(users, DataFrame):
        return users
    return user_ids(prepared.ratings.sparkSession, users)


def find_similar_users(
    prepared: Prepared,
    users: DataFrame | Sequence[int],
    k: int = DEFAULTS.neighbors,
    min_common: int = DEFAULTS.min_common,
    min_similarity: float | None = None,
) -> DataFrame:
    """The ``k`` most similar users of each given user."""
    targets = load_targets(prepared, _as_targets(prepared, users))
    return top_k_neighbors(targets.similarities(min_common=min_common), k, min_similarity)


def popular_for(
    prepared: Prepared,
    users: DataFrame,
    warm: DataFrame,
    seen: DataFrame,
    items: DataFrame | None = None,
    n: int = DEFAULTS.recommendations,
) -> DataFrame:
    """Popular unseen items, ranked, for ``users(targetId)`` who are not in ``warm(targetId)``.

    A user without any rating is offered the most popular items.
    ``seen`` holds the items of the users, those of others do no harm.
    """
    near = staged(warm.select("targetId").distinct(), "warm")
    others = stage(
        users.join(F.broadcast(near) if few_rows(near) else near, "targetId", "left_anti"), "others"
    )
    if not rows_of(others):
        none = F.lit(None).cast("bigint").alias("movieId"), F.lit(None).cast("int").alias("rank")
        return with_items(others.select("targetId", *none), items)
    known = prepared.averages.select(F.col("userId").alias("targetId"), "num_ratings").join(
        F.broadcast(others) if few_rows(others) else others, "targetId"
    )
    cold = stage(
        others.join(known, "targetId", "left").withColumn(
            "num_ratings", F.coalesce("num_ratings", F.lit(0).cast("bigint"))
        ),
        "cold",
    )
    if few_rows(cold):
        seen = seen.join(F.broadcast(cold.select("targetId")), "targetId", "left_semi")
    # as many rows as the largest profile of a user without neighbours, and n more
    reach = n + cold.agg(F.max("num_ratings")).first()[0]
    popular = stage(popular_items(prepared.ratings, None, reach).select("movieId", "rank"), "popular")
    found = cold_start_items(cold, seen, popular, n, broadcast_popular=few_rows(popular))
    return with_items(found, items)


def _best_predictions(
    targets: Targets, nearest: DataFrame, n: int, min_prediction: float | None
) -> DataFrame:
    """Each target's ``n`` best predictions from stored neighbours; many are made a part of the targets at a time."""
    rated = nearest.join(targets.prepared.averages, "userId").agg(F.sum("num_ratings")).first()[0] or 0
    rounds = _rounds(rated * PREDICTION_VALUES, rows_of(targets.prepared.ratings))

    def best(targets: Targets, near: DataFrame) -> DataFrame:
        return top_n(targets.predictions(near), None, n, min_prediction)

    if rounds < 2:
        return best(targets, nearest)
    chosen = (_part("targetId", i, rounds) for i in range(rounds))
    parts = (
        best(replace(targets, profiles=targets.profiles.filter(part)), nearest.filter(part))
        for part in chosen
    )
    return stage_parts(parts, "best_predictions")


def recommend(
    prepared: Prepared,
    users: DataFrame | Sequence[int],
    items: DataFrame | None = None,
    k: int = DEFAULTS.neighbors,
    n: int = DEFAULTS.recommendations,
    min_common: int = DEFAULTS.min_common,
    min_similarity: float | None = None,
    min_prediction: float | None = None,
    fallback: bool = True,
) -> DataFrame:
    """The ``n`` best unseen items of each given user.

    With ``fallback`` a user without neighbours, also one without any ratings, gets the most-rated
    items instead, as rows without a prediction and with 0 raters.
    """
    wanted = stage(
        _as_targets(prepared, users).select("targetId").filter("targetId IS NOT NULL").distinct(),
        "wanted",
    )
    targets = load_targets(prepared, wanted)
    nearest = stage(
        top_k_neighbors(targets.similarities(min_common=min_common), k, min_similarity), "neighbors"
    )
    best = with_items(_best_predictions(targets, nearest, n, min_prediction), items)
    if not fallback:
        return best
    popular = popular_for(prepared, wanted, nearest, targets.seen, items, n)
    missing = {
        "predicted_rating": F.lit(None).cast("double"),
        "num_raters": F.lit(0).cast("bigint"),
        "avg_similarity": F.lit(None).cast("double"),
    }
    return best.unionByName(popular.withColumns(missing))


def pooled_similarities(
    prepared: Prepared, targets: DataFrame, min_common: int = DEFAULTS.min_common
) -> DataFrame:
    """Pooled similarities from stored item totals, broadcast where they are few.

    The ratings are read twice, once for the totals of items and once for those of users, in
    whose order they stand, so that what is shuffled is about one row per user.
    """
    totals = stage(item_totals(prepared.ratings), "item_totals")
    means = stage(
        target_means(prepared.averages, targets.select("targetId").distinct()), "target_means"
    )
    return pearson_pooled(
        prepared.of_users(None),
        prepared.averages,
        means,
        min_common,
        totals=totals,
        broadcast_items=few_rows(totals),
        broadcast_targets=few_rows(means),
    )


def pair_tasks(left: DataFrame, right: DataFrame) -> int:
    """Tasks for the pairs of two stored tables' rows with the same item, of ``PAIR_ROWS`` each."""
    counts = (
        rows.groupBy("movieId").agg(F.count(F.lit(1)).cast("double").alias(name))
        for rows, name in ((left, "a"), (right, "b"))
    )
    pairs = next(counts).join(next(counts), "movieId").agg(F.sum(F.col("a") * F.col("b"))).first()[0]
    return int((pairs or 0.0) // PAIR_ROWS) + 1


def _rounds(values: int, ratings: int) -> int:
    """In how many rounds to shuffle so many values."""
    return -(-values // max(ROUND_VALUES, ROUND_VALUES_EACH * ratings))


def _part(user: str, number: int, rounds: int) -> Column:
    """Whether a user belongs to a round."""
    # salted: within a round, users are still to be dealt to tasks and parts by their hashes
    return F.pmod(F.xxhash64(F.lit("round"), F.col(user)), F.lit(rounds)) == number


def pair_rounds(
    found: Found, left: DataFrame, right: DataFrame, user: str, above: bool, tasks: int, name: str
) -> DataFrame:
    """``found`` in the pairs of ``left`` and ``right``, in as many rounds as their number asks for.

    Each round takes the rows of a part of the users, all pairs of a user are found in one. What it found
    is stored, and what it shuffled is freed, before the next one begins.
    """
    values = tasks * PAIR_ROWS * (len(right.columns) - 1) // (2 if above else 1)
    rounds = _rounds(values, rows_of(right))
    if rounds < 2:
        return found(left, tasks)
    each = -(-tasks // rounds)
    parts = (found(left.filter(_part(user, i, rounds)), each) for i in range(rounds))
    return stage_parts(parts, name)


# How the pairs of stored tables are found; what a round has stored is not stored again.
BY_ROUNDS = {"keep": staged, "tasks": pair_tasks, "rounds": pair_rounds}


def all_pairs(
    prepared: Prepared,
    min_common: int = DEFAULTS.min_common,
    large_raters: int = LARGE_RATERS,
    **options,
) -> DataFrame:
    """Similarity of all user pairs with enough shared items, with large items looked up first."""
    return similarity_matrix(
        prepared.ratings,
        prepared.averages,
        _large_items(prepared.ratings, large_raters),
        min_common,
        **BY_ROUNDS,
        **options,
    )


def nearest_of_all(
    prepared: Prepared,
    k: int = DEFAULTS.neighbors,
    min_common: int = DEFAULTS.min_common,
    large_raters: int = LARGE_RATERS,
    **options,
) -> DataFrame:
    """The ``k`` most similar users of every user, with large items looked up first."""
    return top_k_join(
        prepared.ratings,
        prepared.averages,
        k,
        min_common,
        _large_items(prepared.ratings, large_raters),
        **BY_ROUNDS,
        **options,
    )
