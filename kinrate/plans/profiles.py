"""Recommendations for new users from the ratings they just gave."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from kinrate.config import DEFAULTS
from kinrate.functions.labels import rating_type
from kinrate.operators.comparison import explore_neighbors
from kinrate.operators.joins import top_per
from kinrate.operators.recommendation import top_n, with_items
from kinrate.operators.similarity import top_k_neighbors
from kinrate.plans.comparing import Comparison
from kinrate.plans.prepared import Prepared, Targets, load_profiles
from kinrate.plans.storage import stage


@dataclass(frozen=True)
class NewUsers:
    """New-user profiles against the stored ratings."""

    targets: Targets

    @classmethod
    def load(
        cls,
        prepared: Prepared,
        profiles: DataFrame,
        min_size: int = DEFAULTS.min_profile_size,
    ) -> NewUsers:
        """Profiles ``profileId, movieId, rating`` of at least ``min_size`` ratings."""
        return cls(load_profiles(prepared, profiles, min_size))

    def favorites(self, items: DataFrame | None = None, n: int = 5) -> DataFrame:
        """Each new user's ``n`` highest own ratings, with titles."""
        own = self.targets.profiles.select(
            "targetId", "movieId", F.col("target_rating").alias("rating")
        )
        order = [F.col("rating").desc(), F.col("movieId")]
        return with_items(top_per(own, ["targetId"], order, n), items, title_fallback=True)

    def neighbors(
        self,
        k: int | None = DEFAULTS.profile_neighbors,
        min_common: int = DEFAULTS.min_common,
        min_candidate_ratings: int = DEFAULTS.min_candidate_ratings,
    ) -> DataFrame:
        """The most similar users with enough ratings, positive scores only.

        Similarities are not rounded visibly: ten digits keep their order free of
        summation noise.
        """
        scored = self.targets.similarities(
            min_common=min_common,
            on_zero_variance="drop",
            round_similarity=10,
            min_candidate_ratings=min_candidate_ratings,
        )
        nearest = top_k_neighbors(scored, k, min_similarity=0.0)
        averages = self.targets.prepared.averages
        means = self.targets.means
        return (
            averages.join(
                F.broadcast(nearest) if self.targets.few_neighbors(k) else nearest, "userId"
            )
            .join(F.broadcast(means) if self.targets.few else means, "targetId")
            .select(
                "targetId",
                "userId",
                "similarity",
                "common_movies",
                "avg_rating",
                "num_ratings",
                rating_type(F.col("avg_rating")).alias("rating_type"),
                "target_mean",
            )
        )

    def explore(
        self, items: int = 5, k: int | None = DEFAULTS.profile_neighbors, **filters
    ) -> DataFrame:
        """Neighbours that pass filters by similarity, common ``items`` and rating type, in one
        of three orders: the options of :func:`kinrate.operators.comparison.explore_neighbors`."""
        return explore_neighbors(self.neighbors(k), min_common=items, **filters)

    def compare(self, users: Sequence[int], items: DataFrame | None = None) -> Comparison:
        """Each new user with each of the given known users."""
        ids = F.lit([int(u) for u in users]).cast("array<bigint>")
        pairs = self.targets.means.select(
            "targetId", F.explode(F.array_distinct(ids)).alias("userId")
        )
        return Comparison(self.targets, stage(pairs, "pairs"), items)

    def predictions(self, neighbors: DataFrame, **options) -> DataFrame:
        return self.targets.explained_predictions(neighbors, **options)

    def recommendations(
        self,
        predictions: DataFrame,
        items: DataFrame | None = None,
        n: int = DEFAULTS.profile_recommendations,
    ) -> DataFrame:
        """The best predictions with titles; ties go to the lower item id."""
        return top_n(predictions, items, n, title_fallback=True, raters=None)
