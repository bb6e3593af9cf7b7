"""Comparing chosen users, known or new, with others of the stored ratings."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from kinrate.config import DEFAULTS
from kinrate.operators import comparison
from kinrate.operators.recommendation import with_items
from kinrate.plans.prepared import Prepared, Targets, few_ids, load_targets
from kinrate.plans.storage import few_rows, stage

Pairs = DataFrame | Sequence[tuple[int, int]]


def _pair_rows(prepared: Prepared, pairs: Pairs) -> DataFrame:
    if not isinstance(pairs, DataFrame):
        rows = [(int(one), int(other)) for one, other in pairs]
        spark = prepared.ratings.sparkSession
        pairs = spark.createDataFrame(rows, "targetId bigint, userId bigint")
    return pairs.select("targetId", "userId").filter("targetId != userId").distinct()


@dataclass(frozen=True)
class Comparison:
    """Pairs ``targetId, userId``, stored, with the ratings of the targets.

    ``items`` names the items of lists; without a name they are called by their id. Users
    without ratings, and pairs without an item in common, have no rows.
    """

    targets: Targets
    pairs: DataFrame
    items: DataFrame | None = None

    @classmethod
    def of_users(
        cls, prepared: Prepared, pairs: Pairs, items: DataFrame | None = None
    ) -> Comparison:
        """Two known users of each pair: one pair, a list, or a table of any size."""
        chosen = stage(_pair_rows(prepared, pairs), "pairs")
        return cls(load_targets(prepared, chosen.select("targetId")), chosen, items)

    def _titled(self, rows: DataFrame) -> DataFrame:
        items = None if self.items is None else self.items.select("movieId", "title")
        return with_items(rows, items, title_fallback=True)

    @property
    def _others(self) -> DataFrame:
        return self.targets.prepared.of_users(few_ids(self.pairs, "userId"))

    def _common(self) -> DataFrame:
        return comparison.common_items(
            self._others, self.targets.profiles, self.pairs, self.targets.small
        )

    def common_items(self) -> DataFrame:
        """``targetId, userId, movieId, rating1, rating2`` of what both have rated."""
        return self._titled(self._common().drop("target_mean"))

    def summary(self, min_common: int = DEFAULTS.min_common) -> DataFrame:
        """Similarity, its band, number of common items and agreement, a row per pair."""
        return comparison.compare_users(
            self._common(), self.targets.prepared.averages, min_common
        )

    def agreements(self) -> DataFrame:
        """Items that both loved or both disliked."""
        return self._titled(comparison.agreement_lists(self._common()))

    def disagreements(self, n: int = 10) -> DataFrame:
        """The ``n`` items that they rated most differently."""
        return self._titled(comparison.biggest_disagreements(self._common(), n))

    def regression(self) -> DataFrame:
        """The line through the common ratings."""
        return comparison.rating_regression(self._common())

    def loved_unseen(self, n: int = 10) -> DataFrame:
        """The ``n`` best that one loved and the other has not rated, both ways."""
        rows = comparison.loved_unseen(
            self._others,
            self.targets.profiles,
            self.pairs,
            n=n,
            broadcast_pairs=few_rows(self.pairs),
        )
        return self._titled(rows)
