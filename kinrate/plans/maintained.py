"""User averages that are kept up to date by changes instead of being worked out anew.

A change is an old and a new rating of a user: none and one is an insert, one and none a
removal, two a revision. A batch of changes is stored as what it adds to each user's number
and sum of ratings, which may be negative, so any order of batches and any number of
them gives the same totals. Batches are published by manifest under their id; one that
is there already, or that a snapshot contains, is not stored again, so a batch whose answer
was lost may be sent again. Sums are decimal and therefore exact.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from kinrate.config import DEFAULTS
from kinrate.functions.scores import EXACT, round_half_up
from kinrate.plans.storage import delete, published, read_manifest, read_stage, write_stage

NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
SNAPSHOT = "snapshot"


def rating_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changes ``userId, old_rating, new_rating`` that lead from one rating table to another.

    Both have one row per user and item. Ratings that stay the same are no change.
    """
    keys = ["userId", "movieId"]
    both = old.select(*keys, F.col("rating").alias("old_rating")).join(
        new.select(*keys, F.col("rating").alias("new_rating")), keys, "full"
    )
    same = F.col("old_rating").eqNullSafe(F.col("new_rating"))
    return both.filter(~same).select("userId", "old_rating", "new_rating")


@dataclass(frozen=True)
class MaintainedAverages:
    """Number and sum of each user's ratings, in a folder that all executors share."""

    spark: SparkSession
    folder: str

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _merged(self) -> set[str]:
        manifest = read_manifest(self.spark, self._path(SNAPSHOT))
        return set(manifest["notes"]["merged"]) if manifest else set()

    def batches(self) -> list[str]:
        """Ids of all batches committed so far."""
        stored = published(self.spark, self._path("batches"))
        return sorted({*stored, *self._merged()})

    def commit(self, batch_id: str, changes: DataFrame) -> bool:
        """Add a batch of ``userId, old_rating, new_rating``; False if it was there already.

        A null user has no average and is left out.
        """
        if not NAME.fullmatch(batch_id):
            raise ValueError(f"not a batch id: {batch_id!r}")
        path = self._path(f"batches/{batch_id}")
        if batch_id in self._merged() or read_manifest(self.spark, path) is not None:
            return False

        def signed(value: str) -> F.Column:
            return F.coalesce(F.col(value).cast(EXACT), F.lit(0).cast(EXACT))

        def there(value: str) -> F.Column:
            return F.col(value).isNotNull().cast("bigint")

        deltas = (
            changes.filter("userId IS NOT NULL")
            .groupBy(F.col("userId").cast("bigint").alias("userId"))
            .agg(
                F.sum(there("new_rating") - there("old_rating")).alias("ratings"),
                F.sum(signed("new_rating") - signed("old_rating")).cast(EXACT).alias("total"),
            )
            .filter("ratings != 0 OR total != 0")
        )
        write_stage(deltas, path)
        return True

    def totals(self) -> DataFrame:
        """``userId, ratings, total`` of all batches, users without ratings left out."""
        merged = self._merged()
        names = [n for n in published(self.spark, self._path("batches")) if n not in merged]
        tables = [read_stage(self.spark, self._path(f"batches/{name}")) for name in names]
        if merged:
            tables.append(read_stage(self.spark, self._path(SNAPSHOT)))
        if not tables:
            return self.spark.createDataFrame([], f"userId bigint, ratings bigint, total {EXACT}")
        whole = tables[0]
        for table in tables[1:]:
            whole = whole.unionByName(table)
        return (
            whole.groupBy("userId")
            .agg(F.sum("ratings").alias("ratings"), F.sum("total").cast(EXACT).alias("total"))
            .filter("ratings > 0")
        )

    def averages(self, digits: int | None = DEFAULTS.mean_digits) -> DataFrame:
        """The table of user averages, as worked out from the ratings themselves."""
        mean = F.col("total").cast("double") / F.col("ratings")
        return self.totals().select(
            "userId",
            round_half_up(mean, digits).alias("avg_rating"),
            F.col("ratings").alias("num_ratings"),
        )

    def compact(self) -> None:
        """Merge all batches into a snapshot, which lists them, and delete them after that.

        What is cut off in between leaves batches that the snapshot lists; they are not
        read again, and the next call deletes them.
        """
        merged = self.batches()
        if merged:
            write_stage(self.totals(), self._path(SNAPSHOT), {"merged": merged})
        for name in published(self.spark, self._path("batches")):
            delete(self.spark, self._path(f"batches/{name}"))
