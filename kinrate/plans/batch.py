"""The batch run: cleaned ratings to recommendations through stored stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from kinrate.config import DEFAULTS
from kinrate.operators.cleaning import clean_ratings
from kinrate.operators.recommendation import top_n
from kinrate.operators.similarity import top_k_neighbors
from kinrate.operators.stats import user_averages
from kinrate.plans.prepared import RATINGS_CLEAN, USER_AVERAGES, Prepared, load_targets, prepare
from kinrate.plans.storage import scratch
from kinrate.sources.files import read_table, write_table

# Names of the result tables.
SIMILARITY_SCORES = "similarity_scores"
TOP_SIMILAR_USERS = "top_similar_users"
PREDICTED_RATINGS = "predicted_ratings"
FINAL_RECOMMENDATIONS = "final_recommendations"


def run_batch(
    raw: DataFrame,
    targets: DataFrame,
    folder: str,
    items: DataFrame | None = None,
    recency: Sequence[str] = ("timestamp",),
    k: int = DEFAULTS.neighbors,
    min_common: int = DEFAULTS.min_common,
    n: int = DEFAULTS.recommendations,
    min_similarity: float | None = None,
    min_prediction: float | None = None,
    fmt: str = "parquet",
) -> dict[str, DataFrame]:
    """Write every result table under ``folder`` and return them as read back.

    Similarities, neighbours and predictions are each read back before the next
    step, so no step repeats the work of another. Nothing else is left behind.
    """
    spark = raw.sparkSession

    def store(df: DataFrame, name: str) -> DataFrame:
        path = f"{folder}/{name}"
        write_table(df, path, fmt)
        return read_table(spark, path, df.schema, fmt)

    with scratch():
        if fmt == "parquet":
            ratings = store(clean_ratings(raw, recency=recency), RATINGS_CLEAN)
            averages = store(user_averages(ratings), USER_AVERAGES)
            base = Prepared(ratings, averages)
        else:
            base = prepare(raw, recency)
            ratings = store(base.ratings, RATINGS_CLEAN)
            averages = store(base.averages, USER_AVERAGES)
        wanted = load_targets(base, targets)
        scores = store(wanted.similarities(min_common=min_common), SIMILARITY_SCORES)
        nearest = store(top_k_neighbors(scores, k, min_similarity), TOP_SIMILAR_USERS)
        predicted = store(wanted.predictions(nearest, stored=True), PREDICTED_RATINGS)
        final = store(
            top_n(predicted, items, n, min_prediction).orderBy("targetId", F.col("rank")),
            FINAL_RECOMMENDATIONS,
        )
    return {
        RATINGS_CLEAN: ratings,
        USER_AVERAGES: averages,
        SIMILARITY_SCORES: scores,
        TOP_SIMILAR_USERS: nearest,
        PREDICTED_RATINGS: predicted,
        FINAL_RECOMMENDATIONS: final,
    }
