"""Recommendations for all users: each pair of users is added up once, and given both ways round."""

from dataclasses import replace

from pyspark.sql import functions as F

from kinrate import recommend
from kinrate.operators import similarity
from kinrate.operators.stats import user_averages
from kinrate.plans import prepared as plans
from kinrate.plans.prepared import load_targets
from tests import reference_math as plain
from tests.test_rounds import base_of, parts_of, rounds, rows  # noqa: F401


def test_each_pair_of_everybody_is_met_once(ratings_of, targets_of):
    users = plain.random_users(4, users=24, items=18, share=0.25)
    base = base_of(ratings_of(users))
    targets = replace(load_targets(base, targets_of(*users)), small=False)
    plan = targets.similarities()._jdf.queryExecution().executedPlan().toString()
    assert "array_position" in plan  # lists are cut to the users above


def test_candidates_of_everybody_may_be_limited(ratings_of):
    users = plain.random_users(5, users=24, items=18, share=0.3)
    ratings = ratings_of(users)
    averages = user_averages(ratings)
    targets = averages.select(F.col("userId").alias("targetId"))
    profiles = similarity.target_profiles(ratings, similarity.target_means(averages, targets))
    names = "targetId", "userId", "similarity", "common_movies"
    for how in ({}, {"on_zero_variance": "drop", "min_candidate_ratings": 6, "round_similarity": None}):
        one = similarity.pearson_neighbors(ratings, averages, profiles, **how)
        assert rows(similarity.pearson_of_all(ratings, averages, **how), *names) == rows(one, *names)


def test_recommendations_in_rounds_are_the_same(spark, ratings_of, monkeypatch, rounds):  # noqa: F811
    users = plain.random_users(6, users=24, items=30, share=0.3, everyone=(0,))
    base = base_of(ratings_of(users))
    everybody = base.averages.select(F.col("userId").alias("targetId"))
    items = spark.createDataFrame([(i, f"title {i}") for i in range(30)], "movieId bigint, title string")
    monkeypatch.setattr(plans, "few_rows", lambda df, limit=0: False)
    monkeypatch.setattr(plans, "ROUND_VALUES_EACH", 40)
    found = recommend(base, everybody, items, k=4)
    assert [path.rsplit("/", 1)[1] for path in rounds] == ["best_predictions"]
    assert parts_of(spark, rounds[0]) > 1
    monkeypatch.setattr(plans, "ROUND_VALUES", 1 << 40)
    whole = recommend(base, everybody, items, k=4)
    assert found.columns == whole.columns
    assert rows(found, *found.columns) == rows(whole, *found.columns)
    assert len(rounds) == 1
