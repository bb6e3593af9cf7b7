"""All pairs of users from lists of raters: whole, and without a shuffle of pairs."""

import pytest

from kinrate.operators import similarity
from kinrate.operators.stats import user_averages
from kinrate.plans.prepared import Prepared, all_pairs, pair_tasks
from kinrate.plans.storage import stage
from tests import reference_math as plain


def expected_pairs(users, min_common):
    return sorted(
        (a, b, score, common)
        for a in users
        for b, (score, common) in plain.similarities(users, a, min_common).items()
        if a < b
    )


def found_pairs(df):
    return sorted((r.userA, r.userB, r.similarity, r.common_movies) for r in df.collect())


@pytest.mark.parametrize("seed, min_common", [(0, 1), (1, 3)])
def test_all_pairs_match_the_definition(ratings_of, seed, min_common):
    users = plain.random_users(seed, users=20, items=16, share=0.3, everyone=(0, 5))
    ratings = ratings_of(users)
    averages = user_averages(ratings)
    expected = expected_pairs(users, min_common)
    small_parts = similarity.similarity_matrix(
        ratings, averages, min_common=min_common, share_rows=3, side_rows=2
    )
    assert found_pairs(small_parts) == expected
    large = similarity.large_items(ratings, 6)
    split = similarity.similarity_matrix(ratings, averages, large, min_common, keep=stage)
    assert found_pairs(split) == expected


def test_all_pairs_are_not_cut(ratings_of):
    users = {u: {i: float((u * i) % 5 + 1) for i in range(1, 5)} for u in range(1, 61)}
    ratings = ratings_of(users)
    found = all_pairs(Prepared(ratings, user_averages(ratings)))
    assert found.count() == 60 * 59 // 2


def test_lists_are_shuffled_and_not_pairs(ratings_of, targets_of):
    users = plain.random_users(4)
    ratings = ratings_of(users)
    averages = user_averages(ratings)
    profiles = similarity.target_profiles(
        ratings, similarity.target_means(averages, targets_of(*users))
    )
    for pairs in (
        similarity.co_rated_counts(ratings, profiles),
        similarity.similarity_matrix(ratings, averages).select("userA", "userB"),
    ):
        plan = pairs._jdf.queryExecution().sparkPlan().toString()
        assert "inline(" in plan
        # the groups of pairs stand right above the lists that they come from
        executed = pairs._jdf.queryExecution().executedPlan().toString()
        above = executed[: executed.index("Generate inline")]
        assert "Exchange" not in above[above.rindex("HashAggregate") - 200 :]


def test_tasks_follow_the_number_of_pairs(ratings_of, monkeypatch):
    rows = stage(ratings_of({u: {1: 3.0, 2: 4.0} for u in range(1, 11)}), "rows")
    assert pair_tasks(rows, rows) == 1
    monkeypatch.setattr("kinrate.plans.prepared.PAIR_ROWS", 50)
    assert pair_tasks(rows, rows) == 200 // 50 + 1


def test_the_tasks_of_the_lists_are_fixed(ratings_of):
    # Left to Spark, a few tasks made all lists: their output spilled.
    users = plain.random_users(2, users=20, items=16, share=0.3, everyone=(0,))
    ratings = ratings_of(users)
    found = similarity.similarity_matrix(
        ratings, user_averages(ratings), tasks=lambda left, right: 40
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count(", 18), REPARTITION_BY_NUM") == 2
    assert ", 40), REPARTITION_BY_NUM" in plan
    assert found_pairs(found) == expected_pairs(users, 3)
