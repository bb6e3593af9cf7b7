"""The k most similar users of every user, by bounds, against the definition."""

import pytest
from pyspark.sql import functions as F

from kinrate import nearest_of_all
from kinrate.operators import similarity
from kinrate.operators.stats import user_averages
from kinrate.plans.prepared import Prepared
from kinrate.plans.storage import stage
from tests import reference_math as plain


def expected_best(users, k, min_common, least=None):
    rows = []
    for target in users:
        scored = [
            (-score, user, common)
            for user, (score, common) in plain.similarities(users, target, min_common).items()
            if least is None or score > least
        ]
        rows += [
            (target, user, -score, common, rank)
            for rank, (score, user, common) in enumerate(sorted(scored)[:k], 1)
        ]
    return sorted(rows)


def found_best(df):
    return sorted((r.targetId, r.userId, r.similarity, r.common_movies, r["rank"]) for r in df.collect())


@pytest.mark.parametrize("seed, min_common", [(0, 1), (1, 2), (0, 3), (1, 4)])
def test_with_and_without_large_items(ratings_of, seed, min_common):
    users = plain.random_users(seed, users=24, items=18, share=0.25, everyone=(0, 5))
    ratings = ratings_of(users)
    averages = user_averages(ratings)
    for k in (2, 30):
        expected = expected_best(users, k, min_common)
        if k == 2:
            simple = similarity.top_k_join(ratings, averages, k, min_common, share_rows=3, side_rows=2)
            assert found_best(simple) == expected
        for raters, deferred_items in ((4, 64), (3, 2))[: 1 + (k == 2)]:
            large = similarity.large_items(ratings, raters)
            assert large.count() > 2
            split = similarity.top_k_join(
                ratings, averages, k, min_common, large, deferred_items=deferred_items, keep=stage
            )
            assert found_best(split) == expected


def test_a_least_similarity(ratings_of):
    users = plain.random_users(3, users=20, items=12, share=0.4, everyone=(1,))
    ratings = ratings_of(users)
    large = similarity.large_items(ratings, 4)
    found = similarity.top_k_join(ratings, user_averages(ratings), 5, 2, large, min_similarity=0.3, keep=stage)
    assert found_best(found) == expected_best(users, 5, 2, 0.3)


def test_bounds_hold_and_rule_candidates_out(ratings_of):
    """Every pair's similarity is within its bound, and few pairs are completed."""
    users = plain.random_users(6, users=40, items=30, share=0.5, everyone=(0, 1, 2))
    ratings = ratings_of(users)
    large = similarity.large_items(ratings, 30)
    kept = {}

    def keep(df, name):
        kept[name] = stage(df, name)
        return kept[name]

    found = similarity.top_k_join(ratings, user_averages(ratings), 3, 3, large, keep=keep)
    assert found_best(found) == expected_best(users, 3, 3)
    scores = {u: plain.similarities(users, u, 3) for u in users}
    bounds = {(r.u, r.v): r.bound for r in kept["bounded_pairs"].collect()}
    assert all(scores[u][v][0] <= bound for (u, v), bound in bounds.items() if v in scores[u])
    cuts = {r.targetId: r.least for r in kept["cuts"].collect()}
    open_ = sum(bound >= cuts[u] for (u, _), bound in bounds.items() if cuts.get(u) is not None)
    assert 0 < open_ < len(bounds)


def test_an_item_of_everyone_makes_no_pairs_of_its_own(ratings_of):
    # 40 users share item 0 and nothing else: no pair may be generated at all.
    users = {u: {0: 3.0, u: 4.0} for u in range(1, 41)}
    rows = ratings_of(users)
    large = similarity.large_items(rows, 10)
    vectors = similarity._hot_vectors(rows, large, 2)
    set_aside = vectors.select("userId", F.explode("hot").alias("x")).filter("x.deferred")
    assert set_aside.count() == 40
    assert similarity.top_k_join(rows, user_averages(rows), 5, 3, large).count() == 0


def test_the_plan_looks_for_large_items(ratings_of):
    users = plain.random_users(8)
    ratings = ratings_of(users)
    base = Prepared(ratings, user_averages(ratings))
    plans = [nearest_of_all(base, 3), nearest_of_all(base, 3, large_raters=4)]
    seen = ["last_bound" in p._jdf.queryExecution().executedPlan().toString() for p in plans]
    assert seen == [False, True]
    assert found_best(plans[0]) == found_best(plans[1]) == expected_best(users, 3, 3)


def test_parameters_are_checked(ratings_of):
    rows = ratings_of({1: {1: 3.0}})
    with pytest.raises(ValueError):
        similarity.top_k_join(rows, user_averages(rows), 0)
    with pytest.raises(ValueError):
        similarity.top_k_join(rows, user_averages(rows), 3, on_zero_variance="null")
