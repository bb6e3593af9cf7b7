"""What both users of a pair set aside is added where pairs are added up, without a join."""

import pytest

from kinrate.operators import similarity
from kinrate.operators.stats import user_averages
from kinrate.plans.prepared import Prepared, load_targets
from kinrate.plans.storage import rows_of, stage
from tests import reference_math as plain


def keeper(kept):
    def keep(df, name):
        kept[name] = stage(df, name)
        return kept[name]

    return keep


def expected_counts(users, min_common):
    return sorted(
        (a, b, len(users[a].keys() & users[b].keys()))
        for a in users
        for b in users
        if a != b and len(users[a].keys() & users[b].keys()) >= min_common
    )


def found_counts(df):
    return sorted((r.targetId, r.userId, r.common_movies) for r in df.collect())


def test_only_the_best_known_pairs_are_stored(ratings_of):
    # all share items 0 and 1, each sets both aside: every similarity is known from the lists
    users = {u: {0: u % 5 + 1.0, 1: u * 3 % 5 + 1.0, 2 + u % 2: u * 2 % 5 + 1.0} for u in range(1, 41)}
    ratings = ratings_of(users)
    large = similarity.large_items(ratings, 30)
    assert large.count() == 2
    kept = {}
    found = similarity.top_k_join(ratings, user_averages(ratings), 3, 3, large, keep=keeper(kept))
    rows = sorted((r.targetId, r.userId, r.similarity, r.common_movies, r["rank"]) for r in found.collect())
    expected = []
    for u in users:
        scored = [(-s, v, n) for v, (s, n) in plain.similarities(users, u, 3).items()]
        expected += [(u, v, -s, n, i) for i, (s, v, n) in enumerate(sorted(scored)[:3], 1)]
    assert rows == sorted(expected)
    # all pairs were stored before, and nearly all of them joined with both users' items
    assert rows_of(kept["bounded_pairs"]) == 40 * (3 + 1)
    assert rows_of(kept["first_candidates"]) == 0


@pytest.mark.parametrize("deferred_each", [1, 8])
def test_more_hot_items_than_set_aside(ratings_of, targets_of, monkeypatch, deferred_each):
    monkeypatch.setattr(similarity, "DEFERRED_EACH", deferred_each)
    users = plain.random_users(9, users=24, items=14, share=0.5, everyone=())
    ratings = ratings_of(users)
    averages = user_averages(ratings)
    large = similarity.large_items(ratings, 8)
    assert large.count() > 4
    kept = {}
    found = similarity.similarity_matrix(ratings, averages, large, 4, keep=keeper(kept))
    assert kept["met"].filter("open > 0").count() > 0 and kept["met"].filter("open = 0").count() > 0
    pairs = sorted((r.userA, r.userB, r.similarity, r.common_movies) for r in found.collect())
    assert pairs == sorted(
        (a, b, s, n) for a in users for b, (s, n) in plain.similarities(users, a, 4).items() if a < b
    )
    some = [3, 4, 5]
    profiles = similarity.target_profiles(ratings, similarity.target_means(averages, targets_of(*some)))
    counted = similarity.co_rated_counts(ratings, profiles, 4, large, keep=stage)
    assert found_counts(counted) == [r for r in expected_counts(users, 4) if r[0] in some]


def test_everybody_is_counted_once(ratings_of, targets_of):
    users = plain.random_users(5, users=24, items=18, share=0.3, everyone=(0, 5))
    ratings = stage(ratings_of(users), "ratings")
    base = Prepared(ratings, stage(user_averages(ratings), "averages"))
    targets = load_targets(base, targets_of(*users), large_raters=10)
    assert targets.everybody and targets.large is not None
    assert found_counts(targets.co_rated_counts()) == expected_counts(users, 3)
    counts = load_targets(base, targets_of(*users)).co_rated_counts()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "rating#" not in plan and "_u#" not in plan  # no ratings go along
    assert "(u#" in plan and found_counts(counts) == expected_counts(users, 3)
    assert not load_targets(base, targets_of(*list(users)[:-1])).everybody
    for large in (None, similarity.large_items(ratings, 10)):
        small = similarity.co_rated_counts_of_all(ratings, 3, large, share_rows=3, side_rows=2)
        assert found_counts(small) == expected_counts(users, 3)
