import pytest
from pyspark.sql import functions as F

from kinrate.operators import similarity
from kinrate.operators.stats import user_averages
from kinrate.plans.prepared import Prepared, load_targets
from tests import reference_math as plain


def scores(df):
    return {r.userId: (r.similarity, r.common_movies) for r in df.collect()}


def prepared(ratings):
    return Prepared(ratings, user_averages(ratings))


def profiles(ratings, targets):
    means = similarity.target_means(user_averages(ratings), targets)
    return similarity.target_profiles(ratings, means)


HAND = {
    1: {1: 5, 2: 3, 3: 1},
    2: {1: 4, 2: 3, 3: 2},  # same direction: 1
    3: {1: 1, 2: 3, 3: 5},  # mirrored: -1
    4: {1: 3, 2: 3, 3: 3},  # no variance
    5: {1: 5, 2: 1},  # two items in common only
    6: {8: 2, 9: 4},  # nothing in common
}


def test_hand_computed_scores(ratings_of, targets_of):
    ratings = ratings_of(HAND)
    mine = profiles(ratings, targets_of(1))
    averages = user_averages(ratings)
    got = scores(similarity.pearson_neighbors(ratings, averages, mine))
    assert got == {2: (1.0, 3), 3: (-1.0, 3), 4: (0.0, 3)}
    dropped = similarity.pearson_neighbors(ratings, averages, mine, on_zero_variance="drop")
    assert set(scores(dropped)) == {2, 3}
    unsure = similarity.pearson_neighbors(ratings, averages, mine, on_zero_variance="null")
    assert scores(unsure)[4] == (None, 3)
    looser = similarity.pearson_neighbors(ratings, averages, mine, min_common=2)
    assert scores(looser)[5][1] == 2
    with pytest.raises(ValueError):
        similarity.pearson_neighbors(ratings, averages, mine, on_zero_variance="?")


def test_constant_rater_of_thirds_has_no_variance(ratings_of, targets_of):
    # Ratings that are no binary fractions leave noise in centred sums.
    users = {1: {i: 0.1 * i for i in range(1, 8)}, 2: {i: 3.3 for i in range(1, 8)}}
    ratings = ratings_of(users)
    found = similarity.pearson_neighbors(
        ratings, user_averages(ratings), profiles(ratings, targets_of(1))
    )
    assert scores(found) == {2: (0.0, 7)}


@pytest.mark.parametrize("min_common", [1, 2, 3, 5])
def test_random_users_match_the_definition(ratings_of, targets_of, min_common):
    users = plain.random_users(min_common)
    ratings = ratings_of(users)
    averages = user_averages(ratings)
    mine = profiles(ratings, targets_of(1, 7))
    near = similarity.pearson_neighbors(
        ratings, averages, mine, min_common, broadcast_profiles=True
    ).cache()
    far = similarity.pearson_neighbors(ratings, averages, mine, min_common, share_rows=3, side_rows=1)
    for target in (1, 7):
        expected = plain.similarities(users, target, min_common)
        assert scores(near.filter(F.col("targetId") == target)) == expected
        assert scores(far.filter(F.col("targetId") == target)) == expected
    near.unpersist()


@pytest.mark.parametrize("min_common", [1, 2, 3, 4])
@pytest.mark.parametrize("seed", range(2))
def test_deferring_large_items_changes_nothing(ratings_of, targets_of, seed, min_common):
    users = plain.random_users(seed, users=24, items=18, share=0.25, everyone=(0, 5))
    ratings = ratings_of(users)
    averages = user_averages(ratings)
    mine = profiles(ratings, targets_of(1, 7, 20))
    for tile, deferred_items in ((4, 64), (7, 2)):
        large = similarity.large_items(ratings, tile)
        found = similarity.pearson_neighbors(
            ratings, averages, mine, min_common, large=large, deferred_items=deferred_items
        ).collect()
        counts = similarity.co_rated_counts(
            ratings, mine, min_common, large, deferred_items=deferred_items
        ).collect()
        for target in (1, 7, 20):
            expected = plain.similarities(users, target, min_common)
            assert {
                r.userId: (r.similarity, r.common_movies) for r in found if r.targetId == target
            } == expected
            assert {r.userId: r.common_movies for r in counts if r.targetId == target} == {
                u: common for u, (_, common) in expected.items()
            }


def test_candidates_need_enough_ratings(ratings_of, targets_of):
    ratings = ratings_of({**HAND, 2: {**HAND[2], 7: 3}})
    found = similarity.pearson_neighbors(
        ratings,
        user_averages(ratings),
        profiles(ratings, targets_of(1)),
        min_candidate_ratings=4,
    )
    assert set(scores(found)) == {2}


@pytest.mark.parametrize("broadcast_items", [True, False])
def test_pooled_form_equals_the_self_join(ratings_of, targets_of, broadcast_items):
    users = plain.random_users(11, users=12)
    ratings = ratings_of(users)
    averages = user_averages(ratings)
    found = similarity.pearson_pooled(
        ratings,
        averages,
        similarity.target_means(averages, targets_of(3, 4)),
        broadcast_items=broadcast_items,
        broadcast_targets=broadcast_items,
        share_rows=2,
        side_rows=1,
    )
    for target in (3, 4):
        assert scores(found.filter(F.col("targetId") == target)) == plain.pooled(users, target)


def test_top_k_breaks_ties_by_user(spark):
    rows = [(1, u, s, 3) for u, s in ((5, 0.5), (4, 0.5), (3, 0.9), (2, -0.1), (6, 0.0))]
    scored = spark.createDataFrame(
        rows, "targetId int, userId int, similarity double, common_movies bigint"
    )
    top = similarity.top_k_neighbors(scored, 3)
    assert {r["rank"]: r.userId for r in top.collect()} == {1: 3, 2: 4, 3: 5}
    assert similarity.top_k_neighbors(scored, 9, min_similarity=0.0).count() == 3
    assert similarity.top_k_neighbors(scored, None, min_similarity=-1.0).count() == 5
    extremes = similarity.similarity_extremes(scored, most=1, least=2).collect()
    assert sorted((r.side, r["rank"], r.userId) for r in extremes) == [
        ("least", 1, 2),
        ("least", 2, 6),
        ("most", 1, 3),
    ]


def test_overlap_ranking(ratings_of, targets_of):
    ratings = ratings_of(HAND)
    counts = similarity.co_rated_counts(ratings, profiles(ratings, targets_of(1)), min_common=2)
    top = similarity.top_overlap_users(counts, 2)
    assert sorted((r["rank"], r.userId) for r in top.collect()) == [(1, 2), (2, 3)]


def test_many_targets_give_what_single_ones_give(ratings_of, targets_of):
    users = plain.random_users(5)
    base = prepared(ratings_of(users))
    together = load_targets(base, targets_of(*users)).similarities()
    alone = load_targets(base, targets_of(2)).similarities()
    assert scores(together.filter("targetId = 2")) == scores(alone)


def test_target_without_ratings_has_no_rows(ratings_of, targets_of):
    targets = load_targets(prepared(ratings_of(HAND)), targets_of(99))
    assert targets.similarities().count() == 0 and targets.count == 0
