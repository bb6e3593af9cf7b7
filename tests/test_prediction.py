import pytest
from pyspark.sql import functions as F

from kinrate.operators import prediction, recommendation
from kinrate.operators.similarity import top_k_neighbors
from kinrate.operators.stats import user_averages
from kinrate.plans.prepared import (
    Prepared,
    find_similar_users,
    load_profiles,
    load_targets,
    recommend,
)
from kinrate.plans.profiles import NewUsers
from tests import reference_math as plain


@pytest.fixture(scope="module")
def small(spark):
    """Target 1 (mean 3.279) and three neighbours with given means."""
    ratings = spark.createDataFrame(
        [
            (1, 1, 3.0),
            (2, 1, 4.0),
            (2, 10, 5.0),
            (3, 11, 5.0),
            (4, 11, 0.5),
            (4, 12, 0.5),
            (5, 13, 4.0),
            (3, 14, 5.0),
        ],
        "userId int, movieId int, rating double",
    )
    averages = spark.createDataFrame(
        [(1, 3.279, 140), (2, 3.311, 30), (3, 1.0, 20), (4, 4.5, 20), (5, 3.0, 9)],
        "userId int, avg_rating double, num_ratings bigint",
    )
    neighbors = spark.createDataFrame(
        [(1, 2, 0.3978), (1, 3, 0.8), (1, 4, 0.2), (1, 5, 0.0)],
        "targetId int, userId int, similarity double",
    )
    means = spark.createDataFrame([(1, 3.279)], "targetId int, target_mean double")
    seen = spark.createDataFrame([(1, 1)], "targetId int, movieId int")
    return ratings, averages, neighbors, means, seen


def predicted(df):
    return {r.movieId: (r.predicted_rating, r.num_raters, r.avg_similarity) for r in df.collect()}


def test_hand_computed_predictions(small):
    got = predicted(prediction.predict_ratings(*small))
    assert got == {
        10: (4.97, 1, 0.3978),  # one rater: the similarity cancels out
        11: (5.0, 2, 0.5),  # 3.279 + (0.8*4 - 0.2*4) / 1.0, limited
        12: (0.5, 1, 0.2),  # 3.279 - 4, limited
        13: (None, 1, 0.0),  # no weight at all
        14: (5.0, 1, 0.8),
    }


def test_undefined_predictions_can_be_dropped(small):
    assert 13 not in predicted(prediction.predict_ratings(*small, drop_undefined=True))


def test_seen_items_are_no_candidates(small):
    ratings, _, neighbors, _, seen = small
    items = prediction.unseen_items(ratings, neighbors, seen)
    assert sorted(r.movieId for r in items.collect()) == [10, 11, 12, 13, 14]


@pytest.mark.parametrize("near", [True, False])
def test_random_users_match_the_definition(ratings_of, targets_of, near):
    users = plain.random_users(3)
    ratings = ratings_of(users)
    base = Prepared(ratings, user_averages(ratings))
    targets = load_targets(base, targets_of(1, 9))
    nearest = top_k_neighbors(targets.similarities(), 6).cache()
    got = prediction.predict_ratings(
        ratings,
        base.averages,
        nearest,
        targets.means,
        targets.seen,
        broadcast_neighbors=near,
        broadcast_seen=near,
        share_rows=2,
        side_rows=1,
    ).cache()
    for target in (1, 9):
        weights = {
            r.userId: r.similarity for r in nearest.filter(F.col("targetId") == target).collect()
        }
        assert predicted(got.filter(F.col("targetId") == target)) == plain.predictions(
            users, target, weights
        )


def test_contributors_are_ordered_by_effect(small):
    got = prediction.profile_predictions(*small, explain=1)
    rows = {r.movieId: r for r in got.collect()}
    assert set(rows) == {10, 11, 12, 14}
    assert rows[11].num_contributors == 2
    (top,) = rows[11].contributors
    assert (top.userId, top.rating, top.avg_rating) == (3, 5.0, 1.0)
    assert top.contribution == pytest.approx(3.2)
    flat = prediction.explain_contributors(prediction.profile_predictions(*small))
    listed = [(r.position, r.userId, r.contribution) for r in flat.filter("movieId = 11").collect()]
    assert sorted(listed) == [(1, 3, 3.2), (2, 4, -0.8)]
    assert {r.adjustment for r in flat.filter("movieId = 11").collect()} == {1.721}


def test_only_the_nearest_contribute(small):
    got = prediction.profile_predictions(*small, max_contributors=1)
    assert {r.movieId for r in got.collect()} == {11, 14}


def test_ranking_uses_raters_then_id_and_keeps_unknown_items(spark, small):
    predictions = spark.createDataFrame(
        [(1, 1, 4.0, 2), (1, 2, 4.0, 3), (1, 3, 4.5, 1), (1, 4, None, 9), (1, 5, 4.0, 3)],
        "targetId int, movieId int, predicted_rating double, num_raters bigint",
    )
    items = spark.createDataFrame([(3, "Three", "Drama|War")], "movieId int, title string, genres string")
    ranked = recommendation.top_n(predictions, items, 5).orderBy("rank").collect()
    assert [r.movieId for r in ranked] == [3, 2, 5, 1, 4]
    assert ranked[0].genres == "Drama|War" and ranked[1].title is None
    titled = recommendation.top_n(predictions, items, 2, title_fallback=True)
    assert {r.title for r in titled.collect()} == {"Three", "Movie 2"}
    assert recommendation.top_n(predictions, n=9, min_prediction=4.5).count() == 1
    bare = recommendation.top_n(predictions, None, 1, title_fallback=True).first()
    assert bare.title == "Movie 3"


def test_prediction_reports(spark):
    predictions = spark.createDataFrame(
        [(1, i, v, r) for i, v, r in ((1, 4.0, 20), (2, 4.0, 10), (3, 3.0, 9), (4, None, 1))],
        "targetId int, movieId int, predicted_rating double, num_raters bigint",
    )
    top = prediction.top_predictions(predictions, 2).collect()
    assert sorted(r.movieId for r in top) == [1, 2]
    spread = prediction.prediction_distribution(predictions, 2).collect()
    assert sorted((r["rank"], r.predicted_rating, r["count"]) for r in spread) == [
        (1, 4.0, 2),
        (2, 3.0, 1),
    ]
    bands = {r.confidence: r["count"] for r in prediction.confidence_distribution(predictions).collect()}
    assert bands == {"High Confidence": 1, "Medium Confidence": 1, "Low Confidence": 2}


def test_favourites_and_profiles(ratings_of, targets_of):
    ratings = ratings_of({1: {1: 4, 2: 5, 3: 5, 4: 1}, 2: {1: 2}})
    best = recommendation.user_favorites(ratings, targets_of(1), n=2).collect()
    assert sorted((r["rank"], r.movieId) for r in best) == [(1, 2), (2, 3)]
    described = recommendation.user_profiles(ratings, user_averages(ratings), n=1).collect()
    assert sorted((r.userId, r.movieId, r.rating_type) for r in described) == [
        (1, 2, "Balanced"),
        (2, 1, "Critical"),
    ]


def test_popular_items_and_cold_start(spark, ratings_of):
    ratings = ratings_of({1: {1: 4, 2: 5}, 2: {1: 3, 2: 1, 3: 2}, 3: {1: 2, 4: 2}})
    popular = recommendation.popular_items(ratings, n=4)
    assert [(r["rank"], r.movieId, r.avg_rating) for r in popular.orderBy("rank").collect()] == [
        (1, 1, 3.0),
        (2, 2, 3.0),
        (3, 3, 2.0),
        (4, 4, 2.0),
    ]
    cold = spark.createDataFrame([(3, 2), (8, 0)], "targetId int, num_ratings bigint")
    seen = spark.createDataFrame([(3, 1), (3, 4)], "targetId int, movieId int")
    got = recommendation.cold_start_items(cold, seen, popular.select("movieId", "rank"), 2)
    assert sorted((r.targetId, r["rank"], r.movieId) for r in got.collect()) == [
        (3, 1, 2),
        (3, 2, 3),
        (8, 1, 1),
        (8, 2, 2),
    ]


@pytest.mark.parametrize("block", [1, 3, 256])
@pytest.mark.parametrize("broadcast", [True, False])
def test_free_ranks_of_any_profiles(spark, block, broadcast):
    import random

    pick = random.Random(block)
    popular = spark.createDataFrame([(100 - r, r) for r in range(1, 41)], "movieId bigint, rank int")
    seen = {u: sorted(pick.sample(range(60, 100), pick.choice([0, 1, 5, 20, 38, 40]))) for u in range(12)}
    seen[12] = list(range(90, 100))  # the ten most popular ones
    cold = [(u, len(items)) for u, items in seen.items() if u != 5]
    got = recommendation.cold_start_items(
        spark.createDataFrame(cold, "targetId bigint, num_ratings bigint"),
        spark.createDataFrame([(u, i) for u, items in seen.items() for i in items], "targetId bigint, movieId bigint"),
        popular,
        4,
        broadcast,
        block,
    )
    expected = [
        (u, item, rank)
        for u, _ in cold
        for rank, item in enumerate([i for i in range(99, 59, -1) if i not in seen[u]][:4], 1)
    ]
    assert sorted((r.targetId, r.movieId, r["rank"]) for r in got.collect()) == sorted(expected)


def test_recommend_serves_users_without_neighbours(spark, ratings_of):
    users = plain.random_users(9, users=20, items=15, share=0.5)
    users[50] = {3: 4.0, 900: 2.0}  # shares one item only
    users[51] = {901: 1.0}
    ratings = ratings_of(users)
    base = Prepared(ratings, user_averages(ratings))
    items = spark.createDataFrame([(i, f"item {i}", "x") for i in range(15)], "movieId bigint, title string, genres string")
    rows = recommend(base, [1, 50, 51, 77], items, n=3).collect()
    raters = {}
    for rated in users.values():
        for i in rated:
            raters[i] = raters.get(i, 0) + 1
    popular = sorted(raters, key=lambda i: (-raters[i], i))
    for user in (50, 51, 77):
        mine = sorted((r["rank"], r.movieId) for r in rows if r.targetId == user)
        unseen = [i for i in popular if i not in users.get(user, {})][:3]
        assert mine == list(enumerate(unseen, 1))
        assert all(
            r.predicted_rating is None and r.num_raters == 0 and r.avg_similarity is None and r.title
            for r in rows
            if r.targetId == user
        )
    warm = [r for r in rows if r.targetId == 1]
    alone = recommend(base, [1, 50, 77], items, n=3, fallback=False).collect()
    assert sorted(map(tuple, warm)) == sorted(tuple(r[c] for c in warm[0].asDict()) for r in alone)
    assert all(r.predicted_rating is not None for r in warm)


def test_no_join_on_popular_places_per_seen_item(spark, ratings_of):
    """Per cold user there are a few blocks and n rows, not one row for each seen item and more."""
    cold = spark.createDataFrame([(u, 30) for u in range(50)], "targetId bigint, num_ratings bigint")
    none = spark.createDataFrame([], "targetId bigint, place bigint")
    blocks = recommendation.free_ranks(cold, none, 5)
    assert blocks.count() == 250
    assert "explode(sequence(0" in blocks._jdf.queryExecution().optimizedPlan().toString()


def test_new_user_equals_the_same_known_user(spark, ratings_of, targets_of):
    users = plain.random_users(21, users=25, items=30, share=0.6)
    ratings = ratings_of(users)
    base = Prepared(ratings, user_averages(ratings, digits=10))
    profile = spark.createDataFrame(
        [(1, i, r) for i, r in users[1].items()] + [(1, 99, 0.0)],
        "profileId int, movieId int, rating double",
    )
    new = NewUsers.load(base, profile)
    known = load_targets(base, targets_of(1))
    expected = top_k_neighbors(
        known.similarities(round_similarity=10, min_candidate_ratings=10, on_zero_variance="drop"),
        10,
        min_similarity=0.0,
    )
    found = new.neighbors()
    ids = {(r.userId, round(r.similarity, 8)) for r in found.collect()}
    assert ids == {(r.userId, round(r.similarity, 8)) for r in expected.collect()}
    assert len(ids) == 10
    left = {r.movieId: r.predicted_rating for r in new.predictions(found).collect()}
    right = {
        r.movieId: r.predicted_rating
        for r in known.predictions(expected, drop_undefined=True).collect()
    }
    assert left == right and left
    top = new.recommendations(new.predictions(found), n=3).orderBy("rank").collect()
    assert [r.movieId for r in top] == sorted(left, key=lambda i: (-left[i], i))[:3]


def test_named_users_and_tables_of_users_agree(ratings_of, targets_of):
    ratings = ratings_of(plain.random_users(4))
    base = Prepared(ratings, user_averages(ratings))
    by_id = recommend(base, [2, 2, 5], n=3).collect()
    assert sorted(map(tuple, by_id)) == sorted(
        map(tuple, recommend(base, targets_of(2, 5), n=3).collect())
    )
    assert {r.targetId for r in by_id} == {2, 5}
    near = find_similar_users(base, [2], k=4, min_similarity=0.0).collect()
    assert 0 < len(near) <= 4 and all(r.similarity > 0 for r in near)


def test_profile_mean_is_not_rounded_and_zero_means_unrated(spark, ratings_of):
    base = Prepared(ratings_of({1: {1: 4}}), user_averages(ratings_of({1: {1: 4}})))
    profile = spark.createDataFrame(
        [(-1, 1, 4.0), (-1, 2, 4.0), (-1, 3, 3.0), (-1, 4, 0.0)],
        "profileId int, movieId int, rating double",
    )
    assert load_profiles(base, profile).count == 0  # three ratings are too few
    loaded = load_profiles(base, profile, min_size=3)
    assert loaded.means.first().target_mean == 11 / 3
    assert loaded.seen.count() == 3
    summary = recommendation.profile_summary(profile.filter("rating > 0")).first()
    assert (summary.avg_rating, summary.num_ratings) == (11 / 3, 3)
    assert summary.rating_type == "Balanced"


def test_a_profile_has_one_rating_per_item(spark, ratings_of):
    from kinrate.operators.recommendation import profile_summary
    from kinrate.plans.prepared import prepare
    from kinrate.plans.profiles import NewUsers

    ratings = ratings_of({1: {0: 4, 1: 2, 2: 5}, 2: {0: 1, 1: 5, 3: 2}})
    base = prepare(ratings.selectExpr("*", "0L AS timestamp"))
    rows = [(-1, 0, 4.0), (-1, 0, 3.0), (-1, 0, 4.0), (-1, 8, 2.0), (-1, 9, 1.0)]
    profile = spark.createDataFrame(rows, "profileId int, movieId int, rating double")
    # one shared item, however often it is listed, is no neighbour at three common items
    assert NewUsers.load(base, profile, min_size=3).neighbors(min_common=3).count() == 0
    assert NewUsers.load(base, profile, min_size=4).targets.means.count() == 0
    summary = profile_summary(profile).first()
    assert (summary.num_ratings, round(summary.avg_rating, 3)) == (3, 2.333)
