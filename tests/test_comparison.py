import pytest

from kinrate.operators import comparison
from kinrate.operators.stats import user_averages
from kinrate.plans.prepared import Prepared, load_profiles

USERS = {
    2: {1: 4.5, 2: 1.0, 3: 2.0, 4: 5.0, 7: 4.0},
    3: {1: 3.0, 2: 3.0, 3: 3.0},
    4: {1: 5.0},
    5: {9: 2.0},
}
MINE = {1: 5.0, 2: 2.0, 3: 4.0, 5: 4.5, 6: 3.5}


@pytest.fixture(scope="module")
def sides(spark, ratings_of):
    ratings = ratings_of(USERS)
    mean = sum(MINE.values()) / len(MINE)
    left = spark.createDataFrame(
        [(-1, i, r, mean) for i, r in MINE.items()],
        "targetId int, movieId int, target_rating double, target_mean double",
    )
    return ratings, left, user_averages(ratings)


@pytest.fixture(scope="module")
def common(sides):
    ratings, left, _ = sides
    return comparison.common_items(ratings, left).cache()


def test_common_items_of_all_and_of_chosen_pairs(spark, sides, common):
    assert common.count() == 7
    ratings, left, _ = sides
    pairs = spark.createDataFrame([(-1, 2)], "targetId int, userId int")
    chosen = comparison.common_items(ratings, left, pairs, broadcast_left=True)
    assert {r.userId for r in chosen.collect()} == {2} and chosen.count() == 3


def test_targets_meet_only_chosen_users(spark, sides, common):
    ratings, _, averages = sides
    profile = spark.createDataFrame([(-1, i, r) for i, r in MINE.items()], "profileId int, movieId int, rating double")
    targets = load_profiles(Prepared(ratings, averages), profile)
    everybody = {(r.userId, r.movieId) for r in targets.common_items().collect()}
    assert everybody == {(r.userId, r.movieId) for r in common.collect()}
    chosen = targets.common_items([2, 5]).collect()
    assert {(r.userId, r.movieId) for r in chosen} == {pair for pair in everybody if pair[0] == 2}


def test_metrics(sides, common):
    rows = {r.userId: r for r in comparison.compare_users(common, sides[2]).collect()}
    assert set(rows) == {2, 3, 4}
    # Deviations 1.2, -1.8, 0.2 against 1.2, -2.3, -1.3: 5.32 / sqrt(4.72 * 8.42).
    assert rows[2].similarity == 0.8439
    assert (rows[2].common_movies, rows[2].agreement_pct) == (3, 66.67)
    assert rows[2].interpretation == "Very Similar"
    assert rows[3].similarity is None and rows[3].agreement_pct == 66.67
    assert rows[4].similarity is None and rows[4].interpretation is None


def test_agreement_lists(common):
    got = sorted((r.userId, r.movieId, r.verdict) for r in comparison.agreement_lists(common).collect())
    assert got == [(2, 1, "both_loved"), (2, 2, "both_disliked"), (4, 1, "both_loved")]


def test_disagreements(common):
    got = comparison.biggest_disagreements(common, 1).collect()
    assert sorted((r.userId, r.movieId, r.difference) for r in got) == [
        (2, 3, 2.0),
        (3, 1, 2.0),
        (4, 1, 0.0),
    ]


def test_regression(common):
    rows = {r.userId: r for r in comparison.rating_regression(common).collect()}
    assert (rows[3].slope, rows[3].intercept, rows[3].r2) == (0.0, 3.0, 1.0)
    assert rows[4].points == 1 and rows[4].slope is None and rows[4].r2 is None
    # Points (5, 4.5), (2, 1), (4, 2): Sxy = 5, Sxx = 14/3.
    assert rows[2].slope == pytest.approx(15 / 14, abs=1e-6)


@pytest.mark.parametrize("near", [True, False])
def test_loved_by_one_and_unseen_by_the_other(spark, sides, near):
    ratings, left, _ = sides
    pairs = spark.createDataFrame([(-1, 2), (-1, 4)], "targetId int, userId int")
    got = comparison.loved_unseen(
        ratings, left, pairs, broadcast_pairs=near, share_rows=1, side_rows=1
    ).collect()
    assert sorted((r.userId, r.loved_by, r["rank"], r.movieId) for r in got) == [
        (2, "mine", 1, 5),
        (2, "theirs", 1, 4),
        (2, "theirs", 2, 7),
        (4, "mine", 1, 5),
        (4, "mine", 2, 3),
    ]


def test_explore_filters_and_orders(spark):
    neighbors = spark.createDataFrame(
        [
            (-1, 1, 0.9, 5, 4.5, 12, "Generous", 3.0),
            (-1, 2, 0.8, 9, 2.0, 12, "Critical", 3.0),
            (-1, 3, 0.5, 7, 3.1, 12, "Balanced", 3.0),
            (-1, 4, 0.4, 9, 3.0, 12, "Balanced", 3.0),
            (-1, 5, 0.9, 4, 3.0, 12, "Balanced", 3.0),
        ],
        "targetId int, userId int, similarity double, common_movies bigint, avg_rating double,"
        " num_ratings bigint, rating_type string, target_mean double",
    )

    def ids(**options):
        return [r.userId for r in comparison.explore_neighbors(neighbors, **options).collect()]

    assert ids() == [1, 2, 3]
    ranked = comparison.explore_neighbors(neighbors, sort_by="common").collect()
    assert {r.userId: r["rank"] for r in ranked} == {2: 1, 3: 2, 1: 3}
    assert ids(sort_by="common") == [2, 3, 1]
    assert ids(sort_by="mean_gap") == [3, 2, 1]
    assert ids(rating_types=["Balanced"], min_similarity=0.0, min_common=1) == [5, 3, 4]
    with pytest.raises(ValueError):
        ids(sort_by="name")
