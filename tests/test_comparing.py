"""The public calls that compare chosen users, against plain definitions."""

import pytest

from kinrate import Comparison, NewUsers
from kinrate.operators.stats import user_averages
from kinrate.plans.prepared import Prepared
from tests import reference_math as plain


@pytest.fixture(scope="module")
def users():
    return plain.random_users(12, users=14, items=20, share=0.6)


@pytest.fixture(scope="module")
def base(ratings_of, users):
    ratings = ratings_of(users)
    return Prepared(ratings, user_averages(ratings))


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame([(i, f"item {i}") for i in range(10)], "movieId bigint, title string")


PAIRS = [(1, 2), (1, 5), (3, 9), (4, 4), (1, 2), (2, 99), (98, 1)]
REAL = [(1, 2), (1, 5), (3, 9)]


def title(i):
    return f"item {i}" if i < 10 else f"Movie {i}"


def test_lists_of_known_users(base, users, items):
    chosen = Comparison.of_users(base, PAIRS, items)
    both = {(a, b, i): (users[a][i], users[b][i]) for a, b in REAL for i in users[a].keys() & users[b].keys()}
    found = chosen.common_items().collect()
    assert {(r.targetId, r.userId, r.movieId): (r.rating1, r.rating2) for r in found} == both
    assert all(r.title == title(r.movieId) for r in found)
    verdicts = {
        key: "both_loved" if min(two) >= 4 else "both_disliked"
        for key, two in both.items()
        if min(two) >= 4 or max(two) <= 2.5
    }
    assert {(r.targetId, r.userId, r.movieId): r.verdict for r in chosen.agreements().collect()} == verdicts
    for a, b in REAL:
        order = sorted((-abs(x - y), i) for (c, d, i), (x, y) in both.items() if (c, d) == (a, b))
        rows = chosen.disagreements(3).filter(f"targetId = {a} AND userId = {b}").orderBy("rank").collect()
        assert [r.movieId for r in rows] == [i for _, i in order[:3]]
    loved = {(r.targetId, r.userId, r.loved_by, r.movieId) for r in chosen.loved_unseen(99).collect()}
    assert loved == {
        (a, b, side, i)
        for a, b in REAL
        for side, one, other in (("mine", a, b), ("theirs", b, a))
        for i, r in users[one].items()
        if r >= 4 and i not in users[other]
    } | {
        (*pair, side, i)  # nothing is known of the other one, who has rated nothing
        for pair, side, one in (((2, 99), "mine", 2), ((98, 1), "theirs", 1))
        for i, r in users[one].items()
        if r >= 4
    }
    assert {(r.targetId, r.userId) for r in chosen.regression().collect()} == set(REAL)


def test_summary_of_known_users(spark, base, users):
    table = spark.createDataFrame(PAIRS, "targetId bigint, userId bigint")
    for pairs in (PAIRS, table):
        rows = {(r.targetId, r.userId): r for r in Comparison.of_users(base, pairs).summary(1).collect()}
        assert set(rows) == set(REAL)
        for (a, b), row in rows.items():
            score, common = plain.similarities(users, a, 1)[b]
            agree = sum(abs(users[a][i] - users[b][i]) <= 1 for i in users[a].keys() & users[b].keys())
            assert (row.similarity, row.common_movies) == (score, common)
            assert row.agreement_pct == plain.half_up(100 * agree / common, 2)


def test_new_users_against_known_ones(spark, base, users, items):
    profile = spark.createDataFrame([(-7, i, r) for i, r in users[3].items()], "profileId bigint, movieId bigint, rating double")
    new = NewUsers.load(base, profile)
    rows = new.compare([5, 6, 6, 77], items).summary(1).collect()
    assert {(r.targetId, r.userId) for r in rows} == {(-7, 5), (-7, 6)}
    assert {r.common_movies for r in rows if r.userId == 5} == {len(users[3].keys() & users[5].keys())}
    explored = new.explore(items=3, k=None, min_similarity=0.1, sort_by="common").orderBy("rank").collect()
    assert [r.common_movies for r in explored] == sorted((r.common_movies for r in explored), reverse=True)
    assert explored and all(r.similarity >= 0.1 and r.common_movies >= 3 for r in explored)
