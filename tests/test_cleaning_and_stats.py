import pytest
from pyspark.sql import functions as F

from kinrate.operators import cleaning, stats

DIRTY = [
    (1, 1, 3.0, 10),
    (1, 1, 4.0, 20),  # newest of the pair
    (1, 1, 2.0, 15),
    (1, 2, 5.5, 10),  # out of range
    (2, 1, 4.5, 5),
    (2, 1, 0.0, 9),  # newest, but out of range
    (None, 1, 3.0, 1),
    (3, None, 3.0, 1),
    (3, 1, None, 1),
    (4, 2, 0.5, 7),
    (4, 2, 1.5, 7),  # same time: the higher rating stays
]


@pytest.fixture(scope="module")
def dirty(spark):
    return spark.createDataFrame(DIRTY, "userId int, movieId int, rating double, timestamp bigint")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_range_first_keeps_an_older_valid_rating(dirty):
    assert rows(cleaning.clean_ratings(dirty)) == [(1, 1, 4.0), (2, 1, 4.5), (4, 2, 1.5)]


def test_range_last_lets_the_newest_row_evict_its_pair(dirty):
    kept = cleaning.clean_ratings(dirty, range_first=False)
    assert rows(kept) == [(1, 1, 4.0), (4, 2, 1.5)]


def test_range_can_be_switched_off(dirty):
    kept = cleaning.clean_ratings(dirty, rating_range=None)
    assert rows(kept) == [(1, 1, 4.0), (1, 2, 5.5), (2, 1, 0.0), (4, 2, 1.5)]


def test_audit_counts_each_step(dirty):
    audit = cleaning.cleaning_audit(dirty).first().asDict()
    assert audit == {
        "initial_rows": 11,
        "after_nulls": 8,
        "removed_nulls": 3,
        "after_duplicates": 4,
        "removed_duplicates": 4,
        "final_rows": 2,
        "removed_out_of_range": 2,
        "removed_total": 9,
        "removed_pct": 81.82,
    }


def test_audit_of_nothing(dirty):
    audit = cleaning.cleaning_audit(dirty.limit(0)).first()
    assert audit.initial_rows == audit.final_rows == 0 and audit.removed_pct is None


def test_copies_of_one_pair_are_reduced_before_the_shuffle(dirty):
    plan = cleaning.clean_ratings(dirty)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_dataset_and_matrix_numbers(ratings_of):
    ratings = ratings_of({1: {1: 4, 2: 5}, 2: {1: 1}, 3: {3: 2}})
    assert stats.dataset_stats(ratings).first().asDict() == {
        "num_users": 3,
        "num_movies": 3,
        "total_ratings": 4,
        "avg_rating": 3.0,
        "sparsity_pct": 55.56,
    }
    info = stats.matrix_info(ratings).first()
    assert (info.total_cells, info.null_cells) == (9, 5)
    assert (info.sparsity_pct, info.density_pct) == (55.56, 44.44)


def test_rating_distribution_is_in_order(ratings_of):
    ratings = ratings_of({1: {1: 4, 2: 0.5, 3: 4}})
    got = [tuple(r) for r in stats.rating_distribution(ratings).collect()]
    assert got == [(0.5, 1, 33.33), (4.0, 2, 66.67)]


def test_matrix_sample_is_a_corner(ratings_of):
    ratings = ratings_of({u: {u: u / 2, 9: 1.0} for u in range(1, 8)})
    sample = stats.matrix_sample(ratings, [1, 2, 6], users=3)
    assert sample.columns == ["userId", "movie_1", "movie_2", "movie_6"]
    assert rows(sample) == [(1, 0.5, None, None), (2, None, 1.0, None)]


def test_averages_are_rounded_to_three_digits(ratings_of):
    averages = stats.user_averages(ratings_of({1: {1: 4, 2: 4, 3: 3}, 2: {1: 0.5}}))
    assert rows(averages) == [(1, 3.667, 3), (2, 0.5, 1)]
    assert rows(stats.eligible_users(averages, 3)) == [(1, 3.667, 3)]


def test_column_summary_uses_the_sample_deviation(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 2.0)], "k string, x double")
    whole = stats.column_summary(df, "x", digits=4).first()
    assert tuple(whole) == (2.0, 1.0, 1.0, 3.0)
    by_key = {r.k: r.std_dev for r in stats.column_summary(df, "x", ["k"], 4).collect()}
    assert by_key == {"a": 1.4142, "b": 0.0}
    assert tuple(stats.column_summary(df.limit(0), "x").first()) == (0.0, 0.0, 0.0, 0.0)


def test_top_and_bottom_users(spark):
    averages = spark.createDataFrame(
        [(1, 4.0, 5), (2, 4.0, 9), (3, 1.0, 2), (4, 1.0, 2)],
        "userId int, avg_rating double, num_ratings bigint",
    )
    got = {(r.side, r["rank"]): r.userId for r in stats.top_bottom_users(averages, 2).collect()}
    assert got == {
        ("highest", 1): 2,
        ("highest", 2): 1,
        ("lowest", 1): 3,
        ("lowest", 2): 4,
    }


def test_histogram_puts_the_maximum_in_the_last_bin(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 0.04, 0.05, 0.15, 1.0, 0.99, None)], "x double")
    got = {r.bin: r["count"] for r in stats.histogram(df, "x", 0.0, 1.0).collect()}
    assert got == {0: 2, 1: 1, 3: 1, 19: 2}


def test_value_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "x int")
    assert rows(stats.value_counts(df, F.col("x") > 1, "big")) == [(False, 2), (True, 1)]
