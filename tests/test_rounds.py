"""Pairs of users found in rounds: the same pairs, and room for one round's lists at a time."""

import time
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from kinrate import nearest_of_all
from kinrate.operators.stats import user_averages
from kinrate.plans import prepared as plans, storage
from kinrate.plans.prepared import Prepared, all_pairs, load_targets, pair_rounds
from kinrate.plans.storage import rows_of, stage, stage_parts
from tests import reference_math as plain
from tests.test_neighbors_of_all import expected_best, found_best
from tests.test_pair_lists import expected_pairs, found_pairs


@pytest.fixture
def rounds(monkeypatch):
    """The folders that rounds were stored in, where a few pairs make one."""
    made = []

    def counted(parts, name):
        df = stage_parts(parts, name)
        made.append(df._kinrate_path)
        return df

    monkeypatch.setattr(plans, "PAIR_ROWS", 100)
    monkeypatch.setattr(plans, "ROUND_VALUES", 1)
    monkeypatch.setattr(plans, "ROUND_VALUES_EACH", 5)
    monkeypatch.setattr(plans, "stage_parts", counted)
    return made


def base_of(ratings):
    return Prepared(stage(ratings, "ratings"), stage(user_averages(ratings), "averages"))


def parts_of(spark, path):
    place, files = storage._path(spark, path)
    return len(files.listStatus(place))


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("raters", [4, 1000])
def test_rounds_find_the_nearest_of_all(spark, ratings_of, rounds, raters):
    users = plain.random_users(1, users=24, items=18, share=0.25, everyone=(0, 5))
    found = nearest_of_all(base_of(ratings_of(users)), 3, 3, raters)
    assert found_best(found) == expected_best(users, 3, 3)
    assert [parts_of(spark, path) > 2 for path in rounds] == [True]


@pytest.mark.parametrize("raters", [4, 1000])
def test_rounds_find_all_pairs(spark, ratings_of, rounds, raters):
    users = plain.random_users(2, users=24, items=18, share=0.25, everyone=(0, 5))
    found = all_pairs(base_of(ratings_of(users)), 3, raters)
    assert found_pairs(found) == expected_pairs(users, 3)
    assert [parts_of(spark, path) > 1 for path in rounds] == [True]


@pytest.mark.parametrize("raters", [4, 1000])
def test_rounds_find_the_neighbors_of_everybody_and_of_many(ratings_of, targets_of, rounds, raters):
    users = plain.random_users(3, users=24, items=18, share=0.25, everyone=(0, 5))
    base = base_of(ratings_of(users))
    expected = sorted(
        (a, b, score, common)
        for a in users
        for b, (score, common) in plain.similarities(users, a, 3).items()
    )
    names = "targetId", "userId", "similarity", "common_movies"
    many = sorted(users)[:20]
    for chosen, everybody in ((users, True), (many, False)):
        targets = replace(load_targets(base, targets_of(*chosen), raters), small=False)
        assert targets.everybody is everybody
        wanted = [row for row in expected if row[0] in chosen]
        assert rows(targets.similarities(), *names) == wanted
        counts = targets.co_rated_counts()
        assert rows(counts, "targetId", "userId", "common_movies") == [(a, b, n) for a, b, _, n in wanted]
    assert len(rounds) == 4


def test_rounds_follow_the_values_in_lists(ratings_of, monkeypatch):
    ratings = stage(ratings_of({u: {1: 3.0, 2: 4.0} for u in range(1, 11)}), "rows")
    left = ratings.select(F.col("userId").alias("u"), "movieId")
    seen = []

    def found(some, tasks):
        seen.append((rows_of(some), tasks))
        return some

    monkeypatch.setattr(plans, "PAIR_ROWS", 10)
    for least, above, made in ((400, False, 1), (399, False, 2), (200, True, 1), (100, False, 4)):
        monkeypatch.setattr(plans, "ROUND_VALUES", least)
        monkeypatch.setattr(plans, "ROUND_VALUES_EACH", 1)
        seen.clear()
        assert pair_rounds(found, left, ratings, "u", above, 20, "pairs").count() == 20
        assert [tasks for _, tasks in seen] == [-(-20 // made)] * made
        assert sum(count for count, _ in seen) == 20


def test_what_a_stage_shuffled_is_freed(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {name for name in names if name.startswith("shuffle_")}

    before = shuffled()
    wide = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    setting = spark.conf.get(storage.FILE_CLEANUP)
    assert rows_of(stage(wide, "wide")) == 7
    assert spark.conf.get(storage.FILE_CLEANUP) == setting
    for _ in range(50):
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert wide.count() == 7  # shuffled again
