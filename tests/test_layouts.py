"""Stored ratings in order of items and of users, and what scans skip because of it."""

import pytest

from kinrate.catalog import queries
from kinrate.operators.joins import one_of
from kinrate.plans import prepared
from kinrate.plans.prepared import Prepared, load_prepared, load_targets, pooled_similarities, prepare
from kinrate.sources import orders
from tests.test_similarity import scores

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_read(df):
    """Rows that the scan of a table without shuffles hands on, before any filter."""
    query = df._jdf.queryExecution()
    assert query.toRdd().count() >= 0
    scan = query.executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    patch = pytest.MonkeyPatch()
    patch.setattr(prepared, "ROW_GROUP_BYTES", 2048)
    folder = str(tmp_path_factory.mktemp("layouts"))
    made = prepare(orders.raw_ratings(spark, DATA), orders.RECENCY, folder=folder)
    patch.undo()
    return made, folder


def test_both_orders_hold_the_same_rows(spark, base):
    made, folder = base
    again = load_prepared(spark, folder)
    for table in (made.by_user, again.ratings, again.by_user):
        assert table.exceptAll(made.ratings).count() == 0 and table.count() == made.ratings.count()


def test_a_look_up_reads_few_row_groups(base):
    made, _ = base
    whole = made.ratings.count()
    assert rows_read(made.of_items([3])) < whole / 3
    assert rows_read(made.of_users([3])) < whole / 3
    items = list(range(0, 200, 10))  # twenty items far apart
    assert rows_read(made.of_items(items)) < whole
    assert made.of_items(items).count() == made.ratings.filter(f"movieId IN ({str(items)[1:-1]})").count()
    # in the other order the same items are everywhere
    assert rows_read(made.by_user.filter(one_of("movieId", [3]))) > rows_read(made.of_items([3]))


def test_targets_and_predictions_skip(base, targets_of, monkeypatch):
    made, _ = base
    few = load_targets(made, targets_of(10))
    near = few.similarities().limit(40)
    found = few.predictions(near)
    assert "In(movieId" in plan_of(few.similarities()) and "In(userId" in plan_of(found)
    expected, predicted = scores(few.similarities()), sorted(map(tuple, found.collect()))
    monkeypatch.setattr(prepared, "LOOKUP_IDS", 0)
    many = load_targets(made, targets_of(10))
    assert many.items is None and "In(movieId" not in plan_of(many.similarities())
    assert scores(many.similarities()) == expected
    # one layout alone does as well
    single = load_targets(Prepared(made.ratings, made.averages), targets_of(10))
    assert sorted(map(tuple, single.predictions(near).collect())) == predicted


def test_new_user_neighbours_read_the_items_of_the_profile_only(spark):
    plan = plan_of(queries.profile_neighbors(spark, DATA))
    assert "In(movieId" in plan


def test_no_values_is_no_row(spark):
    assert spark.range(5).filter(one_of("id", [])).count() == 0
    assert spark.range(50).filter(one_of("id", range(3, 40))).count() == 37


def test_pooled_form_shuffles_sums_not_ratings(base, targets_of):
    made, _ = base
    plan = plan_of(pooled_similarities(made, targets_of(10, 3)))
    # each exchange carries partial sums or broadcast tables, and none takes rating rows
    assert "hashpartitioning(movieId" not in plan and "hashpartitioning(_share" not in plan
    assert plan.count("FileScan") <= 6 and "collect_set" in plan
