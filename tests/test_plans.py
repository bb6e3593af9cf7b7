"""What the plans look like, and that stages go where the cluster says."""

import os

import pytest

from kinrate.operators.similarity import top_k_neighbors
from kinrate.plans import batch, storage
from kinrate.plans.prepared import load_targets, prepare
from tests import reference_math as plain

DATA = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def raw(spark, ratings_of):
    from pyspark.sql import functions as F

    return ratings_of(plain.random_users(8)).withColumn("timestamp", F.lit(1).cast("bigint"))


@pytest.fixture(scope="module")
def base(raw):
    return prepare(raw)


def test_stages_are_written_below_the_configured_folder(spark, base):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert storage.shared_dir(spark) == folder
    assert all(folder in name for name in base.ratings.inputFiles())
    assert any(name.startswith("kinrate-") for name in os.listdir(folder))


def test_targets_are_broadcast_after_counting(base, targets_of, monkeypatch):
    small = load_targets(base, targets_of(1))
    assert small.small and "BroadcastHashJoin" in plan_of(small.similarities())
    monkeypatch.setattr(storage.few_rows, "__defaults__", (1,))
    large = load_targets(base, targets_of(1))
    assert not large.small and "_share" in plan_of(large.similarities())
    assert sorted(map(tuple, small.similarities().collect())) == sorted(
        map(tuple, large.similarities().collect())
    )


def test_only_the_needed_columns_are_read(base, targets_of):
    plan = plan_of(load_targets(base, targets_of(1)).co_rated_counts())
    assert "ReadSchema: struct<userId:int,movieId:int>" in plan


def test_top_k_is_cut_before_the_shuffle(base, targets_of):
    plan = plan_of(top_k_neighbors(load_targets(base, targets_of(1)).similarities(), 5))
    assert "row_number(), 5, Partial" in plan


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json"])
def test_batch_tables_agree_with_the_definitions(raw, base, targets_of, tmp_path, fmt):
    users = plain.random_users(8)
    tables = batch.run_batch(raw, targets_of(4), str(tmp_path / fmt), k=5, fmt=fmt)
    assert set(os.listdir(tmp_path / fmt)) == set(tables)
    scores = {r.userId: (r.similarity, r.common_movies) for r in tables["similarity_scores"].collect()}
    assert scores == plain.similarities(users, 4)
    weights = {r.userId: r.similarity for r in tables["top_similar_users"].collect()}
    assert len(weights) == 5
    predicted = {
        r.movieId: (r.predicted_rating, r.num_raters, r.avg_similarity)
        for r in tables["predicted_ratings"].collect()
    }
    assert predicted == plain.predictions(users, 4, weights)
    final = tables["final_recommendations"].orderBy("rank").collect()
    ranked = sorted(predicted, key=lambda i: (-predicted[i][0], -predicted[i][1], i))
    assert [r.movieId for r in final] == ranked[: len(final)]


def test_prepared_tables_are_shared_while_the_files_stay_the_same(spark, tmp_path):
    import shutil

    from kinrate.catalog import queries

    folder = tmp_path / "tables"
    folder.mkdir()
    for name in ("lineitem", "orders"):
        shutil.copyfile(f"{DATA}/{name}.parquet", folder / f"{name}.parquet")
    first = queries.prepared(spark, str(folder)).ratings.inputFiles()
    assert queries.prepared(spark, str(folder)).ratings.inputFiles() == first
    shutil.copyfile("/root/testdata/sf0.01/lineitem.parquet", folder / "lineitem.parquet")
    changed = queries.prepared(spark, str(folder)).ratings
    assert changed.inputFiles() != first
    for key, place in list(queries._STORED.items()):
        if key[2] == str(folder):
            queries._STORED[key] = str(tmp_path / "gone")
    again = queries.prepared(spark, str(folder)).ratings
    assert again.inputFiles() != changed.inputFiles() and again.count() == changed.count()
