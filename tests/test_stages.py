"""Stage tables: published whole or not at all, refused when changed, freed by scopes."""

import os

import pytest
from pyspark.sql import functions as F

from kinrate import load_prepared, prepare, recommend, run_batch, scratch
from kinrate.plans import storage
from kinrate.plans.storage import IncompleteStage, read_manifest, read_stage, rows_of, stage, write_stage
from tests import reference_math as plain


def tables(spark):
    return {name for name in os.listdir(storage.shared_dir(spark)) if name.startswith("kinrate-")}


def parts(path, manifest):
    return sorted(f"{path}/{manifest['attempt']}/{name}" for name in manifest["files"])


def test_a_manifest_names_files_and_rows(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert read_stage(spark, path) is None and read_manifest(spark, path) is None
    manifest = write_stage(spark.range(100).repartition(4), path)
    assert manifest == read_manifest(spark, path)
    assert manifest["rows"] == 100 and len(manifest["files"]) == 4
    found = read_stage(spark, path)
    assert rows_of(found) == found.count() == 100
    assert sorted(f.removeprefix("file://") for f in found.inputFiles()) == parts(path, manifest)
    empty = write_stage(spark.range(0), f"{tmp_path}/empty")
    assert empty["rows"] == 0 and read_stage(spark, f"{tmp_path}/empty").count() == 0


def test_a_write_that_was_cut_off_is_no_table(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    broken = spark.range(10).select(F.raise_error(F.lit("lost")).cast("bigint").alias("id"))
    with pytest.raises(Exception, match="lost"):
        write_stage(broken, path)
    assert read_stage(spark, path) is None
    # all files there, but ended before the manifest
    monkeypatch.setattr(storage, "_publish", lambda *a: (_ for _ in ()).throw(OSError("ended")))
    with pytest.raises(OSError):
        write_stage(spark.range(10), path)
    assert read_stage(spark, path) is None
    monkeypatch.undo()
    write_stage(spark.range(7), path)
    assert read_stage(spark, path).count() == 7


def test_a_repeat_replaces_the_table_in_one_step(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    first = write_stage(spark.range(5), path)
    monkeypatch.setattr(storage, "_publish", lambda *a: (_ for _ in ()).throw(OSError("ended")))
    with pytest.raises(OSError):
        write_stage(spark.range(6), path)
    monkeypatch.undo()
    assert read_manifest(spark, path) == first and read_stage(spark, path).count() == 5
    write_stage(spark.range(6), path)
    assert read_stage(spark, path).count() == 6
    assert not os.path.exists(f"{path}/{first['attempt']}")


@pytest.mark.parametrize("change", ["lose", "add", "cut"])
def test_changed_files_are_refused(spark, tmp_path, change):
    path = f"{tmp_path}/t"
    manifest = write_stage(spark.range(100).repartition(3), path)
    first = parts(path, manifest)[0]
    if change == "lose":
        os.remove(first)
    elif change == "add":
        with open(os.path.join(os.path.dirname(first), "part-99999.parquet"), "wb"):
            pass
    else:
        with open(first, "r+b") as file:
            file.truncate(10)
    with pytest.raises(IncompleteStage):
        read_stage(spark, path)


def test_scopes_free_what_they_made(spark):
    before = tables(spark)
    with scratch() as outer:
        with scratch() as inner:
            stage(spark.range(5), "a")
            kept = inner.keep(spark.range(3), "b")
            assert len(tables(spark) - before) == 2
        assert len(tables(spark) - before) == 1 and kept.count() == 3
        last = outer.keep(kept, "c")
    assert len(tables(spark) - before) == 1 and last.count() == 3
    with pytest.raises(ZeroDivisionError), scratch():
        stage(spark.range(5), "a")
        raise ZeroDivisionError
    assert len(tables(spark) - before) == 1


def test_a_batch_and_recommendations_leave_nothing(spark, ratings_of, targets_of, tmp_path):
    raw = ratings_of(plain.random_users(8)).withColumn("timestamp", F.lit(1).cast("bigint"))
    before = tables(spark)
    run_batch(raw, targets_of(4), f"{tmp_path}/batch", k=5)
    assert tables(spark) == before
    with scratch():
        rows = recommend(prepare(raw), [2, 3, 99], n=3).collect()
    assert tables(spark) == before and {r.targetId for r in rows} == {2, 3, 99}


def test_prepared_tables_count_only_when_published(spark, ratings_of, targets_of, tmp_path):
    raw = ratings_of(plain.random_users(8)).withColumn("timestamp", F.lit(1).cast("bigint"))
    folder = f"{tmp_path}/prepared"
    assert load_prepared(spark, folder) is None
    base = prepare(raw, folder=folder)
    assert load_prepared(spark, folder).ratings.count() == base.ratings.count()
    os.remove(f"{folder}/user_averages/{storage.MANIFEST}")
    assert load_prepared(spark, folder) is None
    # the tables of a batch are plain ones, committed by Spark
    run_batch(raw, targets_of(4), f"{tmp_path}/batch", k=5)
    assert load_prepared(spark, f"{tmp_path}/batch").averages.count() == 30
    os.remove(f"{tmp_path}/batch/ratings_clean/_SUCCESS")
    assert load_prepared(spark, f"{tmp_path}/batch") is None


def test_a_local_folder_is_refused_on_a_cluster(spark, monkeypatch):
    monkeypatch.setattr(storage, "CHECKPOINT_DIR", "spark.no.such.dir")
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    assert "kinrate-stages" in storage.shared_dir(spark)  # one machine
    monkeypatch.setattr(spark.sparkContext, "master", "spark://far:7077")
    with pytest.raises(ValueError, match="no.such.dir"):
        storage.shared_dir(spark)
