"""Averages kept up to date by changes against averages worked out anew."""

import random

import pytest

from kinrate.operators.stats import user_averages
from kinrate.plans import maintained, storage
from kinrate.plans.maintained import MaintainedAverages, rating_changes


def rows(df):
    return sorted((r.userId, r.avg_rating, r.num_ratings) for r in df.collect())


def versions(seed, count):
    """Rating tables, each from the one before by inserts, revisions and removals."""
    pick, table, made = random.Random(seed), {}, []
    for _ in range(count):
        for _ in range(60):
            key = pick.randrange(8), pick.randrange(12)
            if key in table and pick.random() < 0.4:
                del table[key]
            else:
                table[key] = pick.choice([0.5, 1.0, 3.5, 4.1, 5.0])
        made.append(dict(table))
    return made


def frame(spark, table):
    return spark.createDataFrame([(u, i, r) for (u, i), r in table.items()], "userId bigint, movieId bigint, rating double")


def test_changes_in_any_order_equal_a_rebuild(spark, tmp_path):
    made = [{}, *versions(1, 4)]
    changes = [(f"b{i}", rating_changes(frame(spark, a), frame(spark, b))) for i, (a, b) in enumerate(zip(made, made[1:]))]
    store = MaintainedAverages(spark, f"{tmp_path}/store")
    assert rows(store.averages()) == [] and store.batches() == []
    for name, change in changes[::-1]:
        assert store.commit(name, change)
    expected = rows(user_averages(frame(spark, made[-1])))
    assert rows(store.averages()) == expected and expected
    assert store.batches() == ["b0", "b1", "b2", "b3"]
    # again, as after lost answers
    assert not any(store.commit(name, change) for name, change in changes)
    assert rows(store.averages()) == expected
    # everything taken back
    store.commit("back", rating_changes(frame(spark, made[-1]), frame(spark, {})))
    assert rows(store.averages()) == []


def test_a_snapshot_knows_its_batches(spark, tmp_path, monkeypatch):
    first, second, third = versions(2, 3)
    store = MaintainedAverages(spark, f"{tmp_path}/store")
    one, two = rating_changes(frame(spark, {}), frame(spark, first)), rating_changes(frame(spark, first), frame(spark, second))
    store.commit("one", one)
    store.commit("two", two)
    # ended between the snapshot and the removal of its batches
    monkeypatch.setattr(maintained, "delete", lambda *a: (_ for _ in ()).throw(OSError("ended")))
    with pytest.raises(OSError):
        store.compact()
    monkeypatch.undo()
    assert rows(store.averages()) == rows(user_averages(frame(spark, second)))
    assert not store.commit("one", one)
    store.compact()
    assert storage.published(spark, f"{tmp_path}/store/batches") == []
    assert not store.commit("two", two) and store.batches() == ["one", "two"]
    store.commit("three", rating_changes(frame(spark, second), frame(spark, third)))
    store.compact()
    assert rows(store.averages()) == rows(user_averages(frame(spark, third)))
    assert store.batches() == ["one", "three", "two"]


def test_odd_changes(spark, tmp_path):
    store = MaintainedAverages(spark, f"{tmp_path}/store")
    with pytest.raises(ValueError):
        store.commit("../up", frame(spark, {}))
    changes = spark.createDataFrame(
        [(1, None, 4.0), (1, None, 3.0), (1, 3.0, 3.0), (None, None, 5.0), (2, None, None)],
        "userId bigint, old_rating double, new_rating double",
    )
    store.commit("a", changes)
    assert rows(store.averages()) == [(1, 3.5, 2)]
    store.compact()
    assert rows(store.averages()) == [(1, 3.5, 2)]
    broken = spark.range(3).selectExpr("id userId", "raise_error('lost') old_rating", "1.0 new_rating")
    with pytest.raises(Exception, match="lost"):
        store.commit("b", broken)
    assert store.batches() == ["a"] and rows(store.averages()) == [(1, 3.5, 2)]
