"""Batches that a snapshot contains."""

import pytest

from kinrate.llm.token_counts import TokenCounts


def test_a_merged_batch_committed_again_counts_once(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, old_tokens bigint, new_tokens bigint"
    changes = lambda n: spark.createDataFrame([("s", "en", "t", None, n)], schema)
    totals = lambda store: [(r.n_docs, r.n_tokens) for r in store.totals().collect()]
    store = TokenCounts(spark, str(tmp_path / "store"))
    store.commit("a", changes(5))
    merged = store.snapshot(str(tmp_path / "merged"))
    merged.commit("a", changes(5))
    assert totals(merged) == [(1, 5)]
    merged.commit("b", changes(7))
    merged.commit("b", changes(7))
    assert totals(merged) == [(2, 12)]
    again = merged.snapshot(str(tmp_path / "again"))
    for name in ("a", "b"):
        again.commit(name, changes(9))
    assert totals(again) == [(2, 12)]
    assert {r.batch_id for r in again.batches().collect()} == {"a", "b", "snapshot"}
    with pytest.raises(ValueError):
        again.commit("snapshot", changes(1))
