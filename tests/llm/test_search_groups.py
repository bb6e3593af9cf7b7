"""Search in groups of candidate blocks: the copies of the query blocks never go through the driver."""

import random

import pytest

from kinrate.llm import topk_search


@pytest.fixture
def vectors(spark):
    random_ = random.Random(11)
    rows = [(i, [float(random_.randrange(-9, 10)) for _ in range(random_.randrange(1, 6))]) for i in range(150)]
    return rows, topk_search.whole_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))


def small_blocks(monkeypatch, bytes_):
    for name, value in {"QUERY_BLOCK": 4, "CANDIDATE_BLOCK": 8, "GROUPS": 3, "GROUP_BYTES": bytes_}.items():
        monkeypatch.setattr(topk_search, name, value)


def test_query_blocks_are_not_broadcast(vectors, monkeypatch):
    small_blocks(monkeypatch, 1 << 20)
    whole = vectors[1]
    found = topk_search.top_k(whole.where("vec_id % 5 = 0"), whole)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bytes_, at_once", [(1 << 20, 6), (450, 2), (1, 1)])
def test_groups_change_no_result(vectors, monkeypatch, bytes_, at_once):
    small_blocks(monkeypatch, bytes_)
    rows, whole = vectors
    assert topk_search._group_blocks(whole, 19) == at_once
    expected = []
    for q, v in rows[::5]:
        scores = sorted((-int(1024 * 1024 * sum(a * b for a, b in zip(v, w))), c) for c, w in rows if c != q)
        expected += [(q, n, c, -s) for n, (s, c) in enumerate(scores[:10], 1)]
    got = topk_search.top_k(whole.where("vec_id % 5 = 0"), whole).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)
