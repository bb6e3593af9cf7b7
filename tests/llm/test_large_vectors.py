"""Search over vectors with components of any size."""

import random

import pytest
from pyspark.sql import functions as F

from kinrate.llm.topk_search import top_k, whole_vectors

MOST = 1 << 63


@pytest.mark.parametrize("kind", ["float", "double"])
def test_large_components_take_part(spark, kind):
    random_ = random.Random(6)
    vectors = {i: [random_.uniform(-1, 1) for _ in range(4)] for i in range(1, 120)}
    vectors |= {
        200: [20000.5, -0.3, 0.1, 0.0],
        201: [-123456.75, 0.2, 3e5, 1.0],
        202: [1e6, 1e6, 1e6, 1e6],
        203: [2.5e9, -2.5e9, 0.5, 0.0],
        204: [2.5e9, 2.5e9, 0.5, 0.0],  # with 203 the products cancel out
        205: [1e18, 0.0, 1e-3, 0.0],
        206: [3e38, 0.0, 0.0, 0.0],
        207: [-3e38, 1.0, 0.0, 0.0],
        208: [0.0, 0.0, 0.0, 1.0],
    }
    rows = spark.createDataFrame([*vectors.items()], f"vec_id bigint, embedding array<{kind}>")
    exact = {r.vec_id: [int((x * 1024) // 1) for x in r.embedding] for r in rows.collect()}
    queries = [1, 2, 200, 201, 202, 203, 204, 205, 206, 207, 208]
    whole = whole_vectors(rows)
    assert whole.count() == len(vectors)
    expected = []
    for q in queries:
        scores = [(-sum(a * b for a, b in zip(exact[q], exact[c])), c) for c in vectors if c != q]
        for n, (s, c) in enumerate(sorted(scores)[:10], 1):
            expected.append((q, n, c, -s if -MOST <= -s < MOST else None))
    got = top_k(whole.where(F.col("vec_id").isin(queries)), whole, k=10).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)
    assert any(e[3] is None for e in expected)


def test_a_component_that_cannot_be_scaled_takes_no_part(spark):
    rows = spark.createDataFrame([(1, [1e308]), (2, [1.0]), (3, [2.0])], "vec_id bigint, embedding array<double>")
    whole = whole_vectors(rows)
    assert sorted(r.vec_id for r in whole.collect()) == [2, 3]
    got = top_k(whole.where("vec_id = 2"), whole, k=10).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(2, 1, 3, 2 << 20)]


def test_rows_that_share_an_id_are_vectors_of_their_own(spark):
    vectors = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 1.0]), (2, [1.0, 3.0]), (3, [2.0, 2.0])]
    vectors += [(4, [0.5, 0.5])] * 30
    rows = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
    whole = whole_vectors(rows)
    got = top_k(whole.where("vec_id = 1"), whole, k=7).collect()
    scores = sorted(
        (-int(sum(a * b for a, b in zip(v, w)) * 1024 * 1024), c) for q, v in vectors for c, w in vectors if q == 1 and c != 1
    )
    assert sorted((r["rank"], -r.score, r.vec_id) for r in got) == [(n, s, c) for n, (s, c) in enumerate(scores[:7], 1)]
