"""Exact top-k search by inner product, term at a time.

Vectors are turned into whole numbers. Query rows and candidates are packed into blocks;
every query block meets every candidate block, a bounded piece of work that holds one
dense array of scores. Candidate blocks stand in groups, each in one task, to which a copy of all
query blocks is shuffled; neither side goes through the driver. Per component (term), the queries that have it scatter its weight
times the candidates' postings of that component into the array. The best k of each
query are selected in each block, and a last top-k over blocks merges them.

Scores are exact at every size of the components: pairs whose products could leave 64 bits are
added up as Python's integers. They are ranked by their true scores; a score that does not fit
in a signed 64-bit integer is shown as null.

A vector that is null, or holds a null, a NaN or an infinite component, takes no part; nor does a
row with a null id, nor a vector with a component that is infinite when scaled (of type double,
beyond 2**1013). A missing component of
a shorter vector is 0. Rows that repeat an id are vectors of their own and no candidates of each
other; as queries they share one list of the k best. Ties go to the smaller id. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from kinrate.llm.shipping import arrow_rows
from kinrate.plans.storage import rows_of, stage

SCALE = 1024
K = 10
QUERY_BLOCK = 512
CANDIDATE_BLOCK = 4096
GROUPS = 64  # of candidate blocks, as long as groups stay within the next two
GROUP_BLOCKS = 16
GROUP_BYTES = 64 << 20
SAFE = float(1 << 62)  # sums of magnitudes up to here are exact in 64 bits
WHOLE = float(1 << 52)  # doubles from here on are whole numbers

_RESULT = "query_id bigint, vec_id bigint, score bigint, beyond int, size binary"


def whole_vectors(rows: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id and weights: floor(scale * x) of each component x, a whole number as a double."""

    def usable(x: Column) -> Column:
        value = x.cast("double") * scale
        return x.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))

    def weight(x: Column) -> Column:
        scaled = x.cast("double") * scale
        return F.when(F.abs(scaled) < WHOLE, F.floor(scaled).cast("double")).otherwise(scaled)

    return (
        rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .where(F.forall("embedding", usable))
        .select(F.col("vec_id").cast("bigint"), F.transform("embedding", weight).alias("weights"))
    )


def _block(count: int) -> Column:
    # by row and not by id, of which one may stand in a third of all rows
    return F.pmod(F.xxhash64("row"), F.lit(count))


def _blocks(vectors: DataFrame, name: str, *keys: str) -> DataFrame:
    return vectors.groupBy(*keys).agg(F.collect_list(F.struct("vec_id", "weights")).alias(name))


def _group_blocks(candidates: DataFrame, blocks: int) -> int:
    """How many candidate blocks stand in a group: all of them wait in memory for the query blocks."""
    most = min(blocks // GROUPS, GROUP_BLOCKS)
    if most < 2:
        return 1
    components = candidates.agg(F.sum(F.size("weights").cast("bigint"))).first()[0]
    return max(1, min(most, GROUP_BYTES * blocks // max(1, 8 * components)))


def _matrix(vectors: pa.StructArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids in order and their weights, one row each, padded with 0."""
    ids, lists = vectors.field("vec_id").to_numpy(), vectors.field("weights")
    bounds = lists.offsets.to_numpy()
    sizes = np.diff(bounds)
    flat = lists.values.to_numpy()[bounds[0] : bounds[-1]]
    matrix = np.zeros((len(ids), width), dtype=np.float64)
    row = np.repeat(np.arange(len(ids)), sizes)
    matrix[row, np.arange(len(flat)) - np.repeat(bounds[:-1] - bounds[0], sizes)] = flat
    order = np.argsort(ids)
    return ids[order], matrix[order]


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of all rows, one component after the other."""
    scores = np.zeros((len(queries), len(candidates)), dtype=np.int64)
    for term in range(queries.shape[1]):
        having = np.flatnonzero(queries[:, term])
        postings = np.flatnonzero(candidates[:, term])
        weights = candidates[postings, term]
        for q in having.tolist():
            if len(postings) == len(candidates):
                scores[q] += queries[q, term] * weights
            else:
                scores[q, postings] += queries[q, term] * weights
    return scores


def exact_scores(queries: np.ndarray, candidates: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Inner products of whole numbers given as doubles, and the pairs that left 64 bits open.

    Without such pairs the scores are 64-bit, otherwise Python's integers.
    """
    whole = [np.where(np.abs(m) <= SAFE, m, 0).astype(np.int64) for m in (queries, candidates)]
    most = [np.abs(m).max(initial=0.0) for m in (queries, candidates)]
    if max(most) <= SAFE and most[0] * most[1] * queries.shape[1] <= SAFE:
        return accumulate(*whole), []
    # the magnitudes' sum bounds every partial sum; the margin covers rounding
    with np.errstate(over="ignore", invalid="ignore"):
        bound = np.abs(queries) @ np.abs(candidates).T
    wide = ~(bound * (1 + 1e-6) <= SAFE)
    # a weight beyond 64 bits is 0 in whole, right only beside a 0
    large = [(np.abs(m) > SAFE).any(axis=1) for m in (queries, candidates)]
    wide |= large[0][:, None] | large[1][None, :]
    scores = accumulate(*whole).astype(object)
    pairs = np.argwhere(wide).tolist()
    integers: list[dict[int, list[int]]] = [{}, {}]
    for i, j in pairs:
        a, b = (
            kept.get(n) or kept.setdefault(n, [int(x) for x in m[n].tolist()])
            for kept, n, m in zip(integers, (i, j), (queries, candidates))
        )
        scores[i, j] = sum(x * y for x, y in zip(a, b))
    return scores, pairs


def _ordered_bytes(value: int) -> bytes:
    """Bytes of one length in the order of the numbers: products of doubles take some 2100 bits."""
    return (value + (1 << 2200)).to_bytes(280, "big")


def _best_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                wanted, rows = (batch.column(n)[i : i + 1].flatten() for n in ("queries", "candidates"))
                width = max(
                    int(np.diff(x.field("weights").offsets.to_numpy()).max(initial=0)) for x in (wanted, rows)
                )
                query_ids, queries = _matrix(wanted, width)
                ids, candidates = _matrix(rows, width)
                scores, _ = exact_scores(queries, candidates)
                found = []
                for query, row in zip(query_ids.tolist(), scores):
                    others = np.flatnonzero(ids != query)
                    own = row[others]
                    if len(others) > k:
                        least = np.partition(own, len(own) - k)[len(own) - k]
                        others = others[own >= least]
                        own = row[others]
                    if own.dtype == object:
                        best = np.array(
                            sorted(range(len(own)), key=lambda n: (-own[n], ids[others[n]]))[:k], dtype=np.int64
                        )
                    else:
                        best = np.lexsort((ids[others], -own))[:k]
                    found += [(query, int(ids[others[n]]), int(own[n])) for n in best.tolist()]
                beyond = [(s >= 1 << 63) - (s < -(1 << 63)) for _, _, s in found]
                columns = [
                    pa.array([q for q, _, _ in found], pa.int64()),
                    pa.array([c for _, c, _ in found], pa.int64()),
                    pa.array([None if b else s for (_, _, s), b in zip(found, beyond)], pa.int64()),
                    pa.array(beyond, pa.int32()),
                    pa.array([_ordered_bytes(s) if b else None for (_, _, s), b in zip(found, beyond)], pa.binary()),
                ]
                yield pa.record_batch(columns, names=["query_id", "vec_id", "score", "beyond", "size"])

    return run


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id and score of the k best other rows of each query.

    Both sides as from ``whole_vectors``.
    """
    queries, candidates = (
        stage(side.select("vec_id", "weights", F.monotonically_increasing_id().alias("row")), name)
        for side, name in ((queries, "queries"), (candidates, "candidates"))
    )
    query_blocks = -(-max(1, rows_of(queries)) // QUERY_BLOCK)
    candidate_blocks = -(-max(1, rows_of(candidates)) // CANDIDATE_BLOCK)
    at_once = _group_blocks(candidates, candidate_blocks)
    groups = -(-candidate_blocks // at_once)
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(groups - 1).cast("bigint")))
    asked = _blocks(queries.withColumn("block", _block(query_blocks)), "queries", "block")
    there = (
        candidates.withColumn("block", _block(candidate_blocks))
        .withColumn("group", F.floor(F.col("block") / at_once))
        .repartition("group")
    )
    # (query block, candidate block) pairs, dealt out evenly. Merged: Spark takes the query blocks for
    # small, as it does not see that each is copied to every group, and would broadcast the copies
    met = (
        asked.select("queries", every.alias("group"))
        .hint("merge")
        .join(_blocks(there, "candidates", "group", "block"), "group")
        .select("queries", "candidates")
    )
    best = arrow_rows(met, _best_rows(k), _RESULT)
    # scores beyond 64 bits, by their bytes, above or below all others
    order = Window.partitionBy("query_id").orderBy(
        F.col("beyond").desc(), F.col("size").desc(), F.col("score").desc(), "vec_id"
    )
    return (
        best.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
