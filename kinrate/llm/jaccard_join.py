"""Exact self-join of documents on the Jaccard similarity of their word shingles.

The result needs, for each document, its class of documents that links connect. Steps:

* Equal sets are one set from the start; copies are never compared.
* Index lists. A global order of shingles puts frequent ones last. Two sets with the
  wanted similarity share one of their first n - ceil(t n) + 1 shingles, so only those
  are indexed, each with its position.
* Answers of a leader. In every list, the set with the least id is the leader, and each
  other member is compared with it: linear in the list, however long.
* Derived answers. If all members of a list are connected by now, none of its pairs can
  change the result and the list is skipped as a whole. In the others, members of blocks
  of like size meet. A pair is skipped if its positions leave too few common shingles, if
  parities of hashed shingles (a lower bound of the symmetric difference) differ too
  often, or if the distances of both members to their leader exclude it (Jaccard distance
  is a metric). What is left is compared, with no cap.
* Links. Linked sets are in one class, so ``jaccard_links`` counts the links of every row within the
  classes, by how sets depart from the centre of theirs; see ``link_counts``.

Frequent shingles are found by counting within tasks over all documents. They change
only the order, hence the work, never the links. Comparisons count common shingles of
the two whole texts.

A null text, or one without words, has an empty set, links with nothing and is its own
class. Rows with a null doc_id keep their set size and get a null class. Rows that share a doc_id are compared
like any others. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from kinrate.llm.components import connected
from kinrate.llm.link_counts import links_in_classes
from kinrate.llm.shipping import arrow_rows
from kinrate.llm.words import Spans, hash_words, text_chunks
from kinrate.plans.storage import scratch, stage

# The most frequent shingles that are put last in the order: bounds what tasks are sent.
FREQUENT = 100_000
FREQUENT_FROM = 8
PARITIES = tuple(f"p{i}" for i in range(8))


@dataclass(frozen=True)
class Jaccard:
    """Word shingles of ``width``; linked if 100 * common >= percent * union."""

    width: int = 5
    percent: int = 80

    def __post_init__(self):
        if self.width < 1 or not 1 <= self.percent <= 100:
            raise ValueError("width must be positive and percent from 1 to 100")

    def prefix(self, size: int) -> int:
        return size - (self.percent * size + 99) // 100 + 1


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text, A-Z as a-z."""
    words = hash_words(texts, lower=True)
    counts = words.counts
    sizes = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1))
    row = np.repeat(np.arange(len(counts)), sizes)
    ends = np.cumsum(sizes)
    start = words.first[row] + np.arange(len(row)) - (ends - sizes)[row]
    hashes = Spans(words.hashes).hashes(start, np.minimum(start + width, words.first[row + 1]))
    return [np.unique(part) for part in np.split(hashes, ends[:-1])] if len(counts) else []


def _set_id(shingles: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _parities(shingles: np.ndarray) -> np.ndarray:
    """For each of 512 classes of shingles, whether the set has an odd number of them."""
    odd = np.bincount((shingles >> np.uint64(55)).astype(np.int64), minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _set_rows(width: int):
    """Set size and id of every text, and shingles that several sets of a batch have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            sizes, ids, distinct, parities = [], [], {}, []
            for at, to in text_chunks(texts):
                for shingles in shingle_sets(texts[at:to], width):
                    sizes.append(len(shingles))
                    ids.append(_set_id(shingles) if len(shingles) else None)
                    parities.append(_parities(shingles))
                    if len(shingles):
                        distinct.setdefault(ids[-1], shingles)
            every = np.concatenate([*distinct.values(), np.zeros(0, dtype=np.uint64)])
            shared, times = np.unique(every, return_counts=True)
            shared, times = shared[times > 1], times[times > 1]
            # the batch's counts go with its first row
            lists = [{"shingle": s, "times": t} for s, t in zip(shared.view(np.int64).tolist(), times.tolist())]
            counts = [lists if i == 0 else [] for i in range(len(texts))]
            yield pa.record_batch(
                [
                    batch.column("doc_id"),
                    batch.column("row_key"),
                    pa.array(sizes, pa.int64()),
                    pa.array(ids, pa.int64()),
                    *(pa.array(part) for part in np.array(parities, dtype=np.int64).reshape(-1, len(PARITIES)).T.copy()),
                    pa.array(counts, pa.list_(pa.struct([("shingle", pa.int64()), ("times", pa.int64())]))),
                ],
                names=["doc_id", "row_key", "n_shingles", "set_id", *PARITIES, "shared"],
            )

    return run


def ordered_prefix(shingles: np.ndarray, length: int, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles in the global order: infrequent by hash, then frequent by rank."""
    place = np.searchsorted(frequent, shingles)
    known = np.zeros(len(shingles), dtype=bool)
    inside = place < len(frequent)
    known[inside] = frequent[place[inside]] == shingles[inside]
    rare = shingles[~known][:length]
    if len(rare) == length:
        return rare
    last = shingles[known][np.argsort(rank[place[known]])]
    return np.concatenate([rare, last[: length - len(rare)]])


def _posting_rows(rule: Jaccard, frequent: np.ndarray, rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, seen = batch.column("text"), set()
            for at, to in text_chunks(texts):
                parts, ids, sizes = [], [], []
                for shingles in shingle_sets(texts[at:to], rule.width):
                    if len(shingles) and (name := _set_id(shingles)) not in seen:
                        seen.add(name)
                        size = len(shingles)
                        parts.append(ordered_prefix(shingles, rule.prefix(size), frequent, rank))
                        ids.append(name)
                        sizes.append(size)
                if not parts:
                    continue
                lengths = [len(p) for p in parts]
                yield pa.record_batch(
                    [
                        pa.array(np.concatenate(parts).view(np.int64)),
                        pa.array(np.repeat(np.array(ids, dtype=np.int64), lengths)),
                        pa.array(np.repeat(np.array(sizes, dtype=np.int32), lengths)),
                        pa.array(np.concatenate([np.arange(n, dtype=np.int32) for n in lengths])),
                    ],
                    names=["shingle", "set_id", "size", "position"],
                )

    return run


def _common_rows(width: int):
    """The number of common shingles of each pair of texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[int, np.ndarray] = {}
            for side in ("a", "b"):
                ids = batch.column(side).to_numpy()
                new = [i for i, name in enumerate(ids.tolist()) if name not in sets and not sets.update({name: None})]
                texts = batch.column(f"{side}_text").take(pa.array(new, pa.int64()))
                for at, to in text_chunks(texts):
                    for i, shingles in zip(new[at:to], shingle_sets(texts[at:to], width)):
                        sets[int(ids[i])] = shingles
            a, b = (batch.column(side).to_numpy().tolist() for side in ("a", "b"))
            common = [len(np.intersect1d(sets[x], sets[y], assume_unique=True)) for x, y in zip(a, b)]
            yield pa.record_batch(
                [batch.column("a"), batch.column("b"), batch.column("a_size"), batch.column("b_size"), pa.array(common, pa.int64())],
                names=["a", "b", "a_size", "b_size", "common"],
            )

    return run


def _shingle_rows(width: int):
    """The set id of each text, as found, and its shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            for at, to in text_chunks(texts):
                sets = shingle_sets(texts[at:to], width)
                lengths = np.cumsum([0, *map(len, sets)], dtype=np.int32)
                values = pa.array(np.concatenate(sets).view(np.int64))
                yield pa.record_batch(
                    [
                        *(batch.column(c).slice(at, to - at) for c in ("root", "set_id", "rows")),
                        pa.array([_set_id(shingles) for shingles in sets], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(lengths), values),
                    ],
                    names=["root", "set_id", "rows", "found", "shingles"],
                )

    return run


def frequent_shingles(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """At most FREQUENT shingles that most sets share, sorted, and their ranks by count."""
    rows = (
        sets.select(F.explode("shared").alias("s"))
        .groupBy("s.shingle")
        .agg(F.sum("s.times").alias("times"))
        .where(F.col("times") >= FREQUENT_FROM)
        .orderBy(F.col("times").desc(), "shingle")
        .limit(FREQUENT)
        .toArrow()
    )
    shingles, times = (rows.column(c).to_numpy() for c in ("shingle", "times"))
    rank = np.empty(len(shingles), dtype=np.int64)
    rank[np.lexsort((shingles, times))] = np.arange(len(shingles))
    shingles = shingles.astype(np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], rank[order]


def compare(pairs: DataFrame, reps: DataFrame, docs: DataFrame, rule: Jaccard) -> DataFrame:
    """Common shingles of pairs (a, b) of sets that sizes do not rule out."""

    def side(name: str) -> DataFrame:
        return reps.select(
            F.col("set_id").alias(name),
            F.col("doc_id").alias(f"{name}_id"),
            F.col("row_key").alias(f"{name}_key"),
            F.col("n_shingles").alias(f"{name}_size"),
        )

    def texts(name: str) -> DataFrame:
        return docs.select(
            F.col("doc_id").alias(f"{name}_id"),
            F.col("row_key").alias(f"{name}_key"),
            F.col("text").alias(f"{name}_text"),
        )

    sized = stage(
        pairs.join(side("a"), "a")
        .join(side("b"), "b")
        .where(
            100 * F.least("a_size", "b_size") >= rule.percent * F.greatest("a_size", "b_size")
        ),
        "pairs",
    )
    whole = sized.join(texts("a"), ["a_id", "a_key"]).join(texts("b"), ["b_id", "b_key"])
    schema = "a bigint, b bigint, a_size bigint, b_size bigint, common bigint"
    needed = whole.select("a", "b", "a_size", "b_size", "a_text", "b_text")
    return stage(arrow_rows(needed, _common_rows(rule.width), schema), "compared")


def _linked(compared: DataFrame, rule: Jaccard) -> DataFrame:
    union = F.col("a_size") + F.col("b_size") - F.col("common")
    return compared.where(100 * F.col("common") >= rule.percent * union).select("a", "b")


def _open_pairs(
    lists: DataFrame, compared: DataFrame, roots: DataFrame, reps: DataFrame, rule: Jaccard
) -> DataFrame:
    """Pairs that lists with unconnected members still have to compare."""
    # What stands before a shingle: at the first one that two sets share, all of it differs.
    along = Window.partitionBy("set_id").orderBy("position")
    lists = lists.repartition("set_id").dropDuplicates(["set_id", "shingle"])
    lists = lists.withColumn("earlier", F.array(*[F.lag("shingle", i).over(along) for i in (1, 2, 3)]))
    placed = lists.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id")
    )
    split = (
        placed.groupBy("shingle")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .where("low < high")
        .select("shingle")
    )
    union = F.col("a_size") + F.col("b_size") - F.col("common")
    far = compared.select(
        F.col("a").alias("set_id"), F.col("b").alias("leader"), (1 - F.col("common") / union).alias("far")
    )
    fields = ["set_id", "size", "position", "root", "far", "block", "earlier", *PARITIES]
    # Sizes of linked sets lie in the same block or in neighbouring ones.
    ratio = math.log(100 / rule.percent) * (1 + 1e-9) if rule.percent < 100 else 1e-9
    members = stage(
        placed.join(split, "shingle")
        .where("set_id != leader")  # the leader has met all
        .join(far, ["set_id", "leader"], "left")
        .join(reps.select("set_id", *PARITIES), "set_id")
        .withColumn("block", F.floor(F.log(F.col("size").cast("double")) / ratio))
        .select("shingle", *fields)
        .distinct(),
        "members",
    )
    a = members.select("shingle", F.col("block").alias("met"), *[F.col(c).alias(f"a_{c}") for c in fields])
    b = members.select(
        "shingle",
        F.explode(F.array("block", F.col("block") - 1)).alias("met"),
        *[F.col(c).alias(f"b_{c}") for c in fields],
    )
    both = F.col("a_size") + F.col("b_size")
    rest = F.least(F.col("a_size") - F.col("a_position"), F.col("b_size") - F.col("b_position"))
    different = sum(F.bit_count(F.col(f"a_{p}").bitwiseXOR(F.col(f"b_{p}"))) for p in PARITIES)
    return (
        a.join(b, ["shingle", "met"])
        .where("a_root != b_root")
        .where("a_block < b_block OR a_set_id < b_set_id")
        .where(100 * F.least("a_size", "b_size") >= rule.percent * F.greatest("a_size", "b_size"))
        .where(~F.coalesce(F.arrays_overlap("a_earlier", "b_earlier"), F.lit(False)))
        # common >= percent / (100 + percent) * both, and different <= both - 2 * common
        .where(
            (100 + rule.percent) * (F.col("a_position") + F.col("b_position"))
            <= (100 - rule.percent) * both
        )
        .where((100 + rule.percent) * rest >= rule.percent * both)
        .where((100 + rule.percent) * different <= (100 - rule.percent) * both)
        .where(
            F.coalesce(
                F.abs(F.col("a_far") - F.col("b_far")) <= 1 - rule.percent / 100 + 1e-9, F.lit(True)
            )
        )
        .select(F.col("a_set_id").alias("a"), F.col("b_set_id").alias("b"))
        .distinct()
    )


def _link_counts(roots: DataFrame, sets: DataFrame, reps: DataFrame, docs: DataFrame, rule: Jaccard) -> DataFrame:
    """For each set, the rows that its rows are linked with: copies, and rows of linked sets."""
    copies = sets.where("set_id IS NOT NULL AND doc_id IS NOT NULL").groupBy("set_id").agg(F.count("*").alias("rows"))
    copies = stage(copies, "copies")
    placed = stage(roots.withColumnRenamed("node", "set_id").join(copies, "set_id"), "placed")
    sizes = stage(placed.groupBy("root").agg(F.count("*").alias("n_sets"), F.sum("rows").alias("all_rows")), "sizes")
    placed = placed.join(sizes, "root")
    # two sets of a class are linked with each other
    two = placed.where("n_sets = 2").select("set_id", (F.col("all_rows") - F.col("rows")).alias("others"))
    more = placed.where("n_sets > 2").join(reps.select("set_id", "doc_id", "row_key"), "set_id")
    texts = docs.join(more, ["doc_id", "row_key"]).select("root", "set_id", "rows", "text")
    schema = "root bigint, set_id bigint, rows bigint, found bigint, shingles array<bigint>"
    members = stage(
        arrow_rows(texts, _shingle_rows(rule.width), schema)
        .where("found = set_id")
        # rows that share doc_id and text
        .groupBy("set_id")
        .agg(*[F.first(c).alias(c) for c in ("root", "rows", "shingles")]),
        "shingles",
    )
    others = two.unionByName(links_in_classes(members, rule.percent))
    return copies.join(others, "set_id", "left").select(
        "set_id", (F.col("rows") - 1 + F.coalesce("others", F.lit(0))).cast("bigint").alias("n_links")
    )


def jaccard_links(docs: DataFrame, rule: Jaccard = Jaccard()) -> DataFrame:
    """As ``jaccard_classes``, with n_links: the number of other rows that each row is linked with.

    Rows with an equal set are linked.
    """
    return jaccard_classes(docs, rule, with_links=True)


def jaccard_classes(docs: DataFrame, rule: Jaccard = Jaccard(), with_links: bool = False) -> DataFrame:
    """doc_id, row_key, n_shingles and component_id (the least linked doc_id) of every row.

    row_key is the hash of the text; ``stays`` marks one text of each class, its first.
    The result is stored, and no other stage is left when this returns.
    """
    with scratch() as step:
        return step.keep(_classes(docs, rule, with_links), "classes")


def _classes(docs: DataFrame, rule: Jaccard, with_links: bool) -> DataFrame:
    docs = docs.select(F.col("doc_id").cast("bigint"), F.hash("text").alias("row_key"), "text")
    schema = (
        "doc_id bigint, row_key int, n_shingles bigint, set_id bigint, "
        + "".join(f"{p} bigint, " for p in PARITIES)
        + "shared array<struct<shingle: bigint, times: bigint>>"
    )
    rows = stage(arrow_rows(docs, _set_rows(rule.width), schema), "sets")
    sets = rows.select("doc_id", "row_key", "n_shingles", "set_id", *PARITIES)
    real = sets.where("set_id IS NOT NULL AND doc_id IS NOT NULL")
    reps = stage(
        real.groupBy("set_id")
        .agg(
            F.min(F.struct("doc_id", "row_key")).alias("rep"),
            *[F.first(c).alias(c) for c in ("n_shingles", *PARITIES)],
        )
        .select("set_id", "rep.doc_id", "rep.row_key", "n_shingles", *PARITIES),
        "reps",
    )
    source = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    postings = stage(
        arrow_rows(
            source,
            _posting_rows(rule, *frequent_shingles(rows)),
            "shingle bigint, set_id bigint, size int, position int",
        ),
        "postings",
    )
    leaders = stage(
        postings.groupBy("shingle")
        .agg(F.min("set_id").alias("leader"), F.max("set_id").alias("high"))
        .where("leader < high")
        .select("shingle", "leader"),
        "leaders",
    )
    lists = stage(postings.join(leaders, "shingle"), "lists")
    stars = lists.where("set_id != leader").select(F.col("set_id").alias("a"), F.col("leader").alias("b")).distinct()
    compared = compare(stars, reps, docs, rule)
    links = _linked(compared, rule)
    roots = stage(connected(links), "roots")
    more = _open_pairs(lists, compared, roots, reps, rule)
    links = links.unionByName(_linked(compare(more, reps, docs, rule), rule))
    roots = stage(connected(links), "roots")
    classes = roots.withColumnRenamed("node", "set_id").join(
        reps.select("set_id", F.struct("doc_id", "row_key").alias("rep")), "set_id"
    )
    least = classes.groupBy("root").agg(F.min("rep").alias("least"))
    named = reps.join(classes.join(least, "root").select("set_id", "least"), "set_id", "left").select(
        "set_id", F.coalesce("least", F.struct("doc_id", "row_key")).alias("least")
    )
    named = stage(named, "named")
    alone = F.col("set_id").isNull() | F.col("doc_id").isNull()
    first = (F.col("doc_id") == F.col("least.doc_id")) & (F.col("row_key") == F.col("least.row_key"))
    columns = []
    if with_links:
        sets = sets.join(_link_counts(roots, sets, reps, docs, rule), "set_id", "left")
        counted = F.when(alone, F.lit(0)).otherwise(F.col("n_links"))
        columns = [counted.cast("bigint").alias("n_links")]
    return sets.join(named, "set_id", "left").select(
        "doc_id",
        "row_key",
        "n_shingles",
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"),
        F.when(alone, F.lit(True)).otherwise(first).alias("stays"),
        *columns,
    )
