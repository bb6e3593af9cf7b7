"""Best-fit packing of documents into sequences of a fixed number of tokens.

Documents longer than a sequence are cut from the end into full pieces; the first piece
may be shorter. Pieces are then placed by bulk-synchronous best fit. In a round, all
pieces left and all gaps stand in the order of their size; a sweep from the largest piece
down gives each the least gap that holds it; where more pieces want a gap size than there
are gaps, those of the lowest rank get them and the sweep goes on with the next gap size;
all gaps taken are then updated. A round without a match opens sequences for the longest
pieces left. Rounds repeat until no piece is left.

Lengths are whole numbers up to the capacity, and pieces of one length (or gaps of one
size) differ by rank only. So a round needs no more than the counts by length, a table bounded by
the capacity: the rounds run on those counts and note which ranks of a length go where.
The pieces themselves are numbered within their length by the task that cuts them; the
counts of all tasks, added up, make these numbers ranks, by which each piece finds its
sequence. So ids are written once and are not shuffled, as long as the counts (a row for each
task and length) are few enough to be broadcast; past that the pieces are joined with them.

A null or empty text is a document of the end token alone. Repeated rows are packed one
by one. A null doc_id is packed like any other. Other columns of documents are ignored, those
of pieces kept, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from kinrate.llm.encoding import SPACED, encoded_chunks, give_back, pieces_of
from kinrate.llm.shipping import arrow_rows
from kinrate.plans.storage import few_rows, stage

CAPACITY = 1024
KEPT_PIECES = 200_000  # pieces of text that a worker keeps
PIECE = ["doc_id", "piece", "start", "length"]
_CUT = "doc_id bigint, piece int, start bigint, length bigint, ids binary, task int, place bigint"


def cut_pieces(totals: np.ndarray, capacity: int) -> tuple[np.ndarray, ...]:
    """Document, number, start and length of the pieces of documents with so many ids."""
    pieces = -(-totals // capacity)
    row = np.repeat(np.arange(len(totals)), pieces)
    number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = totals - (pieces - 1) * capacity  # the length of a document's first piece
    start = np.where(number > 0, first[row] + (number - 1) * capacity, 0)
    return row, number, start, np.where(number > 0, capacity, first[row])


def _numbered(lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """How many pieces of its length a task has cut before each; adds them to the counts."""
    order = np.argsort(lengths, kind="stable")
    ordered = lengths[order]
    begins = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[begins, len(ordered)])
    place = np.empty(len(lengths), dtype=np.int64)
    place[order] = np.arange(len(ordered)) - np.repeat(begins, sizes) + counts[ordered]
    counts[ordered[begins]] += sizes
    return place


def _piece_rows(path: str, words: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path, words, KEPT_PIECES)
        counts = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            for small, flat, first in encoded_chunks(batch, pieces):
                ended = np.insert(flat, first[1:], end_id).astype("<u4")
                row, number, start, length = cut_pieces(np.diff(first) + 1, capacity)
                # the pieces of a chunk lie one after the other in its ids
                bounds = (np.r_[0, np.cumsum(length)] * 4).astype(np.int32)
                buffers = [None, pa.py_buffer(bounds), pa.py_buffer(ended)]
                yield pa.record_batch(
                    [
                        small.column("doc_id").take(pa.array(row)),
                        pa.array(number.astype(np.int32)),
                        pa.array(start),
                        pa.array(length),
                        pa.Array.from_buffers(pa.binary(), len(length), buffers),
                        small.column("task").take(pa.array(row)),
                        pa.array(_numbered(length, counts)),
                    ],
                    names=[*PIECE, "ids", "task", "place"],
                )
        give_back()  # other stages follow in this worker

    return run


def cut_documents(
    docs: DataFrame, path: str, words: str = SPACED, end_id: int = 2, capacity: int = CAPACITY
) -> DataFrame:
    """The pieces of each document with their ids (little-endian, 32 bits), the task that cut
    them, and each one's place among that task's pieces of the length.

    To be stored: another run may deal the documents to other tasks.
    """
    source = docs.select(F.col("doc_id").cast("bigint"), "text", F.spark_partition_id().alias("task"))
    return arrow_rows(source, _piece_rows(path, words, end_id, capacity), _CUT)


@dataclass
class Place:
    """Where pieces of one length and a run of ranks go: ``each`` of them to a sequence."""

    length: int
    rank: int
    count: int
    each: int
    sequence: int
    offset: int


class Gaps:
    """Runs of sequences by the size of their gap."""

    def __init__(self, capacity: int):
        self.runs: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        self.counts = np.zeros(capacity + 1, dtype=np.int64)

    def add(self, size: int, sequence: int, count: int) -> None:
        self.runs[size].append((sequence, count))
        self.counts[size] += count

    def take(self, size: int, count: int) -> list[tuple[int, int]]:
        """Runs of so many sequences with this gap, lowest rank first."""
        taken = []
        while count:
            sequence, there = self.runs[size].pop()
            used = min(count, there)
            if used < there:
                self.runs[size].append((sequence + used, there - used))
            taken.append((sequence, used))
            self.counts[size] -= used
            count -= used
        return taken


def plan_rounds(counts: dict[int, int], capacity: int) -> list[Place]:
    """The rounds of best fit over the number of pieces of each length."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for length, count in counts.items():
        left[length] = count
    ranked = np.zeros(capacity + 1, dtype=np.int64)
    gaps, places, sequences = Gaps(capacity), [], 0

    def put(length: int, size: int, runs: list[tuple[int, int]], number: int, each: int):
        """``number`` pieces into these gaps, ``each`` to a gap, the last gap perhaps fewer."""
        for sequence, count in runs:
            full = min(count, number // each)
            for some, per in ((full, each), (1 if full < count and number % each else 0, number % each)):
                if some:
                    places.append(
                        Place(length, int(ranked[length]), some * per, per, sequence, capacity - size)
                    )
                    ranked[length] += some * per
                    left[length] -= some * per
                    number -= some * per
                    updated.append((size - per * length, sequence, some))
                    sequence += some

    while left.any():
        updated: list[tuple[int, int, int]] = []
        for length in np.flatnonzero(left)[::-1].tolist():
            while left[length]:
                fitting = np.flatnonzero(gaps.counts[length:])
                if not len(fitting):
                    break
                size = length + int(fitting[0])
                there = int(gaps.counts[size])
                # many short pieces for few gaps: several go to one gap in the same round
                each = max(1, min(size // length, -(-int(left[length]) // there)))
                number = min(int(left[length]), there * each)
                put(length, size, gaps.take(size, -(-number // each)), number, each)
        if not updated:
            length = int(np.flatnonzero(left)[-1])
            each = capacity // length if 2 * length <= capacity else 1
            number = int(left[length])
            opened = -(-number // each)
            put(length, capacity, [(sequences, opened)], number, each)
            sequences += opened
        for size, sequence, count in updated:
            if size:
                gaps.add(size, sequence, count)
    return places


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    Of the columns, ``length``, ``task`` and ``place`` are looked at; all but the last two are kept.
    ``pieces`` is read more than once and should be a stored table.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("there"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = stage(
        counts.withColumn("before", F.coalesce(F.sum("there").over(earlier), F.lit(0))), "ranks"
    )
    totals = {r.length: r.there for r in before.groupBy("length").agg(F.sum("there").alias("there")).collect()}
    places = [
        (p.length, p.rank, p.count, p.each, p.sequence, p.offset) for p in plan_rounds(totals, capacity)
    ]
    plan = spark.createDataFrame(
        places, "length bigint, from_rank bigint, number bigint, each bigint, first bigint, gap_at bigint"
    )
    kept = [c for c in pieces.columns if c not in ("task", "place")]
    rows = pieces.select("length", "task", "place", F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
    ranks = before.select("length", "task", "before")
    ranked = rows.join(F.broadcast(ranks) if few_rows(before) else ranks, ["length", "task"])
    slot = F.col("place") + F.col("before") - F.col("from_rank")
    return (
        ranked.join(F.broadcast(plan), "length")  # bounded by the capacity, not by the data
        .where((slot >= 0) & (slot < F.col("number")))
        .select(
            "row.*",
            (F.col("first") + F.floor(slot / F.col("each"))).alias("sequence_id"),
            (F.col("gap_at") + slot % F.col("each") * F.col("length")).alias("offset"),
        )
    )


def pack_documents(
    docs: DataFrame, path: str, words: str = SPACED, end_id: int = 2, capacity: int = CAPACITY
) -> DataFrame:
    """Each piece of each document with its sequence, its offset there, and its token ids
    with their checksum."""
    pieces = stage(cut_documents(docs, path, words, end_id, capacity), "pieces")
    packed = pack(pieces, capacity).withColumn("ids_crc32", F.crc32("ids"))
    return packed.select(*PIECE, "ids_crc32", "sequence_id", "offset", "ids")


def sequence_rows(packed: DataFrame) -> DataFrame:
    """sequence_id, n_tokens and ids of each sequence: its pieces in order of their offsets.

    A sequence has at most ``capacity`` tokens, so a group is small.
    """
    parts = F.transform(F.sort_array(F.collect_list(F.struct("offset", "length", "ids"))), lambda p: p["ids"])
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(parts, F.lit(b"").cast("binary"), lambda whole, part: F.concat(whole, part)).alias("ids"),
    )
