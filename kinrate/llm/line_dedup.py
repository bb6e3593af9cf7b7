"""Removal of lines that a document with a smaller doc_id already has.

A line's key is the line without white space at its ends, A-Z in lower case; only keys of some
length count. Each text gives one narrow row a line: 128 bits of digest, document,
line number. These rows are range-partitioned by digest, document and line, and sorted so
in each task, which streams them: the first document of a digest keeps its lines, those
of all later ones are dropped. Because the document is part of the range, a line that a
third of all rows have is spread over many tasks. A task cannot know whether the digest
it begins with began before, so it passes those rows on undecided, and the first document of
the digest it ends with; there is at most one such digest on either side of a task, and the
undecided rows are settled by a look-up of these. Dropped line numbers come back as one
compressed bitmap per document, never as text.

Rows are keyed by (doc_id, hash of the text). A null or empty text is one empty line.
A document with a null doc_id neither drops nor loses lines. Rows that share a doc_id are
one document here: they keep each other's lines. Other columns are kept in ``other``. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinrate.llm.shipping import arrow_rows
from kinrate.plans.storage import stage

LEAST_CHARS = 10
CHUNK_LINES = 50_000

# What is stripped from both ends of a line.
BLANKS = b" \t\n\x0b\x0c\r"

KEY = ["doc_id", "row_key"]
LINE = ["high", "low", "doc_id", "row_key", "line"]
_LINES = "high bigint, low bigint, doc_id bigint, row_key bigint, line int"

# What a streamed row says: a dropped line, a line whose digest may have begun in an earlier
# task, or the first document of the digest that a task ends with.
DROPPED, OPEN, LAST = 0, 1, 2


def _chars(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode())


def line_parts(text: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The lines of a text, some at a time."""
    at = 0
    while True:
        end = text.find(b"\n", at + size)
        if end < 0:
            yield text[at:].split(b"\n")
            return
        yield text[at:end].split(b"\n")
        at = end + 1


def _line_rows(least_chars: int):
    """Digest and place of each line whose key is long enough."""

    def batch_of(digests: list[bytes], ids: list[int], keys: list[int], lines: list[int]) -> pa.RecordBatch:
        halves = np.frombuffer(b"".join(digests), dtype=">i8").astype(np.int64).reshape(-1, 2)
        columns = [halves[:, 0], halves[:, 1], ids, keys]
        return pa.record_batch(
            [*(pa.array(c, pa.int64()) for c in columns), pa.array(lines, pa.int32())], names=LINE
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: tuple[list, list, list, list] = ([], [], [], [])
            seen = set()  # rows repeated in a batch say nothing new
            texts = batch.column("text").cast(pa.large_binary())
            for doc, row_key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                if (doc, row_key) in seen:
                    continue
                seen.add((doc, row_key))
                number = 0
                for part in line_parts(text.as_py()):
                    for line in part:
                        key = line.strip(BLANKS).lower()
                        if len(key) >= least_chars and _chars(key) >= least_chars:
                            for column, value in zip(
                                rows, (hashlib.blake2b(key, digest_size=16).digest(), doc, row_key, number)
                            ):
                                column.append(value)
                        number += 1
                    if len(rows[0]) >= CHUNK_LINES:
                        yield batch_of(*rows)
                        rows = ([], [], [], [])
            if rows[0]:
                yield batch_of(*rows)

    return run


def _stream_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of LINE to (kind, high, low, doc_id, row_key, line).

    Between batches only the last row and the first document of its digest are kept.
    """

    def out(kind: np.ndarray, columns: list[np.ndarray], chosen: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(kind.astype(np.int8)), *(pa.array(c[chosen]) for c in columns)], names=["kind", *LINE]
        )

    last: list[int] | None = None  # the row before
    begun = False  # whether its digest began after this task's first row's
    first_doc = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(n).to_numpy(zero_copy_only=False) for n in LINE]
        high, low, doc, _, _ = columns
        before = [np.r_[c[:1] if last is None else np.array([last[i]], c.dtype), c[:-1]] for i, c in enumerate(columns)]
        new = (high != before[0]) | (low != before[1])
        again = ~new
        for c, b in zip(columns[2:], before[2:]):
            again &= c == b
        if last is None:
            again[0], first_doc = False, int(doc[0])  # the first row of the task opens its digest
        run = np.cumsum(new)
        firsts = np.r_[first_doc, doc[new]][run]
        undecided = (run == 0) & (not begun)
        chosen = np.flatnonzero(~again & (undecided | (doc > firsts)))
        if len(chosen):
            yield out(np.where(undecided[chosen], OPEN, DROPPED), columns, chosen)
        last = [c[-1].item() for c in columns]
        first_doc, begun = int(firsts[-1]), begun or bool(new.any())
    if last is not None:
        tail = [np.array([v], dtype) for v, dtype in zip([*last[:2], first_doc, *last[3:]], ["i8"] * 4 + ["i4"])]
        yield out(np.array([LAST]), tail, np.array([0]))


def _bitmap_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Dropped line numbers to a compressed bitmap with a one for each line kept."""
    for batch in batches:
        keep, dropped = [], []
        for numbers in batch.column("lines"):
            gone = numbers.values.to_numpy()
            bits = np.ones((int(gone.max()) // 8 + 1) * 8, dtype=np.uint8)
            bits[gone] = 0
            dropped.append(len(gone))
            keep.append(zlib.compress(np.packbits(bits, bitorder="little").tobytes()))
        yield pa.record_batch(
            [batch.column("doc_id"), batch.column("row_key"), pa.array(dropped, pa.int64()), pa.array(keep, pa.binary())],
            names=[*KEY, "n_dropped", "keep"],
        )


def _keyed(docs: DataFrame) -> DataFrame:
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select(
        F.col("doc_id").cast("bigint"),
        F.xxhash64("text").alias("row_key"),
        "text",
        F.struct(F.lit(0).alias("_"), *others).alias("other"),
    )


def dropped_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, row_key and line (from 0) of each line that a smaller doc_id has as well."""
    source = _keyed(docs).where("doc_id IS NOT NULL AND text IS NOT NULL").select(*KEY, "text")
    lines = arrow_rows(source, _line_rows(least_chars), _LINES)
    ordered = lines.repartitionByRange(*LINE).sortWithinPartitions(*LINE)
    found = stage(arrow_rows(ordered, _stream_rows, f"kind tinyint, {_LINES}"), "found")
    # one digest for each end of a task, however many rows are undecided
    firsts = found.where(F.col("kind") != DROPPED).groupBy("high", "low").agg(F.min("doc_id").alias("first"))
    settled = found.where(F.col("kind") == OPEN).join(F.broadcast(firsts), ["high", "low"]).where("doc_id > first")
    return found.where(F.col("kind") == DROPPED).select(*KEY, "line").unionByName(settled.select(*KEY, "line"))


def keep_bitmaps(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, row_key, n_dropped and keep of each document that loses lines.

    keep: bits from the least significant on, zlib; lines past its end are kept.
    """
    lines = dropped_lines(docs, least_chars).groupBy(*KEY).agg(F.collect_list("line").alias("lines"))
    return arrow_rows(lines, _bitmap_rows, "doc_id bigint, row_key bigint, n_dropped bigint, keep binary")


def _kept_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        total, gone, sums, kept = [], [], [], []
        for text, keep in zip(batch.column("text").to_pylist(), batch.column("keep").to_pylist()):
            whole = text.encode() if text else b""
            left = whole
            lines = whole.count(b"\n") + 1
            dropped = 0
            if keep is not None:
                bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), dtype=np.uint8), bitorder="little")
                stays = np.ones(lines, dtype=bool)
                stays[: len(bits)] = bits[:lines]
                dropped = lines - int(stays.sum())
                left = b"\n".join([line for line, stay in zip(whole.split(b"\n"), stays.tolist()) if stay])
            total.append(lines)
            gone.append(dropped)
            sums.append(hashlib.sha256(left).hexdigest())
            kept.append(None if text is None else left.decode())
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("other"),
                pa.array(total, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(sums, pa.string()),
                pa.array(kept, pa.string()),
            ],
            names=["doc_id", "other", "n_lines", "n_dropped", "kept_sha256", "kept_text"],
        )


def remove_lines(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """doc_id, other, n_lines, n_dropped, kept_sha256 and kept_text of every document.

    n_lines is the number before dropping. A null text stays null; its digest is that of an
    empty text. ``other`` holds all further columns of the input.
    """
    marked = _keyed(docs).join(keep_bitmaps(docs, least_chars), KEY, "left")
    rows = marked.select("doc_id", "other", "text", "keep")
    other = rows.schema["other"].dataType.simpleString()
    return arrow_rows(
        rows,
        _kept_rows,
        f"doc_id bigint, other {other}, n_lines bigint, n_dropped bigint, kept_sha256 string, kept_text string",
    )
