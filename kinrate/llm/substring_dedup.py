"""Removal of long word spans that an earlier document already has.

The k-mers of words (50 by default) are the edges of a De Bruijn graph. Consecutive
k-mers with the same least inner word group (the anchor) form a piece, so that a row
stands for some twenty k-mers; equal k-mers always lie at the same place of pieces
with the same anchor. Pieces whose anchor is in one document only cannot repeat.
Of the rest, pieces that always follow each other are nonbranching paths: joins find
these links, and each path is compacted to one row along the coordinates of its first
occurrence. Pieces of an anchor with several contents are branching; their k-mers are
compared one by one, once per distinct content. What comes out are spans with the
coordinates of the same words in an earlier document, which are verified by a digest
of the words at both coordinates.

Rows are keyed by (doc_id, hash of the text). A null text has no words. A document
with a null doc_id neither removes nor loses words. Repeated rows, and rows that share
a doc_id, do not remove words from each other. Texts of fewer than k words stay whole.
Other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from kinrate.llm.shipping import arrow_rows
from kinrate.llm.words import Spans, hash_words, mix, text_chunks
from kinrate.plans.storage import scratch, stage

WINDOW_WORDS = 50
ANCHOR_WORDS = 8
PLACE_BITS = 28
KEY = ["doc_id", "row_key"]

_PIECES = "doc_id bigint, row_key int, first bigint, kmers int, anchor bigint, content bigint"


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint"), F.hash("text").alias("row_key"), "text")


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of so many numbers."""
    done = 1
    while done * 2 <= width:
        keys = np.minimum(keys[:-done], keys[done:])
        done *= 2
    rest = width - done
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def find_pieces(texts: pa.Array, k: int, anchor_words: int) -> tuple[np.ndarray, ...]:
    """Row of the text, first k-mer, number of k-mers, anchor and content of each piece."""
    words = hash_words(texts)
    total = len(words.hashes)
    if total < k:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    spans = Spans(words.hashes)
    at = np.arange(total - anchor_words + 1)
    groups = spans.hashes(at, at + anchor_words)
    place = np.uint64((1 << PLACE_BITS) - 1)
    least = _least((mix(groups) & ~place) | at.astype(np.uint64), k - anchor_words + 1)
    left = np.repeat(words.first[1:], words.counts) - np.arange(total)
    kmer = np.flatnonzero(left[: len(least)] >= k)
    if not len(kmer):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(5))
    anchor = (least[kmer] & place).astype(np.int64)
    begins = np.flatnonzero(np.r_[True, (np.diff(kmer) != 1) | (np.diff(anchor) != 0)])
    kmers = np.diff(np.r_[begins, len(kmer)])
    first = kmer[begins]
    row = np.searchsorted(words.first, first, "right") - 1
    content = spans.hashes(first, first + kmers + k - 1)
    return row, first - words.first[row], kmers, groups[anchor[begins]], content


def _piece_rows(k: int, anchor_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, texts = (batch.column(n) for n in ("doc_id", "row_key", "text"))
            for at, to in text_chunks(texts):
                row, first, kmers, anchor, content = find_pieces(texts[at:to], k, anchor_words)
                row = pa.array(row + at)
                yield pa.record_batch(
                    [
                        ids.take(row),
                        keys.take(row),
                        pa.array(first.astype(np.int64)),
                        pa.array(kmers.astype(np.int32)),
                        pa.array(_signed(anchor)),
                        pa.array(_signed(content)),
                    ],
                    names=["doc_id", "row_key", "first", "kmers", "anchor", "content"],
                )

    return run


def _kmer_rows(k: int):
    """The k-mers of the wanted pieces, by content and place in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, wanted = batch.column("text"), batch.column("wanted")
            ids, keys = batch.column("doc_id"), batch.column("row_key")
            for at, to in text_chunks(texts):
                words = hash_words(texts[at:to])
                spans = Spans(words.hashes)
                part = wanted[at:to]
                flat = part.flatten()
                sizes = np.diff(part.offsets.to_numpy())
                row = np.repeat(np.arange(to - at), sizes)
                first = flat.field("first").to_numpy()
                kmers = flat.field("kmers").to_numpy().astype(np.int64)
                which = np.repeat(np.arange(len(row)), kmers)
                place = np.arange(len(which)) - np.repeat(np.cumsum(kmers) - kmers, kmers)
                start = words.first[row][which] + first[which] + place
                doc = pa.array(row[which] + at)
                yield pa.record_batch(
                    [
                        pa.array(flat.field("content").to_numpy()[which]),
                        pa.array(place.astype(np.int32)),
                        pa.array(_signed(spans.hashes(start, start + k))),
                        ids.take(doc),
                        keys.take(doc),
                        pa.array(first[which] + place),
                    ],
                    names=["content", "place", "kmer", "doc_id", "row_key", "first"],
                )

    return run


def _split(text: str | None) -> list[bytes]:
    return text.encode().split() if text else []


def digest_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each wanted span of a text."""
    for batch in batches:
        rows = {n: [] for n in ("from_id", "from_key", "from_first", "words", "digest")}
        columns = (batch.column(n).to_pylist() for n in ("doc_id", "row_key", "text", "wanted"))
        for doc, key, text, wanted in zip(*columns):
            words = _split(text)
            for span in wanted:
                first, length = span["from_first"], span["words"]
                values = (doc, key, first, length, digest_of(words[first : first + length]))
                for name, value in zip(rows, values):
                    rows[name].append(value)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
        yield pa.record_batch(
            [pa.array(v, kind) for v, kind in zip(rows.values(), kinds)], names=list(rows)
        )


def _result_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole and kept words of each text after the spans with the right digest."""
    for batch in batches:
        total, gone, kept, digests = [], [], [], []
        for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
            words = _split(text)
            stays = bytearray(b"\x01") * len(words)
            for span in spans or ():
                first, end = span["first"], span["first"] + span["words"]
                if digest_of(words[first:end]) == span["digest"]:
                    stays[first:end] = bytes(end - first)
            left = b" ".join([w for w, stay in zip(words, stays) if stay])
            total.append(len(words))
            gone.append(len(words) - sum(stays))
            digests.append(hashlib.sha256(left).hexdigest())
            kept.append(text if text is None or all(stays) else left.decode())
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                batch.column("other"),
                pa.array(total, pa.int64()),
                pa.array(gone, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(kept, pa.string()),
            ],
            names=["doc_id", "other", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )


def repeated_pieces(docs: DataFrame, k: int, anchor_words: int) -> DataFrame:
    """Pieces whose anchor occurs in two documents at least; branching: in several contents."""
    source = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    with scratch() as step:
        pieces = stage(arrow_rows(source, _piece_rows(k, anchor_words), _PIECES), "pieces")
        anchors = (
            pieces.groupBy("anchor")
            .agg(
                F.min("doc_id").alias("low"),
                F.max("doc_id").alias("high"),
                (F.min("content") != F.max("content")).alias("branching"),
            )
            .where("low < high")
            .select("anchor", "branching")
        )
        # stored, so that the join reads both sides from exchanges, whose heavy keys Spark splits
        return step.keep(pieces.join(stage(anchors, "anchors"), "anchor").drop("anchor"), "repeated")


def _first_of(*names: str) -> F.Column:
    return F.min(F.struct(*names))


def compact_paths(repeated: DataFrame) -> DataFrame:
    """Nonbranching paths: their first piece, all k-mers and first occurrence.

    Two pieces are linked if each occurrence of the one is followed by the other and the
    other never stands without it. The first occurrence of linked pieces then lies at
    neighbouring coordinates of one document, along which the links add up to paths.
    """
    pieces = repeated.where("NOT branching")
    contents = stage(
        pieces.groupBy("content").agg(
            _first_of("doc_id", "row_key", "first").alias("at"),
            F.max("doc_id").alias("last_id"),
            F.first("kmers").alias("kmers"),
            F.count(F.lit(1)).alias("times"),
        ),
        "contents",
    )
    after = pieces.select(
        *KEY, (F.col("first") + F.col("kmers")).alias("first"), F.col("content").alias("before")
    )
    met = (
        after.join(pieces.select(*KEY, "first", "content"), [*KEY, "first"])
        .groupBy("before", "content")
        .agg(F.count(F.lit(1)).alias("links"))
    )
    times = contents.select(F.col("content").alias("before"), F.col("times").alias("before_times"))
    linked = (
        met.join(times, "before")
        .where("links = before_times")
        .join(contents.select("content", "times"), "content")
        .where("links = times")
        .select("content")
        .distinct()
        .withColumn("linked", F.lit(1))
    )
    along = Window.partitionBy("at.doc_id", "at.row_key").orderBy("at.first", "content")
    numbered = (
        contents.join(linked, "content", "left")
        .withColumn("path", F.sum(F.lit(1) - F.coalesce("linked", F.lit(0))).over(along))
    )
    return (
        numbered.groupBy(F.col("at.doc_id").alias("from_id"), F.col("at.row_key").alias("from_key"), "path")
        .agg(
            F.min_by("content", "at.first").alias("content"),
            F.min("at.first").alias("from_first"),
            F.sum("kmers").alias("kmers"),
            F.max("last_id").alias("last_id"),
        )
        .where("last_id > from_id")
        .select("content", "from_id", "from_key", "from_first", "kmers")
    )


def branching_runs(repeated: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """For each content of a branching anchor, runs of k-mers with their first occurrence."""
    contents = (
        repeated.where("branching")
        .groupBy("content")
        .agg(_first_of("doc_id", "row_key", "first").alias("at"), F.first("kmers").alias("kmers"))
        .groupBy(F.col("at.doc_id").alias("doc_id"), F.col("at.row_key").alias("row_key"))
        .agg(F.collect_list(F.struct("content", F.col("at.first").alias("first"), "kmers")).alias("wanted"))
    )
    kmers = stage(
        arrow_rows(
            docs.join(contents, KEY),
            _kmer_rows(k),
            "content bigint, place int, kmer bigint, doc_id bigint, row_key int, first bigint",
        ),
        "kmers",
    )
    first = kmers.groupBy("kmer").agg(_first_of("doc_id", "row_key", "first").alias("from"))
    # k-mers in a row of which the first occurrences are in a row, too
    of_run = Window.partitionBy("content", "from_id", "from_key", "shift").orderBy("place")
    return (
        kmers.select("kmer", "content", "place")
        .join(first, "kmer")
        .select(
            "content",
            "place",
            F.col("from.doc_id").alias("from_id"),
            F.col("from.row_key").alias("from_key"),
            F.col("from.first").alias("from_first"),
            (F.col("from.first") - F.col("place")).alias("shift"),
        )
        .withColumn("run", F.col("place") - F.dense_rank().over(of_run))
        .groupBy("content", "from_id", "from_key", "shift", "run")
        .agg(
            F.min("place").alias("place"),
            F.min("from_first").alias("from_first"),
            (F.max("place") - F.min("place") + 1).alias("kmers"),
        )
        .select("content", "place", "from_id", "from_key", "from_first", "kmers")
    )


def repeated_spans(docs: DataFrame, k: int = WINDOW_WORDS, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """Spans (doc_id, row_key, first, words) that begin with the same words as the span
    (from_id, from_key, from_first) of a document with a smaller doc_id. ``docs`` as from ``keyed``."""
    if not 1 <= anchor_words <= k:
        raise ValueError("anchor_words must be between 1 and k")
    repeated = repeated_pieces(docs, k, anchor_words)
    paths = compact_paths(repeated).withColumn("place", F.lit(0))
    runs = branching_runs(repeated, docs, k)
    columns = ["content", "place", "from_id", "from_key", "from_first", "kmers"]
    sources = stage(paths.select(columns).unionByName(runs.select(columns)), "sources")
    return (
        repeated.select(*KEY, "first", "content")
        .join(sources, "content")
        .where("from_id < doc_id")
        .select(
            *KEY,
            (F.col("first") + F.col("place")).alias("first"),
            (F.col("kmers") + (k - 1)).cast("bigint").alias("words"),
            "from_id",
            "from_key",
            "from_first",
        )
    )


def remove_repeats(docs: DataFrame, k: int = WINDOW_WORDS, anchor_words: int = ANCHOR_WORDS) -> DataFrame:
    """doc_id, other, n_words, n_removed, kept_sha256 and kept_text of every document.

    kept_text is the text as it is if nothing was removed, else the kept words joined
    by one space. ``other`` holds all further columns of the input. Of the stages
    only the spans to remove are left when this returns.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    whole = docs.select(
        F.col("doc_id").cast("bigint"),
        F.hash("text").alias("row_key"),
        "text",
        F.struct(F.lit(0).alias("_"), *others).alias("other"),
    )
    docs = whole.drop("other")
    with scratch() as step:
        with scratch() as search:
            spans = search.keep(repeated_spans(docs, k, anchor_words), "spans")
        wanted = (
            spans.select(
                F.col("from_id").alias("doc_id"), F.col("from_key").alias("row_key"), "from_first", "words"
            )
            .distinct()
            .groupBy(KEY)
            .agg(F.collect_list(F.struct("from_first", "words")).alias("wanted"))
        )
        digests = stage(
            arrow_rows(
                docs.join(wanted, KEY),
                _digest_rows,
                "from_id bigint, from_key int, from_first bigint, words bigint, digest binary",
            ).distinct(),  # a repeated row gives its digests again
            "digests",
        )
        claims = step.keep(
            spans.join(digests, ["from_id", "from_key", "from_first", "words"])
            .groupBy(KEY)
            .agg(F.collect_list(F.struct("first", "words", "digest")).alias("spans")),
            "claims",
        )
    joined = whole.join(claims, KEY, "left").select("doc_id", "other", "text", "spans")
    other = joined.select("other").schema["other"].dataType.simpleString()
    return arrow_rows(
        joined,
        _result_rows,
        f"doc_id bigint, other {other}, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string",
    )
