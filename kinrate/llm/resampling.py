"""Importance resampling of documents towards the word statistics of target texts.

Features are runs of 1 to ``width`` consecutive words, hashed to buckets by CRC-32. The
texts of a batch are joined with separators between them and lower-cased as one buffer; one
pass of a regular expression finds all words, a binary search of their places among the
texts' offsets tells the text of each, and that masks the runs that would cross texts. The
checksum of a run follows from those of its words, because CRC-32 is linear: appending
n bytes is a table look-up of the checksum so far for n, and an exclusive or. A bincount
adds up buckets, or gains per text. Counts cover all documents and all target texts.

A bucket's gain is the logarithm of its smoothed share among the targets against that among
the documents, in thousandths, and a document's weight the mean gain of its features. A
Gumbel draw, fixed by seed and doc_id, turns the highest sums into a sample without
replacement in proportion to exp(weight / 1000).

A null or empty text has no words, no features and weight 0. A null doc_id is drawn like
any other, with the draw of an empty id, and stands last among ties. Repeated rows are
documents of their own; where all that the order knows is the same, one is as good as the
other. Other columns are ignored. Without documents the result is empty; without targets all
gains speak for rare features only.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from kinrate.llm.shipping import arrow_rows
from kinrate.llm.words import text_chunks
from kinrate.plans.storage import stage

CHUNK_BYTES = 1 << 20
LONGEST_TABLE = 64  # bytes; longer words are appended by zlib itself

# What parts words (by bytes; a byte of any longer character is part of one),
# and the range of a draw.
PART = rb"\x00-\x2F\x3A-\x60\x7B-\x7F"
DRAWS = 1 << 32

WORD, GAP = re.compile(rb"[^" + PART + rb"]+"), re.compile(rb"[" + PART + rb"]")
SEPARATOR = b"\x00"


@dataclass(frozen=True)
class Resampling:
    """Longest run of words, buckets, share drawn, shortest document drawn, and seed."""

    width: int = 2
    buckets: int = 10_000
    percent: int = 25
    min_words: int = 20
    seed: int = 7


@lru_cache(maxsize=LONGEST_TABLE)
def _appended(length: int) -> np.ndarray:
    """What each byte of a checksum becomes when so many bytes follow, [place, byte]."""
    zeros = bytes(length)
    none = zlib.crc32(zeros)
    return np.array(
        [[zlib.crc32(zeros, byte << 8 * place) ^ none for byte in range(256)] for place in range(4)],
        dtype=np.uint32,
    )


class Vocabulary:
    """The distinct words of a buffer, each with a space before it, as checksums."""

    def __init__(self, words: list[bytes]):
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.which = coded.indices.to_numpy()
        self.words = coded.dictionary.to_pylist()
        self.alone = np.array([zlib.crc32(w) for w in self.words], dtype=np.uint32)
        self.spaced = np.array([zlib.crc32(w, zlib.crc32(b" ")) for w in self.words], dtype=np.uint32)
        lengths = np.array([len(w) + 1 for w in self.words], dtype=np.int64)
        known, self.table = np.unique(np.minimum(lengths, LONGEST_TABLE + 1), return_inverse=True)
        self.long = lengths > LONGEST_TABLE
        self.tables = np.stack([_appended(int(n)) for n in known]) if len(known) else None

    def append(self, sums: np.ndarray, which: np.ndarray) -> np.ndarray:
        """Checksums after a space and these words."""
        table = self.table[which]
        after = self.spaced[which]
        for place in range(4):
            byte = (sums >> np.uint32(8 * place)) & np.uint32(255)
            after = after ^ self.tables[table, place, byte]
        for i in np.flatnonzero(self.long[which]).tolist():
            after[i] = zlib.crc32(b" " + self.words[which[i]], int(sums[i]))
        return after


def _features(
    joined: bytes, offsets: np.ndarray, carried: int, how: Resampling
) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Text, bucket of all features of a lower-case buffer, by width. ``offsets``: where
    each text begins; ``carried``: leading words whose features were given already."""
    found = list(WORD.finditer(joined))
    if not found:
        return
    vocabulary = Vocabulary([m.group() for m in found])
    which = vocabulary.which
    text = np.searchsorted(offsets, np.fromiter((m.start() for m in found), np.int64, len(found)), "right") - 1
    sums = vocabulary.alone[which]
    for more in range(how.width):
        if more:
            sums = vocabulary.append(sums[:-1], which[more:])
        inside = text[: len(sums)] == text[more:]
        inside[: max(0, carried - more)] = False  # runs that end in a carried word
        yield text[: len(sums)][inside], (sums[inside] % np.uint32(how.buckets)).astype(np.int64), more


def _buffers(texts: pa.Array, how: Resampling) -> Iterator[tuple[int, bytes, np.ndarray, int]]:
    """First row, lower-case buffer, beginnings of the texts in it, and carried words.

    A text above the chunk size fills several buffers: it is cut between words, and the last
    words before a cut stand again before what follows.
    """
    for at, to in text_chunks(texts, CHUNK_BYTES):
        parts = [t or b"" for t in texts[at:to].to_pylist()]
        if len(parts) > 1 or len(parts[0]) <= CHUNK_BYTES:
            sizes = np.array([len(p) + 1 for p in parts], dtype=np.int64)
            yield at, SEPARATOR.join(parts).lower(), np.cumsum(sizes) - sizes, 0
            continue
        data, begin, before = parts[0], 0, []
        while begin < len(data):
            gap = GAP.search(data, begin + CHUNK_BYTES)
            end = gap.start() if gap else len(data)
            part = data[begin:end].lower()
            yield at, b" ".join([*before, part]), np.zeros(1, dtype=np.int64), len(before)
            if how.width > 1:
                before = (before + WORD.findall(part))[1 - how.width :]
            begin = end


def _count_rows(how: Resampling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(how.buckets, dtype=np.int64)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            for _, joined, offsets, carried in _buffers(texts, how):
                for _, bucket, _ in _features(joined, offsets, carried, how):
                    counts += np.bincount(bucket, minlength=how.buckets)
        held = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(held), pa.array(counts[held])], names=["bucket", "n"])

    return run


def feature_counts(texts: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """bucket and n: how many features of all rows' ``text`` fall into each bucket.

    Every task adds up its own, so at most ``buckets`` rows a task are shuffled.
    """
    counted = arrow_rows(texts.select("text"), _count_rows(how), "bucket bigint, n bigint")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, targets: DataFrame, how: Resampling = Resampling()) -> np.ndarray:
    """Each bucket's gain from two tables of ``feature_counts``, of ``buckets`` rows at most."""
    sides = []
    for counts in (documents, targets):
        side = np.zeros(how.buckets)
        for row in counts.collect():
            side[row.bucket] = row.n
        sides.append(side)
    (s, t), (all_s, all_t) = sides, (side.sum() for side in sides)
    ratios = (t + 1) * (all_s + how.buckets) / ((s + 1) * (all_t + how.buckets))
    return np.array([math.floor(1000 * math.log(r)) for r in ratios.tolist()], dtype=np.int64)


def _weight_rows(gains: np.ndarray, how: Resampling):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            words, features, total = (np.zeros(len(texts), dtype=np.int64) for _ in range(3))
            for at, joined, offsets, carried in _buffers(texts, how):
                rows = slice(at, at + len(offsets))
                for text, bucket, more in _features(joined, offsets, carried, how):
                    there = np.bincount(text, minlength=len(offsets))
                    features[rows] += there
                    if not more:
                        words[rows] += there
                    # sums of whole numbers, exact in doubles
                    total[rows] += np.bincount(text, gains[bucket], len(offsets)).astype(np.int64)
            weight = np.where(features > 0, total // np.maximum(features, 1), 0)
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("row_key"), *map(pa.array, (words, features, weight))],
                names=["doc_id", "row_key", "n_words", "n_features", "weight"],
            )

    return run


def document_weights(docs: DataFrame, gains: np.ndarray, how: Resampling = Resampling()) -> DataFrame:
    """doc_id, row_key (hash of the text), n_words, n_features and weight of every row."""
    source = docs.select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("row_key"), "text")
    schema = "doc_id bigint, row_key bigint, n_words bigint, n_features bigint, weight bigint"
    return arrow_rows(source, _weight_rows(gains, how), schema)


def gumbel_draw(seed: int, doc_id: F.Column) -> F.Column:
    """A Gumbel number in thousandths, fixed by seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((draw + 0.5) / float(DRAWS))))


def _place_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Numbers the rows of a task in their order."""
    before = 0
    for batch in batches:
        yield batch.append_column("place", pa.array(np.arange(before, before + batch.num_rows)))
        before += batch.num_rows


def ranked(rows: DataFrame, order: list[F.Column]) -> DataFrame:
    """``rows`` with ``rank`` from 1 over the whole table, however large.

    Rows are dealt to tasks by ranges and numbered there; only the number of rows of each
    range is added up. The last key of the ranges is a random number, so that
    rows alike in ``order`` may be parted, too.
    """
    dealt = rows.withColumn("_deal", F.rand(7))
    keys = [*order, F.col("_deal")]
    dealt = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_deal")
    dealt = dealt.withColumn("part", F.spark_partition_id())
    schema = T.StructType([*dealt.schema.fields, T.StructField("place", T.LongType())])
    placed = stage(arrow_rows(dealt, _place_rows, schema), "ranges")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    # one row for each range, of which there are as many as shuffle partitions
    return (
        placed.join(F.broadcast(before), "part")
        .withColumn("rank", F.col("before") + F.col("place") + 1)
        .drop("part", "place", "before")
    )


def resample(docs: DataFrame, targets: DataFrame, how: Resampling = Resampling()) -> DataFrame:
    """doc_id, row_key, n_words, n_features, weight, score and rank of every document.

    ``targets`` has a column ``text``. Of the documents with enough words the share with the highest
    scores is drawn and ranked, ties by doc_id; all others have no rank.
    """
    gains = bucket_gains(feature_counts(docs, how), feature_counts(targets, how), how)
    weights = document_weights(docs, gains, how)
    scored = stage(weights.withColumn("score", F.col("weight") + gumbel_draw(how.seed, F.col("doc_id"))), "scored")
    enough = F.col("n_words") >= how.min_words
    drawn = how.percent * scored.where(enough).count() // 100
    order = [enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row_key")]
    first = enough & (F.col("rank") <= drawn)
    return ranked(scored, order).withColumn("rank", F.when(first, F.col("rank")))


def drawn_documents(docs: DataFrame, resampled: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``resample`` drew, with all their columns."""
    drawn = resampled.where("rank IS NOT NULL").select(
        F.col("doc_id").alias("_id"), F.col("row_key").alias("_key")
    ).distinct()
    same = docs["doc_id"].cast("bigint").eqNullSafe(F.col("_id")) & (F.xxhash64(docs["text"]) == F.col("_key"))
    return docs.join(drawn, same, "left_semi")
