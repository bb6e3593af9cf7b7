"""Token ids as ORC files: sorted by document id, with row indexes and Bloom filters.

Documents are dealt to files by ranges of doc_id and sorted in each, so files, stripes and
row groups cover ascending ranges. ORC run-length encodes the ids to as few bits as they
need. Its stripes can be read in parallel, and a look-up of some doc_ids skips stripes
and row groups by their least and greatest id and by their Bloom filter.

A null or empty text is a document of the end token alone. Rows with a null doc_id come
first; rows that repeat a doc_id are all kept, next to each other. Other columns are
ignored. An empty table gives files without rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from kinrate.llm.encoding import LOWERED, encoded_chunks, pieces_of
from kinrate.llm.shipping import arrow_rows

SCHEMA = "doc_id bigint, ids array<int>"
# Rows between two index entries, bytes of a stripe, wrong answers of the Bloom filters.
ORC_OPTIONS = {
    "orc.row.index.stride": "2000",
    "orc.stripe.size": str(32 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}


def _id_rows(path: str, words: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(path, words)
        for batch in batches:
            for small, flat, first in encoded_chunks(batch, pieces):
                ended = np.insert(flat, first[1:], end_id).astype("<u4").view("<i4")
                bounds = pa.array(first + np.arange(len(first)), pa.int32())
                lists = pa.ListArray.from_arrays(bounds, pa.array(ended))
                yield pa.record_batch([small.column("doc_id"), lists], names=["doc_id", "ids"])

    return run


def write_token_files(
    docs: DataFrame, folder: str, path: str, words: str = LOWERED, end_id: int = 1
) -> None:
    """Encode each document, end it with ``end_id`` and write ORC files in doc_id order."""
    ordered = (
        docs.select(F.col("doc_id").cast("bigint"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    rows = arrow_rows(ordered, _id_rows(path, words, end_id), SCHEMA)
    rows.write.options(**ORC_OPTIONS).mode("errorifexists").orc(folder)


def read_token_files(spark: SparkSession, folder: str, doc_ids: Iterable[int] | None = None) -> DataFrame:
    """doc_id and ids of all documents, or of some, for which indexes rule out most files."""
    rows = spark.read.schema(SCHEMA).orc(folder)
    return rows if doc_ids is None else rows.where(F.col("doc_id").isin(list(doc_ids)))


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column("ids")
        bounds = lists.offsets.to_numpy()
        ids = lists.values.to_numpy().astype("<u4", copy=False)
        sums = [zlib.crc32(ids[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
        yield pa.record_batch(
            [
                batch.column("file"),
                batch.column("doc_id"),
                pa.array(np.diff(bounds).astype(np.int64)),
                pa.array(sums, pa.int64()),
            ],
            names=["file", "doc_id", "n_tokens", "ids_crc32"],
        )


def token_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 from the files."""
    rows = read_token_files(spark, folder).select(F.col("_metadata.file_name").alias("file"), "doc_id", "ids")
    sums = arrow_rows(rows, _sum_rows, "file string, doc_id bigint, n_tokens bigint, ids_crc32 bigint")
    # files are in the order of their least doc_id, those without any first; one row a file is summed up
    earlier = Window.orderBy(F.col("least").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    files = sums.groupBy("file").agg(F.sum("n_tokens").alias("tokens"), F.min("doc_id").alias("least"))
    files = files.select("file", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("doc_id", "ids_crc32", "n_tokens").rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        sums.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
        .join(files, "file")
        .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")
    )
