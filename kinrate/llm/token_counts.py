"""Token totals by source, language and tokenizer version, kept up by signed changes.

A change of a document is an insert (no old count), a delete (no new count) or a revised
count (both). A batch of changes is summed up to signed numbers of documents and tokens
by key and written to the folder of its batch id; then the batch is marked as committed.
Totals are the sums over committed batches. A batch that is committed already is left as it
is when it comes again; one that a crash cut off half way has no mark, does not count, and is written
anew. So no batch counts twice or is ever missing after its mark. Batches can be
merged into one snapshot, which lists the batches that it contains; one of these that is
committed to the snapshot's store again changes nothing. The name ``snapshot`` is kept for it.

Null counts are as above; a change with neither count changes nothing. Null keys are keys
of their own. Repeated changes count each time. Other columns are ignored. An empty batch
commits without rows. Totals of an empty store are empty.

``count_tokens`` gives the counts of whole texts under any number of tokenizers; a null text counts
as an empty one, of no tokens.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from kinrate.llm.encoding import encoded_chunks, pieces_of
from kinrate.llm.shipping import arrow_rows

KEYS = ("source", "lang", "tokenizer")
_DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
_MARKS = "batch_id string"
SNAPSHOT = "snapshot"
KEPT_PIECES = 200_000  # pieces of text that a worker keeps, for each tokenizer


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def deltas(changes: DataFrame) -> DataFrame:
    """Signed documents and tokens of each key; keys that end up unchanged are left out."""
    old, new = F.col("old_tokens").cast("bigint"), F.col("new_tokens").cast("bigint")
    docs = new.isNotNull().cast("bigint") - old.isNotNull().cast("bigint")
    tokens = F.coalesce(new, F.lit(0)) - F.coalesce(old, F.lit(0))
    return (
        changes.select(*KEYS, docs.alias("docs"), tokens.alias("tokens"))
        .groupBy(*KEYS)
        .agg(F.sum("docs").cast("bigint").alias("n_docs"), F.sum("tokens").cast("bigint").alias("n_tokens"))
        .where("n_docs != 0 OR n_tokens != 0")
    )


def _counted_rows(tokenizers: list[tuple[str, str]], kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = [pieces_of(path, words, KEPT_PIECES) for path, words in tokenizers]
        for batch in batches:
            counts = [
                np.concatenate([np.diff(first) for _, _, first in encoded_chunks(batch, one)] or [np.zeros(0, np.int64)])
                for one in pieces
            ]
            whole = np.stack(counts, axis=1).astype(np.int64)
            bounds = pa.array(np.arange(len(whole) + 1) * len(pieces), pa.int32())
            lists = pa.ListArray.from_arrays(bounds, pa.array(whole.ravel()))
            yield pa.record_batch([*(batch.column(c) for c in kept), lists], names=[*kept, "counts"])

    return run


def count_tokens(docs: DataFrame, tokenizers: Mapping[str, tuple[str, str]]) -> DataFrame:
    """``docs`` without ``text``, with ``counts``: the tokens of each text by tokenizer name.

    ``tokenizers`` gives each name the path of a tokenizer file and how it sees words.
    """
    kept = [c for c in docs.columns if c not in ("text", "counts")]
    fields = [f for f in docs.schema.fields if f.name in kept]
    schema = T.StructType([*fields, T.StructField("counts", T.ArrayType(T.LongType()))])
    rows = arrow_rows(docs.select("text", *kept), _counted_rows(list(tokenizers.values()), kept), schema)
    names = F.array(*[F.lit(name) for name in tokenizers])
    return rows.withColumn("counts", F.map_from_arrays(names, F.col("counts")))


class TokenCounts:
    """A store of signed totals in one folder that all executors share."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def commit(self, batch_id: str, changes: DataFrame) -> None:
        """Add a batch, unless it was added before."""
        if not batch_id.replace("-", "").replace("_", "").isalnum():
            raise ValueError("a batch id has letters, digits, - and _ only")
        if batch_id == SNAPSHOT:
            raise ValueError(f"{SNAPSHOT!r} names the merged batches")
        if self.batches().where(F.col("batch_id") == batch_id).first():
            return
        deltas(changes).write.mode("overwrite").parquet(f"{self.folder}/deltas/batch_id={batch_id}")
        mark = self.spark.createDataFrame([(batch_id,)], _MARKS)
        mark.write.mode("overwrite").parquet(f"{self.folder}/commits/of={batch_id}")

    def _read(self, name: str, schema: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not _exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def _stored(self) -> DataFrame:
        """Batches with changes of their own here."""
        return self._read("commits", _MARKS).select("batch_id").distinct()

    def _merged(self) -> DataFrame:
        """Batches that the snapshot contains."""
        return self._read("merged", _MARKS).select("batch_id").distinct()

    def batches(self) -> DataFrame:
        return self._stored().unionByName(self._merged()).distinct()

    def totals(self) -> DataFrame:
        """Documents and tokens by key, without keys that have neither."""
        rows = self._read("deltas", f"{_DELTAS}, {_MARKS}")
        return (
            rows.join(self._stored(), "batch_id", "left_semi")
            .groupBy(*KEYS)
            .agg(F.sum("n_docs").cast("bigint").alias("n_docs"), F.sum("n_tokens").cast("bigint").alias("n_tokens"))
            .where("n_docs != 0 OR n_tokens != 0")
        )

    def snapshot(self, folder: str) -> TokenCounts:
        """The committed batches merged into one of a new store, which lists them."""
        self.totals().write.mode("errorifexists").parquet(f"{folder}/deltas/batch_id={SNAPSHOT}")
        merged = self.batches().where(F.col("batch_id") != SNAPSHOT)
        merged.write.mode("errorifexists").parquet(f"{folder}/merged/of={SNAPSHOT}")
        mark = self.spark.createDataFrame([(SNAPSHOT,)], _MARKS)
        mark.write.mode("errorifexists").parquet(f"{folder}/commits/of={SNAPSHOT}")
        return TokenCounts(self.spark, folder)
