"""The training-text operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinrate.llm import byte_bpe, fingerprints, language_id, licences, topk_search
from kinrate.llm.encoding import LOWERED, SPACED
from kinrate.llm.jaccard_join import Jaccard, jaccard_links
from kinrate.llm.line_dedup import remove_lines
from kinrate.llm.packing import pack_documents
from kinrate.llm.periodic_runs import best_run, periodic_runs
from kinrate.llm.resampling import Resampling, resample
from kinrate.llm.substring_dedup import remove_repeats
from kinrate.llm.token_counts import TokenCounts, count_tokens
from kinrate.llm.token_files import token_offsets, write_token_files
from kinrate.plans.storage import new_path, stage

# Fixed value: a word, as the contracts of the queries define it.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words in windows of 50 that an earlier document has, removed."""
    result = remove_repeats(documents(spark, folder).select("doc_id", "text"), k=50)
    return result.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of every text, learnt from three of four folds."""
    docs = documents(spark, folder)
    fold = language_id.fold(F.col("doc_id"))
    model = language_id.train(docs.where(fold != 2).select(F.col("doc_id").alias("key"), "text", "lang"))
    rows = docs.select("doc_id", "text", F.coalesce(fold == 2, F.lit(False)).alias("held_out"))
    return language_id.predict(rows, model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents and lines of documents that are a known licence text."""
    return licences.find_licences(documents(spark, folder), licences.known_digests(spark))


def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in sequences of 1024 tokens, shown by the checksums of the packed ids."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack_documents(documents(spark, folder), path, end_id=2, capacity=1024).drop("ids")


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Classes of documents with like sets of 4-word shingles, and the links of each."""
    classes = jaccard_links(documents(spark, folder), Jaccard(width=4, percent=85))
    return classes.select("doc_id", "n_shingles", "component_id", "n_links")


def op6_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids written as ORC files in order of doc_id, and read back."""
    target = new_path(spark, "tokens")
    write_token_files(documents(spark, folder), target, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_offsets(spark, target)


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals of two tokenizers after three batches: rough counts of all documents, exact
    counts in place of the rough ones, and the removal of repeated texts.

    A rough count is a token for each four bytes. Null texts are empty ones.
    """
    tokenizers = {
        "byte_bpe_50k": (public_tokenizers.path("byte_bpe_50k.json"), SPACED),
        "word_bpe_49k": (public_tokenizers.path("word_bpe_49k.json"), LOWERED),
    }
    text = F.coalesce("text", F.lit(""))
    rough = F.ceil(F.octet_length(text) / 4).cast("bigint").alias("rough")
    docs = documents(spark, folder).select("doc_id", "source", "lang", "text", F.sha2(text, 256).alias("digest"), rough)
    counted = stage(count_tokens(docs, tokenizers), "counted")
    none = F.lit(None).cast("bigint")
    count = F.col("tokens")

    def changes(rows: DataFrame, old: F.Column, new: F.Column) -> DataFrame:
        each = rows.select("source", "lang", "rough", F.explode("counts").alias("tokenizer", "tokens"))
        return each.select("source", "lang", "tokenizer", old.alias("old_tokens"), new.alias("new_tokens"))

    store = TokenCounts(spark, new_path(spark, "counts"))
    store.commit("load", changes(counted, none, F.col("rough")))
    store.commit("revise", changes(counted, F.col("rough"), count))
    first = stage(counted.groupBy("digest").agg(F.min("doc_id").alias("first")), "first")
    store.commit("delete", changes(counted.join(first, "digest").where("doc_id > first"), count, none))
    store.commit("revise", changes(counted, F.col("rough"), count))  # again, as after a lost answer
    return store.totals()


def op8_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again."""
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    encoded = byte_bpe.encode_documents(documents(spark, folder), path, pattern)
    return byte_bpe.decode_documents(encoded, path, pattern).select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op9_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited form, and how alike they are."""
    return fingerprints.compare_with_next(documents(spark, folder))


def op10_topk_search(spark: SparkSession, folder: str) -> DataFrame:
    """The ten best other vectors for each hundredth one."""
    vectors = topk_search.whole_vectors(spark.read.parquet(f"{folder}/embeddings.parquet"))
    vectors = stage(vectors, "vectors")
    return topk_search.top_k(vectors.where("vec_id % 100 = 0"), vectors, k=10).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def op11_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """A quarter of the longer documents, drawn towards the words of the benchmark."""
    targets = spark.read.parquet(f"{folder}/benchmark.parquet")
    rows = resample(documents(spark, folder), targets, Resampling(width=2, buckets=10_000, percent=25, min_words=20, seed=7))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


def op12_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines of ten characters or more that an earlier document has, removed."""
    rows = remove_lines(documents(spark, folder).select("doc_id", "text"), least_chars=10)
    return rows.select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def replanted(docs: DataFrame) -> DataFrame:
    """doc_id and text, of which one in ten repeats a part of itself up to its end.

    With h the CRC-32 of the id and g = h div 10, from word a = g mod n on the words are
    those of the p words there, again and again, for p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeated(words: F.Column) -> F.Column:
        n = F.size(words)
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        from_place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p)
        places = F.sequence(F.lit(0), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(words, from_place(i).cast("int"))), " ")

    words = F.regexp_extract_all("text", F.lit(f"({WORD})"))
    # a lambda over one element, so that the words are found once and not for each place
    edited = F.get(
        F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, repeated(w)).otherwise(F.col("text"))), F.lit(0)
    )
    return docs.select("doc_id", F.when(h % 10 == 0, edited).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every text after the planted edit, and digests of all of them."""
    rows = periodic_runs(replanted(documents(spark, folder)), least_words=6, times=4)
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return rows.withColumn("best", best_run(F.col("runs"))).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_language_id,
        op3_license_scan,
        op4_best_fit_packing,
        op5_jaccard_join,
        op6_token_files,
        op7_token_counts,
        op8_byte_bpe,
        op9_fingerprints,
        op10_topk_search,
        op11_importance_resampling,
        op12_line_dedup,
        op13_periodic_runs,
    )
}
