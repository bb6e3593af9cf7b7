"""Token counts of real tokenizers, and totals kept by signed batches, against the library."""

from collections import Counter

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kinrate.llm.encoding import LOWERED, SPACED
from kinrate.llm.queries import op7_token_counts
from kinrate.llm.token_counts import TokenCounts, count_tokens

NAMES = {"byte_bpe_50k": ("byte_bpe_50k.json", SPACED), "word_bpe_49k": ("word_bpe_49k.json", LOWERED)}


def counters():
    found = {}
    for name, (file, _) in NAMES.items():
        tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
        tokenizer.encode_special_tokens = True
        found[name] = lambda text, t=tokenizer: len(t.encode(text or "", add_special_tokens=False).ids)
    return found


def brute_force(rows):
    """Totals of the first row, by doc_id, of each text."""
    first, totals, docs = {}, Counter(), Counter()
    for doc, _, _, text in rows:
        if doc is not None:
            first[text or ""] = min(first.get(text or "", doc), doc)
    for doc, source, lang, text in rows:
        if doc is None or first.get(text or "", doc) >= doc:
            for name, count in counters_of.items():
                totals[source, lang, name] += count(text)
                docs[source, lang, name] += 1
    return {key: (docs[key], totals[key]) for key in docs}


counters_of = counters()


def totals(df):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in df.collect()}


def test_query_over_the_given_table(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "text")
    assert totals(op7_token_counts(spark, folder)) == brute_force([tuple(r) for r in docs.collect()])


def test_query_over_odd_rows(spark, tmp_path):
    rows = [
        (1, "s", "en", "the cat, the dog"),
        (2, "s", "en", "the cat, the dog"),
        (3, "s", None, None),
        (4, None, "en", ""),
        (5, "s", "de", None),
        (None, "s", "en", "the cat, the dog"),
        (6, "t", "zh", "語 é " * 50),
        (6, "t", "zh", "another row of six"),
    ]
    made = spark.createDataFrame(rows, "doc_id bigint, source string, lang string, text string")
    made.withColumn("counts", F.lit(1)).write.parquet(f"{tmp_path}/documents.parquet")
    assert totals(op7_token_counts(spark, str(tmp_path))) == brute_force(rows)


def test_counts_of_texts(spark, docs_of):
    texts = {1: "One two.", 2: None, 3: "", 4: "語" * 9, 5: "x\n\ny  z"}
    tokenizers = {name: (public_tokenizers.path(file), words) for name, (file, words) in NAMES.items()}
    rows = count_tokens(docs_of(texts), tokenizers).collect()
    assert {r.doc_id: r.counts for r in rows} == {i: {n: c(t) for n, c in counters_of.items()} for i, t in texts.items()}
    assert {r.words for r in rows} == {"x"}  # a further column
    assert count_tokens(docs_of([]), tokenizers).count() == 0


def test_a_committed_batch_is_never_rewritten(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, old_tokens bigint, new_tokens bigint"
    store = TokenCounts(spark, str(tmp_path / "store"))
    store.commit("a", spark.createDataFrame([("s", "en", "t", None, 5)], schema))
    broken = spark.createDataFrame([("s", "en", "t")], "source string, lang string, tokenizer string").select(
        "*", F.lit(None).cast("bigint").alias("old_tokens"), F.raise_error(F.lit("lost")).cast("bigint").alias("new_tokens")
    )
    store.commit("a", broken)  # not even read
    assert totals(store.totals()) == {("s", "en", "t"): (1, 5)}
    with pytest.raises(Exception, match="lost"):
        store.commit("b", broken)
    assert totals(store.totals()) == {("s", "en", "t"): (1, 5)}
