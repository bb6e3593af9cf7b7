import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kinrate.llm import language_id
from kinrate.llm.oracle import ORACLE
from kinrate.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, name):
    with duckdb.connect() as sql:
        for table in ("documents", "embeddings"):
            sql.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
        expected = sql.execute(ORACLE[name])
        types = {c[0]: str(c[1]) for c in expected.description}
        got = QUERIES[name](spark, DATA)
        assert {c: TYPES[t] for c, t in got.dtypes} == types
        rows = sorted(repr(tuple(r[c] for c in types)) for r in got.collect())
        assert rows == sorted(map(repr, expected.fetchall()))


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    result = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id")
    held = result.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert held[0] >= 0.97 and held[1] > 100
    assert result.where("score < 0 OR score > 1 OR rejected").count() == 0


def test_language_of_odd_texts(spark, docs_of):
    learn = docs_of([(i, t) for i, t in enumerate(["the cat and the dog", "le chat et la souris"] * 20)])
    learn = learn.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "en").otherwise("fr"))
    model = language_id.train(learn.withColumn("key", F.col("doc_id")))
    odd = docs_of({1: None, 2: "", 3: "12 34 !", 4: "the dog", 5: "la souris", 6: "語", 7: "the " * 50_000})
    rows = language_id.predict(odd.withColumn("score", F.lit("old")), model).collect()
    found = {r.doc_id: (r.lang_pred, r.rejected) for r in rows}
    assert [found[i] for i in (1, 2, 3)] == [("und", True)] * 3
    assert [found[i][0] for i in (4, 5, 7)] == ["en", "fr", "en"] and found[6][0] in ("en", "fr")
    assert language_id.predict(docs_of([]), model).count() == 0
    none = language_id.train(odd.withColumn("key", F.col("doc_id")))
    assert none is None
    assert {r.lang_pred for r in language_id.predict(odd, none).collect()} == {"und"}


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    words = F.concat_ws(" ", F.sequence(F.lit(1), F.lit(60)).cast("array<string>"))
    first = docs.orderBy("doc_id").first()
    more = spark.createDataFrame(
        [(9001, first.text, "en", "s", 1), (9002, None, None, None, None), (9003, "12 34", None, None, 5),
         (9004, "   ", "en", "s", 3), (None, "the words that stand here", "en", "s", 24)],
        docs.schema,
    )
    docs = docs.unionByName(more)
    steps = {}
    for name, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, DATA).cache()
        steps[name] = docs
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert all(steps[n].columns == columns for n in ("language_id", "near_duplicates", "substring_dedup"))
    ids = {n: {r.doc_id for r in steps[n].select("doc_id").distinct().collect()} for n in steps}
    assert not ids["language_id"] & {9002, 9003, 9004} and 9001 in ids["language_id"]
    assert 9001 not in ids["near_duplicates"] and first.doc_id in ids["near_duplicates"]
    assert ids["packing"] == ids["substring_dedup"] <= ids["near_duplicates"] and None in ids["packing"]
    assert steps["substring_dedup"].where("n_chars != length(text)").count() <= steps["near_duplicates"].where(
        "n_chars != length(text)").count()
    again = corpus_pipeline.run(spark, DATA)
    assert again.count() > 0 and set(again.columns) == set(steps["packing"].columns)


def test_pipeline_over_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").where("false")
    for _, function in corpus_pipeline.STAGES:
        docs = function(spark, docs, DATA)
    assert docs.count() == 0
