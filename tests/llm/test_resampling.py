import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from kinrate.llm import resampling
from kinrate.llm.queries import op11_importance_resampling
from kinrate.llm.resampling import Resampling, document_weights, drawn_documents, feature_counts, resample

FOLDER = "/root/testdata/sf0.001"
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def features(text, width=2):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_TO_Z))
    runs = [" ".join(words[i : i + w]) for w in range(1, width + 1) for i in range(len(words) - w + 1)]
    return words, [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute_force(docs, targets, percent=25, least=20, seed=7):
    """(doc_id, n_features, weight, score, rank) of each of the (doc_id, text) pairs."""
    s = Counter(b for _, t in docs for b in features(t)[1])
    t = Counter(b for text in targets for b in features(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
        for b in range(10000)
    ]
    rows, enough = [], []
    for i, (doc, text) in enumerate(docs):
        words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc, len(found), weight, score, None])
        if len(words) >= least:
            enough.append((-score, doc is None, doc or 0, len(found), i))
    for rank, (*_, i) in enumerate(sorted(enough)[: percent * len(enough) // 100], 1):
        rows[i][4] = rank
    return sorted(map(repr, map(tuple, rows)))


def spark_rows(rows):
    return sorted(repr(tuple(r)) for r in rows.select("doc_id", "n_features", "weight", "score", "rank").collect())


def made(spark, docs, targets):
    named = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, rank string, score int")
    return named, spark.createDataFrame([(t,) for t in targets], "text string")


def test_query_over_the_given_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    targets = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    assert spark_rows(op11_importance_resampling(spark, FOLDER)) == brute_force(docs, targets)


def test_odd_texts(spark):
    docs = [
        (4, "Ein Wort, zwei WÖRTER; drei wörter: " * 9),
        (4, "a row that shares the id " * 5),
        (-3, "x" * 200 + " y " + "z" * 65 + " " + "é" * 40),
        (7, None),
        (8, ""),
        (9, " \x00 ,;"),
        (None, "no id at all " * 8),
        (10, "trailing word"),
        (11, "leading word"),
        *[(i, "the same text again and again " * 4) for i in range(20, 60)],
    ]
    targets = ["zwei wörter drei", None, "", "the same, once"]
    tables = made(spark, docs, targets)
    assert spark_rows(resample(*tables)) == brute_force(docs, targets)


def test_repeated_rows_are_ranked_one_by_one(spark):
    docs = [(1, "one two three four " * 6)] * 40 + [(2, "short")]
    tables = made(spark, docs, ["four one"])
    ranks = sorted(r.rank for r in resample(*tables).collect() if r.rank is not None)
    assert ranks == list(range(1, 11))


def test_empty_tables(spark):
    docs = [(i, f"word{i} and more words " * 6) for i in range(9)]
    assert resample(*made(spark, [], ["a b"])).count() == 0
    assert spark_rows(resample(*made(spark, docs, []))) == brute_force(docs, [])


def test_texts_longer_than_a_buffer(spark, monkeypatch):
    text = " ".join(f"Wort{i * i % 97}é" for i in range(3000)) + "\n" + "q" * 500 + " end"
    docs = [(1, text), (2, "short text"), (3, text + " more")]
    whole = made(spark, docs, ["wort4é wort9é"])[0]

    def counts(how):
        return {r.bucket: r.n for r in feature_counts(whole, how).collect()}

    for width in (1, 2, 3):
        expected = Counter(b for _, t in docs for b in features(t, width)[1])
        assert counts(Resampling(width=width)) == expected
        # as the tasks do it, with buffers that cut the long texts
        import pyarrow as pa

        monkeypatch.setattr(resampling, "CHUNK_BYTES", 700)
        batch = pa.record_batch({"text": pa.array([t for _, t in docs])})
        (made_batch,) = resampling._count_rows(Resampling(width=width))(iter([batch]))
        assert dict(zip(*(c.to_pylist() for c in made_batch.columns))) == expected
        monkeypatch.undo()


@pytest.mark.parametrize("length", [1, 2, 7, 64, 65, 300])
def test_checksums_of_runs(length):
    words = [b"a" * length, "ü".encode() * length, b"0"]
    vocabulary = resampling.Vocabulary(words)
    for i in range(3):
        sums = vocabulary.append(np.array([zlib.crc32(b"before")], dtype=np.uint32), vocabulary.which[i : i + 1])
        assert sums[0] == zlib.crc32(b"before " + words[i])


def test_drawn_documents_keep_their_columns(spark):
    docs = [(i, f"word{i % 3} " * 30) for i in range(16)] + [(None, "null id " * 30)]
    table, targets = made(spark, docs, ["word1"])
    rows = stage = resample(table, targets)
    drawn = drawn_documents(table, rows)
    assert drawn.columns == table.columns
    assert drawn.count() == stage.where("rank IS NOT NULL").count() == 4


def test_weights_favour_the_targets(spark):
    docs = [(i, "alpha beta gamma " * 10 if i % 2 else "red green blue " * 10) for i in range(40)]
    table, targets = made(spark, docs, ["alpha beta", "beta gamma alpha"])
    gains = resampling.bucket_gains(feature_counts(table), feature_counts(targets))
    weights = {r.doc_id: r.weight for r in document_weights(table, gains).collect()}
    assert min(w for i, w in weights.items() if i % 2) > max(w for i, w in weights.items() if not i % 2)
