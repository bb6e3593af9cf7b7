"""Licences, fingerprints, token counts and search."""

import random

import pytest
import xxhash
from pyspark.sql import functions as F

from kinrate.llm.fingerprints import GROUP_WORDS, SKETCH, compare_with_next
from kinrate.llm.licences import ISC, MIT, find_licences, known_digests
from kinrate.llm.token_counts import TokenCounts
from kinrate.llm.topk_search import top_k, whole_vectors

PYTHON = ("Python", "Arrow", "Pandas")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_licences(spark, docs_of):
    docs = docs_of({
        1: "Copyright (c) 2020 Someone\n\n" + MIT.replace(", ", " ,\n"),
        2: "prose\n  RELEASED under the MIT LICENCE!\nmore prose\nReleased under the MIT License.",
        3: "prose, released under the MIT License.",
        4: "© 2019 Me\nAll rights reserved.\n" + ISC.upper(),
        5: None,
        6: "",
        7: "Licensed under the Apache License, Version 2.0",
    })
    found = find_licences(docs, known_digests(spark))
    assert not any(p in plan(found) for p in PYTHON)
    rows = {(r.doc_id, r.licence): (r.n_lines, r.whole_text) for r in found.collect()}
    assert rows == {
        (1, "MIT"): (0, True),
        (2, "MIT"): (2, False),
        (4, "ISC"): (0, True),
        (7, "Apache-2.0"): (1, True),
    }
    assert find_licences(docs_of([]), known_digests(spark)).count() == 0
    assert find_licences(docs, known_digests(spark).limit(0)).count() == 0


def long_hash(value, seed=42):
    hashed = xxhash.xxh64(value.to_bytes(8, "little", signed=True), seed).intdigest()
    return hashed - (1 << 64) if hashed >> 63 else hashed


def text_hash(value, seed=42):
    hashed = xxhash.xxh64(value, seed).intdigest()
    return hashed - (1 << 64) if hashed >> 63 else hashed


def sketch(text):
    words = text.encode().split()
    if not words:
        return []
    if len(words) < GROUP_WORDS:
        seed = 42
        for w in words:
            seed = text_hash(w, seed & (1 << 64) - 1)
        return [seed]
    pairs = [text_hash(b, text_hash(a) & (1 << 64) - 1) for a, b in zip(words, words[1:])]
    found = set()
    for i in range(len(words) - GROUP_WORDS + 1):
        inner = pairs[i : i + GROUP_WORDS - 1]
        if min(inner) in (inner[0], inner[-1]):
            seed = 42
            for p in inner[::2]:
                seed = long_hash(p, seed & (1 << 64) - 1)
            found.add(seed)
    return sorted(found)[:SKETCH]


def likeness(a, b):
    least = sorted({*a, *b})[:SKETCH]
    return len([h for h in least if h in a and h in b]) / len(least) if least else 1.0


def test_fingerprints(spark, docs_of):
    random_ = random.Random(2)
    texts = {i * 7: " ".join(f"{random_.choice('éabc')}{random_.randrange(50)}" for _ in range(random_.randrange(150)))
             for i in range(60)}
    texts |= {1: None, 2: "", 3: "a b", 4: "  a\tb ", 5: "x" * 3000, 1000: texts[7]}
    result = compare_with_next(docs_of([*texts.items(), (None, "left out")]))
    assert not any(p in plan(result) for p in PYTHON)
    rows = {r.doc_id: r for r in result.collect()}
    order = sorted(texts, reverse=True)
    assert set(rows) == set(texts)
    for i, doc in enumerate(order):
        text, following = texts[doc] or "", texts[order[(i + 1) % len(order)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        hexed = lambda s: "".join(f"{h & (1 << 64) - 1:016x}" for h in s)
        own, changed, after = sketch(text), sketch(edited), sketch(following)
        r = rows[doc]
        assert (r.n_chars, r.fingerprint, r.edited_fingerprint) == (len(text), hexed(own), hexed(changed))
        assert r.near_edited == pytest.approx(likeness(own, changed))
        assert r.near_next == pytest.approx(likeness(own, after))
    assert compare_with_next(docs_of([])).count() == 0
    alone = compare_with_next(docs_of({5: "one two"})).first()
    assert (alone.near_next, alone.n_chars) == (1.0, 7)


def test_token_counts(spark, tmp_path):
    schema = "source string, lang string, tokenizer string, old_tokens bigint, new_tokens bigint, doc_id int"

    def changes(*rows):
        return spark.createDataFrame([(*r, 0) for r in rows], schema)

    def totals(store):
        return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}

    store = TokenCounts(spark, str(tmp_path / "store"))
    assert totals(store) == {}
    store.commit("a", changes(("s", "en", "t", None, 5), ("s", "en", "t", None, 7), (None, None, "t", None, 1)))
    revise = changes(("s", "en", "t", 5, 6), (None, None, "t", 1, None), ("s", "en", "t", None, None))
    for _ in range(3):  # a batch that is committed again counts once
        store.commit("b", revise)
    assert totals(store) == {("s", "en", "t"): (2, 13)}
    store.commit("c", changes())
    # a batch whose mark was never written does not count
    revise.write.mode("overwrite").parquet(str(tmp_path / "ignored"))
    changes(("s", "en", "t", None, 99)).selectExpr(
        "source", "lang", "tokenizer", "1L n_docs", "new_tokens n_tokens"
    ).write.parquet(str(tmp_path / "store/deltas/batch_id=half"))
    assert totals(store) == {("s", "en", "t"): (2, 13)}
    merged = store.snapshot(str(tmp_path / "merged"))
    assert totals(merged) == totals(store)
    assert {r.batch_id for r in merged.batches().collect()} == {"a", "b", "c", "snapshot"}
    with pytest.raises(ValueError):
        store.commit("../x", changes())


def test_search(spark):
    random_ = random.Random(4)
    nan, inf = float("nan"), float("inf")
    vectors = {i: [random_.choice([0.0, random_.uniform(-1, 1)]) for _ in range(6)] for i in range(300)}
    vectors |= {300: vectors[7], 301: vectors[7], 302: [0.5], 400: []}
    odd = [(500, None), (501, [1.0, None]), (600, [nan]), (700, [inf]), (None, [1.0]), (7, vectors[7])]
    rows = spark.createDataFrame([*vectors.items(), *odd], "vec_id bigint, embedding array<float>")
    whole = whole_vectors(rows.withColumn("rank", F.lit(1)))
    got = top_k(whole.where("vec_id % 100 = 0"), whole, k=10).collect()
    exact = {r.vec_id: [int((x * 1024) // 1) for x in r.embedding] for r in rows.collect() if r.vec_id in vectors}
    expected = []
    for q in (i for i in vectors if i % 100 == 0):
        # the row that repeats id 7 is a candidate of its own
        scores = [(-sum(a * b for a, b in zip(exact[q], exact[c])), c) for c in [*vectors, 7] if c != q]
        expected += [(q, n, c, -s) for n, (s, c) in enumerate(sorted(scores)[:10], 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == sorted(expected)
    none = whole.where("false")
    assert top_k(none, none).count() == 0
    few = whole.where("vec_id IN (0, 1)")
    assert [r.vec_id for r in top_k(few.where("vec_id = 0"), few).collect()] == [1]
