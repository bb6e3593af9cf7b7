import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from kinrate.llm.periodic_runs import find_runs, periodic_runs, word_numbers
from kinrate.llm.queries import op13_periodic_runs

FOLDER = "/root/testdata/sf0.001"


def plain_runs(words, least=6, times=4):
    """Every stretch of a period that nothing extends, from the words alone."""
    n, found = len(words), {}
    for q in range(1, n // times + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if length >= max(least, times * q) and (i, length) not in found:
                found[i, length] = q
            i = j + 1
    # a stretch has the period of any shorter one that covers it
    runs = [(s, l, q) for (s, l), q in found.items()]
    return sorted(
        (r for r in runs if not any(o != r and o[2] < r[2] and r[2] % o[2] == 0 and o[0] <= r[0] and o[0] + o[1] >= r[0] + r[1] for o in runs)),
        key=lambda r: (r[0], r[2]),
    )


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def spark_runs(words, least=6, times=4):
    array = np.array(words, dtype=np.int64)
    return [tuple(r) for r in find_runs(array, np.array([0, len(words)]), least, times).tolist()]


def brute_row(doc, text):
    words = split(text)
    n = len(words)
    h = zlib.crc32(str(doc).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    gone = {i for s, l, q in runs for i in range(s + q, s + l)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
    return (
        doc,
        len(runs),
        *best,
        1000 * best[1] // best[2] if runs else None,
        hashlib.sha256("".join(f"{s},{l},{q}\n" for s, l, q in runs).encode()).hexdigest(),
        hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest(),
    )


def test_query_over_the_given_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    rows = sorted(tuple(r) for r in op13_periodic_runs(spark, FOLDER).collect())
    assert rows == sorted(brute_row(d.doc_id, d.text) for d in docs)
    assert sum(r[1] > 0 for r in rows) > 10


def test_query_over_odd_texts(spark, tmp_path):
    texts = [None, "", " \n ", "one", "a a a a a a", " a b\ta b a b a b a c\x0b", "x " * 500, "ab abab ab ab ab ab ab"]
    texts += ["é è " * 9 + "end", "a b a b a b a b a b a b", "w " * 2000 + "v"]
    docs = [(i, texts[i % len(texts)], "x") for i in range(-40, 120)]
    made = spark.createDataFrame(docs, "doc_id bigint, text string, runs string")
    made.write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect())
    assert rows == sorted(brute_row(i, t) for i, t, _ in docs)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_small_alphabets(words):
    assert spark_runs(words) == plain_runs(words)


@pytest.mark.parametrize("seed", range(40))
def test_planted_runs(seed):
    random_ = random.Random(seed)
    words = []
    for _ in range(random_.randrange(1, 6)):
        words += [random_.randrange(3) for _ in range(random_.randrange(20))]
        period = [random_.randrange(2) for _ in range(random_.randrange(1, 30))]
        words += (period * 9)[: random_.randrange(1, 9 * len(period))]
    assert spark_runs(words) == plain_runs(words)


def test_texts_of_a_batch_do_not_mix(spark):
    texts = ["a a a", "a a a", "a b a b", "a b a b", None, "", "a a a a a a a", "b b b b b b"]
    first, words, _ = word_numbers(pa.array(texts))
    assert np.diff(first).tolist() == [3, 3, 4, 4, 0, 0, 7, 6]
    assert [tuple(r) for r in find_runs(words, first, 6, 4).tolist()] == [(14, 7, 1), (21, 6, 1)]
    # a text that begins with a letter after one that ends with a letter
    assert word_numbers(pa.array(["ab", "cd", " x"]))[2].to_pylist() == [b"ab", b"cd", b"x"]


def test_operator_keeps_runs_and_text(docs_of):
    rows = periodic_runs(docs_of([(1, "say  ha ha ha ha ha ha\nho"), (None, None), (2, "")])).collect()
    by_id = {r.doc_id: r for r in rows}
    assert [tuple(r) for r in by_id[1].runs] == [(1, 6, 1)]
    assert by_id[1].collapsed_text == "say ha ho" and by_id[1].n_words == 8
    assert by_id[None].runs == [] and by_id[2].collapsed_text == ""
    assert periodic_runs(docs_of([])).count() == 0
    with pytest.raises(ValueError):
        periodic_runs(docs_of([]), times=3)


def test_long_periods_in_a_long_text():
    random_ = random.Random(3)
    period = [random_.randrange(1000) for _ in range(2500)]
    words = [5000] + period * 5 + period[:7] + [6000] * 3
    assert spark_runs(words) == [(1, 12507, 2500)]
