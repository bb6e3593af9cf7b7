import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from kinrate.llm import line_dedup
from kinrate.llm.line_dedup import keep_bitmaps, line_parts, remove_lines

BLANKS = " \t\n\x0b\x0c\r"
A_TO_Z = {c: c + 32 for c in range(65, 91)}


def key_of(line):
    return line.strip(BLANKS).translate(A_TO_Z)


def brute_force(pairs, least=10):
    holders = {}
    for doc, text in pairs:
        if doc is not None:
            for line in (text or "").split("\n"):
                holders.setdefault(key_of(line), set()).add(doc)
    rows = []
    for doc, text in pairs:
        lines = (text or "").split("\n")
        kept = [
            line
            for line in lines
            if doc is None or len(key_of(line)) < least or min(holders[key_of(line)]) == doc
        ]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        rows.append((doc, len(lines), len(lines) - len(kept), digest))
    return sorted(map(repr, rows))


def spark_rows(docs, least=10):
    rows = remove_lines(docs, least).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    return sorted(repr(tuple(r)) for r in rows)


def test_planted_lines(docs_of):
    long = "\n".join(f"line number {i} of a long text" for i in range(300))
    pairs = [
        (5, "A common line here\nonly in five\n\nA common line here"),
        (7, "\t a COMMON line here \r\nshort\nanother line\na common line here"),
        (2, "short\nanother line\x0b"),
        (9, long),
        (10, "first\n" + long + "\nlast"),
        (10, "another row of ten\nline number 7 of a long text"),
        (11, "ÄÖÜäöüßßßß\näöüäöüßßßß\n"),
        (12, "ÄÖÜäöüßßßß\n éééééééé  \n"),
        (13, "éééééééé\néééééééééé"),
        (14, "éééééééééé"),
        (None, "A common line here"),
        (None, None),
        (15, None),
        (16, ""),
        (17, "\n\n"),
        (-1, "line number 0 of a long text"),
    ]
    assert spark_rows(docs_of(pairs)) == brute_force(pairs)


def test_one_line_in_a_third_of_all_rows(spark, docs_of):
    # more rows of one digest than a task holds, and repeated rows besides
    pairs = [(i, f"the line that so many have\nown line number {i}") for i in range(400)]
    pairs += [(3, pairs[3][1])] * 200 + [(i, f"text of {i} alone") for i in range(400, 800)]
    random.Random(1).shuffle(pairs)
    conf = spark.conf
    conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    conf.set("spark.sql.shuffle.partitions", "16")
    try:
        assert spark_rows(docs_of(pairs).repartition(7)) == brute_force(pairs)
    finally:
        conf.set("spark.sql.shuffle.partitions", "3")
        conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 6), st.lists(st.sampled_from(["aaaa", " AAAA", "bbbb", "c", ""]), max_size=6)), max_size=9))
def test_small_alphabets(docs_of, texts):
    pairs = [(doc, "\n".join(lines)) for doc, lines in texts]
    assert spark_rows(docs_of(pairs), 3) == brute_force(pairs, 3)


@pytest.mark.parametrize("cut", [1, 2, 3, 50])
def test_streams_cut_anywhere(cut):
    """All ways of dealing sorted rows to tasks and batches give the same drops."""
    random_ = random.Random(cut)
    rows = sorted((random_.randrange(4), 0, random_.randrange(5), 0, random_.randrange(3)) for _ in range(60))
    first = {}
    for high, _, doc, _, _ in rows:
        first[high] = min(first.get(high, doc), doc)
    expected = {(doc, line, high) for high, _, doc, _, line in rows if doc > first[high]}

    def batch(part):
        kinds = [pa.int64()] * 4 + [pa.int32()]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*part), kinds)], names=line_dedup.LINE)

    out = []
    for at in range(0, len(rows), 17):  # tasks, and batches in them
        task = rows[at : at + 17]
        parts = [batch(task[b : b + cut]) for b in range(0, len(task), cut)]
        for made in line_dedup._stream_rows(iter(parts)):
            out += made.to_pylist()
    firsts = {}
    for r in out:
        if r["kind"] != line_dedup.DROPPED:
            firsts[r["high"]] = min(firsts.get(r["high"], r["doc_id"]), r["doc_id"])
    dropped = {
        (r["doc_id"], r["line"], r["high"])
        for r in out
        if r["kind"] == line_dedup.DROPPED or (r["kind"] == line_dedup.OPEN and r["doc_id"] > firsts[r["high"]])
    }
    assert dropped == expected


def test_bitmaps_and_kept_texts(docs_of):
    pairs = {1: "a line of some length\nother", 2: "x\nA line of some length \ny\nz", 3: None}
    (bitmap,) = keep_bitmaps(docs_of(pairs)).collect()
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap.keep), dtype=np.uint8), bitorder="little")
    assert (bitmap.doc_id, bitmap.n_dropped, bits.tolist()) == (2, 1, [1, 0] + [1] * 6)
    rows = remove_lines(docs_of(pairs)).collect()
    assert {r.doc_id: r.kept_text for r in rows} == {1: pairs[1], 2: "x\ny\nz", 3: None}
    assert {r.other.words for r in rows} == {"x"}


def test_empty_table(docs_of):
    assert remove_lines(docs_of([])).count() == 0


def test_lines_of_long_texts_some_at_a_time():
    text = b"\n".join(b"x" * (i % 50) for i in range(500)) + b"\n"
    for size in (1, 10, 1000, 1 << 20):
        assert [line for part in line_parts(text, size) for line in part] == text.split(b"\n")
