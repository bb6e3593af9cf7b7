"""Encoders, packing and token files against the libraries and brute force."""

import base64
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from kinrate.llm.byte_bpe import decode_documents, encode_documents, load_ranks
from kinrate.llm.encoding import LOWERED, SPACED, Pieces
from kinrate.llm.packing import pack_documents, plan_rounds
from kinrate.llm.token_files import read_token_files, token_offsets, write_token_files

LETTERS = ["a", "b", "the", " ", " ", "\n", "\t", "é", "ß", "Ö", ".", ",", "'s", "1", " ", "\u0085", " ",
           "́", "Σ", "語", "İ", "\x1c", "<|endoftext|>"]
RANDOM = random.Random(3)
TEXTS = ["", " ", "a", " a ", "a  b", "x\n", "\nx y z", "a\nb c\n d", "w" * 500 + " v", None] + [
    "".join(RANDOM.choice(LETTERS) for _ in range(RANDOM.randint(1, 30))) for _ in range(800)
]


def library(name):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name, words", [("byte_bpe_50k.json", SPACED), ("word_bpe_49k.json", LOWERED)])
def test_pieces_give_the_ids_of_the_library(name, words):
    pieces = Pieces(public_tokenizers.path(name), words)
    flat, first = pieces.encode(pa.array(TEXTS))
    expected = library(name)
    assert [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [expected(t) for t in TEXTS]
    assert pieces.encode(pa.array([], pa.string()))[1].tolist() == [0]


def test_byte_bpe_equals_the_library_and_decodes(spark, docs_of):
    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    expected = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    texts = [*TEXTS, "a" * 700, "abab" * 200 + "b", "".join(RANDOM.choice("abcdef") for _ in range(2000))]
    docs = docs_of(list(enumerate(texts)))
    rows = decode_documents(encode_documents(docs, path, pattern), path, pattern).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r.doc_id] or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == expected.encode_ordinary(text)
        assert bytes(r.bytes) == text.encode()
    assert encode_documents(docs_of([]), path, pattern).count() == 0


def test_long_words_merge_alike_one_by_one_or_together():
    bpe = load_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    word = "".join(RANDOM.choice("abct") for _ in range(300)).encode()
    done = [b""]
    bpe._merge_matrix([word], np.array([0]), 320, done)
    assert bpe._merge_long(word) == done[0]


def best_fit_decreasing(counts, capacity):
    gaps, opened = [0] * (capacity + 1), 0
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            gap = next((g for g in range(length, capacity + 1) if gaps[g]), None)
            if gap is None:
                opened, gap = opened + 1, capacity
            else:
                gaps[gap] -= 1
            gaps[gap - length] += 1
    return opened


@pytest.mark.parametrize("seed", range(4))
def test_rounds_place_every_rank_once_without_gaps(seed):
    random_ = random.Random(seed)
    counts = {n: random_.randint(0, 30) for n in random_.sample(range(1, 65), 40)} | {1: 500}
    sequences, ranks = {}, {n: [] for n in counts}
    for place in plan_rounds(counts, 64):
        for i in range(place.count):
            spot = (place.offset + i % place.each * place.length, place.length)
            sequences.setdefault(place.sequence + i // place.each, []).append(spot)
            ranks[place.length].append(place.rank + i)
    assert all(sorted(ranks[n]) == list(range(c)) for n, c in counts.items())
    for spots in sequences.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 64
    assert len(sequences) <= best_fit_decreasing(counts, 64)


def test_packed_documents(docs_of):
    texts = [*TEXTS[:60], "the cat " * 60, "the cat " * 60]
    rows = pack_documents(docs_of(list(enumerate(texts))), public_tokenizers.path("byte_bpe_50k.json"), capacity=32).collect()
    expected, places = library("byte_bpe_50k.json"), {}
    for i, text in enumerate(texts):
        ids = [*expected(text), 2]
        own = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(-(-len(ids) // 32)))
        assert [r.length for r in own][1:] == [32] * (len(own) - 1)
        at = 0
        for r in own:
            assert r.start == at and r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4"))
            at += r.length
        assert at == len(ids)
    for r in rows:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spots in places.values():
        at = 0
        for offset, length in sorted(spots):
            assert offset == at
            at += length
        assert at <= 32
    assert pack_documents(docs_of([]), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_token_files(spark, docs_of, tmp_path):
    path, expected = public_tokenizers.path("word_bpe_49k.json"), library("word_bpe_49k.json")
    pairs = [(3 * i, t) for i, t in enumerate(TEXTS[:80])] + [(6, TEXTS[2]), (None, "a b")]
    random.Random(1).shuffle(pairs)
    folder = str(tmp_path / "files")
    write_token_files(docs_of(pairs), folder, path)
    stored = read_token_files(spark, folder).collect()
    ids = sorted(((d is not None, d or 0), [*expected(t), 1]) for d, t in pairs)
    assert sorted(((r.doc_id is not None, r.doc_id or 0), r.ids) for r in stored) == ids
    at = 0
    for row, (_, own) in zip(sorted(token_offsets(spark, folder).collect(), key=lambda r: r.start), ids):
        assert row.start == at and row.n_tokens == len(own)
        at += len(own)
    some = read_token_files(spark, folder, [9, 10]).collect()
    assert [r.doc_id for r in some] == [9]
    assert "PushedFilters: [In(doc_id" in read_token_files(spark, folder, [9, 10])._jdf.queryExecution().toString()
    write_token_files(docs_of([]), str(tmp_path / "none"), path)
    assert token_offsets(spark, str(tmp_path / "none")).count() == 0


@pytest.mark.parametrize("name, words", [("byte_bpe_50k.json", SPACED), ("word_bpe_49k.json", LOWERED)])
def test_a_small_cache_changes_nothing(name, words):
    made = random.Random(5)
    letters = "abcdeéÉßK'.,;!? \n1"
    texts = ["".join(made.choice(letters) for _ in range(200)) for _ in range(60)] + ["the cat, the dog; the End.", "x" * 100 + "."]
    expected = library(name)
    for most in (4, 60, 100_000):
        pieces = Pieces(public_tokenizers.path(name), words, most)
        for _ in range(2):
            flat, first = pieces.encode(pa.array(texts))
            assert [flat[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [expected(t) for t in texts]
        assert len(pieces.kept) + len(pieces.older) <= most + 2 * len({w for t in texts for w in t}) + 5000


def test_spans_with_one_hash_are_told_apart(monkeypatch):
    """Equal spans are found by hash and then compared by their bytes."""
    from kinrate.llm import encoding

    data = np.frombuffer(b"abcabdabcxyzabd", dtype=np.uint8)
    start, end = np.array([0, 3, 6, 9, 12]), np.array([3, 6, 9, 12, 15])
    sample, which = encoding.equal_spans(data, start, end)
    assert len(sample) == 3 and which[0] == which[2] and which[1] == which[4]
    monkeypatch.setattr(encoding.Spans, "hashes", lambda self, a, b: np.zeros(len(a), dtype=np.uint64))
    sample, which = encoding.equal_spans(data, start, end)
    spans = [data[a:b].tobytes() for a, b in zip(start, end)]
    assert [spans[sample[w]] for w in which] == spans and which[0] == which[2]
