"""Packed sequences hold the tokens of the corpus."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from kinrate.llm.packing import pack_documents, sequence_rows

from .test_tokens import TEXTS

END = 2
PATH = "byte_bpe_50k.json"


def check_sequences(rows, sequences, capacity):
    """Every piece stands at its place in its sequence, and nothing else does."""
    whole = {s.sequence_id: np.frombuffer(s.ids, "<u4") for s in sequences}
    assert sum(map(len, whole.values())) == sum(r.length for r in rows)
    for r in rows:
        assert whole[r.sequence_id][r.offset : r.offset + r.length].tobytes() == bytes(r.ids)
        assert r.ids_crc32 == zlib.crc32(r.ids) and len(r.ids) == 4 * r.length
    assert all(len(ids) <= capacity for ids in whole.values())


def texts_of(rows):
    """The text of each document, from its pieces."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path(PATH))
    found = {}
    for r in sorted(rows, key=lambda r: (r.doc_id, r.piece)):
        found.setdefault(r.doc_id, []).extend(np.frombuffer(r.ids, "<u4").tolist())
    assert all(ids[-1] == END for ids in found.values())
    return {doc: tokenizer.decode(ids[:-1], skip_special_tokens=False) for doc, ids in found.items()}


def test_texts_come_back_from_packed_ids(docs_of):
    texts = dict(enumerate([*TEXTS[:60], "the cat " * 60, "the cat " * 60]))
    packed = pack_documents(docs_of(texts), public_tokenizers.path(PATH), capacity=32).cache()
    rows = packed.collect()
    check_sequences(rows, sequence_rows(packed).collect(), 32)
    assert texts_of(rows) == {i: t or "" for i, t in texts.items()}


def test_the_pipeline_ends_with_the_tokens_of_the_cleaned_texts(spark, docs_of):
    docs = docs_of({i: f"number {i} of the texts " * (i * 40) for i in range(1, 8)})
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, None).cache()
    rows = packed.collect()
    check_sequences(rows, sequence_rows(packed).collect(), 1024)
    assert texts_of(rows) == {r.doc_id: r.text for r in docs.collect()}
