"""Byte-level BPE encoding and decoding with numpy matrices.

Texts are cut by the tokenizer's pattern. Distinct words that a worker has not met are
put into matrices by length, one row of byte ids each, padded. In each round every row
merges its leftmost pair of least rank: ranks of pairs come from a hash table over both
ids, rows without a pair are done and leave the matrix, and the others close the gap, so
that the matrix loses a column. Words longer than the widest matrix are rows of their own.
If every merged token ranks after both its parts, which is checked when ranks are read,
all places of the least rank merge in one round there, with the same result.

A null text counts as empty and has no ids. Rows are encoded one by one, repeated ones
too; a null doc_id is kept. Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from kinrate.llm.encoding import KEPT_PIECES, LONGEST_KEPT, small_batches
from kinrate.llm.shipping import arrow_rows

NONE = np.int32(2**31 - 1)
WIDTHS = (2, 4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64)
CELLS = 1 << 20  # of one matrix
# The characters with the Unicode property White_Space.
SPACE_CLASS = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


class PairTable:
    """The rank of the merged token for two neighbouring ids, by open addressing."""

    def __init__(self, tokens: list[bytes]):
        ids = {t: i for i, t in enumerate(tokens)}
        keys, values = [], []
        for merged, token in enumerate(tokens):
            for cut in range(1, len(token)):
                left, right = ids.get(token[:cut]), ids.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(merged)
        self.ordered = all(v > max(k >> 32, k & 0xFFFFFFFF) for k, v in zip(keys, values) if v > 255)
        self.bits = max(4, (4 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, NONE, dtype=np.int32)
        left, value = np.array(keys, dtype=np.int64), np.array(values, dtype=np.int32)
        slots, self.probes = self._slots(left), 0
        while len(left):
            self.probes += 1
            free = self.keys[slots] == -1
            order = np.flatnonzero(free)
            self.keys[slots[order]] = left[order]  # of several, the last stays
            own = self.keys[slots] == left
            self.values[slots[own]] = value[own]
            left, value, slots = left[~own], value[~own], (slots[~own] + 1) & ((1 << self.bits) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE for no token or a padded place (-1)."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        keys = np.where((left < 0) | (right < 0), -2, keys)
        slots = self._slots(keys)
        found = np.full(keys.shape, NONE, dtype=np.int32)
        open_ = np.flatnonzero(keys.ravel() != -2)
        keys, slots, flat = keys.ravel(), slots.ravel(), found.ravel()
        for _ in range(self.probes):
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            flat[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (there != -1)]
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & ((1 << self.bits) - 1)
        return flat.reshape(found.shape)


class ByteBpe:
    """Encoding by ranks and decoding."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex

        self.tokens = tokens
        self.pairs = PairTable(tokens)
        singles = {t: i for i, t in enumerate(tokens) if len(t) == 1}
        if len(singles) != 256:
            raise ValueError("every byte needs a rank of its own")
        self.byte_ids = np.array([singles[bytes([b])] for b in range(256)], dtype=np.int32)
        # white space is the Unicode property, which other engines' \s does not mean exactly
        pattern = pattern.replace(r"[^\s", "[^" + SPACE_CLASS).replace(r"\S", f"[^{SPACE_CLASS}]")
        self.words = regex.compile(pattern.replace(r"\s", f"[{SPACE_CLASS}]")).findall
        self.kept: dict[str, bytes | None] = {}

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each word."""
        done: list[bytes] = [b""] * len(words)
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        lower = 0
        for width in WIDTHS:
            chosen = np.flatnonzero((sizes > lower) & (sizes <= width))
            lower = width
            step = max(1, CELLS // width)
            for at in range(0, len(chosen), step):
                self._merge_matrix(words, chosen[at : at + step], width, done)
        for i in np.flatnonzero(sizes > lower).tolist():
            done[i] = self._merge_long(words[i])
        return done

    def _merge_matrix(self, words: list[bytes], chosen: np.ndarray, width: int, done: list[bytes]):
        data = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in chosen.tolist()), dtype=np.uint8)
        ids = self.byte_ids[data].reshape(len(chosen), width)
        sizes = np.array([len(words[i]) for i in chosen.tolist()])
        ids[np.arange(width) >= sizes[:, None]] = -1
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:])
        while len(ids):
            at = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(ids), dtype=np.int64)
            best = ranks[np.arange(len(ids)), at] if ranks.shape[1] else np.full(len(ids), NONE)
            going = best != NONE
            for i, size, row in zip(
                chosen[~going].tolist(), sizes[~going].tolist(), ids[~going].astype("<i4")
            ):
                done[i] = row[:size].tobytes()
            if not going.any():
                return
            ids, ranks, at, best = ids[going], ranks[going], at[going], best[going]
            chosen, sizes = chosen[going], sizes[going] - 1
            rows, width = np.arange(len(ids)), ids.shape[1]
            ids[rows, at] = best
            keep = np.ones(ids.shape, dtype=bool)
            keep[rows, at + 1] = False
            ids = ids[keep].reshape(len(rows), width - 1)
            keep = np.ones(ranks.shape, dtype=bool)
            keep[rows, np.minimum(at + 1, width - 2)] = False
            ranks = ranks[keep].reshape(len(rows), width - 2)
            for place in (at - 1, at):
                inside = np.flatnonzero((place >= 0) & (place < width - 2))
                column = place[inside]
                ranks[inside, column] = self.pairs.ranks(ids[inside, column], ids[inside, column + 1])

    def _merge_long(self, word: bytes) -> bytes:
        ids = self.byte_ids[np.frombuffer(word, dtype=np.uint8)]
        ranks = self.pairs.ranks(ids[:-1], ids[1:])
        while len(ranks) and (least := ranks.min()) != NONE:
            places = np.flatnonzero(ranks == least)
            if self.pairs.ordered:
                # of places in a row, every other one from the left
                run = np.flatnonzero(np.r_[True, np.diff(places) > 1])
                place_in_run = np.arange(len(places)) - np.repeat(run, np.diff(np.r_[run, len(places)]))
                places = places[place_in_run % 2 == 0]
            else:
                places = places[:1]
            ids[places] = least
            keep = np.ones(len(ids), dtype=bool)
            keep[places + 1] = False
            at = places - np.arange(len(places))
            ids = ids[keep]
            keep_ranks = np.ones(len(ranks), dtype=bool)
            keep_ranks[np.minimum(places + 1, len(ranks) - 1)] = False
            ranks = ranks[keep_ranks]
            for place in (at - 1, at):
                place = place[(place >= 0) & (place < len(ranks))]
                ranks[place] = self.pairs.ranks(ids[place], ids[place + 1])
        return ids.astype("<i4").tobytes()

    def _strings(self, strings: list[str]) -> list[bytes]:
        cut = [[w.encode() for w in self.words(s)] for s in strings]
        distinct = list({w for words in cut for w in words})
        ids = dict(zip(distinct, self.merge_words(distinct)))
        return [b"".join([ids[w] for w in words]) for words in cut]

    def texts(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts. A cut at a space between two other characters is also one of
        the pattern, so pieces between such cuts are encoded once per worker."""
        if len(self.kept) > KEPT_PIECES:
            self.kept.clear()
        parts = [(text or "").split(" ") for text in texts]
        kept = self.kept
        new = [p for p in set().union(*(p[1:-1] for p in parts)) if p not in kept]
        plain = [p for p in new if p and not p[0].isspace() and not p[-1].isspace()]
        kept.update(dict.fromkeys(new))
        kept.update(zip(plain, self._strings([" " + p for p in plain])))
        rest, where = [], []
        for i, part in enumerate(parts):
            head, tail = part[0], part[-1]
            cut = len(part) > 1 and head and tail and not head[-1].isspace() and not tail[0].isspace()
            if cut and all(kept[p] is not None for p in part[1:-1]):
                where.append(True)
                rest += (head, " " + tail)
            else:
                where.append(False)
                rest.append(texts[i] or "")
        others = iter(self._strings(rest))
        result = []
        for part, cut in zip(parts, where):
            first = next(others)
            if cut:
                first += b"".join([kept[p] for p in part[1:-1]]) + next(others)
            result.append(first)
        for piece in new:
            if len(piece) > LONGEST_KEPT:
                del kept[piece]
        return result

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


@cache
def load_ranks(path: str, pattern: str) -> ByteBpe:
    """From a file of base64 tokens and their ranks, once per worker."""
    with open(path, "rb") as lines:
        pairs = sorted((int(rank), base64.b64decode(token)) for token, rank in map(bytes.split, lines))
    if [rank for rank, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must count up from 0")
    return ByteBpe([token for _, token in pairs], pattern)


def _encode_rows(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_ranks(path, pattern)
        for batch in batches:
            for small in small_batches(batch):
                ids = bpe.texts(small.column("text").to_pylist())
                yield pa.record_batch([small.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return run


def _decode_rows(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load_ranks(path, pattern)
        for batch in batches:
            for small in small_batches(batch):
                texts = [None if ids is None else bpe.decode(ids) for ids in small.column("ids").to_pylist()]
                yield pa.record_batch(
                    [small.column("doc_id"), small.column("ids"), pa.array(texts, pa.binary())],
                    names=["doc_id", "ids", "bytes"],
                )

    return run


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (little-endian unsigned 32-bit integers) of every document."""
    source = docs.select(F.col("doc_id").cast("bigint"), "text")
    return arrow_rows(source, _encode_rows(path, pattern), "doc_id bigint, ids binary")


def decode_documents(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``encoded`` with the bytes that the ids stand for."""
    source = encoded.select("doc_id", "ids")
    return arrow_rows(source, _decode_rows(path, pattern), "doc_id bigint, ids binary, bytes binary")
