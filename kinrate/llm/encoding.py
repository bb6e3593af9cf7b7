"""Token ids of whole texts with the tokenizers library, a piece encoded once per worker.

Texts are cut before a space, and before and after a line feed, that stands between two
other characters, and before a mark after a letter. The patterns of byte-level and of word tokenizers
always start a match there, so the ids of the pieces are the ids of the text. Equal pieces of many texts are
found in numpy, by 64-bit hashes that are verified byte by byte, and those that a worker has
not met of late are encoded: a plain word by the library's merge model, anything else by its
whole pipeline, many in one call. The ids are always the library's.
"""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from kinrate.llm.words import Spans, text_chunks

# Pieces kept by a worker before it starts afresh, and the longest one that it keeps.
KEPT_PIECES = 800_000
LONGEST_KEPT = 64
AT_ONCE = 4096  # pieces given to the library in one call
CHUNK_BYTES = 1 << 20  # text worked on at a time: numpy takes fifty times as much

# How a tokenizer sees a word after a space: with the space, or in lower case without it.
SPACED, LOWERED = "spaced", "lowered"
# Below this, letters are in composed form and have one lower-case letter each.
PLAIN_BELOW = "İ"

# Marks before which a text is cut, if an ASCII letter stands before them.
_MARK = np.zeros(256, dtype=bool)
_MARK[list(b".,;:!?")] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True

# Bytes next to which a space is no cut: white space, or the beginning of a character that may be
# white space (after the space); before it, the last byte of any but a Latin-1 character.
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[*range(9, 14), *range(28, 33)]] = True
_UNSAFE_AFTER = _BLANK.copy()
_UNSAFE_AFTER[[0xC2, 0xE1, 0xE2, 0xE3]] = True
LATIN_LETTERS = 0xC3  # first byte of the characters from U+00C0 to U+00FF


def byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: a byte that prints is
    itself, the others follow from 256 on, in order."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + i) for i, b in enumerate(others)}


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces begin: at the texts' beginnings, at safe spaces, about safe line feeds and at marks."""
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[1:-1] = _MARK[data[1:]] & _LETTER[data[:-1]]
    space = np.flatnonzero((data == 32) | (data == 10))
    space = space[(space > 0) & (space < len(data) - 1)]
    before, after = data[space - 1], data[space + 1]
    latin = (before < 128) | (data[np.maximum(space - 2, 0)] == LATIN_LETTERS)
    space = space[~_BLANK[before] & latin & ~_UNSAFE_AFTER[after]]
    begins[space] = True
    begins[space[data[space] == 10] + 1] = True
    # white space that ends a text has no neighbour on that side
    ends = offsets[1:] - 1
    begins[ends[ends >= 0]] = False
    begins[offsets] = True
    begins[len(data)] = False
    return np.flatnonzero(begins)


def equal_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One of each of the distinct spans, and which of them every span equals."""
    hashes = Spans(data.astype(np.uint64) + np.uint64(1)).hashes(start, end)
    _, sample, which = np.unique(hashes, return_index=True, return_inverse=True)
    length = end - start
    same = length == length[sample][which]
    # the bytes of all spans of the right length against those of their sample
    inside = np.repeat(same, length)
    shift = np.repeat(start[sample][which] - start, length)
    place = np.flatnonzero(inside)
    differ = place[data[place] != data[place + shift[place]]]
    same[np.searchsorted(end, differ, "right")] = False
    # spans that share a hash only stand for themselves
    other = np.flatnonzero(~same)
    which[other] = len(sample) + np.arange(len(other))
    return np.r_[sample, other], which


class Pieces:
    """Ids of texts, with the pieces met of late: half of them or more of the last ``most``."""

    def __init__(self, path: str, words: str, most: int = KEPT_PIECES):
        if words not in (SPACED, LOWERED):
            raise ValueError(f"words must be {SPACED!r} or {LOWERED!r}")
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.model = self.tokenizer.model
        self.lowered = words == LOWERED
        self.letters = byte_letters()
        self.space = "" if self.lowered else self.letters[32]
        size = self.tokenizer.get_vocab_size()
        self.as_bytes = [i.to_bytes(4, "little") for i in range(size)]
        self.kept: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.most = most

    def _word(self, literal: bytes) -> bytes | None:
        """The ids of a plain word, perhaps with a space before it; None for anything else."""
        space, bare = (self.space, literal[1:]) if literal[0] == 32 else ("", literal)
        word = bare.decode()
        plain = bare.isalpha()  # ASCII letters only
        if not plain and (not word.isalpha() or max(word) >= PLAIN_BELOW):
            return None
        if self.lowered:
            word = word.lower()
        if not plain:
            word = word.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.as_bytes[token.id] for token in self.model.tokenize(space + word)])

    def _encoded(self, literals: list[bytes]) -> list[bytes]:
        """The ids of each literal, as if encoded alone."""
        texts = [literal.decode() for literal in literals]
        encoded = self.tokenizer.encode(texts, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoded.ids, dtype="<u4").tobytes()
        owners = np.array(encoded.word_ids, dtype=np.int64)
        ends = (4 * np.cumsum(np.bincount(owners, minlength=len(literals)))).tolist()
        return [ids[a:b] for a, b in zip([0, *ends], ends)]

    def _ids(self, literals: list[bytes]) -> list[bytes]:
        if 2 * len(self.kept) > self.most:
            self.older, self.kept = self.kept, {}
        kept, older = self.kept, self.older
        found = []
        unmet = []
        for i, literal in enumerate(literals):
            ids = kept.get(literal)
            if ids is None:
                ids = older.get(literal)
                if ids is None:
                    ids = self._word(literal)
                if ids is None:
                    unmet.append(i)
                elif len(literal) <= LONGEST_KEPT:
                    kept[literal] = ids
            found.append(ids)
        for at in range(0, len(unmet), AT_ONCE):
            some = unmet[at : at + AT_ONCE]
            for i, ids in zip(some, self._encoded([literals[i] for i in some])):
                found[i] = ids
                if len(literals[i]) <= LONGEST_KEPT:
                    kept[literals[i]] = ids
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts after each other, and where each text's begin; a null
        text counts as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        if offsets[-1] == offsets[0]:
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts) + 1, dtype=np.int64)
        data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        if self.lowered:  # one piece for both cases, as the tokenizer sees them
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        start = cuts(data, offsets)
        end = np.r_[start[1:], len(data)]
        sample, which = equal_spans(data, start, end)
        raw = data.tobytes()
        ids = self._ids([raw[a:b] for a, b in zip(start[sample].tolist(), end[sample].tolist())])
        sizes = np.array([len(i) // 4 for i in ids], dtype=np.int64)
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        each = sizes[which]
        ends = np.cumsum(each)
        at = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - each), each) + np.arange(ends[-1])
        first = np.r_[0, ends][np.searchsorted(start, offsets)]
        return flat[at], first


@cache
def pieces_of(path: str, words: str, most: int = KEPT_PIECES) -> Pieces:
    """One for each worker and tokenizer file, with the pieces it has met."""
    return Pieces(path, words, most)


def give_back() -> None:
    """Hand freed memory back to the system, where the C library can: a worker lives on."""
    if os.name == "posix" and hasattr(ctypes.CDLL(None), "malloc_trim"):
        ctypes.CDLL(None).malloc_trim(0)


def encoded_chunks(
    batch: pa.RecordBatch, pieces: Pieces
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of a batch with the ids of their texts and where each text's begin."""
    texts = batch.column("text")
    for at, to in text_chunks(texts, CHUNK_BYTES):
        yield (batch.slice(at, to - at), *pieces.encode(texts[at:to]))


def small_batches(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that Python holds few texts at a time."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)
