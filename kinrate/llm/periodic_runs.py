"""Periodic runs of words and their removal.

A run is a stretch of words with smallest period q, of at least ``times`` periods and
``least_words`` words, that cannot be made longer on either side. Runs come from a dictionary
of basic factors: for each power of two L, every place of a text gets a name for the L words
that begin there, from the pairs of names for the halves; a place whose factor occurs once
in its text has no name, and so no longer factor there is looked at again. Places of one
name stand in order, and each has its successor. Where successors follow at one
distance d of at most 2L three times, the places form an arithmetic progression and d is
proposed as a period; neighbouring places with the same distance make one proposal. Each
proposed stretch is extended word by word as far as the period holds, and what several
lengths L propose is kept once.

No run is missed: one with period q and four times its length is proposed at the L with
q <= L < 2q, where equal factors inside it are exactly q apart. No period is proposed that is not
the smallest: a smaller one would divide it, and its successor would be nearer.

Texts are never cut; what a task holds is bounded by its longest text. A null or empty
text has no words and no runs. Every row is handled by itself, so repeated rows and ids and
null ids make no difference. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from kinrate.llm.shipping import arrow_rows
from kinrate.llm.words import SPACES, text_chunks

LEAST_WORDS, TIMES = 6, 4

_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True

SPACE = pa.scalar(b" ", pa.large_binary())
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_RUNS = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed_text string"


def word_numbers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """First word of each text (and the number of all words), each word's number in the
    dictionary, and the dictionary. Words are told apart by their bytes."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if offsets[-1] == offsets[0]:
        return np.zeros(len(texts) + 1, dtype=np.int64), np.zeros(0, dtype=np.int32), pa.array([], pa.large_binary())
    data = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    inner = ~_IS_SPACE[data]
    begins = inner.copy()
    begins[1:] &= ~inner[:-1]
    edge = offsets[offsets < len(data)]
    begins[edge] = inner[edge]  # a text begins a word whatever the text before ends with
    letters = data[inner]
    bounds = np.append(np.flatnonzero(begins[inner]), len(letters)).astype(np.int64)
    words = pa.Array.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
    ).dictionary_encode()
    first = np.searchsorted(np.flatnonzero(begins), offsets)
    return first, words.indices.to_numpy(), words.dictionary


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading elements are equal, looking at ever longer blocks."""
    done, size, most = 0, 64, min(len(a), len(b))
    while done < most:
        end = min(done + size, most)
        differ = np.flatnonzero(a[done:end] != b[done:end])
        if len(differ):
            return done + int(differ[0])
        done, size = end, 2 * size
    return done


def _extended(words: np.ndarray, at: int, end: int, period: int, low: int, high: int) -> tuple[int, int]:
    """The stretch [at, end) made as long as the period holds within one text [low, high)."""
    right = _matching(words[end:high], words[end - period : high - period])
    left = _matching(words[low : at][::-1], words[low + period : at + period][::-1])
    return at - left, end + right


def find_runs(words: np.ndarray, first: np.ndarray, least_words: int, times: int) -> np.ndarray:
    """(start, length, period) of all runs of some texts, by start and period. ``words`` are
    the words' numbers, ``first`` each text's first word and the number of all words."""
    total, longest = len(words), int(np.diff(first).max(initial=0))
    proposed = set()
    at = named = np.arange(total)
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    keys = text * (int(words.max(initial=0)) + 1) + words
    name, distance = np.full(total, -1, dtype=np.int64), np.zeros(total, dtype=np.int64)
    size = 1
    while len(at):
        order = np.argsort(keys, kind="stable")
        place, keys = at[order], keys[order]
        new = np.r_[True, keys[1:] != keys[:-1]]
        follows = np.flatnonzero(~new)
        distance[at] = 0
        distance[place[follows - 1]] = place[follows] - place[follows - 1]
        near = at[(distance[at] > 0) & (distance[at] <= 2 * size)]
        apart = distance[near]
        three = distance[near + apart] == apart
        near, apart = near[three], apart[three]
        if len(near):
            begins = np.r_[True, (np.diff(near) != 1) | (np.diff(apart) != 0)]
            lasts = np.r_[np.flatnonzero(begins)[1:] - 1, len(near) - 1]
            ends = near[lasts] + apart[lasts] + size
            proposed.update(zip(near[begins].tolist(), ends.tolist(), apart[begins].tolist()))
        if 4 * size > longest:  # a period is at most a fourth of a text, and less than twice it is enough
            break
        recurs = np.r_[~new[1:], False] | ~new
        name[named] = -1
        named = np.sort(place[recurs])
        name[place[recurs]] = np.cumsum(new)[recurs]
        at = named
        at = at[at + size < total]
        at = at[name[at + size] >= 0]
        keys = name[at] * (total + 1) + name[at + size]
        size *= 2
    found = set()
    bounds = np.searchsorted(first, [p[0] for p in proposed], "right") if proposed else ()
    for (start, end, period), k in zip(proposed, bounds):
        start, end = _extended(words, start, end, period, int(first[k - 1]), int(first[k]))
        if end - start >= max(least_words, times * period):
            found.add((start, end - start, period))
    return np.array(sorted(found, key=lambda r: (r[0], r[2])), dtype=np.int64).reshape(-1, 3)


def _run_rows(least_words: int, times: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("doc_id")
            for low, high in text_chunks(texts):
                first, words, dictionary = word_numbers(texts[low:high])
                runs = find_runs(words, first, least_words, times)
                start, length, period = runs.T
                # a word goes if some run has it after its first period
                edges = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edges, start + period, 1)
                np.add.at(edges, start + length, -1)
                stays = np.cumsum(edges[:-1]) == 0
                kept = dictionary.take(pa.array(words[stays]))
                until = np.r_[0, np.cumsum(stays)][first]
                collapsed = pc.binary_join(pa.ListArray.from_arrays(pa.array(until, pa.int32()), kept), SPACE)
                of_text = np.searchsorted(first, start, "right") - 1
                rows = pa.StructArray.from_arrays(
                    [pa.array(start - first[of_text]), pa.array(length), pa.array(period)], fields=list(_RUN)
                )
                lists = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of_text, np.arange(len(first))), pa.int32()), rows
                )
                yield pa.record_batch(
                    [ids[low:high], pa.array(np.diff(first)), lists, collapsed.cast(pa.string())],
                    names=["doc_id", "n_words", "runs", "collapsed_text"],
                )

    return run


def periodic_runs(docs: DataFrame, least_words: int = LEAST_WORDS, times: int = TIMES) -> DataFrame:
    """doc_id, n_words, runs by start and period, and collapsed_text of every row.

    collapsed_text has the words, joined by one space, without those that a run repeats:
    of each run its first period stays.
    """
    if times < 4:
        raise ValueError("runs of fewer than four periods may be missed")
    source = docs.select(F.col("doc_id").cast("bigint"), "text")
    return arrow_rows(source, _run_rows(least_words, times), _RUNS)


def best_run(runs: F.Column) -> F.Column:
    """The run with the most periods, compared exactly; of equal ones the first. Null without runs."""
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    return F.aggregate(runs, F.try_element_at(runs, F.lit(1)), lambda a, b: F.when(more(a, b), b).otherwise(a))
