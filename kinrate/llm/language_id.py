"""Language of whole texts from averaged embeddings of hashed subwords.

A subword is two to four neighbouring bytes of the text in lower case, in which all
characters other than letters are one blank. Each is hashed to a row of an embedding; a text is the
average of all its subwords, and a linear softmax over it gives the languages. Both are trained
together by stochastic gradient descent in numpy, on a bounded sample of the labelled rows:
of each language all rows up to its share of SAMPLE_ROWS (LEAST_ROWS at least), beyond that as many
drawn by hash, so that every language with a lettered text is learned however rare it is. Executors
send counts of subwords instead of texts. Part of the sample is held back to calibrate: a temperature for the
scores, and the score below which a prediction is rejected, such that about one in a
thousand of the right predictions would be.

A null text, or one without any letter, is ``und`` with score 0 and is rejected. Every other
text gets a learned language. Repeated rows get equal predictions; a null doc_id is kept. Other
columns are not looked at. An empty table gives an empty result. If nothing
is labelled, or nothing but texts without letters, all texts are ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from kinrate.llm.shipping import arrow_rows
from kinrate.llm.words import text_chunks

UNKNOWN = "und"
SAMPLE_ROWS = 4000
LEAST_ROWS = 50  # of a language, if there are so many that their shares would be less
BITS = 14
DIMENSIONS = 16
ORDERS = (2, 3, 4)
EPOCHS = 6
BATCH = 32
RATE = 0.5
REJECTED_RIGHT = 0.001  # share of right predictions that calibration gives up
SEED = 7
CHUNK_BYTES = 1 << 18  # text worked on at a time: its subwords take a hundred times as much

_LETTER = np.zeros(256, dtype=np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[65:91] = np.arange(97, 123)
_LETTER[_LETTER == 0] = 32


def subwords(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of all subwords, the text of each, and whether a text has a letter."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    size = int(offsets[-1] - offsets[0])
    if not size:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(len(texts), dtype=bool)
    raw = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]]
    data = _LETTER[raw].astype(np.uint64)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    plain = np.bincount(row[(data >= 97) & (data < 123)], minlength=len(texts)) > 0
    lettered = plain.copy()
    for i in np.flatnonzero(~plain).tolist():
        lettered[i] = any(c.isalpha() for c in texts[i].as_py())
    rows, owners = [], []
    for n in ORDERS:
        if size < n:
            continue
        key = np.full(size - n + 1, n, dtype=np.uint64)
        for i in range(n):
            key = key << np.uint64(8) | data[i : size - n + 1 + i]
        inside = (row[n - 1 :] == row[: size - n + 1]) & (data[: size - n + 1] + data[n - 1 :] != 64)
        hashed = key[inside] * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - BITS)
        rows.append(hashed.astype(np.int64))
        owners.append(row[: size - n + 1][inside])
    return np.concatenate(rows), np.concatenate(owners), lettered


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray  # for each subword row, its part of the score of each language
    bias: np.ndarray
    temperature: float = 1.0
    least_score: float = 0.0

    def scores(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Calibrated scores of each language, and whether a text has a letter."""
        rows, owners, lettered = subwords(texts)
        counts = np.maximum(np.bincount(owners, minlength=len(texts)), 1)
        sums = np.stack(
            [np.bincount(owners, column[rows], minlength=len(texts)) for column in self.table.T], axis=1
        )
        return softmax((sums / counts[:, None] + self.bias) / self.temperature), lettered


def softmax(x: np.ndarray) -> np.ndarray:
    powers = np.exp(x - x.max(axis=1, keepdims=True))
    return powers / powers.sum(axis=1, keepdims=True)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subword counts of each text with a letter, as bytes."""
    for batch in batches:
        texts = batch.column("text")
        for at, to in text_chunks(texts, CHUNK_BYTES):
            rows, owners, lettered = subwords(texts[at:to])
            found: dict[str, list] = {"lang": [], "part": [], "subwords": [], "shares": []}
            bounds = np.searchsorted(np.sort(owners, kind="stable"), np.arange(to - at + 1))
            order = np.argsort(owners, kind="stable")
            for i in np.flatnonzero(lettered).tolist():
                ids, times = np.unique(rows[order[bounds[i] : bounds[i + 1]]], return_counts=True)
                found["lang"].append(batch.column("lang")[at + i].as_py())
                found["part"].append(batch.column("part")[at + i].as_py())
                found["subwords"].append(ids.astype("<u4").tobytes())
                found["shares"].append((times / times.sum()).astype("<f4").tobytes())
            kinds = (pa.string(), pa.int64(), pa.binary(), pa.binary())
            yield pa.record_batch([pa.array(v, k) for v, k in zip(found.values(), kinds)], names=list(found))


def _gradient_descent(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, kinds: int):
    """Embedding, weights and bias; languages count alike however many texts they have."""
    random = np.random.default_rng(SEED)
    embedding = random.normal(0, 1 / DIMENSIONS, (1 << BITS, DIMENSIONS))
    weights, bias = np.zeros((DIMENSIONS, kinds)), np.zeros(kinds)
    weights += random.normal(0, 0.1, weights.shape)
    emphasis = len(labels) / (kinds * np.maximum(np.bincount(labels, minlength=kinds), 1))
    steps, step = EPOCHS * -(-len(labels) // BATCH), 0
    for _ in range(EPOCHS):
        order = random.permutation(len(labels))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            rows = np.concatenate([texts[i][0] for i in chosen])
            shares = np.concatenate([texts[i][1] for i in chosen])
            owner = np.repeat(np.arange(len(chosen)), [len(texts[i][0]) for i in chosen])
            hidden = np.zeros((len(chosen), DIMENSIONS))
            np.add.at(hidden, owner, embedding[rows] * shares[:, None])
            error = softmax(hidden @ weights + bias)
            error[np.arange(len(chosen)), labels[chosen]] -= 1
            error *= emphasis[labels[chosen], None] / len(chosen)
            rate = RATE * (1 - step / steps)
            back = error @ weights.T
            weights -= rate * 20 * hidden.T @ error
            bias -= rate * error.sum(axis=0)
            np.add.at(embedding, rows, -rate * 400 * shares[:, None] * back[owner])
            step += 1
    return embedding, weights, bias


def _calibrate(model: Model, logits: np.ndarray, labels: np.ndarray) -> None:
    """The temperature of least loss, and the least score to accept."""
    if not len(labels):
        return

    def loss(t: float) -> float:
        return -np.log(softmax(logits / t)[np.arange(len(labels)), labels] + 1e-12).mean()

    model.temperature = float(min(np.geomspace(0.05, 20, 61), key=loss))
    scores = softmax(logits / model.temperature)
    right = scores.argmax(axis=1) == labels
    if right.any():
        model.least_score = float(min(np.quantile(scores.max(axis=1)[right], REJECTED_RIGHT), 0.5))


def train(labelled: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from rows with text and lang; ``key`` chooses the sample and its parts."""
    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").where(F.regexp_like("text", F.lit(r"\p{L}")))
    cells = 1 << 30
    place = F.pmod(F.xxhash64("key", "text", F.lit("sample")), F.lit(cells))
    rows = rows.withColumn("place", place)
    found = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("there"), F.min("place").alias("first")).collect()
    if not found:
        return None
    share = max(LEAST_ROWS, -(-sample_rows // len(found)))
    # twice the share, of which the first ones count; a language's first row is always among them
    drawn = [(r.lang, max(r.first + 1, int(cells * min(1.0, 2 * share / r.there)))) for r in found]
    below = labelled.sparkSession.createDataFrame(drawn, "lang string, below bigint")
    first = Window.partitionBy("lang").orderBy("place", "key", F.xxhash64("text"))
    sample = (
        rows.join(F.broadcast(below), "lang")  # a row for each language
        .where("place < below")
        .withColumn("n", F.row_number().over(first))
        .where(F.col("n") <= share)
    )
    part = F.pmod(F.xxhash64("key", F.lit("part")), F.lit(5)).alias("part")
    counted = arrow_rows(
        sample.select("lang", part, "text"),
        _count_rows,
        "lang string, part bigint, subwords binary, shares binary",
    ).toArrow()
    if not counted.num_rows:
        return None
    # in an order that does not depend on how the rows came in
    found = sorted(zip(*(counted.column(c).to_pylist() for c in ("part", "lang", "subwords", "shares"))))
    del counted
    languages = sorted({row[1] for row in found})
    labels = np.array([languages.index(row[1]) for row in found])
    texts = [(np.frombuffer(s, dtype="<u4"), np.frombuffer(c, dtype="<f4")) for _, _, s, c in found]
    held = np.array([row[0] == 0 for row in found])
    # a language of which all rows would be held back is learned from them
    held &= np.bincount(labels[~held], minlength=len(languages))[labels] > 0
    learn = np.flatnonzero(~held)
    embedding, weights, bias = _gradient_descent([texts[i] for i in learn], labels[learn], len(languages))
    model = Model(languages, embedding @ weights, bias)
    check = np.flatnonzero(held) if held.any() else learn
    logits = np.array([(model.table[texts[i][0]] * texts[i][1][:, None]).sum(axis=0) for i in check])
    _calibrate(model, logits + bias, labels[check])
    return model


def _predict_rows(model: Model | None, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            names, scores, rejected = [], [], []
            for at, to in text_chunks(texts, CHUNK_BYTES):
                if model is None:
                    found, lettered = np.zeros((to - at, 1)), np.zeros(to - at, dtype=bool)
                else:
                    found, lettered = model.scores(texts[at:to])
                best = found.argmax(axis=1)
                top = np.where(lettered, found[np.arange(to - at), best], 0.0)
                names += [model.languages[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), lettered)]
                scores.append(np.clip(top, 0.0, 1.0))
                rejected.append(~lettered | (top < (model.least_score if model else 1.0)))
            yield pa.record_batch(
                [
                    *(batch.column(name) for name in schema.names[:-3]),
                    pa.array(names, pa.string()),
                    pa.array(np.concatenate(scores) if scores else [], pa.float64()),
                    pa.array(np.concatenate(rejected) if rejected else [], pa.bool_()),
                ],
                names=schema.names,
            )

    return run


def predict(rows: DataFrame, model: Model | None) -> DataFrame:
    """``rows`` with lang_pred, score and rejected, from the column text alone.

    Columns of those names that the input has are replaced.
    """
    rows = rows.drop("lang_pred", "score", "rejected")
    result = rows.select(
        "*",
        F.lit("").alias("lang_pred"),
        F.lit(0.0).alias("score"),
        F.lit(False).alias("rejected"),
    ).schema
    names = pa.schema([(name, pa.null()) for name in result.names])
    return arrow_rows(rows, _predict_rows(model, names), result)


def fold(doc_id: Column) -> Column:
    """The remainder, from 0 to 3, by which documents are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))
