"""Language of documents by error-correcting output codes over n-gram classifiers.

Every language has a codeword, a row of +1 and -1; each column splits the languages in two, and
a binary classifier learns to tell the two sides apart from hashed byte n-grams (1 to 3 bytes
of the lower-case text). Up to five languages get all different splits (an exhaustive code),
more get ``CODE_BITS`` splits drawn at random, of which those with the largest least distance
between codewords are kept.

A document is decoded by loss: each language pays ``exp(-margin)`` per bit, weighed by how well
that bit's classifier did in training, and the language that pays least is chosen. Its score is
the share of the softmax over the mean losses; ``ambiguous`` says that the second best is close.

Learning uses a sample of at most ``MAX_DOCS`` documents per language; prediction reads whole
texts. Defined results: a text that is null or has no letter is ``und`` with score 0; without
any labelled document everything is ``und``; with one language it is that one, score 1 for
texts with letters; rows that repeat get equal results. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rxlens.llm.arrow import batch_of, plain_texts

BUCKETS = 1 << 13
CODE_BITS = 24
MAX_DOCS = 600
AMBIGUOUS = 0.2
_LETTER = regex.compile(r"\p{L}")
_STEP = 1 << 16
_EPOCHS = 60


def has_letter(text: str) -> bool:
    return _LETTER.search(text) is not None


def features(text: str) -> np.ndarray:
    """Square roots of the hashed n-gram shares of a whole text."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), dtype=np.uint8)
    counts = np.zeros(BUCKETS, dtype=np.int64)
    for at in range(0, len(data), _STEP):
        # Two bytes more, so that no n-gram is lost between steps.
        piece = data[at : at + _STEP + 2].astype(np.uint32)
        one = piece[:_STEP]
        two = one[: len(piece) - 1] << 8 | piece[1 : _STEP + 1]
        three = two[: len(piece) - 2] << 8 | piece[2 : _STEP + 2]
        for n, gram in ((1, one), (2, two), (3, three)):
            mixed = (gram + np.uint32(n << 24)) * np.uint32(2654435761)
            counts += np.bincount(mixed >> np.uint32(19), minlength=BUCKETS)
    total = counts.sum()
    return np.sqrt(counts / total).astype(np.float32) if total else counts.astype(np.float32)


def codewords(n: int, bits: int = CODE_BITS, seed: int = 7) -> np.ndarray:
    """One row of +1 and -1 per language; no column is constant or another's mirror."""
    if n <= 5:
        columns = [(1, *rest) for rest in product((1, -1), repeat=n - 1) if -1 in rest]
        return np.array(columns, dtype=np.float64).T
    rng = np.random.default_rng(seed)
    best, least = None, -1
    for _ in range(200):
        code = np.where(rng.random((n, bits)) < 0.5, 1.0, -1.0)
        code[:, np.abs(code.sum(axis=0)) == n] *= np.where(np.arange(n) % 2, 1, -1)[:, None]
        apart = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if apart > least:
            best, least = code, apart
    return best


@dataclass(frozen=True)
class Model:
    """Languages, their codewords, and a weight vector and a reliability per bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    trust: np.ndarray

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: the language's number, its score, and whether another is close."""
        margin = np.clip(x @ self.weights + self.bias, -6, 6)
        loss = np.exp(-margin[:, None, :] * self.code[None]) @ self.trust
        share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
        share /= share.sum(axis=1, keepdims=True)
        best = share.argmax(axis=1)
        order = np.sort(share, axis=1)
        close = order[:, -1] - order[:, -2] < AMBIGUOUS
        return best, share[np.arange(len(x)), best], close


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bits' logistic regressions at once, by gradient descent with momentum."""
    w, b = np.zeros((x.shape[1], y.shape[1])), np.zeros(y.shape[1])
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(_EPOCHS):
        p = -y / (1 + np.exp(np.clip(y * (x @ w + b), -30, 30)))
        vw = 0.9 * vw - 20 * (x.T @ p / len(x) + 1e-5 * w)
        vb = 0.9 * vb - 20 * p.mean(axis=0)
        w, b = w + vw, b + vb
    return w, b


_FEATURES = "lang string, x binary"


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
        rows = [(n, features(t).tobytes()) for n, t in zip(langs, texts) if has_letter(t)]
        yield batch_of(rows, _FEATURES)


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Model | None:
    """Fit on at most ``max_docs`` documents of each language, none of those held out."""
    ids = docs.filter("lang is not null and doc_id is not null and text is not null").filter(
        ~held_out(F.col("doc_id").cast("long"))
    )
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = (
        ids.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string"))
        .withColumn("turn", F.row_number().over(order))
        .filter(F.col("turn") <= max_docs)
        .select("doc_id", "lang")
        .dropDuplicates(["doc_id"])
    )
    # At most max_docs rows a language.
    sample = (
        plain_texts(ids)
        .join(F.broadcast(chosen), "doc_id")
        .dropDuplicates(["doc_id"])
        .mapInArrow(_sampled, _FEATURES)
        .collect()
    )
    languages = sorted({r["lang"] for r in sample})
    if not languages:
        return None
    if len(languages) == 1:
        one = np.ones((1, 1))
        return Model(languages, one, np.zeros((BUCKETS, 1)), np.zeros(1), np.ones(1))
    x = np.stack([np.frombuffer(r["x"], dtype=np.float32) for r in sample]).astype(np.float64)
    place = {n: i for i, n in enumerate(languages)}
    label = np.array([place[r["lang"]] for r in sample])
    code = codewords(len(languages))
    y = code[label]
    w, b = _logistic(x, y)
    right = ((x @ w + b > 0) == (y > 0)).mean(axis=0)
    trust = np.maximum(right - 0.5, 1e-3)
    return Model(languages, code, w.astype(np.float32), b, trust / trust.sum())


_RESULT = "doc_id long, lang_pred string, score double, ambiguous boolean"


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``ambiguous`` for every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for low in range(0, len(ids), 256):
                part = texts[low : low + 256]
                rows = [(i, "und", 0.0, True) for i in ids[low : low + 256]]
                told = [k for k, t in enumerate(part) if model is not None and has_letter(t)]
                if told and len(model.languages) == 1:
                    for k in told:
                        rows[k] = (rows[k][0], model.languages[0], 1.0, False)
                elif told:
                    best, score, close = model.decode(np.stack([features(part[k]) for k in told]))
                    for k, n, s, c in zip(told, best.tolist(), score.tolist(), close.tolist()):
                        rows[k] = (rows[k][0], model.languages[n], s, c)
                yield batch_of(rows, _RESULT)

    return plain_texts(docs).mapInArrow(run, _RESULT)


def language_report(docs: DataFrame) -> DataFrame:
    """The query's rows, with whether the row was held out of training."""
    return predict(docs, train(docs)).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "ambiguous",
    )
