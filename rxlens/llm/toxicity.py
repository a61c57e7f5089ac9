"""Toxicity of documents: a subsequence string-kernel SVM with Nyström landmarks.

**Kernel.** Two words are compared by the subsequences of ``ORDER`` symbols they share, gaps
allowed; a subsequence that spans ``n`` symbols weighs ``DECAY ** n``, and the kernel is
normalised. A character put in, left out or changed costs some of the weight, not the match.
Words carry a mark at either end; letters are told apart by 64 symbol classes.

**Units.** A text is cut into sentences and these into words (a word runs from its first to
its last letter or digit; one with marks inside is read without them as well). Three or more
single letters in a row are also read as one word. Longer units than ``LONGEST`` are read in
overlapping pieces.

**Training.** On a sample of at most ``MAX_DOCS`` labelled documents of each class and
``MAX_SENTENCES`` of their sentences of each class. Sentences inherit the label, though most
sentences of a toxic document are harmless, so the machine is trained on *bags*: a toxic
sentence that has a suspicious word counts by the most suspicious one (at first that most tied
to toxic documents, then that which the machine scores highest), a clean one by all its words.
Landmarks are
spread over the words tied to toxic documents, the clean words most like them, and the most
common clean ones. Words become vectors by
their kernel values to the landmarks (Nyström), and a linear squared-hinge SVM is fitted.

**Scoring.** The machine is a weighted sum of the landmarks' subsequences, so it is kept as one
weight per subsequence. A document's evidence is the value of its highest word and how much its
other words add above zero; a logistic curve fitted on labelled training documents makes it a
probability.

Defined results: a null or empty text, or one without words, gets the score of a text in which
nothing is suspicious; without labels of both classes all scores are the share of toxic labels
(0 without labels); an id with contradictory labels is not learned from; rows that repeat get
equal scores. Only ``doc_id`` (to leave out rows held out) and ``text`` are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxlens.llm.arrow import agreed_labels, batch_of, plain_texts, slices
from rxlens.operators.reuse import checkpoint_stage

ORDER = 3
DECAY = 0.5
LONGEST = 40
MAX_DOCS = 4000
MAX_SENTENCES = 12_000
LANDMARKS = 192
#: Rounds of choosing words and adding landmarks where the machine errs.
TURNS = 6
#: Log-likelihood ratio from which a word is held to be tied to toxic documents.
CERTAIN = 25.0
THRESHOLD = 0.7
MAX_KNOWN = 250_000
#: Rows of a batch that are held as lists of words at a time.
ROWS = 500
_SYMBOLS = 64
_WORD = re.compile(r"\w(?:\S*\w)?")
_SPELLED = re.compile(r"\b\w(?:\W{1,2}\w\b){2,}")
_SENTENCE = re.compile(r"[^.!?\n]+")
_MARKS = re.compile(r"\W+")
_FLOOR = -3.0
_MORE = 3.0


def units(text: str) -> set[str]:
    """The distinct words of a text, as they are scored."""
    text = text.lower()
    found = set(_WORD.findall(text))
    found.update([_MARKS.sub("", w) for w in found if not w.isalnum()])
    for match in _SPELLED.finditer(text):
        found.add(_MARKS.sub("", match[0]))
    long = [w for w in found if len(w) > LONGEST]
    for word in long:
        found.remove(word)
        for at in range(0, len(word) - LONGEST // 2, LONGEST // 2):
            found.add(word[at : at + LONGEST])
    return found


def _symbol(char: str) -> int:
    """A to z, then digits and other characters by class; 62 and 63 mark the ends."""
    code = ord(char)
    if 97 <= code <= 122:
        return code - 97
    return 26 + code * 7 % 36


def _coded(words: list[str]) -> np.ndarray:
    """Words of one length as rows of symbols, with end marks."""
    rows = [[62, *map(_symbol, w), 63] for w in words]
    return np.array(rows, dtype=np.int32)


_TRIPLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _triples(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Index triples of a word of ``length`` symbols, and the weight of each."""
    if length not in _TRIPLES:
        at = np.array(list(combinations(range(length), ORDER)), dtype=np.int64).reshape(-1, ORDER)
        weight = DECAY ** (at[:, -1] - at[:, 0] + 1)
        _TRIPLES[length] = (at, weight.astype(np.float32))
    return _TRIPLES[length]


def _subsequences(coded: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The subsequences of each row as numbers, and their weights (the same for all rows)."""
    at, weight = _triples(coded.shape[1])
    code = (coded[:, at[:, 0]] * _SYMBOLS + coded[:, at[:, 1]]) * _SYMBOLS + coded[:, at[:, 2]]
    return code, weight


def _norms(coded: np.ndarray) -> np.ndarray:
    """Square root of each row's kernel with itself, by the usual recursion over its symbols."""
    rows, length = coded.shape
    gap = np.subtract.outer(np.arange(length), np.arange(length)).T
    spread = np.where(gap >= 0, DECAY ** np.maximum(gap, 0), 0.0)
    one = np.zeros((rows, length + 1))
    two = np.zeros((rows, length + 1))
    total = np.zeros(rows)
    for i in range(length):
        same = (coded == coded[:, i : i + 1]) * DECAY**2
        total += (same * two[:, :-1]).sum(axis=1)
        two[:, 1:] = DECAY * two[:, 1:] + (same * one[:, :-1]) @ spread
        one[:, 1:] = DECAY * one[:, 1:] + same @ spread
    return np.sqrt(total)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of words of one length and their symbols, in bounded pieces."""
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for length in np.unique(lengths).tolist():
        places = np.flatnonzero(lengths == length)
        step = max(1, 400_000 // max(1, math.comb(length + 2, ORDER)))
        for at in range(0, len(places), step):
            part = places[at : at + step]
            yield part, _coded([words[i] for i in part.tolist()])


def weigh(words: list[str], table: np.ndarray) -> np.ndarray:
    """Sum of ``table`` over each word's weighted subsequences, normalised."""
    out = np.zeros(len(words))
    for places, coded in _by_length(words):
        code, weight = _subsequences(coded)
        out[places] = (table[code] @ weight) / _norms(coded)
    return out


def kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """Normalised kernel values, one row per word."""
    column = np.zeros(_SYMBOLS**ORDER, dtype=np.int32)
    coded = [_coded([m]) for m in landmarks]
    codes = np.unique(np.concatenate([_subsequences(c)[0].ravel() for c in coded]))
    column[codes] = np.arange(1, len(codes) + 1)
    features = np.zeros((len(codes) + 1, len(landmarks)), dtype=np.float32)
    for j, c in enumerate(coded):
        code, weight = _subsequences(c)
        np.add.at(features[:, j], column[code[0]], weight / _norms(c)[0])
    out = np.zeros((len(words), len(landmarks)), dtype=np.float32)
    for places, coded_words in _by_length(words):
        norms = _norms(coded_words)
        step = max(1, 1_000_000 // (len(landmarks) * math.comb(coded_words.shape[1], ORDER)))
        for at in range(0, len(places), step):
            code, weight = _subsequences(coded_words[at : at + step])
            found = np.einsum("wtm,t->wm", features[column[code]], weight)
            out[places[at : at + step]] = found / norms[at : at + step, None]
    return out


def _table(landmarks: list[str], weights: np.ndarray) -> np.ndarray:
    """The weighted sum of normalised landmarks, as a weight per subsequence."""
    table = np.zeros(_SYMBOLS**ORDER, dtype=np.float32)
    for word, w in zip(landmarks, weights):
        coded = _coded([word])
        code, weight = _subsequences(coded)
        np.add.at(table, code[0], w * weight / _norms(coded)[0])
    return table


@dataclass(frozen=True)
class Model:
    """A weight per subsequence, a bias, and the curve from evidence to probabilities."""

    table: np.ndarray | None
    bias: float
    curve: tuple[float, float, float]

    def values(self, words: list[str]) -> np.ndarray:
        return weigh(words, self.table) + self.bias


def evidence(values: list[float]) -> tuple[float, float]:
    """The highest value and what the others add above zero, both within bounds."""
    if not values:
        return _FLOOR, 0.0
    high = [min(v, 1.0) for v in values if v > 0]
    if not high:
        return max(max(values), _FLOOR), 0.0
    top = max(high)
    return top, min(sum(high) - top, _MORE)


def _fit_svm(blocks: list[tuple[np.ndarray, float, np.ndarray]]) -> np.ndarray:
    """Squared-hinge linear SVM by Newton steps; returns weights with the bias last.

    ``blocks`` are rows, their label of +1 or -1, and their weights; rows are read in pieces.
    """
    n = blocks[0][0].shape[1] + 1
    ridge = np.full(n, 1e-2)
    ridge[-1] = 1e-4
    w = np.zeros(n)
    for _ in range(30):
        gradient, curvature = ridge * w, np.diag(ridge)
        for rows, label, weight in blocks:
            for at in range(0, len(rows), 4096):
                x = np.hstack([rows[at : at + 4096], np.ones((len(rows[at : at + 4096]), 1))])
                margin = 1 - label * (x @ w)
                on = margin > 0
                x, c = x[on], weight[at : at + 4096][on]
                gradient = gradient - label * (x.T @ (c * margin[on]))
                curvature = curvature + (x * c[:, None]).T @ x
        step = np.linalg.solve(curvature, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _logistic(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + 1e-3 * w
        hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(len(w))
        step = np.clip(np.linalg.solve(hessian, gradient), -2, 2)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


def _fit_curve(x: np.ndarray, toxic: np.ndarray) -> tuple[float, float, float]:
    """Logistic curve over both kinds of evidence, neither of which may count against.

    Targets are drawn in from 0 and 1. If either weight came out negative, the two share one.
    """
    n1, n0 = toxic.sum(), len(toxic) - toxic.sum()
    target = np.where(toxic, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    one = np.ones((len(x), 1))
    a, b, c = _logistic(np.hstack([x, one]), target)
    if a < 0 or b < 0:
        a, c = _logistic(np.hstack([x[:, :1] + x[:, 1:] / 2, one]), target)
        b = a / 2
    return max(float(a), 0.0), max(float(b), 0.0), float(c)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _sample(docs: DataFrame, labels: DataFrame, max_docs: int, salt: int) -> DataFrame:
    """``doc_id``, ``toxic`` and ``text`` of at most ``max_docs`` labelled documents a class."""
    known = (
        agreed_labels(labels, "toxic")
        .filter(~held_out(F.col("doc_id")))
        .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")
    )
    order = F.xxhash64("doc_id", F.lit(salt))
    chosen = [
        known.filter(F.col("toxic") == of).orderBy(order, "doc_id").limit(max_docs)
        for of in (True, False)
    ]
    chosen = checkpoint_stage(chosen[0].unionByName(chosen[1]))
    # At most twice max_docs rows of an id and a flag; of an id that repeats, any one text.
    return plain_texts(docs).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"])


_SENTENCES = "doc_id long, toxic boolean, words array<string>"


def _sentences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, ROWS):
        rows = []
        ids, flags = batch.column("doc_id").to_pylist(), batch.column("toxic").to_pylist()
        for doc_id, toxic, text in zip(ids, flags, batch.column("text").to_pylist()):
            for sentence in _SENTENCE.findall(text):
                words = sorted(units(sentence))
                for at in range(0, len(words), 50):
                    rows.append((doc_id, toxic, words[at : at + 50]))
        yield batch_of(rows, _SENTENCES)


def _spread(words: list[str], n: int) -> list[str]:
    """Up to ``n`` of the words, each as unlike the ones before as can be; the first stays."""
    if not words:
        return []
    chosen = [0]
    nearest = kernel(words, [words[0]])[:, 0]
    while len(chosen) < min(n, len(words)):
        at = int(np.argmin(nearest))
        if nearest[at] > 0.98:
            break
        chosen.append(at)
        nearest = np.maximum(nearest, kernel(words, [words[at]])[:, 0])
    return [words[i] for i in chosen]


def _constant(n1: int, n0: int) -> Model:
    share = min(max(n1 / (n1 + n0) if n1 + n0 else 0.0, 1e-9), 1 - 1e-9)
    return Model(None, 0.0, (0.0, 0.0, math.log(share / (1 - share))))


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_docs: int = MAX_DOCS,
    max_sentences: int = MAX_SENTENCES,
    landmarks: int = LANDMARKS,
) -> Model:
    sample = _sample(docs, labels, max_docs, 1)
    sentences = checkpoint_stage(sample.mapInArrow(_sentences, _SENTENCES))
    # Copies are no evidence: a word counts once per context, which is the word of its sentence
    # with the smallest hash (of the others). Copies share that even where they were edited.
    hashes = F.array_sort(F.transform("words", lambda w: F.xxhash64(w)))
    sentences = checkpoint_stage(
        sentences.filter(F.size("words") > 0).withColumns(
            {"h1": F.get(hashes, F.lit(0)), "h2": F.coalesce(F.get(hashes, F.lit(1)), F.lit(0))}
        )
    )
    # Not more than two rows.
    n_docs = {
        r["toxic"]: r["n"]
        for r in sentences.groupBy("toxic").agg(F.countDistinct("h1").alias("n")).collect()
    }
    n1, n0 = n_docs.get(True, 0), n_docs.get(False, 0)
    if not n1 or not n0:
        return _constant(n1, n0)
    context = F.when(F.xxhash64("word") == F.col("h1"), F.col("h2")).otherwise(F.col("h1"))
    seen = (
        sentences.select("toxic", "h1", "h2", F.explode("words").alias("word"))
        .select("toxic", "word", context.alias("context"))
        .distinct()
    )
    words = seen.groupBy("word").agg(
        F.sum(F.col("toxic").cast("int")).alias("in_toxic"),
        F.sum((~F.col("toxic")).cast("int")).alias("in_clean"),
    )
    # How much more often in toxic documents than by chance (log-likelihood ratio).
    share = n1 / (n1 + n0)
    a, b = F.col("in_toxic"), F.col("in_clean")

    def part(n: Column, of: float) -> Column:
        return F.when(n > 0, n * F.log(n / ((a + b) * of))).otherwise(0.0)

    ratio = 2 * (part(a, share) + part(b, 1 - share))
    words = words.filter(a > (a + b) * share).withColumn("tie", ratio)
    suspects = words.orderBy(F.desc("tie"), "word").limit(20 * landmarks).collect()
    tie = {r["word"]: r["tie"] for r in suspects}
    strong = [w for w in tie if tie[w] >= CERTAIN] or list(tie)[:10]
    order = F.xxhash64("doc_id", "words")
    bags = {
        of: [
            r["words"]
            for r in sentences.filter(F.col("toxic") == of)
            .filter(F.arrays_overlap("words", F.lit(strong)) if of else F.lit(True))
            .orderBy(order)
            .limit(max_sentences)
            .select("words")
            .collect()
        ]
        for of in (True, False)
    }
    if not bags[True] or not bags[False]:
        return _constant(n1, n0)
    often = Counter(w for bag in bags[False] for w in bag)
    clean, held = sorted(often), sorted({w for bag in bags[True] for w in bag})
    tied = _spread(strong, landmarks // 2)
    like = kernel(clean, tied).max(axis=1)
    near = [clean[i] for i in np.argsort(-like)[: landmarks // 8]]
    common = [w for w, _ in often.most_common(landmarks // 8)]
    marks = sorted(set(tied) | set(near) | set(common))
    place = {w: i for i, w in enumerate(held)}
    witness = [max(bag, key=lambda w: (tie.get(w, -1.0), w)) for bag in bags[True]]
    k_clean, k_held = kernel(clean, marks), kernel(held, marks)
    seen_often = np.sqrt([often[w] for w in clean])
    for turn in range(TURNS):
        values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
        use = values > 1e-5
        root = (vectors[:, use] / np.sqrt(values[use])).astype(np.float32)
        x_clean, x_held = k_clean @ root, k_held @ root
        times = np.bincount([place[v] for v in witness], minlength=len(held)).astype(float)
        on = times > 0
        weight = np.log1p(times[on])
        weight *= max(1.0, seen_often.sum() / 20 / weight.sum())
        w = _fit_svm([(x_held[on], 1.0, weight), (x_clean, -1.0, seen_often)])
        scored = x_held @ w[:-1]
        again = [max(bag, key=lambda v: scored[place[v]]) for bag in bags[True]]
        # Clean words that the machine takes for toxic become landmarks themselves.
        wrong = x_clean @ w[:-1] + w[-1]
        order = [clean[i] for i in np.argsort(-wrong)[:landmarks] if wrong[i] > -0.5]
        more = [m for m in _spread(order, landmarks // 8) if m not in marks]
        if turn == TURNS - 1 or (again == witness and not more):
            break
        witness = again
        if more:
            marks = marks + more
            k_clean = np.hstack([k_clean, kernel(clean, more)])
            k_held = np.hstack([k_held, kernel(held, more)])
    model = Model(_table(marks, root @ w[:-1]), float(w[-1]), (1.0, 0.0, 0.0))
    judged = _evidence(_sample(docs, labels, max_docs, 2), model, ["toxic"]).collect()
    x = np.array([(r["top"], r["more"]) for r in judged])
    toxic = np.array([r["toxic"] for r in judged], dtype=bool)
    return Model(model.table, model.bias, _fit_curve(x, toxic))


def _evidence(docs: DataFrame, model: Model, more: list[str], text: str = "text") -> DataFrame:
    """``top`` and ``more`` (see ``evidence``) of each text, beside some columns."""
    schema = docs.select(*more).schema.add("top", "double").add("more", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, float] = {}
        for batch in slices(batches, ROWS):
            found = [units(t or "") for t in batch.column(text).to_pylist()]
            if len(known) > MAX_KNOWN:
                known.clear()
            new = [w for w in set().union(*found) if w not in known]
            known.update(zip(new, model.values(new).tolist()))
            rows = [evidence(list(map(known.__getitem__, words))) for words in found]
            both = batch_of(rows, "top double, more double")
            arrays = [batch.column(c) for c in more] + both.columns
            yield pa.RecordBatch.from_arrays(arrays, names=[*more, "top", "more"])

    read = more if text in more else [*more, text]
    return docs.select(*read).mapInArrow(run, schema)


def _probability(model: Model) -> Column:
    a, b, c = model.curve
    z = F.col("top") * a + F.col("more") * b + c
    return 1 / (1 + F.exp(-z))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` and ``predicted`` of every whole text."""
    rows = plain_texts(docs)
    if model.table is None:
        found = rows.withColumns({"top": F.lit(0.0), "more": F.lit(0.0)})
    else:
        found = _evidence(rows, model, ["doc_id"])
    return found.select("doc_id", _probability(model).alias("score")).withColumn(
        "predicted", (F.col("score") >= THRESHOLD).cast("int")
    )


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's rows: score, prediction, and whether the row was held out of training."""
    return score(docs, train(docs, labels)).select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        "predicted",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below ``threshold``; all columns stay."""
    model = train(docs, labels)
    names = docs.columns
    inner = [f"c{i}" for i in range(len(names))]
    rows = docs.select(*[F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)])
    if model.table is None:
        found = rows.withColumns({"top": F.lit(0.0), "more": F.lit(0.0)})
    else:
        found = _evidence(rows, model, inner, inner[names.index("text")])
    return found.filter(_probability(model) < threshold).select(
        *[F.col(i).alias(c) for i, c in zip(inner, names)]
    )
