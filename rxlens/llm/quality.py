"""Quality of documents: fixed base rules, then boosted trees over document statistics.

Statistics come from one pass over each whole text. The trees are fitted on a sample of at most
``MAX_DOCS`` labelled documents, by Newton boosting on histograms of at most ``BINS`` bins; a
statistic listed in ``DIRECTION`` can only lower the score as it grows. A fitted forest is five
flat arrays of nodes (statistic, cut, left and right child, value); all documents of a batch
walk down all trees together, one level per step.

Words are runs of characters other than ASCII white space. Defined results: a null or empty
text has no words and fails the base rules; without labels of both kinds the trees keep
everything; contradictory labels of an id are not learned from; rows that repeat get equal
results. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxlens.llm.arrow import agreed_labels, batch_of, plain_texts
from rxlens.operators.reuse import checkpoint_stage

MAX_DOCS = 4000
BINS = 48
TREES = 60
DEPTH = 3
RATE = 0.2
LEAST_WORDS = 50
KEEP = 0.5
NAMES = (
    "n_words",
    "word_length",
    "symbol_share",
    "repeat_line_share",
    "repeat_word_share",
    "distinct_share",
    "punctuation_share",
    "digit_share",
    "capital_share",
    "high_share",
    "line_length",
    "longest_word",
)
#: Statistics that may only count against a document.
DIRECTION = {"symbol_share": -1, "repeat_line_share": -1, "repeat_word_share": -1}
_SYMBOLS = np.frombuffer(b"#*$%&|<>", dtype=np.uint8)
_SPACE = np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8)
_PUNCTUATION = np.frombuffer(b".,;:!?'\"()-", dtype=np.uint8)


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    hit = np.zeros(len(words) + 1, dtype=np.int64)
    at = np.array([i for i, w in enumerate(windows) if times[w] > 1])
    np.add.at(hit, at, 1)
    np.add.at(hit, at + 3, -1)
    return int((np.cumsum(hit) > 0).sum())


def base_counts(text: bytes) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and the statistics."""
    words = text.split()
    n = len(words)
    bytes_of = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256)
    points = int(bytes_of.sum() - bytes_of[0x80:0xC0].sum())
    chars = points - int(bytes_of[_SPACE].sum())
    symbols = int(bytes_of[_SYMBOLS].sum())
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeats = len(lines) - len(set(lines))
    again = repeated_words(words)
    per_char = 1 / max(chars, 1)
    statistics = [
        float(n),
        chars / max(n, 1),
        symbols * per_char,
        repeats / max(len(lines), 1),
        again / max(n, 1),
        len(set(words)) / max(n, 1),
        float(bytes_of[_PUNCTUATION].sum()) * per_char,
        float(bytes_of[48:58].sum()) * per_char,
        float(bytes_of[65:91].sum()) * per_char,
        float(bytes_of[0xC0:].sum()) * per_char,
        n / max(len(lines), 1),
        float(max(map(len, words), default=0)),
    ]
    return (n, chars, symbols, repeats, again), statistics


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > 50 * n_words


@dataclass(frozen=True)
class Forest:
    """Nodes of all trees in flat arrays; a leaf is its own child."""

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def probability(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))[:, None]
        at = np.tile(self.roots, (len(x), 1))
        for _ in range(self.depth):
            low = x[rows, self.feature[at]] <= self.cut[at]
            at = np.where(low, self.left[at], self.right[at])
        total = self.base + self.value[at].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit(
    x: np.ndarray,
    y: np.ndarray,
    direction: np.ndarray,
    trees: int = TREES,
    depth: int = DEPTH,
    rate: float = RATE,
    least: int = 10,
) -> Forest:
    """Newton boosting for the logistic loss, monotone in features with a direction of +1 or -1.

    A split on such a feature is allowed only if its two sides' values are in order, and the
    middle between them bounds all values further down on either side.
    """
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(q, c, side="left") for q, c in zip(cuts, x.T)], axis=1)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    total = np.full(len(x), base)
    roots, feature, cut, left, right, value = [], [], [], [], [], []
    ridge = 1.0

    def leaf(g: float, h: float, low: float, high: float) -> float:
        return float(np.clip(-g / (h + ridge), low, high))

    def gain(g: np.ndarray, h: np.ndarray, v: np.ndarray) -> np.ndarray:
        return -(g * v + (h + ridge) * v * v / 2)

    def grow(rows: np.ndarray, level: int, low: float, high: float) -> int:
        at = len(feature)
        for column, empty in zip((feature, cut, left, right, value), (0, 0.0, at, at, 0.0)):
            column.append(empty)
        g, h = grad[rows], hess[rows]
        here = leaf(g.sum(), h.sum(), low, high)
        value[at] = rate * here
        best = (1e-6, -1, -1, 0.0, 0.0)
        if level < depth and len(rows) >= 2 * least:
            whole = float(gain(g.sum(), h.sum(), here))
            for f, q in enumerate(cuts):
                if not len(q):
                    continue
                b = binned[rows, f]
                size = len(q) + 1
                gs = np.cumsum(np.bincount(b, g, size))[:-1]
                hs = np.cumsum(np.bincount(b, h, size))[:-1]
                ns = np.cumsum(np.bincount(b, minlength=size))[:-1]
                a = np.clip(-gs / (hs + ridge), low, high)
                c = np.clip(-(g.sum() - gs) / (h.sum() - hs + ridge), low, high)
                ok = (ns >= least) & (len(rows) - ns >= least) & ((c - a) * direction[f] >= 0)
                if not ok.any():
                    continue
                won = gain(gs, hs, a) + gain(g.sum() - gs, h.sum() - hs, c) - whole
                i = int(np.argmax(np.where(ok, won, -np.inf)))
                if won[i] > best[0]:
                    best = (float(won[i]), f, i, float(a[i]), float(c[i]))
        if best[1] >= 0:
            _, f, i, a, c = best
            side = binned[rows, f] <= i
            middle = (a + c) / 2
            bounds = {
                0: ((low, high), (low, high)),
                1: ((low, middle), (middle, high)),
                -1: ((middle, high), (low, middle)),
            }[int(direction[f])]
            feature[at], cut[at], value[at] = f, float(cuts[f][i]), 0.0
            left[at] = grow(rows[side], level + 1, *bounds[0])
            right[at] = grow(rows[~side], level + 1, *bounds[1])
        return at

    everything = np.arange(len(x))
    for _ in range(trees):
        p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        grad, hess = p - y, p * (1 - p)
        roots.append(grow(everything, 0, -np.inf, np.inf))
        tree = Forest(
            np.array(roots[-1:]), *map(np.array, (feature, cut, left, right, value)), 0.0, depth
        )
        at = np.full(len(x), roots[-1])
        for _ in range(depth):
            low = x[everything, tree.feature[at]] <= tree.cut[at]
            at = np.where(low, tree.left[at], tree.right[at])
        total += tree.value[at]
    return Forest(np.array(roots), *map(np.array, (feature, cut, left, right, value)), base, depth)


_STATISTICS = "good boolean, x binary"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("quality").to_pylist(), batch.column("text").to_pylist())
        rows = [(y, np.array(base_counts(t.encode())[1]).tobytes()) for y, t in pairs]
        yield batch_of(rows, _STATISTICS)


def train(docs: DataFrame, labels: DataFrame, max_docs: int = MAX_DOCS) -> Forest | None:
    """Fit on at most ``max_docs`` labelled documents of either kind; None without both kinds."""
    known = agreed_labels(labels, "quality").join(
        docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi"
    )
    order = F.xxhash64("doc_id")
    chosen = [
        known.filter(F.col("quality") == of).orderBy(order, "doc_id").limit(max_docs)
        for of in (True, False)
    ]
    # At most twice max_docs rows of an id and a flag; of an id that repeats, any one text.
    chosen = checkpoint_stage(chosen[0].unionByName(chosen[1]))
    sample = (
        plain_texts(docs)
        .join(F.broadcast(chosen), "doc_id")
        .dropDuplicates(["doc_id"])
        .mapInArrow(_measured, _STATISTICS)
        .collect()
    )
    y = np.array([r["good"] for r in sample], dtype=float)
    if not len(y) or y.min() == y.max():
        return None
    x = np.stack([np.frombuffer(r["x"], dtype=np.float64) for r in sample])
    return fit(x, y, np.array([DIRECTION.get(n, 0) for n in NAMES]))


_REPORT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, quality double"
)


def judge(docs: DataFrame, forest: Forest | None, keep: float = KEEP) -> DataFrame:
    """Base counts, base verdict, the forest's ``quality`` and the final verdict of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for low in range(0, len(ids), 1000):
                part = [t.encode() for t in texts.slice(low, 1000).to_pylist()]
                counted = [base_counts(t) for t in part]
                if forest is None:
                    good = [1.0] * len(part)
                else:
                    good = forest.probability(np.array([c[1] for c in counted])).tolist()
                rows = []
                for doc_id, (counts, _), p in zip(ids[low : low + 1000], counted, good):
                    failed = base_failed(counts[0], counts[4])
                    rows.append((doc_id, *counts, failed, not failed and p >= keep, p))
                yield batch_of(rows, _REPORT)

    return plain_texts(docs).mapInArrow(run, _REPORT)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The query's rows."""
    return judge(docs, train(docs, labels))
