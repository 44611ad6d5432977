"""Quality scores by histogram gradient-boosted trees over statistics of a document.

Statistics are computed in Arrow batches over whole texts. The trees are fitted
on a bounded sample of labelled rows: features become bins by quantiles, and each
level of a tree takes, per node, the split with the best gain from histograms of
gradients. Fitted trees are complete and lie flat in arrays, so that a batch goes
down all trees at once by array look-ups.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardpulse.llm.batches import by_text_size, map_batches

#: Labelled rows that the trees are fitted on at most, taken in the order of a hash of the id.
MAX_LABELLED = 20_000
FEATURES = (
    "log_words", "word_length", "upper", "digits", "spaces", "non_ascii", "commas", "stops", "exclaims", "bars", "symbols", "other_marks",
    "lines_per_word", "repeated_lines", "distinct_words", "distinct_pairs", "top_word", "twice_running", "longest_word", "bare_words",
)
N_FEATURES = len(FEATURES)
_UPPER, _DIGITS = np.arange(65, 91), np.arange(48, 58)
_SYMBOLS = np.frombuffer(b"#*$%&<>~^=_+@\\", np.uint8)
_MARKS = np.frombuffer(b"\"'()[]{};:/-?`", np.uint8)


def statistics(text: str | None) -> list[float]:
    """The features of a text; zeros for a null or empty one."""
    text = text or ""
    words = text.split()
    if not words:
        return [0.0] * N_FEATURES
    n, raw = len(words), np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(raw, minlength=256)
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    pairs = len(set(zip(words, words[1:], strict=False)))
    return [
        np.log1p(n),
        sum(map(len, words)) / n,
        counts[_UPPER].sum() / len(raw),
        counts[_DIGITS].sum() / len(raw),
        counts[32] / len(raw),
        counts[128:].sum() / len(raw),
        counts[44] / n,
        counts[46] / n,
        counts[33] / n,
        counts[124] / n,
        counts[_SYMBOLS].sum() / n,
        counts[_MARKS].sum() / n,
        len(lines) / n,
        1 - len(set(lines)) / len(lines),
        len(set(words)) / n,
        pairs / max(1, n - 1),
        Counter(words).most_common(1)[0][1] / n,
        sum(map(eq, words, words[1:])) / n,
        max(map(len, words)) / n,
        sum(map(str.isalpha, words)) / n,
    ]


def features(texts: list[str | None]) -> np.ndarray:
    return np.array([statistics(t) for t in texts], np.float64).reshape(-1, N_FEATURES)


@dataclass(frozen=True)
class Trees:
    """Complete trees of one depth: split features and thresholds by level order, then leaf values."""

    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray
    leaf: np.ndarray  # trees x 2^depth
    base: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of label 1; all trees take a step at a time."""
        count, inner = self.feature.shape
        rows, trees = np.arange(len(x))[:, None], np.arange(count)[None, :]
        at = np.zeros((len(x), count), np.int64)
        while inner and at.size and at[0, 0] < inner:
            at = 2 * at + 1 + (x[rows, self.feature[trees, at]] > self.threshold[trees, at])
        total = self.base + self.leaf[trees, at - inner].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, trees: int = 120, depth: int = 4, rate: float = 0.12, bins: int = 64, ridge: float = 1.0, least: float = 5.0) -> Trees:
    """Boosted trees for logistic loss; with one label only, or no rows, the share of label 1 (smoothed) alone."""
    share = (y.sum() + 1) / (len(y) + 2)
    base, inner = float(np.log(share / (1 - share))), (1 << depth) - 1
    if not len(y) or y.min() == y.max():
        trees = 0
    feature = np.zeros((trees, inner), np.int64)
    threshold = np.full((trees, inner), np.inf)
    leaf = np.zeros((trees, inner + 1))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])] if trees else []
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]) if trees else None
    score = np.full(len(y), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        gradient, weight = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            nodes, first = 1 << level, (1 << level) - 1
            best = np.full(nodes, 1e-9)
            own = at - first
            for f, c in enumerate(cuts):
                cell = own * bins + binned[f]
                g = np.bincount(cell, gradient, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                h = np.bincount(cell, weight, nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                all_g, all_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (all_g - g) ** 2 / (all_h - h + ridge) - all_g**2 / (all_h + ridge)
                gain[(h < least) | (all_h - h < least)] = 0
                gain[:, len(c) :] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(nodes), top] > best
                best[better] = gain[np.arange(nodes), top][better]
                feature[t, first : first + nodes][better] = f
                threshold[t, first : first + nodes][better] = c[top[better]] if len(c) else np.inf
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t, at]] > threshold[t, at])
        g, h = (np.bincount(at - inner, v, inner + 1) for v in (gradient, weight))
        leaf[t] = rate * g / (h + ridge)
        score += leaf[t, at - inner]
    return Trees(feature, threshold, leaf, base)


def held_out(doc_id: Column) -> Column:
    """Rows that are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _with_features(frame: DataFrame, name: str, kind: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_text_size(batches, "text"):
            x = features(batch.column("text").to_pylist())
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.reshape(-1)), N_FEATURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column(name), lists], ["doc_id", name, "x"])

    return map_batches(frame.select("doc_id", name, "text"), run, f"doc_id long, {name} {kind}, x array<double>")


def learn(documents: DataFrame, labels: DataFrame, label: str = "quality", most: int = MAX_LABELLED) -> Trees:
    """Trees from at most ``most`` labelled documents outside the held-out part.

    Null ids and labels are left out; of several labels of a document the
    majority counts, and of several documents with one id any one.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg((F.avg(label) >= 0.5).cast("double").alias("label"))
    chosen = one.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    found = _with_features(rows, "label", "double").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    return fit(np.array([r.x for r in found], np.float64).reshape(-1, N_FEATURES), np.array([r.label for r in found], np.float64))


def scored(documents: DataFrame, trees: Trees, cut: float = 0.7) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; null and empty texts are scored by their zeros.

    Null ids stay and are not held out; repeated rows stay; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_text_size(batches, "text"):
            scores = trees.score(features(batch.column("text").to_pylist()))
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(scores), pa.array((scores >= cut).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    read = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return map_batches(read, run, "doc_id long, held_out boolean, score double, predicted int")
