"""Quality classifier: histogram gradient-boosted trees over document statistics.

Features are rates and logs of the statistics of a document's whole text. Trees are grown on binned features
(second-order gains on histograms of gradients) and flattened into arrays of complete binary trees, so that
scoring a batch is a few numpy gathers a level for all trees.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.llm import _common as c
from corpusengine.llm.learning import held_out, sample
from corpusengine.llm.stats import NAMES, stats

SAMPLE, BINS, TREES, DEPTH, RATE, L2 = 12_000, 64, 80, 4, 0.15, 1.0
_AT = {n: i for i, n in enumerate(NAMES)}


def features(x: np.ndarray) -> np.ndarray:
    """Of rows of statistics; an empty document has zeros."""
    g = lambda n: x[:, _AT[n]].astype(float)
    words, chars, letters, lines = (np.maximum(g(n), 1) for n in ("n_words", "n_chars", "n_letters", "n_lines"))
    return np.column_stack([
        np.log1p(g("n_words")), np.log1p(g("n_lines")), g("word_chars") / words, g("n_symbols") / words, g("n_dup_lines") / lines, g("n_repeat_words") / words,
        g("n_distinct") / words, np.log1p(g("n_distinct")), g("n_upper") / letters, g("n_letters") / chars, g("n_digits") / chars, g("n_marks") / words, g("n_stops") / words, g("n_pipes") / words,
        np.log1p(g("longest_word")), g("top_word") / words, g("n_same_next") / words, g("n_capital") / words, words / lines,
    ])


class Trees:
    """Boosted trees for a 0/1 label. Arrays: node i of a tree has children 2i+1 and 2i+2; a leaf below the last split keeps its parent's way."""

    def __init__(self, trees: int = TREES, depth: int = DEPTH, rate: float = RATE):
        self.trees, self.depth, self.rate = trees, depth, rate
        self.feature = np.zeros((0, 2**depth - 1), np.int64)
        self.limit = np.zeros((0, 2**depth - 1))
        self.value = np.zeros((0, 2**depth))
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        if not len(y):
            return self
        rate = np.clip(y.mean(), 0.01, 0.99)
        self.base = float(np.log(rate / (1 - rate)))
        if y.min() == y.max():
            return self
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        binned = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])  # bin b: x <= edges[b]
        f = np.full(len(y), self.base)
        grown = []
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-f))
            feature, limit, value, leaf = self._tree(binned, edges, p - y, np.maximum(p * (1 - p), 1e-6))
            grown.append((feature, limit, value))
            f += value[leaf]
        self.feature, self.limit, self.value = (np.stack(z) for z in zip(*grown, strict=True))
        return self

    def _tree(self, binned, edges, g, h):
        n_features, inner = binned.shape[1], 2**self.depth - 1
        feature, limit, node = np.zeros(inner, np.int64), np.full(inner, np.inf), np.zeros(len(g), np.int64)
        for level in range(self.depth):
            first, width = 2**level - 1, 2**level
            gains = np.full((width, n_features), -1.0)
            cuts = np.zeros((width, n_features), np.int64)
            for j in range(n_features):
                key = node * BINS + binned[:, j]
                gs = np.bincount(key, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                hs = np.bincount(key, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + L2) + (gt - gs) ** 2 / (ht - hs + L2) - gt**2 / (ht + L2)
                gain[(hs < 1) | (ht - hs < 1)] = -1
                gain = gain[:, : max(1, len(edges[j]))] if len(edges[j]) else np.full((width, 1), -1.0)
                cuts[:, j], gains[:, j] = gain.argmax(axis=1), gain.max(axis=1)
            best = gains.argmax(axis=1)
            for k in range(width):
                j = best[k]
                if gains[k, j] > 1e-6:
                    feature[first + k], limit[first + k] = j, edges[j][cuts[k, j]]
            cut = np.where(np.isfinite(limit[first : first + width]), cuts[np.arange(width), best], BINS)
            node = 2 * node + (binned[np.arange(len(g)), feature[first + node]] > cut[node])
        gs, hs = np.bincount(node, g, 2**self.depth), np.bincount(node, h, 2**self.depth)
        return feature, limit, -self.rate * gs / (hs + L2), node

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1, by rows."""
        f = np.full(len(x), self.base)
        n = len(self.feature)
        if n and len(x):
            at = np.zeros((len(x), n), np.int64)
            tree, rows = np.arange(n)[None, :], np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, self.feature[tree, at]] > self.limit[tree, at])
            f += self.value[tree, at - (2**self.depth - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-f))


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Trees:
    """On at most ``rows`` labelled documents; no labels: every score is 0.5."""
    picked = sample(docs, labels, "quality", rows)
    made = c.map_rows(picked.select("doc_id", "y", "text"), lambda doc_id, y, raw: (doc_id, y, list(stats(raw))), "doc_id long, y int, x array<long>")
    made = made.groupBy("doc_id").agg(F.min(F.struct("y", "x")).alias("m")).select("m.*").toArrow().to_pylist()  # of repeated rows one
    made.sort(key=lambda r: (r["y"], r["x"]))
    if not made:
        return Trees()
    return Trees().fit(features(np.array([r["x"] for r in made])), np.array([float(r["y"]) for r in made]))


def classify(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of docs.

    Null texts are scored as empty ones; very long texts are measured whole; equal texts have equal scores; a null doc_id isn't held out; a
    score of exactly 0.5 predicts 1. No documents: no rows. Columns beside doc_id and text aren't read.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows))  # trees x 2^depth numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = np.array([stats(raw.as_py()) for raw in b.column("text")])
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(model.value.score(features(x)))], ["doc_id", "held_out", "score"])

    out = c.texts(docs, held_out()).mapInArrow(run, "doc_id long, held_out boolean, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """classify() over all documents: a row for each, null and empty texts, repeated rows and very long texts included; an empty table gives no rows."""
    return classify(c.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
