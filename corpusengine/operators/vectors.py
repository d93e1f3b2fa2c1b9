"""Latent semantic indexing: vocabulary, weights, truncated decomposition, fold-in, and incremental indexes.

Weights are log1p(count) x idf. The right singular vectors come from randomised subspace iteration: partitions multiply
their own rows, the driver holds only terms x (dims + oversampling) numbers, bounded by the vocabulary's size.
"""

from __future__ import annotations

import importlib.util
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import ClassVar, Protocol

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusengine.functions import text as T

MAX_VOCABULARY, OVERSAMPLE, ITERATIONS = 8000, 10, 4
_TOKEN, _STOP = re.compile(T.TOKEN), frozenset(T.STOP_WORDS)


def vocabulary(docs: DataFrame, text: str, min_df: int = 2, size: int = MAX_VOCABULARY) -> DataFrame:
    """term, df: the terms in most documents, ties by term."""
    terms = docs.select(F.explode(F.array_distinct(T.tokens(F.col(text)))).alias("term"))
    return terms.groupBy("term").agg(F.count("*").alias("df")).filter(F.col("df") >= min_df).orderBy(F.desc("df"), "term").limit(size)


def idf(vocab: DataFrame, n_docs: int) -> DataFrame:
    return vocab.withColumn("idf", F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1)


def weighted(docs: DataFrame, keys: list[str], text: str, terms: DataFrame) -> DataFrame:
    """keys, term, weight: log1p(count) x idf of the vocabulary's terms in each document, in long form."""
    counts = docs.select(*keys, F.explode(T.tokens(F.col(text))).alias("term")).join(terms.select("term", "idf"), "term").groupBy(*keys, "term", "idf").agg(F.count("*").alias("n"))
    return counts.select(*keys, "term", (F.log1p("n") * F.col("idf")).alias("weight"))


def words(text: str | None) -> list[str]:
    return [t for t in _TOKEN.findall((text or "").lower()) if t not in _STOP]


class Embedder(Protocol):
    """What an embedding backend is: its size, vectors of texts (unit rows, float32) and the vector of a query."""

    name: str

    @property
    def dims(self) -> int: ...

    def embed(self, texts: list[str | None]) -> np.ndarray: ...

    def embed_query(self, text: str) -> list[float]: ...

    def state(self) -> str: ...


def _by_row(n: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of values by their row; ``at`` is in order."""
    out = np.zeros((n, values.shape[1]))
    if len(at):
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        out[at[first]] = np.add.reduceat(values, first, axis=0)
    return out


@dataclass
class Lsa:
    """A fitted model: each term's column and idf, and the directions (terms x dims)."""

    terms: dict[str, int]
    weights: np.ndarray
    directions: np.ndarray
    name = "lsa"

    @property
    def dims(self) -> int:
        return self.directions.shape[1]

    def row(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Columns, each once, and weights of a text."""
        n = {c: k for term, k in Counter(words(text)).items() if (c := self.terms.get(term)) is not None}
        j = np.fromiter(n.keys(), np.int64, len(n))
        return j, np.log1p(np.fromiter(n.values(), float, len(n))) * self.weights[j]

    def rows(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sparse (row, column, weight) of texts, rows in order."""
        each = [self.row(t) for t in texts]
        j, w = (np.concatenate([x[k] for x in each] or [np.zeros(0, kind)]) for k, kind in ((0, np.int64), (1, float)))
        return np.repeat(np.arange(len(each)), [len(x[0]) for x in each]), j, w

    def embed(self, texts: list[str | None]) -> np.ndarray:
        """Text by text: what is held beside the result is one text's terms x dims numbers, however many texts there are."""
        x = np.zeros((len(texts), self.dims))
        for k, t in enumerate(texts):
            j, w = self.row(t)
            x[k] = w @ self.directions[j]
        return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)).astype(np.float32)

    def embed_query(self, text: str) -> list[float]:
        return self.embed([text])[0].tolist()

    def state(self) -> str:
        return json.dumps({"terms": list(self.terms), "weights": self.weights.tolist(), "directions": self.directions.tolist()})

    @classmethod
    def of(cls, state: str) -> Lsa:
        s = json.loads(state)
        return cls({t: k for k, t in enumerate(s["terms"])}, np.array(s["weights"]), np.array(s["directions"]).reshape(len(s["terms"]), -1))


_FLOATS = pa.list_(pa.float64())
_TOGETHER = 64  # rows of a product that are added up in one place
_TEXTS = 512  # texts that are weighed at a time


def _lists(m: np.ndarray, kind: pa.DataType) -> pa.Array:
    """The rows of a matrix as an Arrow list column, of no rows too."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel(), kind.value_type))


def fit(docs: DataFrame, text: str, dims: int = 128, min_df: int = 2, size: int = MAX_VOCABULARY, seed: int = 0) -> Lsa:
    """Texts are tokenised once, into columns and weights that stay for the passes of the iteration."""
    n = docs.count()
    vocab = idf(vocabulary(docs, text, min_df, size), n).collect()  # at most ``size`` rows
    model = Lsa({r["term"]: k for k, r in enumerate(vocab)}, np.array([r["idf"] for r in vocab], float), np.zeros((len(vocab), 1)))
    if not vocab:
        return model
    k = max(1, min(dims, min(n, len(vocab)) - 1))
    wide = min(k + OVERSAMPLE, n, len(vocab))
    q = np.linalg.qr(np.random.RandomState(seed).randn(len(vocab), wide))[0]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (whole.slice(at, _TEXTS) for whole in batches for at in range(0, whole.num_rows, _TEXTS)):
            i, j, w = shared.value.rows(b.column(0).to_pylist())
            ends = pa.array(np.searchsorted(i, np.arange(b.num_rows + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, pa.array(j, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(w, pa.float64()))], ["j", "w"])

    # As many partitions as there are tasks at a time, evenly filled: each sends terms x dims numbers, however large the corpus.
    rows = docs.select(F.col(text).alias("t")).mapInArrow(sparse, "j array<int>, w array<double>").filter(F.size("j") > 0).repartition(spark.sparkContext.defaultParallelism)
    rows = rows.persist(StorageLevel.DISK_ONLY)  # each pass reads it once, in order; the heap is left to the tasks
    for _ in range(ITERATIONS):
        q = np.linalg.qr(_gram_times(rows, q))[0]
    b = _gram_times(rows, q)
    rows.unpersist()
    _, turn = np.linalg.eigh(q.T @ b)
    model.directions = (q @ turn[:, ::-1])[:, :k]
    return model


def _add_gram(total: np.ndarray, j: np.ndarray, w: np.ndarray, ends: np.ndarray, q: np.ndarray) -> None:
    """Adds (A'A) q for some rows of A, row by row: a row has a column once, and its terms x dims numbers are all that is held."""
    for s, e in zip(ends[:-1], ends[1:], strict=True):
        at, by = j[s:e], w[s:e]
        total[at] += np.outer(by, by @ q[at])


def _gram_times(rows: DataFrame, q: np.ndarray) -> np.ndarray:
    """(A'A) q for the weighted matrix A in sparse rows (j, w): each partition adds up its own part, parts are added by row in Spark."""
    shared = rows.sparkSession.sparkContext.broadcast(q)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        total = np.zeros_like(q)
        for b in batches:
            j, w, ends = b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy(), b.column(0).offsets.to_numpy()
            _add_gram(total, j, w, ends - ends[0], q)
        some = np.flatnonzero(np.abs(total).sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(some // _TOGETHER, pa.int64()), pa.array(some, pa.int64()), _lists(total[some], _FLOATS)], ["block", "row", "v"])

    def add(t: pa.Table) -> pa.Table:
        """Rows of a block from every partition: one of each."""
        at, v = t["row"].to_numpy(), t["v"].combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        some, place = np.unique(at, return_inverse=True)
        order = np.argsort(place, kind="stable")
        return pa.table([pa.array(some, pa.int64()), _lists(_by_row(len(some), place[order], v[order]), _FLOATS)], ["row", "v"])

    got = rows.mapInArrow(part, "block long, row long, v array<double>").groupBy("block").applyInArrow(add, "row long, v array<double>").toArrow()
    out = np.zeros_like(q)
    if got.num_rows:
        out[got["row"].to_numpy()] = got["v"].combine_chunks().flatten().to_numpy().reshape(got.num_rows, -1)
    shared.unpersist()
    return out


def embed(chunks: DataFrame, text: str, model: Embedder) -> DataFrame:
    """pmcid, chunk_id, text_hash, vector for each row of chunks."""
    shared = chunks.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("array<float>")
    def vector(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for s in batches:
            yield _lists(np.asarray(shared.value.embed(s.to_pylist()), np.float32).reshape(len(s), -1), pa.list_(pa.float32()))

    return chunks.select("pmcid", "chunk_id", F.md5(F.col(text)).alias("text_hash"), vector(F.col(text)).alias("vector"))


def corpus_hash(chunks: DataFrame, text: str) -> str:
    """Of all chunks' keys and texts, whatever their order."""
    got = chunks.agg(F.count("*"), F.sum(F.xxhash64("pmcid", "chunk_id", F.md5(F.col(text))).cast("decimal(38,0)"))).first()
    return f"{got[0]}-{got[1]}"


def refreshed(chunks: DataFrame, text: str, prior: DataFrame | None, embed_new: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """An index for chunks: vectors of chunks whose key and text are in the prior index are taken over, the others are made."""
    if prior is None:
        return embed_new(chunks)
    keyed = chunks.withColumn("text_hash", F.md5(F.col(text)))
    known = prior.select("pmcid", "chunk_id", "text_hash", "vector")
    keys = ["pmcid", "chunk_id", "text_hash"]
    old = keyed.select(*keys).join(known, keys)
    return old.unionByName(embed_new(keyed.join(known.select(*keys), keys, "left_anti").drop("text_hash")))


class Pretrained:
    """A sentence encoder of an optional package. What travels is its name: each worker process loads the model once, when it first embeds."""

    name = "st"
    _loaded: ClassVar[dict[str, object]] = {}

    def __init__(self, model: str = "all-MiniLM-L6-v2"):
        self.model = model

    def _encoder(self):
        if self.model not in Pretrained._loaded:
            from sentence_transformers import SentenceTransformer

            Pretrained._loaded[self.model] = SentenceTransformer(self.model)
        return Pretrained._loaded[self.model]

    @property
    def dims(self) -> int:
        return self._encoder().get_sentence_embedding_dimension()

    def embed(self, texts: list[str | None]) -> np.ndarray:
        return np.asarray(self._encoder().encode([t or "" for t in texts], batch_size=64, normalize_embeddings=True), np.float32)

    def embed_query(self, text: str) -> list[float]:
        return self.embed([text])[0].tolist()

    def state(self) -> str:
        return json.dumps({"model": self.model})

    @classmethod
    def of(cls, state: str) -> Pretrained:
        return cls(json.loads(state)["model"])


#: Embedding backends by name.
BACKENDS: dict[str, type] = {"lsa": Lsa, "st": Pretrained}


def backend(name: str = "auto") -> str:
    """The name of a backend; auto: the pretrained one where its package is installed, else lsa."""
    if name == "auto":
        return "st" if importlib.util.find_spec("sentence_transformers") else "lsa"
    if name not in BACKENDS:
        raise ValueError(f"unknown embedding backend: {name}")
    return name
