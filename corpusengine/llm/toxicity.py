"""Toxicity: a convolutional text classifier over hashed word embeddings, in numpy.

A word's vector is the sum of the embeddings of its hash and of the hashes of its beginnings, so that inflected
and compounded words meet. Filters of several widths slide over the words of the whole text; each keeps its
maximum, and a logistic layer reads the maxima. Embeddings, filters and the layer start at random and are learnt
together by gradient descent. A filter is linear in the words it covers, so the answers of each distinct word to
every filter column are computed once and a position is a sum of looked-up rows.

Thresholds are calibrated by language on a fold of the training rows. A language is what the training documents
show: a cluster of their frequent words (spherical k-means), so that no list of languages is needed and scores use
no column beside the text; each cluster's logits are moved so that its threshold is 0.7.
"""

from __future__ import annotations

import pickle
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.llm import _common as c
from corpusengine.llm.learning import held_out, sample

SAMPLE = 12_000  # labelled rows, a documented bound (learning.SIZE bounds their texts together)
BUCKETS, DIM, WIDTHS, FILTERS = 1 << 16, 12, (1, 2, 3), 8
STEPS, EPOCHS, RATE, BATCH, SEED, THRESHOLD = 1000, 25, 0.02, 64, 7, 0.7
TOXIC_WEIGHT = 2.0
PREFIXES, LEAST_DOCS = (4, 5, 6), 3
CLUSTERS, FREQUENT = 6, 256
_WORD = re.compile(r"\w+")
_KEPT = 100_000  # words whose answers a worker remembers
_PAD = max(WIDTHS) - 1
_BYTES = 1 << 20  # texts scored at a time, beyond the first


def hashed(word: str) -> tuple[int, ...]:
    """Buckets of a lower-case word: its own and those of its beginnings (its own again where it is shorter)."""
    own = zlib.crc32(word.encode("utf-8", "replace")) % BUCKETS
    return (own, *(zlib.crc32(b"^" + word[:n].encode("utf-8", "replace")) % BUCKETS if len(word) > n else own for n in PREFIXES))


def words_of(raw: bytes | None) -> list[str]:
    return _WORD.findall((raw or b"").decode("utf-8", "replace").lower())


class Languages:
    """Clusters of texts by the hashed words that most training documents use."""

    def __init__(self, texts: list[tuple[np.ndarray, np.ndarray]] = ()):
        held = np.zeros(BUCKETS, np.int64)
        for ids, _ in texts:
            held[np.unique(ids[:, 0])] += 1
        often = np.argsort(-held, kind="stable")[:FREQUENT]
        often = often[held[often] > 0]
        self.place = np.full(BUCKETS, -1)  # of a bucket among the frequent ones
        self.place[often] = np.arange(len(often))
        x = np.stack([self.profile(ids[index, 0]) for ids, index in texts]) if texts else np.zeros((0, FREQUENT))
        x = x[x.any(axis=1)]
        self.centres = np.zeros((1, FREQUENT))
        if len(x):
            centres = [x.mean(axis=0)]  # the first one is in the middle, each further one farthest from those before
            while len(centres) < min(CLUSTERS, len(x)):
                centres.append(x[(x @ np.stack(centres).T).max(axis=1).argmin()])
            m = np.stack(centres)
            for _ in range(20):
                near = (x @ m.T).argmax(axis=1)
                m = np.stack([x[near == k].sum(axis=0) if (near == k).any() else m[k] for k in range(len(m))])
                m /= np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-12)
            self.centres = m

    def profile(self, buckets: np.ndarray) -> np.ndarray:
        """Of the words' buckets: square roots of the frequent ones' counts, of length 1."""
        k = self.place[buckets]
        v = np.sqrt(np.bincount(k[k >= 0], minlength=FREQUENT))
        return v / max(np.linalg.norm(v), 1e-12)

    def __call__(self, buckets: np.ndarray) -> int:
        """The nearest cluster; the first one for a text without frequent words."""
        return int((self.centres @ self.profile(buckets)).argmax())


class Network:
    """Texts are pairs: the buckets of their distinct words (a row each), and for each word of the text the row of it."""

    def __init__(self, kind: type = np.float32) -> None:
        rng, n = np.random.RandomState(SEED), len(WIDTHS) * FILTERS
        self.offset = np.concatenate(([0], np.cumsum(WIDTHS)))
        self.e = (rng.randn(BUCKETS, DIM) * 0.1).astype(kind)
        self.w = (rng.randn(sum(WIDTHS), DIM, FILTERS) / np.sqrt(DIM)).astype(kind)  # one block for each place under each filter
        self.b = np.zeros(n, kind)
        self.out = (np.abs(rng.randn(n)) * 0.3).astype(kind)
        self.bias = np.zeros(1, kind)
        self.languages = Languages()
        self.moved = np.zeros(1)  # threshold of each language, as a logit
        self.spread = 1.0

    def answers(self, ids: np.ndarray) -> np.ndarray:
        """(words, buckets) -> (words, places, filters): what each word gives to each filter column."""
        return (self.e[ids].sum(axis=1) @ self.w.transpose(1, 0, 2).reshape(DIM, -1)).reshape(len(ids), sum(WIDTHS), FILTERS)

    def maxima(self, answers: np.ndarray, seq: np.ndarray, starts: np.ndarray, places: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """Of every text and filter the maximum over its positions, and (if asked for) the first place of it in seq.

        seq: rows of answers of the texts one after another, each followed by _PAD rows of the null word (an empty text is a null word), so that
        every filter fits at every word; starts: where texts start.
        """
        n, sizes = len(seq), np.diff(np.append(starts, len(seq)))
        inside = np.ones(n, bool)
        for k in range(1, _PAD + 1):
            inside[starts + sizes - k] = False
        tops, at = [], []
        for k, width in enumerate(WIDTHS):
            z = answers[seq, self.offset[k]]
            for j in range(1, width):
                z[: n - j] += answers[seq[j:], self.offset[k] + j]
            z[~inside] = -np.inf  # a window that would begin in the padding
            top = np.maximum.reduceat(z, starts, axis=0)
            tops.append(top)
            if places:
                at.append(np.minimum.reduceat(np.where(z == np.repeat(top, sizes, axis=0), np.arange(n)[:, None], n), starts, axis=0))
        return np.concatenate(tops, axis=1), np.concatenate(at, axis=1) if places else None

    def _batch(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, seq, starts, maxima, their places) of some texts; row 0 of ids is the null word, whose answers are zero."""
        ids = np.concatenate([np.zeros((1, 1 + len(PREFIXES)), np.int64), *[t[0] for t in texts]])
        first = 1 + np.cumsum([0, *[len(t[0]) for t in texts[:-1]]])
        parts = [np.concatenate([t[1] + f if len(t[1]) else [0], np.zeros(_PAD, np.int64)]).astype(np.int64) for t, f in zip(texts, first, strict=True)]
        seq, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts])
        starts = ends - [len(x) for x in parts]
        answers = self.answers(ids)
        answers[0] = 0
        return ids, seq, starts, *self.maxima(answers, seq, starts)

    def logits(self, top: np.ndarray) -> np.ndarray:
        return np.maximum(top + self.b, 0) @ self.out + self.bias[0]

    def logits_of(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        return np.concatenate([self.logits(self._batch(texts[k : k + BATCH])[3]) for k in range(0, len(texts), BATCH)] or [np.zeros(0)])

    def gradients(self, texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, weight: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
        """Of the mean weighted logistic loss: by parameter, and for the embeddings (buckets, their gradients)."""
        ids, seq, _, top, at = self._batch(texts)
        x = self.e[ids].sum(axis=1)
        x[0] = 0
        act = np.maximum(top + self.b, 0)
        p = 1 / (1 + np.exp(-np.clip(act @ self.out + self.bias[0], -500, 500)))
        d = ((p - y) * weight / len(y)).astype(self.e.dtype)
        back = np.where(act > 0, d[:, None] * self.out, 0).astype(self.e.dtype)
        grads = {"out": act.T @ d, "b": back.sum(axis=0), "bias": d.sum(keepdims=True), "w": np.zeros_like(self.w)}
        rows, pulls = [], []
        for k, width in enumerate(WIDTHS):
            mine = slice(k * FILTERS, (k + 1) * FILTERS)
            for j in range(width):
                row, place = seq[at[:, mine] + j], self.offset[k] + j
                grads["w"][place] = np.einsum("nfd,nf->df", x[row], back[:, mine])
                some = np.nonzero((back[:, mine] != 0) & (row > 0))
                rows.append(ids[row[some]])
                pulls.append(back[:, mine][some][:, None] * self.w[place].T[some[1]])
        rows, pulls = np.concatenate(rows), np.concatenate(pulls)
        bucket, inverse = np.unique(rows.ravel(), return_inverse=True)
        total = np.zeros((len(bucket), DIM), self.e.dtype)
        np.add.at(total, inverse, np.repeat(pulls, rows.shape[1], axis=0))
        return grads, bucket, total

    def fit(self, texts: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray) -> None:
        """Adam for filters and layer, rows of embeddings by their own squared gradients; rates fall to nearly zero.

        Buckets of fewer than LEAST_DOCS training documents stay zero, for what one document says alone doesn't carry over.
        """
        held = np.zeros(BUCKETS, np.int64)
        for ids, _ in texts:
            held[np.unique(ids)] += 1
        known = held >= LEAST_DOCS
        self.e[~known] = 0
        self.bias[0] = np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)) if len(y) else 0
        rng, n = np.random.RandomState(SEED), len(y)
        params = {"w": self.w, "b": self.b, "out": self.out, "bias": self.bias}
        m, v = ({k: np.zeros_like(p) for k, p in params.items()} for _ in range(2))
        seen = np.zeros(BUCKETS, self.e.dtype)  # squared gradients of the embeddings' rows
        step, steps = 0, min(STEPS, EPOCHS * -(-n // BATCH))
        while step < steps:
            order = rng.permutation(n)
            for s in range(0, n, BATCH)[: steps - step]:
                left = 1 - step / steps
                some = order[s : s + BATCH]
                grads, bucket, total = self.gradients([texts[i] for i in some], y[some], np.where(y[some] == 1, TOXIC_WEIGHT, 1.0))
                step += 1
                for k, p in params.items():
                    m[k] = 0.9 * m[k] + 0.1 * grads[k]
                    v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                    p -= (RATE * left + 1e-4) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
                total[~known[bucket]] = 0
                seen[bucket] += (total**2).mean(axis=1)
                self.e[bucket] -= (5 * RATE * left + 1e-4) * total / (np.sqrt(seen[bucket])[:, None] + 1e-6)

    def calibrate(self, logits: np.ndarray, y: np.ndarray, lang: np.ndarray) -> None:
        """For each language the threshold of the best F1, nearer to the toxic row above it than to the row below; one with few rows of either label takes that of all."""

        def best(f: np.ndarray, t: np.ndarray) -> float | None:
            if (t == 1).sum() < 5 or (t == 0).sum() < 5:
                return None
            order = np.argsort(-f, kind="stable")
            hits = t[order].cumsum()
            f1 = 2 * hits / (np.arange(1, len(f) + 1) + t.sum())
            k = int(f1.argmax())
            low = f[order[k + 1]] if k + 1 < len(f) else f[order[k]] - 1
            return float(low + 0.7 * (f[order[k]] - low))

        every = best(logits, y)
        every = 0.0 if every is None else every
        self.moved = np.array([every if (own := best(logits[lang == k], y[lang == k])) is None else own for k in range(len(self.languages.centres))])
        self.spread = max(0.5, float(np.std(logits)) / 4)

    def score(self, logit: float, lang: int) -> float:
        """The threshold of the language is at 0.7."""
        z = (logit - self.moved[lang]) / self.spread + np.log(THRESHOLD / (1 - THRESHOLD))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def learnt(made: list[dict]) -> Network:
    """Of rows with doc_id, y, ids and idx (a text's words as in Network), four of five to learn from and the fifth to calibrate; no rows: every score is 0."""
    made.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    net = Network()
    if not made:
        net.moved = net.moved + 1e3
        return net
    texts = [(np.frombuffer(r["ids"], np.int32).reshape(-1, 1 + len(PREFIXES)), np.frombuffer(r["idx"], np.int32)) for r in made]
    y = np.array([r["y"] for r in made])
    fit = np.arange(len(y)) % 5 != 0
    learn, check = ([t for t, k in zip(texts, fit, strict=True) if k == side] for side in (True, False))
    net.languages = Languages(learn)
    if learn:
        net.fit(learn, y[fit])
    net.calibrate(net.logits_of(check), y[~fit], np.array([net.languages(ids[index, 0]) for ids, index in check], int))
    return net


def train(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Network:
    """On at most ``rows`` labelled documents, in one task (the sample's bounds hold for it); only the network comes to the driver."""
    picked = sample(docs, labels, "toxic", rows)

    def row(doc_id: int, y: int, raw: bytes | None) -> tuple:
        words = words_of(raw)
        seen = {w: k for k, w in enumerate(dict.fromkeys(words))}
        ids = np.array([hashed(w) for w in seen], np.int32).reshape(-1, 1 + len(PREFIXES))
        return doc_id, y, ids.tobytes(), np.array([seen[w] for w in words], np.int32).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = [r for b in batches for r in b.to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(learnt(made))], pa.binary())], ["network"])

    made = c.map_rows(picked.select("doc_id", "y", "text"), row, "doc_id long, y int, ids binary, idx binary")
    made = made.groupBy("doc_id").agg(F.min(F.struct("y", "ids", "idx")).alias("x")).select("doc_id", "x.*")  # of repeated rows one
    got = made.repartition(1).mapInArrow(run, "network binary").collect()  # one row, or none if there is nothing to learn from
    return pickle.loads(got[0][0]) if got else learnt([])


class Scorer:
    """A worker's network with the answers of the words it has met; how many it remembers, and how texts are batched, has no effect on scores."""

    def __init__(self, net: Network):
        self.net, self.row = net, {}
        self.table = np.zeros((1024, sum(WIDTHS), FILTERS), np.float32)  # row 0 is the null word
        self.own = np.zeros(1024, np.int64)

    def rows(self, words: list[str]) -> np.ndarray:
        new = list({w for w in words if w not in self.row})
        if new:
            at = 1 + len(self.row)
            if at + len(new) > len(self.table):
                size = 2 * (at + len(new))
                table, own = np.zeros((size, *self.table.shape[1:]), np.float32), np.zeros(size, np.int64)
                table[:at], own[:at] = self.table[:at], self.own[:at]
                self.table, self.own = table, own
            ids = np.array([hashed(w) for w in new])
            self.table[at : at + len(new)], self.own[at : at + len(new)] = self.net.answers(ids), ids[:, 0]
            self.row.update({w: at + k for k, w in enumerate(new)})
        return np.array([self.row[w] for w in words], np.int64)

    def __call__(self, raws: list[bytes | None]) -> list[float]:
        if len(self.row) > _KEPT:
            self.row = {}
        found = [self.rows(words_of(raw)) for raw in raws]
        if not found:
            return []
        sizes = [max(1, len(x)) + _PAD for x in found]
        starts = np.cumsum([0, *sizes[:-1]])
        seq = np.zeros(sum(sizes), np.int64)
        for s, x in zip(starts, found, strict=True):
            seq[s : s + len(x)] = x
        logits = self.net.logits(self.net.maxima(self.table, seq, starts, places=False)[0])
        return [self.net.score(float(f), self.net.languages(self.own[x])) for f, x in zip(logits, found, strict=True)]


def score(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Callable[[Column], Column]:
    """A column function, from a text (as binary) to its score, of a network trained on docs and labels."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows))  # BUCKETS x DIM numbers, at any size

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(model.value)
        for texts in batches:
            scores, held, size = [], [], 0
            for x in texts:
                held.append(x.as_py())
                size += len(held[-1] or b"")
                if size >= _BYTES:
                    scores += scorer(held)
                    held, size = [], 0
            yield pa.array(scores + scorer(held), pa.float64())

    return F.arrow_udf(run, "double")


def classify(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted: a row for each row of docs.

    Null and empty texts have no words: the score of a null word; very long texts are scored whole; equal texts have equal scores; a null
    doc_id isn't held out; a score of exactly the threshold is toxic. No documents: no rows. Columns beside doc_id and text aren't read.
    """
    scored = c.texts(docs, held_out()).select("doc_id", "held_out", score(docs, labels, rows)("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    """The rows of docs that aren't predicted toxic, unchanged; no shuffle of texts."""
    mark = score(docs, labels, rows)(F.col("text").cast("string").cast("binary"))
    return docs.withColumn("_toxic", mark).filter(F.col("_toxic") < THRESHOLD).drop("_toxic")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """classify() over all documents: a row for each, null and empty texts, repeated rows and very long texts included; an empty table gives no rows."""
    return classify(c.documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
