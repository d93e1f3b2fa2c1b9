"""Language-model scores by Katz backoff over words.

Probabilities: Good-Turing discounts counts up to ``K``; a context's freed mass goes to the words not seen after it, in
proportion to their unigram probability, with the backoff weight that makes the context sum to exactly 1 over the
training vocabulary and one class for all unknown words. The mass freed from unigrams is that class's probability.

Data flow: documents are encoded once into chunks (indices into a chunk's own vocabulary). A chunk sends each of its
distinct words, and then each of its distinct word pairs, once, packed in numpy arrays, to the part of the model that owns
them; parts are tables partitioned by word hash and by context, hold the counts of the whole corpus, and answer. So what
is moved follows the distinct words and pairs of a chunk, texts never move, and no part of the model is ever
broadcast. Contexts with a large share of all tokens are dealt over several parts.
"""

from __future__ import annotations

import struct
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.llm import _common as c

K, CHUNK, FOLDS, HELD_OUT = 5, 3_000_000, 7, 2
#: Tokens behind a part of the model: a part holds the different words or pairs of so many, at most; there is a task for each part.
PART = 3_000_000
END = xxhash.xxh64_intdigest(b"\n</s>")  # no word has a line feed
_SLOT = 1 << 20


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned integers or doubles: as narrow as they fit, byte planes apart, compressed."""
    out = []
    for a in arrays:
        real = a.dtype.kind == "f"
        a = np.ascontiguousarray(a, "<f8").view("<u8") if real else a.astype("<u8")
        top = int(a.max()) if len(a) else 0
        width = 8 if real else next(w for w in (1, 2, 4, 8) if top < 1 << 8 * w)
        out += [struct.pack("<BBQ", real, width, len(a)), a.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()]
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(blob: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(blob), 0, []
    while at < len(raw):
        real, width, n = struct.unpack_from("<BBQ", raw, at)
        at += 10
        a = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T.copy().view(f"<u{width}").reshape(-1)
        out.append(a.view("<f8") if real else a.astype(np.int64 if width < 8 else np.uint64))
        at += n * width
    return out


def discounts(n: list[int] | np.ndarray) -> np.ndarray:
    """d[r] for counts r = 0..K from n[r], how many events have count r (r = 1..K+1): Katz's form of Good-Turing.

    Where the raw n give no proper discount (copies of documents push events from 1 to 2), they are first smoothed by a
    line through log n over log r; with too few of them, or one that falls too slowly, 1 - 1/(2r) stands in.
    """
    n, r = np.asarray(n, float), np.arange(1, K + 1)

    def turing(n: np.ndarray) -> np.ndarray | None:
        common = (K + 1) * n[K + 1] / n[1]
        if not (n[1:] > 0).all() or common >= 1:
            return None
        d = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common)
        return d if ((d > 0) & (d < 1)).all() else None

    with np.errstate(divide="ignore", invalid="ignore"):
        d = turing(n[: K + 2])
    full = np.flatnonzero(n[1 : K + 2] > 0) + 1
    if d is None and len(full) >= 3:
        slope, level = np.polyfit(np.log(full), np.log(n[full]), 1)
        d = turing(np.concatenate(([0.0], np.exp(level + slope * np.log(np.arange(1, K + 2))))))
    return np.concatenate(([0.0], 1 - 0.5 / r if d is None else d))


class Unigrams:
    """The lowest order: counts of all training tokens, summed up in a few numbers."""

    def __init__(self, n: list[int], tokens: int, words: int):
        self.tokens, self.words, self.d = tokens, words, discounts(n)
        self.some = any(n[1 : K + 1])
        kept = tokens - sum((1 - self.d[r]) * r * n[r] for r in range(1, K + 1))
        self.total = tokens if self.some else tokens + 1  # nothing to discount: one event is set aside for the unknown
        self.unknown = 1 - kept / self.total if tokens else 1.0

    def p(self, count: np.ndarray) -> np.ndarray:
        """By count of the word; 0: the class of unknown words."""
        count = np.asarray(count, float)
        return np.where(count > 0, np.where(count <= K, self.d[np.minimum(count, K).astype(int)], 1.0) * count / max(1, self.total), self.unknown)

    def base(self, count: np.ndarray) -> np.ndarray:
        return np.log10((np.asarray(count, float) + 1) / (self.tokens + self.words + 1))


def backoff(context: np.ndarray, below: np.ndarray, seen: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, weight) of contexts: their counts, how many words have counts 1..K after them (rows), and the unigram mass of all that were seen.

    A context in which nothing is discounted sets one event aside. A context without counts leaves all to the lower order.
    """
    r = np.arange(1, K + 1)
    total = np.where(below.sum(axis=1) > 0, context, context + 1).astype(float)
    kept = context - below @ (r * (1 - d[1:]))
    return total, np.where(context > 0, (1 - kept / total) / np.maximum(1 - seen, 1e-300), 1.0)


def probability(levels: list, at: int = -1) -> np.ndarray:
    """Recursively: the discounted estimate where the n-gram was seen, else the context's weight times the next lower order.

    levels, lowest first: an array of probabilities, then (seen, estimate, weight) for each higher order.
    """
    if at % len(levels) == 0:
        return levels[0]
    seen, estimate, weight = levels[at]
    return np.where(seen, estimate, weight * probability(levels, at % len(levels) - 1))


# ---- documents to chunks

_CHUNKS = "chunk long, n long, ids array<long>, learn array<boolean>, sizes array<long>, tokens binary, words binary"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, seq = TaskContext.get().partitionId(), 0
    ids, learn, sizes, tokens = [], [], [], []
    local: defaultdict[bytes, int] = defaultdict()
    local.default_factory = local.__len__
    local[b"\n"] = 0  # the end

    def flush() -> pa.RecordBatch:
        nonlocal seq, ids, learn, sizes, tokens
        index = np.concatenate(tokens)
        order = np.argsort(-np.bincount(index, minlength=len(local)), kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words = np.fromiter((xxhash.xxh64_intdigest(w) for w in local), np.uint64, len(local))
        words[0] = END
        row = [[part << 32 | seq], [len(index)], [ids], [learn], [sizes], [pack(rank[index])], [pack(words[order])]]
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary())
        out = pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds, strict=True)], ["chunk", "n", "ids", "learn", "sizes", "tokens", "words"])
        seq, ids, learn, sizes, tokens = seq + 1, [], [], [], []
        local.clear()
        local[b"\n"] = 0
        return out

    held = 0
    for b in batches:
        for doc_id, raw, train in zip(b.column(0), b.column(1), b.column(2), strict=True):
            words = (raw.as_py() or b"").lower().split()
            ids.append(doc_id.as_py())
            learn.append(train.as_py())
            sizes.append(len(words) + 1)
            tokens.append(np.array([*[local[w] for w in words], 0], np.int32))
            held += len(words) + 1
            if held >= CHUNK:
                yield flush()
                held = 0
    if ids:
        yield flush()


def _table(kind: list, part: list, chunk: list, blob: list, n: list | None = None) -> pa.Table:
    return pa.table([pa.array(kind, pa.int32()), pa.array(part, pa.int64()), pa.array(chunk, pa.int64()), pa.array(blob, pa.binary()), pa.array(n or [None] * len(kind), pa.list_(pa.int64()))], ["kind", "part", "chunk", "blob", "n"])


_ROWS = "kind int, part long, chunk long, blob binary, n array<long>"
_MODEL, _WORDS, _PAIRS = 0, 1, 2  # kinds: a part of the model, answers about words, answers about pairs


class _Chunk:
    """A chunk with the answers about its words."""

    def __init__(self, t: pa.Table, answers: pa.Table | None = None):
        row = t.to_pylist()[0]
        self.chunk, self.ids, self.learn = row["chunk"], row["ids"], np.array(row["learn"], bool)
        self.sizes = np.array(row["sizes"], np.int64)
        self.tokens = unpack(row["tokens"])[0].astype(np.int64)
        self.words = unpack(row["words"])[0].astype(np.uint64)
        if answers is not None:
            got = sorted((r for r in answers.to_pylist() if r["kind"] == _WORDS), key=lambda r: r["part"])
            gid, count = (np.concatenate(z) for z in zip(*(unpack(r["blob"]) for r in got), strict=True))
            order = np.argsort(self.words, kind="stable")
            self.gid, self.count = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
            self.gid[order], self.count[order] = gid.astype(np.int64), count.astype(np.int64)
            self.end = int(np.flatnonzero(self.words == np.uint64(END))[0])

    def trained(self) -> np.ndarray:
        return np.repeat(self.learn, self.sizes)

    def pairs(self, parts: int, hot: int) -> None:
        """Distinct pairs by the slots of their contexts. A context counted more than ``hot`` times has several slots, and its pairs are dealt over them."""
        n = len(self.words)
        gid = np.append(self.gid, 0)  # context 0: the start of a text
        times = np.append(self.count, self.count[self.end])
        slots = np.minimum(times // hot + 1, _SLOT - 1)
        first = np.cumsum(slots) - slots
        owner = np.repeat(np.arange(n + 1), slots)
        nth = np.arange(len(owner)) - first[owner]
        part = (gid[owner] + nth * 7919) % parts
        order = np.lexsort((nth, gid[owner], part))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        before = np.empty(len(self.tokens), np.int64)
        before[1:] = self.tokens[:-1]
        before[np.cumsum(self.sizes) - self.sizes] = n
        slot = rank[first[before] + self.gid[self.tokens] % slots[before]]
        key, self.inverse = np.unique(slot * n + self.tokens, return_inverse=True)
        self.slot, self.word = key // n, key % n
        self.before, self.owner, self.part = before, owner[order], part[order]
        self.slot_id = gid[owner[order]] * _SLOT + nth[order]
        self.times = times


def _ask_words(parts: int):
    """Chunks -> for each part of the hash range the chunk's words there and their counts in training."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                x = _Chunk(pa.Table.from_batches([b.slice(i, 1)]))
                count = np.bincount(x.tokens[x.trained()], minlength=len(x.words))
                order = np.argsort(x.words, kind="stable")
                words, count = x.words[order], count[order]
                part = ((words >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
                bounds = np.searchsorted(part, np.arange(parts + 1))
                full = np.flatnonzero(np.diff(bounds))
                blobs = [pack(words[bounds[p] : bounds[p + 1]], count[bounds[p] : bounds[p + 1]]) for p in full]
                yield _table([_WORDS] * len(full), full.tolist(), [x.chunk] * len(full), blobs).to_batches()[0]

    return run


def _count_words(parts: int):
    def run(t: pa.Table) -> pa.Table:
        part, rows = t["part"][0].as_py(), [(r["chunk"], *unpack(r["blob"])) for r in t.select(["chunk", "blob"]).to_pylist()]
        words = np.concatenate([r[1].astype(np.uint64) for r in rows])
        uniq, inverse = np.unique(words, return_inverse=True)
        count = np.bincount(inverse, np.concatenate([r[2] for r in rows]), len(uniq)).astype(np.int64)
        rank = np.empty(len(uniq), np.int64)
        rank[np.argsort(-count, kind="stable")] = np.arange(len(uniq))
        gid = 1 + rank * parts + part  # frequent words have small numbers
        n = [int((count == r).sum()) for r in range(K + 2)]
        ends = np.cumsum([len(r[1]) for r in rows])
        answers = [pack(gid[k], count[k]) for k in np.split(inverse, ends[:-1])]
        kept = count > 0
        n[0] = int(kept.sum())
        return _table([_MODEL, *[_WORDS] * len(rows)], [part] * (len(rows) + 1), [-1, *[r[0] for r in rows]], [pack(uniq[kept], count[kept]), *answers], [[*n, int(count.sum())], *[None] * len(rows)])

    return run


def _ask_pairs(parts: int, hot: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _Chunk(left, right)
        x.pairs(parts, hot)
        count = np.bincount(x.inverse, x.trained(), len(x.slot)).astype(np.int64)
        ends = np.searchsorted(x.slot, np.arange(len(x.slot_id) + 1))
        bounds = np.searchsorted(x.part, np.arange(parts + 1))
        full, blobs = np.flatnonzero(np.diff(bounds)), []
        for p in full:
            s, e = bounds[p], bounds[p + 1]
            k = slice(ends[s], ends[e])
            ids = x.slot_id[s:e]
            blobs.append(pack(np.diff(ids, prepend=0), np.diff(ends[s : e + 1]), x.gid[x.word[k]], count[k], x.count[x.word[k]]))
        return _table([_PAIRS] * len(full), full.tolist(), [x.chunk] * len(full), blobs)

    return run


def _count_pairs(unigrams: Unigrams):
    def run(t: pa.Table) -> pa.Table:
        part, asked = t["part"][0].as_py(), []
        for r in t.select(["chunk", "blob"]).to_pylist():
            ids, sizes, word, count, of = unpack(r["blob"])
            asked.append((r["chunk"], np.cumsum(ids.astype(np.int64)), sizes.astype(np.int64), word.astype(np.int64), count.astype(np.int64), of.astype(np.int64)))
        slots, at = np.unique(np.concatenate([a[1] for a in asked]), return_inverse=True)
        slot = np.repeat(at, np.concatenate([a[2] for a in asked]))
        word, count, of = (np.concatenate([a[k] for a in asked]) for k in (3, 4, 5))
        order = np.lexsort((word, slot))
        s, w = slot[order], word[order]
        new = np.ones(len(s), bool)
        new[1:] = (s[1:] != s[:-1]) | (w[1:] != w[:-1])
        starts = np.flatnonzero(new)
        total = np.add.reduceat(count[order], starts) if len(starts) else np.zeros(0, np.int64)
        each = np.empty(len(s), np.int64)
        each[order] = total[np.cumsum(new) - 1] if len(starts) else 0
        owner, seen = s[starts], total > 0
        below = np.stack([np.bincount(owner, total == r, len(slots)) for r in range(1, K + 1)]).astype(np.int64)
        mass = np.bincount(owner, np.where(seen, unigrams.p(of[order][starts]), 0.0), len(slots))
        n = [int(seen.sum()), *[int((total == r).sum()) for r in range(1, K + 2)], int(total.sum())]
        blobs, a, b = [], 0, 0
        for x in asked:
            k, mine = at[a : a + len(x[1])], each[b : b + len(x[3])]
            blobs.append(pack(mine, *below[:, k], mass[k]))
            a, b = a + len(x[1]), b + len(x[3])
        model = pack(slots[owner[seen]], w[starts][seen], total[seen])
        return _table([_MODEL, *[_PAIRS] * len(asked)], [part] * (len(asked) + 1), [-1, *[x[0] for x in asked]], [model, *blobs], [n, *[None] * len(asked)])

    return run


def _score(parts: int, hot: int, unigrams: Unigrams, d: np.ndarray):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        x = _Chunk(left, right)
        x.pairs(parts, hot)
        got = sorted((r for r in right.to_pylist() if r["kind"] == _PAIRS), key=lambda r: r["part"])
        answers = [np.concatenate(z) for z in zip(*(unpack(r["blob"]) for r in got), strict=True)]
        pair, below, mass = answers[0].astype(float), np.stack(answers[1:-1]), answers[-1]
        contexts = len(x.words) + 1
        below = np.stack([np.bincount(x.owner, b, contexts) for b in below], axis=1)
        mass = np.bincount(x.owner, mass, contexts)
        total, weight = backoff(x.times, below, mass, d)
        context, counts = x.before, pair[x.inverse]
        count = x.count[x.tokens]
        estimate = np.where(counts <= K, d[np.minimum(counts, K).astype(int)], 1.0) * counts / total[context]
        p = probability([unigrams.p(count), (counts > 0, estimate, weight[context])])
        starts = np.cumsum(x.sizes) - x.sizes
        add = lambda v: np.add.reduceat(v, starts)
        return pa.table({
            "doc_id": pa.array(x.ids, pa.int64()), "held_out": pa.array(~x.learn), "n_tokens": pa.array(x.sizes), "n_known": pa.array(add((count > 0).astype(np.int64))),
            "train_tokens": pa.array(np.full(len(x.sizes), unigrams.tokens)), "base_score": pa.array(add(unigrams.base(count))), "score": pa.array(add(np.log10(p))),
        })

    return run


def _sums(rows: DataFrame) -> list[int]:
    """The n of all model parts, added up: K + 3 numbers."""
    got = rows.filter(F.col("kind") == _MODEL).agg(*[F.coalesce(F.sum(F.col("n")[i]), F.lit(0)).alias(f"n{i}") for i in range(K + 3)]).first()
    return [int(v) for v in got]


def katz(docs: DataFrame, held_out: F.Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores, unigram parts, bigram parts).

    Scores: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, a row for each row of docs; learnt from the rows that
    aren't held out. Null and empty texts are one token, the end. With nothing to learn from every token is unknown and scores 0.
    """
    chunks = c.settle(c.texts(docs, (~held_out).alias("learn")).mapInArrow(_encode, _CHUNKS))
    n_chunks, tokens = chunks.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    n_chunks, parts = max(1, n_chunks), max(1, -(-tokens // PART))  # tasks and parts grow with the corpus, what each of them holds doesn't
    by_part = lambda rows: rows.repartition(parts, "part").groupBy("part")
    by_chunk = lambda rows: rows.repartition(n_chunks, "chunk").groupBy("chunk")
    words = c.settle(by_part(chunks.mapInArrow(_ask_words(parts), _ROWS)).applyInArrow(_count_words(parts), _ROWS))
    sums = _sums(words)
    unigrams = Unigrams([0, *sums[1 : K + 2]], sums[K + 2], sums[0])
    hot = max(200_000, 2 * unigrams.tokens // parts)
    known = words.filter(F.col("kind") == _WORDS)
    requests = by_chunk(chunks).cogroup(by_chunk(known)).applyInArrow(_ask_pairs(parts, hot), _ROWS)
    pairs = c.settle(by_part(requests).applyInArrow(_count_pairs(unigrams), _ROWS))
    d = discounts([0, *_sums(pairs)[1 : K + 2]])
    answers = known.unionByName(pairs.filter(F.col("kind") == _PAIRS))
    scores = by_chunk(chunks).cogroup(by_chunk(answers)).applyInArrow(_score(parts, hot, unigrams, d), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    return scores, words.filter(F.col("kind") == _MODEL), pairs.filter(F.col("kind") == _MODEL)


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """katz() over all documents: a row for each, null and empty texts and repeated rows included; an empty table gives no rows."""
    return katz(c.documents(spark, sf_dir), c.fold(FOLDS) == HELD_OUT)[0]
