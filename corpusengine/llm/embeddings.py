"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are normalised in double precision and turned into their principal axes (a rotation, so cosines stay).
Repeated vectors meet first. Tiles are cells of a tree that halves the space along the leading axes, cut into blocks
of bounded size; the boxes of two blocks tell whether any pair in them can reach the threshold. Inside a pair of blocks
the leading dimensions are multiplied first, with the product of the suffix norms added as one more dimension: that is
an upper bound of the cosine, and only pairs whose bound reaches the threshold go on, some dimensions at a time, as long as
the sum so far and the suffix norms can still reach it. Pairs within rounding of the threshold are decided on the vectors as
they were given. Links are counted, never listed; a block pair gives each linked vector's count and a spanning forest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.llm import _common as c
from corpusengine.llm.components import components

#: BLOCK, BLOCK_BYTES: vectors of a block and their bytes at most (by expectation); smaller ones only while there are fewer pairs of blocks than tasks to run.
#: SAMPLE, SAMPLE_BYTES: vectors that the tree is cut by, and their bytes, at most: eight a cell, so that cells grow with the corpus up to there.
THRESHOLD, BLOCK, LEAST_BLOCK, STRIP, LEAD, STEP, BOX = 0.95, 32_768, 1024, 128, 16, 16, 8
BLOCK_BYTES, SAMPLE, SAMPLE_BYTES = 1 << 24, 8192, 1 << 26
_EPS = 1e-9  # what rotation and summation may lose, and much more


def _clean(vectors: DataFrame) -> DataFrame:
    """vec_id, key, v: v is the vector in doubles, null where it can link with nothing; key is equal for equal vectors."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))

    def row(vec_id: int | None, v: list | None) -> tuple:
        if vec_id is None or not v or any(x is None for x in v):
            return vec_id, None, None
        x = np.array(v, float) + 0.0
        if not np.isfinite(x).all() or not x.any():
            return vec_id, None, None
        return vec_id, hashlib.blake2b(x.tobytes(), digest_size=16).digest(), x.tobytes()

    return c.map_rows(rows, row, "vec_id long, key binary, v binary", step=4096)


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)  # no overflow in the norm
    return v / np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]


def _stack(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), float).reshape(len(blobs), -1)


def axes(groups: DataFrame, dim: int) -> np.ndarray:
    """Principal axes of all vectors of this length, largest first: partitions send sums of products, d(d+1)/2 rows each."""

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            if b.num_rows:
                x = _unit(_stack(b.column("v").to_pylist()))
                total += x.T @ x
        i, j = np.triu_indices(dim)
        yield pa.RecordBatch.from_arrays([pa.array(i * dim + j), pa.array(total[i, j])], ["k", "s"])

    summed = groups.select("v").mapInArrow(gram, "k long, s double").groupBy("k").agg(F.sum("s").alias("s")).toArrow()
    full = np.zeros(dim * dim)
    full[summed["k"].to_numpy()] = summed["s"].to_numpy()
    full = full.reshape(dim, dim)
    return np.linalg.eigh(full + np.triu(full, 1).T)[1][:, ::-1].copy()


def tree(sample: np.ndarray, depth: int) -> list[np.ndarray]:
    """Medians along the leading axes in turn, of a bounded sample: level by level, 2^level cuts each."""
    cell, cuts = np.zeros(len(sample), np.int64), []
    for level in range(depth):
        x = sample[:, level % min(BOX, sample.shape[1])]
        cut = np.array([np.median(x[cell == k]) if (cell == k).any() else 0.0 for k in range(2**level)])
        cuts.append(cut)
        cell = 2 * cell + (x > cut[cell])
    return cuts


def _cells(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    cell = np.zeros(len(x), np.int64)
    for level, cut in enumerate(cuts):
        cell = 2 * cell + (x[:, level % min(BOX, x.shape[1])] > cut[cell])
    return cell


def _roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray) -> np.ndarray:
    """root: for each of n nodes the least known node of its component; joins it along the links (a, b)."""
    while True:
        ra, rb = root[a], root[b]
        far = ra != rb
        if not far.any():
            return root
        hi, lo = np.maximum(ra[far], rb[far]), np.minimum(ra[far], rb[far])
        np.minimum.at(root, hi, lo)
        while not (root[root] == root).all():
            root = root[root]


def _suffix(z: np.ndarray, at: int) -> np.ndarray:
    """Lengths of the vectors without their first dimensions."""
    return np.sqrt(np.einsum("ij,ij->i", z[:, at:], z[:, at:]))


def compare(x: np.ndarray, y: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Index pairs (of x, of y) that may reach the threshold, with their cosines: all that do, and others only within _EPS below. Bounded pairs at a time.

    same: y is x, pairs i < j.
    """
    dim, lead = x.shape[1], min(LEAD, x.shape[1])
    steps = list(range(lead, dim, STEP))
    left, right = ([_suffix(z, at) for at in [*steps, dim]] for z in (x, y))
    xb, yb = np.column_stack([x[:, :lead], left[0]]), np.column_stack([y[:, :lead], right[0]]).T.copy()
    for s in range(0, len(x), STRIP):
        start = s if same else 0
        upper = xb[s : s + STRIP] @ yb[:, start:]
        i, j = np.nonzero(upper >= threshold - _EPS)
        rest = upper[i, j]
        i, j = i + s, j + start
        if same:
            keep = i < j
            i, j, rest = i[keep], j[keep], rest[keep]
        for k in range(0, len(i), 1 << 16):
            a, b, so_far = i[k : k + (1 << 16)], j[k : k + (1 << 16)], rest[k : k + (1 << 16)]
            so_far = so_far - left[0][a] * right[0][b]  # the leading dimensions alone
            for n, at in enumerate(steps):
                so_far = so_far + np.einsum("ij,ij->i", x[a, at : at + STEP], y[b, at : at + STEP])
                can = so_far + left[n + 1][a] * right[n + 1][b] >= threshold - _EPS
                a, b, so_far = a[can], b[can], so_far[can]
                if not len(a):
                    break
            if len(a):
                yield a, b, so_far


def _decided(maybe: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """maybe: (rep, other), pairs too near the threshold to tell -> links of those that reach it, by the cosine of the vectors as they were given."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            out = []
            for a, b, n, m, v, w in zip(*(t.column(k).to_pylist() for k in ("rep", "other", "n", "m", "v", "w")), strict=True):
                p, q = np.frombuffer(v), np.frombuffer(w)
                with np.errstate(over="ignore", invalid="ignore"):
                    cosine = float(p @ q) / (float(np.sqrt(p @ p)) * float(np.sqrt(q @ q)) or np.nan)
                if not np.isfinite(cosine):  # too large or too small to be squared
                    cosine = float(_unit(p[None, :])[0] @ _unit(q[None, :])[0])
                if cosine >= threshold:
                    out += [(a, m, min(a, b)), (b, n, min(a, b))]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], ["rep", "links", "root"])

    left = groups.select("rep", "n", "v")
    right = groups.select(F.col("rep").alias("other"), F.col("n").alias("m"), F.col("v").alias("w"))
    return maybe.select("rep", "other").join(left, "rep").join(right, "other").mapInArrow(decide, "rep long, links long, root long")


def links(groups: DataFrame, threshold: float) -> DataFrame:
    """groups: (rep long, n long, v binary), v different -> (rep, links, root): links counts vectors, root is a linked node or rep itself."""
    spark = groups.sparkSession
    out = None
    lengths = groups.select((F.length("v") / 8).cast("int").alias("d")).distinct().collect()  # a table has one, or few
    for dim in sorted(r["d"] for r in lengths):
        some = groups.filter(F.length("v") == 8 * dim)
        found = c.settle(_links(some, dim, threshold))
        sure = found.filter("other is null").drop("other")
        sure = sure.unionByName(_decided(found.filter("other is not null"), some, threshold))
        out = sure if out is None else out.unionByName(sure)
    return spark.createDataFrame([], "rep long, links long, root long") if out is None else out


def _links(groups: DataFrame, dim: int, threshold: float) -> DataFrame:
    spark = groups.sparkSession
    rotation = axes(groups, dim)
    n = groups.count()
    most = max(2, min(BLOCK, BLOCK_BYTES // (8 * dim)))
    size = int(np.clip(n / np.sqrt(6 * spark.sparkContext.defaultParallelism), min(LEAST_BLOCK, most), most))
    depth = max(0, int(np.ceil(np.log2(max(1, n / size)))))
    room = max(SAMPLE, SAMPLE_BYTES // (8 * dim))
    depth = min(depth, int(np.log2(room // 8)))
    picked = groups.orderBy(F.xxhash64("rep")).limit(min(room, max(SAMPLE, 8 << depth))).select("v").toArrow()["v"].to_pylist()
    model = spark.sparkContext.broadcast((rotation, tree(_unit(_stack(picked)) @ rotation, depth)))  # d x d, and the cuts

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, cuts = model.value
        for b in batches:
            if b.num_rows:
                x = _unit(_stack(b.column("v").to_pylist())) @ q
                yield pa.RecordBatch.from_arrays([pa.array(_cells(x, cuts)), b.column("rep"), b.column("n"), pa.array([z.tobytes() for z in x], pa.binary())], ["cell", "rep", "n", "x"])

    placed = c.settle(groups.select("rep", "n", "v").mapInArrow(place, "cell long, rep long, n long, x binary"))
    sizes = placed.groupBy("cell").agg(F.count("*").alias("held"))  # a row for each cell: an eighth of the sample at most
    blocked = placed.join(F.broadcast(sizes), "cell").select((F.col("cell") * (1 << 20) + F.pmod(F.xxhash64("rep"), F.ceil(F.col("held") / size))).alias("block"), "rep", "n", "x")

    def box(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                t = pd.DataFrame(_stack(b.column("x").to_pylist())[:, :BOX])
                g = t.groupby(b.column("block").to_numpy())
                lo, hi = g.min(), g.max()
                yield pa.RecordBatch.from_arrays([pa.array(lo.index.to_numpy()), pa.array(lo.to_numpy().tolist(), pa.list_(pa.float64())), pa.array(hi.to_numpy().tolist(), pa.list_(pa.float64()))], ["block", "lo", "hi"])

    lead = min(BOX, dim)
    ends = blocked.select("block", "x").mapInArrow(box, "block long, lo array<double>, hi array<double>").groupBy("block")
    boxes = ends.agg(F.array(*[F.min(F.col("lo")[k]) for k in range(lead)]).alias("lo"), F.array(*[F.max(F.col("hi")[k]) for k in range(lead)]).alias("hi"))
    boxes = c.settle(boxes)  # a row for each block
    # Blocks meet in strips of the leading axis as wide as two linked vectors can be apart there; of those, only boxes that are near enough.
    width = float(np.sqrt(max(0.0, 2 - 2 * threshold))) + 1e-6
    strips = lambda reach: F.explode(F.sequence(F.floor((F.col("lo")[0] - reach) / width), F.floor((F.col("hi")[0] + reach) / width)))
    a = boxes.select(F.col("block").alias("a"), F.col("lo").alias("alo"), F.col("hi").alias("ahi"), strips(0.0).alias("strip"))
    b = boxes.select(F.col("block").alias("b"), F.col("lo").alias("blo"), F.col("hi").alias("bhi"), strips(width).alias("strip"))
    gap = F.aggregate(F.zip_with(F.zip_with("alo", "bhi", lambda p, q: p - q), F.zip_with("blo", "ahi", lambda p, q: p - q), lambda p, q: F.greatest(p, q, F.lit(0.0))), F.lit(0.0), lambda s, d: s + d * d)
    pairs = a.join(b, "strip").filter("a <= b").filter(gap <= width * width).select("a", "b").distinct()
    sides = pairs.select(F.col("a"), F.col("b"), F.explode(F.when(F.col("a") == F.col("b"), F.array("a")).otherwise(F.array("a", "b"))).alias("block"))
    met = sides.join(blocked, "block").select("a", "b", "block", "rep", "n", "x")

    def meet(t: pa.Table) -> pa.Table:
        first, second = t["a"][0].as_py(), t["b"][0].as_py()
        block, rep, count = (t[k].to_numpy() for k in ("block", "rep", "n"))
        order = np.argsort(rep, kind="stable")
        block, rep, count = block[order], rep[order], count[order]
        x = _stack(t["x"].to_pylist())[order]
        mine, theirs = np.flatnonzero(block == first), np.flatnonzero(block == second)
        linked, root, near = np.zeros(len(rep), np.int64), np.arange(len(rep)), []
        for i, j, cosine in compare(x[mine], x[theirs], threshold, first == second):
            i, j = mine[i], theirs[j]
            sure = cosine >= threshold + _EPS
            near.append(np.column_stack([rep[i[~sure]], rep[j[~sure]]]))
            i, j = i[sure], j[sure]
            linked += np.bincount(i, count[j], len(rep)).astype(np.int64) + np.bincount(j, count[i], len(rep)).astype(np.int64)
            root = _roots(len(rep), i, j, root)
        got = np.flatnonzero(linked)
        near = np.concatenate(near) if near else np.zeros((0, 2), np.int64)
        none = [None] * len(near)
        return pa.table([pa.array([*rep[got], *near[:, 0]], pa.int64()), pa.array([*linked[got], *none], pa.int64()), pa.array([*rep[root[got]], *none], pa.int64()), pa.array([None] * len(got) + list(near[:, 1]), pa.int64())], ["rep", "links", "root", "other"])

    return met.groupBy("a", "b").applyInArrow(meet, "rep long, links long, root long, other long")


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each row of vectors.

    A vector that is null, empty or zero, or that holds a null or non-finite component, links with nothing, nor does one without
    vec_id or of another length. Repeated rows are vectors of their own and link with each other. A cosine of exactly the threshold (a tie)
    is a link, by the vectors as they were given in double precision. Columns beside vec_id and embedding aren't read. No vectors: no rows.
    """
    made = c.settle(_clean(vectors))
    groups = made.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("v").alias("v"))
    found = c.settle(links(c.settle(groups.select("rep", "n", "v")), threshold))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    classes = groups.select("key", "rep", "n").join(counts, "rep", "left").join(joined, F.col("rep") == F.col("node"), "left")
    classes = classes.select("key", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = made.select("vec_id", "key").join(classes, "key", "left")
    out = out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """near_duplicates() over all embeddings: a row for each, null, zero and repeated vectors included; an empty table gives no rows."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
