"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64 bits by majority over the XXH64 of word shingles. Search: every bit position has a non-zero
vector of r+1 bits; for each non-zero v there is a table whose mask keeps the positions with odd inner product.
The vectors of at most r differing bits span at most r dimensions, so some v is orthogonal to all of them: that
table masks out every differing bit and the pair collides in it. Nothing within the radius is missed, whatever
the data.

Exact repeats meet first (one row a fingerprint), so copies are never expanded. Buckets are compared in streaming
order and give the links of a spanning forest only. A bucket over ``ROOM`` different fingerprints isn't compared
but dealt out again by a second set of masks over the bits that are still free: the same guarantee holds inside
it, and as each level fixes half of the free bits, a bucket of different fingerprints can't stay large.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.llm import _common as c
from corpusengine.llm.components import components

BITS, RADIUS, SHINGLE, SEED = 64, 4, 4, 42
ROOM = 2048
_BLOCK = 1 << 16
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint(raw: bytes | None, width: int = SHINGLE) -> int:
    """Majority bits of the shingles' hashes, unsigned. No words: zero. Fewer words than a shingle: their whole sequence."""
    words = (raw or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - width + 1].tolist()
    stops = ends[width - 1 :].tolist()
    digest, votes = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _BLOCK):
        h = np.array([digest(line[s:e], SEED) for s, e in zip(starts[at : at + _BLOCK], stops[at : at + _BLOCK], strict=True)], dtype=">u8")
        octets = h.view(np.uint8).reshape(-1, 8)
        for k in range(8):
            votes[8 * k : 8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ _BYTE_BITS
    return int.from_bytes(np.packbits(2 * votes > len(starts)).tobytes(), "big")


def masks(radius: int = RADIUS, level: int = 0) -> list[int]:
    """2^(radius+1) - 1 masks; a level deals the vectors to the positions in another order, and every level covers."""
    n = (1 << (radius + 1)) - 1
    vector = [1 + ((i * (2 * level + 1) + i // n * (level + 3) + level) % n) for i in range(BITS)]
    if level:
        order = np.random.RandomState(level).permutation(BITS)
        vector = [vector[i] for i in order]
    return [sum(1 << i for i in range(BITS) if bin(vector[i] & v).count("1") & 1) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _deal(rows: DataFrame, radius: int, level: int) -> DataFrame:
    """(tab, mask, fp, rep) -> a row for each mask of this level: the bits that are fixed so far, and their value."""
    tables = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(_signed(m)).cast("long").alias("m")) for t, m in enumerate(masks(radius, level))])
    out = rows.select("tab", "mask", "fp", "rep", F.explode(tables).alias("x"))
    n = (1 << (radius + 1)) - 1
    out = out.select((F.col("tab") * n + F.col("x.t")).alias("tab"), F.col("mask").bitwiseOR(F.col("x.m")).alias("mask"), "fp", "rep")
    return out.select("tab", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp", "rep")


def _forest(fp: np.ndarray, rep: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member of its component) among at most ROOM different fingerprints."""
    if len(fp) == 2:
        if np.bitwise_count(fp[0] ^ fp[1]) > radius:
            return rep[:0], rep[:0]
        return rep.max(keepdims=True), rep.min(keepdims=True)
    order = np.argsort(rep)
    fp, rep = fp[order], rep[order]
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= radius
    label = np.arange(len(fp), dtype=np.int32)
    while True:
        least = np.where(near, label[None, :], np.int32(len(fp))).min(axis=1)
        least = np.minimum(least, least[least])
        if (least == label).all():
            break
        label = least
    far = np.flatnonzero(label != np.arange(len(fp)))
    return rep[far], rep[label[far]]


_FOUND = "hot boolean, tab long, mask long, fp long, rep long, to long"


def _compare(radius: int, room: int):
    """Over rows sorted by (tab, key): links of each bucket, or the rows of one that holds more than ``room``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["hot", "tab", "mask", "fp", "rep", "to"], [pa.bool_(), *[pa.int64()] * 5]

        def batch(hot: bool, tab, mask, fp, rep, to) -> pa.RecordBatch:
            cols = [np.full(len(rep), hot), tab, mask, fp, rep, to]
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], names)

        held = np.zeros((0, 5), np.int64)  # the last bucket so far; over ``room`` rows it is streamed out
        streaming = None
        for b in batches:
            x = np.concatenate([held, np.column_stack([col.to_numpy(zero_copy_only=False) for col in b.columns]).astype(np.int64, copy=False)])
            new = np.flatnonzero((x[1:, 0] != x[:-1, 0]) | (x[1:, 2] != x[:-1, 2])) + 1
            bounds = np.concatenate(([0], new, [len(x)]))
            last = bounds[-2]
            out, spilt = [], []
            if streaming is not None and len(x) and streaming == (x[0, 0], x[0, 2]):
                spilt.append((0, int(bounds[1])))
                done = 1
            else:
                done = 0
            sizes = np.diff(bounds)
            for k in np.flatnonzero(sizes[:-1] > 1):
                if k < done:
                    continue
                s, e = bounds[k], bounds[k + 1]
                if e - s > room:
                    spilt.append((s, e))
                else:
                    out.append(_forest(x[s:e, 3].view(np.uint64), x[s:e, 4], radius))
            if len(bounds) > 2 or done == 0:
                streaming = None
            if streaming is None and len(x) - last > room:
                streaming = (x[last, 0], x[last, 2])
                spilt.append((last, len(x)))
                held = x[:0]
            elif streaming is not None:
                held = x[:0]
            else:
                held = x[last:]
            for s, e in spilt:
                y = x[s:e]
                yield batch(True, y[:, 0], y[:, 1], y[:, 3], y[:, 4], y[:, 4])
            if out:
                a, m = (np.concatenate(z) for z in zip(*out, strict=True))
                z = np.zeros(len(a), np.int64)
                yield batch(False, z, z, z, a, m)
        if len(held) > 1:
            a, m = _forest(held[:, 3].view(np.uint64), held[:, 4], radius)
            z = np.zeros(len(a), np.int64)
            yield batch(False, z, z, z, a, m)

    return run


def links(fps: DataFrame, radius: int = RADIUS, room: int = ROOM) -> DataFrame:
    """fps: (fp long, rep long), fp unique -> (a, b): links whose components are those of all pairs within the radius."""
    rows = fps.select(F.lit(0).cast("long").alias("tab"), F.lit(0).cast("long").alias("mask"), "fp", "rep")
    found, level = [], 0
    while True:
        dealt = _deal(rows, radius, level).repartition("tab", "key").sortWithinPartitions("tab", "key")
        out = c.settle(dealt.mapInArrow(_compare(radius, room), _FOUND))
        found.append(out.filter(~F.col("hot")).select(F.col("rep").alias("a"), F.col("to").alias("b")))
        rows = out.filter("hot").select("tab", "mask", "fp", "rep")
        if rows.isEmpty():
            break
        level += 1
    links = found[0]
    for more in found[1:]:
        links = links.unionByName(more)
    return links


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint, component_id: a row for each row of docs.

    Texts that are null or hold no word have fingerprint zero and link like any other; very long texts are read whole. Repeated rows give
    repeated rows. A bit set in exactly half of the hashes (a tie) is 0. A null doc_id can't name a component; such a row gets the component
    of its fingerprint, null if none. No documents: no rows. Columns beside doc_id and text aren't read, whatever their names.
    """
    made = c.map_rows(c.texts(docs), lambda doc_id, raw: (doc_id, _signed(fingerprint(raw))), "doc_id long, fp long")
    made = c.settle(made)
    fps = made.groupBy("fp").agg(F.min("doc_id").alias("rep"))
    linked = components(links(fps.filter("rep is not null"), radius))
    classes = fps.join(linked, fps["rep"] == linked["node"], "left").select(F.col("fp").alias("of"), F.coalesce("component", "rep").alias("component_id"))
    out = made.join(classes, made["fp"] == classes["of"])
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


#: Row numbers that are broadcast at most (8 bytes each), by count; beyond it the rows to drop are joined without a hint.
LEAVING = 1_000_000


def single(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of each component, unchanged: the smallest doc_id (null last), then the smallest hash of the row.

    Rows are told apart as rows: of repeated ones one stays, and a group without any doc_id keeps one too. Null, empty and blank texts have
    fingerprint zero and are one group with what else has it. No rows: no rows. What travels is a number for each row that leaves, not the texts.
    """
    rows = c.settle(docs.withColumn("_row", F.monotonically_increasing_id()))  # a checkpoint, so that numbers stay
    made = c.map_rows(c.texts(rows, "_row", F.xxhash64(*docs.columns).alias("_hash")), lambda doc_id, raw, row, key: (_signed(fingerprint(raw)), doc_id, key, row), "fp long, doc_id long, hash long, row long")
    made = c.settle(made)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "hash", "row")).alias("first")
    fps = c.settle(made.groupBy("fp").agg(first))
    linked = components(links(fps.select("fp", F.col("fp").alias("rep")), radius))
    classes = fps.join(linked, fps["fp"] == linked["node"], "left").select("fp", F.coalesce("component", "fp").alias("of"), "first")
    stays = classes.groupBy("of").agg(F.min("first").alias("stays"))
    stays = stays.select(F.col("of").alias("_of"), "stays")
    kept = classes.join(stays, F.bitwise_not("of") == F.bitwise_not("_of")).select("fp", F.col("stays.row").alias("stays"))  # dealt anew, so that a large group can be split
    leaving = c.settle(made.select("fp", "row").join(kept, "fp").filter(F.col("row") != F.col("stays")).select(F.col("row").alias("_row")))
    few = leaving.count() <= LEAVING
    return rows.join(F.broadcast(leaving) if few else leaving, "_row", "left_anti").select(*docs.columns)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """near_duplicates() over all documents: a row for each, null and empty texts and repeated rows included; an empty table gives no rows."""
    return near_duplicates(c.documents(spark, sf_dir))
