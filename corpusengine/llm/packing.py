"""Best-fit packing by matching large items.

Only the *lengths* decide a packing, and there are at most ``capacity`` of them. So the plan is made on counts by
length, a table of bounded size whatever the corpus: pieces above a third of the capacity, of which a sequence
holds at most two, are matched greedily, largest with the largest that fits; smaller pieces go, longest first,
to the tightest gap that takes them. Equal lengths are placed a run of sequences at a time, so the plan is a few
thousand runs. Pieces learn their place from their rank within their length. No text is moved, no piece is
packed apart from the rest, and the packing is that of the whole table.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusengine.llm import _common as c
from corpusengine.llm.bpe import codec

CAPACITY, END = 2048, 0
_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: all full, but the first may be shorter."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document; an empty or null text is the end id alone."""

    def row(doc_id: int | None, raw: bytes | None) -> tuple:
        ids = codec(vocabulary).encode_added((raw or b"").decode("utf-8", "replace"))
        ids.append(END)
        data = np.array(ids, dtype="<u4")
        return doc_id, [(k, s, n, zlib.crc32(data[s : s + n].tobytes())) for k, (s, n) in enumerate(cut(len(ids), capacity))]

    made = c.map_rows(c.texts(docs), row, "doc_id long, p array<struct<piece:int,start:long,length:long,ids_crc32:long>>")
    return made.select("doc_id", F.explode("p").alias("p")).select("doc_id", "p.*")


class _Gaps:
    """Runs of sequences by the room they have left."""

    def __init__(self) -> None:
        self.rooms: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, first: int, n: int) -> None:
        if room and n:
            if room not in self.runs:
                self.rooms.insert(bisect_left(self.rooms, room), room)
                self.runs[room] = []
            self.runs[room].append((first, n))

    def tightest(self, length: int) -> int | None:
        k = bisect_left(self.rooms, length)
        return self.rooms[k] if k < len(self.rooms) else None

    def take(self, room: int) -> tuple[int, int]:
        run = self.runs[room].pop()
        if not self.runs[room]:
            del self.runs[room]
            self.rooms.remove(room)
        return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(length, rank, n, sequence, each, offset): the n pieces from that rank on go to sequences in a row, ``each`` to a sequence, from that offset."""
    left = {n: k for n, k in counts.items() if k}
    rank = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int, int]] = []
    gaps, made = _Gaps(), 0

    def place(length: int, n: int, first: int, each: int, offset: int) -> None:
        out.append((length, rank[length], n, first, each, offset))
        rank[length] += n
        left[length] -= n

    large = sorted(x for x in left if 3 * x > capacity)
    while large:
        a = large[-1]
        k = bisect_left(large, capacity - a + 1) - 1
        if not left[a]:
            large.pop()
        elif k < 0:  # no partner fits
            gaps.add(capacity - a, made, n := left[a])
            place(a, n, made, 1, 0)
            made += n
        elif not left[b := large[k]]:
            large.pop(k)
        elif a == b and left[a] == 1:
            if k:  # itself is no partner; the next smaller is
                b = large[k - 1]
                if not left[b]:
                    large.pop(k - 1)
                    continue
                place(a, 1, made, 1, 0)
                place(b, 1, made, 1, a)
                gaps.add(capacity - a - b, made, 1)
            else:
                place(a, 1, made, 1, 0)
                gaps.add(capacity - a, made, 1)
            made += 1
        else:
            n = left[a] // 2 if a == b else min(left[a], left[b])
            place(a, n, made, 1, 0)
            place(b, n, made, 1, a)
            gaps.add(capacity - a - b, made, n)
            made += n
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            room = gaps.tightest(length)
            if room is None:
                each = capacity // length
                full, rest = divmod(left[length], each)
                if full:
                    place(length, full * each, made, each, 0)
                    gaps.add(capacity - each * length, made, full)
                    made += full
                if rest:
                    place(length, rest, made, rest, 0)
                    gaps.add(capacity - rest * length, made, 1)
                    made += 1
                continue
            first, n = gaps.take(room)
            each = room // length
            full = min(n, left[length] // each)
            used = full
            if full:
                place(length, full * each, first, each, capacity - room)
                gaps.add(room - each * length, first, full)
            if full < n and left[length]:
                rest = left[length]  # fewer than a gap takes
                place(length, rest, first + full, rest, capacity - room)
                gaps.add(room - rest * length, first + full, 1)
                used += 1
            gaps.add(room, first + used, n - used)
    return out


def ranked(made: DataFrame) -> DataFrame:
    """rank: each piece's place among those of its length, from 0, without bringing a length together.

    Pieces are numbered in small buckets by hash; a bucket's first number is what the length's buckets before it hold.
    """
    buckets = max(1, made.rdd.getNumPartitions() * 4)
    parted = made.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "start", "ids_crc32"), F.lit(buckets)))
    inner = Window.partitionBy("bucket", "length").orderBy("doc_id", "piece", "ids_crc32")
    local = parted.withColumn("at", F.row_number().over(inner) - 1)
    held = parted.groupBy("bucket", "length").agg(F.count("*").alias("n"))
    before = held.select("bucket", "length", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return local.join(before, ["bucket", "length"]).withColumn("rank", F.col("at") + F.col("before")).drop("bucket", "at", "before")


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces -> the same rows with sequence_id and offset. made must give the same rows each time (a checkpoint)."""
    spark = made.sparkSession
    counts = {int(r["length"]): int(r["n"]) for r in made.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    runs = pd.DataFrame(sorted(plan(counts, capacity)) or [(0, 0, 0, 0, 1, 0)], columns=["length", "rank", "n", "first", "each", "base"], dtype="int64")
    runs_b = spark.sparkContext.broadcast({k: runs[k].to_numpy() for k in runs})  # a few rows a length

    def assign(frames):
        r = runs_b.value
        starts: dict[int, list[tuple[int, int]]] = {}
        for i, (length, rank) in enumerate(zip(r["length"], r["rank"], strict=True)):
            starts.setdefault(int(length), []).append((int(rank), i))
        by = {k: (np.array([x for x, _ in v]), np.array([i for _, i in v])) for k, v in starts.items()}
        for f in frames:
            length, rank = f["length"].to_numpy(), f["rank"].to_numpy()
            at = np.zeros(len(f), np.int64)
            for n in np.unique(length):
                who = np.flatnonzero(length == n)
                lo, index = by[int(n)]
                at[who] = index[np.searchsorted(lo, rank[who], side="right") - 1]
            k = rank - r["rank"][at]
            f["sequence_id"] = r["first"][at] + k // r["each"][at]
            f["offset"] = r["base"][at] + k % r["each"][at] * length
            yield f[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return ranked(made).mapInPandas(assign, _PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """All pieces of docs in as few sequences as the matching finds.

    Null and empty texts are their end token alone; longer ones than a sequence are cut; repeated rows are packed each; pieces of equal length (ties)
    are interchangeable. No documents: no rows. Columns beside doc_id and text aren't read.
    """
    return pack(c.settle(pieces(docs, vocabulary, capacity)), capacity)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pack_documents() over all documents: a row for each piece; null, empty, repeated and very long texts included; an empty table gives no rows."""
    return pack_documents(c.documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
