"""SimHash, components and embedding near-duplicates against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from corpusengine.llm import components as C
from corpusengine.llm import embeddings as E
from corpusengine.llm import simhash as S


def reach(n, near):
    """Smallest index reachable, for each of n."""
    root = list(range(n))

    def find(a):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        return a

    for a, b in near:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "A", "A b C d", "a b c d e", "Ä É x y z w", "rep rep rep rep rep rep rep", "w1 w2\x0bw3\x1cw4 w5 w6 w7 " * 50])
def test_fingerprint(text):
    assert S.fingerprint(None if text is None else text.encode()) == slow_fingerprint(text)


def test_blocks_have_no_effect(monkeypatch):
    text = " ".join(str(i % 97) for i in range(500)).encode()
    want = S.fingerprint(text)
    monkeypatch.setattr(S, "_BLOCK", 7)
    assert S.fingerprint(text) == want


@pytest.mark.parametrize("level", [0, 1, 2, 3])
def test_masks_cover_every_difference(level):
    masks, rng = S.masks(level=level), random.Random(level)
    assert len(masks) == 31 and all(28 <= bin(m).count("1") <= 36 for m in masks)
    for _ in range(20_000):
        d = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
        assert any(not m & d for m in masks)


@pytest.mark.parametrize("room", [2048, 64])
def test_links_against_all_pairs(spark, room):
    """Chains, a dense ball and random fingerprints; with little room, buckets are dealt out anew."""
    rng, fps = random.Random(room), set()
    for _ in range(12):
        f = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 14)):
            fps.add(f)
            for b in rng.sample(range(64), rng.randint(1, 5)):
                f ^= 1 << b
    center = rng.getrandbits(64)
    fps |= {center ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(400)}
    fps = sorted(fps)
    rng.shuffle(fps)
    df = spark.createDataFrame([(S._signed(f), i) for i, f in enumerate(fps)], "fp long, rep long")
    got = {r["node"]: r["component"] for r in C.components(S.links(df, room=room)).collect()}
    want = reach(len(fps), [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 4])
    assert [got.get(i, i) for i in range(len(fps))] == want and len(set(want)) > 5


def test_a_bucket_over_many_batches():
    """The rows of hot and other buckets, whatever the batches that they come in: one bucket of 30, one of 3, single ones."""
    rows = [(0, 0, 1, 8 + k, k) for k in range(30)] + [(0, 0, 2, 99, 50)] + [(1, 0, 5, 1 << (8 * k), 60 + k) for k in range(3)] + [(1, 0, 6, 7, 70), (2, 0, 1, 3, 80), (2, 0, 1, 2, 81)]
    for room in (2, 3, 29, 30, 100):
        seen = set()
        for size in range(1, len(rows) + 1):
            batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[at : at + size], strict=True)], list("abcde")) for at in range(0, len(rows), size)]
            out = [r for b in S._compare(4, room)(iter(batches)) for r in b.to_pylist()]
            hot = sorted(r["rep"] for r in out if r["hot"])
            assert hot == ([] if room >= 30 else list(range(30))) + ([60, 61, 62] if room < 3 else [])
            seen.add(tuple(sorted((r["rep"], r["to"]) for r in out if not r["hot"])))
        assert len(seen) == 1 and (81, 80) in next(iter(seen))


def test_near_duplicates(docs, odd):
    rng = random.Random(3)
    base = [" ".join(rng.choice("abcdefgh") * 3 for _ in range(400)) for _ in range(6)]
    texts = [t if k % 2 else t + " tail" for t in base for k in range(4)] + [None, ""]
    got = {r["doc_id"]: r for r in S.near_duplicates(docs(texts)).collect()}
    fp = [slow_fingerprint(t) for t in texts]
    want = reach(len(texts), [(a, b) for a in range(len(texts)) for b in range(a) if bin(fp[a] ^ fp[b]).count("1") <= 4])
    assert [got[i]["component_id"] for i in range(len(texts))] == want
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{f:016x}" for f in fp]
    rows = S.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add(r["component_id"])
    assert by[0] == by[1] == by[2] == {0} and by[5] == by[6] == {5} and by[3] == {3} and by[None] == {None, 0}


def test_empty(docs, spark):
    assert S.near_duplicates(docs([]).limit(0)).collect() == []
    assert C.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components(spark):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 180)] + [(rng.randrange(200, 300), rng.randrange(200, 300)) for _ in range(70)] + [(5, 5), (None, 3), (7, 6)]
    got = {r["node"]: r["component"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = reach(300, real)
    assert got == {n: want[n] for n in {x for e in real for x in e}}


# ---- embeddings


def vectors_of(rng, n, dim, groups):
    x = rng.randn(n, dim)
    at = 0
    for size, noise in groups:
        x[at : at + size] = x[at] + noise * rng.randn(size, dim)
        at += size
    return x


def frame(spark, vectors):
    return spark.createDataFrame([(i, None if v is None else [float(c) if c is not None else None for c in v], 1, "x", 7) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>, label int, key string, rep long").repartition(3)


def brute(vectors, t=0.95):
    ok = [i for i, v in enumerate(vectors) if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v) and np.any(np.array(v, np.float32))]
    x = {i: np.array(vectors[i], np.float32).astype(float) for i in ok}
    near = [(a, b) for a in ok for b in ok if b < a and len(x[a]) == len(x[b]) and x[a] @ x[b] / np.sqrt((x[a] @ x[a]) * (x[b] @ x[b])) >= t]
    return [sum(i in p for p in near) for i in range(len(vectors))], reach(len(vectors), near)


@pytest.mark.parametrize("block,strip", [(4096, 256), (16, 5)])
def test_embeddings(spark, monkeypatch, block, strip):
    monkeypatch.setattr(E, "BLOCK", block)
    monkeypatch.setattr(E, "STRIP", strip)
    rng = np.random.RandomState(block)
    v = list(vectors_of(rng, 150, 24, [(40, 0.02), (12, 0.2), (9, 0.14), (2, 0.0)]))
    v += [v[60], 3 * v[60], -v[60], None, np.zeros(24), [float("nan")] * 24, [None] + [1.0] * 23, [float("inf")] + [1.0] * 23, [], [1.0, 0.0], [2.0, 0.01], [1e-38] * 24]
    got = {r["vec_id"]: r for r in E.near_duplicates(frame(spark, v)).collect()}
    links, roots = brute(v)
    assert [got[i]["n_links"] for i in range(len(v))] == links and [got[i]["component_id"] for i in range(len(v))] == roots
    assert all(r["kept"] == (i == roots[i]) for i, r in got.items()) and max(links) >= 39


def test_ties_are_links(spark):
    """Cosines of exactly 19/20, and a hair below: by the vectors as given, not by what rotation makes of them."""
    rng = np.random.RandomState(9)
    tie, below = [19.0, 5.0, 3.0, 2.0, 1.0], [19.0, 5.0, 3.0, 2.0, np.nextafter(1.0, 2) + 1e-12]
    v = [[1.0, 0, 0, 0, 0], tie, [0, 1.0, 0, 0, 0], [5.0, 19.0, 1.0, 3.0, 2.0], [0, 0, 0, 0, -3.0], [-2.0, 3.0, 1.0, 5.0, -19.0], *rng.randn(60, 5).tolist()]
    links, roots = brute(v)
    assert links[1] >= 1 and links[3] >= 1 and links[5] >= 1
    df = lambda v: spark.createDataFrame([(i, [float(c) for c in x]) for i, x in enumerate(v)], "vec_id long, embedding array<double>").repartition(3)
    got = {r["vec_id"]: r for r in E.near_duplicates(df(v)).collect()}
    assert [got[i]["n_links"] for i in range(len(v))] == links and [got[i]["component_id"] for i in range(len(v))] == roots
    assert [r["n_links"] for r in E.near_duplicates(df([v[0], below])).collect()] == [0, 0]
    assert {r["n_links"] for r in E.near_duplicates(df([[1e200, 0, 0, 0, 0], [19e200, 5e200, 3e200, 2e200, 1e200]])).collect()} <= {0, 1}  # too large to be squared


def test_blocks_are_bounded_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK_BYTES", 8 * 24 * 10)
    monkeypatch.setattr(E, "LEAST_BLOCK", 1)
    v = list(vectors_of(np.random.RandomState(4), 150, 24, [(40, 0.02), (12, 0.2)]))
    got = {r["vec_id"]: r["n_links"] for r in E.near_duplicates(frame(spark, v)).collect()}
    assert [got[i] for i in range(len(v))] == brute(v)[0]


def test_embeddings_odd_tables(spark):
    assert E.near_duplicates(frame(spark, [[1.0, 2.0]]).limit(0)).collect() == []
    assert [tuple(r) for r in E.near_duplicates(frame(spark, [None, []])).orderBy("vec_id").collect()] == [(0, 0, 0, True), (1, 0, 1, True)]
    twice = spark.createDataFrame([(4, [1.0, 1.0]), (4, [1.0, 1.0]), (None, [1.0, 1.0]), (9, [2.0, 2.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, E.near_duplicates(twice).collect()), key=str) == [(4, 2, 4, True), (4, 2, 4, True), (9, 2, 4, False), (None, 0, None, False)]


def test_bound_misses_nothing():
    rng = np.random.RandomState(2)
    x = E._unit(vectors_of(rng, 300, 40, [(80, 0.1), (50, 0.16), (30, 0.18)]))
    s = x @ x.T
    for same, want in ((True, np.argwhere(np.triu(s >= 0.95, 1))), (False, np.argwhere(s >= 0.95 + 1e-12))):
        found = [p for i, j, c in E.compare(x, x, 0.95, same) for p in zip(i.tolist(), j.tolist(), c.tolist())]
        got = [p[:2] for p in found]
        assert all(abs(s[i, j] - c) < 1e-12 and c >= 0.95 - 1e-9 for i, j, c in found)
        assert {tuple(p) for p in want.tolist()} <= set(got) and len(got) == len(set(got))
