"""Katz scores against brute force; the classifiers by held-out accuracy and on odd rows; the pipeline."""

import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusengine.llm import _common as c
from corpusengine.llm import katz as K
from corpusengine.llm import quality as Q
from corpusengine.llm import toxicity as X

SF = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")


def slow_discounts(counts, k=5):
    """Good-Turing discounts of Katz from the counts of all events, by the book: raw numbers, else those of a least-squares line through their logarithms, else 1 - 1/(2r)."""
    n = {r: sum(x == r for x in counts) for r in range(1, k + 2)}

    def turing(n):
        if min(n.values()) <= 0 or (k + 1) * n[k + 1] >= n[1]:
            return None
        common = (k + 1) * n[k + 1] / n[1]
        d = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, k + 1)]
        return d if all(0 < x < 1 for x in d) else None

    d = turing(n)
    points = [(math.log(r), math.log(x)) for r, x in n.items() if x]
    if d is None and len(points) >= 3:
        mx, my = (sum(z) / len(points) for z in zip(*points, strict=True))
        slope = sum((x - mx) * (y - my) for x, y in points) / sum((x - mx) ** 2 for x, _ in points)
        d = turing({r: math.exp(my + slope * (math.log(r) - mx)) for r in n})
    return [0.0, *(d or [1 - 1 / (2 * r) for r in range(1, k + 1)])]


class Slow:
    """A bigram Katz model in dictionaries, one token at a time."""

    def __init__(self, texts):
        self.one, self.two = Counter(), defaultdict(Counter)
        for t in texts:
            self.one.update(t)
            for a, b in zip([None, *t], t):  # noqa: B905
                self.two[a][b] += 1
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.d1, self.d2 = slow_discounts(list(self.one.values())), slow_discounts([x for w in self.two.values() for x in w.values()])
        total = self.n if any(x <= K.K for x in self.one.values()) else self.n + 1
        self.p1 = {w: (self.d1[x] if x <= K.K else 1) * x / total for w, x in self.one.items()}
        self.unknown = 1 - sum(self.p1.values()) if self.n else 1.0

    def p(self, h, w):
        seen = self.two.get(h)
        low = self.p1.get(w, self.unknown)
        if not seen:
            return low
        total = sum(seen.values()) + (not any(x <= K.K for x in seen.values()))
        d = lambda x: self.d2[x] if x <= K.K else 1
        if w in seen:
            return d(seen[w]) * seen[w] / total
        return (1 - sum(d(x) * x for x in seen.values()) / total) / (1 - sum(self.p1[v] for v in seen)) * low


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), "\n"]


def check(rows, table):
    learn = [tokens(t) for i, t in table if i is None or zlib.crc32(str(i).encode()) % 7 != 2]
    m = Slow(learn)
    want = Counter()
    for i, t in table:
        w = tokens(t)
        score = sum(math.log10(m.p(h, x)) for h, x in zip([None, *w], w))  # noqa: B905
        base = sum(math.log10((m.one[x] + 1) / (m.n + m.v + 1)) for x in w)
        want[i, i is not None and zlib.crc32(str(i).encode()) % 7 == 2, len(w), sum(x in m.one for x in w), m.n, f"{base:.6g}", f"{score:.6g}"] += 1
    got = Counter((*tuple(r)[:5], f"{r['base_score']:.6g}", f"{r['score']:.6g}") for r in rows)
    assert {k: v for k, v in got.items() if k[0] is not None} == {k: v for k, v in want.items() if k[0] is not None} and sum(got.values()) == sum(want.values())
    return m


@pytest.mark.parametrize("chunk,cores", [(3_000_000, 3), (40, 7)])
def test_katz(docs, odd, monkeypatch, chunk, cores):
    """In one chunk a task and in many; the smaller ones also deal frequent contexts over slots."""
    rng = random.Random(chunk)
    words = ["the", "The", "of", "x,", *["w%d" % i for i in range(60)]]
    table = [(i, " ".join(rng.choice(words[: rng.choice([4, 64])]) for _ in range(rng.randrange(60)))) for i in range(150)]
    monkeypatch.setattr(K, "CHUNK", chunk)
    monkeypatch.setattr(K, "PART", 2 * chunk)
    whole = docs(table).repartition(cores)
    m = check(K.katz(whole, c.fold(7) == 2)[0].collect(), table)
    for h in (None, "the", "w1", "never seen"):
        assert abs(sum(m.p(h, w) for w in m.one) + m.p(h, "no such word") - 1) < 1e-9
    odds = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(K.katz(odd, c.fold(7) == 2)[0].collect(), odds)


def test_slots_have_no_effect(docs, monkeypatch):
    rng = random.Random(8)
    table = docs([" ".join(rng.choice(["a", "b", "c", "d%d" % rng.randrange(30)]) for _ in range(50)) for _ in range(80)]).repartition(5)
    monkeypatch.setattr(K, "PART", 700)
    want = sorted(map(tuple, K.katz(table, c.fold(7) == 2)[0].collect()))
    real = K._Chunk.pairs
    monkeypatch.setattr(K._Chunk, "pairs", lambda self, parts, hot: real(self, parts, 20))
    ask, score = K._ask_pairs, K._score
    monkeypatch.setattr(K, "_ask_pairs", lambda parts, hot: ask(parts, 20))
    monkeypatch.setattr(K, "_score", lambda parts, hot, *more: score(parts, 20, *more))
    got = sorted(map(tuple, K.katz(table, c.fold(7) == 2)[0].collect()))
    assert [g[:5] for g in got] == [w[:5] for w in want] and np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


def test_katz_with_nothing_to_learn(docs):
    rows = K.katz(docs(["a b", ""]), F.lit(True))[0].collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in sorted(rows, key=lambda r: r["doc_id"])] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert K.katz(docs([]).limit(0), F.lit(False))[0].collect() == []


def test_discounts():
    d = K.discounts([0, 1000, 300, 140, 80, 50, 35])
    assert d[0] == 0 and (d[1:] > 0).all() and (d[1:] < 1).all()
    common = 6 * 35 / 1000
    assert abs(d[1] - (2 * 300 / 1000 - common) / (1 - common)) < 1e-12
    assert ((s := K.discounts([0, 1000, 900, 140, 80, 50, 35]))[1:] < 1).all() and (s[1:] > 0).all()  # smoothed
    for n in ([1000, 300, 140, 80, 50, 35], [1000, 900, 140, 80, 50, 35], [5, 0, 2, 0, 1, 0], [0, 0, 1, 0, 0, 0], [10, 9, 8, 7, 6, 5]):
        assert np.allclose(K.discounts([0, *n]), slow_discounts([r for r, x in enumerate(n, 1) for _ in range(x)]))
    assert K.discounts([0] * 7).tolist() == [0, 0.5, 0.75, 1 - 1 / 6, 0.875, 0.9]


def test_pack():
    arrays = [np.array([], np.int64), np.array([0, 5, 255]), np.array([2**63, 1], np.uint64), np.array([1.5, -2.0]), np.arange(70_000)]
    assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, K.unpack(K.pack(*arrays)), strict=True))


# ---- classifiers


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_trees_learn_and_flatten():
    rng = np.random.RandomState(3)
    x = rng.rand(3000, 5)
    y = ((x[:, 0] > 0.5) ^ (x[:, 3] > 0.3)).astype(float)
    t = Q.Trees(trees=30, depth=3).fit(x[:2000], y[:2000])
    assert ((t.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.97 and t.feature.shape == (30, 7)

    def walk(v):
        f = t.base
        for k in range(30):
            node = 0
            while node < 7:
                node = 2 * node + 1 + (v[t.feature[k, node]] > t.limit[k, node])
            f += t.value[k, node - 7]
        return 1 / (1 + math.exp(-f))

    assert np.allclose([walk(v) for v in x[:50]], t.score(x[:50]))
    assert Q.Trees().fit(x, np.ones(3000)).score(x[:2]).min() > 0.98 and Q.Trees().score(x[:1]).tolist() == [0.5] and Q.Trees().fit(x[:0], y[:0]).score(x[:0]).tolist() == []


@needs_tables
@pytest.mark.parametrize("classify,label,least", [(Q.classify, "quality", 0.97), (X.classify, "toxic", 0.9)])
def test_held_out_accuracy(spark, classify, label, least):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    out = classify(docs, labels)
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    assert len(rows) > 80 and sum(r["predicted"] == r[label] for r in rows) / len(rows) >= least
    assert out.count() == docs.count()


@pytest.mark.parametrize("classify", [Q.classify, X.classify])
def test_classifiers_on_odd_rows(spark, odd, classify):
    some = labels_of(spark, [(0, 1, 0), (3, 0, 1), (4, 1, 0), (5, None, None), (None, 1, 1), (9, 1, 0), (9, 0, 1)])
    for labels in (some, some.limit(0)):
        rows = classify(odd, labels).collect()
        assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in rows)
        assert {r["held_out"] for r in rows if r["doc_id"] is None} == {False}
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows if r["doc_id"] is not None)
    assert classify(odd.limit(0), some).collect() == []


def test_scores_come_from_the_text_alone(spark, docs):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["good", "fine", "plain", "nasty"] if i % 2 else ["good", "fine", "plain"]) for _ in range(60)) for i in range(120)]
    labels = labels_of(spark, [(i, 1, i % 2) for i in range(120)])
    a = {r["doc_id"]: r["score"] for r in X.classify(docs(texts), labels).collect()}
    b = {r["doc_id"]: r["score"] for r in X.classify(docs(texts).withColumn("lang", F.lit("de")).withColumn("source", F.lit("z")), labels).collect()}
    assert a == b
    held = [i for i in a if zlib.crc32(str(i).encode()) % 3 == 1]
    flipped = labels_of(spark, [(i, 1, 1 - i % 2 if i in held else i % 2) for i in range(120)])
    assert {r["doc_id"]: r["score"] for r in X.classify(docs(texts), flipped).collect()} == a  # held-out labels have no effect
    assert sum((a[i] >= 0.7) == bool(i % 2) for i in held) / len(held) > 0.9


def texts_of(lines):
    """Texts as the network takes them."""
    out = []
    for words in (x.split() for x in lines):
        seen = {w: k for k, w in enumerate(dict.fromkeys(words))}
        out.append((np.array([X.hashed(w) for w in seen], np.int64).reshape(-1, 1 + len(X.PREFIXES)), np.array([seen[w] for w in words], np.int64)))
    return out


def slow_logit(net, words):
    """Word by word: sums of embeddings, every filter at every word (null words after the last one), the maximum, the layer."""
    vectors = [sum(net.e[b].astype(float) for b in X.hashed(w)) for w in words] or [np.zeros(X.DIM)]
    n = len(vectors)
    vectors += [np.zeros(X.DIM)] * (max(X.WIDTHS) - 1)
    out, f = float(net.bias[0]), 0
    for k, width in enumerate(X.WIDTHS):
        for j in range(X.FILTERS):
            top = max(sum(float(vectors[i + p] @ net.w[net.offset[k] + p][:, j].astype(float)) for p in range(width)) for i in range(n))
            out += max(0.0, top + float(net.b[f])) * float(net.out[f])
            f += 1
    return out


def test_convolution_against_plain_loops():
    net, rng = X.Network(), random.Random(1)
    net.b += np.random.RandomState(1).randn(len(net.b)).astype(np.float32) * 0.1
    lines = ["", "one", "two words", *[" ".join(rng.choice(["alpha", "beta", "gammas", "delta"]) + str(rng.randrange(9)) for _ in range(rng.randrange(1, 40))) for _ in range(30)]]
    want = [slow_logit(net, x.split()) for x in lines]
    assert np.allclose(net.logits_of(texts_of(lines)), want, atol=1e-4)
    scorer = X.Scorer(net)
    raw = [x.encode() for x in lines]
    assert np.allclose(scorer(raw), [net.score(f, 0) for f in want], atol=1e-4) and np.allclose([scorer([x])[0] for x in raw], scorer(raw), atol=1e-6)


def test_gradients_by_differences():
    net, rng = X.Network(np.float64), random.Random(2)
    net.b += 0.01  # not at the kink, where an empty text would be
    texts = texts_of(["", *[" ".join(rng.choice("abcdefgh") * rng.randrange(1, 8) for _ in range(rng.randrange(1, 12))) for _ in range(9)]])
    y, weight = np.array([rng.randrange(2) for _ in texts]), np.array([rng.choice([1.0, 2.0]) for _ in texts])

    def loss():
        f = net.logits_of(texts)
        return float((weight * (np.log1p(np.exp(-np.abs(f))) + np.maximum(f, 0) - y * f)).mean())

    grads, bucket, total = net.gradients(texts, y, weight)
    eps = 1e-6
    for name, g in grads.items():
        p = getattr(net, name)
        for at in [tuple(rng.randrange(n) for n in p.shape) for _ in range(25)]:
            old = p[at]
            p[at] = old + eps
            up = loss()
            p[at] = old - eps
            down = loss()
            p[at] = old
            assert abs((up - down) / (2 * eps) - g[at]) < 1e-5, (name, at)
    for _ in range(40):
        k, j = rng.randrange(len(bucket)), rng.randrange(X.DIM)
        old = net.e[bucket[k], j]
        net.e[bucket[k], j] = old + eps
        up = loss()
        net.e[bucket[k], j] = old - eps
        down = loss()
        net.e[bucket[k], j] = old
        assert abs((up - down) / (2 * eps) - total[k, j]) < 1e-5


def test_languages_are_learnt():
    rng = random.Random(3)
    common = {"a": "the of and to in".split(), "b": "der die und das ist".split(), "c": "le la les et des".split()}
    made = [(k, " ".join(rng.choice(words if rng.random() < 0.5 else [f"x{rng.randrange(500)}"]) for _ in range(80))) for k, words in common.items() for _ in range(40)]
    texts = texts_of([t for _, t in made])
    guess = X.Languages(texts)
    found = defaultdict(Counter)
    for (k, _), (ids, index) in zip(made, texts, strict=True):
        found[guess(ids[index, 0])][k] += 1
    assert sum(max(n.values()) for n in found.values()) / len(made) > 0.98 and len(found) >= 3
    assert X.Languages()(np.zeros(0, int)) == guess(np.zeros(0, int)) == 0


def test_sample_is_bounded_and_drawn_from_what_is_there(spark, docs):
    from corpusengine.llm.learning import sample

    outside = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 != 1]
    labels = labels_of(spark, [(i, 1, 0) for i in range(200)])
    there = docs([(i, "some text") for i in outside[50:]] + [(outside[60], "some text"), (outside[61], "some longer text"), (None, "x")])
    got = sample(there, labels, "toxic", 20).collect()
    assert len({r["doc_id"] for r in got}) == 20 and all(bytes(r["text"]) == b"some text" for r in got)
    assert sample(there, labels, "toxic", 20, 95).select("doc_id").distinct().count() == 10
    longest = docs([(outside[0], "w " * 10_000), (outside[1], None)])
    assert {r["doc_id"] for r in sample(longest, labels, "toxic", 20).collect()} == set(outside[:2])  # long texts are learnt from


def test_network_is_learnt_in_a_task(docs, monkeypatch):
    """The sample and what is made of it stay out of the driver, whose memory every stage of the pipeline shares."""
    import corpusengine.llm.toxicity as mine

    spark = docs([]).sparkSession
    texts = [(i, f"some words and {'awful' if i % 3 == 0 else 'kind'} ones") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in texts], "doc_id long, toxic int")

    def here(*_):
        raise AssertionError("learnt in the driver")

    monkeypatch.setattr(mine.Network, "fit", here)
    net = mine.train(docs(texts), labels)
    scores = dict(zip(("awful", "kind"), mine.Scorer(net)([b"some words and awful ones", b"some words and kind ones"]), strict=True))
    assert scores["awful"] >= mine.THRESHOLD > scores["kind"]
    assert mine.train(docs([]), labels).moved.tolist() == [1e3] and mine.train(docs(texts), labels.limit(0)).moved.tolist() == [1e3]


def test_forgetting_has_no_effect(monkeypatch):
    net = X.Network()
    texts = [f"word{i} and word{i + 1} but word{i}".encode() for i in range(30)]
    want = [X.Scorer(net)([t])[0] for t in texts]
    monkeypatch.setattr(X, "_KEPT", 3)
    scorer = X.Scorer(net)
    assert np.allclose([scorer([t])[0] for t in texts], want)


# ---- pipeline


@needs_tables
def test_stages(spark):
    import corpus_pipeline as P
    from corpusengine.llm import packing, rules, secrets, simhash

    assert [n for n, _ in P.STAGES] == ["quality_rules", "toxicity", "near_duplicates", "secrets", "packing"] and P.ORACLE_SQL is None
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good = P.quality_rules(spark, docs, SF).cache()
    assert good.columns == columns and {r["doc_id"] for r in good.collect()} == {r["doc_id"] for r in rules.judge(docs).filter("kept").collect()}
    clean = P.toxic(spark, good, SF).cache()
    gone = {r["doc_id"] for r in good.select("doc_id").exceptAll(clean.select("doc_id")).collect()}
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").filter("toxic = 1").join(good, "doc_id").collect()}
    assert clean.columns == columns and len(gone & toxic) > 0.8 * len(toxic)
    single = P.near_duplicates(spark, clean, SF).cache()
    fp = {r["doc_id"]: simhash.fingerprint((r["text"] or "").encode()) for r in clean.collect()}
    from test_near_duplicates import reach

    ids = sorted(fp)
    want = reach(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if bin(fp[ids[a]] ^ fp[ids[b]]).count("1") <= 4])
    assert single.columns == columns and {r["doc_id"] for r in single.collect()} == {ids[k] for k in set(want)}
    safe = P.secret_scan(spark, single, SF).cache()
    assert safe.columns == columns and safe.count() == single.count()
    for r in safe.collect():
        assert r["n_chars"] == len(r["text"]) and secrets.base_spans(r["text"]) == []
    out = P.best_fit_packing(spark, safe, SF)
    n, tokens_ = out.select("sequence_id").distinct().count(), out.agg(F.sum("length")).first()[0]
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in safe.collect()} and -(-tokens_ // packing.CAPACITY) <= n <= -(-tokens_ // packing.CAPACITY) + 3
    assert P.run(spark, SF).count() == out.count()


def test_pipeline_on_odd_rows(spark, docs, odd, tmp_path):
    """Null, empty, blank, short, long, repeated and nameless rows: what is left after every stage, row by row."""
    import corpus_pipeline as P

    rng = random.Random(6)
    prose = lambda: "\n".join(" ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(3, 8))) for _ in range(12)).capitalize() + "." for _ in range(10))
    one, two, three, long = prose(), prose(), prose(), "\n".join(prose() for _ in range(300))
    secret = f"{two}\npassword = hunter2hunter2"
    odds = [tuple(r) for r in odd.select("doc_id", "text").collect()]
    rows = [*odds, (50, one), (50, one), (51, one), (None, one), (52, secret), (None, three), (None, three), (53, long)]
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    table = docs(rows)
    table.write.parquet(str(tmp_path / "documents.parquet"))
    want = [
        [x for x in rows if x[1] in (one, secret, three, long)],  # odd texts are too short or repeat themselves
        [x for x in rows if x[1] in (one, secret, three, long)],  # no labels, nothing learnt
        [(50, one), (52, secret), (None, three), (53, long)],
        [(50, one), (52, f"{two}\n[assign]"), (None, three), (53, long)],
    ]
    for (name, stage), left in zip(P.STAGES, want, strict=False):
        table = stage(spark, table, str(tmp_path)).cache()
        assert sorted(((r["doc_id"], r["text"]) for r in table.collect()), key=repr) == sorted(left, key=repr), name
        assert table.columns == P.COLUMNS
    packed = P.STAGES[-1][1](spark, table, str(tmp_path)).collect()
    assert {r["doc_id"] for r in packed} == {50, 52, None, 53} and sum(r["piece"] == 0 for r in packed) == 4
    key = lambda r: (str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, P.run(spark, str(tmp_path)).collect())) == sorted(map(key, packed))
    empty = docs([]).limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, str(tmp_path)).collect() == []


@pytest.mark.parametrize("room", [1_000_000, 0])
def test_one_row_of_each_group_stays(spark, docs, tmp_path, monkeypatch, room):
    import corpus_pipeline as P
    from corpusengine.llm import simhash

    monkeypatch.setattr(simhash, "LEAVING", room)  # with and without a broadcast

    text = lambda k: " ".join(f"word{k}x{i}" for i in range(80))
    rows = [(7, text(1))] * 3 + [(9, text(1)), (None, text(1)), (7, text(2)), (None, text(3)), (None, text(4)), (None, text(4)), (5, text(5))]
    kept = P.near_duplicates(spark, docs(rows), str(tmp_path)).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted([(7, text(1)), (7, text(2)), (None, text(3)), (None, text(4)), (5, text(5))], key=str)
    assert P.near_duplicates(spark, docs([]).limit(0), str(tmp_path)).collect() == []
