"""Quality rules by weak supervision.

Each rule votes good, bad or abstains. Expectation-maximisation over the counts of vote patterns (3^rules at
most, and far fewer in fact, however many documents) estimates how often each rule is right on good and on bad
documents, and the posterior probability of each pattern replaces all-must-pass filtering. Rules overlap, so that
a kind of bad document draws several bad votes and a rule that errs is outvoted. Nothing is clipped: a rule may
turn out to be wrong on any share of either class. What fixes which class is the good one is that most rules
beat chance. A fixed base test (too short, too repetitive) overrules a good verdict.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.llm import _common as c
from corpusengine.llm.stats import NAMES, stats


#: Where expectation-maximisation starts: the share of good documents, and how often a voting rule is right on good and on bad ones.
PRIOR = (0.9, 0.95, 0.4)
COUNTS = 4.0  # documents that the start weighs
#: Documents, as a share of a class, that the rules' common accuracy weighs in each rule's own (partial pooling): no rule counts
#: as unfailing for want of a mistake so far, whatever the number of documents.
POOL = 0.2


def _ratio(a: str, b: str) -> Column:
    return F.col(f"_s.{a}") / F.greatest(F.col(f"_s.{b}"), F.lit(1))


def rules() -> list[tuple[str, Column, Column]]:
    """(name, votes good, votes bad) of a row with its statistics in _s; neither: it abstains."""
    length, symbols, marks = _ratio("word_chars", "n_words"), _ratio("n_symbols", "n_words"), _ratio("n_marks", "n_words")
    dup, repeat = _ratio("n_dup_lines", "n_lines"), _ratio("n_repeat_words", "n_words")
    upper, distinct, same, top = _ratio("n_upper", "n_letters"), _ratio("n_distinct", "n_words"), _ratio("n_same_next", "n_words"), _ratio("top_word", "n_words")
    letters, digits = _ratio("n_letters", "n_chars"), _ratio("n_digits", "n_chars")
    marked, bare = _ratio("n_symbol_words", "n_words"), _ratio("n_letterless", "n_words")
    some = F.col("_s.n_words") >= 20  # shares of fewer words say little
    return [
        ("length", F.col("_s.n_words") >= 60, F.col("_s.n_words") < 25),
        ("word_length", (length > 4.2) & (length < 6.2), (length < 3.6) | (length > 6.8)),
        ("letters", letters > 0.76, letters < 0.74),
        ("symbols", symbols < 0.02, symbols > 0.1),
        ("symbol_words", marked < 0.02, marked > 0.1),
        ("letterless", bare < 0.05, bare > 0.15),
        ("marks", marks < 0.03, marks > 0.15),
        ("lines", (F.col("_s.n_lines") >= 3) & (dup < 0.1), (F.col("_s.n_lines") >= 3) & (dup > 1 / 3)),
        ("repeats", some & (repeat < 0.1), some & (repeat > 0.25)),
        ("capitals", upper < 0.06, upper > 0.2),
        ("runs", some & (same < 0.025), some & (same > 0.06)),
        ("top_word", some & (top < 0.1), some & (top > 0.2)),
        ("distinct", some & (distinct > 0.55), some & (distinct < 0.45)),
        ("digits", digits < 0.02, digits > 0.1),
    ]


def fit(patterns: list[tuple[str, int]], rounds: int = 1000) -> tuple[dict[str, float], np.ndarray, float]:
    """patterns: (votes as a string of + - 0, documents). Returns the posterior of good by pattern, accuracies [class, rule] and the prior of good.

    A rule is right on a good document with one probability and on a bad one with another, given that it votes at all; an
    abstention says nothing of the document. An accuracy is the share of right votes, with the class's common accuracy and the
    start (PRIOR) counted in as POOL and COUNTS say.
    """
    if not patterns:
        return {}, np.zeros((2, 0)), PRIOR[0]
    n = np.array([k for _, k in patterns], float)
    plus, minus = (np.array([[v == sign for v in p] for p, _ in patterns], float) for sign in "+-")
    start = np.array([[PRIOR[2]], [PRIOR[1]]])  # of bad, of good
    accuracy, prior, good = np.repeat(start, plus.shape[1], axis=1), PRIOR[0], np.zeros(len(n))
    for _ in range(rounds):
        log_good = plus @ np.log(accuracy[1]) + minus @ np.log(1 - accuracy[1]) + np.log(prior)
        log_bad = plus @ np.log(1 - accuracy[0]) + minus @ np.log(accuracy[0]) + np.log(1 - prior)
        new = 1 / (1 + np.exp(np.clip(log_bad - log_good, -700, 700)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
        w_good, w_bad = n * good, n * (1 - good)
        right = np.stack([w_bad @ minus, w_good @ plus])
        voted = np.stack([w_bad @ (minus + plus), w_good @ (minus + plus)])
        size = np.stack([w_bad.sum(), w_good.sum()])[:, None]
        common = (right.sum(axis=1, keepdims=True) + COUNTS * start) / (voted.sum(axis=1, keepdims=True) + COUNTS)
        accuracy = (right + POOL * size * common + COUNTS * start) / (voted + POOL * size + COUNTS)
        prior = float((w_good.sum() + COUNTS * PRIOR[0]) / (n.sum() + COUNTS))
    if (accuracy.sum(axis=0) > 1).mean() < 0.5:  # the classes have changed places: most rules would do worse than chance
        good, accuracy, prior = 1 - good, 1 - accuracy[::-1], 1 - prior
    return {p: float(g) for (p, _), g in zip(patterns, good, strict=True)}, accuracy, prior


_STATS = "struct<" + ",".join(f"{n}:bigint" for n in NAMES) + ">"


def _measured(docs: DataFrame) -> DataFrame:
    """docs with _s (the text's statistics), _votes and _failed (the base test)."""

    def run(texts: pa.Array) -> pa.Array:
        cols = zip(*(stats(t.as_py()) for t in texts), strict=True)
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols] or [pa.array([], pa.int64())] * len(NAMES), NAMES)

    once = F.arrow_udf(run, _STATS).asNondeterministic()  # else filters and votes would each measure the text
    counted = once(F.col("text").cast("string").cast("binary"))
    votes = F.concat(*[F.when(good, "+").when(bad, "-").otherwise("0") for _, good, bad in rules()])
    failed = (F.col("_s.n_words") < 50) | (100 * F.col("_s.n_repeat_words") > 50 * F.col("_s.n_words"))
    return docs.withColumn("_s", counted).withColumn("_votes", votes).withColumn("_failed", failed)


def _posterior(votes: DataFrame) -> DataFrame:
    """votes, quality: the posterior of every vote pattern of these documents; their number is bounded by the rules, here and on the driver."""
    seen = sorted((r["_votes"], int(r["n"])) for r in votes.groupBy("_votes").agg(F.count("*").alias("n")).collect())
    posterior, _, _ = fit(seen)
    return votes.sparkSession.createDataFrame(sorted(posterior.items()), "_votes string, quality double")


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, quality: a row for each row of docs.

    Null and empty texts have no words, fail the base test and aren't kept. Very long texts are measured whole. Repeated rows and
    equal votes (ties) are judged alike; a posterior of exactly 0.5 keeps. No rows: no rows. Columns beside doc_id and text aren't read.
    """
    wide = _measured(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    made = c.settle(wide.select("doc_id", *[F.col(f"_s.{n}") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], F.col("_failed").alias("base_failed"), "_votes"))
    out = made.join(F.broadcast(_posterior(made)), "_votes", "left")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", (~F.col("base_failed") & (F.col("quality") >= 0.5)).alias("kept"), "quality")


def keep(docs: DataFrame) -> DataFrame:
    """The rows of docs that judge() keeps, unchanged. Texts are read and measured twice, so that they are never shuffled."""
    known = _posterior(_measured(docs.select("text")).select("_votes")).filter("quality >= 0.5").select("_votes")
    return _measured(docs).filter(~F.col("_failed")).join(F.broadcast(known), "_votes", "left_semi").drop("_s", "_votes", "_failed")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """judge() over all documents: a row for each, null and empty texts, repeated rows and very long texts included; an empty table gives no rows."""
    return judge(c.documents(spark, sf_dir))
