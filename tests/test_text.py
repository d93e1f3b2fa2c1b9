import random

import pytest
from pyspark.sql import functions as F

from corpusengine.functions import scores as S
from corpusengine.functions import text as T
from corpusengine.operators import chunking
from corpusengine.operators import matching as M


def values(spark, rows, expr, ddl="t string"):
    return [r[0] for r in spark.createDataFrame([(x,) if not isinstance(x, tuple) else x for x in rows], ddl).select(expr).collect()]


def test_drug_norm(spark):
    cases = {"(R)-Methadone": "methadone", "rac-Fenfluramine": "fenfluramine", "D-Amphetamine": "amphetamine", "NALOXONE HYDROCHLORIDE DIHYDRATE": "naloxone", "water": None, "abc": None, "": None, None: None, "sodium chloride": "sodium"}
    assert values(spark, list(cases), T.drug_norm(F.col("t"))) == list(cases.values())


def test_drug_term(spark):
    assert values(spark, ["Narcan", "two words", "x-12", "abcd", None], T.drug_term(F.col("t"))) == ["narcan", None, None, None, None]


def test_words_split_like_python(spark):
    odd = ["a b　c\x1cd", "  ", "", None, "one\ttwo\nthree", " x "]
    assert values(spark, odd, T.word_count(F.col("t"))) == [len((x or "").split()) for x in odd]


def test_ratios(spark):
    assert values(spark, ["abc 123", "", "   ", None, "é1"], F.round(T.letter_ratio(F.col("t")), 3)) == [0.5, 1.0, 1.0, 1.0, 0.5]
    assert values(spark, ["x " * 30, "x " * 10, "a b " * 10, None], T.repeat_ratio(F.col("t"))) == [1.0, 0.0, 0.5, 0.0]


def test_section_kind(spark):
    got = values(spark, [("body", "2. Materials and Methods"), ("body", "RESULTS"), ("body", "Results and Discussion"), ("body", None), ("title", "methods"), ("abstract", None), ("body", "Prior work")], T.section_kind(F.col("a"), F.col("b")), "a string, b string")
    assert got == ["methods", "results", "results", "body", "title", "abstract", "related"]


def test_fixed_chunks_overlap(spark):
    text = " ".join(f"w{i}" for i in range(500))
    got = values(spark, [text, "", "a b"], T.fixed_chunks(T.words(F.col("t")), 220, 40))
    assert got[0][0][-40:] == got[0][1][:40] and sum(len(c) - 40 for c in got[0]) + 40 == 500
    assert got[1:] == [[], [["a", "b"]]]
    assert got[0] == list(chunking.windows(text.split(), 220, 40))


def test_sentence_chunks():
    text = " ".join(f"Sentence number {i} has several words in it." for i in range(20))
    got = chunking.by_sentence(text, 20, 6)
    assert len(got) > 1 and all(c[-1].endswith(".") for c in got) and all(c[0] == "Sentence" for c in got)
    assert got[0][-8:] == got[1][:8]  # the last sentence goes along even if it is longer than the overlap
    assert [len(c) for c in chunking.by_sentence(" ".join(["w"] * 50), 20, 5)] == [20, 20, 20]
    assert chunking.by_sentence("", 20, 5) == chunking.by_sentence(None, 20, 5) == []


def test_protein_terms(spark):
    got = values(spark, [("OPRM1", "Mu opioid receptor; receptor; MOR; MOR-1; alpha beta"), ("ABC", None), (None, "Kinase"), ("AB", "")], T.protein_terms(F.col("g"), F.col("a")), "g string, a string")
    assert got == [["oprm1", "mu opioid receptor"], ["abc"], [], []]


def test_inverted_index(spark):
    df = spark.createDataFrame([({"Mathematical": [0], "models": [1], "of": [2, 4], "addiction": [3]},), ({},), (None,)], "m map<string,array<int>>")
    assert [r[0] for r in df.select(T.inverted_to_text(F.col("m"))).collect()] == ["Mathematical models of addiction of", None, None]


def test_scores(spark):
    df = spark.createDataFrame([(True, 1), (False, 1), (False, 2), (True, None)], "m boolean, n bigint")
    assert [tuple(r) for r in df.select(S.link_score(F.col("m"), F.col("n")), S.confidence(F.col("m"), F.col("n"))).collect()] == [(0.941, "strong"), (0.341, "weak"), (0.515, "strong"), (0.6, "strong")]


def test_snippet(spark):
    assert values(spark, ["x" * 100 + "NEEDLE" + "y" * 200], F.length(T.snippet(F.col("t"), "needle"))) == [180]


@pytest.mark.parametrize("digits", [False, True])
def test_equi_join_is_the_theta_join(spark, digits):
    rng = random.Random(5)
    texts = spark.createDataFrame([(i, "".join(rng.choice("ab1 -Ab\n") for _ in range(rng.randrange(40)))) for i in range(300)] + [(300, None), (301, "aa aa aa")], "id int, t string")
    terms = spark.createDataFrame([(t,) for t in (["a", "ab", "aa"] if not digits else ["a", "ab", "a1", "a b", "b a b"])], "term string")
    fast = M.counted(M.mentions(terms, texts, ["id"], "t", digits=digits, longest=3 if digits else 1), texts, ["id"], "t", digits=digits)
    slow = M.theta_mentions(terms, texts, ["id"], "t", digits=digits)
    key = lambda df: sorted((r["term"], r["id"], r["n"]) for r in df.collect())
    assert key(fast) == key(slow) != []
    if not digits:
        assert ("aa", 301, 2) in key(fast)  # a match takes the blank after it
