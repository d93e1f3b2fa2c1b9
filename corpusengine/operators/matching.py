"""Terms in texts: the regular-expression join as an equi-join.

A term of letters matches between non-letters exactly where it is a whole run of letters, and a sequence of words exactly
where it is a run of neighbouring words. So texts are cut into runs (n-grams up to the longest term), terms join them by
equality, and the pattern itself runs on the surviving pairs only, where it gives the count: a match consumes the characters
beside it, so that counts of patterns differ from counts of words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusengine.functions import text as T


def _grams(text: DataFrame, key: list[str], blob: str, pattern: str, longest: int) -> DataFrame:
    parts = F.regexp_extract_all(F.lower(F.coalesce(F.col(blob), F.lit(""))), F.lit(pattern), F.lit(0))
    rows = text.select(*key, parts.alias("_p"))
    every = F.array_distinct(F.col("_p"))
    for n in range(2, longest + 1):
        width = F.lit(n)
        spans = F.transform(F.sequence(F.lit(1), F.greatest(F.size("_p") - (n - 1), F.lit(1))), lambda i: F.concat_ws(" ", F.slice("_p", i, width)))  # noqa: B023  used at once
        every = F.array_union(every, F.when(F.size("_p") >= n, spans).otherwise(F.array().cast("array<string>")))
    return rows.select(*key, F.explode(every).alias("term"))


def mentions(terms: DataFrame, texts: DataFrame, key: list[str], blob: str, *, digits: bool = False, longest: int = 1) -> DataFrame:
    """terms with a column ``term`` x texts: the pairs where the term occurs, once each, without the text.

    digits: terms hold digits and several words (up to ``longest``).
    """
    pattern = "[a-z0-9]+" if digits else "[a-z]+"
    return _grams(texts, key, blob, pattern, longest).join(terms, "term").select(*terms.columns, *key).distinct()


def counted(pairs: DataFrame, texts: DataFrame, key: list[str], blob: str, *, digits: bool = False) -> DataFrame:
    """pairs with n: matches of the term's pattern in the text, at least 1.

    A text meets all the terms found in it at once, so that it moves once and is never repeated.
    """
    pattern = T.name_pattern if digits else T.letter_pattern
    terms = [c for c in pairs.columns if c not in key]
    found = pairs.groupBy(*key).agg(F.collect_list(F.struct(*terms)).alias("_t"))
    rows = found.join(texts.select(*key, F.lower(F.coalesce(F.col(blob), F.lit(""))).alias("_b")), key)
    each = F.transform("_t", lambda t: F.struct(*[t[c].alias(c) for c in terms], F.regexp_count(F.col("_b"), pattern(t["term"])).cast("long").alias("n")))
    out = rows.select(*key, F.explode(each).alias("x"))
    return out.select(*[F.col(c) if c in key else F.col(f"x.{c}") for c in pairs.columns], "x.n").filter("n > 0")


def theta_mentions(terms: DataFrame, texts: DataFrame, key: list[str], blob: str, *, digits: bool = False) -> DataFrame:
    """What mentions() and counted() give, literally: every term against every text, the terms broadcast. For tests only: nothing checks their size."""
    pattern = T.name_pattern(F.col("term")) if digits else T.letter_pattern(F.col("term"))
    rows = texts.select(*key, F.lower(F.coalesce(F.col(blob), F.lit(""))).alias("_b"))
    return rows.join(F.broadcast(terms), F.regexp_like("_b", pattern)).withColumn("n", F.regexp_count("_b", pattern).cast("long")).drop("_b")
