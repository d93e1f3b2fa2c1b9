"""Shapes of queries that the analyses share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusengine.functions import scores as S


def star(center: DataFrame, key: str, arms: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """center with, for each arm (name, edges, what), how many different ``what`` its edges have for the key; 0 where none.

    Each arm is aggregated before it joins, so that arms never multiply. Null values don't count.
    """
    out = center
    for name, edges, what in arms:
        counts = edges.select(key, what).filter(F.col(what).isNotNull()).distinct().groupBy(key).agg(F.count("*").alias(name))
        out = out.join(counts, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def graded(meta: DataFrame, body: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs mentioned in metadata (meta: keys) and in bodies (body: keys and n) as links with confidence and score."""
    m = meta.select(*keys).distinct().withColumn("_m", F.lit(True))
    out = m.join(body.select(*keys, "n"), keys, "full_outer").withColumn("in_metadata", F.coalesce("_m", F.lit(False))).withColumn("n_body", F.coalesce("n", F.lit(0)))
    return out.select(*keys, "in_metadata", "n_body", S.confidence(F.col("in_metadata"), F.col("n_body")).alias("confidence"), S.link_score(F.col("in_metadata"), F.col("n_body")).alias("score"))


def bridge(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Both sides' pairs through a shared key; repeated edges go before the join."""
    return left.distinct().join(right.distinct(), key).distinct()


def without(rows: DataFrame, other: DataFrame, key: str, other_key: str) -> DataFrame:
    """Rows whose key is not among the other's keys; rows without a key stay out, null keys of the other don't count."""
    keys = other.select(F.col(other_key).alias(key)).filter(F.col(key).isNotNull()).distinct()
    return rows.filter(F.col(key).isNotNull()).join(keys, key, "left_anti")


def top_values(rows: DataFrame, column: str, separator: str, k: int) -> DataFrame:
    """The k most frequent values of a column of joined values."""
    terms = rows.select(F.explode(F.split(column, separator)).alias("term")).select(F.trim("term").alias("term")).filter("term <> ''")
    return terms.groupBy("term").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "term").limit(k)


def joined_text(rows: DataFrame, keys: list[str], order: str, text: str) -> DataFrame:
    """The texts of each key in order, with blanks between. The result is one text a key, so a key's texts have to fit in a row."""
    items = F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t"))))
    return rows.filter(F.col(text).isNotNull()).groupBy(*keys).agg(F.concat_ws(" ", F.transform(items, lambda x: x["t"])).alias("blob"))
