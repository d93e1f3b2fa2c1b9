"""Keyed upserts and clustering by a shared key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keyed_merge(old: DataFrame, batch: DataFrame, keys: list[str], order: str) -> DataFrame:
    """old with the batch merged in: of each key the batch's row, and within either the last by ``order``. A null key is a key.

    Only the winning rows' keys are ranked in one shuffle; rows go along.
    """
    rows = old.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.desc("_new"), F.desc_nulls_last(order))
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_new")


def added(old: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the batch that old has not, each once."""
    a, b = batch.select(*keys).distinct().alias("a"), old.select(*keys).distinct().alias("b")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}"))
    return a.join(b, same, "left_anti")


def rank_of(column: Column, order: list[str], otherwise: int = 9) -> Column:
    """Position of a value in a list of preferences."""
    out = F.lit(otherwise)
    for i, value in reversed(list(enumerate(order))):
        out = F.when(column == value, i).otherwise(out)
    return out


def clusters(rows: DataFrame, row_id: str, key: Column, preference: Column) -> DataFrame:
    """rows with cluster_id (the key, or the row's own id where it has none) and is_primary (the preferred row of its cluster).

    A cluster's primary is its least (preference, id), an aggregate, so that no cluster has to fit in one task; rows that have no key are alone and pass by.
    """
    keyed = rows.withColumn("cluster_id", F.coalesce(key.cast("string"), F.col(row_id).cast("string")))
    best = keyed.groupBy("cluster_id").agg(F.min(F.struct(preference.alias("p"), F.col(row_id).alias("i"))).alias("best"))
    return keyed.join(best, "cluster_id").withColumn("is_primary", F.col(row_id) == F.col("best.i")).drop("best")


def cluster_stats(clustered: DataFrame) -> DataFrame:
    out = clustered.agg(F.count("*").alias("rows"), F.countDistinct("cluster_id").alias("clusters"))
    return out.withColumn("duplicates", F.col("rows") - F.col("clusters"))
