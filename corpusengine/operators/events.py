"""Events: raw to cleaned to daily metrics, and the reports on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Event types and their weights.
EVENT_TYPES = [("view", 50), ("click", 25), ("add_to_cart", 12), ("signup", 5), ("purchase", 8)]


def generate(spark: SparkSession, n: int, seed: int = 0) -> DataFrame:
    """A seeded stand-in for a real feed; an event's id depends on its index alone, so that two seeds collide and one event stays."""
    total = sum(w for _, w in EVENT_TYPES)
    draw = lambda salt, m: F.pmod(F.xxhash64(F.col("id"), F.lit(seed), F.lit(salt)), F.lit(m))
    kind, upto, at = F.lit(None).cast("string"), draw("type", total), 0
    for name, weight in EVENT_TYPES:
        kind = F.when((upto >= at) & (upto < at + weight), F.lit(name)).otherwise(kind)
        at += weight
    countries = F.array(*[F.lit(x) for x in ("US", "GB", "DE", "IN", "BR", "JP")])
    out = spark.range(n).select(
        F.format_string("evt_%08d", "id").alias("event_id"), F.format_string("user_%04d", draw("user", 500)).alias("user_id"), kind.alias("event_type"),
        F.get(countries, draw("country", 6).cast("int")).alias("country"), F.date_format(F.timestamp_seconds(F.lit(1735689600) + draw("ts", 30 * 86400)), "yyyy-MM-dd'T'HH:mm:ssXXX").alias("ts"), (draw("value", 19500) / 100 + 5).alias("value"),
    )
    return out.withColumn("value", F.when(F.col("event_type") == "purchase", F.col("value")))


def earliest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key: the first by the order. Filters belong below it."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def clean(raw: DataFrame) -> DataFrame:
    """Events with an id and a time, the earliest of each id; types in lower case, countries in upper case. Unreadable values and times are null."""
    folded = {"event_type": F.lower("event_type"), "country": F.upper("country")}
    cols = [F.col(c) for c in ("event_id", "user_id")] + [v.alias(k) for k, v in folded.items() if k in raw.columns]
    rows = raw.select(*cols, F.col("value").try_cast("double").alias("value"), F.col("ts").try_cast("timestamp").alias("ts"))
    rows = rows.filter(F.col("event_id").isNotNull() & F.col("ts").isNotNull())
    rest = [F.col(c).asc_nulls_last() for c in rows.columns if c not in ("event_id", "ts")]
    return earliest(rows, ["event_id"], [F.col("ts"), *rest]).withColumn("event_date", F.to_date("ts"))


def daily(events: DataFrame) -> DataFrame:
    return events.groupBy("event_date", "event_type").agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("unique_users"), F.round(F.sum("value"), 2).alias("revenue"))


def totals(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("total_events"), F.countDistinct("user_id").alias("unique_users"), F.round(F.sum("value"), 2).alias("total_revenue"))


def by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"), F.countDistinct("user_id").alias("users")).orderBy(F.desc("events"), "event_type")


def top_revenue(events: DataFrame, by: str, k: int = 5) -> DataFrame:
    return events.groupBy(by).agg(F.round(F.sum("value"), 2).alias("revenue"), F.count("*").alias("events")).orderBy(F.desc_nulls_last("revenue"), by).limit(k)


def daily_revenue(metrics: DataFrame) -> DataFrame:
    """The gold table added up by date."""
    return metrics.groupBy("event_date").agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.sum("events").alias("events")).orderBy("event_date")
