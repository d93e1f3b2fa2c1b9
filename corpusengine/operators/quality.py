"""The admission gate: candidate records are admitted, or quarantined with every reason in a fixed order."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusengine.functions import text as T

# Titles and phrases of retraction notices.
RETRACTED_TITLE = r"(?i)^\s*(retracted|retraction|withdrawn|withdrawal|(editorial )?expression of concern)\b[:\s.-]"
RETRACTED_ABSTRACT = "(?i)this article has been (withdrawn|retracted|removed)"


@dataclass(frozen=True)
class Thresholds:
    """Limits of the gate. from_env(): CORPUSENGINE_Q_<NAME> overrides each; a value that is no number is ignored."""

    min_title_chars: float = 8
    min_body_words: float = 40
    min_abstract_words: float = 10
    year_min: float = 1500
    year_max: float = 2100
    min_alpha_ratio: float = 0.5
    max_repeat_ratio: float = 0.6

    @classmethod
    def from_env(cls) -> Thresholds:
        got = {}
        for f in fields(cls):
            try:
                got[f.name] = float(os.environ[f"CORPUSENGINE_Q_{f.name.upper()}"])
            except (KeyError, ValueError):
                continue
        return cls(**got)


def reasons(limits: Thresholds) -> Column:
    """Array of reasons; empty: admitted. Columns: pmcid, title, abstract, pub_year, has_body, body_words (null: not measured)."""
    title, abstract, name = (T.stripped(F.col(c)) for c in ("title", "abstract", "pmcid"))
    year_text = F.col("pub_year").cast("string")
    year = F.trim(year_text).try_cast("bigint")
    has_body, words = F.coalesce("has_body", F.lit(False)), F.col("body_words")
    broken = has_body & words.isNotNull() & ((words == 0) | (words < limits.min_body_words))
    usable = T.word_count(F.col("abstract")) >= limits.min_abstract_words
    sample = F.concat_ws(" ", F.nullif(title, F.lit("")), F.nullif(abstract, F.lit("")))
    garbage = (sample != "") & ((T.letter_ratio(sample) < limits.min_alpha_ratio) | (T.repeat_ratio(sample) > limits.max_repeat_ratio))
    return F.array_compact(F.array(
        F.when(title == "", "missing_title").when(F.length(title) < limits.min_title_chars, "title_too_short"),
        F.when(name == "", "bad_id"),
        F.when(year_text.isNotNull() & (year.isNull() | (year < limits.year_min) | (year > limits.year_max)), "year_out_of_range"),
        F.when(title.rlike(RETRACTED_TITLE) | F.substring(abstract, 1, 300).rlike(RETRACTED_ABSTRACT), "withdrawn_or_retracted"),
        F.when(broken, "body_missing").when(~has_body & ~usable, "no_indexable_content"),
        F.when(garbage, "garbage_text"),
    ))


def gate(records: DataFrame, limits: Thresholds | None = None) -> DataFrame:
    """records with reasons (joined by ;, empty if admitted) and checks (JSON of what was measured)."""
    checks = F.to_json(F.struct(F.length(T.stripped(F.col("title"))).alias("title_chars"), T.word_count(F.col("abstract")).alias("abstract_words"), F.col("body_words"), F.coalesce("has_body", F.lit(False)).alias("has_body"), F.col("pub_year").alias("year")), {"ignoreNullFields": "false"})
    return records.withColumn("reasons", F.array_join(reasons(limits or Thresholds.from_env()), ";")).withColumn("checks", checks)


def rollup(judged: DataFrame) -> DataFrame:
    """How many records each reason keeps out."""
    rows = judged.filter("reasons <> ''").select(F.explode(F.split("reasons", ";")).alias("reason")).filter("reason <> ''")
    return rows.groupBy("reason").agg(F.count("*").alias("documents"))
