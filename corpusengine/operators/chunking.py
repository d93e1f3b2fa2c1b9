"""Chunks of sections: windows of words that end at sentences where they can."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusengine.functions import text as T

_SENTENCE = re.compile(T.SENTENCE_END)


def windows(words: list[str], size: int, overlap: int) -> Iterator[list[str]]:
    """Fixed windows; the one that reaches the end is the last."""
    at, step = 0, max(1, size - overlap)
    while words:
        yield words[at : at + size]
        if at + size >= len(words):
            return
        at += step


def by_sentence(text: str | None, size: int, overlap: int) -> list[list[str]]:
    """Chunks of whole sentences, about ``size`` words, each opening with the last sentences of the one before (about ``overlap`` words, at least one sentence).

    A sentence longer than ``size`` is cut into fixed windows and carries nothing over.
    """
    out: list[list[str]] = []
    held: list[list[str]] = []  # sentences of the chunk that is open
    tail: list[list[str]] = []  # those that the next one will open with
    for sentence in (s.split() for s in _SENTENCE.split(text or "")):
        if not sentence:
            continue
        if len(sentence) > size:
            if held:
                out.append(sum(held, []))
            held, tail = [], []
            out.extend(windows(sentence, size, overlap))
            continue
        if held and sum(map(len, held)) + len(sentence) > size:
            out.append(sum(held, []))
            held, tail = tail, []
        held = [*held, sentence]
        tail = [*tail, sentence]
        while len(tail) > 1 and sum(map(len, tail)) > overlap:
            tail = tail[1:]
    if held:
        out.append(sum(held, []))
    return out


def settings() -> tuple[int, int, bool]:
    """(words, overlap, sentence-aware) from the environment, 220/40/True by default."""
    return int(os.environ.get("CORPUSENGINE_CHUNK_WORDS", "220")), int(os.environ.get("CORPUSENGINE_CHUNK_OVERLAP", "40")), os.environ.get("CORPUSENGINE_CHUNK_SENTENCE_AWARE", "1") != "0"


def chunks(sections: DataFrame, size: int | None = None, overlap: int | None = None, sentence_aware: bool | None = None) -> DataFrame:
    """Rows of doc_sections -> rows of doc_chunks: abstracts and bodies, chunk_id by document in order of sections.

    The sentence fold is an Arrow function, a call a section; fixed windows stay in the JVM.
    """
    d_size, d_overlap, d_aware = settings()
    size, overlap = size or d_size, d_overlap if overlap is None else overlap
    rows = sections.filter(F.col("sec_type").isin("abstract", "body"))
    if d_aware if sentence_aware is None else sentence_aware:

        @F.pandas_udf("array<array<string>>")
        def split(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: by_sentence(t, size, overlap))

        made = split("text")
    else:
        made = T.fixed_chunks(T.words(F.col("text")), size, overlap)
    rows = rows.select("pmcid", "ordinal", "sec_type", "sec_kind", "sec_title", "n_figures", "n_tables", F.posexplode(made).alias("pos", "words"))
    number = F.row_number().over(Window.partitionBy("pmcid").orderBy("ordinal", "pos")) - 1  # a document's chunks only
    return rows.select(
        "pmcid", number.alias("chunk_id"), "sec_type", "sec_kind", "sec_title", F.concat_ws(" ", "words").alias("text"), F.size("words").alias("n_words"),
        (F.col("sec_kind") == "methods").alias("is_methods"), (F.col("sec_kind") == "results").alias("is_results"), "n_figures", "n_tables",
    )
