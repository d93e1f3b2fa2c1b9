"""Documents: landed manifests to admitted documents, clusters, sections and chunks. One lazy plan a layer, each written once."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from corpusengine.functions import text as T
from corpusengine.operators import chunking, merge, quality, relational, retrieval
from corpusengine.schemas import schema
from corpusengine.sources.parsers import parsed
from corpusengine.store import Store

#: Sources in order of preference for a cluster's primary row.
SOURCES = ["europepmc", "openalex", "arxiv", "patents", "surechembl", "epo_ops", "google_patents"]


def candidates(store: Store) -> DataFrame:
    """Manifest lines with their raw documents; lines whose file is gone are passed over. _at orders lines as manifests sort.

    A source's manifests are pieces of one, a landing each: of a document's lines in them the last counts.
    """
    spark = store.spark
    pattern = store.raw("*", "manifest*.jsonl")
    if not store._fs.globStatus(store._path(pattern)):
        return spark.createDataFrame([], schema("manifest")).withColumns({"raw_xml": F.lit(""), "_at": F.struct(F.lit(""), F.lit(0).cast("long"))})
    lines = spark.read.schema(schema("manifest")).json(pattern).select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_line"))
    folder = F.element_at(F.split("_file", "/"), -2)
    last = lines.groupBy(folder.alias("_folder"), "pmcid").agg(F.max(F.struct("_file", "_line")).alias("_last"))
    lines = lines.join(last.select("_last._file", "_last._line"), ["_file", "_line"], "left_semi")
    base = F.regexp_extract("xml_file", r"(?:^|.*/)raw/(.*)$", 1)
    tail = F.when(base != "", base).otherwise(F.concat_ws("/", F.element_at(F.split("_file", "/"), -2), F.element_at(F.split("xml_file", "/"), -1)))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.{xml,json}").option("recursiveFileLookup", "true").load(store.raw())
    files = files.select(F.regexp_extract("path", r".*/raw/(.*)$", 1).alias("_tail"), F.make_valid_utf8(F.col("content").cast("string")).alias("raw_xml"))
    return lines.withColumn("_tail", tail).join(files, "_tail").withColumn("_at", F.struct("_file", "_line")).drop("_tail", "_file", "_line")


def judge(rows: DataFrame, limits: quality.Thresholds | None = None) -> DataFrame:
    """Candidates parsed once, measured and judged: columns sections, body_words, reasons, checks."""
    words = F.aggregate(F.filter("sections", lambda s: s["sec_type"] == "body"), F.lit(0), lambda n, s: n + T.word_count(s["text"]))
    return quality.gate(parsed(rows).withColumn("body_words", words), limits)


def latest(rows: DataFrame, key: str = "pmcid") -> DataFrame:
    """Of each key the last line: keys and places are compared first, documents join what is left of them."""
    last = rows.groupBy(key).agg(F.max("_at").alias("_at"))
    return rows.join(last, [key, "_at"], "left_semi")


def sections(rows: DataFrame) -> DataFrame:
    """A row for each section in order."""
    out = rows.select("pmcid", F.posexplode("sections").alias("ordinal", "s")).select("pmcid", "ordinal", "s.*")
    return out.withColumn("sec_kind", T.section_kind(F.col("sec_type"), F.col("sec_title"))).withColumn("n_words", T.word_count(F.col("text")))


def clusters(documents: DataFrame) -> DataFrame:
    """Documents that share a DOI are one paper; its primary row comes from the preferred source."""
    doi = F.nullif(F.lower(F.trim("doi")), F.lit(""))
    rows = documents.select("pmcid", "source", doi.alias("doi_norm"))
    return merge.clusters(rows, "pmcid", F.col("doi_norm"), merge.rank_of(F.col("source"), SOURCES))


def build(store: Store, limits: quality.Thresholds | None = None) -> dict[str, int]:
    """All layers from what has landed. stored counts admitted lines, documents different ids."""
    judged = judge(candidates(store), limits).persist()
    good, bad = judged.filter("reasons = ''"), judged.filter("reasons <> ''")
    stored = good.count()
    kept = latest(good).withColumn("pub_year", F.trim("pub_year").try_cast("int"))
    docs = store.write("documents_raw", kept)
    rejected = latest(bad).withColumn("rejected_at", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX"))
    store.write("documents_rejected", rejected)
    made = store.write("doc_sections", sections(kept))
    judged.unpersist()
    store.write("doc_clusters", clusters(docs))
    parts = store.write("doc_chunks", chunking.chunks(made))
    stats = merge.cluster_stats(store.read("doc_clusters")).first()
    return {"stored": stored, "documents": docs.count(), "rejected": store.read("documents_rejected").count(), "sections": made.count(), "chunks": parts.count(), "clusters": stats["clusters"], "duplicates": stats["duplicates"]}


def report(store: Store, k: int = 10) -> dict[str, list]:
    """Counts, years, journals and subject terms of the corpus."""
    docs, secs, parts = store.read("documents_raw"), store.read("doc_sections"), store.read("doc_chunks")
    rows = lambda df: [tuple(r) for r in df.collect()]  # noqa: E731  a few rows each
    return {
        "documents": rows(docs.agg(F.count("*"), F.count_if("has_body"), F.countDistinct("journal"))),
        "sections": rows(secs.groupBy("sec_type").agg(F.count("*").alias("n"), F.sum("n_words")).orderBy(F.desc("n"), "sec_type")),
        "chunks": rows(parts.agg(F.count("*"), F.sum("n_words"), F.count_if("is_methods"))),
        "years": rows(docs.groupBy("pub_year").agg(F.count("*").alias("n")).orderBy(F.desc_nulls_last("pub_year")).limit(k)),
        "journals": rows(docs.filter("journal is not null").groupBy("journal").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "journal").limit(k)),
        "mesh": rows(relational.top_values(docs.filter("mesh is not null"), "mesh", ";", k)),
    }


def search(store: Store, term: str, k: int = 10) -> list[dict]:
    """Chunks that hold the term."""
    joined = store.read("doc_chunks").join(store.read("documents_raw").select("pmcid", "title"), "pmcid")
    return [r.asDict() for r in retrieval.search(joined, term, ["pmcid", "chunk_id", "title", "sec_title"]).orderBy("pmcid", "chunk_id").limit(k).collect()]


def quarantine(store: Store) -> dict[str, int]:
    return {r["reason"]: r["documents"] for r in quality.rollup(store.read("documents_rejected")).collect()}  # the gate's reasons


def checks_of(row: dict) -> dict:
    return json.loads(row["checks"])
