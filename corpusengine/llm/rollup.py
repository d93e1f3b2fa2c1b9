"""Token counts as delta-maintained rollups.

Inserts, deletes and revised counts are signed rows; a batch of them is summed by source, language and tokenizer
version before anything is kept, and totals are additive: the sum of the committed batches. A batch is written
under its own name and becomes part of the totals by one rename, so that a batch that is sent twice, or a job that
dies half-way and runs anew, counts once. Compaction adds batches up in a base, by one rename too. The registered
query's tokenizers are DataFrame functions; a BPE vocabulary can be counted beside them on the same scan.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusengine.llm import _common as c
from corpusengine.llm.bpe import codec

KEYS = ["source", "lang", "tokenizer"]
SUMS = ["n_docs", "n_tokens", "n_text_chars"]
#: Tokenizer version -> tokens of a text. Both classes hold the same characters in Java's and in other engines' regular expressions.
TOKENIZERS = {"words-1": r"[^\x20\x09-\x0D]+", "marks-1": r"[0-9A-Za-z]+|[^\x00-\x7F]+|[!-/:-@\[-`{-~]"}


def _bpe_tokens(vocabulary: str):
    """Tokens of a text (as bytes) by a vocabulary file; a null text has none."""

    def run(texts: pa.Array) -> pa.Array:
        coder = codec(vocabulary)
        return pa.array([len(coder.encode((x.as_py() or b"").decode("utf-8", "replace"))) for x in texts], pa.int64())

    return F.arrow_udf(run, "long")


def versions(text: Column, bpe: str | None = None) -> Column:
    """An array: for each tokenizer version its name, the tokens of the text, and the text's characters. bpe: a vocabulary file that counts as one more version."""
    counts = {v: F.regexp_count(text, F.lit(p)).cast("long") for v, p in sorted(TOKENIZERS.items())}
    if bpe:
        counts[f"bpe:{bpe.rsplit('/', 1)[-1]}"] = _bpe_tokens(bpe)(text.cast("binary"))
    return F.array(*[F.struct(F.lit(v).alias("tokenizer"), n.alias("n_tokens"), F.length(text).cast("long").alias("n_text_chars")) for v, n in counts.items()])


def counted(docs: DataFrame, bpe: str | None = None) -> DataFrame:
    """One scan of the texts: doc_id, source, lang, ``whole`` and ``trimmed`` (the text without its repeated lines; null where it has none).

    A null text is empty; null sources and languages are keys like any other; very long texts are counted whole; repeated rows count as often as
    they are there. No documents: no rows. Columns beside doc_id, text, source and lang aren't read.
    """
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.split(t, "\n", -1)
    base = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"), t.alias("t"), lines.alias("l"), F.array_distinct(lines).alias("u"))
    return base.select("doc_id", "source", "lang", versions(F.col("t"), bpe).alias("whole"), F.when(F.size("u") < F.size("l"), versions(F.array_join("u", "\n"), bpe)).alias("trimmed"))


def rows_of(made: DataFrame, which: str) -> DataFrame:
    """+1 document for each row and tokenizer version, with its tokens and characters."""
    return made.select("source", "lang", F.explode(which).alias("x")).select("source", "lang", "x.tokenizer", F.lit(1).cast("long").alias("n_docs"), "x.n_tokens", "x.n_text_chars")


def insert(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, *SUMS)


def delete(rows: DataFrame) -> DataFrame:
    return rows.select(*KEYS, *[(-F.col(x)).alias(x) for x in SUMS])


def revise(old: DataFrame, new: DataFrame) -> DataFrame:
    """What the old counts were goes, what the new ones are comes."""
    return delete(old).unionByName(insert(new))


def summed(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy(*KEYS).agg(*[F.sum(x).alias(x) for x in SUMS])


class Ledger:
    """Committed batches in a shared folder: ``batch=<hash of the name>`` holds one batch's sums, ``base=<number>`` those of many.

    A base names the batches that are in it (file ``_included``), so that what is left of them after a stop half-way isn't counted twice and a batch
    that is sent again after compaction is known.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._path(self.folder))

    def _names(self, kind: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(self.folder)) if s.getPath().getName().startswith(f"{kind}="))

    def _key(self, batch: str) -> str:
        return f"batch={hashlib.sha256(batch.encode()).hexdigest()[:32]}"

    def _base(self) -> tuple[str | None, set[str]]:
        """The newest base and the batches in it."""
        bases = self._names("base")
        if not bases:
            return None, set()
        stream = self._fs.open(self._path(f"{self.folder}/{bases[-1]}/_included"))
        try:
            return bases[-1], set(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode().split())
        finally:
            stream.close()

    def committed(self, batch: str) -> bool:
        return self._fs.exists(self._path(f"{self.folder}/{self._key(batch)}")) or self._key(batch) in self._base()[1]

    def _publish(self, draft: str, name: str) -> bool:
        """Rename a draft to its name; False if another writer was first."""
        target = f"{self.folder}/{name}"
        if not self._fs.exists(self._path(target)) and self._fs.rename(self._path(draft), self._path(target)) and not self._fs.exists(self._path(f"{target}/{draft.rsplit('/', 1)[1]}")):
            return True
        for left in (draft, f"{target}/{draft.rsplit('/', 1)[1]}"):
            self._fs.delete(self._path(left), True)
        return False

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """False, and nothing changes, if a batch of this name is committed already."""
        if self.committed(batch):
            return False
        draft = f"{self.folder}/_draft-{uuid.uuid4().hex}"  # readers pass over names with an underscore
        summed(deltas).write.parquet(draft)
        return self._publish(draft, self._key(batch))

    def _rows(self) -> tuple[DataFrame | None, str | None, set[str], list[str]]:
        base, included = self._base()
        fresh = [n for n in self._names("batch") if n not in included]
        kept = [f"{self.folder}/{n}" for n in ([base] if base else []) + fresh]
        rows = self.spark.read.schema("source string, lang string, tokenizer string, n_docs long, n_tokens long, n_text_chars long").parquet(*kept) if kept else None
        return rows, base, included, fresh

    def totals(self) -> DataFrame:
        """Sums by key over all committed batches; keys whose sums are all 0 are gone. No batch: no rows."""
        rows = self._rows()[0]
        if rows is None:
            return self.spark.createDataFrame([], "source string, lang string, tokenizer string, n_docs long, n_tokens long, n_text_chars long")
        return summed(rows).filter(" or ".join(f"{x} <> 0" for x in SUMS))

    def compact(self) -> int:
        """All committed batches into one base; how many were added to it. Batches that are committed meanwhile stay beside it."""
        rows, base, included, fresh = self._rows()
        if not fresh:
            return 0
        draft = f"{self.folder}/_draft-{uuid.uuid4().hex}"
        summed(rows).write.parquet(draft)
        out = self._fs.create(self._path(f"{draft}/_included"))
        out.write(bytearray("\n".join(sorted(included | set(fresh))).encode()))
        out.close()
        if not self._publish(draft, f"base={int(base.split('=')[1]) + 1 if base else 1:09d}"):
            return 0
        for old in [*([base] if base else []), *fresh]:
            self._fs.delete(self._path(f"{self.folder}/{old}"), True)
        return len(fresh)


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The life of a corpus: every document is loaded; documents labelled toxic are taken down; those labelled of low quality
    (and not taken down) are counted anew without their repeated lines. The take-down is sent twice and counts once.
    """
    c.shared_folder(spark)
    ledger = Ledger(spark, f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/rollup-{uuid.uuid4().hex}")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").groupBy("doc_id").agg(F.max(F.coalesce("toxic", F.lit(0))).alias("toxic"), F.min(F.coalesce("quality", F.lit(1))).alias("quality"))
    made = c.settle(counted(c.documents(spark, sf_dir)))
    ledger.commit("load", insert(rows_of(made, "whole")))
    gone = delete(rows_of(made.join(labels.filter("toxic = 1"), "doc_id", "left_semi"), "whole"))
    ledger.commit("take-down", gone)
    ledger.commit("take-down", gone)
    low = made.filter("trimmed is not null").join(labels.filter("toxic = 0 and quality = 0"), "doc_id", "left_semi")
    ledger.commit("trim", revise(rows_of(low, "whole"), rows_of(low, "trimmed")))
    return ledger.totals()


OP8_SQL = r"""
WITH l AS (
  SELECT doc_id, max(coalesce(toxic, 0)) AS toxic, min(coalesce(quality, 1)) AS quality FROM labels GROUP BY doc_id
), d AS (
  SELECT d.source, d.lang, coalesce(d.text, '') AS t, coalesce(l.toxic, 0) AS toxic, coalesce(l.quality, 1) AS quality
  FROM documents d LEFT JOIN l USING (doc_id)
), kept AS (
  SELECT source, lang, CASE WHEN quality = 0 THEN (
    SELECT string_agg(line, chr(10) ORDER BY first) FROM (
      SELECT line, min(i) AS first FROM (SELECT unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS i) GROUP BY line
    )) ELSE t END AS t
  FROM d WHERE toxic = 0
), n AS (
  SELECT source, lang, 'words-1' AS tokenizer, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS k, length(t) AS c FROM kept
  UNION ALL
  SELECT source, lang, 'marks-1', len(regexp_extract_all(t, '[0-9A-Za-z]+|[^\x00-\x7F]+|[!-/:-@\[-`{-~]')), length(t) FROM kept
)
SELECT source, lang, tokenizer, CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(k) AS BIGINT) AS n_tokens, CAST(sum(c) AS BIGINT) AS n_text_chars
FROM n GROUP BY source, lang, tokenizer
"""
