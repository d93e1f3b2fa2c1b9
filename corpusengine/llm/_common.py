"""What the corpus operators share: reading columns, shared checkpoints, Arrow row mapping.

Texts travel to Python as UTF-8 bytes (``cast('binary')``), so a null text is ``None`` and the
operators decide what it means; every operator names its case in its docstring.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, the complement of the word class ``[^\x20\x09-\x0D]``; ``bytes.split()`` uses the same six.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id (long) and text (binary) alone, whatever other columns the table has."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"), *more)


def shared_folder(spark: SparkSession) -> None:
    """Checkpoints go to spark.checkpoint.dir; a folder of our own is set only where that is unset."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        local = sc.master.startswith("local[") or sc.master == "local"
        sc.setCheckpointDir(named or ("/tmp/checkpoints" if local else f"{spark.conf.get('spark.sql.warehouse.dir')}/_checkpoints"))


#: Spark removes the shuffle files of an execution when that execution ends.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settle(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint: lost executors can't take it along. The shuffle files that led there go with it."""
    spark = df.sparkSession
    shared_folder(spark)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # an execution of its own, under this setting
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def forget(settled: DataFrame) -> None:
    """Delete the files of a settled frame that nothing reads any more."""
    file = settled._jdf.queryExecution().analyzed().rdd().getCheckpointFile()
    if file.isDefined():
        path = settled.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(settled.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def fold(mod: int, doc_id: str = "doc_id") -> Column:
    """crc32 of the decimal doc_id, modulo ``mod``; a null doc_id is in fold -1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % mod, F.lit(-1)).cast("int")


def map_rows(df: DataFrame, row: Callable[..., tuple], schema: str, step: int = 512) -> DataFrame:
    """``row(*values) -> tuple`` for every row, in Arrow batches; a batch is cut so that its Python objects stay few."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                part = whole.slice(at, step)
                out = [row(*x) for x in zip(*(c.to_pylist() for c in part.columns), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    fields = df.sparkSession.createDataFrame([], schema).schema.fields
    from pyspark.sql.pandas.types import to_arrow_type

    names, types = [f.name for f in fields], [to_arrow_type(f.dataType) for f in fields]
    return df.mapInArrow(run, schema)
