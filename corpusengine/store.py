"""A warehouse of Parquet tables in one folder, on any file system that Spark reads.

A table is written as a new version beside the old one and becomes current by renaming one small pointer: readers never see
half a table, and a job that dies leaves the old one. Tables that don't exist read as empty ones of their schema.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusengine.operators import merge
from corpusengine.schemas import DATASETS, schema


#: Landings of a feed that are kept apart, at most.
MOST_LANDINGS = 32


def fit(df: DataFrame, to: StructType) -> DataFrame:
    """The columns of a schema in its order: missing ones null, others cast, extra ones dropped."""
    have = {c.lower(): c for c in df.columns}
    return df.select(*[(F.col(have[f.name.lower()]).cast(f.dataType) if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in to.fields])


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- files

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def matches(self, pattern: str) -> bool:
        return bool(self._fs.globStatus(self._path(pattern)))

    def raw(self, *parts: str) -> str:
        return "/".join([self.root, "raw", *parts])

    def resolve(self, path: str) -> str:
        """A landed file's path from another machine: relative ones are below the root, absolute ones are taken after their last raw/."""
        if not path.startswith("/"):
            return f"{self.root}/{path}"
        tail = path.rsplit("/raw/", 1)[1] if "/raw/" in path else path.rsplit("/", 1)[-1]
        return path if self.exists(path) else self.raw(tail)

    # ---- tables

    def _list(self, at: str) -> list[str]:
        return [x.getPath().getName() for x in self._fs.listStatus(self._path(at))] if self.exists(at) else []

    def _current(self, table: str) -> str | None:
        """The newest pointer's version."""
        at = f"{self.root}/warehouse/{table}"
        if not self.exists(at):
            return None
        found = sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(at)) if s.getPath().getName().startswith("current-"))
        return f"{at}/{found[-1].split('-', 2)[2]}" if found else None

    def has(self, table: str) -> bool:
        return self._current(table) is not None

    def read(self, table: str) -> DataFrame:
        at = self._current(table)
        return self.spark.read.parquet(at) if at else self.spark.createDataFrame([], schema(table))

    def write(self, table: str, df: DataFrame, to: StructType | None = None) -> DataFrame:
        """A new version of the table; the one before it stays for readers that have begun, older ones go."""
        at, version = f"{self.root}/warehouse/{table}", uuid.uuid4().hex
        fit(df, to or schema(table)).write.parquet(f"{at}/{version}")
        listed = [s.getPath().getName() for s in self._fs.listStatus(self._path(at))]
        pointers = sorted(n for n in listed if n.startswith("current-"))
        n = int(pointers[-1].split("-")[1]) + 1 if pointers else 1
        self._fs.create(self._path(f"{at}/_pointer-{version}")).close()
        self._fs.rename(self._path(f"{at}/_pointer-{version}"), self._path(f"{at}/current-{n:09d}-{version}"))
        for old in pointers[:-1]:
            self._fs.delete(self._path(f"{at}/{old.split('-', 2)[2]}"), True)
            self._fs.delete(self._path(f"{at}/{old}"), False)
        return self.read(table)

    # ---- landing

    def _deltas(self, table: str) -> list[str]:
        """Landings of a feed, oldest first."""
        at = f"{self.root}/feeds/{table}"
        return sorted(n for n in self._list(at) if n.startswith("landing-"))

    def _landed(self, table: str, columns: list[str] | None = None) -> DataFrame:
        """Rows of all landings, with _seq: later landings have larger ones. A landing has each key once."""
        read = self.spark.read.schema(schema(table)).parquet(*[f"{self.root}/feeds/{table}/{n}" for n in self._deltas(table)])
        seq = F.regexp_extract(F.col("_metadata.file_path"), r"/landing-(\d+)-", 1)
        return read.select(*(columns or ["*"]), seq.alias("_seq"))

    def land(self, table: str, batch: DataFrame, keys: list[str]) -> tuple[int, int]:
        """Append a batch of records to a feed; of a key the batch's last record counts, and the last landing's. Returns (total, added).

        What has landed is never rewritten here: earlier landings are read for their keys alone. Every MOST_LANDINGS landings they become one.
        """
        to = schema(table)
        new = fit(batch, to).withColumn("_at", F.monotonically_increasing_id()).persist()
        known = self._landed(table, keys).select(*keys).distinct() if self._deltas(table) else self.spark.createDataFrame([], to).select(*keys)
        n_added, n_known = merge.added(known, new, keys).count(), known.count()
        self._append(table, merge.keyed_merge(new.limit(0), new, keys, "_at"))
        new.unpersist()
        self.put_text(f"feeds/{table}/_keys", json.dumps(keys))
        if len(self._deltas(table)) > MOST_LANDINGS:
            self.compact(table)
        return n_known + n_added, n_added

    def _append(self, table: str, rows: DataFrame) -> None:
        at, draft = f"{self.root}/feeds/{table}", f"_draft-{uuid.uuid4().hex}"
        fit(rows, schema(table)).write.parquet(f"{at}/{draft}")
        before = self._deltas(table)
        n = int(before[-1].split("-")[1]) + 1 if before else 1
        self._fs.rename(self._path(f"{at}/{draft}"), self._path(f"{at}/landing-{n:09d}-{draft[7:]}"))

    def _merged(self, table: str) -> DataFrame:
        keys = json.loads(self.get_text(f"feeds/{table}/_keys"))
        last = self._landed(table, keys).groupBy(*keys).agg(F.max("_seq").alias("_last")).alias("k")
        rows = self._landed(table).alias("r")
        same = F.col("_seq") == F.col("_last")
        for k in keys:
            same = same & F.col(f"r.{k}").eqNullSafe(F.col(f"k.{k}"))
        return rows.join(last, same, "left_semi").drop("_seq")

    def compact(self, table: str) -> None:
        """All landings of a feed as one; it comes after them, so that a stop before they are gone changes nothing."""
        old = self._deltas(table)
        self._append(table, self._merged(table))
        for name in old:
            self._fs.delete(self._path(f"{self.root}/feeds/{table}/{name}"), True)

    def feed(self, table: str) -> DataFrame | None:
        """What has landed for a table: records merged from its landings, and the NDJSON file of its name."""
        parts = [self._merged(table)] if self._deltas(table) else []
        path = self.raw(DATASETS[table]) if table in DATASETS else None
        if path and self.exists(path):
            parts.append(self.spark.read.schema(schema(table)).json(path))
        return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    # ---- small JSON files of the driver: models, states

    def put_text(self, name: str, text: str) -> None:
        draft = self._path(f"{self.root}/_draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft)
        out.write(bytearray(text.encode()))
        out.close()
        target = self._path(f"{self.root}/{name}")
        self._fs.mkdirs(target.getParent())
        self._fs.delete(target, False)
        self._fs.rename(draft, target)

    def get_text(self, name: str) -> str | None:
        path = f"{self.root}/{name}"
        if not self.exists(path):
            return None
        stream = self._fs.open(self._path(path))  # one small file of the driver's own
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()
