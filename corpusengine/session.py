"""Sessions with the settings that the engine's semantics rest on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

#: UTC makes dates independent of the machine; ANSI makes bad casts errors (try_cast where they are data).
SEMANTICS = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
#: Runtime re-planning: coalesced partitions, split skewed joins.
EXECUTION = {"spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.execution.arrow.pyspark.enabled": "true"}


def session(name: str = "corpusengine", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    return builder.config(map=SEMANTICS | EXECUTION | conf).getOrCreate()


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once for each application: they need no installation and no shared path."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(), "corpusengine.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in sorted(os.walk(here)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("corpusengine", os.path.relpath(full, here)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
