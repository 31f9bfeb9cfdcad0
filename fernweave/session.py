"""Spark session defaults."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def session(master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``master`` only for local runs, a cluster names its own."""
    builder = SparkSession.builder.appName("fernweave")
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
    return builder.config(map=settings | conf).getOrCreate()


#: Temporary folders of sessions without a shared one, by application.
_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which all executors share; where that is unset, under a
    temporary folder if the session is local (tests), else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = _OWN.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="fernweave-"))
    return f"{root.rstrip('/')}/fernweave-{uuid.uuid4().hex}"


#: Folders, and tables of the catalog that lie in them, that operators left, by application.
_LEFT: dict[str, dict[str, str | None]] = {}


def left(spark: SparkSession, at: str, table: str | None = None) -> None:
    """Remember a folder that a result may still read."""
    _LEFT.setdefault(spark.sparkContext.applicationId, {})[at] = table


def cleared(spark: SparkSession) -> int:
    """Remove what operators of this session left, once no result is read any more; how many folders."""
    found = _LEFT.pop(spark.sparkContext.applicationId, {})
    for at, table in found.items():
        if table:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(found)


ROOT = Path(__file__).resolve().parent.parent
#: Applications whose executors have the package.
_SHIPPED: set[str] = set()


def importable() -> bool:
    """Whether Python workers find the package by themselves: by path or in the folder they start in."""
    return str(ROOT) in os.environ.get("PYTHONPATH", "").split(os.pathsep) or Path.cwd() == ROOT


def ship(spark: SparkSession) -> None:
    """Give the executors the package, once for each application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        at = shutil.make_archive(f"{tempfile.mkdtemp(prefix='fernweave-')}/fernweave", "zip", ROOT, "fernweave")
        spark.sparkContext.addPyFile(at)
        _SHIPPED.add(app)
