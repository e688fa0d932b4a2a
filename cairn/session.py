"""SparkSession factory with the settings the engine relies on."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(name: str = "cairn", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in more.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def scratch(spark: SparkSession) -> str:
    """A new folder that driver and executors share: below ``spark.checkpoint.dir``, or, where Spark is one local process and
    none is set, a folder of the process."""
    base = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getConf().get("spark.checkpoint.dir", "")
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="cairn-scratch-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
    return f"{base.rstrip('/')}/scratch-{uuid.uuid4().hex[:12]}"
