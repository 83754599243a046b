"""The Spark session the library expects: UTC, ANSI, adaptive execution, page checksums on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    "spark.hadoop.parquet.page.verify-checksum.enabled": "true",
    "spark.hadoop.parquet.page.write-checksum.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def session(master: str | None = None, name: str = "loomlake", **more: str) -> SparkSession:
    """A session with SETTINGS; ``more`` adds or replaces settings (dots as double underscores)."""
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("__", "."): v for k, v in more.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; where it is unset, one of our own on a single machine."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = context.getConf().get("spark.checkpoint.dir", None)
        if not named and not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="loomlake-shared-"))
    return context._jsc.sc().getCheckpointDir().get()
