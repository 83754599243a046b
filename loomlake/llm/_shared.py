"""What the training-data operators have in common: the shared folder, cut lineage, Arrow batches in small pieces."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession


def use_shared_folder(spark: SparkSession) -> None:
    """Take spark.checkpoint.dir for checkpoints; where it is unset make a folder, on one machine only."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = context.getConf().get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="loomlake-checkpoint-"))


def shared_path(spark: SparkSession) -> str:
    """The folder for files that driver and executors all see."""
    use_shared_folder(spark)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


#: Bytes of an Arrow batch between the JVM and Python; both sides hold some of them for each task.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Have Arrow batches of BATCH_BYTES in this session, where nothing smaller is set."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = re.fullmatch(r"(\d+)b?", spark.conf.get(name))
    if not now or not 0 < int(now[1]) <= BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps survive a lost executor without recomputing."""
    use_shared_folder(df.sparkSession)
    small_batches(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder as Parquet and read back: smaller than a checkpoint, for tables with texts."""
    small_batches(df.sparkSession)
    place = f"{shared_path(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(place)
    tidy(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def tidy(spark: SparkSession) -> None:
    """Have the session's cleaner take the shuffle files that no plan refers to any more: it waits for collections."""
    gc.collect()
    spark._jvm.System.gc()


def remove(spark: SparkSession, place: str) -> None:
    """Delete a folder that this program has written, through the file system that Spark writes to."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back() -> None:
    """Return freed memory to the system: a worker that waits for its next task keeps little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        return


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = 1 << 20, max_rows: int = 4096) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds at most ``max_bytes`` of ``column``, or one row if that row is longer."""
    for batch in batches:
        sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, size in enumerate(sizes):
            if i > start and (total + size > max_bytes or i - start >= max_rows):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < batch.num_rows:
            yield batch.slice(start)
    give_back()


def fresh_names(taken: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores behind it as keep it apart from the taken ones."""
    used, out = {c.lower() for c in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
