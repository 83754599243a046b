"""Sessions as they arrive: a file stream of ticks, audited batch by batch into the same rows as the batch audit."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit import session_audit
from ..operators.store import flat
from ..schema import TICK_SCHEMA


def tick_stream(spark: SparkSession, folder: str, files_per_trigger: int = 64) -> DataFrame:
    """Parquet files of whole sessions in TICK_SCHEMA, as a stream."""
    return spark.readStream.schema(TICK_SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def audit_stream(ticks: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Audit what is there now and stop. A batch writes its own folder, so a batch that is run again replaces itself."""

    def one(batch: DataFrame, number: int) -> None:
        flat(session_audit(batch)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return ticks.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
