"""Sessions and sliding windows over a stream of events, by event time.

A watermark bounds the state: a window leaves it, and is written, when no event
that may still come can belong to it.  Rows behind the watermark are late: they
are left out and counted.  Results are appended once, by batch id, so a restart
or a replay writes nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from churnlens.streaming.scoring import write_batch


def run_windows(spark: SparkSession, source: str, schema: T.StructType, time: str, delay: str,
                windows: Callable[[DataFrame], DataFrame], out: str, checkpoint_path: str,
                max_files_per_trigger: int | None = None) -> int:
    """Add the events under ``source`` that the checkpoint has not seen to the windows,
    write the windows that are complete, then stop; returns the number of late rows.

    ``windows`` is one of the aggregations of ``operators.temporal``; ``delay`` says how
    late an event may come.  Windows that are still open stay in the checkpoint's state."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    done = windows(reader.parquet(source).withWatermark(time, delay))
    query = (done.writeStream.outputMode("append").foreachBatch(lambda df, batch: write_batch(df, out, batch))
             .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    query.awaitTermination()
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out).drop("batch")
