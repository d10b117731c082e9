"""Incremental bronze ingest of the landing folder with Structured Streaming.

The batch bronze layer re-reads every landing file on each update.  At scale
new files arrive continuously; the file-stream source remembers which files
it has already processed (in the query's checkpoint), so each update reads
only the new ones.  ``trigger(availableNow=True)`` processes everything that
is present and stops, which is how a scheduled job runs it.

The rows are the same as the batch bronze layer: renamed headers, the
landing file's name in ``_source_file`` and one ``_ingestion_time`` per
micro-batch.  De-duplication stays in the batch silver step: a streaming
``dropDuplicates`` without a watermark would keep every profile ever seen in
state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators.bronze import rename_headers
from churnlens.sources.landing import headers, landing_name


def _place(uri: F.Column) -> F.Column:
    """A file URI without the empty authority that only some writers put in."""
    return F.regexp_replace(uri, "^([a-z][a-z0-9+.-]*):/+(?=/)|^file:", "")


def bronze_stream(spark: SparkSession, landing_dir: str, pattern: str = "*",
                  max_files_per_trigger: int | None = None,
                  columns: list[str] = C.RAW_COLUMNS) -> DataFrame:
    """Streaming bronze rows from the files under ``landing_dir`` that match
    ``pattern`` (all by default, compressed ones too).

    Lines are read as text and take their column names from their own file's
    header, which is looked up when the stream starts; a file that arrives
    after that stops the query with an error and is ingested by the next run.
    Fields are text, like batch bronze.  A field can't span lines.  A line in which
    every field is its column's own name is a header line wherever it stands (files that
    were put together keep theirs in the middle), so no row of data looks like it."""
    known = headers(spark, landing_dir, pattern, columns)
    width = max((len(h) for h in known.values()), default=1)
    table = spark.createDataFrame([(f, list(h)) for f, h in known.items()], "_file string, _names array<string>")
    table = table.select(_place(F.col("_file")).alias("_file"), "_names")
    reader = (spark.readStream.format("text").option("recursiveFileLookup", "true")
              .option("pathGlobFilter", pattern))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = reader.load(landing_dir).select("value", F.col("_metadata.file_path").alias("_path"))
    fields = ", ".join(f"c{i} string" for i in range(width))
    parsed = lines.withColumn("_c", F.from_csv(F.regexp_replace("value", "^\ufeff", ""), F.lit(fields)))
    values = F.array(*[F.col(f"_c.c{i}") for i in range(width)])
    named = (parsed.select("_path", values.alias("_values"))
             .join(table, _place(F.col("_path")) == F.col("_file"), "left")
             .withColumn("_names", F.coalesce("_names", F.raise_error(F.concat(
                 F.lit("no header was read of "), "_path")).cast("array<string>")))
             .filter(F.slice("_values", F.lit(1), F.size("_names")) != F.col("_names")))
    rows = named.select(
        *[F.get("_values", (F.array_position("_names", F.lit(c)) - 1).cast("int")).alias(c) for c in columns],
        landing_name(F.col("_path")).alias("_source_file"))
    return rename_headers(rows).withColumn("_ingestion_time", F.current_timestamp())


def run_bronze_ingest(spark: SparkSession, landing_dir: str, bronze_path: str,
                      checkpoint_path: str, pattern: str = "*",
                      max_files_per_trigger: int | None = None) -> int:
    """Append the not-yet-ingested landing files to the bronze folder
    (Parquet), then stop; returns the number of micro-batches run.

    The checkpoint (source offsets + sink log) makes a rerun after a failure
    exactly-once: a file is never appended twice and never skipped."""
    query = (bronze_stream(spark, landing_dir, pattern, max_files_per_trigger).writeStream
             .format("parquet").option("path", bronze_path)
             .option("checkpointLocation", checkpoint_path)
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    last = query.lastProgress
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    return progress[-1]["batchId"] - progress[0]["batchId"] + 1 if last and progress else 0
