"""Scoring inside a stream: a stored model, a checked input, an idempotent sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import config as C
from churnlens.operators import scoring as SC
from churnlens.operators.boosting import BoostedScorer
from churnlens.operators.models import Scorer

#: What a model reads, by kind: any type of the kind will do.
NUMBERS, TEXTS = (T.NumericType,), (T.StringType,)


def check_input(df: DataFrame, num: list[str] = C.NUM_FEATURES, cat: list[str] = C.CAT_FEATURES) -> None:
    """An error that names the columns a model misses or finds with another kind of type."""
    types = {f.name: f.dataType for f in df.schema}
    wrong = [f"{c} is missing" for c in [*num, *cat] if c not in types]
    for names, kinds, what in ((num, NUMBERS, "a number"), (cat, TEXTS, "text")):
        wrong += [f"{c} is {types[c].simpleString()}, not {what}" for c in names
                  if c in types and not isinstance(types[c], kinds)]
    if wrong:
        raise ValueError("the model can't read these rows: " + "; ".join(wrong))


def scored(rows: DataFrame, scorer: Scorer | BoostedScorer, tag: str) -> DataFrame:
    """``rows`` with probability, band and model tag; batch and streaming rows alike."""
    check_input(rows)
    return SC.with_band(scorer.score(rows)).withColumn("modelo", F.lit(tag))


def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """A micro-batch into its own folder: written again, it replaces itself."""
    df.write.mode("overwrite").parquet(f"{path}/batch={batch}")


def run_scoring_stream(spark: SparkSession, source: str, schema: T.StructType, scorer: Scorer | BoostedScorer, tag: str,
                       out: str, checkpoint_path: str, max_files_per_trigger: int | None = None) -> None:
    """Score the Parquet files under ``source`` that the checkpoint has not seen, then stop.

    The input schema is checked before the stream starts; every micro-batch is
    scored by the same plan as a batch and lands in a folder of its id."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    rows = scored(reader.parquet(source), scorer, tag)
    query = (rows.writeStream.foreachBatch(lambda df, batch: write_batch(df, out, batch))
             .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    query.awaitTermination()


def read_scores(spark: SparkSession, out: str) -> DataFrame:
    """All scored rows, without the batch they came in."""
    return spark.read.parquet(out).drop("batch")
