"""Incremental silver layer: new landing files in, new distinct profiles out.

Every micro-batch is merged once into a store of Parquet folders by batch id:

* ``keys``: digests of all profiles ever seen.  A batch is de-duplicated against
  them by an anti-join, so nothing is held in memory or in streaming state; only
  the known keys that also occur in the batch are shuffled to it.
* ``silver`` and ``quarantine``: the new rows that keep, or fail, the rules;
* ``metrics``: the batch's own counts, so that the rule metrics and the target
  distribution of all rows are sums over batches;
* ``commits``, written last: folders of a batch without one are not read.

A batch overwrites its own folders and leaves its own keys out of the anti-join:
run again after a failure, or replayed after its commit, it changes nothing.
Repairs of quarantined rows are merged in the same way, as change sets.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.functions.expressions import all_rules_hold, rule_holds
from churnlens.operators.quality import expect_drop, expect_violations
from churnlens.operators.silver import cast_columns, derive, drop_meta
from churnlens.session import drop_folder
from churnlens.streaming.ingest import bronze_stream

#: Batch ids of change sets start here.
REPAIRS = 1 << 40
PROFILE = ("Age int, Gender string, Tenure int, usage_frequency int, support_calls int, payment_delay int, "
           "subscription_type string, contract_length string, total_spend double, last_interaction int, Churn int")
DERIVED = (", support_calls_per_tenure double, spend_per_tenure double, is_new_client int, high_friction int, "
           "high_payment_delay int, is_inactive int, risk_score_flags int")
LAYOUT = {"commits": "done boolean", "keys": "_key binary", "silver": f"_key binary, {PROFILE}{DERIVED}",
          "quarantine": f"_key binary, {PROFILE}{DERIVED}, violations string", "repaired": "_key binary",
          "metrics": "kind string, name string, n long"}


def profile_key(columns: list[str], types: dict[str, str]):
    """A digest of a profile: NULL is a value of its own, and -0.0 is 0.0, as in a distinct."""
    return F.unhex(F.sha2(F.to_json(F.struct(*_plain(columns, types)), {"ignoreNullFields": "false"}), 256))


def _plain(columns: list[str], types: dict[str, str]) -> list:
    return [(F.col(c) + F.lit(0.0) if types[c] == "double" else F.col(c)).alias(c) for c in columns]


@dataclass(frozen=True)
class SilverStore:
    """The folders of one incremental silver layer."""
    root: str

    def path(self, table: str, batch: int | None = None) -> str:
        return f"{self.root}/{table}" + ("" if batch is None else f"/batch={batch}")

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """All rows of a table by batch, committed or not; no rows before the first write."""
        schema = f"{LAYOUT[table]}, batch long"
        place = spark._jvm.org.apache.hadoop.fs.Path(self.path(table))
        if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(self.path(table))

    def committed(self, spark: SparkSession, table: str) -> DataFrame:
        """Rows of a table of the batches that are done (one small row each)."""
        done = self.read(spark, "commits").select("batch")
        return self.read(spark, table).join(done, "batch", "left_semi")

    def silver(self, spark: SparkSession) -> DataFrame:
        """The silver rows so far."""
        return self.committed(spark, "silver").drop("batch", "_key")

    def quarantine(self, spark: SparkSession) -> DataFrame:
        """The rows that fail rules, with their keys, without those that were repaired."""
        repaired = self.committed(spark, "repaired").select("_key")
        return self.committed(spark, "quarantine").drop("batch").join(repaired, "_key", "left_anti")

    def _sums(self, spark: SparkSession, kind: str) -> DataFrame:
        return (self.committed(spark, "metrics").filter(F.col("kind") == kind).groupBy("name")
                .agg(F.sum("n").alias("n")))

    def metrics(self, spark: SparkSession, rules: dict[str, str] = C.EXPECTATIONS) -> DataFrame:
        """(rule, failed, total, kept, dropped) of all rows so far, as ``expect_metrics``."""
        names = spark.createDataFrame([(r,) for r in rules], "rule string")
        whole = self._sums(spark, "rows").agg(*[
            F.coalesce(F.sum(F.when(F.col("name") == k, F.col("n"))), F.lit(0)).alias(k) for k in ("total", "kept")])
        return (names.join(self._sums(spark, "rule"), F.col("rule") == F.col("name"), "left")
                .join(F.broadcast(whole))  # one row
                .select("rule", F.coalesce("n", F.lit(0)).alias("failed"), "total", "kept",
                        (F.col("total") - F.col("kept")).alias("dropped")))

    def target_distribution(self, spark: SparkSession) -> DataFrame:
        """(target, n) of the silver rows so far."""
        return self._sums(spark, "target").filter("n <> 0").select(F.col("name").cast("int").alias(C.TARGET), "n")


def _partials(unfiltered: DataFrame, rules: dict[str, str], sign: int = 1) -> DataFrame:
    """(kind, name, n): the counts that one batch adds (or, with ``sign`` -1, takes away)."""
    names = list(rules)
    counts = [F.count(F.lit(1)).alias("total"), F.count_if(all_rules_hold(rules)).alias("kept")]
    counts += [F.count_if(~rule_holds(rules[r])).alias(f"r{i}") for i, r in enumerate(names)]
    rows = [("rows", "total", "total"), ("rows", "kept", "kept"), *[("rule", r, f"r{i}") for i, r in enumerate(names)]]
    stacked = unfiltered.agg(*counts).select(F.inline(F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(name).alias("name"), F.col(c).alias("n")) for kind, name, c in rows])))
    target = (expect_drop(unfiltered, rules).groupBy(F.col(C.TARGET).cast("string").alias("name"))
              .agg(F.count(F.lit(1)).alias("n")).select(F.lit("target").alias("kind"), "name", "n"))
    return stacked.unionByName(target).withColumn("n", F.col("n") * sign)


def _write(df: DataFrame, store: SilverStore, table: str, batch: int) -> None:
    df.write.mode("overwrite").parquet(store.path(table, batch))


def _merge(store: SilverStore, profiles: DataFrame, batch: int, rules: dict[str, str],
           retired: DataFrame | None = None) -> None:
    """Typed ``profiles`` into the store; ``retired`` are quarantined rows that leave it."""
    spark = profiles.sparkSession
    own = [f.split()[0] for f in PROFILE.split(", ")]
    types = dict(profiles.dtypes)
    rows = profiles.select(*_plain(own, types), profile_key(own, types).alias("_key")).dropDuplicates(["_key"])
    # The stream's rows are read once, here.
    _write(rows, store, "staged", batch)
    rows = spark.read.schema(f"{PROFILE}, _key binary").parquet(store.path("staged", batch))
    known = store.committed(spark, "keys").filter(F.col("batch") != batch).select("_key")
    if retired is not None:  # a row may take the place of a repaired one, its own above all
        known = known.join(retired.select("_key"), "_key", "left_anti")
    fresh = rows.join(known.join(rows.select("_key"), "_key", "left_semi"), "_key", "left_anti")
    _write(fresh, store, "fresh", batch)
    unfiltered = derive(spark.read.schema(f"{PROFILE}, _key binary").parquet(store.path("fresh", batch)))
    _write(expect_drop(unfiltered, rules), store, "silver", batch)
    _write(expect_violations(unfiltered, rules), store, "quarantine", batch)
    partials = _partials(unfiltered, rules)
    if retired is not None:
        partials = partials.unionByName(_partials(retired, rules, -1))
        _write(retired.select("_key"), store, "repaired", batch)
    _write(partials, store, "metrics", batch)
    _write(unfiltered.select("_key"), store, "keys", batch)
    _write(spark.createDataFrame([(True,)], "done boolean").coalesce(1), store, "commits", batch)
    for scratch in ("staged", "fresh"):
        drop_folder(spark, store.path(scratch, batch))


def merge_batch(store: SilverStore, bronze: DataFrame, batch: int, rules: dict[str, str] = C.EXPECTATIONS) -> None:
    """Merge the bronze rows of one micro-batch.  NULL equals NULL; malformed
    values become NULL as in the batch layer; a batch without rows only commits."""
    _merge(store, cast_columns(drop_meta(bronze)), batch, rules)


def run_silver_stream(spark: SparkSession, landing_dir: str, store: SilverStore, checkpoint_path: str,
                      pattern: str = "*", max_files_per_trigger: int | None = None,
                      rules: dict[str, str] = C.EXPECTATIONS) -> None:
    """Merge the landing files that the checkpoint has not seen, then stop."""
    query = (bronze_stream(spark, landing_dir, pattern, max_files_per_trigger).writeStream
             .foreachBatch(lambda rows, batch: merge_batch(store, rows, batch, rules))
             .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start())
    query.awaitTermination()


def repair(spark: SparkSession, store: SilverStore, changes: DataFrame, change_set: int,
           rules: dict[str, str] = C.EXPECTATIONS) -> None:
    """Merge repaired rows of the quarantine: ``changes`` has the `_key` of a
    quarantined row and its new profile columns.

    The old row leaves the quarantine and its counts; the new one is cast,
    de-duplicated against all known rows and judged like any row, so silver, quarantine
    and metrics are those of the repaired input, and no silver row is rewritten.  A
    change whose key is not in the quarantine does nothing; of several changes of a key
    the smallest digest holds.  A row that was repaired stays known: it does not come
    back with a later file.  A change set that is done changes nothing when replayed;
    its number names it."""
    batch = REPAIRS + change_set
    done = store.read(spark, "commits").filter(F.col("batch") == batch)
    if not done.isEmpty():
        return
    typed = cast_columns(drop_meta(changes))
    own = [f.split()[0] for f in PROFILE.split(", ")]
    first = Window.partitionBy("_key").orderBy(profile_key(own, dict(typed.dtypes)))
    single = typed.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")
    quarantine = store.quarantine(spark)
    retired = quarantine.join(single.select("_key"), "_key", "left_semi")
    applied = single.join(quarantine.select("_key"), "_key", "left_semi").drop("_key")
    _merge(store, applied, batch, rules, retired)
