"""Joins and windows over event time: as-of, interval, sessions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.session import scratch_path


def asof_join(left: DataFrame, right: DataFrame, keys: dict[str, str], times: tuple[str, str], columns: list[str],
              ties: list[str] = (), within: str | None = None, blocks: int | None = None) -> DataFrame:
    """Every row of ``left`` with ``columns`` of the latest row of ``right`` that has
    the same key and is not later.

    ``keys`` maps left to right key columns, ``times`` are the two time columns;
    of right rows at the same time the one of the largest ``ties`` counts.
    ``within`` (an interval such as '7 days') leaves out older ones.  Both sides go
    into one table, dealt in ranges of (key, time) to ``blocks`` parts (default:
    the shuffle partitions).  In a part the last right row is carried forward;
    into a part that starts in the middle of a key, the key's last one from the
    parts before.  So a key of any size is spread over many tasks, and no task
    holds a key.

    A null key or time finds nothing; such left rows stay, with nulls.  Repeated
    rows stay.  ``columns`` that ``left`` has too are an error.
    """
    clash = [c for c in columns if c in left.columns]
    if clash:
        raise ValueError(f"columns of both sides: {', '.join(clash)}")
    spark = left.sparkSession
    names = [f"_k{i}" for i in range(len(keys))]
    from_left = left.select(
        *[F.col(c).alias(n) for c, n in zip(keys, names)], F.col(times[0]).alias("_t"), F.lit(1).alias("_side"),
        F.struct(*[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in ties] or [F.lit(0).alias("_")]).alias("_tie"),
        F.struct("*").alias("_left"),
        F.lit(None).cast(right.select(F.struct(*[F.col(c) for c in columns], F.col(times[1]).alias("_rt"))).schema[0].dataType)
        .alias("_right"))
    usable = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*keys.values(), times[1])])
    from_right = right.filter(usable).select(
        *[F.col(c).alias(n) for c, n in zip(keys.values(), names)], F.col(times[1]).alias("_t"), F.lit(0).alias("_side"),
        F.struct(*[F.col(c) for c in ties] or [F.lit(0).alias("_")]).alias("_tie"),
        F.lit(None).cast(from_left.schema["_left"].dataType).alias("_left"),
        F.struct(*[F.col(c) for c in columns], F.col(times[1]).alias("_rt")).alias("_right"))
    n = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["_t", "_side", "_tie"]
    # Left rows at one time of one key may be many: their hash parts them.
    spread = F.xxhash64("_left")
    dealt = (from_left.unionByName(from_right).withColumn("_spread", spread)
             .repartitionByRange(n, *names, *order, "_spread")
             .withColumn("_block", F.spark_partition_id()).drop("_spread"))
    path = scratch_path(spark, "asof")
    dealt.write.parquet(path)
    dealt = spark.read.schema(dealt.schema).parquet(path)

    before = Window.partitionBy(*names, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = dealt.withColumn("_in_block", F.last("_right", ignorenulls=True).over(before)).filter("_side = 1")
    # The last right row of every key in every part, and of the parts before.
    last = (dealt.filter("_side = 0").groupBy(*names, "_block")
            .agg(F.max_by("_right", F.struct("_t", "_tie")).alias("_last")))
    parts = dealt.select(*names, "_block").distinct().join(last, [*names, "_block"], "left")
    upto = Window.partitionBy(*names).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    prior = parts.select(*names, "_block", F.last("_last", ignorenulls=True).over(upto).alias("_prior")).filter(
        "_prior is not null")
    found = carried.join(prior, [*names, "_block"], "left").withColumn(
        "_found", F.when(F.col("_t").isNotNull(), F.coalesce("_in_block", "_prior")))
    if within:
        found = found.withColumn("_found", F.when(F.col("_found._rt") >= F.col("_t") - F.expr(f"INTERVAL {within}"),
                                                  F.col("_found")))
    return found.select("_left.*", *[F.col(f"_found.`{c}`").alias(c) for c in columns])


_EPOCH = "1970-01-01"


def micros(c: Column, kind: str) -> Column:
    """Time as microseconds, whatever the session's time zone; a whole number as it is."""
    if kind == "timestamp":
        return F.unix_micros(c)
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), c)
    return (F.unix_date(c) * 86_400_000_000) if kind == "date" else c.cast("long")


def as_instant(c: Column) -> Column:
    """A time without zone as the instant it is in UTC: what watermarks need."""
    return F.timestamp_micros(micros(c, "timestamp_ntz"))


def without_zone(c: Column) -> Column:
    """An instant as its time in UTC, without zone."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(_EPOCH).cast("timestamp_ntz"))


def interval_join(points: DataFrame, intervals: DataFrame, keys: dict[str, str], point: str, start: str,
                  end: str) -> DataFrame:
    """Pairs of rows with equal key and start <= point < end, as an equality join.

    An interval belongs to the level of bins at least as long as itself, where it
    meets two bins at most; a point is looked up in its bin of every level that
    occurs (their number is the logarithm of the longest interval).  The exact
    condition is checked on what meets.  Key and bin together spread a hot key over
    time; what is left of skew is a join of plain rows, which Spark splits.

    Null keys, points or bounds and empty intervals find nothing; repeated rows
    give repeated pairs.  Columns of both sides must have different names.
    """
    types = dict(points.dtypes) | dict(intervals.dtypes)
    bounds = intervals.withColumns({"_s": micros(F.col(start), types[start]), "_e": micros(F.col(end), types[end])}).filter(
        "_s < _e")
    bounds = bounds.withColumn("_level", F.ceil(F.log2((F.col("_e") - F.col("_s")).cast("double"))).cast("int"))
    levels = [r["_level"] for r in bounds.select("_level").distinct().collect()]  # at most 64
    def bin_of(c: Column, level: Column) -> Column:
        return F.call_function("shiftright", c, level)

    in_bins = bounds.withColumn("_bin", F.explode(F.array_distinct(F.array(
        bin_of(F.col("_s"), F.col("_level")), bin_of(F.col("_e") - 1, F.col("_level"))))))
    if not levels:
        in_bins, levels = in_bins.limit(0), [0]
    at = micros(F.col(point), types[point])
    looked_up = points.withColumn("_p", at).withColumn("_x", F.explode(F.array(*[
        F.struct(F.lit(k).alias("_at_level"), bin_of(F.col("_p"), F.lit(k)).alias("_at_bin")) for k in sorted(levels)])))
    looked_up = looked_up.select(*points.columns, "_p", "_x.*")
    same = [F.col(a) == F.col(b) for a, b in keys.items()]
    on = reduce(lambda a, b: a & b, [*same, F.col("_at_level") == F.col("_level"), F.col("_at_bin") == F.col("_bin")])
    return (looked_up.join(in_bins, on).filter("_s <= _p and _p < _e")
            .select(*[F.col(c) for c in points.columns], *[F.col(c) for c in intervals.columns]))


def sessions(events: DataFrame, key: str, time: str, gap: str, aggregates: dict[str, Column]) -> DataFrame:
    """(key, start, end, aggregates) of every session: events of a key that follow each
    other within ``gap``; the end is ``gap`` behind the last one.  Streaming rows need a
    watermark.  Rows of null time or key: no session for a null time, a null key is a key."""
    return (events.filter(F.col(time).isNotNull()).groupBy(key, F.session_window(time, gap).alias("_w"))
            .agg(*[c.alias(n) for n, c in aggregates.items()])
            .select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *aggregates))


def sliding(events: DataFrame, key: str, time: str, size: str, slide: str, aggregates: dict[str, Column]) -> DataFrame:
    """(key, start, end, aggregates) of every window of ``size`` that starts each ``slide``
    and has an event."""
    return (events.groupBy(key, F.window(time, size, slide).alias("_w"))
            .agg(*[c.alias(n) for n, c in aggregates.items()])
            .select(key, F.col("_w.start").alias("start"), F.col("_w.end").alias("end"), *aggregates))
