"""Queries over event time: as-of and interval joins of events with orders,
sessions and sliding windows (batch and streaming), cubes with distinct counts.

The order days of the given tables end before the events begin; the queries set
them 23 years on, so that both run over the same month.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from churnlens import config as C
from churnlens.operators import scoring as SC
from churnlens.operators.evaluate import auc_from_histogram, merged_histogram, roc_auc, roc_points, score_histogram
from churnlens.operators.rollup import cube_counts
from churnlens.operators.temporal import as_instant, asof_join, interval_join, sessions, sliding, without_zone
from churnlens.plans.medallion import split_from
from churnlens.plans.oracle import band_sql, with_base
from churnlens.plans.registry import register
from churnlens.session import scratch_path
from churnlens.streaming.windows import read_windows, run_windows

YEARS_ON = 23


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _orders(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        (F.col("o_orderdate") + F.expr(f"INTERVAL {YEARS_ON} YEARS")).alias("o_time"))


_ORDERS = f"""orders_on AS (
  SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate + INTERVAL {YEARS_ON} YEAR AS o_time FROM orders)"""


@register("asof_orders", f"""
WITH {_ORDERS},
latest AS (SELECT o_custkey, o_time, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice
           FROM orders_on GROUP BY ALL)
SELECT e.event_id, e.user_id, e.ts, o.o_orderkey, o.o_totalprice, o.o_time
FROM events e ASOF LEFT JOIN latest o ON e.user_id = o.o_custkey AND e.ts >= o.o_time""")
def asof_orders_q(spark, sf_dir):
    """The latest order of the customer before each event."""
    return asof_join(_events(spark, sf_dir).select("event_id", "user_id", "ts"), _orders(spark, sf_dir),
                     {"user_id": "o_custkey"}, ("ts", "o_time"), ["o_orderkey", "o_totalprice", "o_time"], ["o_orderkey"])


@register("interval_orders", f"""
WITH {_ORDERS}
SELECT e.event_id, e.user_id, e.ts, o.o_orderkey, o.o_time, o.o_time + INTERVAL 3 DAY AS o_until
FROM events e JOIN orders_on o ON e.user_id = o.o_custkey AND e.ts >= o.o_time AND e.ts < o.o_time + INTERVAL 3 DAY""")
def interval_orders_q(spark, sf_dir):
    """Events within three days after an order of their customer."""
    orders = _orders(spark, sf_dir).select("o_orderkey", "o_custkey", "o_time",
                                           (F.col("o_time") + F.expr("INTERVAL 3 DAYS")).alias("o_until"))
    return interval_join(_events(spark, sf_dir).select("event_id", "user_id", "ts"), orders, {"user_id": "o_custkey"},
                         "ts", "o_time", "o_until").drop("o_custkey")


def _counts():
    return {"n": F.count(F.lit(1)), "spent": F.sum(F.col("value").cast("decimal(18,2)")).cast("double")}


_SESSIONS = """
WITH marked AS (
  SELECT *, CASE WHEN ts <= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS new
  FROM events WHERE ts IS NOT NULL),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM marked)
SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS n,
  sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS spent
FROM numbered GROUP BY user_id, k"""
_SLIDING = """
SELECT user_id, start, start + INTERVAL 6 HOUR AS "end", count(*) AS n, sum(CAST(value AS DECIMAL(18,2)))::DOUBLE AS spent
FROM (SELECT user_id, value, unnest([time_bucket(INTERVAL 2 HOUR, ts), time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 2 HOUR,
        time_bucket(INTERVAL 2 HOUR, ts) - INTERVAL 4 HOUR]) AS start FROM events WHERE ts IS NOT NULL)
GROUP BY user_id, start"""


def _session_windows(events):
    return sessions(events, "user_id", "ts", "2 hours", _counts())


def _sliding_windows(events):
    return sliding(events, "user_id", "ts", "6 hours", "2 hours", _counts())


@register("user_sessions", _SESSIONS)
def user_sessions_q(spark, sf_dir):
    return _session_windows(_events(spark, sf_dir))


@register("sliding_activity", _SLIDING)
def sliding_activity_q(spark, sf_dir):
    return _sliding_windows(_events(spark, sf_dir))


def _streamed(spark, sf_dir, windows):
    """The events in four files, one a micro-batch, then one event far ahead that closes
    all windows (its own stay open)."""
    root = scratch_path(spark, "windows")
    events = _events(spark, sf_dir).select("user_id", as_instant(F.col("ts")).alias("ts"), "value")
    events.repartitionByRange(4, "ts").write.parquet(f"{root}/in")
    # Files of one write come in any order: the watermark waits longer than the month they span.
    run = lambda: run_windows(spark, f"{root}/in", events.schema, "ts", "40 days", windows, f"{root}/out",
                              f"{root}/checkpoint", 1)
    run()
    last = events.agg(F.max("ts").alias("ts")).select(
        F.lit(None).cast("long").alias("user_id"), (F.col("ts") + F.expr("INTERVAL 90 DAYS")).alias("ts"),
        F.lit(None).cast("double").alias("value"))
    last.write.mode("append").parquet(f"{root}/in")
    run()
    return read_windows(spark, f"{root}/out").withColumns({c: without_zone(F.col(c)) for c in ("start", "end")})


@register("session_stream", _SESSIONS)
def session_stream_q(spark, sf_dir):
    return _streamed(spark, sf_dir, _session_windows)


@register("sliding_stream", _SLIDING)
def sliding_stream_q(spark, sf_dir):
    return _streamed(spark, sf_dir, _sliding_windows)


def _banded(spark, sf_dir):
    scored = SC.standin_score(split_from(spark, sf_dir))
    return SC.with_band(scored, "score").select("nivel_riesgo", "contract_length", "subscription_type", "Age", "total_spend")


@register("band_cube", with_base(f"""
SELECT nivel_riesgo, contract_length, subscription_type,
  grouping(nivel_riesgo, contract_length, subscription_type) AS level, count(*) AS n,
  count(DISTINCT "Age") AS n_distinct, sum(CAST(total_spend AS DECIMAL(18,2)))::DOUBLE AS total,
  true AS estimate_within
FROM (SELECT {band_sql('score')} AS nivel_riesgo, contract_length, subscription_type, "Age", total_spend FROM scored)
GROUP BY CUBE (nivel_riesgo, contract_length, subscription_type)"""))
def band_cube_q(spark, sf_dir):
    """Rows, distinct ages (exact, and by merged sketches within three standard errors) and
    spend of every combination of band, contract and subscription."""
    return cube_counts(_banded(spark, sf_dir), ["nivel_riesgo", "contract_length", "subscription_type"], "Age", "total_spend")


def _test_scores(spark, sf_dir):
    return SC.standin_score(split_from(spark, sf_dir).filter(F.col("split") == "test")).select(
        F.col(C.TARGET).alias("label"), "score")


@register("roc_auc_histogram", with_base("""
SELECT (sum(pos * below) + sum(pos * neg) / 2.0) / (sum(pos) * sum(neg) * 1.0) AS auc,
  sum(pos * neg) / (2.0 * sum(pos) * sum(neg)) AS error_bound, true AS within_bound
FROM (
  SELECT *, coalesce(sum(neg) OVER (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
  FROM (SELECT least(CAST(floor(score * 256) AS BIGINT), 255) AS bin, count(*) FILTER (WHERE label = 1)::DOUBLE AS pos,
          count(*) FILTER (WHERE label = 0)::DOUBLE AS neg FROM test_scored GROUP BY bin))"""))
def roc_auc_histogram_q(spark, sf_dir):
    """AUC from a score histogram merged from parts, its error bound, and the exact AUC within it."""
    rows = _test_scores(spark, sf_dir)
    parts = [score_histogram(rows.filter(F.pmod(F.xxhash64("label", "score"), F.lit(2)) == k), 256) for k in (0, 1)]
    found = auc_from_histogram(merged_histogram(parts[0].unionByName(parts[1])))
    exact = roc_auc(roc_points(rows)).select(F.col("auc").alias("exact"))
    return found.join(F.broadcast(exact)).select(
        "auc", "error_bound", (F.abs(F.col("auc") - F.col("exact")) <= F.col("error_bound") + 1e-12).alias("within_bound"))
