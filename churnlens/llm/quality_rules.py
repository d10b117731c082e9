"""Quality rules whose cut-offs come from the data.

Fixed base rules judge a text by itself.  For the rest every (language, source)
has its own cut-offs, read from quantile sketches of four ratios.  A sketch is
a table of counts over log-linear buckets (exact up to 127, then 64 buckets per
power of two): two sketches merge by adding counts, so partial sketches combine
on the map side.  A group's sketch always takes in its language's, with the
weight of a fixed number of rows, and a language's that of all: a small group
is judged mostly by its language, a large one by itself, and nothing switches.

A cut-off is a rate.  A text has as many units (symbols, lines, words, letters)
as chance allows at that rate: six standard errors more than expected are still
fine.  All of it is DataFrame expressions; the texts are not shuffled, only
counts and the narrow measures are.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.tables import stored

SPACE = r"\x20\x09-\x0D"


@dataclass(frozen=True)
class QualityRules:
    """Rates are in thousandths.  The cut-off of symbols, repeated lines and
    repeated words is the 90 % quantile q9 + `spread` * (q9 - median); those of
    mean word length are median + `spread` * (median - lower quartile) and median -
    `spread` * (upper quartile - median), which hold while less than half of a group
    is junk.  A distance is at least the sketch's resolution there.  A text is
    rejected `errors` standard errors of a count beyond a cut-off.  `prior_rows`:
    the weight of the wider sketch."""
    min_words: int = 50
    max_repeat_percent: int = 50
    spread: int = 6
    errors: int = 6
    prior_rows: int = 200


#: Sketch buckets a power of two.
FINE = 64
#: A row's weight in whole-number sketches that take in a share of a wider one.
SCALE = 1000


METRICS = ("symbols", "lines", "repeats", "length")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the columns of MEASURES (long) instead of its text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    others = [c for c in docs.columns if c != text_col]
    d = docs.select(
        *others,
        F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+")).alias("_words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("_lines"),
        F.length(F.regexp_replace(text, f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"))
    words = F.col("_words")
    # The hash of the window of three words that starts at each word.
    d = d.withColumn("_windows", F.when(F.size(words) >= 3, F.slice(
        F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))),
        F.lit(1), F.size(words) - 2)).otherwise(F.array().cast("array<bigint>")))
    windows = F.col("_windows")
    # Windows by hash, in texts that have equal ones; else nothing to sort.
    d = d.withColumn("_sorted", F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    order = F.col("_sorted")
    d = d.withColumn("_at", F.sort_array(F.filter(F.transform(
        order, lambda x, i: F.when((x["h"] == F.get(order, i - 1)["h"]) | (x["h"] == F.get(order, i + 1)["h"]),
                                   x["i"])), lambda i: i.isNotNull())))
    at = F.col("_at")
    covered = F.aggregate(
        F.transform(at, lambda p, i: F.least(F.lit(3), F.coalesce(F.get(at, i + 1) - p, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, n: total + n)
    return d.select(
        *others, F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"))


def bucket(v: Column) -> Column:
    """The sketch bucket of a whole number from 0: itself below 2 * FINE, else FINE a power of two."""
    e = F.length(F.bin(v)) - 1
    return F.when(v < 2 * FINE, v).otherwise(
        e * FINE + F.pmod(F.floor(v / F.pow(F.lit(2.0), e - 6)), F.lit(FINE))).cast("long")


def bucket_top(b: Column) -> Column:
    """The largest number in a bucket."""
    e = F.floor(b / FINE)
    return F.when(b < 2 * FINE, b).otherwise((FINE + 1 + b % FINE) * F.pow(F.lit(2.0), e - 6) - 1).cast("long")


def _taking_in(own: DataFrame, wider: DataFrame, keys: list[str], shared: list[str], p: QualityRules) -> DataFrame:
    """The sketches ``own`` (keys, metric, bucket, w), each with the sketch of ``wider`` of its
    ``shared`` keys at the weight of `prior_rows` rows.  Weights stay whole numbers."""
    total = Window.partitionBy(*shared, "metric")
    whole = lambda c: F.col(c).cast("decimal(38,0)")
    prior = wider.select(*[F.col(c).alias(f"p_{c}") for c in shared], F.col("metric").alias("p_metric"), "bucket",
                         F.call_function("div", F.lit(p.prior_rows * SCALE).cast("decimal(18,0)") * F.col("w").cast("decimal(20,0)"),
                                         F.sum(whole("w")).over(total).cast("decimal(20,0)")).alias("w"))
    on = F.col("metric") == F.col("p_metric")
    for c in shared:
        on = on & F.col(c).eqNullSafe(F.col(f"p_{c}"))
    added = own.select(*keys, "metric").distinct().join(prior, on).select(*keys, "metric", "bucket", "w")
    return own.unionByName(added).groupBy(*keys, "metric", "bucket").agg(F.sum("w").alias("w"))


def merged_sketches(sketch: DataFrame, p: QualityRules) -> DataFrame:
    """(_lang, _source, metric, bucket, w) from counts ``sketch`` (_lang, _source, metric, bucket, n)."""
    def summed(keys: list[str]) -> DataFrame:
        return sketch.groupBy(*keys, "metric", "bucket").agg((F.sum("n") * SCALE).alias("w"))

    langs = stored(_taking_in(summed(["_lang"]), summed([]), ["_lang"], [], p), "lang_sketches")
    return _taking_in(summed(["_lang", "_source"]), langs, ["_lang", "_source"], ["_lang"], p)


def cut_offs(sketches: DataFrame, p: QualityRules) -> DataFrame:
    """One row per (g_lang, g_source): the cut-off rates.  A sketch has a bounded
    number of buckets, whatever the number of rows, and is walked over."""
    own = Window.partitionBy("_lang", "_source", "metric")
    walked = sketches.select(
        "_lang", "_source", "metric", bucket_top(F.col("bucket")).alias("top"), F.sum("w").over(own).alias("total"),
        F.sum("w").over(own.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"))
    quantiles = walked.groupBy("_lang", "_source", "metric").agg(*[
        F.min(F.when(F.col("upto") * 100 >= F.col("total") * k, F.col("top"))).alias(f"q{k}") for k in (25, 50, 75, 90)])

    def of(metric: str, value: Column) -> Column:
        return F.max(F.when(F.col("metric") == metric, value))

    def distance(far: str, near: str) -> Column:
        return p.spread * F.greatest(F.abs(F.col(far) - F.col(near)), F.floor(F.col(near) / FINE))

    tail = F.col("q90") + distance("q50", "q90")
    return quantiles.groupBy(F.col("_lang").alias("g_lang"), F.col("_source").alias("g_source")).agg(
        *[of(m, tail).alias(f"{m}_max") for m in ("symbols", "lines", "repeats")],
        of("length", F.col("q50") + distance("q25", "q50")).alias("length_max"),
        of("length", F.greatest(F.col("q50") - distance("q75", "q50"), F.lit(0))).alias("length_min"))


def beyond(units: Column, size: Column, rate: Column, errors: int, sign: int = 1) -> Column:
    """Whether ``units`` of ``size`` lie more than ``errors`` standard errors above
    (``sign`` 1) or below (-1) the number that ``rate`` (thousandths) gives."""
    expected = rate.cast("double") * size / 1000
    return sign * (units - expected) > errors * F.sqrt(expected + 1)


def judged(docs: DataFrame, params: QualityRules = QualityRules(), text_col: str = "text",
           lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """``docs`` without its text, with MEASURES, `base_failed` and `kept`.

    Null text has no words and fails the base rules; null language or source
    is a group of its own.  Repeated rows are judged one by one and count one
    by one in the sketches.  An empty table gives no rows.  Columns of ``docs``
    with the names of results are replaced.
    """
    p = params
    results = {*MEASURES, "base_failed", "kept"}
    own = [c for c in docs.columns if c not in results or c == text_col]
    d = measured(docs.select(*own, F.col(lang_col).alias("_lang"), F.col(source_col).alias("_source")), text_col)
    d = d.withColumn("base_failed", (F.col("n_words") < p.min_words)
                     | (100 * F.col("n_repeat_words") > p.max_repeat_percent * F.col("n_words")))
    n = F.greatest("n_words", F.lit(1))
    ratio = {"symbols": F.floor(1000 * F.col("n_symbols") / n),
             "lines": F.floor(1000 * F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))),
             "repeats": F.floor(1000 * F.col("n_repeat_words") / n),
             "length": F.floor(1000 * F.col("word_chars") / n)}
    d = d.withColumns({f"_{m}": ratio[m].cast("long") for m in METRICS})
    d = stored(d, "measures")
    sketch = (d.filter("not base_failed")
              .select("_lang", "_source", F.explode(F.array(*[
                  F.struct(F.lit(m).alias("metric"), bucket(F.col(f"_{m}")).alias("bucket")) for m in METRICS]))
                  .alias("x")).select("_lang", "_source", "x.*")
              .groupBy("_lang", "_source", "metric", "bucket").agg(F.count("*").alias("n")))
    sketch = stored(sketch, "sketch")
    # Written, so that its size is known when the join is planned: the rows are
    # shuffled to their cut-offs only if there are too many groups to send.
    groups = stored(cut_offs(merged_sketches(sketch, p), p), "limits")
    words, lines = F.col("n_words"), F.col("n_lines")
    rejected = (beyond(F.col("n_symbols"), words, F.col("symbols_max"), p.errors)
                | beyond(F.col("n_dup_lines"), lines, F.col("lines_max"), p.errors)
                | beyond(F.col("n_repeat_words"), words, F.col("repeats_max"), p.errors)
                | beyond(F.col("word_chars"), words, F.col("length_max"), p.errors)
                | beyond(F.col("word_chars"), words, F.col("length_min"), p.errors, -1))
    return (d.join(groups, F.col("_lang").eqNullSafe(F.col("g_lang"))
                   & F.col("_source").eqNullSafe(F.col("g_source")), "left")
            .select(*[c for c in own if c != text_col], *MEASURES, "base_failed",
                    (~F.col("base_failed") & ~F.coalesce(rejected, F.lit(False))).alias("kept")))
