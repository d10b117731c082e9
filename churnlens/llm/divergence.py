"""How the sources of a language differ in their words, from collapsed texts.

1. Texts that are equal within a language are one text with the number of its
   copies in each source; only that one is tokenised.
2. Its terms add to counts and document frequencies weighted by the copies:
   summed in the task first, then by (language, term, source).
3. Every group spreads 10^9 parts over the language's kept terms in proportion
   to count + 1.  The divergence of two sources is a sum over all kept terms,
   but most terms are in few sources: the sum over terms that a group lacks
   needs only how many terms have which count, so the sources of a term are
   joined only where both have it.

All numbers are whole; sums stay below 2^63 for up to 5 * 10^8 kept terms a
language, and beyond that Spark raises an overflow instead of a wrong value.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.tables import importable, stored
from churnlens.llm.tally import byte_table, byte_words

#: Letters and every byte of a character beyond ASCII.
TERM_BYTES = byte_table(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
TERMS = "lang string, source string, term string, n long, docs long"


@dataclass(frozen=True)
class Divergence:
    """`min_docs`: documents of the language that a kept term is in.
    `top_terms`: ranks of the `term` part.  `parts`: what a group spreads.
    `held_terms`: counters a task holds before it passes them on."""
    min_docs: int = 3
    top_terms: int = 200
    parts: int = 1_000_000_000
    held_terms: int = 1 << 18


def collapsed(docs: DataFrame) -> DataFrame:
    """(lang, text, copies: array of (source, n)): every different text of a
    language once.  Copies are summed on the map side before any shuffle, so a
    text that fills a third of the rows is one row a task."""
    base = docs.withColumn("digest", F.unhex(F.sha2("text", 256)))
    copies = (base.groupBy("lang", "digest", "source").agg(F.count("*").alias("n"))
              .groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("copies")))
    return (base.groupBy("lang", "digest").agg(F.any_value("text").alias("text"))
            .join(copies, ["lang", "digest"]).select("lang", "text", "copies"))


def _terms(p: Divergence):
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()),
                        ("n", pa.int64()), ("docs", pa.int64())])

    def emit(counts: dict, docs: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), own in counts.items():
            terms = list(own)
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(lang, pa.string()), len(terms)), pa.repeat(pa.scalar(source, pa.string()), len(terms)),
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array(own.values(), pa.int64()),
                 pa.array(map(docs[lang, source].__getitem__, terms), pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, Counter] = {}
        docs: dict[tuple, Counter] = {}
        held = 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for row, (lang, copies) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                own: Counter | None = None
                data = texts[row].as_py()
                if len(copies) == 1 and copies[0]["n"] == 1 and len(data) < 1 << 20:
                    key = lang, copies[0]["source"]
                    words = next(byte_words(data, TERM_BYTES))
                    count, doc = counts.setdefault(key, Counter()), docs.setdefault(key, Counter())
                    before = len(count)
                    count.update(words)
                    doc.update(set(words))
                    held += len(count) - before
                else:
                    own = Counter()
                    for words in byte_words(data, TERM_BYTES):
                        own.update(words)
                    for copy in copies:
                        key, n = (lang, copy["source"]), copy["n"]
                        count, doc = counts.setdefault(key, Counter()), docs.setdefault(key, Counter())
                        before = len(count)
                        for term, k in own.items():
                            count[term] += k * n
                            doc[term] += n
                        held += len(count) - before
                        if held > p.held_terms:  # a text of many sources
                            yield from emit(counts, docs)
                            counts, docs, held = {}, {}, 0
                if held > p.held_terms:
                    yield from emit(counts, docs)
                    counts, docs, held = {}, {}, 0
        yield from emit(counts, docs)

    return run


def _share(count: Column, total: Column, terms: Column, p: Divergence) -> Column:
    """1 + floor(parts * (count + 1) / (total + terms)), exactly."""
    wide = F.lit(p.parts).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", wide, (total + terms).cast("decimal(20,0)")).cast("long") + 1


def _apart(own: Column, other: Column) -> Column:
    """floor((own - other)^2 / other) of two shares."""
    return F.call_function("div", (own - other) * (own - other), other)


def source_divergence(docs: DataFrame, params: Divergence = Divergence(), text_col: str = "text",
                      lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part `pair`: every other source of the language by its divergence from the
    source's view.  Part `term`: the `top_terms` terms that the source has more
    often than its language.  Null language, source or text reads as empty.  A
    source without terms has counts of 0; a language without kept terms gives
    its pairs the value 0 and no terms; a language of one source has no pairs.
    Repeated rows are documents of their own.  Ties go by the item's bytes.
    Extra columns are ignored; an empty table gives no rows.
    """
    p, spark = params, docs.sparkSession
    importable(spark)
    base = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(a) for c, a in (
        (lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    # One shuffle by term serves its counts, their sums and the filter; the rows of a term are its sources.
    of_term = Window.partitionBy("lang", "term")
    kept = stored(collapsed(base).mapInArrow(_terms(p), TERMS).repartition("lang", "term")
                  .groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
                  .withColumns({"lang_n": F.sum("n").over(of_term), "lang_docs": F.sum("docs").over(of_term)})
                  .filter(F.col("lang_docs") >= p.min_docs).select("lang", "term", "source", "n", "lang_n"), "kept_terms")

    langs = stored(kept.groupBy("lang").agg(F.sum("n").alias("lang_total"),
                                            F.count_distinct("term").alias("terms")), "langs")
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("present"))
    zero = F.lit(0).cast("long")
    groups = stored(
        base.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "present", "lang_total", "terms")])
        # The share of a term that the source lacks.
        .withColumn("none", F.when(F.col("terms") > 0, _share(zero, F.col("total"), F.col("terms"), p))), "groups")

    shares = stored(
        kept.join(groups, ["lang", "source"])
        .select("lang", "source", "term", "none", _share(F.col("n"), F.col("total"), F.col("terms"), p).alias("p"),
                _share(F.col("lang_n"), F.col("lang_total"), F.col("terms"), p).alias("q")), "shares")

    a = shares.select("lang", "term", F.col("source").alias("a"), F.col("p").alias("pa"), F.col("none").alias("za"))
    b = shares.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("pb"), F.col("none").alias("zb"))
    pa_, pb, za, zb = map(F.col, ("pa", "pb", "za", "zb"))
    both = (a.join(b, ["lang", "term"]).filter("a != b").groupBy("lang", "a", "b")
            .agg(F.sum(_apart(pa_, pb) - _apart(pa_, zb) - _apart(za, pb)).alias("value"), F.count("*").alias("both")))
    # How many terms of a source have which share: all that the terms of one side alone need.
    spread = stored(shares.groupBy("lang", "source", "p").agg(F.count("*").alias("n")), "spread")
    left = groups.select("lang", F.col("source").alias("a"), F.col("none").alias("za"))
    right = groups.select("lang", F.col("source").alias("b"), F.col("none").alias("zb"))
    first = (spread.select("lang", F.col("source").alias("a"), F.col("p").alias("pa"), "n").join(right, "lang")
             .filter("a != b").groupBy("lang", "a", "b").agg(F.sum(F.col("n") * _apart(pa_, zb)).alias("value")))
    second = (spread.select("lang", F.col("source").alias("b"), F.col("p").alias("pb"), "n").join(left, "lang")
              .filter("a != b").groupBy("lang", "a", "b").agg(F.sum(F.col("n") * _apart(za, pb)).alias("value")))
    nothing = zero.alias("both")
    sums = (both.unionByName(first.select("*", nothing)).unionByName(second.select("*", nothing))
            .groupBy("lang", "a", "b").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"),
                                           F.sum("both").alias("both")))
    wide = (groups.select("lang", "terms", F.col("source").alias("a"), F.col("present").alias("na"), F.col("none").alias("za"))
            .join(groups.select("lang", F.col("source").alias("b"), F.col("present").alias("nb"),
                                F.col("none").alias("zb")), "lang").filter("a != b"))
    neither = F.col("terms") - F.col("na") - F.col("nb") + F.coalesce("both", zero)
    pairs = (wide.join(sums, ["lang", "a", "b"], "left")
             .select("lang", F.col("a").alias("source"), F.lit("pair").alias("part"), F.col("b").alias("item"),
                     F.when(F.col("terms") > 0, F.coalesce("value", zero.cast("decimal(38,0)"))
                            + neither.cast("decimal(19,0)") * _apart(za, zb).cast("decimal(19,0)"))
                     .otherwise(0).cast("long").alias("value")))
    over = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked_pairs = pairs.withColumn("rank", F.row_number().over(over))
    terms = (shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                           _apart(F.col("p"), F.col("q")).alias("value"))
             .withColumn("rank", F.row_number().over(over)).filter(F.col("rank") <= p.top_terms))
    return ranked_pairs.unionByName(terms)
