"""Language identification: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased code points, anything but a letter counts as a
space.  Counts per language and bucket are summed by Spark; the model is a
matrix of languages x buckets of log probabilities, broadcast to the tasks,
which score a batch of texts by gathering and summing its columns.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.shingles import mix
from churnlens.llm.tables import importable

UNKNOWN = "und"


@dataclass(frozen=True)
class NaiveBayes:
    """`rows_per_language`: expected number of labelled rows that are learned
    from in each language (chosen by a hash of the id); `max_languages` bounds
    the model, a table with more labels is refused."""
    orders: tuple[int, ...] = (1, 2, 3)
    bits: int = 16
    alpha: float = 0.1
    rows_per_language: int = 5_000
    max_languages: int = 512


@functools.cache
def _letters() -> np.ndarray:
    """Code point -> lower-case code point of a letter, else a space."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _batches(texts: list[str | None], size: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, code points, offsets) of runs of rows."""
    first = 0
    while first < len(texts):
        n, last = 0, first
        while last < len(texts) and (n < size or last == first):
            n += len(texts[last] or "")
            last += 1
        part = [t or "" for t in texts[first:last]]
        points = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        yield first, _letters()[points], np.concatenate([[0], np.cumsum([len(t) for t in part])])
        first = last


def _grams(points: np.ndarray, offsets: np.ndarray, p: NaiveBayes) -> Iterator[np.ndarray]:
    """Buckets of the n-grams that start at each character, for each order;
    n-grams that would leave their text are in the extra last bucket."""
    wide = points.astype(np.uint64)
    for n in p.orders:
        h = np.zeros(len(points), dtype=np.uint64)
        if len(points) >= n:
            for j in range(n):
                h[: len(points) - n + 1] += wide[j: len(points) - n + 1 + j] * np.uint64(
                    (0x9E3779B97F4A7C15 * (2 * (j + 7 * n) + 1)) & 0xFFFFFFFFFFFFFFFF)
        bucket = (mix(h) >> np.uint64(64 - p.bits)).astype(np.int32)
        for k in range(1, n):
            tail = offsets[1:] - k
            bucket[tail[tail >= offsets[:-1]]] = 1 << p.bits
        yield bucket


def fit_languages(docs: DataFrame, learn: Column, params: NaiveBayes = NaiveBayes(), id_col: str = "doc_id",
                  text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log probabilities) from the rows for which ``learn`` holds
    and text and language are not null.  Priors are equal.  Without any such
    row there are no languages."""
    p = params
    importable(docs.sparkSession)
    known = docs.filter(learn).select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).dropna(
        subset=["text", "lang"])
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).limit(p.max_languages + 1)
    found = {r["lang"]: r["n"] for r in counts.collect()}
    if len(found) > p.max_languages:
        raise ValueError(f"more than {p.max_languages} languages")
    if not found:
        return [], np.zeros((0, (1 << p.bits) + 1), np.float32)
    share = F.create_map(*[x for k, n in found.items() for x in (F.lit(k), F.lit(p.rows_per_language / n))])
    sample = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < share[F.col("lang")] * (1 << 30))
    schema = pa.schema([("lang", pa.string()), ("bucket", pa.int32()), ("n", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), np.array(batch.column(1).to_pylist())
            for lang in np.unique(langs):
                total = totals.setdefault(str(lang), np.zeros((1 << p.bits) + 1, np.int64))
                own = [t for t, x in zip(texts, langs) if x == lang]
                for _, points, offsets in _batches(own):
                    for bucket in _grams(points, offsets, p):
                        total += np.bincount(bucket, minlength=len(total))
        for lang, total in totals.items():
            at = np.flatnonzero(total[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(total[at])],
                schema=schema)

    summed = (sample.select("text", "lang").mapInArrow(count, "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    table = summed.toArrow()  # at most languages x buckets rows
    langs = sorted(found)
    matrix = np.full((len(langs), 1 << p.bits), p.alpha)
    row = np.searchsorted(np.array(langs), np.array(table["lang"].to_pylist(), dtype=object).astype(str)) \
        if table.num_rows else np.empty(0, np.int64)
    matrix[row, table["bucket"].to_numpy()] += table["n"].to_numpy()
    logs = np.log(matrix) - np.log(matrix.sum(axis=1, keepdims=True))
    return langs, np.hstack([logs, np.zeros((len(langs), 1))]).astype(np.float32)


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], params: NaiveBayes = NaiveBayes(),
             text_col: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the likeliest language and its posterior probability.

    The whole text is scored.  A null text or one without a letter, and any
    text under a model without languages, is `und` with score 0.  Ties go to
    the first language in order.  Columns of ``docs`` with the names of ``out``
    are replaced.
    """
    spark, p = docs.sparkSession, params
    importable(spark)
    shared = spark.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in out]
    at = kept.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logs = shared.value
        for batch in batches:
            texts = batch.column(at).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            for first, points, offsets in _batches(texts) if langs else ():
                full = np.flatnonzero(np.diff(offsets))
                if not len(full):
                    continue
                total = np.zeros((len(langs), len(full)))
                for bucket in _grams(points, offsets, p):
                    for k, own in enumerate(logs):
                        total[k] += np.add.reduceat(own[bucket], offsets[full], dtype=np.float64)
                lettered = np.maximum.reduceat(points != 32, offsets[full])
                best = total.argmax(axis=0)
                sure = 1 / np.exp(total - total.max(axis=0)).sum(axis=0)
                for i, b, s in zip(full[lettered] + first, best[lettered], sure[lettered]):
                    names[i], scores[i] = langs[b], s
            columns = [batch.column(i) for i in range(len(kept))]
            yield pa.RecordBatch.from_arrays(
                columns + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*kept, *out])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[docs[c] for c in kept]).schema]
    return docs.select(*[docs[c] for c in kept]).mapInArrow(
        run, ", ".join(fields + [f"`{out[0]}` string", f"`{out[1]}` double"]))
