"""Compression classifier: zstandard dictionaries of good and bad text.

A text is cut into chunks, every chunk is compressed once with the dictionary
built from bad text and once with that built from good text.  The difference of
the two total sizes, divided by the text's own size, is calibrated by a
monotone curve fitted on labelled texts that the dictionaries have not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import importable


@dataclass(frozen=True)
class Compression:
    """`rows_per_class`: expected number of labelled rows learned from per
    class, chosen by a hash of the id, two thirds for the dictionary and one
    third for calibration; `most_rows` bounds them all where ids repeat.  The
    rows' whole texts are learned from, in pieces of `chunk` bytes."""
    chunk: int = 1024
    level: int = 3
    dictionary_bytes: int = 1 << 17
    rows_per_class: int = 3_000
    most_rows: int = 12_000


def _chunks(text: str | None, size: int) -> list[bytes]:
    data = (text or "").encode("utf-8", "surrogatepass")
    return [data[i: i + size] for i in range(0, len(data), size)]


def _dictionary(chunks: list[bytes], size: int) -> bytes:
    """A trained dictionary; of too few samples for training, the samples themselves."""
    import zstandard as z

    try:
        return z.train_dictionary(size, chunks).as_bytes()
    except z.ZstdError:
        return b"".join(chunks)[-size:]


class Scorer:
    """The two dictionaries and the curve, knots of (difference, score)."""

    def __init__(self, good: bytes, bad: bytes, p: Compression, score: float = 0.5):
        self.good, self.bad, self.p = good, bad, p
        self.knots = np.array([0.0]), np.array([score])

    def _compressors(self):
        import zstandard as z

        made = []
        for raw in (self.good, self.bad):
            d = z.ZstdCompressionDict(raw)
            d.precompute_compress(level=self.p.level)
            made.append(z.ZstdCompressor(level=self.p.level, dict_data=d, write_content_size=False,
                                         write_checksum=False, write_dict_id=False))
        return made

    def differences(self, texts: list[str | None]) -> np.ndarray:
        """(size by the bad dictionary - size by the good one) / own size; 0 for an empty text."""
        out = np.zeros(len(texts))
        if not self.good or not self.bad:
            return out
        good, bad = self._compressors()
        for i, text in enumerate(texts):
            parts = _chunks(text, self.p.chunk)
            if parts:
                g, b = sum(len(good.compress(x)) for x in parts), sum(len(bad.compress(x)) for x in parts)
                out[i] = (b - g) / sum(map(len, parts))
        return out

    def scores(self, texts: list[str | None]) -> np.ndarray:
        return np.interp(self.differences(texts), *self.knots)


def _monotone(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of a rising curve from x to the weighted share of y = 1: pooled
    adjacent violators, each pool's share drawn half a row towards the whole's;
    between the pools' centres the curve is linear."""
    prior = float((y * weight).sum() / weight.sum())
    pools: list[list[float]] = []  # weight, weight of y, weight * x, rows
    for i in np.argsort(x, kind="stable"):
        pools.append([weight[i], weight[i] * y[i], weight[i] * x[i], 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    w, wy, wx, rows = np.array(pools).T
    half = 0.5 * w / rows
    return wx / w, (wy + half * prior) / (w + half)


def fit_quality(docs: DataFrame, labels: DataFrame, learn: Column, params: Compression = Compression(),
                id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Scorer:
    """A scorer from the labelled rows for which ``learn`` (over ``labels``)
    holds.  Null labels and texts are left out; without rows of both classes
    every score is the share of good labels (0.5 without any)."""
    p = params
    importable(docs.sparkSession)
    known = labels.filter(learn).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")) \
        .filter("label in (0, 1) and id is not null").distinct()
    found = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(found) < 2:
        share = float(next(iter(found))) if found else 0.5
        return Scorer(b"", b"", p, share)
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    share = F.create_map(*[x for k, n in found.items() for x in (F.lit(k), F.lit(p.rows_per_class / n))])
    picked = (known.filter(unit < share[F.col("label")] * (1 << 30))
              .withColumn("curve", F.pmod(F.xxhash64("id", F.lit("curve")), F.lit(3)) == 0))
    # The picked labels are as many as the parameter says, whatever the corpus:
    # they go to the texts, which stay where they are.
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).dropna()
              .join(F.broadcast(picked), "id").select("label", "curve", "text")
              .orderBy(F.xxhash64("text"), "label", "text").limit(p.most_rows))
    schema = pa.schema([("label", pa.int32()), ("chunk", pa.binary())])

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(label, x) for x in _chunks(text, p.chunk)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.binary())], schema=schema)

    chunks = sample.filter("not curve").select("label", "text").mapInArrow(
        pieces, "label int, chunk binary").orderBy(F.xxhash64("chunk")).toArrow()
    label, chunk = chunks["label"].to_numpy(), chunks["chunk"].to_pylist()
    scorer = Scorer(*[_dictionary([c for c, x in zip(chunk, label) if x == k], p.dictionary_bytes)
                      for k in (1, 0)], p)
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(shared.value.differences(batch.column(1).to_pylist()))],
                names=["label", "x"])

    points = sample.filter("curve").select("label", "text").mapInArrow(measured, "label int, x double").toArrow()
    y = points["label"].to_numpy().astype(float)
    if len(y):
        # Every row stands for the labelled rows of its class that were not sampled.
        scale = np.array([max(1.0, found[k] / p.rows_per_class) for k in (0, 1)])
        scorer.knots = _monotone(points["x"].to_numpy(), y, scale[y.astype(int)])
    return scorer


def score_quality(docs: DataFrame, scorer: Scorer, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score between 0 and 1 for every whole text; null counts
    as empty, and an empty text has the score of no difference.  A column of
    the name ``out`` is replaced."""
    spark = docs.sparkSession
    importable(spark)
    shared = spark.sparkContext.broadcast(scorer)
    base = docs.select(*[docs[c] for c in docs.columns if c != out])
    at, kept = base.columns.index(text_col), base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(len(kept))]
                + [pa.array(shared.value.scores(batch.column(at).to_pylist()), pa.float64())], names=[*kept, out])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema]
    return base.mapInArrow(run, ", ".join(fields + [f"`{out}` double"]))
