"""Benchmark decontamination by size-partitioned containment MinHash.

A short test item inside a long document has a tiny Jaccard similarity, so
whole-set signatures cannot find it.  Containment of the item is estimated from
the item's side instead: its sketch holds its smallest shingle hashes, and the
share of them that a document has estimates the share of the whole item.

Items are partitioned by size, a class from one power of two to the next, and
every class has an index of its own that a document is looked up in.  Items of the
first class are their own sketch.  The sketch of each larger class is longer, and
the number of hits that makes a candidate there is the largest at which an item at the
threshold is missed with a probability below `miss`, so both the work on false
candidates and the loss are bounded class by class.  Candidates are verified by exact
containment of the full shingle set.

Documents are probed where they lie, whole and without a shuffle; the items go
to the tasks in blocks of at most `block_bytes` of text, one pass over the
documents per block, so a benchmark of any size works with bounded memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm import shingles as S
from churnlens.llm.tables import importable


@dataclass(frozen=True)
class Decontam:
    """An item is found in a document that has at least `percent` % of its shingles.
    `sketch`: the sketch of the first size class; `longer`: by how much each class's
    is longer than the one before."""
    width: int = 5
    percent: int = 80
    sketch: int = 32
    longer: int = 8
    miss: float = 1e-9
    block_bytes: int = 16 << 20


def size_class(size: int, p: Decontam) -> int:
    """0 up to `sketch` shingles, then one class a power of two."""
    return max(0, (-(-size // p.sketch) - 1).bit_length())


def least_hits(size: int, sketch: int, percent: int, miss: float) -> int:
    """The largest number of sketch hits that an item of `size` shingles, of
    which just `percent` % are in a document, falls below with a probability of
    at most `miss`; the sketch is a random sample without replacement."""
    need = -(-percent * size // 100)
    if size <= sketch:
        return max(need, 1)
    below, hits = 0.0, 0
    while True:
        p = math.comb(need, hits) * math.comb(size - need, sketch - hits) / math.comb(size, sketch)
        if below + p > miss or hits >= min(need, sketch):
            return max(hits, 1)
        below += p
        hits += 1


class SizeClass:
    """The sketches of the items of one class, as sorted arrays."""

    def __init__(self, items: np.ndarray, sets: list[np.ndarray], number: int, p: Decontam):
        size = p.sketch + p.longer * number
        known: dict[int, int] = {}
        self.hits = {int(i): known.setdefault(len(sets[i]), least_hits(len(sets[i]), size, p.percent, p.miss)) for i in items}
        parts = [sets[i][:size] for i in items]  # sorted: the smallest hashes
        keys, owner = np.concatenate(parts), np.repeat(items, [len(x) for x in parts])
        order = np.argsort(keys, kind="stable")
        self.items = owner[order]
        self.keys, self.first = np.unique(keys[order], return_index=True)
        self.last = np.append(self.first[1:], len(owner))
        bits = max(16, int(len(self.keys)).bit_length() + 6)
        self.mask = np.uint64((1 << bits) - 1)
        self.seen = np.zeros(1 << bits, dtype=bool)
        self.seen[self.keys & self.mask] = True

    def candidates(self, hashes: np.ndarray, at: np.ndarray) -> Iterator[tuple[int, int]]:
        """(document, item) with enough sketch hits; document d's hashes are hashes[at[d]:at[d + 1]]."""
        likely = np.flatnonzero(self.seen[hashes & self.mask])
        place = np.minimum(np.searchsorted(self.keys, hashes[likely]), len(self.keys) - 1)
        real = self.keys[place] == hashes[likely]
        likely, place = likely[real], place[real]
        if not len(likely):
            return
        doc = np.searchsorted(at, likely, side="right") - 1
        once = np.unique(doc * len(self.keys) + place)
        doc, place = once // len(self.keys), once % len(self.keys)
        for d in np.unique(doc).tolist():
            found = np.concatenate([self.items[self.first[k]: self.last[k]] for k in place[doc == d]])
            items, n = np.unique(found, return_counts=True)
            yield from ((d, i) for i, k in zip(items.tolist(), n.tolist()) if k >= self.hits[i])


class ItemIndex:
    """The size classes and full sets of one block of items."""

    def __init__(self, ids: list, texts: pa.Array, p: Decontam):
        self.p, self.ids, self.sets = p, [], []
        for row, hashes in S.text_shingles(texts, S.ALNUM_WORDS, p.width):
            if len(hashes):
                self.ids.append(ids[row])
                self.sets.append(np.unique(hashes))
        self.sizes = np.array([len(s) for s in self.sets], dtype=np.int64)
        of = np.array([size_class(n, p) for n in self.sizes.tolist()], dtype=np.int64)
        self.classes = [SizeClass(np.flatnonzero(of == k), self.sets, k, p) for k in np.unique(of).tolist()]

    def search(self, texts: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(row, item index, shared shingles) of every contained item."""
        if not self.classes:
            return
        for row, data, offsets in S.blocks(texts):
            words, counts = S.word_hashes(data, offsets, S.ALNUM_WORDS)
            hashes, n_of = S.shingle_hashes(words, counts, self.p.width)
            at = np.concatenate([[0], np.cumsum(n_of)])
            for own_class in self.classes:
                last, own = -1, None
                for d, item in own_class.candidates(hashes, at):
                    if d != last:
                        last, own = d, np.unique(hashes[at[d]: at[d + 1]])
                    where = np.minimum(np.searchsorted(own, self.sets[item]), len(own) - 1)
                    shared = int((own[where] == self.sets[item]).sum())
                    if 100 * shared >= self.p.percent * self.sizes[item]:
                        yield row + d, item, shared


def _item_blocks(benchmark: DataFrame, p: Decontam, item_col: str, text_col: str) -> list[ItemIndex]:
    """The items in blocks of at most about `block_bytes` of text (a single
    longer item is a block of its own)."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(text_col).alias("text")).distinct()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, -(-total // p.block_bytes))
    for i in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == i).toArrow()
        yield ItemIndex(part["item"].to_pylist(), part["text"].combine_chunks(), p)


def contained_items(docs: DataFrame, benchmark: DataFrame, params: Decontam = Decontam(),
                    id_col: str = "doc_id", text_col: str = "text",
                    item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(id_col, item_col, n_shingles, n_shared, containment) of every item
    found in a document.

    Words are runs of ASCII letters and digits and of non-ASCII characters,
    A-Z lower-cased.  An item or document of fewer than `width` words is one
    shingle, the whole sequence: such an item is found only in a document that
    is that sequence.  Null or wordless texts contain nothing and are
    contained in nothing.  A repeated item counts once, a repeated document
    row each time; null ids are returned as null.
    """
    spark = docs.sparkSession
    importable(spark)
    id_type = docs.select(id_col).schema[0].dataType
    item_type = benchmark.select(item_col).schema[0].dataType
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    schema = pa.schema([("id", pa.int64()), ("item", pa.int64()), ("n_shingles", pa.int64()),
                        ("n_shared", pa.int64())])

    def search(index):
        def run(batches):
            for batch in batches:
                rows, items, n, shared = [], [], [], []
                for row, item, both in index.value.search(batch.column(1)):
                    rows.append(row), items.append(index.value.ids[item])
                    n.append(int(index.value.sizes[item])), shared.append(both)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(items, pa.int64()),
                     pa.array(n, pa.int64()), pa.array(shared, pa.int64())], schema=schema)
        return run

    out = None
    for index in _item_blocks(benchmark, params, item_col, item_text_col):
        part = base.mapInArrow(search(spark.sparkContext.broadcast(index)),
                               "id long, item long, n_shingles long, n_shared long")
        out = part if out is None else out.unionByName(part)
    return out.select(F.col("id").cast(id_type).alias(id_col), F.col("item").cast(item_type).alias(item_col),
                      "n_shingles", "n_shared", (F.col("n_shared") / F.col("n_shingles")).alias("containment"))


def without_items(docs: DataFrame, benchmark: DataFrame, params: Decontam = Decontam(),
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item; in
    place, without a join (so rows with a null id are judged too)."""
    spark = docs.sparkSession
    importable(spark)
    at = docs.columns.index(text_col)

    def drop(index):
        def run(batches):
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for row, _, _ in index.value.search(batch.column(at)):
                    keep[row] = False
                yield batch.filter(pa.array(keep))
        return run

    for index in _item_blocks(benchmark, params, item_col, item_text_col):
        docs = docs.mapInArrow(drop(spark.sparkContext.broadcast(index)), docs.schema)
    return docs
