"""MinHash near-duplicate classes with b-bit signatures.

1. Every text becomes its set of word shingles (64-bit hashes).  From
   `bands x rows` minima come the band keys (hashes of `rows` full minima)
   and a packed signature that keeps only the lowest `bits` bits of each.
2. Texts with equal sets are one class, found by the set's digest; the classes
   are the vertices of all that follows, and only a class's representative text
   goes on.  Ids come back in the result, so one id may have many texts.
3. Candidates share a band key.  Each key links its members to its smallest
   member, and the connected groups of these links hold every candidate pair.
4. A group is compared in blocks of bounded size, pair of blocks by pair of
   blocks: the similarity estimated from the share of equal signature
   positions, corrected for chance collisions, rejects most pairs, the rest is
   confirmed on the full sets.  A block pair returns stars over what it
   linked, not its pairs.
5. The components of the confirmed links are the result.

Memory of a task is bounded by two blocks, whatever a group's size.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm import shingles as S
from churnlens.llm.components import connected_components
from churnlens.llm.tables import importable, shuffle_partitions, stored


@dataclass(frozen=True)
class NearDup:
    """`percent`: two sets are linked if 100 * |intersection| >= percent * |union|.

    With 48 bands of 7 rows a pair at 85 % stays unseen with probability
    9e-9, at 80 % with 1e-5.  `margin` is six standard errors of the estimate
    from 336 positions of 2 bits."""
    width: int = 5
    percent: int = 80
    bands: int = 48
    rows: int = 7
    bits: int = 2
    margin: float = 0.14
    block_docs: int = 256
    block_shingles: int = 1 << 21

    @property
    def positions(self) -> int:
        return self.bands * self.rows


FEATURES = "id long, mark long, n_shingles long, digest binary, signature binary, band_keys array<long>"


def _minima(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low = np.full(len(a), 0xFFFFFFFF, dtype=np.uint32)
    for i in range(0, len(values), 1024):
        part = values[None, i: i + 1024] * a[:, None]
        part += b[:, None]
        np.minimum(low, part.min(axis=1), out=low)
    return low


def pack(minima: np.ndarray, bits: int) -> bytes:
    """The lowest `bits` bits of each minimum, as bit planes."""
    planes = [np.packbits((minima >> np.uint32(j)) & np.uint32(1)) for j in range(bits)]
    return b"".join(p.tobytes() for p in planes)


def estimate(one: np.ndarray, many: np.ndarray, bits: int, positions: int) -> np.ndarray:
    """Similarity estimates of one packed signature against rows of packed
    signatures: the share of equal positions by bit counts, less what
    positions of unequal minima share by chance."""
    differ = np.bitwise_xor(many, one).reshape(len(many), bits, -1)
    unequal = np.bitwise_count(np.bitwise_or.reduce(differ, axis=1)).sum(axis=1, dtype=np.int64)
    chance = 1 / (1 << bits)
    return ((1 - unequal / positions) - chance) / (1 - chance)


def _features(p: NearDup):
    rng = np.random.default_rng(20240229)
    a = rng.integers(0, 1 << 32, p.positions, dtype=np.uint32) | np.uint32(1)
    b = rng.integers(0, 1 << 32, p.positions, dtype=np.uint32)
    seeds = S.mix(np.arange(1, p.bands + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    schema = pa.schema([("id", pa.int64()), ("mark", pa.int64()), ("n_shingles", pa.int64()), ("digest", pa.binary()),
                        ("signature", pa.binary()), ("band_keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digests, signatures, keys = [], [], [], []
            for _, hashes in S.text_shingles(batch.column(1), S.SPACE_WORDS, p.width):
                own = np.unique(hashes)
                n.append(len(own))
                if not len(own):
                    digests.append(None), signatures.append(None), keys.append(None)
                    continue
                low = _minima((own >> np.uint64(32)).astype(np.uint32), a, b)
                key = seeds.copy()
                for column in low.reshape(p.bands, p.rows).T:
                    key = S.mix(key ^ column.astype(np.uint64))
                digests.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                signatures.append(pack(low, p.bits))
                keys.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(signatures, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], schema=schema)

    return run


def _sets(p: NearDup):
    schema = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sets = [], []
            digest = batch.column(2)
            for row, hashes in S.text_shingles(batch.column(1), S.SPACE_WORDS, p.width):
                own = np.unique(hashes).tobytes()
                if hashlib.blake2b(own, digest_size=16).digest() == digest[row].as_py():
                    ids.append(batch.column(0)[row].as_py())
                    sets.append(own)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sets, pa.binary())],
                                             schema=schema)

    return run


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact intersection sizes of the pairs (left[i], right[i])."""
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.concatenate([[True], every[1:] != every[:-1]])
    word = np.cumsum(new) - 1
    shared = np.bincount(word) > 1
    column = np.cumsum(shared) - 1
    width = int(shared.sum())
    if len(sets) ** 2 * width / 4e9 < (sizes[left] + sizes[right]).sum() * 2e-8 + len(left) * 2e-5:
        keep = shared[word]
        at, who = column[word[keep]], owner[keep]
        total = np.zeros((len(sets), len(sets)), dtype=np.float32)
        for first in range(0, width, 4096):
            a, b = np.searchsorted(at, [first, first + 4096])
            dense = np.zeros((len(sets), min(4096, width - first)), dtype=np.float32)
            dense[who[a:b], at[a:b] - first] = 1
            total += dense @ dense.T
        return total[left, right].astype(np.int64)
    return np.array([len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                     for x, y in zip(left, right)], dtype=np.int64)


def _compare(p: NearDup):
    """Stars over the confirmed links within a block, or between two blocks."""
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("id", "ascending")])
        ids = table["id"].to_numpy()
        first = np.concatenate([[True], ids[1:] != ids[:-1]])  # a repeated row counts once
        table, ids = table.filter(pa.array(first)), ids[first]
        block = table["block"].to_numpy()
        cross = table["low"][0].as_py() != table["high"][0].as_py()
        sets = [np.frombuffer(x, dtype=np.uint64) for x in table["shingles"].to_pylist()]
        signatures = np.array([np.frombuffer(x, dtype=np.uint8) for x in table["signature"].to_pylist()])
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        left, right = [], []
        for i in range(len(ids) - 1):
            small, large = np.minimum(sizes[i + 1:], sizes[i]), np.maximum(sizes[i + 1:], sizes[i])
            ok = (100 * small >= p.percent * large) & (
                estimate(signatures[i], signatures[i + 1:], p.bits, p.positions) >= p.percent / 100 - p.margin)
            if cross:
                ok &= block[i + 1:] != block[i]
            found = np.flatnonzero(ok) + i + 1
            left.append(np.full(len(found), i)), right.append(found)
        left = np.concatenate(left) if left else np.empty(0, np.int64)
        right = np.concatenate(right) if right else np.empty(0, np.int64)
        parent = np.arange(len(ids))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        if len(left):
            both = _intersections(sets, left, right)
            linked = 100 * both >= p.percent * (sizes[left] + sizes[right] - both)
            for x, y in zip(left[linked], right[linked]):
                x, y = root(x), root(y)
                parent[max(x, y)] = min(x, y)
        top = np.array([root(i) for i in range(len(ids))], dtype=np.int64)
        out = top != np.arange(len(ids))
        return pa.table([pa.array(ids[out]), pa.array(ids[top[out]])], schema=schema)

    return run


def near_duplicates(docs: DataFrame, params: NearDup = NearDup(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id_col, n_shingles, component_id, kept) for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links, ``kept`` marks
    the row that has it.  Null or wordless text: no shingles, linked with
    nothing, kept.  A text of fewer than `width` words is one shingle.  Rows
    that repeat an id and text get equal results; an id with several texts has a
    row for each, linked by its own text; a null id is never linked and is kept
    with a null component.  Ids are whole numbers, or text of one (other text
    is an error).  Other columns are ignored; an empty
    table gives no rows.
    """
    p, spark = params, docs.sparkSession
    importable(spark)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("mark"))
    features = stored(base.mapInArrow(_features(p), FEATURES), "features")
    usable = features.filter("n_shingles > 0 and id is not null")
    # A class's own row is that of its smallest id; its number is written with it.
    classes = stored(
        usable.groupBy("digest").agg(
            F.min(F.struct("id", "mark")).alias("own"), F.any_value("n_shingles").alias("n_shingles"),
            F.any_value("signature").alias("signature"), F.any_value("band_keys").alias("band_keys"))
        .select(F.monotonically_increasing_id().alias("vertex"), "own.*", "digest", "n_shingles", "signature",
                "band_keys"), "classes")

    keys = classes.select("vertex", F.explode("band_keys").alias("key"))
    # Written, so that a key with very many members is a skewed join of plain rows, which Spark splits.
    hubs = stored(keys.groupBy("key").agg(F.min("vertex").alias("hub"), F.count("*").alias("n"))
                  .filter("n > 1").select("key", "hub"), "hubs")
    candidates = keys.join(hubs, "key").filter("vertex != hub")
    groups = stored(connected_components(
        candidates.select(F.col("vertex").alias("src"), F.col("hub").alias("dst")))
        .select("vertex", F.col("component").alias("group")), "groups")

    members = stored(groups.join(classes.select("vertex", "id", "mark", "digest", "n_shingles", "signature"), "vertex"),
                     "members")
    sets = (members.select("vertex", "id", "mark", "digest").join(base, ["id", "mark"])
            .select(F.col("vertex").alias("id"), "text", "digest").mapInArrow(_sets(p), "id long, shingles binary"))
    size = stored(members.groupBy("group").agg(
        F.ceil(F.greatest(F.count("*") / p.block_docs,
                          F.sum("n_shingles") / p.block_shingles)).cast("long").alias("blocks")), "sizes")
    dealt = (members.select(F.col("vertex").alias("id"), "group", "signature").join(size, "group")
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
             .join(sets, "id")
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("group", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
                     "id", "block", "signature", "shingles"))
    stars = (dealt.repartition(shuffle_partitions(spark), "group", "low", "high")
             .groupBy("group", "low", "high").applyInArrow(_compare(p), "src long, dst long"))
    components = stored(connected_components(stars), "components")

    placed = (classes.select("vertex", "digest", "id").join(components, "vertex", "left")
              .withColumn("component", F.coalesce("component", "vertex")))
    smallest = placed.groupBy("component").agg(F.min("id").alias("component_id"))
    named = stored(placed.join(smallest, "component").select("digest", "component_id"), "named")
    result = (usable.select("id", "n_shingles", "digest").join(named, "digest")
              .select("id", "n_shingles", "component_id"))
    alone = features.filter("not (n_shingles > 0 and id is not null)").select(
        "id", "n_shingles", F.col("id").alias("component_id"))
    return (result.unionByName(alone)
            .select(F.col("id").alias(id_col), "n_shingles", "component_id",
                    F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")))
