"""Packing as a cutting-stock problem over the histogram of lengths.

A sequence costs no padding if it is full or as long as a power of two.  The
linear program chooses how often each pattern (lengths that fill a sequence
without padding) is used, at the least cost of sequences and of the pieces
left over, which have to be cut.  Its columns are generated: the current prices
of the lengths go into a knapsack by dynamic programming, whose best fillings
are the patterns that lower the cost.  The program has one row a length, so its
size is bounded by the capacity, not by the corpus.

The patterns are used a whole number of times, single sequences complete the
plan from what rounding leaves, and the last pieces form one run that is cut
every `capacity` tokens and, at its end, into powers of two.  Pieces take their
places by their rank within their length: a count before their part of the
table plus their rank within it.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zlib
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.packing import _byte_characters
from churnlens.llm.tables import importable, stored

#: Fixed value: how byte-level tokenizers of this family split a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@dataclass(frozen=True)
class CuttingStock:
    """`tokenizer`: path of a byte-level tokenizer file.  `cut_cost` and
    `sequence_cost` are the costs of a cut and of a sequence.  Columns are
    generated until the plan is proven to be within `gap` of the least cost, or
    `turns` times."""
    tokenizer: str = ""
    capacity: int = 1024
    end_id: int = 0
    cut_cost: float = 1.0
    sequence_cost: float = 0.25
    gap: float = 0.002
    turns: int = 16


class ByteEncoder:
    """Token ids by the vocabulary of a byte-level tokenizer file; its special
    tokens are found in a text as the file's own tokenizer finds them."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        byte = {c: b for b, c in _byte_characters().items()}
        ranks = {bytes(byte[c] for c in token): i for token, i in parts["model"]["vocab"].items() if token not in special}
        self.path = path
        self.size = max([*ranks.values(), *special.values()]) + 1
        self.encoding = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    @functools.cached_property
    def whole(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def encode(self, text: str) -> np.ndarray:
        try:
            return self.encoding.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # a run of white space too long for the pattern's back-tracking
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@functools.lru_cache(2)
def _encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long, part long, no long, rank long, ids binary"


def _packed_ids(ids: np.ndarray, narrow: bool) -> bytes:
    """The width of an id in bytes, then the ids."""
    return b"\x02" + ids.astype("<u2").tobytes() if narrow else b"\x04" + ids.astype("<u4").tobytes()


def _unpacked_ids(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype("<u4")


def _tokenise(p: CuttingStock, batch_bytes: int = 1 << 21):
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "part", "no", "rank"]
    schema = pa.schema([(c, pa.int64()) for c in names] + [("ids", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder = _encoder(p.tokenizer)
        narrow = max(encoder.size, p.end_id + 1) <= 1 << 16
        seen = np.zeros(p.capacity + 1, dtype=np.int64)
        no = held = 0
        rows: list[tuple] = []

        def batch_of_rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                ids = np.append(encoder.encode(text.as_py() or ""), np.uint32(p.end_id)).astype("<u4")
                for at in range(0, len(ids), p.capacity):
                    own = ids[at: at + p.capacity]
                    n = len(own)
                    rows.append((key.as_py(), at, n, zlib.crc32(own), len(ids), part, no, int(seen[n]),
                                 _packed_ids(own, narrow) if n < p.capacity else None))
                    seen[n] += 1
                    no += 1
                    held += 200 + 2 * n
                    if held > batch_bytes:
                        yield batch_of_rows()
                        rows, held = [], 0
        if rows:
            yield batch_of_rows()

    return run


def token_pieces(docs: DataFrame, params: CuttingStock, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's tokens with its end id, cut every `capacity` tokens.
    `part`, `no` and `rank` number the rows of the task, and those of equal
    length among them; full pieces don't carry their ids."""
    importable(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(_tokenise(params), PIECES)


def _knapsack(lengths: np.ndarray, prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For every fill the best sum of prices of lengths that make it, and the last length taken."""
    best = np.full(capacity + 1, -np.inf)
    best[0] = 0
    last = np.full(capacity + 1, -1)
    upto = np.searchsorted(lengths, np.arange(capacity + 1), side="right")
    for fill in range(1, capacity + 1):
        k = upto[fill]
        if k:
            sums = best[fill - lengths[:k]] + prices[:k]
            i = int(sums.argmax())
            best[fill], last[fill] = sums[i], i
    return best, last


def fills(p: CuttingStock) -> list[int]:
    """The lengths of a sequence that need no padding; short ones that cost more
    than leaving their pieces over are no use to the plan."""
    least = p.sequence_cost * p.capacity / (p.cut_cost + p.sequence_cost)
    return sorted({1 << k for k in range(p.capacity.bit_length()) if least < 1 << k < p.capacity} | {p.capacity})


def _complements(lengths: np.ndarray, at: np.ndarray, have: np.ndarray, room: int) -> Iterator[list[int]]:
    """One, two or three of the lengths ``have`` (ascending places) that make ``room``."""
    if at[room] >= 0:
        yield [int(at[room])]
    have = have[lengths[have] < room]
    for third in [None, *have[:32]]:
        left = room - (0 if third is None else int(lengths[third]))
        ok = have[lengths[have] < left]
        fits = ok[at[left - lengths[ok]] >= 0]
        for i in fits[::-1][:4].tolist():
            yield [i, int(at[left - lengths[i]])] + ([] if third is None else [int(third)])


def _filled(last: np.ndarray, lengths: np.ndarray, fill: int, m: int) -> np.ndarray:
    """The pattern that the knapsack found for ``fill``."""
    pattern = np.zeros(m)
    while fill:
        pattern[last[fill]] += 1
        fill -= lengths[last[fill]]
    return pattern


def _start(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> list[tuple[int, np.ndarray]]:
    """(length, pattern): full patterns, longest lengths first, each used until it has used up a
    length, which is then its own row of the program."""
    m, rest = len(lengths), counts.astype(float)
    at = np.full(capacity + 1, -1)
    at[lengths] = np.arange(m)
    out = []
    for i in range(m - 1, -1, -1):
        while at[lengths[i]] >= 0:
            room = capacity - int(lengths[i])
            have = np.flatnonzero(at[lengths] >= 0)
            picked = next(_complements(lengths, at, have, room), None)
            if picked is not None:
                pattern = np.bincount(picked, minlength=m).astype(float)
            else:  # more pieces, those that there is most of
                best, last = _knapsack(lengths[have], rest[have] / rest[have].max(), room)
                if not np.isfinite(best[room]):
                    break
                pattern = np.zeros(m)
                pattern[have] = _filled(last, lengths[have], room, len(have))
            pattern[i] += 1
            own = np.flatnonzero(pattern)
            r = own[(rest[own] / pattern[own]).argmin()]
            rest = np.maximum(rest - rest[r] / pattern[r] * pattern, 0)
            rest[r] = 0
            at[lengths[r]] = -1
            out.append((int(r), pattern))
        at[lengths[i]] = -1
    return out


def _sums(row: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """row @ matrix in one thread: the driver's other cores may be busy."""
    return np.einsum("i,ij->j", row, matrix)


def fractional(lengths: np.ndarray, counts: np.ndarray, p: CuttingStock) -> list[tuple[np.ndarray, float]]:
    """The patterns (how often each length) of the linear program's solution and
    how often each is used.  Simplex with an explicit inverse, whose pieces left
    over are slacks; it ends at the gap or after `turns` pricings, with a plan
    that holds every piece in either case."""
    m = len(lengths)
    left_cost = lengths / p.capacity * (p.cut_cost + p.sequence_cost)
    cost = left_cost.copy()
    # What each row holds: a pattern, or the left-over pieces of a length.
    basis: list[tuple[np.ndarray | None, int]] = [(None, i) for i in range(m)]
    # Counts a little apart from each other: equal ones would let steps of no length go round.
    counts = counts + np.random.default_rng(m).uniform(0, 1e-3, m)
    for r, pattern in _start(lengths, counts, p.capacity):
        basis[r], cost[r] = (pattern, -1), p.sequence_cost
    tokens = float(lengths @ counts)
    good = fills(p)

    def solved() -> tuple[np.ndarray, np.ndarray]:
        columns = np.eye(m)
        for r, (pattern, left) in enumerate(basis):
            columns[:, r] = pattern if left < 0 else np.eye(1, m, left)[0]
        inverse = np.linalg.inv(columns)
        return inverse, np.maximum(inverse @ counts, 0)

    inverse, amount = solved()

    def enter(column: np.ndarray, price: float, held: tuple[np.ndarray | None, int]) -> None:
        own = np.flatnonzero(column)
        way = (inverse[:, own] * column[own]).sum(axis=1)
        rows = np.flatnonzero(way > 1e-9)
        if not len(rows):
            return
        r = rows[(amount[rows] / way[rows]).argmin()]
        step = amount[r] / way[r]
        amount[:] = np.maximum(amount - step * way, 0)
        amount[r] = step
        pivot = inverse[r] / way[r]
        inverse[:] -= np.outer(way, pivot)
        inverse[r] = pivot
        cost[r], basis[r] = price, held

    # Prices of the basis swing widely, so columns are sought at prices between them and the best
    # known, which start from every token at its share of a full sequence.
    center, step = lengths * p.sequence_cost / p.capacity, 0.25
    bound = float(center @ counts)
    for turn in range(p.turns):
        if turn % 16 == 15:  # rounding errors of the updates
            inverse, amount = solved()
        prices = np.minimum(center + step * (_sums(cost, inverse) - center), left_cost)
        best, last = _knapsack(lengths, prices, p.capacity)
        # No plan costs less: a sequence of f tokens has at most this reduced cost a token.
        short = min([(p.sequence_cost - best[f]) / f for f in good if np.isfinite(best[f])], default=0.0)
        least = float(prices @ counts) + min(short, 0.0) * tokens
        if least > bound:
            bound, center = least, prices
        if float(cost @ amount) - bound <= p.gap * float(cost @ amount):
            break
        found: dict[bytes, np.ndarray] = {}
        for f in good:
            # The best filling that holds each length, most promising first.
            rest = f - lengths
            value = np.where(rest >= 0, best[np.maximum(rest, 0)], -np.inf) + prices
            for i in np.argsort(-value)[:32]:
                if np.isfinite(value[i]):
                    pattern = _filled(last, lengths, f - lengths[i], m)
                    pattern[i] += 1
                    found.setdefault(pattern.tobytes(), pattern)
        entered = False
        for pattern in found.values():
            if p.sequence_cost - _sums(cost, inverse) @ pattern < -1e-9:
                enter(pattern, p.sequence_cost, (pattern, -1))
                entered = True
        for i in np.argsort(left_cost - _sums(cost, inverse))[:16].tolist():
            if left_cost[i] - _sums(cost, inverse)[i] < -1e-9:
                enter(np.eye(1, m, i)[0], left_cost[i], (None, i))
                entered = True
        if not entered and step == 1:
            break
        step = max(0.25, step / 2) if entered else min(1.0, 2 * step)
    return [(pattern, float(x)) for (pattern, left), x in zip(basis, amount) if left < 0 and x > 1e-9]


def _single(lengths: np.ndarray, rest: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """Full sequences from single pieces, longest first: each is completed by one,
    two or three pieces that fill it exactly, where there are such."""
    at = np.full(capacity + 1, -1)
    at[lengths] = np.where(rest > 0, np.arange(len(lengths)), -1)
    out = []
    for i in range(len(lengths) - 1, -1, -1):
        found = True
        while rest[i] and found:
            found = False
            for picked in _complements(lengths, at, np.flatnonzero(rest > 0), capacity - int(lengths[i])):
                need = np.bincount([i, *picked], minlength=len(lengths))
                if not (need > rest).any():
                    rest -= need
                    at[lengths[rest == 0]] = -1
                    out.append((need.astype(float), 1))
                    found = True
                    break
    return out


@dataclass
class Plan:
    """`slots`: (length, first rank, pieces, base sequence, copies, offset): the
    piece of rank first + i is in sequence base + i // copies, at offset +
    (i % copies) * length.  `run`: length -> (first rank, start of its pieces
    in the run); the run's sequences start at `run_base`."""
    slots: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    run: dict[int, tuple[int, int]] = field(default_factory=dict)
    run_base: int = 0
    run_length: int = 0


def cutting_plan(histogram: dict[int, int], p: CuttingStock) -> Plan:
    """The places of all pieces, from the number of pieces of each length."""
    plan, sequences = Plan(), 0
    rank = dict.fromkeys(histogram, 0)
    if p.capacity in histogram:
        plan.slots.append((p.capacity, 0, histogram[p.capacity], 0, 1, 0))
        sequences = histogram[p.capacity]
    lengths = np.array(sorted(n for n in histogram if n < p.capacity), dtype=np.int64)
    rest = np.array([histogram[n] for n in lengths.tolist()], dtype=np.int64)
    chosen: list[tuple[np.ndarray, int]] = []
    if len(lengths):
        solved = fractional(lengths, rest, p)
        for pattern, x in solved:
            # Rounding errors must not use a piece twice.
            most = int(np.min(rest[pattern > 0] // pattern[pattern > 0].astype(np.int64)))
            times = min(int(x + 1e-6), most)
            if times:
                chosen.append((pattern, times))
                rest -= times * pattern.astype(np.int64)
        for pattern, x in sorted(solved, key=lambda s: -(s[1] % 1)):
            if x % 1 > 0.25 and not (pattern > rest).any() and lengths @ pattern == p.capacity:
                chosen.append((pattern, 1))
                rest -= pattern.astype(np.int64)
        chosen += _single(lengths, rest, p.capacity)
    for pattern, times in chosen:
        offset = 0
        for i in np.flatnonzero(pattern)[::-1].tolist():
            n, copies = int(lengths[i]), int(pattern[i])
            plan.slots.append((n, rank[n], times * copies, sequences, copies, offset))
            rank[n] += times * copies
            offset += copies * n
        sequences += times
    plan.run_base = sequences
    for n, left in zip(lengths.tolist(), rest.tolist()):
        if left:
            plan.run[n] = (rank[n], plan.run_length)
            plan.run_length += n * left
    return plan


def _cells(plan: Plan, capacity: int, first: int, end: int) -> Iterator[tuple[int, int, int, int]]:
    """(skip, length, sequence, offset) of the cuts of run positions first..end."""
    full = plan.run_length - plan.run_length % capacity
    at = first
    while at < end:
        if at < full:
            start, size, sequence = at - at % capacity, capacity, plan.run_base + at // capacity
        else:  # the rest of the run in powers of two, largest first
            start, sequence, size = full, plan.run_base + full // capacity, 0
            for size in (1 << k for k in range(capacity.bit_length(), -1, -1) if (plan.run_length - full) >> k & 1):
                if at < start + size:
                    break
                start, sequence = start + size, sequence + 1
        upto = min(end, start + size)
        yield at - first, upto - at, sequence, at - start
        at = upto


PLACED = ("id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "part long, no long, skip long")


def _placed(shared, p: CuttingStock):
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "no", "skip"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan: Plan = shared.value
        slots = np.array(plan.slots, dtype=np.int64).reshape(-1, 6)
        slots = slots[np.lexsort((slots[:, 1], slots[:, 0]))]
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in
                    ("start", "length", "ids_crc32", "doc_tokens", "part", "no", "rank")}
            length, rank = cols["length"], cols["rank"]
            at = np.full(len(rank), -1, dtype=np.int64)
            for n in np.unique(length).tolist():
                a, b = np.searchsorted(slots[:, 0], [n, n + 1])
                own = length == n
                kept = rank[own] < (plan.run[n][0] if n in plan.run else np.iinfo(np.int64).max)
                at[own] = np.where(kept, a + np.searchsorted(slots[a:b, 1], rank[own], side="right") - 1, -1)
            w = np.flatnonzero(at >= 0)
            _, first, _, base, copies, offset = slots[at[w]].T if len(w) else np.empty((6, 0), np.int64)
            whole = [batch.column("id").take(pa.array(w)), *[pa.array(cols[c][w]) for c in (
                "start", "length", "ids_crc32", "doc_tokens")], pa.array(base + (rank[w] - first) // copies),
                pa.array(offset + (rank[w] - first) % copies * length[w]),
                pa.array(cols["part"][w]), pa.array(cols["no"][w]), pa.array(np.zeros(len(w), np.int64))]
            yield pa.RecordBatch.from_arrays(whole, names=names)
            ids = batch.column("id")
            rows = []
            for i in np.flatnonzero(at < 0).tolist():
                n = int(length[i])
                first_rank, position = plan.run[n]
                start = position + (int(rank[i]) - first_rank) * n
                for skip, size, sequence, place in _cells(plan, p.capacity, start, start + n):
                    rows.append((ids[i].as_py(), int(cols["start"][i]) + skip, size,
                                 int(cols["ids_crc32"][i]) if size == n else None, int(cols["doc_tokens"][i]), sequence,
                                 place, int(cols["part"][i]), int(cols["no"][i]), skip))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [zlib.crc32(_unpacked_ids(ids)[skip: skip + n]) for ids, skip, n in zip(*(
            batch.column(c).to_pylist() for c in ("ids", "skip", "length")))]
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int64()) if c == "ids_crc32" else batch.column(c) for c in OUT], names=OUT)


OUT = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def pack_by_patterns(docs: DataFrame, params: CuttingStock, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every piece with its place: id_col, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Null or empty text: the end id alone.  Null ids, repeated rows and texts of
    any length are packed like any row; ids are whole numbers, or text of one.  Extra columns are ignored; an empty
    table gives no rows.  Texts are tokenised once, into a written table."""
    p, spark = params, docs.sparkSession
    pieces = stored(token_pieces(docs, p, id_col, text_col), "pieces")
    counts = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "counts")
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(cutting_plan(histogram, p))
    before = stored(counts.select("length", "part", (F.sum("n").over(
        Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n"))
        .alias("before")), "before")
    ranked = (pieces.drop("ids").join(before, ["length", "part"])
              .withColumn("rank", F.col("rank") + F.col("before")).drop("before"))
    placed = stored(ranked.mapInArrow(_placed(plan, p), PLACED), "placed")
    cut = (placed.filter("ids_crc32 is null").join(pieces.select("part", "no", "ids"), ["part", "no"])
           .mapInArrow(_cut, ", ".join(f"{c} long" for c in OUT)))
    return (placed.filter("ids_crc32 is not null").select(*OUT).unionByName(cut)
            .withColumnRenamed("id", id_col))
