"""Best-fit packing of token sequences, planned over the histogram of lengths.

Documents are tokenised, ended with an end id and cut into pieces only where
they are longer than a sequence.  The plan needs the number of pieces of each
length alone (at most `capacity` numbers, whatever the corpus): best-fit
decreasing puts whole runs of equal pieces into whole runs of equally filled
sequences.  Every run becomes a slot segment (length, first rank, base
sequence, copies per sequence, offset); the pieces take their slots by joining
on their rank within their length.
"""

from __future__ import annotations

import bisect
import functools
import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnlens.llm.tables import importable, stored


@dataclass(frozen=True)
class Packing:
    """`tokenizer`: path of a tokenizer file.  Sequences are numbered by the plan."""
    tokenizer: str = ""
    capacity: int = 4096
    end_id: int = 1


def _byte_characters() -> dict[int, str]:
    """Byte -> character of byte-level vocabularies: printable bytes stand for
    themselves, the others for the characters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())


class WordEncoder:
    """Token ids of a text, word by word with a bounded memory of known words.

    For tokenizers that normalise to NFC and lower case, drop white space, and
    separate letters from punctuation before byte-level merges.  Texts are
    split at ASCII white space; a word of Latin letters goes straight to the
    merges, any other word through the whole tokenizer, and so does a text that
    may hold special tokens (all begin with `<|`), which the tokenizer finds
    before anything else.  The memory is two generations of `known_words` words."""

    def __init__(self, path: str, known_words: int = 1 << 19):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = self.tokenizer.model
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.known_words = known_words
        self.characters = _byte_characters()
        self.as_bytes = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]

    def _ids(self, word: bytes) -> bytes:
        """Ids of a word without ASCII white space."""
        text = word.decode()
        plain = text.isalpha() and text == text.lower()
        if plain and not text.isascii():
            plain = max(text) < "\u0250"
            text = word.decode("latin-1").translate(self.characters) if plain else text
        if plain:
            return b"".join([self.as_bytes[t.id] for t in self.merges.tokenize(text)])
        return b"".join([self.as_bytes[i] for i in self.tokenizer.encode(text, add_special_tokens=False).ids])

    @staticmethod
    def _plain(c: str) -> bool:
        """A letter or digit that stays one when it is lower-cased."""
        return c.isalnum() and c < "\u0250" and len(c.lower()) == 1

    def _learn(self, word: bytes) -> bytes:
        ids = self.known.get(word)
        if ids is None:
            ids = self.older.get(word)
        if ids is None:
            stem = word.rstrip(_PUNCTUATION)
            # Punctuation behind a letter or digit is a run of its own.
            if len(stem) < len(word) and stem and self._plain(stem.decode()[-1]):
                ids = self._learn(stem) + self._learn(word[len(stem):])
            else:
                ids = self._ids(word)
        self.known[word] = ids
        return ids

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out = []
        for text in texts:
            if text and "<|" in text:
                ids = self.tokenizer.encode(text, add_special_tokens=False).ids
                out.append(np.array(ids, dtype="<u4").tobytes())
                continue
            data = (text or "").encode()
            if b"\xcc" not in data and b"\xcd" not in data:  # no combining marks: case doesn't matter
                data = data.lower()
            words = data.split()  # at ASCII white space
            parts = list(map(self.known.get, words))
            if None in parts:
                if len(self.known) > self.known_words:
                    self.known, self.older = {}, self.known
                parts = [self._learn(w) if ids is None else ids for w, ids in zip(words, parts)]
            out.append(b"".join(parts))
        return out


@functools.lru_cache(2)
def _encoder(path: str) -> WordEncoder:
    """One for all tasks of a worker process: its vocabulary is loaded once, its
    known words serve the next task, and its memory is not taken anew."""
    return WordEncoder(path)


PIECES = "id long, piece int, start long, length long, ids_crc32 long, part int, no long"


def _tokenise(p: Packing, with_ids: bool):
    fields = [("id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
              ("ids_crc32", pa.int64()), ("part", pa.int32()), ("no", pa.int64())] + [("ids", pa.list_(pa.int32()))] * with_ids
    schema = pa.schema(fields)
    end = np.array([p.end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, no = TaskContext.get().partitionId(), 0
        encoder = _encoder(p.tokenizer)
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                some = batch.slice(first, 256)
                columns: list[list] = [[] for _ in fields]
                for key, ids in zip(some.column(0).to_pylist(), encoder.encode(some.column(1).to_pylist())):
                    ids += end
                    for piece, at in enumerate(range(0, len(ids), 4 * p.capacity)):
                        own = ids[at: at + 4 * p.capacity]
                        values = [key, piece, at // 4, len(own) // 4, zlib.crc32(own), part, no]
                        no += 1
                        if with_ids:
                            values.append(np.frombuffer(own, dtype="<i4"))
                        for column, value in zip(columns, values):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)],
                                                 schema=schema)

    return run


def tokenised_pieces(docs: DataFrame, params: Packing, id_col: str = "doc_id", text_col: str = "text",
                     with_ids: bool = True) -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, no[, ids]) of every document; a
    null text is empty, so that every row has one piece at least: the end id.
    `part` and `no` number the pieces of a task's part of the table."""
    importable(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _tokenise(params, with_ids), PIECES + ", ids array<int>" * with_ids)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts.

    Returns segments (length, first rank, pieces, base sequence, copies per
    sequence, offset): the piece of rank first + i goes to sequence
    base + i // copies at offset + (i % copies) * length.  Each length splits
    at most one run of equal sequences in two and opens at most two, so the
    number of runs depends on `capacity` only.
    """
    free: dict[int, list[tuple[int, int]]] = {}  # free room -> runs (base, sequences)
    rooms: list[int] = []  # rooms that have runs, ascending
    segments, sequences = [], 0

    def put(room: int, base: int, n: int) -> None:
        if n and room:
            if room not in free:
                free[room] = []
                bisect.insort(rooms, room)
            free[room].append((base, n))

    for length in sorted(histogram, reverse=True):
        left, rank = histogram[length], 0
        while left:
            at = bisect.bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                base, n = free[room].pop()
                if not free[room]:
                    del free[room]
                    rooms.pop(at)
            else:
                room = capacity
                n = max(1, left // (capacity // length))
                base, sequences = sequences, sequences + n
            copies = min(room // length, left)
            used = min(n, left // copies)
            segments.append((length, rank, used * copies, base, copies, capacity - room))
            rank += used * copies
            left -= used * copies
            put(room, base + used, n - used)
            put(room - copies * length, base, used)
    return segments


def packed(pieces: DataFrame, params: Packing) -> DataFrame:
    """``pieces`` (a table that can be read again) with sequence_id and offset.

    The rank of a piece within its length is its place within a salt plus the
    rows of the salts before; a length of n pieces has sqrt(n) salts, so that
    neither a salt nor the list of salts is a large group.  The salt is a hash of
    the piece's number in its part of the table, so rows that repeat are spread
    like all others.  The plan goes to
    the tasks, which look their pieces' ranks up in it: its size is bounded by
    `capacity`, not by the corpus.  An empty table has an empty plan.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots = spark.sparkContext.broadcast(
        np.array(plan(counts, params.capacity), dtype=np.int64).reshape(-1, 6))
    salts = spark.createDataFrame([(n, math.isqrt(c - 1) + 1) for n, c in counts.items()],
                                  "length long, salts long")
    order = ["part", "no"]
    salted = (pieces.join(F.broadcast(salts), "length")
              .withColumn("salt", F.pmod(F.xxhash64(*order), F.col("salts"))).drop("salts"))
    before = (salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
              .withColumn("before", F.coalesce(F.sum("n").over(
                  Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0))).drop("n"))
    ranked = (salted.withColumn("rank", F.row_number().over(
        Window.partitionBy("length", "salt").orderBy(*order)) - 1)
        .join(before, ["length", "salt"])
        .withColumn("rank", F.col("rank") + F.col("before"))
        .select(*pieces.columns, "rank"))
    kept = pieces.columns

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value[np.lexsort((slots.value[:, 1], slots.value[:, 0]))]
        starts = {n: np.searchsorted(table[:, 0], [n, n + 1]) for n in np.unique(table[:, 0]).tolist()}
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.empty(len(rank), dtype=np.int64)
            for n in np.unique(length).tolist():
                a, b = starts[n]
                own = length == n
                at[own] = a + np.searchsorted(table[a:b, 1], rank[own], side="right") - 1
            _, first, _, base, copies, offset = table[at].T
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept]
                + [pa.array(base + (rank - first) // copies),
                   pa.array(offset + (rank - first) % copies * length)],
                names=[*kept, "sequence_id", "offset"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.mapInArrow(place, fields + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, params: Packing, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = True) -> DataFrame:
    """Every piece with its place: id_col, piece, start, length, ids_crc32
    [, ids], sequence_id, offset.

    Null or empty text: the end id alone.  Null ids and repeated rows are
    packed like any row.  Ids are whole numbers, or text of one.  Texts are tokenised once: the pieces are a written
    table that the histogram, the ranks and the result read."""
    pieces = stored(tokenised_pieces(docs, params, id_col, text_col, with_ids), "pieces")
    return packed(pieces, params).drop("part", "no").withColumnRenamed("id", id_col)


def sequences(placed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences, from pieces that carry their ids."""
    return (placed.groupBy("sequence_id")
            .agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
            .select("sequence_id", F.flatten(F.transform("parts", lambda x: x["ids"])).alias("ids")))
