"""Spelling variants: words that differ by one letter, found in a trie.

A word's path is its length, then its counts of letters by letter group.  One
inserted, deleted or replaced letter raises at most one of the counts by one
(a surplus) and lowers at most one by one (a deficit), so a depth-first search
that may spend one of each reaches every near word's leaf; the words of a leaf
are verified letter by letter.

The trie is distributed by its own nodes: a node with few enough words is a
shard, found from the counts of words below each node.  A word goes to its own
shard, and as a query to every shard that the search from the top reaches with
its budget.  A near pair is found once, in the shard of the word whose path
(then spelling) is larger.  A shard returns one row per word, not its pairs.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.tables import importable, shuffle_partitions, stored
from churnlens.llm.tally import byte_table, byte_words

LETTERS = byte_table(bytes([*range(65, 91), *range(97, 123), *range(0xC0, 0x100)]))


@dataclass(frozen=True)
class Spelling:
    """Words of at least `min_length` code points and `min_count` occurrences.
    A form is at least `ratio` times as frequent.  `groups`: letter groups (a
    code point's remainder).  A trie node of at most `shard_words` words is a
    shard; where that would be more than `shards` of them, shards are larger.
    With `misprint` k > 0, a letter is dropped from the words of a document
    whose hash k divides."""
    min_length: int = 5
    min_count: int = 3
    ratio: int = 2
    groups: int = 12
    shard_words: int = 4096
    shards: int = 20_000
    misprint: int = 0
    held_words: int = 1 << 18


def _counted(p: Spelling):
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def emit(counts: dict[bytes, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())],
            schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                own: Counter = Counter()
                # Characters beyond latin-1 become question marks, which end a word like they do.
                for words in byte_words(text.encode("latin-1", "replace"), LETTERS):
                    own.update(words)
                if not p.misprint:
                    for word, n in own.items():
                        if len(word) >= p.min_length:
                            counts[word] += n
                else:
                    start = zlib.crc32(f"{key}:".encode())
                    for word, n in own.items():
                        if len(word) < p.min_length:
                            continue
                        h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                        if h % p.misprint == 0:
                            at = h % len(word)
                            word = word[:at] + word[at + 1:]
                            if len(word) < p.min_length:
                                continue
                        counts[word] += n
                if len(counts) > p.held_words:
                    yield emit(counts)
                    counts = Counter()
        yield emit(counts)

    return run


def frequent_words(docs: DataFrame, params: Spelling = Spelling(), id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """(word, n): the frequent letter runs of all texts, A-Z lower-cased.  Null
    text has none; a null id hashes as an empty text.  Tasks sum their words
    before the shuffle."""
    p = params
    importable(docs.sparkSession)
    return (docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col).cast("string"))
            .mapInArrow(_counted(p), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= p.min_count))


def _letters(words: list[str]) -> np.ndarray:
    return np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32)


def paths(words: list[str], groups: int) -> np.ndarray:
    """One row a word: its length and its counts of letters by group."""
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    cell = np.repeat(np.arange(len(words)) * groups, lengths) + _letters(words) % groups
    counts = np.bincount(cell, minlength=len(words) * groups).reshape(len(words), groups)
    return np.column_stack([lengths, counts]).astype(np.int32)


def _with_paths(groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = paths(batch.column(0).to_pylist(), groups)
            offsets = pa.array(np.arange(len(found) + 1) * (groups + 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(found.ravel()))],
                names=["word", "n", "path"])

    return run


def top_of_trie(words: DataFrame, p: Spelling):
    """The trie above its shards: nested {count: node}; a shard is (number, blocks).

    Only nodes above shards and shards themselves reach the driver: a node
    above has more than `shard_words` words, so their number is bounded by
    `shards` times the trie's depth, whatever the vocabulary."""
    depth = p.groups + 1
    by_path = words.groupBy("path").agg(F.count("*").alias("n"))
    total = by_path.agg(F.sum("n")).first()[0] or 0
    limit = max(p.shard_words, -(-total // p.shards))
    if total <= limit:
        return (0, 1)
    nodes = stored(
        by_path.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(depth)), lambda k: F.slice("path", 1, k)))
                       .alias("node"), "n").groupBy("node").agg(F.sum("n").alias("n")), "nodes")
    above = nodes.filter((F.col("n") > limit) & (F.size("node") < depth)).select(F.col("node").alias("parent"))
    found = (nodes.withColumn("parent", F.slice("node", 1, F.size("node") - 1))
             .join(above, "parent", "left").filter((F.size("node") == 1) | above["parent"].isNotNull())
             .select("node", "n").collect())
    top: dict = {}
    for number, (node, n) in enumerate(sorted((tuple(r["node"]), r["n"]) for r in found)):
        at = top
        for c in node[:-1]:
            at = at[c]
        at[node[-1]] = {} if n > limit and len(node) < depth else (number, -(-n // limit))
    return top


def _reached(top, path: tuple[int, ...]) -> list[tuple[int, int, bool]]:
    """(shard, blocks, own) that the search for near words with a path not below ``path`` reaches."""
    found = []

    def visit(node, level: int, surplus: int, deficit: int, same: bool) -> None:
        if isinstance(node, tuple):
            found.append((*node, same))
            return
        count = path[level]
        child = node.get(count)
        if child is not None:
            visit(child, level + 1, surplus, deficit, same)
        child = node.get(count + 1)
        if child is not None:
            if level == 0:  # a longer word: one letter more, none fewer
                visit(child, 1, 1, 0, False)
            elif surplus:
                visit(child, level + 1, 0, deficit, False)
        if level and deficit and not same:
            child = node.get(count - 1)
            if child is not None:
                visit(child, level + 1, surplus, 0, False)

    visit(top, 0, 1, 1, True)
    return found


def _dealt(top):
    schema = pa.schema([("shard", pa.int64()), ("block", pa.int64()), ("own", pa.bool_()), ("word", pa.string()),
                        ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = top.value
        known: dict[tuple, list] = {}
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                rows: list[tuple] = []
                for word, n, path in zip(*(c.to_pylist() for c in part.columns)):
                    path = tuple(path)
                    shards = known.get(path)
                    if shards is None:
                        if len(known) > 1 << 16:
                            known.clear()
                        shards = known[path] = _reached(trie, path)
                    for shard, blocks, home in shards:
                        mine = zlib.crc32(word.encode()) % blocks if home else -1
                        rows.extend((shard, block, block == mine, word, n) for block in range(blocks))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _search(tree: np.ndarray, queries: np.ndarray):
    """Depth-first over the trie of the sorted rows ``tree``: yields (first, end, queries, same)
    for the leaves that queries reach; `same` marks queries with the leaf's own path.  The
    queries that reach a node go on together, each with what is left of its budget."""
    depth = tree.shape[1]
    every = np.arange(len(queries))
    stack = [(0, len(tree), 0, every, np.ones(len(queries), bool), np.ones(len(queries), bool),
              np.ones(len(queries), bool))]
    while stack:
        lo, hi, level, q, surplus, deficit, same = stack.pop()
        if hi - lo == 1:  # one word left: its whole rest at once
            rest = tree[lo, level:] - queries[q, level:]
            if level == 0:
                longer = rest[:, 0] == 1
                fits = longer | (rest[:, 0] == 0)
                deficit = deficit & ~longer
                rest = rest[:, 1:]
            else:
                longer, fits = np.zeros(len(q), bool), np.ones(len(q), bool)
            up, down = np.maximum(rest, 0).sum(axis=1), np.maximum(-rest, 0).sum(axis=1)
            fits &= (up <= surplus) & (down <= deficit)
            unlike = rest != 0
            changed = unlike.any(axis=1)
            raised = changed & (rest[np.arange(len(q)), unlike.argmax(axis=1)] > 0) if rest.shape[1] else changed
            fits &= ~same | longer | ~changed | raised
            same = same & ~longer & ~changed
            if fits.any():
                yield lo, hi, q[fits], same[fits]
            continue
        if level == depth:
            yield lo, hi, q, same
            continue
        counts = tree[lo:hi, level]
        cuts = np.flatnonzero(np.diff(counts)) + 1
        own = queries[q, level]
        for a, b in zip([0, *cuts], [*cuts, hi - lo]):
            d = counts[a] - own
            up, down = d == 1, d == -1
            if level == 0:
                go = (d == 0) | up
                left = (surplus, deficit & ~up)
            else:
                go = (d == 0) | (up & surplus) | (down & deficit & ~same)
                left = (surplus & ~up, deficit & ~down)
            if go.any():
                stack.append((lo + a, lo + b, level + 1, q[go], left[0][go], left[1][go], (same & (d == 0))[go]))


def _verified(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one replaced letter, or (one column more) by one inserted."""
    n, width = short.shape
    if long.shape[1] == width:
        return (short != long).sum(axis=1) == 1
    ahead = np.column_stack([short != long[:, :width], np.ones(n, bool)]).argmax(axis=1)
    behind = np.column_stack([(short != long[:, 1:])[:, ::-1], np.ones(n, bool)]).argmax(axis=1)
    return ahead + behind >= width


def _near(p: Spelling):
    schema = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        words, n = table["word"].to_pylist(), table["n"].to_numpy()
        own = table["own"].to_numpy()
        every = paths(words, p.groups)
        order = np.array(sorted(range(len(words)), key=words.__getitem__), dtype=np.int64)
        place = np.empty(len(words), dtype=np.int64)  # place in code-point order
        place[order] = np.arange(len(words))
        home = np.flatnonzero(own)
        home = home[np.lexsort(every[home].T[::-1])]
        low, high = [], []
        for lo, hi, q, same in _search(every[home], every) if len(home) else ():
            leaf = home[lo:hi]
            width = len(words[leaf[0]])
            theirs = _letters([words[i] for i in leaf]).reshape(len(leaf), width)
            for size in (width, width - 1):
                fit = every[q, 0] == size
                mine, alike = q[fit], same[fit]
                step = max(1, (1 << 22) // (len(leaf) * width))
                for first in range(0, len(mine), step):
                    block = mine[first: first + step]
                    left = np.repeat(_letters([words[i] for i in block]).reshape(len(block), size), len(leaf), axis=0)
                    right = np.tile(theirs, (len(block), 1))
                    one, two = np.repeat(block, len(leaf)), np.tile(leaf, len(block))
                    ok = _verified(left, right)
                    # Within one path a pair counts from its smaller word only.
                    ok &= ~np.repeat(alike[first: first + step], len(leaf)) | (place[one] < place[two])
                    low.append(one[ok]), high.append(two[ok])
        one = np.concatenate([*low, *high]) if low else np.empty(0, np.int64)
        two = np.concatenate([*high, *low]) if low else np.empty(0, np.int64)
        best = np.lexsort((place[two], -n[two], one))
        one, two = one[best], two[best]
        found, first, times = np.unique(one, return_index=True, return_counts=True)
        return pa.table([pa.array([words[i] for i in found], pa.string()), pa.array(times, pa.int64()),
                         pa.array([words[i] for i in two[first]], pa.string()), pa.array(n[two[first]], pa.int64())],
                        schema=schema)

    return run


def near_words(words: DataFrame, params: Spelling = Spelling()) -> DataFrame:
    """(word, n_near, form, form_n) of every word of ``words`` (word, n: distinct
    words) that has a near word; `form` is the most frequent, of equally
    frequent ones the first in code-point order."""
    p, spark = params, words.sparkSession
    importable(spark)
    with_paths = stored(words.mapInArrow(_with_paths(p.groups), "word string, n long, path array<int>"), "paths")
    top = spark.sparkContext.broadcast(top_of_trie(with_paths, p))
    dealt = with_paths.mapInArrow(_dealt(top), "shard long, block long, own boolean, word string, n long")
    found = (dealt.repartition(shuffle_partitions(spark), "shard", "block").groupBy("shard", "block")
             .applyInArrow(_near(p), "word string, n_near long, form string, form_n long"))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", "best.form", (-F.col("best.less")).alias("form_n")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of every row of ``forms`` (word, form not null): the end of
    its chain.  Each round doubles the steps taken; a form is at least twice as
    frequent, so chains have no cycles and a few dozen words at most."""
    current = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        following = stored(current.join(onward, "root", "left")
                           .select("word", F.coalesce("next", "root").alias("root"),
                                   F.col("next").isNotNull().alias("moved")), "roots")
        moved = not following.filter("moved").isEmpty()
        current = following.drop("moved")
        if not moved:
            return current


def spelling_variants(docs: DataFrame, params: Spelling = Spelling(), id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every frequent word.

    `form` is its near word of largest n (ties: first in code-point order) if
    that n is at least `ratio` times its own, else null, and `form_n` its n;
    `root` follows the forms from the word to the last.  Null, empty and blank
    texts have no words; repeated rows count again; words of any length are
    whole.  Extra columns are ignored; an empty table gives no rows.
    """
    p = params
    words = stored(frequent_words(docs, p, id_col, text_col), "words")
    near = near_words(words, p)
    frequent = F.col("form_n") >= p.ratio * F.col("n")
    known = stored(words.join(near, "word", "left").select(
        "word", F.when(frequent, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(frequent, F.col("form_n")).alias("form_n")),
        "known")
    ends = roots(known.filter("form is not null"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
