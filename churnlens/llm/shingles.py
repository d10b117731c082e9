"""Vectorised word and shingle hashes over Arrow string buffers.

A batch of texts is handled as one byte array: words are runs of bytes that
are no separators, a word's 64-bit hash is a polynomial over its bytes, a
shingle's hash mixes the hashes of `width` consecutive words.  No Python
object is made per word, so the cost is a few numpy passes over the bytes.
All hashes are fixed functions of the bytes: equal on every executor and in
every retry.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
#: Bytes handled together; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20


def _table(separators: bytes | None) -> np.ndarray:
    """Byte -> byte in which A-Z are lower-cased and separators are 0."""
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    if separators is None:  # all ASCII but letters and digits
        for b in range(128):
            if not chr(b).isalnum():
                table[b] = 0
    else:
        table[0] = 1  # a NUL byte is part of a word; kept apart from 0 = separator
        table[list(separators)] = 0
    return table


#: Words as runs of anything but space, tab, LF, VT, FF, CR.
SPACE_WORDS = _table(b" \t\n\x0b\x0c\r")
#: Words as runs of ASCII letters and digits and of non-ASCII characters.
ALNUM_WORDS = _table(None)


def _powers(n: int, _kept: dict = {}) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n."""
    if _kept.get("n", 0) < n:
        size = max(n, BLOCK_BYTES)
        up = np.full(size, _BASE & _MASK, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        _kept.update(n=size, up=np.cumprod(up, dtype=np.uint64), down=np.cumprod(down, dtype=np.uint64))
    return _kept["up"], _kept["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts data[offsets[i]:offsets[i+1]], and
    the number of words of each text."""
    n_docs = len(offsets) - 1
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(n_docs, np.int64)
    b = table[data]
    inside = b != 0
    first = np.zeros(len(b) + 1, dtype=bool)
    first[offsets] = True  # a text's first byte starts a word, whatever came before
    start = inside.copy()
    start[1:] &= ~inside[:-1] | first[1:-1]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end)
    up, down = _powers(len(b))
    total = np.cumsum((b.astype(np.uint64) + np.uint64(0x1F3)) * up[: len(b)], dtype=np.uint64)
    before = np.where(starts > 0, total[starts - 1], np.uint64(0))
    h = (total[ends] - before) * down[starts]
    counts = np.diff(np.searchsorted(starts, offsets))
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), counts


def _weights(width: int) -> np.ndarray:
    return mix(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)) | np.uint64(1)


def shingle_hashes(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles (with repeats) in text order and their number
    per text.  A text with fewer words, but one at least, has its whole
    sequence as its one shingle; a text without words has none."""
    weights = _weights(width)
    n_of = np.where(counts >= width, counts - width + 1, np.minimum(counts, 1)).astype(np.int64)
    word_at = np.concatenate([[0], np.cumsum(counts)])
    if len(words) >= width:
        full = words[: len(words) - width + 1] * weights[0]
        for j in range(1, width):
            full = full + words[j: len(words) - width + 1 + j] * weights[j]
    else:
        full = np.empty(0, np.uint64)
    out = np.empty(int(n_of.sum()), dtype=np.uint64)
    out_at = np.concatenate([[0], np.cumsum(n_of)])
    long = np.flatnonzero(counts >= width)
    if len(long):
        keep = np.zeros(len(full), dtype=np.int32)
        edge = np.zeros(len(full) + 1, dtype=np.int32)
        np.add.at(edge, word_at[long], 1)
        np.add.at(edge, word_at[long] + n_of[long], -1)
        keep = np.cumsum(edge[:-1]) > 0
        target = np.ones(len(out), dtype=bool)
        for i in np.flatnonzero((counts > 0) & (counts < width)):
            target[out_at[i]] = False
        out[target] = full[keep]
    for i in np.flatnonzero((counts > 0) & (counts < width)):
        w = words[word_at[i]: word_at[i + 1]]
        out[out_at[i]] = (w * weights[: len(w)]).sum(dtype=np.uint64) + np.uint64(len(w))
    return mix(out), n_of


def blocks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about BLOCK_BYTES;
    null counts as empty."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset: column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < n:
        upto = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1
        upto = min(max(upto, row + 1), n)
        yield row, data[offsets[row]: offsets[upto]], offsets[row: upto + 1] - offsets[row]
        row = upto


def text_shingles(column: pa.Array, table: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, shingle hashes in text order) of every text of the column."""
    for row, data, offsets in blocks(column):
        words, counts = word_hashes(data, offsets, table)
        hashes, n_of = shingle_hashes(words, counts, width)
        at = np.concatenate([[0], np.cumsum(n_of)])
        for i in range(len(n_of)):
            yield row + i, hashes[at[i]: at[i + 1]]
