"""Words of byte texts and counts of them, in bounded memory."""

from __future__ import annotations

from collections.abc import Iterator


def byte_table(kept: bytes) -> bytes:
    """A translation that lower-cases A-Z, keeps ``kept`` and turns every other byte into a space."""
    own = set(kept)
    return bytes((b + 32 if 65 <= b <= 90 else b) if b in own else 32 for b in range(256))


def byte_words(data: bytes, table: bytes, chunk: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of ``data`` by ``table``, list by list: a very long text is cut at
    spaces into chunks, so that only a chunk's words are objects at a time."""
    data = data.translate(table)
    first = 0
    while len(data) - first > chunk:
        end = data.find(b" ", first + chunk)
        if end < 0:
            break
        yield data[first:end].split()
        first = end
    yield (data[first:] if first else data).split()
