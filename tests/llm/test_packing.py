from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from churnlens.llm.packing import Packing, WordEncoder, pack_documents, plan, sequences
from tests.llm.frames import awkward, none

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def whole():
    t = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer(whole):
    """Random strings of awkward characters, word memory included."""
    rng = random.Random(3)
    alphabet = "aAbZéÉßİıΣσςǅ漢字ñ ńéJ̌ǰ'\"s t re 12 ½ ² _-.,!?  \u0085\x1c\x0b\t\n😀ŉﬁKÅ"
    encoder = WordEncoder(PATH, known_words=500)
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) + rng.choice(["", "<|endoftext|>", "<|ENDOFTEXT|>", "a<|startoftext|> b", " <| endoftext|>", "<<|endoftext|>|>"])
        got = np.frombuffer(encoder.encode([text])[0], "<u4").tolist()
        assert got == whole(text), repr(text)


@pytest.mark.parametrize("seed", range(5))
def test_plan_places_every_rank_once(seed):
    rng = random.Random(seed)
    capacity = 64
    histogram = {n: rng.randint(1, 400) for n in rng.sample(range(1, capacity + 1), rng.randint(1, 40))}
    filled: dict[int, set] = {}
    for length, first, pieces, base, copies, offset in plan(histogram, capacity):
        for i in range(pieces):
            at = offset + i % copies * length
            cells = filled.setdefault(base + i // copies, set())
            own = set(range(at, at + length))
            assert not cells & own and at + length <= capacity
            cells |= own
    assert sum(map(len, filled.values())) == sum(k * n for k, n in histogram.items())
    assert all(cells == set(range(len(cells))) for cells in filled.values())  # gapless from 0
    # best-fit decreasing, piece by piece, opens as many sequences
    rooms: list[int] = []
    for n in sorted((k for k, c in histogram.items() for _ in range(c)), reverse=True):
        fit = [r for r in rooms if r >= n]
        if fit:
            rooms.remove(min(fit))
            rooms.append(min(fit) - n)
        else:
            rooms.append(capacity - n)
    assert len(filled) == len(rooms)


def test_plan_does_not_grow_with_counts():
    rng = random.Random(1)
    small = {n: rng.randint(1, 10 ** 3) for n in range(1, 4097)}
    large = {n: c * 10 ** 6 + 1 for n, c in small.items()}
    assert len(plan(large, 4096)) < 20_000 and plan({}, 4096) == []


def test_awkward_rows_round_trip(spark, whole):
    docs = awkward(spark)
    placed = pack_documents(docs, Packing(tokenizer=PATH, capacity=512)).collect()
    texts: dict = {}
    for r in docs.collect():
        texts.setdefault(r["doc_id"], []).append(whole(r["text"]) + [1])
    pieces: dict = {}
    for r in placed:
        assert len(r["ids"]) == r["length"] <= 512
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        assert r["start"] == 512 * r["piece"]
        pieces.setdefault(r["doc_id"], []).append((r["piece"], r["ids"]))
    for key, own in texts.items():
        cut = sorted((i, x[a:a + 512]) for x in own for i, a in enumerate(range(0, len(x), 512)))
        assert sorted(pieces[key]) == cut
    by_sequence: dict = {}
    for r in placed:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 512
    out = sequences(pack_documents(docs, Packing(tokenizer=PATH, capacity=512))).collect()
    assert sum(len(r["ids"]) for r in out) == sum(len(x) for own in texts.values() for x in own)
    assert pack_documents(none(spark), Packing(tokenizer=PATH)).collect() == []
