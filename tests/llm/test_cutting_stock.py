from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from churnlens.llm.cutting_stock import (ByteEncoder, CuttingStock, _cells, cutting_plan, fractional,
                                         pack_by_patterns)
from tests.conftest import SF_SMALL
from tests.llm.frames import awkward, none

tokenizers = pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def whole():
    t = tokenizers.Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_tokenizer(whole):
    """Awkward characters, special tokens and contractions, against the unmodified tokenizer."""
    rng = random.Random(3)
    alphabet = "aAbZéÉßİ漢字ñ ńéJ̌'\"s t're 12 ½ _-.,!?  \u0085\x1c\x0b\t\n😀ﬁKÅ\x00"
    encoder = ByteEncoder(PATH)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 20)))
        text += rng.choice(["", "<|endoftext|>", "<|endoftext|> you", " <|endoftext", "'ll we"])
        assert encoder.encode(text).tolist() == whole(text), repr(text)
    for text in (" " * 3_000_000 + "x", "\n " * 500_000, "a" * 300_000):
        assert encoder.encode(text).tolist() == whole(text)


def placed(histogram, p):
    """Cells of every sequence by walking over the plan, piece by piece."""
    plan = cutting_plan(histogram, p)
    cells, cuts = defaultdict(list), 0
    used = dict.fromkeys(histogram, 0)
    for length, first, pieces, base, copies, offset in sorted(plan.slots):
        assert first == used[length] and pieces % copies == 0
        used[length] += pieces
        for i in range(pieces):
            cells[base + i // copies].append((offset + i % copies * length, length))
    for length, (first, position) in plan.run.items():
        assert first == used[length]
        for i in range(histogram[length] - first):
            at = position + i * length
            own = list(_cells(plan, p.capacity, at, at + length))
            assert sum(c[1] for c in own) == length and [c[0] for c in own] == list(
                np.cumsum([0, *[c[1] for c in own[:-1]]]))
            cuts += len(own) - 1
            for _, size, sequence, offset in own:
                cells[sequence].append((offset, size))
        used[length] = histogram[length]
    assert used == histogram
    for own in cells.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= p.capacity and (at == p.capacity or at & (at - 1) == 0)  # no padding at all
    return plan, cuts


@pytest.mark.parametrize("seed", range(12))
def test_plan_places_every_piece_once_without_padding(seed):
    rng = random.Random(seed)
    p = CuttingStock(capacity=rng.choice([64, 96, 128]))
    lengths = rng.sample(range(1, p.capacity + 1), rng.randint(1, 60))
    histogram = {n: rng.choice([1, 2, 17, 400]) for n in lengths}
    tokens = sum(n * k for n, k in histogram.items())
    plan, cuts = placed(histogram, p)
    assert cuts <= tokens // p.capacity + p.capacity.bit_length()


def test_patterns_spare_cuts():
    """Lengths that fill sequences exactly are not cut, and the program finds mixtures."""
    p = CuttingStock(capacity=64)
    assert placed({40: 100, 24: 100}, p)[1] == 0
    assert placed({30: 60, 17: 120, 64: 5}, p)[1] == 0
    assert placed({22: 500, 21: 1000, 10: 500, 7: 200}, p)[1] == 0
    assert placed({33: 64}, p)[1] > 0  # nothing fits 33: cuts are the only way


def test_columns_lower_the_cost_to_the_least():
    """Generated columns lower the start's cost; more turns than are
    needed change nothing."""
    rng = np.random.default_rng(1)
    lengths, counts = np.arange(1, 64), rng.integers(1, 300, 63)

    def cost(turns):
        p = CuttingStock(capacity=64, turns=turns, gap=1e-6)
        solved = fractional(lengths, counts, p)
        used = sum(x * pattern for pattern, x in solved)
        assert (used <= counts + 0.1).all()
        left = lengths @ (counts - used)
        return sum(x for _, x in solved) * p.sequence_cost + left / 64 * (p.cut_cost + p.sequence_cost)

    first, middle, last = cost(0), cost(4), cost(500)
    assert last < middle < first
    assert cost(2000) == pytest.approx(last, rel=1e-6)


def check(rows, texts, whole, p):
    """Every id in one piece, digests of the ids, gapless sequences without padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, copies in texts.items():
        own = sorted(pieces.pop(key), key=lambda r: r["start"])
        expected = []
        for text in copies:
            ids = whole(text) + [p.end_id]
            expected.append(ids)
        if len(copies) == 1:
            at = 0
            for r in own:
                part = np.array(expected[0][at: at + r["length"]], "<u4")
                assert (r["start"], len(part), zlib.crc32(part)) == (at, r["length"], r["ids_crc32"])
                assert r["doc_tokens"] == len(expected[0])
                at += r["length"]
            assert at == len(expected[0])
        else:
            assert sum(r["length"] for r in own) == sum(map(len, expected))
    assert not pieces
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == p.capacity or at & (at - 1) == 0


def run(spark, docs, whole, p):
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        texts[r["doc_id"]].append(r["text"])
    rows = pack_by_patterns(docs, p).collect()
    check(rows, texts, whole, p)
    return rows


def test_documents(spark, whole):
    p = CuttingStock(tokenizer=PATH)
    rows = run(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(5), whole, p)
    cut = sum(1 for r in rows if r["length"] < p.capacity) - len({r["doc_id"] for r in rows if r["length"] < p.capacity})
    assert cut < 40


def test_awkward(spark, whole):
    p = CuttingStock(tokenizer=PATH, capacity=64)
    docs = awkward(spark, [(40, "a <|endoftext|> b", "en", "a"), *[(50 + i, "same text", "en", "a") for i in range(300)]])
    run(spark, docs, whole, p)
    assert pack_by_patterns(none(spark), p).count() == 0
