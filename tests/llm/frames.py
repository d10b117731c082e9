"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", kept string, score string, id string, label int, start string, word string, length int"


def words(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    syllables = ["ba", "ce", "di", "fo", "gu", "ha", "ki", "lo", "mu", "ne", "pra", "stu"]
    known = [rng.choice(syllables) + rng.choice(syllables) + rng.choice(syllables) for _ in range(vocabulary)]
    return [rng.choice(known) for _ in range(n)]


def awkward(spark, extra=()):
    """Null in every column, empty and blank texts, a very long text, repeated
    rows, equal texts under two ids, few words, clashing extra columns."""
    long = " ".join(words(1, 30_000, 5_000))
    base = " ".join(words(2, 120))
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, "a"), (4, "one", "en", None),
            (5, "one two three four", "en", "a"), (6, "One TWO three four", "en", "b"), (7, long, "en", "a"),
            (8, base, "en", "a"), (8, base, "en", "a"), (9, base, "de", "b"), (None, base, "en", "a"),
            (None, None, None, None), (10, base + " tail", "en", "a"), (11, "\x00 \x1f é ü 漢 \U0001f600", "en", "a"),
            *extra]
    full = [(i, t, la, s, None if t is None else len(t), "k", "s", "i", 1, "st", "w", 3) for i, t, la, s in rows]
    return spark.createDataFrame(full, COLUMNS + CLASHING)


def none(spark):
    return spark.createDataFrame([], COLUMNS + CLASHING)
