from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import functions as F

from churnlens.llm.quality_rules import QualityRules, bucket, bucket_top, judged
from tests.llm.frames import awkward, none, words

WORD = re.compile("[^\x20\x09-\x0d]+")


def measures(text):
    w = WORD.findall(text or "")
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_measures_equal_brute_force(spark):
    texts = [None, "", " ", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\ny\nx\n\n \nx", "#a *b\n#a *b",
             "  lead\u00a0in \x0b é ü\n", "a b c d\na b c e a b c", " ".join(words(3, 900, 6)), "\n".join(words(4, 50, 3))]
    rows = judged(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
                  .withColumns({"lang": F.lit("en"), "source": F.lit("s")})).collect()
    for r in rows:
        want = measures(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 50 or 100 * want[4] > 50 * want[0])


def test_buckets_are_ordered_and_tight(spark):
    rows = spark.range(0, 5000).select("id", bucket(F.col("id")).alias("b")).withColumn("top", bucket_top(F.col("b")))
    got = [(r["id"], r["b"], r["top"]) for r in rows.orderBy("id").collect()]
    assert all(i <= top <= max(i, i * 65 // 64) for i, _, top in got)
    assert [b for _, b, _ in got] == sorted(b for _, b, _ in got)


def top(v):
    """The largest number in v's bucket."""
    if v < 128:
        return v
    shift = v.bit_length() - 7
    return (((v >> shift) + 1) << shift) - 1


def plain_verdicts(rows, p):
    """The rules row by row: weighted values instead of sketches."""
    measured = []
    for text, lang, source in rows:
        n, chars, symbols, dup, repeats = measures(text)
        lines = len([x for x in (text or "").split("\n") if WORD.search(x)])
        failed = n < p.min_words or 100 * repeats > p.max_repeat_percent * n
        values = {"symbols": (symbols, n), "lines": (dup, lines), "repeats": (repeats, n), "length": (chars, n)}
        measured.append((lang, source, failed, values))

    def sketch(of, key):
        out = Counter()
        for m in of:
            units, size = m[3][key]
            out[top(1000 * units // max(size, 1))] += 1000
        return out

    def taking_in(own, wider):
        out, total = Counter(own), sum(wider.values())
        for v, w in wider.items():
            out[v] += p.prior_rows * 1000 * w // total
        return out

    def quantile(weights, k):
        upto, total = 0, sum(weights.values())
        for v in sorted(weights):
            upto += weights[v]
            if upto * 100 >= total * k:
                return v

    def beyond(units, size, rate, sign=1):
        expected = rate * size / 1000
        return sign * (units - expected) > p.errors * math.sqrt(expected + 1)

    good = [m for m in measured if not m[2]]
    out, cuts = [], {}
    for lang, source, failed, values in measured:
        if failed:
            out.append(False)
            continue
        if (lang, source) not in cuts:
            own = {}
            for key in values:
                w = taking_in(sketch([m for m in good if m[:2] == (lang, source)], key), taking_in(
                    sketch([m for m in good if m[0] == lang], key), sketch(good, key)))
                q25, q50, q75, q90 = (quantile(w, k) for k in (25, 50, 75, 90))
                if key == "length":
                    own[key] = (max(q50 - p.spread * max(q75 - q50, q50 // 64), 0),
                                q50 + p.spread * max(q50 - q25, q50 // 64))
                else:
                    own[key] = (None, q90 + p.spread * max(q90 - q50, q90 // 64))
            cuts[lang, source] = own
        own = cuts[lang, source]
        out.append(not any(beyond(*values[k], own[k][1]) or (own[k][0] is not None and beyond(*values[k], own[k][0], -1))
                           for k in values))
    return out, cuts


def text(seed, share, size=100, long=""):
    return " ".join(w + long + "#" * (i * 37 % 100 < share) for i, w in enumerate(words(seed, size, 3000)))


def corpus():
    rows = [(text(i, i % 2), "en", "plain") for i in range(700)]
    rows += [(text(1000 + i, 40 + i % 20), "en", "code") for i in range(100)]
    rows += [(text(2000 + i, 0, 100 + i), "de", "plain") for i in range(9)]
    rows += [("\n".join([text(3000 + i, 0)] * (1 + i % 3) + [text(4000 + i, 1)]), None, "lines") for i in range(60)]
    rows += [(text(5000 + i, 2, 80, "iti" * (i % 7)), "fr", f"s{i % 5}") for i in range(200)]
    rows += [(text(6000, 50), "en", "plain"), (text(6000, 50), "en", "code"), (text(6001, 8), "en", "plain"),
             (text(6001, 8), "en", "code"), (text(6002, 99), "en", "code"), (text(6003, 0, 100, "x" * 40), "de", "plain"),
             (None, "en", "plain"), ("", None, None)]
    return rows


def test_verdicts_equal_plain_rules(spark):
    rows = corpus()
    for p in (QualityRules(), QualityRules(prior_rows=5, errors=3, spread=2)):
        want, _ = plain_verdicts(rows, p)
        got = judged(spark.createDataFrame([(i, *r) for i, r in enumerate(rows)],
                                           "doc_id long, text string, lang string, source string"), p).collect()
        assert [want[r["doc_id"]] for r in got] == [r["kept"] for r in got]


def test_no_constants_give_these_verdicts(spark):
    """Texts of equal measures are junk in one source and usual in another, and cut-offs of
    every rate that varies differ between groups: no fixed cut-offs judge alike."""
    rows = corpus()
    got = {r["doc_id"]: r for r in judged(spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string")).collect()}
    plain = next(i for i, r in enumerate(rows) if r == (text(6000, 50), "en", "plain"))
    code = next(i for i, r in enumerate(rows) if r == (text(6000, 50), "en", "code"))
    measures_of = lambda r: {k: v for k, v in r.asDict().items() if k.startswith("n_") or k == "word_chars"}
    assert measures_of(got[plain]) == measures_of(got[code])
    assert not got[plain]["kept"] and got[code]["kept"]
    assert sum(got[i]["kept"] for i, r in enumerate(rows) if r[2] in ("plain", "code") and i < 800) == 800
    _, cuts = plain_verdicts(rows, QualityRules())
    for metric in ("symbols", "length"):
        assert len({c[metric] for c in cuts.values()}) > 1


def test_one_more_row_changes_little(spark):
    """The weight of a group's own rows grows with their number; no count of rows switches the rule."""
    base = [(text(i, 0), "en", "plain") for i in range(300)]
    before = None
    for n in range(150, 260, 10):
        own = [(text(9000 + i, 30 + i % 9), "en", "new") for i in range(n)]
        _, cuts = plain_verdicts(base + own, QualityRules())
        cut = cuts["en", "new"]["symbols"][1]
        assert before is None or abs(cut - before) <= 0.5 * max(cut, before)
        before = cut


def test_awkward_rows(spark):
    docs = awkward(spark)
    got = judged(docs)
    assert got.count() == docs.count()
    by = {r["doc_id"]: r for r in got.collect()}
    assert by[1]["n_words"] == 0 and by[1]["base_failed"] and not by[1]["kept"]
    assert by[7]["n_words"] == 30_000
    assert judged(none(spark)).collect() == []
