"""Language, quality and URL models: accuracy on rows they did not see."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import queries as Q
from churnlens.llm.language import NaiveBayes, _batches, _grams, fit_languages, identify
from churnlens.llm.quality_model import Compression, _monotone, fit_quality, score_quality
from churnlens.llm.urls import fit_urls, judge_urls, labelled_urls
from tests.llm.frames import awkward, none

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_languages_of_held_out_rows(spark, docs):
    got = Q.QUERIES["op7_language_id"](spark, SF).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_scores_equal_brute_force(spark):
    p = NaiveBayes(orders=(1, 2), bits=10)
    rows = [(1, "the cat and the hat", "en"), (2, "der Hund und die Katze", "de"), (3, "a", "en"), (4, None, "de"),
            (5, "x", None), (6, "und die", "de")]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, logs = fit_languages(table, F.lit(True), p)
    assert langs == ["de", "en"]

    def grams(text):
        return [b for _, points, offsets in _batches([text]) for own in _grams(points, offsets, p)
                for b in own.tolist() if b < 1 << p.bits]

    counts = {k: np.full(1 << p.bits, p.alpha) for k in langs}
    for _, text, lang in rows:
        if text and lang:
            assert len(grams(text)) == 2 * len(text) - 1
            np.add.at(counts[lang], grams(text), 1)
    got = {r["doc_id"]: r for r in identify(table, (langs, logs), p).collect()}
    for i, text, _ in rows:
        if not text:
            assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
            continue
        sums = [sum(math.log(counts[k][b] / counts[k].sum()) for b in grams(text)) for k in langs]
        best = int(np.argmax(sums))
        assert got[i]["lang_pred"] == langs[best]
        assert got[i]["score"] == pytest.approx(1 / sum(math.exp(s - max(sums)) for s in sums), abs=1e-4)


def test_language_awkward_rows(spark):
    table = awkward(spark, [(50, "1234 !!", "en", "a")])
    model = fit_languages(table, F.lit(True))
    got = identify(table, model).collect()
    assert len(got) == table.count()
    by = {r["doc_id"]: r["lang_pred"] for r in got if r["doc_id"] is not None}
    assert by[1] == by[2] == by[3] == by[50] == "und" and by[7] in ("en", "de")
    assert identify(none(spark), model).collect() == []
    nothing = fit_languages(none(spark), F.lit(True))
    assert nothing[0] == [] and {r["lang_pred"] for r in identify(table, nothing).collect()} == {"und"}


def test_a_text_is_scored_alike_in_any_batch():
    p = NaiveBayes()
    texts = ["abc", "", "é", "long text " * 50, "zz"]
    alone = [[b for _, pt, of in _batches([t]) for own in _grams(pt, of, p) for b in own] for t in texts]
    for _, points, offsets in _batches(texts):
        own = list(_grams(points, offsets, p))
        for i, t in enumerate(texts):
            assert [b for o in own for b in o[offsets[i]:offsets[i + 1]]] == alone[i]


def test_quality_of_held_out_rows(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    got = Q.QUERIES["op9_quality_classifier"](spark, "/root/testdata/sf0.1").join(labels, "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    score = np.array([r["score"] for r in held])
    label = np.array([r["quality"] for r in held])
    rank = score.argsort().argsort() + 1
    good = label.sum()
    assert (rank[label == 1].sum() - good * (good + 1) / 2) / (good * (len(label) - good)) > 0.97
    assert ((score >= 0.5) == label).mean() > 0.96 and (score[label == 1] >= 0.3).mean() > 0.98


def test_monotone_curve():
    x = np.array([0.0, 1, 2, 3, 4, 5])
    knots, values = _monotone(x, np.array([0, 1, 0, 1, 1, 1.0]), np.ones(6))
    assert (np.diff(values) > 0).all() and (np.diff(knots) > 0).all() and 0 < values[0] < values[-1] < 1


def test_quality_awkward_rows(spark):
    table = awkward(spark)
    for rows in ([], [(8, 1), (9, None)], [(7, 1), (8, 0), (8, 0), (None, 1), (999, 0)]):
        labels = spark.createDataFrame(rows, "doc_id long, quality int")
        scorer = fit_quality(table, labels, F.lit(True))
        got = score_quality(table, scorer).collect()
        assert len(got) == table.count() and all(0 <= r["score"] <= 1 for r in got)
        assert score_quality(none(spark), scorer).collect() == []


def brute_url(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    ends = [i for i, c in enumerate(rest) if c in "/?#"]
    host = rest[: ends[0]] if ends else rest
    tail = rest[len(host):]
    path = tail[: min([i for i, c in enumerate(tail) if c in "?#"], default=len(tail))]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    best = None
    for rule in Q.URL_RULES:
        own, _, start = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + start):
            best = max(best or rule, rule, key=len)
    return host, path, best


def test_urls(spark):
    urls = [None, "", "no host", "http://", "http://A.Example.NET/en/x?y#z", "http://net/", "http://net", "http://xnet/a",
            "x://example.com/de/a", "x://example.com/DE/a", "x://m.example.com/de", "http://a.org/fr/", "http://a.org?q=/fr/",
            "http://ÄÖ.org/fr/ü", "a://b://c/d", "http://u:p@h.example.net:80/en/", "http://a.net/x\ny", "http://a.net#/",
            "https://www.casino-win.example.org/en/1", "https://www.library.example.org/en/1"]
    model = fit_urls(labelled_urls(spark))
    table = spark.createDataFrame([(i, u, "r", "h") for i, u in enumerate(urls)], "page_id long, url string, rule string, host string")
    got = {r["page_id"]: r for r in judge_urls(table, model, Q.URL_RULES).collect()}
    for i, u in enumerate(urls):
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == brute_url(u), u
        if r["rule"]:
            assert r["verdict"] == Q.URL_RULES[r["rule"]]
        else:
            assert r["verdict"] == ("block" if r["score"] >= 0.5 else "allow")
    assert got[18]["verdict"] == "block" and got[19]["verdict"] == "allow"
    twice = table.filter("page_id = 4").unionAll(table.filter("page_id = 4")).withColumn("page_id", F.lit(None).cast("long"))
    assert judge_urls(twice, model, Q.URL_RULES).count() == 2
    assert judge_urls(table.limit(0), model, Q.URL_RULES).collect() == []


def test_unseen_spam_hosts_are_blocked(spark):
    got = Q.QUERIES["op10_url_filter"](spark, SF).filter("rule is null").collect()
    bad = lambda h: any(x in h for x in ("spam", "casino", "pills", "adult", "bets", "ads-"))
    assert np.mean([(r["verdict"] == "block") == bad(r["host"]) for r in got]) > 0.97


#: URLs of other hosts and forms than the training table's.
OTHER_BLOCK = """
https://pokerstars.eu/download https://www.vegas-casino.info/register http://slotmania.bet/bonus https://betting-odds.uk/horse-racing
https://free-porn-clips.net/new https://adultcams.live/models http://sexdating.ru/chat https://xxxmovies.top/hd
https://buy-viagra-cheap.com/pills http://pharmacy-discount.ru/cialis https://dietpills24.shop/order https://replica-handbags.cn/gucci
https://instant-loans.biz/apply https://bitcoin-jackpot.win/deposit http://free-gift-cards.click/claim https://keygen-crack.ws/download
https://torrentking.to/movies http://adserver-click.biz/banner https://buybacklinks.top/seo https://spam-bulk.ru/mail
https://sportwetten-bonus.de/wetten https://casino-en-ligne.fr/bonus http://lotto24-gewinn.biz/ https://poker-online.es/apuestas
""".split()
OTHER_ALLOW = """
https://www.bbc.co.uk/sport https://github.com/torvalds/linux https://www.lemonde.fr/planete/ https://www.spiegel.de/wissenschaft/
https://www.britannica.com/science/photosynthesis https://www.economist.com/europe https://www.stanford.edu/academics/
https://www.ethz.ch/de/forschung.html https://www.cern.ch/science https://docs.oracle.com/javase/tutorial/
https://www.python.org/downloads/ https://numpy.org/doc/stable/ https://www.elmundo.es/ciencia https://www.lavanguardia.com/cultura
https://www.nhs.uk/conditions/ https://www.berlin.de/museum/ https://www.louvre.fr/expositions https://www.rijksmuseum.nl/en/visit
https://www.nps.gov/yell/planyourvisit https://www.weather.gov/forecast https://www.tagesschau.de/ausland/
https://www.openstreetmap.org/about https://www.mathworks.com/help/ https://www.ieee.org/conferences
""".split()


def test_urls_of_other_forms(spark):
    """Held-out accuracy on hosts, domains and paths that the training table doesn't have."""
    rows = [(1, u) for u in OTHER_BLOCK] + [(0, u) for u in OTHER_ALLOW]
    model = fit_urls(labelled_urls(spark))
    got = judge_urls(spark.createDataFrame(rows, "page_id long, url string"), model, {}).collect()
    right = {k: np.mean([(r["verdict"] == "block") == k for r in got if r["page_id"] == k]) for k in (0, 1)}
    print(right, [(r["host"], round(r["score"], 2)) for r in got if (r["verdict"] == "block") != r["page_id"]])
    assert right[0] >= 0.9 and right[1] >= 0.8


def test_compression_uses_the_whole_text(spark):
    """Only the end of a long text differs, and the score moves."""
    from churnlens.llm.quality_model import Scorer

    good, bad = b"the quick brown fox jumps over the lazy dog " * 50, b"### $$$ %%% *** &&& ||| " * 80
    s = Scorer(good, bad, Compression())
    text = "the quick brown fox " * 2000
    a, b = s.differences([text, text + "### $$$ %%% *** " * 400])
    assert a > b
