"""The registered queries of this package: one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@query("op2_minhash_near_dup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.near_dup import NearDup, near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents"), NearDup(percent=85))


OP3_SQL = """
WITH words AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents
  UNION ALL SELECT DISTINCT 'b', item_id, text FROM benchmark),
lists AS (
  SELECT side, id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w FROM words),
sets AS (
  SELECT side, id, r, unnest(list_distinct(CASE WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)) AS s FROM lists),
sizes AS (SELECT r, count(*) AS n FROM sets WHERE side = 'b' GROUP BY r),
shared AS (
  SELECT d.id AS doc_id, d.r AS dr, b.id AS item_id, b.r AS br, count(*) AS n_shared
  FROM sets d JOIN sets b ON d.side = 'd' AND b.side = 'b' AND d.s = b.s GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, n_shared, n_shared / n AS containment
FROM shared JOIN sizes ON br = r WHERE 100 * n_shared >= 80 * n
"""


@query("op3_benchmark_decontamination", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.decontaminate import contained_items

    return contained_items(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.language import fit_languages, identify

    docs = read(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string")) % 3
    model = fit_languages(docs, rest != 1)
    return identify(docs.select("doc_id", F.coalesce(rest == 1, F.lit(False)).alias("held_out"), "text"),
                    model).drop("text")


@query("op8_best_fit_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from churnlens.llm.packing import Packing, pack_documents

    params = Packing(tokenizer=public_tokenizers.path("word_bpe_49k.json"))
    return pack_documents(read(spark, sf_dir, "documents"), params, with_ids=False)


@query("op9_quality_classifier")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.quality_model import fit_quality, score_quality

    docs = read(spark, sf_dir, "documents")
    rest = F.crc32(F.col("doc_id").cast("string")) % 5
    scorer = fit_quality(docs, read(spark, sf_dir, "labels"), rest != 0)
    return (score_quality(docs.select("doc_id", F.coalesce(rest == 0, F.lit(False)).alias("held_out"), "text"),
                          scorer)
            .select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted")))


#: The rules of the query: `host/path start` -> verdict.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


@query("op10_url_filter")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.urls import fit_urls, judge_urls, labelled_urls

    return judge_urls(read(spark, sf_dir, "pages"), fit_urls(labelled_urls(spark)), URL_RULES)


_OP5_MERGED = """
SELECT {keys}, metric, bucket, sum(w)::HUGEINT AS w FROM (
  SELECT {keys}, metric, bucket, sum(n)::HUGEINT * 1000 AS w FROM sketch GROUP BY ALL
  UNION ALL
  SELECT {own_keys}, o.metric, p.bucket, (200000::HUGEINT * p.w) // p.total AS w
  FROM (SELECT DISTINCT {keys}, metric FROM sketch) o
  JOIN (SELECT *, sum(w) OVER (PARTITION BY {shared} metric) AS total FROM {wider}) p ON o.metric = p.metric {on})
GROUP BY ALL"""
OP5_CTES = r"""
docs AS (SELECT row_number() OVER () AS r, *, coalesce(text, '') AS t FROM {documents}),
split AS (
  SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM docs),
windows AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS s
            FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM split)),
repeated AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS c FROM windows) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM repeated, (VALUES (0), (1), (2)) AS v(k) GROUP BY r),
measured AS (
  SELECT r, len(ws) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(ls) AS n_lines,
    len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM docs JOIN split USING (r) LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    1000 * n_symbols // greatest(n_words, 1) AS symbols, 1000 * n_dup_lines // greatest(n_lines, 1) AS lines,
    1000 * n_repeat_words // greatest(n_words, 1) AS repeats, 1000 * word_chars // greatest(n_words, 1) AS length
  FROM measured),
ratios AS (
  SELECT lang, source, unnest(['symbols', 'lines', 'repeats', 'length']) AS metric,
    unnest([symbols, lines, repeats, length]) AS v FROM judged JOIN docs USING (r) WHERE NOT base_failed),
sketch AS (
  SELECT lang, source, metric, CASE WHEN v < 128 THEN v
    ELSE (length(bin(v)) - 1) * 64 + (v >> (length(bin(v)) - 7)) % 64 END AS bucket, count(*) AS n
  FROM ratios GROUP BY ALL),
by_all AS (SELECT metric, bucket, sum(n)::HUGEINT * 1000 AS w FROM sketch GROUP BY ALL),
by_lang AS (""" + _OP5_MERGED.format(keys="lang", own_keys="o.lang", shared="", wider="by_all", on="") + """),
by_source AS (""" + _OP5_MERGED.format(keys="lang, source", own_keys="o.lang, o.source", shared="lang,", wider="by_lang",
                                       on="AND o.lang IS NOT DISTINCT FROM p.lang") + """),
walked AS (
  SELECT lang, source, metric,
    CASE WHEN bucket < 128 THEN bucket ELSE ((65 + bucket % 64) << (bucket // 64 - 6)) - 1 END AS top,
    sum(w) OVER (PARTITION BY lang, source, metric) AS total,
    sum(w) OVER (PARTITION BY lang, source, metric ORDER BY bucket) AS upto FROM by_source),
quantiles AS (
  SELECT lang, source, metric, """ + ", ".join(
    f"min(CASE WHEN upto * 100 >= total * {k} THEN top END) AS q{k}" for k in (25, 50, 75, 90)) + """
  FROM walked GROUP BY ALL),
cuts AS (
  SELECT lang, source, """ + ", ".join(
    f"max(CASE WHEN metric = '{m}' THEN q90 + 6 * greatest(q90 - q50, q90 // 64) END) AS {m}_max"
    for m in ("symbols", "lines", "repeats")) + """,
    max(CASE WHEN metric = 'length' THEN q50 + 6 * greatest(q50 - q25, q50 // 64) END) AS length_max,
    max(CASE WHEN metric = 'length' THEN greatest(q50 - 6 * greatest(q75 - q50, q50 // 64), 0) END) AS length_min
  FROM quantiles GROUP BY ALL),
verdicts AS (
  SELECT d.r, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT coalesce(""" + " OR ".join(
    f"{s}({units} - {c}::DOUBLE * {size} / 1000) > 6 * sqrt({c}::DOUBLE * {size} / 1000 + 1)" for units, size, c, s in (
        ("n_symbols", "n_words", "symbols_max", ""), ("n_dup_lines", "n_lines", "lines_max", ""),
        ("n_repeat_words", "n_words", "repeats_max", ""), ("word_chars", "n_words", "length_max", ""),
        ("word_chars", "n_words", "length_min", "-"))) + """, FALSE) AS kept
  FROM docs d JOIN judged j USING (r) LEFT JOIN cuts c
  ON d.lang IS NOT DISTINCT FROM c.lang AND d.source IS NOT DISTINCT FROM c.source)"""
OP5_SQL = "WITH " + OP5_CTES.format(documents="documents") + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept
FROM verdicts JOIN docs USING (r)"""


@query("op5_quality_rules", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.quality_rules import judged

    return judged(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op1_secret_scan")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.secrets import scan_secrets

    return scan_secrets(read(spark, sf_dir, "documents"))


def _license_sql() -> str:
    from churnlens.llm.licenses import TEMPLATES

    quoted = lambda x: x.replace("'", "''")
    values = ", ".join(f"('{quoted(k)}', '{quoted(v)}')" for k, v in sorted(TEMPLATES.items()))
    words = ("string_split(trim(regexp_replace(translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[^0-9a-z\\x{{80}}-\\x{{10FFFF}}]+', ' ', 'g'), ' '), ' ')")
    grams = "list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))"
    return f"""
WITH templates(license, t) AS (VALUES {values}),
tw AS (SELECT license, {words.format(t='t')} AS w FROM templates),
tg AS (SELECT license, len(w) - 1 AS tn, {grams} AS tb FROM tw),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
parts AS (
  SELECT r, doc_id, 'line' AS unit, unnest(x) AS t, generate_subscripts(x, 1) - 1 AS unit_no
  FROM (SELECT r, doc_id, string_split(t, chr(10)) AS x FROM docs)
  UNION ALL
  SELECT * FROM (SELECT r, doc_id, 'paragraph' AS unit, unnest(x) AS t, generate_subscripts(x, 1) - 1 AS unit_no
    FROM (SELECT r, doc_id, regexp_split_to_array(t, '\\n[ \\t\\r]*\\n') AS x FROM docs)) WHERE contains(t, chr(10))),
uw AS (SELECT r, doc_id, unit, unit_no, {words.format(t='t')} AS w FROM parts),
ug AS (SELECT r, doc_id, unit, unit_no, len(w) - 1 AS n, {grams} AS b FROM uw
       WHERE len(w) - 1 BETWEEN (SELECT min(ceil(tn / 1.5)) FROM tg) AND (SELECT max(floor(tn * 1.5)) FROM tg)),
pairs AS (SELECT r, doc_id, unit, unit_no, license, len(list_intersect(b, tb)) AS n_shared,
            2.0::DOUBLE * len(list_intersect(b, tb)) / (len(b) + len(tb)) AS dice
          FROM ug JOIN tg ON n BETWEEN ceil(tn / 1.5) AND floor(tn * 1.5)),
best AS (SELECT *, row_number() OVER (PARTITION BY r, unit, unit_no ORDER BY dice DESC, license) AS k FROM pairs)
SELECT doc_id, unit, unit_no, license, n_shared, dice FROM best WHERE k = 1 AND dice >= 0.8
"""


@query("op4_license_scan", _license_sql())
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.licenses import license_matches

    return license_matches(read(spark, sf_dir, "documents"))


#: A demonstration key; a real run passes its own.
PII_KEY = b"churnlens demonstration key"


@query("op6_pii_pseudonyms")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.pii import pseudonymised

    return (pseudonymised(read(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
            .withColumn("n_found", F.size("pii").cast("long")))


OP12_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[a-z\\x{80}-\\x{10FFFF}]+') AS w FROM documents),
words AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM words GROUP BY ALL HAVING count(DISTINCT r) >= 3),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, sum(lang_n)::HUGEINT AS total, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
totals AS (SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total FROM groups LEFT JOIN counts USING (lang, source)
           GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (g.total + l.v) AS p,
    1 + (1000000000::HUGEINT * (lang_n + 1)) // (l.total + l.v) AS q
  FROM totals g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts c USING (lang, source, term)),
apart AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN apart x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (FROM pairs UNION ALL FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


@query("op12_source_divergence", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.divergence import source_divergence

    return source_divergence(read(spark, sf_dir, "documents"))


@query("op13_spelling_variants")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from churnlens.llm.spelling import Spelling, spelling_variants

    return spelling_variants(read(spark, sf_dir, "documents"), Spelling(misprint=97))


@query("op11_pattern_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from churnlens.llm.cutting_stock import CuttingStock, pack_by_patterns

    params = CuttingStock(tokenizer=public_tokenizers.path("byte_bpe_50k.json"))
    return pack_by_patterns(read(spark, sf_dir, "documents"), params)
