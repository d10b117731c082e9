"""A corpus pipeline over `documents`: reject, deduplicate, decontaminate,
pseudonymise, pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of documents.  Between stages the rows are written as
Parquet in the shared folder and read again.

Nulls: null text has no words and is rejected by the quality rules; rows with
a null id are judged, deduplicated by their texts and packed like all others.
Rows that repeat an id and text leave one row.  Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnlens.llm.decontaminate import without_items
from churnlens.llm.near_dup import near_duplicates
from churnlens.llm.packing import Packing, pack_documents
from churnlens.llm.pii import pseudonymised
from churnlens.llm.quality_rules import judged
from churnlens.llm.queries import PII_KEY
from churnlens.llm.tables import read, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    rows = docs.select(F.struct("*").alias("_row"), "text", "lang", "source")
    return judged(rows).filter("kept").select("_row.*")


#: Keys of rows without an id: beyond the ids, so that a row with an id stays before them.
NO_ID = 1 << 62


def minhash_near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id, one of rows
    without an id only where no other has one."""
    mark = F.xxhash64("text")
    keyed = docs.withColumns({"_mark": mark, "_key": F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID) + F.pmod(
        mark, F.lit(NO_ID)))})
    kept = near_duplicates(keyed, id_col="_key").filter("kept").select("_key")
    return keyed.join(kept, "_key", "left_semi").dropDuplicates(["_key", "_mark"]).drop("_key", "_mark")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return without_items(docs, read(spark, sf_dir, "benchmark"))


def pii_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced in their texts."""
    return pseudonymised(docs, PII_KEY, spans_col=None)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    import public_tokenizers

    params = Packing(tokenizer=public_tokenizers.path("word_bpe_49k.json"))
    return pack_documents(docs, params, with_ids=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dup", minhash_near_dup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("pii_pseudonyms", pii_pseudonyms),
    ("best_fit_packing", best_fit_packing),
]

#: SQL can express neither the tokenizer nor the keyed permutation; tests/llm
#: holds the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
