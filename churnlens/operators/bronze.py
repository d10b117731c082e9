"""Bronze layer: rename, tag provenance, union the landing files, stamp the batch."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens import config as C


def rename_headers(df: DataFrame, renames: dict[str, str] = C.RENAMES) -> DataFrame:
    """Spaced CSV headers to snake_case (missing headers are left alone)."""
    present = {k: v for k, v in renames.items() if k in df.columns}
    return df.withColumnsRenamed(present)


def tag_source(df: DataFrame, file_name: str) -> DataFrame:
    """Literal ``_source_file`` column naming the landing file."""
    return df.withColumn("_source_file", F.lit(file_name))


_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def align_types(parts: list[DataFrame]) -> list[DataFrame]:
    """Make per-file types compatible before the union.

    Files whose inferred types differ only numerically are left to the
    union's numeric widening (int + double -> double).  Any other
    disagreement (e.g. one file's column inferred as text because of a
    malformed value) becomes text in every part, so the union never tries
    to parse text as a number; the tolerant casts of silver do that per value
    (`30.0` of a double that became text is still 30).
    """
    types: dict[str, set[str]] = {}
    for df in parts:
        for name, dtype in df.dtypes:
            types.setdefault(name, set()).add(dtype)
    to_text = [c for c, ts in types.items()
               if len(ts) > 1 and not all(t in _NUMERIC or t.startswith("decimal") for t in ts)]
    if not to_text:
        return parts
    return [df.withColumns({c: F.col(c).cast("string") for c in to_text if c in df.columns})
            for df in parts]


def union_parts(parts: list[DataFrame]) -> DataFrame:
    """Union by column name; no shuffle, the partitions are concatenated."""
    return reduce(lambda a, b: a.unionByName(b), align_types(parts))


def stamp_ingestion(df: DataFrame) -> DataFrame:
    """One ``_ingestion_time`` for the whole batch (fixed per query)."""
    return df.withColumn("_ingestion_time", F.current_timestamp())


def bronze(parts: dict[str, DataFrame]) -> DataFrame:
    """Landing files by name -> bronze rows."""
    tagged = [tag_source(rename_headers(df), name) for name, df in parts.items()]
    return stamp_ingestion(union_parts(tagged))
