"""Named tables: database, overwrite with comment, read, model persistence."""

from __future__ import annotations

import threading
from contextlib import nullcontext

from pyspark.sql import DataFrame, SparkSession


#: One append at a time: two writers of one process share a table's folder.
_APPENDS = threading.Lock()


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``database`` or ``catalog.database``; a new one at ``location``, else in the warehouse."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(database)}{place}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def table_location(spark: SparkSession, name: str) -> str | None:
    """Folder of a table of the session catalog inside its database's location;
    None for another catalog, which places its tables itself.  ``table``,
    ``database.table`` and ``catalog.database.table`` are taken; without a
    database it is the current one."""
    *prefix, table = name.split(".")
    database = prefix[-1] if prefix else spark.catalog.currentDatabase()
    if len(prefix) == 2 and prefix[0] != "spark_catalog":
        return None
    info = {r["info_name"]: r["info_value"]
            for r in spark.sql(f"DESCRIBE DATABASE {_quoted(database)}").collect()}
    return f"{info['Location'].rstrip('/')}/{table}"


def write_table(df: DataFrame, name: str, fmt: str = "parquet", comment: str | None = None,
                mode: str = "overwrite") -> str:
    """Write ``df`` as a table at its database location; returns the name.

    The location is given explicitly, so a table whose files outlive the
    catalog entry (a new session on a session-scoped catalog) is written
    and re-registered instead of failing on the existing folder."""
    spark = df.sparkSession
    writer, place = df.write.format(fmt).mode(mode), table_location(spark, name)
    with _APPENDS if mode == "append" else nullcontext():
        (writer.option("path", place) if place else writer).saveAsTable(name)
    if comment:
        escaped = comment.replace("'", "\\'")
        spark.sql(f"ALTER TABLE {_quoted(name)} SET TBLPROPERTIES ('comment' = '{escaped}')")
    return name


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_comment(spark: SparkSession, name: str) -> str | None:
    return spark.catalog.getTable(name).description


def save_model(model, path: str) -> str:
    """Persist a fitted ``PipelineModel`` (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
