"""Landing-folder sources: file inventory and CSV ingest."""

from __future__ import annotations

import csv
import fnmatch
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnlens import config as C

#: Typed layout of the raw CSV files (``typed``).
RAW_SCHEMA = T.StructType([
    T.StructField("CustomerID", T.LongType()),
    T.StructField("Age", T.IntegerType()),
    T.StructField("Gender", T.StringType()),
    T.StructField("Tenure", T.IntegerType()),
    T.StructField("Usage Frequency", T.IntegerType()),
    T.StructField("Support Calls", T.IntegerType()),
    T.StructField("Payment Delay", T.IntegerType()),
    T.StructField("Subscription Type", T.StringType()),
    T.StructField("Contract Length", T.StringType()),
    T.StructField("Total Spend", T.DoubleType()),
    T.StructField("Last Interaction", T.IntegerType()),
    T.StructField("Churn", T.IntegerType()),
])

#: Landing files whose first lines are read at the same time.
HEADER_READERS = 32


def landing_files(spark: SparkSession, path: str, pattern: str = "*") -> list[str]:
    """URIs of all files under ``path`` (a file or folder) in any store that
    Spark reads, without its own markers (names that start with `_` or `.`).
    The list is as long as the folder's listing."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(conf).listFiles(root, True)
    out = []
    while files.hasNext():
        place = files.next().getPath()
        name = place.getName()
        if not name.startswith(("_", ".")) and fnmatch.fnmatchcase(name, pattern):
            out.append(place.toUri().toString())
    return sorted(out)


def file_header(spark: SparkSession, file: str, sep: str = ",") -> tuple[str, ...]:
    """The column names in a file's first line; compressed files by their suffix."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = lines.readLine()
    finally:
        stream.close()
    return tuple(next(csv.reader([line.lstrip("\ufeff")], delimiter=sep))) if line else ()


def headers(spark: SparkSession, path: str, pattern: str = "*",
            required: list[str] = C.RAW_COLUMNS) -> dict[str, tuple[str, ...]]:
    """The header of every file that has one, many files at a time; a file that
    lacks a required column is an error that names it."""
    files = landing_files(spark, path, pattern)
    read = inheritable_thread_target(spark)(lambda f: file_header(spark, f))
    with ThreadPoolExecutor(max_workers=max(1, min(HEADER_READERS, len(files)))) as pool:
        found = dict(zip(files, pool.map(read, files)))
    for f, names in found.items():
        missing = [c for c in required if c not in names]
        if names and missing:
            raise ValueError(f"{f} has no column {', '.join(missing)}")
    return {f: names for f, names in found.items() if names}


def typed(df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Text columns as the types of ``schema``; what doesn't parse is NULL."""
    from churnlens.functions.expressions import tolerant_cast

    types = dict(df.dtypes)
    return df.withColumns({f.name: tolerant_cast(F.col(f.name), types[f.name], f.dataType.simpleString())
                           for f in schema if f.name in types})


def landing_name(path: F.Column) -> F.Column:
    """Name of the landing file a path belongs to; for a landing "file" that
    is a folder of part files, the folder's name."""
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    return F.when(last.startswith("part-"), F.element_at(parts, -2)).otherwise(last)


def landing_inventory(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """Landing files (name, size in bytes, files): a landing file written as
    a folder of part files is one row.

    Only ``path`` and ``length`` are selected, so the binary-file source
    never reads file contents.  An empty result is the "folder is empty"
    warning of the original setup step.
    """
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select(landing_name(F.col("path")).alias("name"), "length")
        .filter(F.col("name").rlike(fnmatch.translate(pattern)))
        .groupBy("name").agg(F.sum("length").alias("size"), F.count(F.lit(1)).alias("files"))
    )


def check_landing(spark: SparkSession, path: str, pattern: str = "*") -> list[tuple[str, int]]:
    """File names and sizes in the landing folder (one row per file, so the
    list is as small as the folder listing); warns when the folder is empty."""
    import warnings

    files = [(r["name"], r["size"]) for r in landing_inventory(spark, path, pattern).collect()]
    if not files:
        warnings.warn(f"landing folder {path} is empty: upload the CSV files before ingesting",
                      stacklevel=2)
    return files


def read_csv(spark: SparkSession, path: str, infer_schema: bool = False, pattern: str = "*",
             columns: list[str] = C.RAW_COLUMNS) -> DataFrame:
    """CSV rows of a file or folder, columns by the names in each file's own
    header, whatever their order.

    Every field is text, as it stands in the file: a malformed value stays
    visible in bronze, and the casts of the silver layer decide about it.
    With ``infer_schema`` Spark's inference types the columns, at a full
    extra pass over the files.  Files are read together by equal headers; all
    files under ``path`` that match ``pattern`` are read."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, names in headers(spark, path, pattern, columns).items():
        groups.setdefault(names, []).append(f)
    out = None
    for names, files in groups.items():
        reader = spark.read.format("csv").option("header", "true").option("mode", "PERMISSIVE")
        if infer_schema:
            reader = reader.option("inferSchema", "true")
        else:
            reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names]))
        part = reader.load(files).select(*[F.col(f"`{c}`") for c in columns])
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return out


def read_landing(spark: SparkSession, landing_dir: str,
                 files: tuple[str, ...] = (C.TRAIN_FILE, C.TEST_FILE),
                 infer_schema: bool = False) -> dict[str, DataFrame]:
    """The landing files by name, ready for the bronze layer."""
    base = landing_dir.rstrip("/")
    return {name: read_csv(spark, f"{base}/{name}", infer_schema) for name in files}


def write_landing(parts: dict[str, DataFrame], landing_dir: str) -> str:
    """Write each part as a CSV folder named like the landing file.

    Used to stage the portfolio as landing files (tests, ingest check).
    """
    base = landing_dir.rstrip("/")
    for name, df in parts.items():
        df.write.mode("overwrite").option("header", "true").csv(f"{base}/{name}")
    return base
