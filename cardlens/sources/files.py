"""File sources.

Monthly files may differ in their columns, and Spark's CSV reader maps a
header positionally onto one schema.  So files are grouped by header: one
multi-file scan per distinct header (usually one), unioned by column name
with missing columns as NULL (``unionByName(allowMissingColumns=True)``).
Listing uses ``DataFrame.inputFiles()`` (metadata only); reading a header
is a one-line job per file, run concurrently in a bounded thread pool.  Everything else - NA tokens, number and date
parsing - is a projection over the scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens import schemas
from cardlens.functions import (drop_present, lenient_double, parse_float, parse_int, parse_timestamp,
                                rename_customer_id)

LATIN = "ISO-8859-1"


def file_name() -> Column:
    """Base name of the file a row comes from; Spark's metadata column has it as part of a URI."""
    return F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))


def list_files(spark: SparkSession, path: str, suffix: str = ".csv") -> list[str]:
    """Sorted data files of a folder; S3: fail when there are none."""
    try:
        files = spark.read.format("text").load(path).inputFiles()
    except Exception as e:  # noqa: BLE001 - missing folder
        raise FileNotFoundError(f"No {suffix} files found in {path}") from e
    files = sorted(unquote(f) for f in files if f.lower().endswith(suffix))  # listed as URIs, read as paths
    if not files:
        raise FileNotFoundError(f"No {suffix} files found in {path}")
    return files


def source_files(spark: SparkSession, path: str, suffix: str = ".csv") -> list[str]:
    """Sorted distinct ``source_file`` values of a folder, from the names of its files alone (no row is read)."""
    mark = f"/{schemas.SOURCE_FILE_COL}="
    return sorted({unquote(f.rsplit(mark, 1)[1].split("/")[0]) if mark in f else f.rsplit("/", 1)[1]
                   for f in list_files(spark, path, suffix)})


def latest_source_file(spark: SparkSession, path: str, suffix: str = ".csv") -> str:
    """The greatest file name; at least two files are required. With ``source_file=<name>/`` folders,
    a filter on it then reads that file's folder only."""
    names = source_files(spark, path, suffix)
    if len(names) < 2:
        raise ValueError(f"need at least 2 snapshot files, found {len(names)}")
    return names[-1]


def _na_to_null(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    toks = list(tokens)
    return df.select(*[
        F.when(F.col(f"`{f.name}`").isin(toks), F.lit(None)).otherwise(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def read_text_table(spark: SparkSession, path: str, encoding: str = LATIN,
                    na_tokens: Sequence[str] = schemas.NA_TOKENS, suffix: str = ".csv") -> DataFrame:
    """Every file of a folder, all columns as text, union by name,
    ``source_file`` = base name of the file each row came from, unless the
    folder is laid out as ``source_file=<name>/`` partitions (as Spark's
    ``partitionBy`` writes it), in which case the partition value is used."""
    files = list_files(spark, path, suffix)

    def header(f: str) -> tuple[str, ...]:
        # reads only the first line of the file
        return tuple(spark.read.option("header", True).option("encoding", encoding).csv(f).columns)

    # header reads are tiny independent jobs: run them concurrently (bounded)
    with ThreadPoolExecutor(max_workers=min(16, len(files))) as pool:
        headers = list(pool.map(header, files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for f, cols in zip(files, headers):
        groups.setdefault(cols, []).append(f)
    frames = []
    for cols, fs in groups.items():
        schema = T.StructType([T.StructField(c, T.StringType()) for c in cols])
        df = (spark.read.schema(schema).option("header", True).option("encoding", encoding)
              .option("mode", "PERMISSIVE").option("basePath", path).csv(fs))
        if schemas.SOURCE_FILE_COL in df.columns:
            df = df.withColumn(schemas.SOURCE_FILE_COL, F.col(schemas.SOURCE_FILE_COL).cast("string"))
        else:
            df = df.withColumn(schemas.SOURCE_FILE_COL, file_name())
        frames.append(df)
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return _na_to_null(out, na_tokens)


def load_prime(spark: SparkSession, path: str, date_formats: Sequence[str] | None = None,
               encoding: str = LATIN) -> DataFrame:
    """S1-S3 with C1-C5: typed snapshot rows from a folder of monthly CSVs."""
    df = rename_customer_id(read_text_table(spark, path, encoding))          # C3
    df = drop_present(df, schemas.RETIRED_PRIME_COLS)                        # C4
    if "LAST_STATEMENT_DATE" in df.columns and "LAST_STAEMENT_DATE" not in df.columns:
        df = df.withColumnRenamed("LAST_STATEMENT_DATE", "LAST_STAEMENT_DATE")
    canonical = {f.name: f.dataType for f in schemas.PRIME_SCHEMA.fields}
    cols = {}
    for c in df.columns:
        if c in schemas.PRIME_FLOAT_COLS:
            cols[c] = parse_float(c)                                          # C2
        elif c in schemas.PRIME_INT_COLS:
            cols[c] = parse_int(c)                                            # C1
        elif c in schemas.DATE_COLS_PRIME:
            cols[c] = parse_timestamp(c, date_formats)                        # C5
        elif c in schemas.PRIME_STRING_COLS:
            continue
        elif isinstance(canonical.get(c), T.DoubleType):
            cols[c] = lenient_double(c, "string")                             # inferred numeric
    return df.withColumns(cols) if cols else df


def load_transactions(spark: SparkSession, path: str, fmt: str = "csv",
                      date_formats: Sequence[str] | None = None, encoding: str = LATIN) -> DataFrame:
    """Transaction files (CSV or Parquet); raw headers renamed to the
    canonical snake_case names; text kept as text, dates parsed (C5)."""
    if fmt == "parquet":
        df = spark.read.parquet(path)
    else:
        df = read_text_table(spark, path, encoding).drop(schemas.SOURCE_FILE_COL)
    for raw, name in schemas.TXN_COLUMN_NAMES.items():
        if raw in df.columns and raw != name:
            df = df.withColumnRenamed(raw, name)
    if "RIMNO" in df.columns and isinstance(df.schema["RIMNO"].dataType, T.StringType):
        df = df.withColumn("RIMNO", parse_int("RIMNO"))
    dates = {c: parse_timestamp(c, date_formats) for c in ("post_date", "trxn_date")
             if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)}
    return df.withColumns(dates) if dates else df
