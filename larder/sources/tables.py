"""Reading and writing tables."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from larder.functions.numbers import nan_to_null
from larder.operators.cleaning import canonical_names

_MALFORMED = "_malformed_line"


def _paths(path: str | Sequence[str]) -> str | list[str]:
    return path if isinstance(path, str) else list(path)


def _csv_reader(spark: SparkSession, encoding: str = "UTF-8", multi_line: bool = False):
    return (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multi_line)
    )


def _files_by_encoding(spark: SparkSession, path: str | Sequence[str]) -> dict[str, list[str]]:
    """The files that are valid UTF-8 and the others; empty if all are valid.

    One scan; the driver gets one row per file, as it does when it lists them.
    """
    lines = spark.read.text(_paths(path)).select("value", F.col("_metadata.file_path").alias("file"))
    files = lines.groupBy("file").agg(F.bool_and(F.is_valid_utf8("value")).alias("valid"))
    valid = {row["file"]: row["valid"] for row in files.collect()}
    if all(valid.values()):
        return {}
    plain = {f: re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(f)) for f in valid}
    return {
        "UTF-8": sorted(plain[f] for f, ok in valid.items() if ok),
        "ISO-8859-1": sorted(plain[f] for f, ok in valid.items() if not ok),
    }


def read_raw_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    encoding: str | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Raw invoice CSV, every column as text, with canonical column names.

    ``path`` may be a folder or a glob. Without ``encoding`` each file is read as
    UTF-8, or as Latin-1 if it holds text that is not valid UTF-8 (one scan
    before). Name the encoding to save that scan. ``multi_line`` keeps line
    breaks inside quoted fields; such files can't be split among tasks.
    """
    groups = {} if encoding is not None else _files_by_encoding(spark, path)
    if not groups:
        reader = _csv_reader(spark, encoding or "UTF-8", multi_line)
        return canonical_names(reader.csv(_paths(path)))
    parts = [
        canonical_names(_csv_reader(spark, name, multi_line).csv(files))
        for name, files in groups.items() if files
    ]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def malformed_lines(
    spark: SparkSession,
    path: str | Sequence[str],
    encoding: str = "UTF-8",
    multi_line: bool = False,
) -> DataFrame:
    """Lines with more or fewer fields than their header, as ``line``.

    Reading keeps them, with the missing fields null and the surplus left out.
    """
    reader = _csv_reader(spark, encoding, multi_line)
    columns = reader.csv(_paths(path)).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _MALFORMED]])
    rows = reader.schema(schema).option("columnNameOfCorruptRecord", _MALFORMED).csv(_paths(path))
    # Always true, but it needs every field, and only then are they counted.
    whole = F.concat_ws("", *[f"`{c}`" for c in columns]) >= ""
    return rows.where(F.col(_MALFORMED).isNotNull() & whole).select(F.col(_MALFORMED).alias("line"))


def read_table(
    spark: SparkSession,
    path: str,
    schema: str | T.StructType,
    format: str = "parquet",
    required: bool = True,
) -> DataFrame:
    """A stored table with its declared schema.

    A missing path raises, or gives an empty table when not ``required``.
    """
    reader = spark.read.schema(schema)
    if format == "csv":
        reader = reader.option("header", True).option("escape", '"')
    try:
        return reader.format(format).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        if required:
            raise FileNotFoundError(f"no table at {path}; run the pipeline first") from error
        return spark.createDataFrame([], schema)


def conform(df: DataFrame, schema: str, name: str) -> DataFrame:
    """``df`` with exactly the declared columns and types; raises when one is missing."""
    declared = T.StructType.fromDDL(schema)
    missing = [c for c in declared.names if c not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks {', '.join(missing)}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared])


def write_table(
    df: DataFrame, path: str, format: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    writer = df.write.mode("overwrite").format(format)
    if format == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


MONTH = "yyyy-MM"


def write_features(features: DataFrame, path: str, files_per_month: int | None = None) -> None:
    """Features by month, in files of about the session's advisory partition size.

    ``recent_history`` then only reads the folders it needs. Adaptive execution splits a
    large month and joins small ones to one task, so there are as many tasks as the data
    need; ``files_per_month`` deals products over that many files instead. Rows are
    sorted by product and day inside a file.
    """
    monthly = features.withColumn("sale_month", F.date_format("date", MONTH))
    if files_per_month is None:
        dealt = monthly.hint("rebalance", F.col("sale_month"))
    else:
        part = F.pmod(F.xxhash64("stock_code"), F.lit(files_per_month))
        dealt = monthly.withColumn("_part", part).repartition("sale_month", "_part").drop("_part")
    write_table(dealt.sortWithinPartitions("sale_month", "stock_code", "date"), path, partition_by=["sale_month"])


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV for people. ``single_file`` is for reports limited to few rows."""
    write_table(df.coalesce(1) if single_file else df, path, "csv")


def preview(spark: SparkSession, path: str, rows: int = 200) -> DataFrame:
    """The first rows of a raw CSV with its own headers, every column as text."""
    return _csv_reader(spark).csv(path).limit(rows)


def as_records(df: DataFrame, out: str = "record") -> DataFrame:
    """Rows as JSON text: NaN becomes null, times are ISO, null fields are kept."""
    clean = nan_to_null(df)
    fields = [
        F.date_format(f.name, "yyyy-MM-dd'T'HH:mm:ss").alias(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType))
        else F.col(f.name)
        for f in clean.schema.fields
    ]
    return clean.select(
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias(out)
    )


def write_json(df: DataFrame, path: str) -> None:
    """A small result (impact, run summary) as JSON."""
    df.coalesce(1).write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_table(spark, path, schema, "json", required=False)
