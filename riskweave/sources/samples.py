"""Reading and writing sample tables."""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskweave.functions.cleaning import sql_list, sql_name
from riskweave.functions.dates import month_of
from riskweave.operators.joins import by_column_batches

# Text that counts as a missing value in a CSV cell.
NULL_TEXT = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
BATCH_COLUMNS = 50


def require_columns(df: DataFrame, required: Iterable[str], source: str = "table") -> DataFrame:
    """Raises when a required column is absent; looks at the schema only."""
    absent = [c for c in required if c not in df.columns]
    if absent:
        raise ValueError(f"{source} lacks columns {absent}")
    return df


def _format_of(path: str, fmt: str | None) -> str:
    if fmt:
        return fmt
    for known in ("parquet", "csv", "json", "orc"):
        if path.rstrip("/").endswith("." + known):
            return known
    return "parquet"


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """CSV with a header. Without a schema, types are found after missing markers are taken out.

    A column is numeric when every present cell is a number. One aggregate
    decides for all columns; large files are split by Spark as usual.
    """
    reader = spark.read.option("header", True)
    if schema is not None:
        raw = reader.schema(schema).csv(path)
        return raw.select(*columns) if columns else raw
    raw = reader.csv(path)
    raw = raw.select(*columns) if columns else raw
    tokens = sql_list(NULL_TEXT)
    cells = raw.selectExpr(*[f"CASE WHEN {sql_name(c)} NOT IN ({tokens}) THEN {sql_name(c)} END AS {sql_name(c)}" for c in raw.columns])
    tests = []
    for i, c in enumerate(cells.columns):
        name = sql_name(c)
        tests.append(f"coalesce(bool_and({name} IS NULL OR try_cast({name} AS BIGINT) IS NOT NULL), true) AS w{i}")
        tests.append(f"coalesce(bool_and({name} IS NULL OR try_cast({name} AS DOUBLE) IS NOT NULL), true) AS d{i}")
        tests.append(f"count({name}) AS n{i}")
    row = cells.selectExpr(*tests).first()
    out = []
    for i, c in enumerate(cells.columns):
        name = sql_name(c)
        if row[f"n{i}"] and row[f"w{i}"]:
            out.append(f"CAST({name} AS BIGINT) AS {name}")
        elif row[f"d{i}"]:
            out.append(f"CAST({name} AS DOUBLE) AS {name}")
        else:
            out.append(name)
    return cells.selectExpr(*out)


def read_samples(
    spark: SparkSession, path: str, required: Iterable[str] = (), fmt: str | None = None, schema=None, columns: Sequence[str] | None = None
) -> DataFrame:
    """A sample table from CSV, Parquet, JSON or ORC with a check of the needed columns."""
    kind = _format_of(path, fmt)
    if kind == "csv":
        df = read_csv(spark, path, schema, columns)
    else:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        df = reader.format(kind).load(path)
        df = df.select(*columns) if columns else df
    return require_columns(df, required, path)


def read_folder(spark: SparkSession, folder: str, required: Iterable[str] = ()) -> list[tuple[str, DataFrame]]:
    """Every CSV file of a folder as (file name, table); files without the needed columns are skipped."""
    required = list(required)
    files = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
        .select("path").orderBy("path").collect()
    )
    out = []
    for f in files:
        name = f.path.rsplit("/", 1)[-1]
        header = spark.read.option("header", True).csv(f.path).columns
        absent = [c for c in required if c not in header]
        if absent:
            warnings.warn(f"{name} skipped: lacks columns {absent}", stacklevel=2)
            continue
        out.append((name, read_csv(spark, f.path)))
    return out


def read_column_batches(spark: SparkSession, path: str, keys: Sequence[str], process=None, batch_size: int = BATCH_COLUMNS, fmt: str | None = None) -> DataFrame:
    """Keys plus a batch of features at a time, processed and joined on the keys again."""
    df = read_samples(spark, path, keys, fmt)
    features = [c for c in df.columns if c not in keys]
    return by_column_batches(df, keys, features, process or (lambda batch, names: batch), batch_size)


def read_by_config(spark: SparkSession, config: dict) -> DataFrame:
    """Reads ``data_path``; ``batch_columns`` chooses the column-batched way and saves its result."""
    keys = list(config.get("base_fea", ()))
    if not config.get("batch_columns"):
        return read_samples(spark, config["data_path"], keys, config.get("format"))
    df = read_column_batches(spark, config["data_path"], keys, batch_size=config.get("batch_size", BATCH_COLUMNS), fmt=config.get("format"))
    write_table(df, config["save_path"])
    return spark.read.parquet(config["save_path"])


def exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def read_or_empty(spark: SparkSession, path: str | None, schema: str, fmt: str | None = None) -> DataFrame:
    """An earlier output, or an empty table of the given schema when it is absent."""
    if path and exists(spark, path):
        return read_samples(spark, path, fmt=fmt)
    return spark.createDataFrame([], schema)


def read_dictionary(spark: SparkSession, path: str | None) -> DataFrame:
    """Feature dictionary; empty when the file or its key column is missing."""
    empty = spark.createDataFrame([], "Feature string, feature_cn string, data_source string")
    if not path or not exists(spark, path):
        return empty
    df = read_samples(spark, path)
    if "Feature" not in df.columns:
        return empty
    have = [c if c in df.columns else f"CAST(NULL AS STRING) AS {c}" for c in ("Feature", "feature_cn", "data_source")]
    return df.selectExpr(*have)


def write_table(df: DataFrame, path: str, fmt: str | None = None, partition_by: Sequence[str] = ()) -> str:
    """Writes a table, Parquet unless the path says otherwise."""
    kind = _format_of(path, fmt)
    writer = df.write.mode("overwrite").partitionBy(*partition_by) if partition_by else df.write.mode("overwrite")
    if kind == "csv":
        writer = writer.option("header", True)
    writer.format(kind).save(path)
    return path


def reproduction_rows(scored: DataFrame, base: Sequence[str], features: Sequence[str], prob: str = "prob_", score: str = "score_", date_col: str = "date", dataset: str = "dataset") -> DataFrame:
    """Base columns, model features, probability, points and month per sample."""
    names = dict.fromkeys([dataset, *base, *features])
    return scored.select(*names, prob, score, month_of(F.col(date_col)).alias("month"))
