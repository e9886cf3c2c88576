"""Typing and missing-value expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def identify_types(df: DataFrame, drop: Iterable[str] = ()) -> tuple[list[str], list[str]]:
    """Numeric and categorical feature names in column order (schema only, no job)."""
    dropped = set(drop)
    numeric, categorical = [], []
    for f in df.schema.fields:
        if f.name in dropped:
            continue
        if isinstance(f.dataType, (T.NumericType, T.BooleanType)):
            numeric.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
    return numeric, categorical


def type_name(df: DataFrame, name: str) -> str:
    return "categorical" if isinstance(df.schema[name].dataType, T.StringType) else "numeric"


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double_sql(df: DataFrame, name: str) -> str:
    """SQL of a column as double, with NaN turned into NULL so aggregates skip it."""
    kind = df.schema[name].dataType
    col = sql_name(name)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return f"nanvl(CAST({col} AS DOUBLE), CAST(NULL AS DOUBLE))"
    if isinstance(kind, T.BooleanType):
        return f"CAST(CAST({col} AS INT) AS DOUBLE)"
    return f"CAST({col} AS DOUBLE)"


def as_double(df: DataFrame, name: str) -> Column:
    return F.expr(double_sql(df, name))


def tokens_for(df: DataFrame, name: str, missing_list: Iterable) -> list:
    """Missing tokens that can match the column: numbers on numbers, text on text."""
    text = type_name(df, name) == "categorical"
    return [t for t in missing_list if isinstance(t, str) == text]


def typed_sql(df: DataFrame, name: str) -> str:
    """Numeric columns as NaN-free double, the others as they are."""
    return sql_name(name) if type_name(df, name) == "categorical" else double_sql(df, name)


def sql_list(values: Iterable) -> str:
    return ", ".join(sql_text(v) if isinstance(v, str) else f"{float(v)!r}D" for v in values)


def is_token_sql(df: DataFrame, name: str, missing_list: Iterable) -> str:
    tokens = tokens_for(df, name, missing_list)
    return f"coalesce({typed_sql(df, name)} IN ({sql_list(tokens)}), false)" if tokens else "false"


def known_sql(df: DataFrame, name: str, missing_list: Iterable) -> str:
    """SQL of the typed column with missing tokens replaced by NULL."""
    tokens = tokens_for(df, name, missing_list)
    col = typed_sql(df, name)
    return f"CASE WHEN {col} NOT IN ({sql_list(tokens)}) THEN {col} END" if tokens else col


def fill_missing(df: DataFrame, numeric: list[str], categorical: list[str], fill_val=-9999) -> DataFrame:
    """NULL or NaN numbers become ``fill_val``; NULL or empty text its string form."""
    changes = {}
    for c in numeric:
        kind = df.schema[c].dataType
        col = F.col(f"`{c}`")
        if isinstance(kind, (T.FloatType, T.DoubleType)):
            col = F.nanvl(col, F.lit(None).cast(kind))
        elif isinstance(kind, T.BooleanType):
            col = col.cast("int")
        changes[c] = F.coalesce(col, F.lit(fill_val).cast("int" if isinstance(kind, T.BooleanType) else kind))
    for c in categorical:
        col = F.col(f"`{c}`")
        changes[c] = F.when(col.isNull() | (col == ""), F.lit(str(fill_val))).otherwise(col)
    return df.withColumns(changes) if changes else df
