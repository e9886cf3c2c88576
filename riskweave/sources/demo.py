"""Sample tables for tests, checks and the bench, derived from the test tables.

``risk_samples`` turns orders into loan applications: status F is good, O is
bad, everything else grey. ``scored`` keeps the binary rows and adds a
probability made of integers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.session import shuffle_width, write_stage

LINE_COLUMNS = ("n_lines", "sum_qty", "max_disc")
COLUMNS = (
    "id", "cust", "date", "label", "channel", "amt", "bal", "bal_dup", "nation", "seg",
    "n_lines", "sum_qty", "max_disc", "sparse", "konst", "drift", "sig", "sig_dup",
)
NUMERIC = (
    "amt", "bal", "bal_dup", "nation", "n_lines", "sum_qty", "max_disc",
    "sparse", "konst", "drift", "sig", "sig_dup",
)
CUT_DATE = 19990101

_written: dict[tuple[str, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def risk_samples(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """One row per order; lineitem is only joined when one of its columns is asked for."""
    columns = columns or COLUMNS
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey)
    if set(columns) & set(LINE_COLUMNS):
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy("l_orderkey")
            .agg(
                F.count(F.lit(1)).alias("n_lines"),
                F.sum("l_quantity").alias("sum_qty"),
                F.max("l_discount").alias("max_disc"),
            )
        )
        joined = joined.join(lines, joined.o_orderkey == lines.l_orderkey, "left")
    day = F.col("o_orderdate")
    date = (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("bigint")
    sig = ((key * 7919) % 1000 + F.when(F.col("o_orderstatus") == "O", 150).otherwise(0)).cast("double")
    status = F.col("o_orderstatus")
    void = F.lit(-9999.0)
    columns_by_name = {
        "id": key,
        "cust": F.col("o_custkey"),
        "date": date,
        "label": F.when(key % 101 != 0, F.when(status == "F", 0).when(status == "O", 1).otherwise(2)),
        "channel": F.col("o_orderpriority"),
        "amt": F.col("o_totalprice"),
        "bal": F.when(key % 29 == 0, None).when(key % 17 == 0, void)
        .when(key % 23 == 0, F.lit(-9998.0)).otherwise(F.col("c_acctbal")),
        "bal_dup": F.col("c_acctbal") * 2 + 1,
        "nation": F.col("c_nationkey").cast("bigint"),
        "seg": F.when(key % 13 == 0, None).when(key % 19 == 0, "")
        .when(key % 31 == 0, "-9998").otherwise(F.col("c_mktsegment")),
        "sparse": F.when(key % 20 == 0, F.col("o_totalprice")).otherwise(void),
        "konst": F.lit(1.0),
        "drift": sig + F.when(date >= CUT_DATE, 600).otherwise(0),
        "sig": sig,
        "sig_dup": sig * 2 + 5,
    }
    return joined.select(*[columns_by_name.get(c, F.col(c)).alias(c) for c in columns])


def samples_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``risk_samples`` written once per session, for operators with several passes.

    The rows are spread evenly before the write: after the join a customer with
    very many orders would otherwise leave one file much larger than the rest.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        _written[key] = write_stage(
            risk_samples(spark, sf_dir).repartition(shuffle_width(spark)), "risk_samples"
        )
    return _written[key]


def add_probability(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label").isin(0, 1)).withColumn(
        "prob_", (F.col("sig").cast("bigint") * 8 + (F.col("id") * 31) % 800) / F.lit(10000.0)
    )


def scored(spark: SparkSession, sf_dir: str, *extra: str) -> DataFrame:
    columns = dict.fromkeys(("id", "date", "label", "channel", "bal", "sig") + extra)
    return add_probability(risk_samples(spark, sf_dir, *columns))


def scored_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``scored`` on top of the written sample table."""
    return add_probability(
        samples_table(spark, sf_dir).select("id", "date", "label", "channel", "bal", "sig")
    )


def with_dataset(df: DataFrame) -> DataFrame:
    """dev before the cut date, oot from it on."""
    return df.withColumn("dataset", F.when(F.col("date") < CUT_DATE, "dev").otherwise("oot"))
