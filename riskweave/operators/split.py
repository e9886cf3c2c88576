"""Splits into dev, oot and psi samples, and their statistics."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from riskweave.functions.dates import month_of
from riskweave.operators.clean import check_range, in_range
from riskweave.operators.quantiles import running_totals

HASH_SPACE = 2**32


def split_by_date_range(
    df: DataFrame, date_col: str, train: Sequence[int], oot: Sequence[int], psi: Sequence[int]
) -> DataFrame:
    """A ``dataset`` column by inclusive date ranges.

    Ranges may overlap: a row then appears once per sample it belongs to.
    """
    check_range(train, oot, psi)
    date = F.col(date_col)
    members = F.array_compact(
        F.array(
            F.when(in_range(date, train), F.lit("dev")),
            F.when(in_range(date, oot), F.lit("oot")),
            F.when(in_range(date, psi), F.lit("psi")),
        )
    )
    return df.select("*", F.explode(members).alias("dataset"))


def require_members(split: DataFrame, names: Sequence[str] = ("dev", "oot", "psi")) -> DataFrame:
    """Raises when a sample is empty; one count over all samples."""
    found = {r.dataset: r["count"] for r in split.groupBy("dataset").count().collect()}
    empty = [n for n in names if not found.get(n)]
    if empty:
        raise ValueError(f"no rows in sample(s) {empty}")
    return split


def _hash32(*parts: Column) -> Column:
    """First 32 bits of an md5, the same number on every engine and partitioning."""
    return F.conv(F.substring(F.md5(F.concat_ws("-", *[p.cast("string") for p in parts])), 1, 8), 16, 10).cast("bigint")


NO_DATE = 99_999_999
#: Dates that are listed on the driver, keys that are counted there, and keys drawn to narrow down more. None changes a result.
DAYS_AT_ONCE, KEYS_AT_ONCE, DRAWN = 100_000, 50_000, 1000


def _cut_day(per_day: DataFrame, test_size: float) -> tuple[int, int, int, int] | None:
    """(date of the cut, its rows, how many of them are dev, rows in all), None where all rows are dev."""
    listed = per_day.limit(DAYS_AT_ONCE + 1).collect()
    if len(listed) <= DAYS_AT_ONCE:
        quota, upto = int(sum(r.rows for r in listed) * (1 - test_size)), 0
        for r in sorted(listed):
            if upto + r.rows > quota:
                return r.day, r.rows, quota - upto, quota
            upto += r.rows
        return None
    quota = int(per_day.agg(F.sum("rows")).first()[0] * (1 - test_size))
    totals = running_totals(per_day, "day", ["rows"])
    r = totals.filter((F.col("below_rows") <= quota) & (F.col("below_rows") + F.col("rows") > quota)).first()
    return None if r is None else (int(r.day), r.rows, quota - r.below_rows, quota)


def _order(key: Row) -> tuple:
    return (key.id is not None, 0 if key.id is None else key.id, key.h1, key.h2)


def _literal(key: Row, kind: DataType) -> Column:
    return F.struct(F.lit(key.id).cast(kind).alias("id"), F.lit(key.h1).cast("bigint").alias("h1"), F.lit(key.h2).cast("bigint").alias("h2"))


def _key_at(keys: DataFrame, rank: int, size: int) -> tuple[Row, int, int]:
    """(key of the ``rank``-th row by (id, h1, h2), rows with that key, how many of these are needed to reach the rank).

    Keys drawn at random name a bracket around the rank and counts say on which
    side of its ends the rank lies, until few keys are left, which are counted one by one.
    """
    kind, here = keys.schema["id"].dataType, F.struct("id", "h1", "h2")
    turn = 0
    while size > KEYS_AT_ONCE:
        drawn = sorted(keys.orderBy(F.xxhash64("h1", "h2", F.lit(turn))).limit(DRAWN).collect(), key=_order)
        at, margin = rank / size * len(drawn), 3 * len(drawn) ** 0.5
        low, high = drawn[max(0, int(at - margin))], drawn[min(len(drawn) - 1, int(at + margin))]
        a, b = _literal(low, kind), _literal(high, kind)
        n = keys.agg(*[F.count_if(test).alias(name) for name, test in (("la", here < a), ("ea", here <= a), ("lb", here < b), ("eb", here <= b))]).first()
        if rank <= n.la:
            keys, size = keys.filter(here < a), n.la
        elif rank <= n.ea:
            return low, n.ea - n.la, rank - n.la
        elif rank <= n.lb:
            keys, rank, size = keys.filter((here > a) & (here < b)), rank - n.ea, n.lb - n.ea
        elif rank <= n.eb:
            return high, n.eb - n.lb, rank - n.lb
        else:
            keys, rank, size = keys.filter(here > b), rank - n.eb, size - n.eb
        turn += 1
    for key in sorted(keys.groupBy("id", "h1", "h2").agg(F.count(F.lit(1)).alias("rows")).collect(), key=_order):
        if rank <= key.rows:
            return key, key.rows, rank
        rank -= key.rows
    raise AssertionError("rank beyond the rows")


def split_by_date_proportion(df: DataFrame, date_col: str, id_col: str, test_size: float = 0.2) -> DataFrame:
    """The earliest ``floor(n * (1 - test_size))`` rows are dev, the rest oot.

    Ties on a date are broken by id, a missing id first, ties on the id by a
    hash of the row; rows without a date come last. There is no sort: counts
    per date name the date of the cut, and the key of the last dev row on it is selected by
    counts. Where rows equal in all columns lie on both sides of the cut they are told apart by number alone,
    so as many as needed are made of one of them.
    """
    day = F.coalesce(F.col(date_col).cast("bigint"), F.lit(NO_DATE))
    found = _cut_day(df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("rows")), test_size)
    if found is None:
        return df.withColumn("dataset", F.lit("dev"))
    cut, rows, left, _ = found
    if left == 0:
        return df.withColumn("dataset", F.when(day < cut, "dev").otherwise("oot"))
    columns = [F.col(f"`{c}`") for c in df.columns]
    # Which values are missing is part of the hash, or a value and a null in exchanged columns would hash alike.
    hashed = [F.xxhash64(F.lit(salt), *columns, *[c.isNull() for c in columns]).alias(f"h{salt}") for salt in (1, 2)]
    last, equal, wanted = _key_at(df.filter(day == cut).select(F.col(f"`{id_col}`").alias("id"), *hashed), left, rows)
    here, end = F.struct(F.col(f"`{id_col}`").alias("id"), *hashed), _literal(last, df.schema[id_col].dataType)
    marked = df.withColumn("dataset", F.when((day < cut) | ((day == cut) & (here <= end)), "dev").otherwise("oot"))
    if equal == wanted:
        return marked
    same = (day == cut) & (here == end)
    number = df.sparkSession.range(equal).withColumnRenamed("id", "_number")
    one = F.broadcast(df.filter(same).limit(1))
    copies = number.crossJoin(one).withColumn("dataset", F.when(F.col("_number") < wanted, "dev").otherwise("oot")).drop("_number")
    return marked.filter(~same).unionByName(copies)


def split_by_hash(df: DataFrame, id_col: str, test_size: float = 0.2, random_state: int = 42) -> DataFrame:
    """Random but repeatable split: the id and seed decide, not the partitioning."""
    cut = int(test_size * HASH_SPACE)
    is_oot = _hash32(F.col(id_col), F.lit(random_state)) < cut
    return df.withColumn("dataset", F.when(is_oot, "oot").otherwise("dev"))


def with_psi_copy(split: DataFrame) -> DataFrame:
    """Adds the oot rows a second time as the psi sample."""
    names = F.when(F.col("dataset") == "oot", F.array(F.lit("oot"), F.lit("psi"))).otherwise(F.array(F.lit("dev")))
    others = [F.col(f"`{c}`") for c in split.columns if c != "dataset"]
    return split.select(*others, F.explode(names).alias("dataset"))


def learn_validate_out(
    df: DataFrame,
    time_var: str,
    id_col: str,
    flag: str = "model_ind",
    learn_share: float = 0.7,
    out_from="2017-01-01",
    seed: int = 42,
) -> DataFrame:
    """L / V / O flag: out of time from a date on, the rest learn or validate by hash."""
    learn = _hash32(F.col(id_col), F.lit(seed)) < int(learn_share * HASH_SPACE)
    return df.withColumn(flag, F.when(F.col(time_var) >= out_from, "O").when(learn, "L").otherwise("V"))


def label_counts(label: str) -> list[Column]:
    col = F.col(label)
    return [
        F.count(F.lit(1)).alias("total"),
        F.count_if(col == 0).alias("good"),
        F.count_if(col == 1).alias("bad"),
        F.count_if(col == 2).alias("grey"),
        F.coalesce(F.try_divide(F.count_if(col == 1), F.count(F.lit(1))), F.lit(0.0)).alias("bad_rate"),
    ]


def sample_stats(df: DataFrame, label: str = "label") -> DataFrame:
    return df.agg(*label_counts(label))


def monthly_stats(df: DataFrame, date_col: str = "date", label: str = "label") -> DataFrame:
    return df.groupBy(month_of(F.col(date_col)).alias("month")).agg(*label_counts(label))


def split_report(split: DataFrame, date_col: str = "date", label: str = "label") -> DataFrame:
    """Overall and monthly rows of the dev and oot samples from one pass."""
    rows = split.filter(F.col("dataset").isin("dev", "oot")).select(
        "dataset", label, month_of(F.col(date_col)).alias("month")
    )
    stats = rows.groupingSets([["dataset"], ["dataset", "month"]], "dataset", "month").agg(
        F.grouping("month").alias("_all"), *label_counts(label)
    )
    return stats.select(
        "dataset",
        F.when(F.col("_all") == 1, F.lit("Overall")).otherwise(F.col("month")).alias("month"),
        "total", "good", "bad", "grey", "bad_rate",
    ).filter("month IS NOT NULL")


def date_bounds(split: DataFrame, date_col: str = "date") -> DataFrame:
    return split.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.col(date_col).cast("bigint")).alias("min_date"),
        F.max(F.col(date_col).cast("bigint")).alias("max_date"),
    )


def warn_if_few(check_row) -> None:
    if check_row.too_few:
        warnings.warn(f"only {check_row.n_rows} rows left after cleaning", stacklevel=2)
