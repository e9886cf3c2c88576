from __future__ import annotations

import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.operators import clean, split


def frame(spark, n=400, hot=False):
    rows = [(7 if hot and i % 3 else i, 20240100 + (i * 7) % 5, float(i)) for i in range(n)]
    rows += [(9000 + i, None, 0.0) for i in range(5)]
    return spark.createDataFrame(rows, "id bigint, date bigint, v double").repartition(6)


@pytest.mark.parametrize("hot", [False, True])
@pytest.mark.parametrize("share", [0.2, 0.5, 0.999])
def test_proportional_split_has_the_exact_size(spark, hot, share):
    df = frame(spark, hot=hot)
    got = split.split_by_date_proportion(df, "date", "id", share).toPandas()
    quota = int(len(got) * (1 - share))
    dev = got[got.dataset == "dev"]
    assert len(dev) == quota and len(got) == 405
    order = got.assign(d=got.date.fillna(99999999)).sort_values(["d", "id"])
    if not hot:
        assert set(dev.id) == set(order.id[:quota])
    assert not len(dev) or dev.date.fillna(99999999).max() <= got[got.dataset == "oot"].date.fillna(99999999).min()


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_missing_ids_come_first_and_no_row_is_lost(spark, kind):
    rows = [(None if i % 4 == 0 else i, 20240101 + i % 2, i // 3) for i in range(90)] + [(None, 20240102, 0)] * 30
    df = spark.createDataFrame(rows, "id bigint, date bigint, v bigint").withColumn("id", F.col("id").cast(kind)).repartition(5)
    for share in (0.1, 0.3, 0.45, 0.5, 0.9, 1.0, 0.0):
        got = split.split_by_date_proportion(df, "date", "id", share).toPandas()
        dev = got[got.dataset == "dev"]
        assert len(got) == 120 and len(dev) == int(120 * (1 - share))
        cut = dev[dev.date == dev.date.max()] if len(dev) else dev
        rest = got[(got.dataset == "oot") & (got.date == cut.date.max())] if len(dev) else dev
        if cut.id.notna().any():
            assert rest.id.notna().all()


def test_text_ids(spark):
    df = spark.createDataFrame([(f"k{i:04d}", 20240101) for i in range(100)], "id string, date bigint")
    got = split.split_by_date_proportion(df, "date", "id", 0.35).toPandas()
    assert sorted(got[got.dataset == "dev"].id) == [f"k{i:04d}" for i in range(65)]


@pytest.mark.parametrize("days, keys, drawn", [(100_000, 10, 7), (2, 1, 40), (100_000, 0, 3)])
def test_selection_by_brackets_finds_the_same_rows(spark, monkeypatch, days, keys, drawn):
    rows = [(None if i % 11 == 0 else i % 40, 20240101 + i % 3, None if i % 2 else 5, 5 if i % 2 else None) for i in range(300)] + [(7, 20240102, 1, 1)] * 60
    df = spark.createDataFrame(rows, "id bigint, date bigint, v bigint, w bigint").repartition(4)
    shares = (0.2, 0.45, 0.5, 0.55, 0.6)
    want = [sorted(map(repr, split.split_by_date_proportion(df, "date", "id", s).collect())) for s in shares]
    monkeypatch.setattr(split, "DAYS_AT_ONCE", days)
    monkeypatch.setattr(split, "KEYS_AT_ONCE", keys)
    monkeypatch.setattr(split, "DRAWN", drawn)
    for share, rows_ in zip(shares, want, strict=True):
        got = split.split_by_date_proportion(df, "date", "id", share)
        assert sorted(map(repr, got.collect())) == rows_ and got.filter("dataset = 'dev'").count() == int(360 * (1 - share))
        assert sorted(map(repr, got.drop("dataset").collect())) == sorted(map(repr, df.collect()))


def test_hash_split_does_not_depend_on_partitioning(spark):
    df = frame(spark)
    a = split.split_by_hash(df, "id").filter("dataset = 'oot'").select("id").toPandas().id
    b = split.split_by_hash(df.repartition(1), "id").filter("dataset = 'oot'").select("id").toPandas().id
    assert sorted(a) == sorted(b)
    assert 0.1 < len(a) / 405 < 0.3


def test_ranges_are_checked(spark):
    df = frame(spark)
    with pytest.raises(ValueError):
        split.split_by_date_range(df, "date", (2, 1), (1, 2), (1, 2))
    with pytest.raises(ValueError):
        split.split_by_date_range(df, "date", (1,), (1, 2), (1, 2))
    with pytest.raises(ValueError):
        split.require_members(split.split_by_date_range(df, "date", (1, 2), (20240100, 20240101), (20240100, 20240104)))
    overlap = split.split_by_date_range(df, "date", (20240100, 20240102), (20240102, 20240104), (20240102, 20240104))
    assert overlap.filter("date = 20240102").groupBy("dataset").count().count() == 3


def test_cleaning_fills_and_filters(spark):
    rows = [(1, 1, 0, "a", None, ""), (2, 1, 1, "a", float("nan"), None), (3, 1, 2, "b", 5.0, "x"), (4, 1, None, "b", 1.0, "y")]
    df = spark.createDataFrame(rows, "id int, date int, label int, channel string, x double, s string")
    got = clean.clean_samples(df).toPandas().sort_values("id")
    assert got.id.tolist() == [1, 2]
    assert got.x.tolist() == [-9999.0, -9999.0] and got.s.tolist() == ["-9999", "-9999"]
    assert clean.row_check(clean.clean_samples(df)).first().too_few
