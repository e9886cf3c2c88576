from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskweave.functions.dates import parse_flexible
from riskweave.functions.scores import to_points
from riskweave.operators import joins, profile, stability, woe


def test_points_at_the_ends_and_in_between(spark):
    probs = [0.0, 1e-20, 0.1, 0.5, 0.9, 1.0, None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(probs)], "i int, p double")
    got = [r.s for r in df.select("i", to_points(F.col("p")).alias("s")).orderBy("i").collect()]
    assert got[2] == 416.0
    assert got[0] == got[1] == 1000.0 and got[5] == 0.0 and got[6] is None
    assert got[:6] == sorted(got[:6], reverse=True)


def test_dates_of_different_lengths(spark):
    df = spark.createDataFrame([(0, "20240301"), (1, "202403"), (2, "20240231"), (3, "abc"), (4, None)], "i int, d string")
    got = [str(r.d) for r in df.select("i", parse_flexible(F.col("d")).alias("d")).orderBy("i").collect()]
    assert got == ["2024-03-01", "2024-03-01", "None", "None", "None"]


def test_iv_of_void_features(spark):
    rows = [(int(i % 4 == 0 or i > 30), None, -9999.0, float(i)) for i in range(40)]
    df = spark.createDataFrame(rows, "label int, void double, code double, x double")
    got = {r.feature: r.iv for r in woe.iv_numeric(df, ["void", "code", "x"]).collect()}
    assert got["void"] == 0.0 and got["code"] == 0.0 and got["x"] > 0


def test_iv_bins_hold_every_row_inside_the_edges(spark, samples):
    bins = woe.iv_numeric_bins(samples, ["bal", "amt"])
    n = samples.filter("label IN (0, 1)").count()
    assert {r.feature: r.n for r in bins.groupBy("feature").agg(F.sum("total_count").alias("n")).collect()} == {"bal": n, "amt": n}


def test_capped_woe_and_binary_check(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 0), ("c", 0), ("c", 1)], "k string, label int")
    got = {r.category: r.woe for r in woe.capped_woe(df, {"k": F.col("k")}).collect()}
    assert got["a"] == 20.0 and got["b"] == -20.0
    assert got["c"] == pytest.approx(math.log((1 / 3) / (1 / 2)))
    with pytest.raises(ValueError):
        woe.capped_woe(df.filter("label = 1"), {"k": F.col("k")})


def test_psi_of_a_sample_with_itself_is_zero(spark):
    values = [float(v) for v in range(200)]
    rows = [(v, True) for v in values] + [(v, False) for v in values]
    df = spark.createDataFrame(rows, "x double, dev boolean")
    row = stability.psi_numeric(df, ["x"], F.col("dev")).first()
    assert row.psi == 0.0 and row.psi_valid == 0.0
    dev = df.filter("dev")
    out = stability.score_psi(dev, dev, "x").first()
    assert abs(out.psi) < 1e-6 and out.extreme_ratio == 0.0


def test_missing_profile_takes_an_empty_token_list(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "-9998"), (float("nan"), None)], "x double, s string")
    got = {r.feature: r for r in profile.missing_profile(df, ["x", "s"], []).collect()}
    assert got["x"].missing_tot == pytest.approx(2 / 3) and got["s"].missing_tot == pytest.approx(1 / 3)
    typed = {r.feature: r for r in profile.missing_profile(df, ["x", "s"], [1, "-9998"]).collect()}
    assert typed["x"]["missing_1_num"] == pytest.approx(1 / 3) and typed["x"]["missing_-9998_str"] == 0.0
    assert typed["s"]["missing_-9998_str"] == pytest.approx(1 / 3)


def test_concentration_of_an_all_missing_feature(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 1.0)], "x double, y double")
    got = {r.feature: r for r in profile.concentration(df, ["x", "y"]).collect()}
    assert got["x"]["count"] == 0 and got["x"].top is None and got["y"].freq_ratio == 1.0


def test_pareto_front_matches_brute_force(spark):
    rng = np.random.default_rng(8)
    pts = rng.integers(0, 6, size=(120, 3)).astype(float)
    df = spark.createDataFrame(pd.DataFrame(pts, columns=["a", "b", "c"]).assign(t=range(120))).repartition(4)
    got = {r.t for r in joins.pareto_front(df, ["a", "b"], ["c"]).filter("is_pareto_front").collect()}
    signed = pts * [1, 1, -1]
    want = {
        i for i in range(120)
        if not any((signed[j] >= signed[i]).all() and (signed[j] > signed[i]).any() for j in range(120))
    }
    assert got == want
