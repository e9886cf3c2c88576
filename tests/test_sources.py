from __future__ import annotations

import json

import pytest

from riskweave.plans.configs import SplitSettings, settings_from
from riskweave.plans.stages import make_split, run_stage
from riskweave.sources import samples as io


def test_csv_types_and_missing_markers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,date,label,channel,x,s\n1,20240101,0,web,NA,n/a\n2,20240102,1,app,1.5,ok\n3,20240103,,web,null,\n")
    df = io.read_samples(spark, str(tmp_path / "a.csv"), ["id", "date", "label", "channel"])
    assert dict(df.dtypes) == {"id": "bigint", "date": "bigint", "label": "bigint", "channel": "string", "x": "double", "s": "string"}
    assert [(r.x, r.s) for r in df.orderBy("id").collect()] == [(None, None), (1.5, "ok"), (None, None)]
    with pytest.raises(ValueError):
        io.read_samples(spark, str(tmp_path / "a.csv"), ["ghost"])


def test_folder_skips_files_without_the_needed_columns(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,2\n")
    (tmp_path / "b.csv").write_text("x\n2\n")
    with pytest.warns(UserWarning):
        got = io.read_folder(spark, str(tmp_path), ["id"])
    assert [n for n, _ in got] == ["a.csv"]


def test_absent_files_become_empty_tables(spark, tmp_path):
    assert io.read_or_empty(spark, str(tmp_path / "none"), "feature string").count() == 0
    assert io.read_dictionary(spark, None).columns == ["Feature", "feature_cn", "data_source"]
    (tmp_path / "d.csv").write_text("name\nx\n")
    assert io.read_dictionary(spark, str(tmp_path / "d.csv")).count() == 0


def test_column_batches_join_back(spark, tmp_path):
    df = spark.createDataFrame([(i, i * 1.0, i * 2.0, i * 3.0) for i in range(20)], "id int, a double, b double, c double")
    path = io.write_table(df, str(tmp_path / "t"))
    out = io.read_column_batches(spark, path, ["id"], batch_size=2)
    assert sorted(map(tuple, out.select("id", "a", "b", "c").collect())) == sorted(map(tuple, df.collect()))


def test_unknown_method_is_an_error(samples):
    with pytest.raises(ValueError):
        make_split(samples, SplitSettings(method="weekly"))


def test_settings_come_from_configuration_keys():
    cfg = settings_from("select", {"settings": {"iv_thresh": 0.02, "upload_fea_list": ["a"], "unknown": 1}})
    assert cfg.iv_thresh == 0.02 and cfg.upload_fea_list == ("a",)


def test_five_stages_through_files(spark, samples, tmp_path):
    root = str(tmp_path)
    source = io.write_table(samples.drop("cust"), f"{root}/data")
    base = {"id_col": "id", "date_col": "date", "label": "label", "channel_col": "channel", "base_fea": ["id", "date", "label", "channel"]}
    out = run_stage(spark, "profile", {"data_path": source, "output_path": {"dst": f"{root}/profile"}, "settings": {**base, "missing_list": [-9999, "-9998"]}})
    assert out["missing"].count() == 13
    split = {
        "data_path": source, "output_path": {"dst": f"{root}/split"},
        "settings": {**base, "method": "date", "train_split_range": [19950101, 19981231], "oot_split_range": [19990101, 20010801], "psi_split_range": [20000101, 20010801]},
    }
    run_stage(spark, "split", split)
    data = {f"{d}_data_path": f"{root}/split/samples/dataset={d}" for d in ("dev", "oot", "psi")}
    out = run_stage(spark, "select", {"data_path": data, "output_path": {"dst": f"{root}/select"}, "settings": {**base, "iv_thresh": 0.01, "psi_thresh": 0.5}})
    kept = [r.feature for r in out["use_fea"].collect()]
    assert "sig" in kept and "sig_dup" not in kept and "sparse" not in kept
    train_cfg = {
        "data_path": {**data, "use_fea_path": f"{root}/select/use_fea"}, "output_path": {"dst": f"{root}/train"},
        "settings": {**base, "n_trials": 1, "model_param": {"n_estimators": 3}, "model_selection_params": {"num_leaves": [4, 8]}},
    }
    out = run_stage(spark, "train", train_cfg)
    assert out["status"] in ("found", "partial", "not_found")
    out = run_stage(spark, "evaluate", {
        "data_path": data, "output_path": {"dst": f"{root}/eval"}, "settings": {**base, "bin_num": 5},
        "model_file": {"model_path": f"{root}/train/model", "model_fea_path": f"{root}/train/model_fea", "model_params_path": f"{root}/train/model_params"},
        "report_all": {"feature_importance_path": f"{root}/train/feature_imp", "single_var_path": f"{root}/select/single_var"},
    })
    perf = {r.dataset: r for r in spark.read.parquet(f"{root}/eval/performance").collect()}
    check = spark.read.parquet(f"{root}/eval/retrain_check").first()
    # The refit uses the saved parameters and the same rows.
    assert check.dev_auc_prob == pytest.approx(perf["dev"].auc, abs=0.02)
    assert json.loads(spark.read.parquet(f"{root}/train/model_params").first().params)["n_estimators"] >= 1
