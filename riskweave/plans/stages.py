"""The five stages. Each takes tables and settings and returns named tables.

Stages hand tables to each other through files, so each can be rerun alone;
``run_stage`` adds the reading and writing around a stage.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.cleaning import identify_types
from riskweave.functions.scores import to_points
from riskweave.operators import clean, importance, metrics, profile, report, score, select, split, train
from riskweave.plans.configs import (
    EvalSettings,
    ProfileSettings,
    ScoreSettings,
    SelectSettings,
    SplitSettings,
    TrainSettings,
    score_from,
    settings_from,
)
from riskweave.session import write_stage
from riskweave.sources.samples import exists, read_dictionary, read_or_empty, read_samples, reproduction_rows, write_table

STATS_SCHEMA = (
    "feature string, iv double, psi double, psi_valid double, missing double, mean double, std double, "
    "min double, max double, unique_rate double, neg_rate double, neg_rate_valid double"
)
# Spellings of the split methods and model choices found in configuration files.
SPLIT_METHODS = {
    "date": "range", "date_range": "range", "date_proportion": "proportion", "data_propration": "proportion",
    "proportion": "proportion", "random": "random",
}
BOOSTING_NAMES = ("lightgbm", "boosting", "gbt")
LOGISTIC_NAMES = ("lr", "logistic")
COMPARE_NAMES = ("autogluon", "compare")


def profile_stage(df: DataFrame, cfg: ProfileSettings = ProfileSettings()) -> dict[str, DataFrame]:
    """Data quality: features, duplicates, dates and default rates."""
    numeric, categorical = identify_types(df, cfg.base_fea)
    features, tokens = [*numeric, *categorical], cfg.missing_list
    cross = profile.cross_default(df, cfg.label, cfg.channel_col, cfg.date_col)
    rates = profile.default_rates(df, cfg.label, cfg.channel_col, cfg.date_col)
    out = {
        "missing": profile.missing_profile(df, features, tokens),
        "concentration": profile.concentration(df, features, tokens),
        "overview": profile.overview(df, cfg.id_col, cfg.channel_col, cfg.date_col),
        "default_rates": rates,
        "cross_default": cross,
        "default_matrix": profile.default_matrix(cross),
        "feature_report": report.feature_report(df, features, tokens),
        "first_features": report.first_features(df, features, tokens),
    }
    if numeric:
        out["numeric"] = profile.numeric_profile(df, numeric, tokens)
    if categorical:
        out["categorical"] = profile.categorical_profile(df, categorical, tokens)
    return out


def make_split(cleaned: DataFrame, cfg: SplitSettings) -> DataFrame:
    """Dispatches on the method; an unknown one is an error."""
    kind = SPLIT_METHODS.get(cfg.method)
    if kind is None:
        raise ValueError(f"unknown split method {cfg.method!r}, use one of {sorted(SPLIT_METHODS)}")
    if kind == "range":
        absent = [n for n in ("train_split_range", "oot_split_range", "psi_split_range") if getattr(cfg, n) is None]
        if absent:
            raise ValueError(f"the date split needs {absent}")
        return split.split_by_date_range(cleaned, cfg.date_col, cfg.train_split_range, cfg.oot_split_range, cfg.psi_split_range)
    if kind == "proportion":
        return split.with_psi_copy(split.split_by_date_proportion(cleaned, cfg.date_col, cfg.id_col, cfg.test_size))
    return split.with_psi_copy(split.split_by_hash(cleaned, cfg.id_col, cfg.test_size, cfg.random_state))


def split_stage(df: DataFrame, cfg: SplitSettings = SplitSettings()) -> dict[str, DataFrame]:
    """Cleaning and the split into dev, oot and psi, with their statistics."""
    spec = cfg.spec(fill_val=cfg.fill_val)
    cleaned = write_stage(clean.clean_samples(df, spec, cfg.product_list_keep, cfg.label_list_keep), "cleaned")
    split.warn_if_few(clean.row_check(cleaned).first())
    samples = split.require_members(make_split(cleaned, cfg))
    return {
        "cleaned": cleaned,
        "samples": samples,
        "target_stats": split.split_report(samples, cfg.date_col, cfg.label),
        "split_overview": report.split_overview(df, cleaned, samples, cfg.channel_col, cfg.date_col),
    }


def select_stage(dev: DataFrame, oot: DataFrame, cfg: SelectSettings = SelectSettings(), saved_stats: DataFrame | None = None) -> dict[str, DataFrame]:
    """Feature statistics and the kept features."""
    numeric, categorical = identify_types(dev, cfg.base_fea)
    spark = dev.sparkSession
    rank = None
    if cfg.use_null_importance:
        def rank(names):
            actual = importance.actual_importance(dev, names, cfg.label, cfg.id_col)
            null = importance.null_importance(dev, names, cfg.label, cfg.id_col, cfg.null_runs)
            return [r.feature for r in importance.top_by_null_score(importance.null_score(actual, null), cfg.top_n).collect()]
    if cfg.upload_fea_list:
        wanted = list(cfg.upload_fea_list)
        select.check_manual_list(dev, wanted)
        if saved_stats is not None and not select.covered_stats(wanted, saved_stats):
            stats = saved_stats.filter(F.col("feature").isin(wanted))
        else:
            stats = select.feature_stats(dev, oot, wanted, cfg.label)
        kept = wanted
    else:
        stats, kept = select.select_features(
            dev, oot, [*numeric, *categorical], cfg.label, cfg.iv_thresh, cfg.psi_thresh, cfg.miss_thresh, cfg.corr_thresh, rank=rank
        )
    return {
        "single_var": stats,
        "mono_var": _bin_table(dev, numeric, categorical, cfg.label),
        "use_fea": spark.createDataFrame(list(enumerate(kept)), "place int, feature string"),
        "selection_report": report.selection_report(stats, kept),
    }


def _bin_table(dev, numeric, categorical, label) -> DataFrame:
    from riskweave.operators import woe

    tables = []
    if numeric:
        tables.append(woe.with_iv(woe.iv_numeric_bins(dev, numeric, label)))
    if categorical:
        tables.append(woe.iv_category_rows(dev, categorical, label))
    return report.union_tables(*tables)


def train_stage(
    dev: DataFrame, oot: DataFrame, features: list[str], cfg: TrainSettings = TrainSettings(), dictionary: DataFrame | None = None
) -> dict:
    """Search, fit, metrics and importances; ``model_select`` names the family."""
    spark = dev.sparkSession
    label, family = cfg.label, cfg.model_select.lower()
    if family in COMPARE_NAMES:
        board = train.compare_models(dev, oot, features, cfg.autogluon_time_limit, label)
        return {"leaderboard": report.leaderboard_report(board)}
    if family in LOGISTIC_NAMES:
        trials = train.search_logistic(dev, oot, features, cfg.n_trials, cfg.ks_threshold_min, cfg.ks_gap_threshold, label)
        best = trials.orderBy(F.desc("objective"), "trial").first()
        c, penalty = (best.c, best.penalty) if best.objective > 0 else (1.0, "l2")
        model = train.fit_logistic(dev, features, c, penalty, label)
        return {"model": model, "trials": trials, **_fit_tables(model, dev, oot, features, label)}
    if family not in BOOSTING_NAMES:
        raise ValueError(f"unknown model_select {cfg.model_select!r}")
    params, out = dict(cfg.model_param), {}
    status = "default"
    if cfg.RUN_HPO:
        space = train.searchable(cfg.model_selection_params or train.SEARCH_SPACE)
        trials = train.summarise_trials(
            train.search_boosting(dev, oot, features, cfg.n_trials, params, space, label),
            cfg.ks_threshold_min, cfg.ks_gap_threshold,
        )
        trials = spark.createDataFrame(trials.collect(), trials.schema)
        best = train.choose_trial(trials).first()
        params, status = {**params, **best.params}, best.status
        out["trials"] = trials
    model = train.fit_boosting(dev, features, params, label)
    importances = train.feature_importance_table(train.tree_importances(spark, model.stages[-1], features), dictionary)
    tables = _fit_tables(model, dev, oot, features, label)
    return {
        **out, **tables, "model": model, "params": params, "status": status, "feature_imp": importances,
        "training_report": report.training_report(tables["metrics"], importances),
    }


def _fit_tables(model, dev, oot, features, label) -> dict:
    both = train._both(dev, oot, features, label)
    scored = write_stage(train.score(model, both, features).select("dataset", label, train.PROB), "fitted")
    row = train.evaluate_fit(scored, label)
    levels = metrics.level_table(scored.filter("dataset = 'oot'"), train.PROB, label)
    return {"metrics": dev.sparkSession.createDataFrame([row]), "levels": levels}


def evaluate_stage(
    samples: DataFrame, model, features: list[str], cfg: EvalSettings = EvalSettings(), points: ScoreSettings = ScoreSettings(),
    importances: DataFrame | None = None, stats: DataFrame | None = None, params: dict | None = None,
) -> dict[str, DataFrame]:
    """Metrics, stability, lift, points, bands and the retrain check of a fitted model.

    ``samples`` carries the three samples in a ``dataset`` column. All rows are
    scored; only measures that compare with the label leave grey and unlabelled ones out.
    """
    columns = list(dict.fromkeys(["dataset", cfg.id_col, cfg.date_col, cfg.label, cfg.channel_col, *features]))
    scored = train.score(model, samples.select(*columns), features, points.prob_col)
    scored = scored.withColumn(points.score_col, to_points(F.col(points.prob_col), points.p0, points.pdo, points.theta))
    scored = write_stage(scored, "scored")
    out = report.evaluation_report(scored, points.prob_col, cfg.channel_col, cfg.label, cfg.date_col, cfg.bin_num)
    labelled_oot = scored.filter((F.col("dataset") == "oot") & F.col(cfg.label).isin(0, 1))
    out["score_bands"] = metrics.score_bands(labelled_oot, points.score_col, points.cut_points, cfg.label)
    out["band_table"] = score.band_table(scored, points.score_col, cfg.label)
    out["reproduction"] = reproduction_rows(
        scored, [cfg.id_col, cfg.date_col, cfg.label, cfg.channel_col], features, points.prob_col, points.score_col, cfg.date_col
    )
    shown = [cfg.id_col, *features, points.prob_col]
    out["parity_rows"] = score.parity_rows(scored.filter("dataset = 'oot'"), shown, cfg.id_col)
    out["parity_sample"] = score.parity_sample(scored.filter("dataset = 'oot'"), shown, cfg.id_col)
    if importances is not None:
        spark = samples.sparkSession
        out["model_features"] = report.importances_with_stats(
            importances, stats if stats is not None else spark.createDataFrame([], STATS_SCHEMA)
        )
    if cfg.run_retrain:
        check, _, _ = score.retrain_check(samples, features, params or {}, cfg.label, points.p0, points.pdo, points.theta)
        out["retrain_check"] = check
    return out


def run_stage(spark: SparkSession, stage: str, config: dict) -> dict:
    """Reads the inputs a configuration names, runs one stage and writes its tables."""
    cfg = settings_from(stage, config)
    data, dst = config["data_path"], config["output_path"]["dst"]
    if stage == "profile":
        out = profile_stage(read_samples(spark, data, cfg.base_fea), cfg)
    elif stage == "split":
        out = split_stage(read_samples(spark, data, cfg.base_fea), cfg)
    elif stage == "select":
        dev, oot = _samples(spark, data, cfg)
        stats_path = config["output_path"].get("single_var_path")
        saved = read_samples(spark, stats_path) if stats_path and exists(spark, stats_path) else None
        out = select_stage(dev, oot, cfg, saved)
    elif stage == "train":
        dev, oot = _samples(spark, data, cfg)
        features = [r.feature for r in read_samples(spark, data["use_fea_path"]).orderBy("place").collect()]
        out = train_stage(dev, oot, features, cfg, read_dictionary(spark, data.get("feature_dic_path")))
        if "model" in out:
            train.save_model(out["model"], f"{dst}/model")
            out["model_fea"] = spark.createDataFrame(list(enumerate(features)), "place int, feature string")
            if "params" in out:
                out["model_params"] = spark.createDataFrame([(json.dumps(out["params"]),)], "params string")
    elif stage == "evaluate":
        parts = [read_samples(spark, data[f"{n}_data_path"]).withColumn("dataset", F.lit(n)) for n in ("dev", "oot", "psi")]
        samples = report.union_tables(*parts)
        files = config["model_file"]
        features = [r.feature for r in read_samples(spark, files["model_fea_path"]).orderBy("place").collect()]
        model = train.load_model(files["model_path"])
        earlier = config.get("report_all", {})
        importances = read_or_empty(
            spark, earlier.get("feature_importance_path"),
            "feature string, feature_cn string, data_source string, importance_score_split bigint, importance_score_gain double, imp_split_ratio double, imp_gain_ratio double",
        )
        stats = read_or_empty(spark, earlier.get("single_var_path"), STATS_SCHEMA)
        params = {}
        if files.get("model_params_path") and exists(spark, files["model_params_path"]):
            params = json.loads(read_samples(spark, files["model_params_path"]).first().params)
        out = evaluate_stage(samples, model, features, cfg, score_from(config), importances, stats, params)
    else:
        raise ValueError(f"unknown stage {stage!r}")
    for name, table in out.items():
        if isinstance(table, DataFrame):
            write_table(table, f"{dst}/{name}", "parquet", ["dataset"] if name in ("samples", "reproduction") else ())
    return out


def _samples(spark: SparkSession, data: dict, cfg) -> tuple[DataFrame, DataFrame]:
    return tuple(read_samples(spark, data[k], cfg.base_fea) for k in ("dev_data_path", "oot_data_path"))
