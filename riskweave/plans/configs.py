"""Stage settings; field names are the keys of the JSON configuration files."""

from __future__ import annotations

from dataclasses import dataclass, field, fields

from riskweave.spec import SampleSpec


def _pick(cls, values: dict):
    known = {f.name for f in fields(cls)}
    return cls(**{k: (tuple(v) if isinstance(v, list) else v) for k, v in values.items() if k in known})


@dataclass(frozen=True)
class ColumnSettings:
    id_col: str = "id"
    date_col: str = "date"
    channel_col: str = "channel"
    label: str = "label"
    base_fea: tuple = ("id", "date", "label", "channel")

    def spec(self, **more) -> SampleSpec:
        return SampleSpec(self.id_col, self.date_col, self.label, self.channel_col, tuple(self.base_fea), **more)


@dataclass(frozen=True)
class ProfileSettings(ColumnSettings):
    missing_list: tuple = (-9999, "-9998")
    save_output: bool = True


@dataclass(frozen=True)
class SplitSettings(ColumnSettings):
    product_list_keep: tuple = ()
    label_list_keep: tuple = (0, 1)
    fill_val: int = -9999
    method: str = "date"
    train_split_range: tuple | None = None
    oot_split_range: tuple | None = None
    psi_split_range: tuple | None = None
    test_size: float = 0.2
    random_state: int = 42


@dataclass(frozen=True)
class SelectSettings(ColumnSettings):
    iv_thresh: float = 0.01
    psi_thresh: float = 0.2
    miss_thresh: float = 0.9
    corr_thresh: float = 0.8
    use_null_importance: bool = False
    null_runs: int = 80
    top_n: int = 500
    upload_fea_list: tuple = ()


@dataclass(frozen=True)
class TrainSettings(ColumnSettings):
    model_select: str = "boosting"
    n_trials: int = 1
    ks_threshold_min: float = 0.01
    ks_gap_threshold: float = 0.05
    autogluon_time_limit: float = 300.0
    RUN_HPO: bool = True
    model_param: dict = field(default_factory=dict, hash=False)
    model_selection_params: dict = field(default_factory=dict, hash=False)


@dataclass(frozen=True)
class EvalSettings(ColumnSettings):
    bin_num: int = 10
    run_retrain: bool = True


@dataclass(frozen=True)
class ScoreSettings:
    pdo: float = 91.0
    theta: float = 8.6
    p0: float = 410.0
    cut_points: tuple = (0, 400, 450, 500, 550, 600, 650, 700, 750, 800, 850, 999)
    prob_col: str = "prob_"
    score_col: str = "score_"


STAGES = {
    "profile": ProfileSettings,
    "split": SplitSettings,
    "select": SelectSettings,
    "train": TrainSettings,
    "evaluate": EvalSettings,
}


def settings_from(stage: str, config: dict):
    """Settings of a stage from a parsed configuration file."""
    return _pick(STAGES[stage], config.get("settings", config))


def score_from(config: dict) -> ScoreSettings:
    return _pick(ScoreSettings, config.get("score", {}))
