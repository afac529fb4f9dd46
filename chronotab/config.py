"""Typed domain configuration (split windows, maturity, evaluation, drift, gate).

A domain is a config plus three functions (see ``plans.domains``). Every threshold used by an
operator comes from here rather than from a literal inside the operator.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def _ts(value) -> dt.datetime:
    if isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    return dt.datetime.fromisoformat(str(value))


@dataclass(frozen=True)
class Window:
    start: dt.datetime
    end: dt.datetime  # inclusive instant: "2017-06-30" means midnight, not end of day

    @classmethod
    def of(cls, start, end) -> "Window":
        return cls(_ts(start), _ts(end))


@dataclass(frozen=True)
class SplitConfig:
    train: Window
    validation: Window
    test: Window
    gap_days: int = 0

    @classmethod
    def of(cls, train, validation, test, gap_days=0) -> "SplitConfig":
        return cls(Window.of(*train), Window.of(*validation), Window.of(*test), gap_days)

    def check_gap(self) -> None:
        """whole days between train.end and validation.start must be >= gap_days."""
        actual = (self.validation.start - self.train.end).days
        if actual < self.gap_days:
            raise ValueError(f"validation begins {actual} whole days after train ends, {self.gap_days} are required")


@dataclass(frozen=True)
class LabelConfig:
    maturity_days: int
    as_of: dt.datetime

    @classmethod
    def of(cls, maturity_days, as_of) -> "LabelConfig":
        return cls(int(maturity_days), _ts(as_of))


@dataclass(frozen=True)
class SliceConfig:
    column: str
    tolerance: float


@dataclass(frozen=True)
class EvalConfig:
    cost_of_miss: float
    cost_of_review: float
    target_fpr: float
    alert_budget_fraction: float
    slices: tuple[SliceConfig, ...] = ()
    min_pr_auc: float = 0.0
    max_pr_auc_regression: float = 0.0


@dataclass(frozen=True)
class DriftConfig:
    psi_threshold: float = 0.2  # a column drifts above this PSI
    dataset_share: float = 0.5  # the dataset drifts once this share of columns drift
    n_bins: int = 10
    share_floor: float = 1e-4
    min_current: int = 500
    window_days: int = 7


@dataclass(frozen=True)
class PerformanceConfig:
    window_days: int = 30
    delay_days: int = 7
    min_labeled: int = 500
    min_positives: int = 25
    max_roc_auc_drop: float = 0.05


@dataclass(frozen=True)
class DomainConfig:
    name: str
    entity_key: str
    target: str
    split: SplitConfig
    label: LabelConfig
    evaluation: EvalConfig
    anchor: Window | None = None
    # columns that never reach a model: bookkeeping and protected attributes
    not_features: frozenset[str] = frozenset()
    sentinels: dict = field(default_factory=dict)
    drift: DriftConfig = DriftConfig()
    performance: PerformanceConfig = PerformanceConfig()

    def inputs(self, columns) -> list[str]:
        """B1: the model inputs among ``columns``, in their order."""
        hidden = self.not_features | {self.entity_key, self.target, "SPLIT", "IS_MATURE"}
        return list(filter(lambda c: c not in hidden, columns))


# Fixed values of the two reference domains (split windows, maturity, costs, slices, gate).
CREDIT = DomainConfig(
    name="credit",
    entity_key="SK_ID_CURR",
    target="TARGET",
    not_features=frozenset({"APPLICATION_DATE", "CODE_GENDER"}),
    anchor=Window.of("2016-01-01", "2018-06-30"),
    split=SplitConfig.of(("2016-01-01", "2017-06-30"), ("2017-08-01", "2017-12-31"),
                         ("2018-01-01", "2018-06-30"), gap_days=30),
    label=LabelConfig.of(540, "2019-09-30"),
    evaluation=EvalConfig(cost_of_miss=10, cost_of_review=1, target_fpr=0.05,
                          alert_budget_fraction=0.10,
                          slices=(SliceConfig("CODE_GENDER", 0.05),
                                  SliceConfig("NAME_EDUCATION_TYPE", 0.05)),
                          min_pr_auc=0.15, max_pr_auc_regression=0.005),
    sentinels={
        "application_train": {"DAYS_EMPLOYED": 365243},
        "previous_application": {
            "DAYS_FIRST_DRAWING": 365243, "DAYS_FIRST_DUE": 365243,
            "DAYS_LAST_DUE_1ST_VERSION": 365243, "DAYS_LAST_DUE": 365243,
            "DAYS_TERMINATION": 365243,
        },
    },
)

FRAUD = DomainConfig(
    name="fraud",
    entity_key="trans_num",
    target="TARGET",
    not_features=frozenset({"trans_date_trans_time"}),
    split=SplitConfig.of(("2019-01-01", "2020-02-29"), ("2020-03-14", "2020-06-30"),
                         ("2020-07-01", "2020-12-31"), gap_days=14),
    label=LabelConfig.of(7, "2021-01-01"),
    evaluation=EvalConfig(cost_of_miss=50, cost_of_review=1, target_fpr=0.01,
                          alert_budget_fraction=0.01,
                          slices=(SliceConfig("category", 0.05),),
                          min_pr_auc=0.20, max_pr_auc_regression=0.005),
)
