"""Frozen run configuration, passed explicitly (no global mutable state)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values that must equal the reference's behaviour.
# Seasonal period by resample frequency (fallback 12):
#   W 52, ME 12, QE 4, YE 1, D 5, M 12, Q 4, Y 1
SEASONAL_PERIODS = {"W": 52, "ME": 12, "QE": 4, "YE": 1, "D": 5, "M": 12, "Q": 4, "Y": 1}
DEFAULT_PERIOD = 12
# Mean length of one period in days, by resample frequency.
STEP_DAYS = {"W": 7.0, "D": 1.0, "h": 1 / 24, "ME": 365.25 / 12, "QE": 365.25 / 4, "YE": 365.25,
             "M": 365.25 / 12, "Q": 365.25 / 4, "Y": 365.25}
# Market event windows used to label dates (start, end, label), inclusive.
EVENT_WINDOWS = (
    ("2020-03-01", "2020-05-01", "COVID-19 Crash"),
    ("2022-02-01", "2022-04-01", "War in Ukraine"),
    ("2022-10-01", "2022-11-01", "Brazil Election"),
)
# Severity labels of batch outliers, in bin order.
SEVERITY_LABELS = ("extreme_low", "low", "normal", "high", "extreme_high")


def _positive(name: str, value):
    if value is not None and value <= 0:
        raise ValueError(f"{name} must be positive or None for the default, got {value!r}")
    return value


@dataclass(frozen=True)
class PanelConfig:
    freq: str = "W"                 # W, D, h, ME, QE, YE
    period: int | None = None       # seasonal period override
    horizon: int = 12               # forecast steps
    test_size: float = 0.2          # hold-out share
    cv_folds: int = 5               # expanding-window folds
    anomaly_multiplier: float = 1.5  # IQR fence multiplier
    ffill_limit: int = 2            # forward fill at most this many periods
    start_date: str | None = None   # inclusive range filter on ts
    end_date: str | None = None
    entities: tuple[str, ...] = field(default_factory=tuple)
    lookback: int = 12              # lag window of the nonlinear model
    broadcast_max_rows: int = 1_000_000  # size bound for explicit broadcast

    def __post_init__(self):
        _positive("period", self.period)
        _positive("horizon", self.horizon)
        _positive("cv_folds", self.cv_folds)
        _positive("lookback", self.lookback)
        _positive("anomaly_multiplier", self.anomaly_multiplier)
        if not 0 < self.test_size < 1:
            raise ValueError("test_size must be in (0, 1)")
        if self.freq not in ("W", "D", "h", "ME", "QE", "YE", "M", "Q", "Y"):
            raise ValueError(f"unsupported frequency {self.freq!r}")

    @property
    def seasonal_period(self) -> int:
        if self.period is not None:
            return self.period
        return SEASONAL_PERIODS.get(self.freq, DEFAULT_PERIOD)

    @property
    def step_days(self) -> float:
        return STEP_DAYS[self.freq]

    @property
    def rolling_window(self) -> int:
        return 4 if self.freq == "W" else 3

    def with_(self, **kw) -> "PanelConfig":
        return replace(self, **kw)
