"""The daily feature panel and its train-only imputation and scaling."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from dayrisk.constants import DRIVERS, LAG_HOURS, PHASES, ROLL_HOURS
from dayrisk.functions.scalars import motional_field, positive_part, season_columns, southward
from dayrisk.operators.daily import to_daily
from dayrisk.operators.labels import next_label
from dayrisk.operators.order_stats import bracket_columns, bracket_row, select_ranks
from dayrisk.operators.windows import BLOCK, hourly_features

PARAMS_SCHEMA = "feature string, pos int, median double, mean double, std double"


@dataclass(frozen=True)
class PanelConfig:
    """What to build: drivers, windows, label and lead time, series keys and block size."""

    drivers: Sequence[str] = DRIVERS
    lags: Sequence[int] = LAG_HOURS
    rolls: Sequence[int] = ROLL_HOURS
    label: str = "any_environmental"
    horizon_days: int = 1
    include_coupling: bool = False
    keys: Sequence[str] = ()
    ts: str = "ts"
    storm_driver: str = "Dst"
    block_days: int = 366
    step_seconds: int = 3600
    gap_mode: str = "rows"


def coupling_statistics(columns: Sequence[str], pressure_change: str = "flow_pressure_change") -> dict[str, Column]:
    """Daily aggregates of the coupling physics, each pair only if its columns are there."""
    out: dict[str, Column] = {}
    if "Bz_gsm" in columns and "flow_speed" in columns:
        field_now = motional_field(F.col("Bz_gsm"), F.col("flow_speed"))
        out["coupling_Ey_mean"] = F.avg(field_now)
        out["coupling_Ey_max"] = F.max(field_now)
        out["frac_southward"] = F.avg(southward(F.col("Bz_gsm")))
    if "flow_pressure" in columns:
        out["pdyn_shock"] = F.max(positive_part(F.col(pressure_change)))
    return out


def coupling_features(
    hourly: DataFrame, keys: Sequence[str] = (), ts: str = "ts", block_days: int = 366
) -> DataFrame:
    """Coupling features alone, per day."""
    carry = [c for c in ("Bz_gsm", "flow_speed", "flow_pressure") if c in hourly.columns]
    rows = hourly_features(
        hourly, (), (1,), (), keys, ts, None, ["flow_pressure"], carry, block_days
    )
    return to_daily(rows, coupling_statistics(carry), keys, ts, [BLOCK])


def daily_features(hourly: DataFrame, config: PanelConfig = PanelConfig()) -> DataFrame:
    """Unscaled daily features: one windowed projection, one aggregation, gaps filled with nulls.

    Windows and aggregation share one shuffle by (series, time block); phases, coupling and lags are
    columns of the same rows, so nothing is joined.
    """
    carry: list[str] = []
    changes: list[str] = []
    if config.include_coupling:
        carry = [c for c in ("Bz_gsm", "flow_speed", "flow_pressure") if c in hourly.columns]
        changes = [c for c in ("flow_pressure",) if c in hourly.columns]
    rows = hourly_features(
        hourly, config.drivers, config.lags, config.rolls, config.keys, config.ts,
        config.storm_driver, changes, carry, config.block_days, config.step_seconds, config.gap_mode,
    )
    own = {*config.keys, config.ts, BLOCK, *carry, *(f"{c}_change" for c in changes)}
    statistics = {
        c: F.expr(f"CAST(max(`{c}`) AS DOUBLE)" if c in PHASES else f"avg(`{c}`)") for c in rows.columns if c not in own
    }
    statistics.update(coupling_statistics(carry))
    daily = to_daily(rows, statistics, config.keys, config.ts, [BLOCK])
    names = list(statistics)
    base = [c for c in names if c not in _COUPLING]
    coupled = [c for c in names if c in _COUPLING]
    return daily.select(*config.keys, "date", *base, *coupled, *season_columns(F.col("date")))


_COUPLING = ("coupling_Ey_mean", "coupling_Ey_max", "frac_southward", "pdyn_shock")


def feature_names(columns: Sequence[str], config: PanelConfig = PanelConfig()) -> list[str]:
    other = {*config.keys, "date", "target", "fold"}
    return [c for c in columns if c not in other]


def feature_groups(columns: Sequence[str]) -> dict[str, list[str]]:
    """Feature families by name."""
    return {
        "lag": [c for c in columns if "_lag" in c],
        "roll": [c for c in columns if "_rmean" in c or "_rstd" in c],
        "phase": [c for c in columns if c.startswith("phase_")],
        "season": [c for c in columns if c.startswith("doy_")],
        "coupling": [c for c in columns if c in _COUPLING],
    }


def align_target(daily: DataFrame, labels: DataFrame, config: PanelConfig = PanelConfig()) -> DataFrame:
    """Features of day T with the label ``horizon_days`` rows later; rows without one are dropped.

    The label is shifted along the whole label calendar, so callers cut folds afterwards.
    """
    ahead = next_label(labels, config.label, config.horizon_days, config.keys)
    return daily.join(ahead, [*config.keys, "date"]).where(F.col("target").isNotNull())


@dataclass
class FittedPanel:
    """Medians, means and deviations of the training rows, one entry per feature in order."""

    params: list[tuple[str, int, float, float, float]] = field(default_factory=list)

    @property
    def features(self) -> list[str]:
        return [p[0] for p in self.params]

    def to_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.params, PARAMS_SCHEMA)

    @classmethod
    def from_frame(cls, params: DataFrame) -> FittedPanel:
        return cls([tuple(r) for r in params.select("feature", "pos", "median", "mean", "std").orderBy("pos").collect()])

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Impute and scale in one projection; a missing feature column is an error."""
        if not self.params:
            raise RuntimeError("transform before fit")
        missing = [f for f in self.features if f not in df.columns]
        if missing:
            raise KeyError(f"features missing from the table: {missing}")
        return df.select(
            *keep,
            *[
                F.expr(f"(coalesce(`{f}`, {med!r}D) - {mean!r}D) / {std or 1.0!r}D AS `{f}`")
                for f, _, med, mean, std in self.params
            ],
        )


def fit_panel(train: DataFrame, features: Sequence[str]) -> FittedPanel:
    """Median per feature, then mean and population deviation of the imputed column.

    One pass takes counts, moments and rank sketches of all features; a second finds the exact
    medians inside their brackets. Moments of the imputed column follow from the moments of its
    values and the number of nulls, so imputing needs no third pass.
    """
    features = list(features)
    wide = train.selectExpr(*[f"CAST(`{f}` AS DOUBLE) AS `{f}`" for f in features]).persist(
        StorageLevel.MEMORY_AND_DISK
    )
    try:
        moments = [F.expr(f"{fn}(`{f}`) AS {a}{i}") for i, f in enumerate(features) for fn, a in (("avg", "a"), ("var_pop", "v"))]
        row = wide.agg(F.count(F.lit(1)).alias("rows"), *bracket_columns(features, 0.5), *moments).first()
        empty = [f for i, f in enumerate(features) if row[f"n{i}"] == 0]
        if empty:
            raise ValueError(f"features without a value in the training rows: {empty}")
        brackets = [bracket_row(row, i) for i in range(len(features))]
        medians = {r["feature"]: r["value"] for r in select_ranks(wide, features, brackets, 0.5, "linear").collect()}
    finally:
        wide.unpersist()
    params = []
    for i, f in enumerate(features):
        n, rows, med = row[f"n{i}"], row["rows"], medians[f]
        mean = (row[f"a{i}"] * n + med * (rows - n)) / rows
        square = (n * (row[f"v{i}"] + (row[f"a{i}"] - mean) ** 2) + (rows - n) * (med - mean) ** 2) / rows
        constant = row[f"min{i}"] == row[f"max{i}"]
        params.append((f, i, float(med), float(mean), 0.0 if constant else float(square) ** 0.5))
    return FittedPanel(params)


@dataclass
class FeaturePanel:
    """Fit on the training fold, apply to any rows; folds are a column, so one build serves all."""

    config: PanelConfig = field(default_factory=PanelConfig)
    fitted: FittedPanel | None = None

    def build(self, hourly: DataFrame, labels: DataFrame) -> DataFrame:
        """Daily features with their target, all folds."""
        return align_target(daily_features(hourly, self.config), labels, self.config)

    def fit_transform(self, hourly: DataFrame, labels: DataFrame, train: Column) -> DataFrame:
        rows = self.build(hourly, labels).where(train)
        self.fitted = fit_panel(rows, feature_names(rows.columns, self.config))
        return self.fitted.transform(rows, [*self.config.keys, "date", "target"])

    def transform(self, hourly: DataFrame, labels: DataFrame, rows: Column | None = None) -> DataFrame:
        if self.fitted is None:
            raise RuntimeError("transform before fit_transform")
        panel = self.build(hourly, labels)
        panel = panel if rows is None else panel.where(rows)
        return self.fitted.transform(panel, [*self.config.keys, "date", "target"])
