"""Model comparison, ablation and the locked test on a scaled panel ``(date, fold, target, features)``."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from dayrisk.constants import SEED
from dayrisk.operators.calibration import conformal_clip, isotonic_fit, isotonic_predict, platt_fit, platt_predict
from dayrisk.operators.classifiers import Fitted, fit_members
from dayrisk.operators.clusters import rate_spread, silhouette_squared
from dayrisk.operators.columns import interaction_names, interactions
from dayrisk.operators.folds import expanding_folds, holdout_cut
from dayrisk.operators.linear import fit_elastic_net, fit_lasso, fit_ols, fit_ridge
from dayrisk.operators.metrics import (
    best_threshold, conformal_quantile, evaluate, long_scores, operating_points, ranking_scores, regression_scores,
    risk_coverage, select_margin, threshold_sweep,
)
from dayrisk.operators.order_stats import first_best
from dayrisk.operators.ransac import fit_ransac
from dayrisk.plans.baselines import climatology, persistence
from dayrisk.plans.panel import feature_groups
from dayrisk.session import settled, side_by_side

Fit = Callable[[DataFrame, Sequence[str], str], Fitted]


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Hold a narrow intermediate while several jobs read it."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def metric_rows(scores: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """:func:`evaluate` on model scores, which are computed once and not once per metric. A row per group."""
    with kept(scores) as held:
        rows = evaluate(held, by=by)
        return scores.sparkSession.createDataFrame(rows.collect(), rows.schema)


def in_fold(panel: DataFrame, name: str) -> DataFrame:
    return panel.where(F.col("fold") == name)


def _cross_validated(rows: DataFrame, models: Mapping[str, Sequence[Fitted]], y: str) -> dict[str, float]:
    """Mean ROC-AUC of each model over the folds ``test_fold`` = 1, 2 ... of ``rows``; model ``k`` is tested on fold ``k + 1``.

    A fold whose test stretch has one class only has no AUC and is an error, as it would be undefined.
    """
    parts = [
        model.score(rows.where(F.col("test_fold") == k)).select(F.lit(name).alias("model"), "test_fold", F.col(y).alias("y"), "p")
        for name, fold_models in models.items() for k, model in enumerate(fold_models, 1)
    ]
    scored = settled(reduce(DataFrame.unionByName, parts))
    found: dict[str, list] = {name: [] for name in models}
    for r in ranking_scores(scored, by=["model", "test_fold"]).collect():
        found[r["model"]].append(r["roc_auc"])
    if any(len(aucs) < len(models[name]) or None in aucs for name, aucs in found.items()):
        raise ValueError("a test fold holds one class only")
    return {name: sum(aucs) / len(aucs) for name, aucs in found.items()}


def cross_validated_auc(train: DataFrame, features: Sequence[str], fit: Fit, splits: int = 5, y: str = "target") -> float:
    """Mean ROC-AUC over expanding time folds; weights are recomputed in every fold. The folds' models are fitted together."""
    rows = settled(expanding_folds(train, splits))
    models = fit_members(fit, rows, features, y, [F.col("test_fold") < k for k in range(1, splits + 1)])
    return _cross_validated(rows, {"model": models}, y)["model"]


def compare_models(
    panel: DataFrame, features: Sequence[str], fits: Mapping[str, Fit], score_on: str = "val", cv: bool = True, y: str = "target", splits: int = 5
) -> DataFrame:
    """One row per model: cross-validated AUC and scores on a later fold.

    Of each kind the model on all of train and those of the folds are fitted together; all scores are evaluated together.
    """
    rows, later = in_fold(panel, "train"), in_fold(panel, score_on)
    members = [F.lit(True)]
    if cv:
        rows = expanding_folds(rows, splits)
        members += [F.col("test_fold") < k for k in range(1, splits + 1)]
    rows = settled(rows)
    models = dict(zip(fits, side_by_side(lambda fit: fit_members(fit, rows, features, y, members), fits.values(), 3)))
    parts = [own[0].score(later).select(F.lit(name).alias("model"), F.col(y).alias("y"), "p") for name, own in models.items()]
    aucs = _cross_validated(rows, {name: own[1:] for name, own in models.items()}, y) if cv else dict.fromkeys(fits)
    placed = [(name, aucs[name], place) for place, name in enumerate(fits)]
    validated = panel.sparkSession.createDataFrame(placed, "model string, cv_roc_auc double, place int")
    return metric_rows(reduce(DataFrame.unionByName, parts)).join(F.broadcast(validated), "model")  # one row per model


def select_model(comparison: DataFrame, digits: int = 3) -> str:
    """Name of the model with the best rounded skill; of equals, the first in the order given (``place``), else by name."""
    place = F.col("place") if "place" in comparison.columns else F.lit(0)
    ranked = comparison.select("model", F.round("tss", digits).alias("tss"), place.alias("place"))
    return first_best(ranked, "tss", F.col("place"), F.col("model")).first()["model"]


def ablation_sets(columns: Sequence[str]) -> dict[str, list[str]]:
    """Nested feature sets, one family added at a time."""
    families = feature_groups(columns)
    steps = [("lag", "lag"), ("lag, roll", "roll"), ("lag, roll, phase", "phase"), ("base features", "season"), ("base and coupling", "coupling")]
    out, so_far = {}, []
    for title, family in steps:
        so_far = so_far + families[family]
        out[title] = list(so_far)
    return out


def ablation(panel: DataFrame, sets: Mapping[str, Sequence[str]], fit: Fit, y: str = "target") -> DataFrame:
    """The same model on nested feature sets; rows stay fixed. Models that can grow on several sets at once do."""
    train, later = settled(in_fold(panel, "train")), in_fold(panel, "val")
    together = getattr(fit, "of_sets", None)
    models = together(train, list(sets.values()), y) if together else side_by_side(lambda columns: fit(train, columns, y), sets.values())
    parts = [
        model.score(later).select(F.lit(name).alias("feature_set"), F.lit(len(columns)).cast("bigint").alias("n_cols"), F.col(y).alias("y"), "p")
        for (name, columns), model in zip(sets.items(), models)
    ]
    return metric_rows(reduce(DataFrame.unionByName, parts), by=["feature_set", "n_cols"]).select("feature_set", "n_cols", "roc_auc", "tss")


def regressor_table(
    panel: DataFrame, features: Sequence[str], y: str = "y", key: str = "date", ransac_threshold: float = 20.0
) -> DataFrame:
    """Six regressors fitted on train and scored on val; a fit that fails fails the query."""
    rows = panel.where(F.col(y).isNotNull()).select(key, "fold", y, *features)
    train, val = in_fold(rows, "train"), in_fold(rows, "val")
    products = interaction_names(features)
    crossed = interactions(rows, list(features), keep=[key, "fold", y])
    day = train.withColumn("_key", F.xxhash64(key))
    jobs = {
        "OLS": lambda: fit_ols(train, features, y),
        "Ridge": lambda: fit_ridge(train, features, y, 1.0),
        "Lasso": lambda: fit_lasso(train, features, y, 0.1),
        "ElasticNet": lambda: fit_elastic_net(train, features, y, 0.1, 0.5),
        "Poly(2)+Ridge": lambda: fit_ridge(in_fold(crossed, "train"), products, y, 10.0),
        "RANSAC": lambda: fit_ransac(day, features, "_key", y, threshold=ransac_threshold, trials=200, seed=SEED),
    }
    fits = dict(zip(jobs, side_by_side(lambda job: job(), jobs.values())))
    wide = in_fold(crossed, "val").select(y, *[f.score().alias(f"m{i}") for i, f in enumerate(fits.values())])
    long = long_scores(wide, {name: f"m{i}" for i, name in enumerate(fits)}, keep=[y])
    return regression_scores(long, y, "p", by=["model"])


def headline_model(panel: DataFrame, features: Sequence[str], fits: Mapping[str, Fit], y: str = "target", digits: int = 3) -> str:
    """Name of the model that the validation fold selects: every candidate fitted on train, the best rounded skill wins."""
    return select_model(compare_models(panel, features, fits, cv=False, y=y), digits)


def validation_table(
    panel: DataFrame, labels: DataFrame, features: Sequence[str], fit: Fit, label: str = "any_environmental", y: str = "target", keys: Sequence[str] = ()
) -> DataFrame:
    """Persistence, climatology and a model, fitted on train, on the validation fold."""
    return forecast_table(panel, labels, fit(in_fold(panel, "train"), features, y).score(in_fold(panel, "val")), "val", label, y, keys)


def forecast_table(
    panel: DataFrame, labels: DataFrame, scored: DataFrame, fold: str, label: str = "any_environmental", y: str = "target", keys: Sequence[str] = ()
) -> DataFrame:
    """Persistence, climatology and the scores of a model on one fold.

    A constant forecast has no skill by definition; persistence, being 0 or 1, gets no ranking scores.
    """
    rows = in_fold(panel, fold).select(*keys, "date", F.col(y).alias("y"))
    same = persistence(rows, labels, label, keys).select("y", F.col("predicted").cast("double").alias("p"))
    flat = climatology(rows, in_fold(panel, "train"), y).select("y", "p")
    parts = {"persistence": same, "climatology": flat, "model": scored.select(F.col(y if y in scored.columns else "y").alias("y"), "p")}
    table = metric_rows(reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("model"), "y", "p") for name, df in parts.items()]))
    is_same, is_flat = F.col("model") == "persistence", F.col("model") == "climatology"
    return table.select(
        "model",
        *[F.when(is_flat, F.lit(0.0)).otherwise(F.col(c)).alias(c) for c in ("tss", "hss")],
        F.when(is_flat, F.lit(0.5)).when(~is_same, F.col("roc_auc")).alias("roc_auc"),
        F.when(is_flat, F.col("base_rate")).when(~is_same, F.col("average_precision")).alias("average_precision"),
        "brier",
        "ece",
    )


def cluster_table(rows: DataFrame, axes: Sequence[str], methods: Mapping[str, Callable[[DataFrame], DataFrame]], y: str = "target") -> DataFrame:
    """``(method, n_clusters, silhouette, pos_rate_spread)``: clusterings of the same projected rows, side by side.

    ``methods`` add a column ``cluster``. The silhouette is the one-pass form with squared distances, noise being a cluster; it is null with fewer
    than two others.
    """
    rows = settled(rows)

    def one(item: tuple[str, Callable]):
        name, method = item
        found = settled(method(rows).select(*axes, y, "cluster"))
        clusters = found.agg(F.count_distinct(F.when(F.col("cluster") >= 0, F.col("cluster")))).first()[0]
        silhouette = silhouette_squared(found, axes) if clusters > 1 else None
        return name, clusters, silhouette, rate_spread(found, y).first()[0]

    found = side_by_side(one, methods.items(), 3)
    return rows.sparkSession.createDataFrame(found, "method string, n_clusters bigint, silhouette double, pos_rate_spread double")  # one row per method


def calibrations(panel: DataFrame, features: Sequence[str], fit: Fit, alpha: float = 0.1, y: str = "target") -> DataFrame:
    """Validation scores ``(model, y, p)`` of the raw model and of three recalibrations.

    The model sees the first four fifths of train, the calibrators the last fifth.
    """
    parts = holdout_cut(in_fold(panel, "train"))
    model = fit(parts.where("part = 'fit'"), features, y)
    held = model.score(parts.where("part = 'calibrate'")).select(F.col(y).alias("y"), "p").persist()
    try:
        slope, intercept = platt_fit(held)
        curve = isotonic_fit(held)
        q = conformal_quantile(held, alpha=alpha).first()["value"]
    finally:
        held.unpersist()
    later = model.score(in_fold(panel, "val")).select(F.col(y).alias("y"), F.col("p").alias("raw"))
    wide = isotonic_predict(later, curve, "raw", "isotonic").withColumns(
        {"platt": platt_predict(F.col("raw"), slope, intercept), "conformal": conformal_clip(F.col("raw"), q)}
    )
    return long_scores(wide, {n: n for n in ("raw", "platt", "isotonic", "conformal")})


def calibration_table(scores: DataFrame) -> DataFrame:
    return metric_rows(scores).select("model", "brier", "ece", "roc_auc")


class LockedTest:
    """Fit on four fifths of train, calibrate on the rest, tune on val, report once on test.

    ``keys`` are the series columns of ``panel`` and ``labels``, if there are several series.
    """

    def __init__(
        self, panel: DataFrame, labels: DataFrame, features: Sequence[str], fit: Fit, label: str = "any_environmental", y: str = "target",
        keys: Sequence[str] = (),
    ):
        self.panel, self.labels, self.features, self.label, self.y, self.keys = panel, labels, list(features), label, y, list(keys)
        self._scored: dict[str, DataFrame] = {}
        parts = settled(holdout_cut(in_fold(panel, "train")))
        self.model = fit(parts.where("part = 'fit'"), self.features, y)
        self.curve = isotonic_fit(self.model.score(parts.where("part = 'calibrate'")).select(F.col(y).alias("y"), "p"))

    @classmethod
    def of_best(cls, panel: DataFrame, labels: DataFrame, features: Sequence[str], fits: Mapping[str, Fit], y: str = "target", **options) -> LockedTest:
        """The whole chain: the validation fold selects one of ``fits``, which is fitted anew, calibrated, tuned and tested."""
        return cls(panel, labels, features, fits[headline_model(panel, features, fits, y)], y=y, **options)

    def scores(self, fold: str) -> DataFrame:
        """``(keys..., date, y, p)`` with calibrated p, computed once for all figures."""
        if fold not in self._scored:
            raw = settled(self.model.score(in_fold(self.panel, fold)).select(*self.keys, "date", F.col(self.y).alias("y"), F.col("p").alias("_raw")))
            self._scored[fold] = settled(isotonic_predict(raw, self.curve, "_raw", "p").select(*self.keys, "date", "y", "p"))
        return self._scored[fold]

    def threshold(self) -> float:
        return best_threshold(threshold_sweep(self.scores("val"))).first()["threshold"]

    def report(self) -> DataFrame:
        """Persistence, climatology and the model on the test fold."""
        return forecast_table(self.panel, self.labels, self.scores("test"), "test", self.label, self.y, self.keys)

    def operating_points(self) -> DataFrame:
        return operating_points(self.scores("test"), {"threshold 0.5": 0.5, "tuned": self.threshold(), "always no": None})

    def curve_points(self, score: str = "tss") -> DataFrame:
        return risk_coverage(self.scores("test"), score=score)

    def margin(self, min_coverage: float = 0.5) -> float:
        return select_margin(self.curve_points(), min_coverage).first()["margin"]


def slice_rerun(panel: DataFrame, features: Sequence[str], fit: Fit, y: str = "target") -> DataFrame:
    """Uncalibrated re-run of the protocol on a panel whose label comes from a slice of the events."""
    model = fit(in_fold(panel, "train"), features, y)
    scored = model.score(in_fold(panel, "test")).select(F.lit("slice").alias("model"), F.col(y).alias("y"), "p")
    positives = scored.groupBy("model").agg(F.sum("y").cast("bigint").alias("test_positives"))
    return metric_rows(scored).join(positives, "model").select("model", "test_positives", "base_rate", "roc_auc", "tss")
