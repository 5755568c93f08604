"""Scores of 0/1 outcomes against probabilities or decisions, for any number of groups at once.

Every function takes rows of ``(y, p)`` and optional ``by`` columns (model, fold, ...) and returns one
row per group, bin or grid point. Sweeps and curves never revisit the rows: rows are counted into
grid cells once, and the curve is a running sum over at most one row per grid point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from dayrisk.functions.scalars import clip, even_grid, grid_index
from dayrisk.operators.order_stats import ROWS_PER_RANGE, exact_quantiles, first_best, running_sums

COUNTS = ("tp", "fp", "fn", "tn")


def confusion_counts(y: Column, decided: Column) -> list[Column]:
    yes, said = y == 1, decided == 1
    cells = {"tp": yes & said, "fp": ~yes & said, "fn": yes & ~said, "tn": ~yes & ~said}
    return [F.count_if(cells[c]).alias(c) for c in COUNTS]


def contingency(df: DataFrame, y: str = "y", decided: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*confusion_counts(F.col(y), F.col(decided)))


def _ratio(top: Column, bottom: Column) -> Column:
    """Quotient, 0 where the denominator is 0."""
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def tss(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """True skill statistic: hit rate minus false-alarm rate, each 0 when its class is absent."""
    return _ratio(tp, tp + fn) - _ratio(fp, fp + tn)


def hss(tp: Column, fp: Column, fn: Column, tn: Column) -> Column:
    """Heidke skill score; 0 when its denominator is 0. Products are taken as doubles (no overflow)."""
    tp, fp, fn, tn = (c.cast("double") for c in (tp, fp, fn, tn))
    bottom = (tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)
    return _ratio(2.0 * (tp * tn - fp * fn), bottom)


SKILLS = {"tss": tss, "hss": hss}


def skill_columns() -> list[Column]:
    cells = [F.col(c) for c in COUNTS]
    return [tss(*cells).alias("tss"), hss(*cells).alias("hss")]


def skill_scores(df: DataFrame, y: str = "y", decided: str = "yhat", by: Sequence[str] = ()) -> DataFrame:
    return contingency(df, y, decided, by).select(*by, *COUNTS, *skill_columns())


def operating_points(
    df: DataFrame, points: dict[str, float | None], y: str = "y", p: str = "p", by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, recall, precision, skill and alerts per named threshold; ``None`` never alerts."""
    decided = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("point"),
                    (F.lit(0) if t is None else (F.col(p) >= F.lit(t)).cast("int")).alias("yhat"),
                )
                for name, t in points.items()
            ]
        )
    )
    counts = contingency(df.select(*by, y, decided.alias("d")).select(*by, y, "d.*"), y, "yhat", [*by, "point"])
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    return counts.select(
        *by,
        "point",
        _ratio(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(tp, tp + fp).alias("precision"),
        tss(tp, fp, fn, tn).alias("tss"),
        (tp + fp).alias("alerts"),
    )


def brier(y: Column, p: Column) -> Column:
    return F.avg((p - y) * (p - y))


def log_loss(y: Column, p: Column) -> Column:
    """Mean negative log probability of the outcome, which is kept within [1e-9, 1]."""
    of_truth = F.when(y == 1, p).otherwise(1.0 - p)
    return F.avg(-F.log(clip(of_truth, 1e-9, 1.0)))


def null_log_loss(y: Column) -> Column:
    """Entropy of the base rate; null when only one class is present."""
    rate = F.avg(y.cast("double"))
    inner = F.when((rate > 0) & (rate < 1), rate)
    return -(inner * F.log(inner) + (1.0 - inner) * F.log(1.0 - inner))


def _expand_bins(cells: DataFrame, by: Sequence[str], index: str, values: Sequence[str], points: int) -> DataFrame:
    """One row per grid point and group from at most ``points`` cells per group; empty cells hold 0."""
    entry = F.struct(F.col(index), F.struct(*values))
    packed = cells.groupBy(*by).agg(F.map_from_entries(F.collect_list(entry)).alias("_cells"))
    spread = packed.select(*by, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias(index), "_cells")
    cell = F.try_element_at("_cells", F.col(index))
    return spread.select(
        *by, index, *[F.coalesce(cell[v], F.lit(0)).alias(v) for v in values]
    )


def reliability_bins(
    df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10, by: Sequence[str] = ()
) -> DataFrame:
    """Mean prediction, positive share and count per equal-width bin; empty bins give zeros.

    Bins are closed on the left, the last on both sides; probabilities are clipped to [0, 1].
    """
    edges = even_grid(0.0, 1.0, n_bins + 1)
    held = df.where(F.col(p).isNotNull()).select(*by, F.col(y).cast("double").alias("_y"), clip(F.col(p), 0.0, 1.0).alias("_p"))
    cells = (
        held.groupBy(*by, F.least(grid_index(F.col("_p"), edges), F.lit(n_bins - 1)).alias("bin"))
        .agg(
            F.avg("_p").alias("mean_predicted"),
            F.avg("_y").alias("fraction_positive"),
            F.count(F.lit(1)).alias("count"),
        )
    )
    full = _expand_bins(cells, by, "bin", ["mean_predicted", "fraction_positive", "count"], n_bins)
    low, high = (F.get(F.array(*[F.lit(e) for e in edges]), F.col("bin") + i) for i in (0, 1))
    return full.select(
        *by,
        "bin",
        low.alias("edge_low"),
        high.alias("edge_high"),
        (0.5 * (low + high)).alias("centre"),
        "mean_predicted",
        "fraction_positive",
        "count",
    )


def reliability_curve(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """The points of a reliability diagram: the bins that hold rows."""
    bins = reliability_bins(df, y, p, n_bins, by)
    return bins.where("count > 0").select(*by, "bin", "mean_predicted", "fraction_positive", "count")


def calibration_error(df: DataFrame, y: str = "y", p: str = "p", n_bins: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Expected calibration error: count-weighted mean gap of the bins, 0 without rows."""
    gap = F.abs(F.col("mean_predicted") - F.col("fraction_positive"))
    bins = reliability_bins(df, y, p, n_bins, by)
    total = F.sum("count")
    share = F.when(total > 0, F.sum(F.col("count") * gap) / F.nullif(total, F.lit(0)))
    return bins.groupBy(*by).agg(F.coalesce(share, F.lit(0.0)).alias("ece"))


def _curve(
    df: DataFrame, cell: Column, decided: Column, y: str, points: int, by: Sequence[str]
) -> DataFrame:
    """Confusion counts of the rows at or above each grid point, plus the row count of the group."""
    cells = df.groupBy(*by, cell.alias("point")).agg(*confusion_counts(F.col(y), decided))
    full = _expand_bins(cells.where("point >= 0"), by, "point", COUNTS, points)
    upwards = Window.partitionBy(*by).orderBy(F.col("point").desc())
    return full.select(*by, "point", *[F.sum(c).over(upwards).alias(c) for c in COUNTS])


def risk_coverage(
    df: DataFrame, y: str = "y", p: str = "p", score: str = "tss", n_points: int = 50, by: Sequence[str] = ()
) -> DataFrame:
    """Coverage and score of the rows with ``|p - 0.5| >= margin`` for an even grid of margins in [0, 0.5].

    The score is null unless both classes are covered.
    """
    if score not in SKILLS:
        raise KeyError(score)
    margins = even_grid(0.0, 0.5, n_points)
    held = df.where(F.col(p).isNotNull())
    cell = grid_index(F.abs(F.col(p) - F.lit(0.5)), margins)
    counts = _curve(held, cell, (F.col(p) >= F.lit(0.5)).cast("int"), y, n_points, by)
    tp, fp, fn, tn = (F.col(c) for c in COUNTS)
    covered = tp + fp + fn + tn
    # margin 0 keeps every row, so the largest count is the size of the group
    everyone = F.max(covered).over(Window.partitionBy(*by))
    both = (tp + fn > 0) & (fp + tn > 0)
    return counts.select(
        *by,
        "point",
        F.get(F.array(*[F.lit(m) for m in margins]), F.col("point")).alias("margin"),
        (covered / F.nullif(everyone, F.lit(0))).alias("coverage"),
        F.when(both, SKILLS[score](tp, fp, fn, tn)).alias("score"),
    )


def select_margin(curve: DataFrame, min_coverage: float = 0.5) -> DataFrame:
    """The margin with the best score among those covering enough, smallest margin on ties."""
    eligible = curve.where((F.col("coverage") >= F.lit(min_coverage)) & F.col("score").isNotNull())
    return first_best(eligible, "score", F.col("margin"))


def threshold_sweep(
    df: DataFrame, y: str = "y", p: str = "p", thresholds: Sequence[float] | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """True skill statistic when alerting at ``p >= threshold``, for ascending thresholds (an even grid by default)."""
    held = df.where(F.col(p).isNotNull())
    if thresholds is None:
        grid = even_grid(0.05, 0.95, 91)
        cell = F.greatest(grid_index(F.col(p), grid), F.lit(-1)) + 1  # cell 0: below every threshold
    else:
        grid = sorted(set(thresholds))
        # a binary search; NaN is above all
        placed = Bucketizer(splits=[float("-inf"), *map(float, grid), float("inf")], inputCol="_p", outputCol="_cell", handleInvalid="keep")
        held = placed.transform(held.withColumn("_p", F.col(p).cast("double")))
        cell = F.least(F.col("_cell").cast("int"), F.lit(len(grid)))
    cells = held.groupBy(*by, cell.alias("point")).agg(
        F.count_if(F.col(y) == 1).alias("pos"), F.count_if(F.col(y) != 1).alias("neg")
    )
    full = _expand_bins(cells, by, "point", ["pos", "neg"], len(grid) + 1)
    upwards = Window.partitionBy(*by).orderBy(F.col("point").desc())
    group = Window.partitionBy(*by)
    alerts = full.select(
        *by,
        "point",
        F.sum("pos").over(upwards).alias("tp"),
        F.sum("neg").over(upwards).alias("fp"),
        F.sum("pos").over(group).alias("_pos"),
        F.sum("neg").over(group).alias("_neg"),
    ).where("point > 0")
    return alerts.select(
        *by,
        F.get(F.array(*[F.lit(g) for g in grid]), F.col("point") - 1).alias("threshold"),
        tss(F.col("tp"), F.col("fp"), F.col("_pos") - F.col("tp"), F.col("_neg") - F.col("fp")).alias("tss"),
    )


def best_threshold(sweep: DataFrame) -> DataFrame:
    return first_best(sweep, "tss", F.col("threshold"))


def ranking_scores(
    df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """ROC-AUC (rank form, ties count half) and average precision; null when a class is absent.

    Rows are first reduced to one per distinct score, then counted from the highest score down.
    """
    scores = (
        df.where(F.col(p).isNotNull())
        .groupBy(*by, F.col(p).alias("_s"))
        .agg(
            F.count_if(F.col(y) == 1).cast("double").alias("pos"),
            F.count_if(F.col(y) != 1).cast("double").alias("neg"),
        )
    )
    summed = running_sums(scores, "_s", ["pos", "neg"], by, descending=True, rows_per_range=rows_per_range)
    pos, above = F.col("pos"), F.col("cum_pos") - F.col("pos")
    pairs = F.sum(F.col("neg") * (above + pos / 2))
    step = F.sum(pos * F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg")))
    n_pos, n_neg = F.max("all_pos"), F.max("all_neg")
    return summed.groupBy(*by).agg(
        F.when((n_pos > 0) & (n_neg > 0), pairs / F.nullif(n_pos * n_neg, F.lit(0.0))).alias("roc_auc"),
        F.when(n_pos > 0, step / F.nullif(n_pos, F.lit(0.0))).alias("average_precision"),
    )


def regression_scores(df: DataFrame, y: str = "y", predicted: str = "predicted", by: Sequence[str] = ()) -> DataFrame:
    """Coefficient of determination and mean absolute error in one pass."""
    error = F.col(y) - F.col(predicted)
    spread = F.var_pop(F.col(y)) * F.count(y)
    return df.groupBy(*by).agg(
        (1.0 - F.sum(error * error) / F.nullif(spread, F.lit(0.0))).alias("r2"),
        F.avg(F.abs(error)).alias("mae"),
    )


def conformal_quantile(df: DataFrame, y: str = "y", p: str = "p", alpha: float = 0.1) -> DataFrame:
    """Upper quantile of the nonconformity ``1 - p_true``: ``(feature, n, value)`` with one row."""
    miss = F.when(F.col(y) == 1, 1.0 - F.col(p)).otherwise(F.col(p))
    return exact_quantiles(df.select(miss.alias("nonconformity")), ["nonconformity"], 1.0 - alpha, "higher")


def evaluate(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = ("model",), n_bins: int = 10) -> DataFrame:
    """The full metric row per group: skill at 0.5, ranking, Brier and calibration error."""
    by = list(by)
    at_half = (F.col(p) >= F.lit(0.5)).cast("int")
    base = df.groupBy(*by).agg(
        *confusion_counts(F.col(y), at_half),
        brier(F.col(y), F.col(p)).alias("brier"),
        F.avg(F.col(y).cast("double")).alias("base_rate"),
    )
    base = base.select(*by, *skill_columns(), "brier", "base_rate")
    for more in (ranking_scores(df, y, p, by), calibration_error(df, y, p, n_bins, by)):
        base = _with_group(base, more, by)
    return base.select(*by, "tss", "hss", "roc_auc", "average_precision", "brier", "ece", "base_rate")


def _with_group(base: DataFrame, more: DataFrame, by: list[str]) -> DataFrame:
    """Columns of ``more`` beside the rows of ``base``; null groups match, and a group without a row in ``more`` stays."""
    renamed = more.select(*[F.col(b).alias(f"_of_{b}") for b in by], *[c for c in more.columns if c not in by])
    match = F.lit(True)
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_of_{b}"))
    return base.join(renamed, match, "left").drop(*[f"_of_{b}" for b in by])


def long_scores(df: DataFrame, scores: dict[str, str], keep: Sequence[str] = ("y",), name: str = "model") -> DataFrame:
    """Wide score columns to ``(keep..., name, p)``, so that all models are scored in one job."""
    entries = F.array(*[F.struct(F.lit(n).alias(name), F.col(c).cast("double").alias("p")) for n, c in scores.items()])
    return df.select(*keep, F.explode(entries).alias("_e")).select(*keep, f"_e.{name}", "_e.p")
