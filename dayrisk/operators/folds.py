"""Chronological, expanding and stratified fold assignments from row positions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from dayrisk.operators.order_stats import date_order, row_positions


def _by_date(df: DataFrame, date: str, tie: str | None, by: list[str] | tuple = ()) -> DataFrame:
    """Positions by date, then by the hash of ``tie`` or of the whole row, so that one date is no hot range."""
    spread = F.xxhash64(tie) if tie else F.xxhash64(*df.columns)
    return row_positions(df, date_order(date, spread), [tie] if tie else [], by)


def holdout_cut(df: DataFrame, share: float = 0.8, date: str = "date", tie: str | None = None) -> DataFrame:
    """``part`` = 'fit' for the first ``floor(share * n)`` rows by date, else 'calibrate'."""
    placed = _by_date(df, date, tie)
    early = F.col("position") <= F.floor(F.col("size") * F.lit(share))
    return placed.withColumn("part", F.when(early, "fit").otherwise("calibrate")).drop("position", "size")


def expanding_folds(df: DataFrame, splits: int = 5, date: str = "date", tie: str | None = None) -> DataFrame:
    """``test_fold`` = 1..splits for the last ``splits`` equal stretches, 0 for the rows before them.

    Fold k is tested on ``test_fold == k`` after training on ``test_fold < k``.
    """
    placed = _by_date(df, date, tie)
    width = F.floor(F.col("size") / F.lit(splits + 1))
    first = F.col("size") - width * splits
    fold = F.when(F.col("position") <= first, F.lit(0)).otherwise(
        F.floor((F.col("position") - 1 - first) / width).cast("int") + 1
    )
    return placed.withColumn("test_fold", fold.cast("int")).drop("position", "size")


def stratified_folds(
    df: DataFrame, label: str, folds: int = 5, date: str = "date", tie: str | None = None
) -> DataFrame:
    """Unshuffled stratified folds: ``cv_fold`` in 0..folds-1, contiguous by date within each class.

    How many rows of a class each fold gets follows the rule of dealing the class-sorted labels out
    to the folds in turn; the classes are ordered by first appearance.
    """
    placed = _by_date(df, date, tie, [label])
    per_class = (
        placed.groupBy(label)
        .agg(F.max("size").alias("n"), F.min(date).alias("first"))
        .collect()  # one row per class
    )
    per_class.sort(key=lambda r: (r["first"], r[label]))
    edge, dealt = F.lit(None).cast("int"), 0
    for row in per_class:
        cuts, total = [], 0
        for fold in range(folds):
            start = dealt + (fold - dealt) % folds
            total += len(range(start, dealt + row["n"], folds))
            cuts.append(total)
        dealt += row["n"]
        mine = F.lit(folds - 1)
        for fold in reversed(range(folds - 1)):
            mine = F.when(F.col("position") <= cuts[fold], F.lit(fold)).otherwise(mine)
        edge = F.when(F.col(label) == F.lit(row[label]), mine).otherwise(edge)
    return placed.withColumn("cv_fold", edge).drop("position", "size")
