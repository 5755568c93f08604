"""Daily label panels from an event catalogue."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

from dayrisk.constants import DIAGNOSES, ENVIRONMENTAL
from dayrisk.operators.daily import fill_calendar


def daily_event_counts(
    events: DataFrame,
    only_environmental: bool = True,
    fill: bool = True,
    classes: Sequence[str] = tuple(DIAGNOSES),
    keys: Sequence[str] = (),
    date: str = "anomaly_date",
    code: str = "ADIAG",
    entity: str = "BIRD",
    other: bool = False,
) -> DataFrame:
    """Event counts, per-class counts and the two daily flags in one aggregation.

    ``n_anomalies`` counts rows, ``n_<class>`` counts rows with an entity, so the two may differ.
    Days enter the panel through a counted row or a row with a class; ``fill`` adds the quiet days.
    The class list is fixed, so the schema does not depend on the data; ``other`` adds ``n_other``, the count of all other classes.
    """
    counted = F.col("is_environmental") if only_environmental else F.lit(True)
    names = {c: f"n_{c.lower()}" for c in classes}
    panel = (
        events.where(counted | F.col(code).isNotNull())
        .groupBy(*keys, F.to_date(date).alias("date"))
        .agg(
            F.count_if(counted).alias("n_anomalies"),
            *[
                F.count_if((F.col(code) == c) & F.col(entity).isNotNull()).alias(n)
                for c, n in names.items()
            ],
            *[F.count_if(~F.col(code).isin(*classes) & F.col(entity).isNotNull()).alias("n_other")] * other,
        )
    )
    counts = ["n_anomalies", *names.values(), *["n_other"] * other]
    if fill:
        panel = fill_calendar(panel, keys, fills=dict.fromkeys(counts, 0))
    caused = sum((F.col(names[c]) for c in ENVIRONMENTAL if c in names), F.lit(0))
    return panel.select(
        *keys,
        "date",
        *[F.col(c).cast("bigint").alias(c) for c in counts],
        (F.col("n_anomalies") > 0).alias("any_anomaly"),
        (caused > 0).alias("any_environmental"),
    )


def class_pivot(
    events: DataFrame,
    classes: Sequence[str] = tuple(DIAGNOSES),
    date: str = "anomaly_date",
    code: str = "ADIAG",
    entity: str = "BIRD",
) -> DataFrame:
    """Count of rows with an entity, per day and class; ``n_other`` counts classes that are not listed. Rows without a class are left out."""
    found, held = F.col(code), F.col(entity).isNotNull()
    return (
        events.where(found.isNotNull())
        .groupBy(F.to_date(date).alias("date"))
        .agg(
            *[F.count_if((found == c) & held).alias(f"n_{c.lower()}") for c in classes],
            F.count_if(~found.isin(*classes) & held).alias("n_other"),
        )
    )


def next_label(
    labels: DataFrame, label: str, horizon: int = 1, keys: Sequence[str] = (), target: str = "target"
) -> DataFrame:
    """The label ``horizon`` rows later; the last rows get null. Apply before any fold is cut off."""
    ahead = F.lead(F.col(label).cast("int"), horizon).over(Window.partitionBy(*keys).orderBy("date"))
    return labels.select(*keys, "date", ahead.alias(target))


def fold_column(date, cuts: Mapping[str, str]):
    """Chronological fold name: each fold ends on its date, later dates have no fold."""
    out = F.lit(None).cast("string")
    for name, end in sorted(cuts.items(), key=lambda item: item[1], reverse=True):
        out = F.when(date <= F.lit(end).cast("date"), F.lit(name)).otherwise(out)
    return out


def fold_summary(folded: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """Start, end, number of days and positive rate (percent) per fold."""
    return (
        folded.where(F.col(fold).isNotNull())
        .groupBy(fold)
        .agg(
            F.min("date").alias("start"),
            F.max("date").alias("end"),
            F.count(F.lit(1)).alias("days"),
            (F.avg(F.col(label).cast("double")) * 100).alias("pos_rate_pct"),
        )
    )


def date_audit(events: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per candidate date column: distinct dates and the largest number of rows on one date.

    Rows are first reduced to one per (column, date), so a date with most of the rows costs nothing.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.to_date(c).alias("date")) for c in columns]))
    per_date = (
        events.select(pairs.alias("pair"))
        .where("pair.date IS NOT NULL")
        .groupBy("pair.column", "pair.date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per_date.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_dates"),
        F.max("n").alias("largest_pile"),
        F.min_by("date", F.struct(-F.col("n"), F.col("date"))).alias("largest_date"),
    )


def coverage_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing and present counts per column from one pass, sorted by share missing."""
    row = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count(c).alias(c) for c in columns])
    entries = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("present")) for c in columns]))
    return (
        row.select("_n", entries.alias("e"))
        .select(
            "e.column",
            (F.col("_n") - F.col("e.present")).alias("missing"),
            "e.present",
            (100.0 * (F.col("_n") - F.col("e.present")) / F.nullif(F.col("_n"), F.lit(0))).alias("pct_missing"),
        )
        .orderBy("pct_missing", "column")
    )
