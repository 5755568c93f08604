"""Isotonic curves by pooling adjacent violators where the scores lie.

Distinct scores fall into value ranges; every range pools its own violators to blocks. Neighbouring stretches of ranges then merge
pairwise, as a tree: only what violates across their border is pooled, into one block, whose value is the weighted mean of the left
blocks above it and the right blocks below it. That value is found by sums over the blocks, so no stretch is gathered. Curves of many
groups are fitted together. Knots stay a table; scores are looked up in an array only if the curve has few of them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from dayrisk.operators.order_stats import RANGE, ROWS_PER_RANGE, in_ranges
from dayrisk.session import settled

#: A curve with more knots than that is joined to the scores instead of being looked up.
KNOTS = 10_000
BLOCK = ("lo", "hi", "w", "s")


def pool(w: np.ndarray, s: np.ndarray) -> list[tuple[int, int, float, float]]:
    """``(first, last, weight, sum)`` of the blocks over ascending scores with non-decreasing means."""
    out: list[tuple[int, int, float, float]] = []
    for i, (weight, total) in enumerate(zip(w.tolist(), s.tolist())):
        first = i
        while out and out[-1][3] * weight > total * out[-1][2]:  # the mean before is above
            first, _, more, part = out.pop()
            weight, total = weight + more, total + part
        out.append((first, i, weight, total))
    return out


def pooled_blocks(df: DataFrame, y: str = "y", p: str = "p", by: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Settled ``(by..., lo, hi, w, s)``: the blocks of every group's curve, each from score ``lo`` to ``hi`` with mean ``s / w``."""
    by = list(by)
    per_score = (
        df.where(F.col(p).isNotNull() & F.col(y).isNotNull())
        .groupBy(*by, F.col(p).cast("double").alias("lo"))
        .agg(F.count(F.lit(1)).cast("double").alias("w"), F.sum(F.col(y).cast("double")).alias("s"))
    )
    ranged = in_ranges(settled(per_score), "lo", rows_per_range)
    fields = [ranged.schema[b] for b in by] + [T.StructField(c, T.DoubleType()) for c in (*BLOCK, RANGE)]

    def local(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("lo")
        found = np.array(pool(rows["w"].to_numpy(), rows["s"].to_numpy()))
        first, last = found[:, 0].astype(int), found[:, 1].astype(int)
        made = {b: rows[b].iloc[0] for b in by} | {"lo": rows["lo"].to_numpy()[first], "hi": rows["lo"].to_numpy()[last], "w": found[:, 2], "s": found[:, 3]}
        return pd.DataFrame(made | {RANGE: rows[RANGE].iloc[0]}, columns=[f.name for f in fields])

    blocks = settled(ranged.groupBy(*by, RANGE).applyInPandas(local, T.StructType(fields)))
    ends = blocks.agg(F.min(RANGE), F.max(RANGE)).first()
    if ends[0] is None:
        return blocks.drop(RANGE)
    blocks, count, span = blocks.withColumn(RANGE, F.col(RANGE) - F.lit(ends[0])), int(ends[1] - ends[0]) + 1, 1
    while span < count:
        blocks = _merged(blocks, by, span)
        span *= 2
    return blocks.drop(RANGE)


def _merged(blocks: DataFrame, by: list[str], span: int) -> DataFrame:
    """Blocks of neighbouring stretches of ``span`` ranges made one non-decreasing run."""
    keys, mean = [*by, "_pair"], F.col("s") / F.col("w")
    sided = blocks.withColumns({"_pair": F.floor(F.col(RANGE) / (2 * span)), "_left": F.floor(F.col(RANGE) / span) % 2 == 0, "_mean": mean})
    edge = lambda flag, best, what: best(F.when(flag, F.struct("lo", what)))[what]
    borders = sided.groupBy(*keys).agg(edge(F.col("_left"), F.max, "_mean").alias("_high"), edge(~F.col("_left"), F.min, "_mean").alias("_low"))
    state = settled(borders.where("_high > _low").withColumns({"_v": (F.col("_high") + F.col("_low")) / 2, "_n": F.lit(-1).cast("bigint"), "_wn": F.lit(0.0), "_done": F.lit(False)}))
    if state.isEmpty():
        return blocks
    within = (F.col("_left") & (F.col("_mean") > F.col("_v"))) | (~F.col("_left") & (F.col("_mean") < F.col("_v")))
    while not (open_ := state.where("NOT _done")).isEmpty():
        active = sided.alias("b").join(open_.alias("o"), _same("b", "o", keys)).where(within)
        sums = active.select(*[F.col(f"b.{k}") for k in keys], "b.w", "b.s").groupBy(*keys).agg(F.sum("w").alias("_w"), F.sum("s").alias("_s"), F.count(F.lit(1)).alias("_m"))
        joined = open_.alias("o").join(sums.alias("x"), _same("o", "x", keys), "left")
        root = F.col("_s") / F.col("_w")  # where the sum over these blocks is balanced
        high, low = F.when(root < F.col("_v"), F.col("_v")).otherwise(F.col("_high")), F.when(root > F.col("_v"), F.col("_v")).otherwise(F.col("_low"))
        inside = (root >= low) & (root <= high)
        same = (root == F.col("_v")) | ((F.col("_m") == F.col("_n")) & (F.col("_w") == F.col("_wn")) & (F.abs(root - F.col("_v")) <= 1e-12 * F.abs(root)))
        stepped = joined.select(
            *[F.col(f"o.{k}") for k in keys], high.alias("_high"), low.alias("_low"),
            F.when(same, F.col("_v")).when(inside, root).otherwise((high + low) / 2).alias("_v"),
            F.when(inside, F.col("_m")).otherwise(F.lit(-1)).cast("bigint").alias("_n"), F.col("_w").alias("_wn"), F.coalesce(same, F.lit(True)).alias("_done"),
        )
        state = settled(stepped.unionByName(state.where("_done")))
    found = sided.alias("b").join(state.alias("o"), _same("b", "o", keys), "left")
    marked = settled(found.select(*[F.col(f"b.{c}") for c in [*keys, *BLOCK, RANGE]], F.coalesce(within, F.lit(False)).alias("_within")))
    pooled = marked.where("_within").groupBy(*keys).agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("w").alias("w"), F.sum("s").alias("s"), F.min(RANGE).alias(RANGE))
    columns = [*by, *BLOCK, RANGE]
    return settled(marked.where("NOT _within").select(*columns).unionByName(pooled.select(*columns)))


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}"))
    return out


def knots(blocks: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(by..., score, value)``: both ends of every block."""
    value = (F.col("s") / F.col("w")).alias("value")
    return blocks.select(*by, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("score"), value)


class IsotonicCurve:
    """A non-decreasing curve through its knots, level beyond them."""

    def __init__(self, table: DataFrame, few: int = KNOTS, arrays: tuple[list[float], list[float]] | None = None):
        self.table, self.few, self._arrays = table, few, arrays

    def arrays(self) -> tuple[list[float], list[float]] | None:
        """Scores and values if there are few."""
        if self._arrays is None:
            rows = sorted((r["score"], r["value"]) for r in self.table.limit(self.few + 1).collect())
            self._arrays = tuple(map(list, zip(*rows))) if 0 < len(rows) <= self.few else ()
        return self._arrays or None

    def predict(self, df: DataFrame, p: str = "p", out: str = "calibrated") -> DataFrame:
        """Add ``out``: linear between knots; null for a null score, and everywhere if the curve has no knot."""
        found = self.arrays()
        if found is None:
            return self._joined(df, p, out)
        scores, values = found
        asked = df.withColumn("_asked", F.col(p).cast("double"))
        splits = [float("-inf"), *scores, float("inf")]
        placed = Bucketizer(splits=splits, inputCol="_asked", outputCol="_place", handleInvalid="keep").transform(asked)
        i = F.col("_place").cast("int")  # the number of knots at or below
        x, v = F.lit(scores), F.lit(values)
        at = lambda a, k: F.get(a, k)
        share = (F.col("_asked") - at(x, i - 1)) / (at(x, i) - at(x, i - 1))
        value = F.when(F.col("_asked").isNull() | F.isnan("_asked"), None).when(i == 0, values[0]).when(i >= len(scores), values[-1])
        return placed.withColumn(out, value.otherwise(at(v, i - 1) + share * (at(v, i) - at(v, i - 1)))).drop("_asked", "_place")

    def _joined(self, df: DataFrame, p: str, out: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
        """Distinct scores take the knots before and after them in sorted ranges; rows take the result by their score."""
        asked = df.select(F.col(p).cast("double").alias("score")).where("score IS NOT NULL AND NOT isnan(score)").distinct()
        both = self.table.select("score", F.struct("score", "value").alias("knot")).unionByName(asked.select("score", F.lit(None).cast("struct<score:double,value:double>").alias("knot")))
        ranged = in_ranges(settled(both), "score", rows_per_range)
        order = [F.col("score"), F.col("knot").isNull()]  # a knot comes before the scores equal to it
        inside = Window.partitionBy(RANGE).orderBy(*order)
        ends = ranged.groupBy(RANGE).agg(F.max("knot").alias("_last"), F.min("knot").alias("_first"))
        over = Window.orderBy(RANGE)  # one row per range
        carried = ends.select(
            F.col(RANGE).alias("_of"), F.last("_last", True).over(over.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
            F.first("_first", True).over(over.rowsBetween(1, Window.unboundedFollowing)).alias("_after"))
        near = ranged.withColumns({
            "_a": F.last("knot", True).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "_b": F.first("knot", True).over(inside.rowsBetween(1, Window.unboundedFollowing)),
        }).where("knot IS NULL").join(carried, F.col(RANGE) == F.col("_of"))
        a, b = F.coalesce("_a", "_before"), F.coalesce("_b", "_after")
        share = (F.col("score") - a["score"]) / (b["score"] - a["score"])
        value = F.when(a.isNull(), b["value"]).when(b.isNull(), a["value"]).otherwise(a["value"] + share * (b["value"] - a["value"]))
        told = near.select(F.col("score").alias("_score"), value.alias(out))
        return df.join(told, F.col(p).cast("double") == F.col("_score"), "left").drop("_score")


def isotonic_curve(df: DataFrame, y: str = "y", p: str = "p", rows_per_range: int = ROWS_PER_RANGE) -> IsotonicCurve:
    return IsotonicCurve(settled(knots(pooled_blocks(df, y, p, rows_per_range=rows_per_range))))


def isotonic_curves(df: DataFrame, by: Sequence[str], y: str = "y", p: str = "p", few: int = KNOTS) -> dict[tuple, IsotonicCurve]:
    """A curve for every group, pooled together; knots of all groups reach the driver at once if no group has more than ``few``."""
    table = settled(knots(pooled_blocks(df, y, p, by), by))
    sizes = table.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per curve
    own = lambda r: table.where(_is(by, r)).select("score", "value")
    if max((r["n"] for r in sizes), default=0) > few:
        return {tuple(r[b] for b in by): IsotonicCurve(own(r), few) for r in sizes}
    found: dict[tuple, list] = {}
    for r in table.collect():
        found.setdefault(tuple(r[b] for b in by), []).append((r["score"], r["value"]))
    return {tuple(r[b] for b in by): IsotonicCurve(own(r), few, tuple(map(list, zip(*sorted(found[tuple(r[b] for b in by)]))))) for r in sizes}


def _is(by: Sequence[str], row) -> Column:
    out = F.lit(True)
    for b in by:
        out = out & F.col(b).eqNullSafe(F.lit(row[b]))
    return out
