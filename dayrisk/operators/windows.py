"""Past-only window features over long hourly series.

A window partitioned by series alone puts a whole series into one task. Here every series is cut
into time blocks, and the few rows a block needs from before its start are copied into it, so one
series spreads over as many tasks as it has blocks and results equal the uncut window exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayrisk.constants import LAG_HOURS, ROLL_HOURS
from dayrisk.functions.scalars import storm_phase

BLOCK, OWN = "_block", "_own"
DAY_SECONDS = 86_400


def in_time_blocks(
    rows: DataFrame,
    ts: str,
    reach: int,
    keys: Sequence[str] = (),
    block_days: int = 366,
    step_seconds: int = 3600,
    gap_mode: str = "rows",
) -> DataFrame:
    """Copy each row to its own time block and to every later block that looks back to it.

    ``_block`` is the block a copy works in and ``_own`` tells the row itself from its copies.
    With ``gap_mode='time'`` a block looks back ``reach`` steps of time, which a row can decide alone.
    With ``gap_mode='rows'`` it looks back ``reach`` rows, however long the gaps: rows are dealt by (keys, block) once, every block sends
    on its last rows, as many as later blocks still need, and only these move again. The result stays dealt by (keys, ``_block``).
    ``(keys, ts)`` must be unique and ``ts`` not null; a null key is a series of its own.
    """
    keys = list(keys)
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    block_seconds = block_days * DAY_SECONDS
    if reach * step_seconds > block_seconds:
        raise ValueError("a block must be longer than the look-back")
    home = "_home"
    columns = rows.columns
    rows = rows.withColumn(home, F.floor(seconds / block_seconds).cast("int"))
    if gap_mode == "time":
        to_end = (F.col(home).cast("long") + 1) * block_seconds - seconds
        targets = F.when(to_end <= reach * step_seconds, F.array(F.col(home), F.col(home) + 1)).otherwise(F.array(F.col(home)))
        spread = rows.withColumn(BLOCK, F.explode(targets))
        return spread.select(*columns, BLOCK, (F.col(BLOCK) == F.col(home)).alias(OWN))
    if gap_mode != "rows":
        raise ValueError(f"gap_mode must be 'rows' or 'time', not {gap_mode!r}")
    dealt = rows.repartition(*keys, home)
    from_end = F.row_number().over(Window.partitionBy(*keys, home).orderBy(F.col(ts).desc()))
    last = dealt.withColumn("_from_end", from_end).where(F.col("_from_end") <= reach)
    feeds, match = _forward_feeds(rows, home, reach, keys), F.lit(True)
    for c in (*keys, home):  # a null key is a series of its own
        feeds = feeds.withColumnRenamed(c, f"_of{c}")
        match = match & F.col(c).eqNullSafe(F.col(f"_of{c}"))
    wanted = F.transform(F.filter("_feeds", lambda f: f["rows"] >= F.col("_from_end")), lambda f: f["to"])
    copies = last.join(feeds, match).withColumn(BLOCK, F.explode(wanted)).select(*columns, BLOCK, F.lit(False).alias(OWN)).repartition(*keys, BLOCK)
    return dealt.select(*columns, F.col(home).alias(BLOCK), F.lit(True).alias(OWN)).unionByName(copies)


def _forward_feeds(rows: DataFrame, home: str, reach: int, keys: Sequence[str]) -> DataFrame:
    """Per block the later blocks that look back to it, and to how many of its last rows; blocks that none looks back to are left out."""
    sizes = rows.groupBy(*keys, home).agg(F.count(F.lit(1)).alias("_n"))
    in_order = Window.partitionBy(*keys).orderBy(home)
    later = in_order.rowsBetween(1, reach)
    between = lambda f: f["_before"] - F.col("_upto")  # noqa: E731  rows between the end of this block and block f
    return (
        sizes.withColumn("_upto", F.sum("_n").over(in_order))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .withColumn("_later", F.collect_list(F.struct(home, "_before")).over(later))
        .select(
            *keys,
            home,
            F.transform(
                F.filter("_later", lambda f: between(f) < reach), lambda f: F.struct(f[home].alias("to"), (F.lit(reach) - between(f)).alias("rows"))
            ).alias("_feeds"),
        )
        .where(F.size("_feeds") > 0)
    )


class PastFrames:
    """Window expressions over one ordered series, by rows or by time, looking strictly back.

    They are SQL text: a wide panel has hundreds, and building each from Column calls would take
    longer than planning the query.
    """

    def __init__(self, partition: Sequence[str], ts: str, gap_mode: str = "rows", step_seconds: int = 3600):
        self.by_rows, self.step = gap_mode == "rows", step_seconds
        by = "PARTITION BY " + ", ".join(f"`{c}`" for c in partition) if partition else ""
        order = f"`{ts}`" if self.by_rows else f"unix_seconds(CAST(`{ts}` AS TIMESTAMP))"
        self.window = f"{by} ORDER BY {order}"

    def lag(self, name: str, steps: int) -> str:
        if self.by_rows:
            return f"lag(`{name}`, {steps}) OVER ({self.window})"
        back = steps * self.step
        return f"first(`{name}`) OVER ({self.window} RANGE BETWEEN {back} PRECEDING AND {back} PRECEDING)"

    def change(self, name: str) -> str:
        return f"`{name}` - {self.lag(name, 1)}"

    def roll(self, name: str, width: int) -> tuple[str, str]:
        """Mean and sample deviation of the ``width`` steps before the row; null below half of them."""
        if self.by_rows:
            frame = f"({self.window} ROWS BETWEEN {width} PRECEDING AND 1 PRECEDING)"
        else:
            frame = f"({self.window} RANGE BETWEEN {width * self.step} PRECEDING AND 1 PRECEDING)"
        enough = f"count(`{name}`) OVER {frame} >= {max(2, width // 2)}"
        return tuple(
            f"CASE WHEN {enough} THEN {fn}(`{name}`) OVER {frame} END" for fn in ("avg", "stddev_samp")
        )


def lag_and_roll_columns(
    frames: PastFrames,
    drivers: Sequence[str],
    lags: Sequence[int] = LAG_HOURS,
    rolls: Sequence[int] = ROLL_HOURS,
) -> dict[str, str]:
    """Feature name to window expression, in panel order."""
    out = {}
    for d in drivers:
        for k in lags:
            out[f"{d}_lag{k}h"] = frames.lag(d, k)
        for w in rolls:
            out[f"{d}_rmean{w}h"], out[f"{d}_rstd{w}h"] = frames.roll(d, w)
    return out


def hourly_features(
    hourly: DataFrame,
    drivers: Sequence[str],
    lags: Sequence[int] = LAG_HOURS,
    rolls: Sequence[int] = ROLL_HOURS,
    keys: Sequence[str] = (),
    ts: str = "ts",
    storm_driver: str | None = "Dst",
    changes: Sequence[str] = (),
    carry: Sequence[str] = (),
    block_days: int = 366,
    step_seconds: int = 3600,
    gap_mode: str = "rows",
) -> DataFrame:
    """Lags, rolling statistics, storm phase and one-step changes in one windowed projection.

    Drivers the table lacks are skipped. Output: keys, ts, ``_block``, carried columns, features,
    ``<name>_change`` per entry of ``changes`` and the phase flags when ``storm_driver`` is present.
    The rows stay partitioned by (keys, ``_block``), so an aggregation by them needs no more shuffle.
    """
    present = [d for d in drivers if d in hourly.columns]
    changes = [c for c in changes if c in hourly.columns]
    storm = [storm_driver] if storm_driver is not None and storm_driver in hourly.columns else []
    used = dict.fromkeys([*keys, ts, *present, *changes, *carry, *storm])
    reach = max([*lags, *rolls, 1])
    blocks = in_time_blocks(
        hourly.select(*used), ts, reach, keys, block_days, step_seconds, gap_mode
    )
    frames = PastFrames([*keys, BLOCK], ts, gap_mode, step_seconds)
    features = lag_and_roll_columns(frames, present, lags, rolls)
    features.update({f"{c}_change": frames.change(c) for c in changes})
    if storm:
        features["_storm_change"] = frames.change(storm_driver)
    kept = dict.fromkeys([*keys, ts, BLOCK, OWN, *carry, *storm])
    out = blocks.select(*kept, *[F.expr(text).alias(name) for name, text in features.items()]).where(OWN)
    if storm:
        out = out.withColumns(storm_phase(F.col(storm_driver), F.col("_storm_change"))).drop("_storm_change")
    return out.drop(OWN, *[c for c in storm if c not in carry])
