"""Lags, rolling statistics and storm phase of a stream of hours, with the last rows of every series kept as state.

An hour is given out once the watermark has passed it: no earlier hour can arrive any more, so its features are those of the batch
panel. Until then it waits in the state; so do, of every series, the last rows that later hours look back to, and nothing else.
Series are dealt into a fixed number of groups by a hash of their keys. The series of a group share one state and one call, whose
array operations run over all their rows, so that many short series cost no call each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from dayrisk.constants import LAG_HOURS, ROLL_HOURS, STORM_LEVEL

PHASES = ("phase_quiet", "phase_main", "phase_recovery")
STATE = "series array<string>, past_n binary, past_ts binary, past binary, open_n binary, open_ts binary, open binary"
KINDS = (np.int64, np.int64, np.float64) * 2
#: Groups of series; a group's state is written anew whenever one of its series has news.
GROUPS = 512
#: Rows whose windows are laid out at once.
SLICE = 16_384
STAMP = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def row_features(values: np.ndarray, known: int, drivers: Sequence[str], lags: Sequence[int], rolls: Sequence[int], storm: int | None) -> dict[str, np.ndarray]:
    """Features of the rows after the first ``known``, from rows in order; missing values are NaN. Windows look strictly back."""
    at = np.arange(known, len(values))
    return placed_features(values, at, at, drivers, lags, rolls, storm)


def placed_features(
    values: np.ndarray, at: np.ndarray, place: np.ndarray, drivers: Sequence[str], lags: Sequence[int], rolls: Sequence[int], storm: int | None
) -> dict[str, np.ndarray]:
    """Features of the rows ``at``, from the rows of many series one after the other; ``place`` counts the rows before each in its own series."""
    out = {}
    for j, d in enumerate(drivers):
        x = values[:, j]
        for k in lags:
            out[f"{d}_lag{k}h"] = np.where(place >= k, x[np.maximum(at - k, 0)], np.nan)
        for w in rolls:
            back = np.arange(w, 0, -1)
            seen = np.where(place[:, None] >= back, x[np.maximum(at[:, None] - back, 0)], np.nan)
            there = ~np.isnan(seen)
            count = there.sum(1)
            total = np.where(there, seen, 0.0).sum(1)
            mean = np.divide(total, count, out=np.full(len(at), np.nan), where=count >= max(2, w // 2))
            gap = np.where(there, seen - mean[:, None], 0.0)
            out[f"{d}_rmean{w}h"] = mean
            out[f"{d}_rstd{w}h"] = np.where(np.isnan(mean), np.nan, np.sqrt((gap**2).sum(1) / np.maximum(1, count - 1)))
    if storm is not None:
        level = values[:, storm]
        change = np.where(place >= 1, level[at] - level[np.maximum(at - 1, 0)], np.nan)
        main, recovery = (level[at] <= STORM_LEVEL) & (change < 0), (level[at] <= STORM_LEVEL) & (change >= 0)
        out |= dict(zip(PHASES, ((~main & ~recovery).astype(np.int32), main.astype(np.int32), recovery.astype(np.int32))))
    return out


def _counted(starts: np.ndarray) -> np.ndarray:
    """How many rows lie between each row and the last start at or before it; the first row starts."""
    at = np.arange(len(starts))
    return at - np.maximum.accumulate(np.where(starts, at, 0))


def stream_features(
    hourly: DataFrame, drivers: Sequence[str], lags: Sequence[int] = LAG_HOURS, rolls: Sequence[int] = ROLL_HOURS, keys: Sequence[str] = ("series",),
    ts: str = "ts", storm_driver: str | None = "Dst", late: str = "2 hours", forget: int | None = None,
    groups: int = GROUPS,
) -> DataFrame:
    """``(keys, ts, features)`` of every hour that the watermark has passed; row-based, as the batch features are.

    An hour that arrives after the watermark has passed it is dropped. Of several rows for one hour of a series the first stays, in one
    micro-batch that of the smallest values. A row without time is dropped; null drivers are missing values, a null key is a series of its own. With ``forget`` a
    series whose next hour is more than so many seconds away starts anew, and the state of one that is silent for so long is given up.
    A stream keeps its number of ``groups``: with many more series, start it with more.
    """
    keys, names = list(keys), list(dict.fromkeys([*drivers, *([storm_driver] if storm_driver else [])]))
    storm, reach = names.index(storm_driver) if storm_driver else None, max([*lags, *rolls, 1])
    made = [f"{d}_lag{k}h" for d in drivers for k in lags] + [f"{d}_r{s}{w}h" for d in drivers for w in rolls for s in ("mean", "std")]
    schema = T.StructType(
        [T.StructField("_series", T.StringType()), T.StructField(ts, T.TimestampType())] + [T.StructField(m, T.DoubleType()) for m in made]
        + [T.StructField(p, T.IntegerType()) for p in (PHASES if storm_driver else ())]
    )
    width = len(names)

    def advance(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = state.get if state.exists else ([], *[b""] * len(KINDS))
        series, (past_n, past_ts, past, open_n, open_ts, open_) = list(held[0]), [np.frombuffer(b, kind) for b, kind in zip(held[1:], KINDS)]
        passed = state.getCurrentWatermarkMs() * 1000
        fresh = [part[part["_us"] > passed] for part in parts]
        fresh = [part for part in fresh if len(part)]
        if fresh:
            found = pd.concat(fresh).sort_values(["_us", *names])
            codes, named = pd.factorize(pd.Series([*series, *found["_series"]], dtype=object))
            own, series = codes[len(series) :], named.tolist()
            us, rows = found["_us"].to_numpy(np.int64), found[names].to_numpy(float)
        else:
            own, us, rows = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, width))
        # waiting hours in order; of several rows for one hour the first that came stays
        of = np.concatenate([np.repeat(np.arange(len(open_n)), open_n), own])
        us, rows = np.concatenate([open_ts, us]), np.concatenate([open_.reshape(-1, width), rows])
        order = np.lexsort((us, of))
        of, us, rows = of[order], us[order], rows[order]
        once = np.ones(len(of), bool)
        once[1:] = (of[1:] != of[:-1]) | (us[1:] != us[:-1])
        of, us, rows = of[once], us[once], rows[once]
        done = us <= passed
        # the rows that are known and those the watermark has passed, by series
        all_of = np.concatenate([np.repeat(np.arange(len(past_n)), past_n), of[done]])
        all_us, all_rows = np.concatenate([past_ts, us[done]]), np.concatenate([past.reshape(-1, width), rows[done]])
        order = np.lexsort((all_us, all_of))
        new = (np.arange(len(all_of)) >= len(past_ts))[order]
        all_of, all_us, all_rows = all_of[order], all_us[order], all_rows[order]
        starts = np.ones(len(all_of), bool)
        starts[1:] = all_of[1:] != all_of[:-1]
        if forget is not None:
            starts[1:] |= new[1:] & (np.diff(all_us) > forget * 1_000_000)
        place, given = _counted(starts), np.flatnonzero(new)
        for i in range(0, len(given), SLICE):
            at = given[i : i + SLICE]
            features = placed_features(all_rows, at, place[at], names, lags, rolls, storm)
            own = {"_series": [series[k] for k in all_of[at]], ts: pd.to_datetime(all_us[at], unit="us")}
            yield pd.DataFrame(own | {m: features[m] for m in schema.names[2:]})
        # of every series its last rows stay, none from before a new start
        ends = np.ones(len(all_of), bool)
        ends[:-1] = starts[1:]
        from_end = _counted(ends[::-1])[::-1]
        last = np.ones(len(all_of), bool)
        last[:-1] = all_of[1:] != all_of[:-1]
        final = np.zeros(len(series), np.int64)
        final[all_of[last]] = np.cumsum(starts)[last]
        kept = (from_end < reach) & (np.cumsum(starts) == final[all_of])
        waiting = np.bincount(of[~done], minlength=len(series))
        wakes = [int(us[~done].min()) // 1000 - 1] if (~done).any() else []
        if forget is not None:
            latest = np.full(len(series), np.iinfo(np.int64).min)
            latest[all_of[last]] = all_us[last]
            silent = (waiting == 0) & (latest + forget * 1_000_000 <= passed)
            kept &= ~silent[all_of]
            quiet = (waiting == 0) & ~silent
            wakes += [int(latest[quiet].min()) // 1000 + forget * 1000] if quiet.any() else []
        counts = np.bincount(all_of[kept], minlength=len(series))
        there = (counts > 0) | (waiting > 0)
        if not there.any():
            if state.exists:
                state.remove()
            return
        stored = (counts[there], all_us[kept], all_rows[kept], waiting[there], us[~done], rows[~done])
        state.update(([s for s, t in zip(series, there) if t], *[np.ascontiguousarray(v, kind).tobytes() for v, kind in zip(stored, KINDS)]))
        if wakes:
            state.setTimeoutTimestamp(max(min(wakes), state.getCurrentWatermarkMs() + 1))

    clocked = hourly.withColumn(ts, F.col(ts).cast("timestamp")).where(F.col(ts).isNotNull()).withWatermark(ts, late)
    named = clocked.withColumns({"_series": F.to_json(F.struct(*keys), STAMP), "_group": F.pmod(F.xxhash64(*keys), F.lit(groups)).cast("int")})
    wanted = named.select("_group", "_series", ts, F.unix_micros(ts).alias("_us"), *[F.col(n).cast("double").alias(n) for n in names])
    given = wanted.groupBy("_group").applyInPandasWithState(advance, schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    of = F.from_json("_series", T.StructType([hourly.schema[k] for k in keys]), STAMP)
    return given.withColumn("_keys", of).select(*[F.col("_keys")[k].alias(k) for k in keys], *schema.names[1:])
