"""Exact order statistics and running sums over one global order, without a one-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from dayrisk.session import settled

SKETCH_ACCURACY = 10_000  # rank error of percentile_approx is n / accuracy
BRACKET = 5 / SKETCH_ACCURACY  # half-width, in rank share, of the interval kept for the exact pass
SMALL = 20_000  # a bracket is at least ten ranks wide to each side: below this many values it is the whole column
ROWS_PER_RANGE = 1_000_000
RANGES = 4_096  # most ranges, so that their cuts stay a short list on the driver; beyond, ranges grow
RANGE = "_range"


def exact_quantiles(df: DataFrame, columns: Sequence[str], fraction: float, how: str = "linear") -> DataFrame:
    """Exact quantile of each column: ``(feature, n, value)``, nulls ignored.

    ``how='linear'`` interpolates between neighbours (the median of an even count is the midpoint);
    ``how='higher'`` takes the element at 0-based ``ceil((n - 1) * fraction)``.

    Selection in two passes. A mergeable sketch of fixed size brackets the wanted ranks of all
    columns at once; the second pass counts the values below each bracket and shuffles only the
    values inside it (a thousandth of a large column). Should a sketch ever miss its rank, the query
    fails rather than return a neighbour.
    """
    if how not in ("linear", "higher"):
        raise ValueError(f"unknown interpolation {how!r}")
    columns = list(columns)
    wide = df.selectExpr(*[f"CAST(`{c}` AS DOUBLE) AS `{c}`" for c in columns])
    return select_ranks(wide, columns, _brackets(wide, columns, fraction), fraction, how)


def bracket_columns(columns: Sequence[str], fraction: float) -> list[Column]:
    ends = f"array({max(0.0, fraction - BRACKET)!r}D, {min(1.0, fraction + BRACKET)!r}D)"
    out = []
    for i, c in enumerate(columns):
        sketch = f"percentile_approx(`{c}`, {ends}, {SKETCH_ACCURACY}) AS q{i}"
        out += [F.expr(t) for t in (f"count(`{c}`) AS n{i}", f"min(`{c}`) AS min{i}", f"max(`{c}`) AS max{i}", sketch)]
    return out


def bracket_row(row, i: int) -> tuple[int, float | None, float | None]:
    n, low, high, ends = row[f"n{i}"], row[f"min{i}"], row[f"max{i}"], row[f"q{i}"]
    return (n, low, high) if n <= SMALL else (n, ends[0], ends[1])


def _brackets(wide: DataFrame, columns: Sequence[str], fraction: float):
    row = wide.agg(*bracket_columns(columns, fraction)).first()
    return [bracket_row(row, i) for i in range(len(columns))]


def select_ranks(
    wide: DataFrame, columns, brackets, fraction: float, how: str, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    known = [(i, c, *b) for i, (c, b) in enumerate(zip(columns, brackets)) if b[0] > 0]
    if not known:
        raise ValueError("no column has a value")
    entries = [
        f"named_struct('feature', '{c}', 'n', {n}L, 'keep', `{c}` <= {high!r}D, "
        f"'value', CASE WHEN `{c}` >= {low!r}D THEN `{c}` END)"
        for _, c, n, low, high in known
    ]
    counted = (
        wide.select(F.expr(f"explode(array({', '.join(entries)}))").alias("e"))
        .where("e.keep")
        .groupBy("e.feature", "e.n", "e.value")
        .agg(F.count(F.lit(1)).alias("m"))
    )
    position = (F.col("n") - 1) * F.lit(fraction)
    if how == "higher":
        position = F.ceil(position)
    low_rank, high_rank = F.floor(position), F.ceil(position)
    # the values inside a bracket are still many for a large column: their ranks are summed in value ranges
    summed = running_sums(counted, "value", ["m"], by=["feature", "n"], rows_per_range=rows_per_range)
    placed = summed.withColumn("_end", F.col("cum_m")).withColumn("_start", F.col("_end") - F.col("m"))
    holds = lambda rank: F.col("value").isNotNull() & (F.col("_start") <= rank) & (rank < F.col("_end"))
    found = placed.groupBy("feature", "n").agg(
        F.max(F.when(holds(low_rank), F.col("value"))).alias("_a"),
        F.max(F.when(holds(high_rank), F.col("value"))).alias("_b"),
    )
    checked = lambda c: F.when(F.col(c).isNotNull(), F.col(c)).otherwise(
        F.raise_error(F.lit("rank outside its bracket")).cast("double")
    )
    weight = position - low_rank
    return found.select(
        "feature", "n", (checked("_a") + (checked("_b") - checked("_a")) * weight).alias("value")
    )


def in_ranges(df: DataFrame, order: str, rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Add ``_range``: consecutive value ranges of ``order`` holding about equally many rows.

    The split points only balance the work; any split points give the same results downstream, because equal values always share a
    range and ranges follow the order. As in Spark's order, nulls are the first range (-1) and NaN the last, however many rows there are.
    """
    key = F.col(order).cast("double")
    n = df.count()
    parts = min(RANGES, -(-n // rows_per_range)) if n else 1
    probabilities = [i / parts for i in range(1, parts)]
    found = df.select(key.alias("_key")).approxQuantile("_key", probabilities, 1 / (4 * parts)) if probabilities else []
    cuts = sorted(set(found))
    if cuts:
        keyed = df.withColumn("_order_key", key)
        ends = [float("-inf"), *cuts, float("inf")]
        ranged = Bucketizer(splits=ends, inputCol="_order_key", outputCol=RANGE, handleInvalid="keep").transform(keyed).drop("_order_key")
    else:
        ranged = df.withColumn(RANGE, F.lit(0.0))
    last = float(len(cuts) + 1)
    return ranged.withColumn(RANGE, F.when(key.isNull(), F.lit(-1.0)).when(F.isnan(key), F.lit(last)).otherwise(F.col(RANGE)))


def running_sums(
    df: DataFrame,
    order: str,
    values: Sequence[str],
    by: Sequence[str] = (),
    descending: bool = False,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``cum_<value>`` (sum up to and including the row) and ``all_<value>`` (sum of the group).

    ``order`` must be unique within ``by``: aggregate equal values first. Sums run inside value
    ranges in parallel; the ranges' totals, a few rows per group, give each range its offset. The input is computed once.
    """
    by = list(by)
    ranged = in_ranges(settled(df), order, rows_per_range)
    direction = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    inside = Window.partitionBy(*by, RANGE).orderBy(direction(order)).rowsBetween(Window.unboundedPreceding, 0)
    groups = Window.partitionBy(*by)
    earlier = groups.orderBy(direction(RANGE)).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy(*by, RANGE).agg(*[F.sum(v).alias(v) for v in values])
    offsets = totals.select(
        *[F.col(b).alias(f"_by_{b}") for b in by],
        F.col(RANGE).alias("_range_of"),
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_before_{v}") for v in values],
        *[F.sum(v).over(groups).alias(f"all_{v}") for v in values],
    )
    match = F.col(RANGE) == F.col("_range_of")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    summed = ranged.withColumns({f"cum_{v}": F.sum(v).over(inside) for v in values})
    return summed.join(offsets, match).select(
        *df.columns,
        *[(F.col(f"cum_{v}") + F.col(f"_before_{v}")).alias(f"cum_{v}") for v in values],
        *[f"all_{v}" for v in values],
    )


def date_order(date: str, tie: Column | None = None) -> Column:
    """Whole-number order key by date, null dates first; a ``tie`` hash spreads the rows of one date.

    15 bits of date and 37 of hash stay exact when the key is handled as a double.
    """
    day = F.coalesce(F.unix_date(F.col(date)).cast("bigint"), F.lit(-32768))
    if tie is None:
        return day
    return F.shiftleft(day, 37) + F.shiftrightunsigned(tie, 27)


def row_positions(
    df: DataFrame, order: Column, ties: Sequence[str] = (), by: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Add 1-based ``position`` along a numeric ``order``, then ``ties``, within ``by``; and the group ``size``.

    The order is total: after ``ties`` the hash of the whole row decides, and rows equal in every column are told apart by a number
    that is fixed when the input is settled. Positions thus do not change between two uses of the result, nor with the layout of the input.
    """
    by = list(by)
    rest = F.xxhash64(*df.columns)
    keyed = in_ranges(settled(df.withColumns({"_key": order, "_rest": rest, "_row": F.monotonically_increasing_id()})), "_key", rows_per_range)
    inside = Window.partitionBy(*by, RANGE).orderBy("_key", *ties, "_rest", "_row")
    groups = Window.partitionBy(*by)
    earlier = groups.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        keyed.groupBy(*by, RANGE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            *[F.col(b).alias(f"_by_{b}") for b in by],
            F.col(RANGE).alias("_range_of"),
            F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_n").over(groups).alias("size"),
        )
    )
    match = F.col(RANGE) == F.col("_range_of")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_by_{b}"))
    return (
        keyed.withColumn("_rn", F.row_number().over(inside))
        .join(offsets, match)
        .select(*df.columns, (F.col("_rn") + F.col("_before")).alias("position"), "size")
    )


def first_best(df: DataFrame, score: str, *ties: str | Column) -> DataFrame:
    """The row with the highest score, first by ``ties``; null scores lose. A distributed top-1."""
    return df.orderBy(F.col(score).desc_nulls_last(), *ties).limit(1)


def hashed_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """A fixed pseudo-random sample of ``n`` rows: those with the smallest MD5 of ``seed:key``, whatever engine computes it."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)
