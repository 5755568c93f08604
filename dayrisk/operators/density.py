"""Density clusters (DBSCAN) by grid cells, exact for any cell size.

Cells have the side ``eps / sqrt(d)``, so points of one cell are always neighbours: a cell with
``min_samples`` points makes all of them core points without looking at a single pair. Pairs are
formed only for points of thin cells (fewer than ``min_samples`` points each), against slices of at
most ``SLICE`` points of the cells around. Whether two cells with core points touch is decided on
bounding boxes of ever finer parts, not on pairs of points.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from dayrisk.operators.components import connected_components
from dayrisk.operators.order_stats import row_positions
from dayrisk.session import ensure_checkpoint_dir

SLICE = 10_000


def _offsets(d: int) -> list[tuple[int, ...]]:
    """Cells that can hold a point within ``eps`` of a cell's points, itself left out."""
    return [
        o for o in itertools.product(range(-2, 3), repeat=d)
        if any(o) and sum(max(0, abs(i) - 1) for i in o) < d
    ]


def _around(cell: str, offsets: Sequence[tuple[int, ...]]) -> Column:
    """Array of the neighbouring cells."""
    table = F.array(*[F.array(*[F.lit(i).cast("bigint") for i in o]) for o in offsets])
    return F.transform(table, lambda o: F.zip_with(F.col(cell), o, lambda a, b: a + b))


def _distance(left: Sequence[str], right: Sequence[str]) -> Column:
    return F.sqrt(sum(((F.col(a) - F.col(b)) * (F.col(a) - F.col(b)) for a, b in zip(left, right)), F.lit(0.0)))


def dbscan(
    df: DataFrame, features: Sequence[str], eps: float = 0.5, min_samples: int = 20, out: str = "cluster"
) -> DataFrame:
    """Add the cluster number (from 0 by position), -1 for noise.

    A border point within reach of several clusters goes to the lowest-numbered one. Rows with a null
    feature are noise.
    """
    names, d = list(features), len(features)
    if d > 6:
        raise ValueError("neighbouring cells are listed, 5 to the power of the dimensions: project to at most six axes first")
    ensure_checkpoint_dir(df.sparkSession)
    side = eps / math.sqrt(d)
    x = [f"_x{i}" for i in range(d)]
    whole = F.lit(True)
    for c in names:
        whole = whole & F.col(c).isNotNull()
    # one row per distinct place: copies only add weight
    points = (
        df.where(whole).groupBy(*[F.col(c).cast("double").alias(n) for c, n in zip(names, x)])
        .agg(F.count(F.lit(1)).alias("_w"))
        .withColumn("cell", F.array(*[F.floor(F.col(n) / F.lit(side)).cast("bigint") for n in x]))
    ).checkpoint()
    cells = points.groupBy("cell").agg(F.sum("_w").alias("_n"), F.count(F.lit(1)).alias("_places")).checkpoint()
    offsets = _offsets(d)

    sized = points.join(cells, "cell")
    thin = sized.where(F.col("_n") < min_samples)
    reach = _near(thin.select("cell", "_n", *x), points.select("cell", "_w", *x), cells, offsets, x, eps)
    counts = reach.groupBy(*x).agg(F.sum("_w").alias("_others"))
    judged = sized.join(counts, x, "left").select(
        *x, "cell", "_w",
        ((F.col("_n") + F.when(F.col("_n") < min_samples, F.coalesce("_others", F.lit(0))).otherwise(0)) >= min_samples).alias("core"),
    ).checkpoint()

    core = judged.where("core")
    nodes = core.select(F.col("cell").alias("node")).distinct()
    edges = _touching(core.select("cell", *x), nodes, offsets, x, side, eps)
    labels = connected_components(nodes, edges)
    roots = row_positions(labels.select("label").distinct(), F.get("label", F.lit(0)), ["label"])
    numbered = labels.join(roots.select("label", (F.col("position") - 1).cast("int").alias(out)), "label").select(
        F.col("node").alias("cell"), out
    ).checkpoint()

    inner = core.join(numbered, "cell").select(*x, "cell", out)
    loose = judged.where(~F.col("core")).select("cell", *x)
    core_cells = inner.groupBy("cell").agg(F.count(F.lit(1)).alias("_places"))
    own = loose.join(numbered, "cell").select(*x, out)
    near = _near(loose, inner, core_cells, offsets, x, eps).select(*x, out)
    border = own.unionByName(near).groupBy(*x).agg(F.min(out).alias(out))
    found = inner.select(*x, out).unionByName(border)
    keyed = df.withColumns({n: F.col(c).cast("double") for n, c in zip(x, names)})
    return keyed.join(found, x, "left").select(*df.columns, F.coalesce(F.col(out), F.lit(-1)).alias(out))


def _near(few: DataFrame, many: DataFrame, sizes: DataFrame, offsets, x: Sequence[str], eps: float) -> DataFrame:
    """Pairs within ``eps`` of a point of ``few`` and a point of ``many`` in another cell.

    A crowded cell of ``many`` is met in slices, so no task sees more than ``SLICE`` of its points;
    each point of ``many`` meets at most ``min_samples`` points per neighbouring thin cell.
    """
    slices = sizes.select("cell", F.ceil(F.col("_places") / F.lit(SLICE)).cast("int").alias("_slices"))
    y = [f"_y{i}" for i in range(len(x))]
    asked = (
        few.select(*x, F.explode(_around("cell", offsets)).alias("cell"))
        .join(slices, "cell")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), F.col("_slices") - 1)))
        .drop("_slices")
    )
    held = many.join(slices, "cell").withColumn("_slice", F.pmod(F.xxhash64(*x), F.col("_slices").cast("bigint")).cast("int"))
    held = held.select("cell", "_slice", *[F.col(a).alias(b) for a, b in zip(x, y)], *[c for c in many.columns if c not in (*x, "cell")])
    return asked.join(held, ["cell", "_slice"]).where(_distance(x, y) <= F.lit(eps)).drop("cell", "_slice", *y)


def _boxes(core: DataFrame, x: Sequence[str], side: float, level: int) -> DataFrame:
    """Tight bounding box of the core points in every part of a cell; level k halves the side k times."""
    part = lambda k: F.array(*[F.floor(F.col(n) / F.lit(side / 2**k)).cast("bigint") for n in x])
    grouped = core.select("cell", part(max(level - 1, 0)).alias("parent"), part(level).alias("part"), *x)
    return grouped.groupBy("cell", "parent", "part").agg(
        F.array(*[F.min(n) for n in x]).alias("low"), F.array(*[F.max(n) for n in x]).alias("high")
    )


def _touching(core: DataFrame, nodes: DataFrame, offsets, x: Sequence[str], side: float, eps: float) -> DataFrame:
    """Edges ``(a, b)``, a < b, between cells that hold core points within ``eps`` of each other.

    Two parts settle their cells when even their farthest corners are within ``eps``; they are out when
    their nearest sides are not; what is between is halved again. Boxes shrink to single places,
    where nearest and farthest agree, so the halving ends.
    """
    forward = [o for o in offsets if o > tuple(0 for _ in o)]
    pairs = (
        nodes.select(F.col("node").alias("a"), F.explode(_around("node", forward)).alias("b"))
        .join(nodes.select(F.col("node").alias("b")), "b")
        .select("a", "b")
    )
    settled, open_parts, level = None, None, 0
    while True:
        boxes = _boxes(core, x, side, level)
        one = boxes.select(F.col("cell").alias("a"), F.col("parent").alias("pa"), F.col("part").alias("sa"), F.col("low").alias("la"), F.col("high").alias("ha"))
        two = boxes.select(F.col("cell").alias("b"), F.col("parent").alias("pb"), F.col("part").alias("sb"), F.col("low").alias("lb"), F.col("high").alias("hb"))
        if level == 0:
            met = pairs.join(one, "a").join(two, "b")
        else:
            # parts of level k know their parent part, so only children of open parts meet
            met = open_parts.join(one, ["a", "pa"]).join(two, ["b", "pb"])
        gaps = [F.greatest(F.get("lb", F.lit(i)) - F.get("ha", F.lit(i)), F.get("la", F.lit(i)) - F.get("hb", F.lit(i)), F.lit(0.0)) for i in range(len(x))]
        reach = [F.greatest(F.get("hb", F.lit(i)) - F.get("la", F.lit(i)), F.get("ha", F.lit(i)) - F.get("lb", F.lit(i))) for i in range(len(x))]
        norm = lambda parts: F.sqrt(sum((p * p for p in parts), F.lit(0.0)))
        met = met.select("a", "b", "sa", "sb", norm(gaps).alias("nearest"), norm(reach).alias("farthest"))
        met = met.where(F.col("nearest") <= F.lit(eps)).checkpoint()
        sure = met.where(F.col("farthest") <= F.lit(eps)).select("a", "b").distinct()
        settled = sure if settled is None else settled.unionByName(sure).distinct()
        open_parts = (
            met.where(F.col("farthest") > F.lit(eps))
            .join(sure, ["a", "b"], "left_anti")
            .select("a", "b", F.col("sa").alias("pa"), F.col("sb").alias("pb"))
        ).checkpoint()
        if open_parts.isEmpty():
            return settled
        level += 1
