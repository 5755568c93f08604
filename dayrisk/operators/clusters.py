"""Regime discovery: projection, clusterers and their diagnostics."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.sql import DataFrame, functions as F, types as T

from dayrisk.constants import SEED
from dayrisk.operators.linear import vectors
from dayrisk.operators.many_means import Centres
from dayrisk.session import ensure_checkpoint_dir, side_by_side


@dataclass(frozen=True)
class Projection:
    """Principal axes (largest loading positive), their variance shares and the centre."""

    features: tuple[str, ...]
    centre: tuple[float, ...]
    axes: tuple[tuple[float, ...], ...]
    shares: tuple[float, ...]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        columns = []
        for i, axis in enumerate(self.axes):
            terms = [f"{a!r}D * (`{f}` - {c!r}D)" for f, a, c in zip(self.features, axis, self.centre)]
            columns.append(F.expr(" + ".join(terms)).alias(f"pc{i + 1}"))
        return df.select(*keep, *columns)


def fit_pca(df: DataFrame, features: Sequence[str], k: int = 3) -> Projection:
    """Centre, find the axes, fix their signs."""
    model = PCA(k=k, inputCol="features", outputCol="projected").fit(vectors(df, features, []))
    axes = model.pc.toArray().T
    axes = [tuple(float(x) for x in (a if a[np.argmax(np.abs(a))] > 0 else -a)) for a in axes]
    row = df.selectExpr(*[f"avg(`{f}`) AS m{i}" for i, f in enumerate(features)]).first()
    centre = tuple(float(row[f"m{i}"]) for i in range(len(features)))
    return Projection(tuple(features), centre, tuple(axes), tuple(float(x) for x in model.explainedVariance))


def kmeans(df: DataFrame, features: Sequence[str], k: int, starts: int = 20, seed: int = SEED, parallelism: int = 8):
    """The cheapest of several seeded K-means fits; returns the model. Fits run side by side."""
    ensure_checkpoint_dir(df.sparkSession)
    data = vectors(df, features, []).checkpoint().persist()  # short lineage for many small jobs
    try:
        fit = lambda i: KMeans(k=k, seed=seed + i, maxIter=100).fit(data)
        return min(side_by_side(fit, range(starts), parallelism), key=lambda m: m.summary.trainingCost)
    finally:
        data.unpersist()


@dataclass(frozen=True)
class ShiftedModel:
    """A cluster model fitted on features moved by a constant."""

    model: object
    shifts: tuple[float, ...]

    def moved(self, features: Sequence[str]) -> list:
        return [(F.col(f) + F.lit(s)).alias(f"_s{i}") for i, (f, s) in enumerate(zip(features, self.shifts))]


def bisecting(df: DataFrame, features: Sequence[str], k: int = 5, seed: int = SEED) -> ShiftedModel:
    """Hierarchical clusters by repeated splitting.

    Spark starts a split by moving the centre a small fraction of its own length, which does nothing
    to a centre at the origin, where centred projections have theirs. Distances do not
    mind a shift, so the features are moved away from the origin by ten times their deviation.
    """
    row = df.selectExpr(*[f"stddev_pop(`{f}`) AS s{i}" for i, f in enumerate(features)]).first()
    spread = max((row[f"s{i}"] or 0.0) for i in range(len(features))) or 1.0
    shifted = ShiftedModel(None, (10.0 * spread,) * len(features))
    names = [f"_s{i}" for i in range(len(features))]
    data = vectors(df.select(*shifted.moved(features)), names, [])
    model = BisectingKMeans(k=k, seed=seed, minDivisibleClusterSize=1.0).fit(data)
    return ShiftedModel(model, shifted.shifts)


def assign(df: DataFrame, model, features: Sequence[str], out: str = "cluster") -> DataFrame:
    if isinstance(model, Centres):
        return model.transform(df, out)
    if isinstance(model, ShiftedModel):
        rows, names, fitted = df.select("*", *model.moved(features)), [f"_s{i}" for i in range(len(features))], model.model
    else:
        rows, names, fitted = df, list(features), model
    assembled = VectorAssembler(inputCols=names, outputCol="features").transform(rows)
    return fitted.copy({fitted.predictionCol: out}).transform(assembled).select(*df.columns, out)


def rate_spread(df: DataFrame, y: str = "y", cluster: str = "cluster") -> DataFrame:
    """Largest minus smallest positive rate over the clusters (noise counts as one)."""
    rates = df.groupBy(cluster).agg(F.avg(F.col(y).cast("double")).alias("rate"))
    return rates.agg((F.max("rate") - F.min("rate")).alias("pos_rate_spread"))


def silhouette_squared(df: DataFrame, features: Sequence[str], cluster: str = "cluster") -> float:
    """Mean silhouette with squared distances: one pass over the rows, at any size.

    Not the same number as :func:`silhouette_exact`, which uses plain distances.
    """
    data = vectors(df, features, [F.col(cluster).cast("double").alias("prediction")])
    return ClusteringEvaluator(distanceMeasure="squaredEuclidean").evaluate(data)


#: Rows of a block of the exact silhouette: VALUES numbers at most, BLOCK_ROWS while there are fewer than BLOCKS blocks.
VALUES, BLOCK_ROWS, BLOCKS = 2_000_000, 2048, 24
#: Squared distances below this part of the squared lengths are computed anew from differences.
CLOSE = 1e-3
SLICE = 512


def plain_distances(x: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows of ``x`` to all rows of ``z`` by one matrix product; close pairs by their differences."""
    lengths = (x * x).sum(1)[:, None] + (z * z).sum(1)[None, :]
    square = x @ z.T
    square *= -2
    square += lengths
    lengths *= CLOSE
    i, j = np.nonzero(square < lengths)
    for at in range(0, len(i), 8192):
        gap = x[i[at : at + 8192]] - z[j[at : at + 8192]]
        square[i[at : at + 8192], j[at : at + 8192]] = (gap * gap).sum(1)
    return np.sqrt(square, out=square)


def silhouette_exact(
    df: DataFrame, features: Sequence[str], cluster: str = "cluster", key: str = "id", block_rows: int | None = None
) -> DataFrame:
    """Mean silhouette with plain Euclidean distances: one row ``(silhouette, n_clusters)``.

    The definition needs every distance, so the work grows with the square of the rows; use
    :func:`silhouette_squared` for large tables. Rows are dealt into blocks by hash, each pair of
    blocks meets once in a task of its own, which gives back only the sums of distances per row and cluster, both ways.
    Noise (cluster -1) takes part as a cluster, but the result is null with fewer than two others.
    A row alone in its cluster scores 0.
    """
    names = list(features)
    rows = df.select(F.col(key).alias("_id"), F.col(cluster).cast("int").alias("_c"), F.array(*[F.col(n).cast("double") for n in names]).alias("_x")).where(
        F.col("_c").isNotNull()
    )
    n, width = rows.count(), len(names)
    if block_rows is None:
        blocks = max(1, -(-n * width // VALUES), min(-(-n // BLOCK_ROWS), BLOCKS))
    else:
        blocks = max(1, -(-n // block_rows))
    tiles = blocks * (blocks + 1) // 2
    home = F.pmod(F.xxhash64("_id"), F.lit(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    placed = rows.withColumn("_h", home).withColumn("_o", other)
    hi, lo = F.greatest("_h", "_o"), F.least("_h", "_o")
    placed = placed.select("_id", "_c", "_x", (F.col("_h") == hi).alias("_left"), (F.col("_h") == lo).alias("_right"), (hi * (hi + 1) / 2 + lo).cast("int").alias("_tile"))
    id_type = rows.schema["_id"].dataType
    schema = T.StructType([T.StructField("_id", id_type), *[T.StructField(c, t) for c, t in (("_c", T.IntegerType()), ("_to", T.IntegerType()), ("_d", T.DoubleType()), ("_m", T.LongType()))]])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = [b for b in batches if b.num_rows]
        if not table:
            return
        table = pa.Table.from_batches(table)
        tile = table["_tile"].to_numpy()
        for t in np.unique(tile):  # one, as every tile has a partition of its own
            own = table.filter(pa.array(tile == t))
            c, left, right = (own[k].to_numpy() for k in ("_c", "_left", "_right"))
            x = pc.list_flatten(own["_x"]).to_numpy().reshape(len(c), width)
            order = np.argsort(c, kind="stable")
            a, b = order[left[order]], order[right[order]]
            if not len(a) or not len(b):
                continue
            diagonal = bool((left & right).any())
            to_b, m_b = np.unique(c[b], return_counts=True)
            to_a, m_a = np.unique(c[a], return_counts=True)
            forth, back = np.zeros((len(a), len(to_b))), np.zeros((len(b), len(to_a)))
            for i in range(0, len(a), SLICE):
                for j in range(0, len(b), 4 * SLICE):
                    z = b[j : j + 4 * SLICE]
                    d = plain_distances(x[a[i : i + SLICE]], x[z])
                    seen, first = np.unique(c[z], return_index=True)
                    at = np.searchsorted(to_b, seen)
                    forth[i : i + SLICE, at] += np.add.reduceat(d, first, axis=1)
                    if not diagonal:
                        seen, first = np.unique(c[a[i : i + SLICE]], return_index=True)
                        back[j : j + 4 * SLICE, np.searchsorted(to_a, seen)] += np.add.reduceat(d, first, axis=0).T
            ids = own["_id"].combine_chunks()
            for at, summed, to, m in ((a, forth, to_b, m_b), *(() if diagonal else ((b, back, to_a, m_a),))):
                for k in range(len(to)):
                    columns = [c[at], np.full(len(at), to[k], np.int32), summed[:, k], np.full(len(at), m[k], np.int64)]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(at)), *[pa.array(x, from_pandas=True) for x in columns]], names=schema.names)

    sums = (
        placed.repartitionById(tiles, F.col("_tile"))
        .mapInArrow(sums, schema)
        .groupBy("_id", "_c", "_to")
        .agg(F.sum("_d").alias("_d"), F.sum("_m").alias("_m"))
    )
    own = F.col("_to") == F.col("_c")
    per_row = sums.groupBy("_id", "_c").agg(
        F.max(F.when(own, F.col("_d") / F.nullif(F.col("_m") - 1, F.lit(0)))).alias("a"),
        F.min(F.when(~own, F.col("_d") / F.col("_m"))).alias("b"),
    )
    score = F.when(F.col("a").isNull(), F.lit(0.0)).otherwise(
        F.coalesce((F.col("b") - F.col("a")) / F.nullif(F.greatest("a", "b"), F.lit(0.0)), F.lit(0.0))
    )
    total = per_row.agg(F.avg(F.when(F.col("b").isNotNull(), score)).alias("silhouette"), F.count_distinct(F.when(F.col("_c") >= 0, F.col("_c"))).alias("n_clusters"))
    return total.select(F.when(F.col("n_clusters") > 1, F.col("silhouette")).alias("silhouette"), "n_clusters")
