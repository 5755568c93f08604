"""Forests and boosted trees on rows whose features are binned once.

All trees of all forests (folds, feature sets, slices) grow together. As long as a node has more than LOCAL_ROWS rows, a level is one
pass over the rows: partitions add up histograms of the open nodes, Spark sums them by key, and every node's best split comes from its own
sums. Smaller nodes are finished where their rows are sent, one task for a node, or for a bundle of trees whose roots are that small.
Draws hang on the row, the tree and the node alone, so where a node is split does not change the tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from dayrisk.constants import SEED
from dayrisk.session import settled

BINS = 255
QUANTILE_ERROR = 0.0005
#: Nodes with at most so many rows are finished in one task.
LOCAL_ROWS = 200_000
#: Trees of one forest that a task grows when their roots are that small.
BUNDLE = 16
DEEPEST = 64
GAIN = 1e-9
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


#: Cumulated probabilities of 0, 1, 2 ... under the Poisson law of mean 1.
POISSON = np.cumsum(np.exp(-1) / np.cumprod([1.0, *range(1, 13)]))


def drawn(rows: np.ndarray, seed: int) -> np.ndarray:
    """How often each row is drawn into the tree ``seed``, about once on average."""
    return np.searchsorted(POISSON, mixed(mixed(rows.astype(U)) + U(seed)) / 2.0**64, "right").astype(float)


def feature_draw(paths: np.ndarray, seed: int, features: np.ndarray, most: int) -> np.ndarray:
    """For each node, named by its path from the root, ``most`` of the features."""
    if most >= len(features):
        return np.broadcast_to(features, (len(paths), len(features)))
    with np.errstate(over="ignore"):
        keys = mixed(mixed(paths + U(seed))[:, None] * U(2654435761) + np.arange(len(features)).astype(U))
    return features[np.argpartition(keys, most, axis=1)[:, :most]]


def child(paths: np.ndarray, side: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mixed(paths * U(2) + U(1 + side))


@dataclass(frozen=True)
class Plan:
    """A forest to grow: the column of row weights, features by number, trees, features tried at a node."""

    weight: int
    features: tuple[int, ...]
    trees: int
    tried: int
    seed: int

    def tree_seed(self, k: int) -> int:
        return (self.seed * 1_000_003 + self.weight * 7_919 + k + 1) & 0x7FFF_FFFF_FFFF


class Nodes:
    """Nodes of one tree; a leaf has no feature."""

    FIELDS = (("feature", np.int32), ("cut", np.int32), ("left", np.int32), ("right", np.int32), ("value", np.float64))

    def __init__(self):
        self.feature, self.cut, self.left, self.right, self.value = [], [], [], [], []

    def add(self, values) -> np.ndarray:
        first = len(self.feature)
        self.value += list(values)
        n = len(self.value) - first
        self.feature += [-1] * n
        self.cut += [0] * n
        self.left += [-1] * n
        self.right += [-1] * n
        return np.arange(first, first + n)

    def split(self, at: int, feature: int, cut: int, left: int, right: int) -> None:
        self.feature[at], self.cut[at], self.left[at], self.right[at] = feature, cut, left, right

    def arrays(self) -> dict[str, np.ndarray]:
        return {name: np.array(getattr(self, name), kind) for name, kind in self.FIELDS}


def best_splits(group: np.ndarray, slot_feature: np.ndarray, bins: np.ndarray, w: np.ndarray, s: np.ndarray, groups: int):
    """Best split of every group: ``(feature, cut, gain)``, -1 where none gains.

    Entries are (group, slot, bin) with weight and weighted target, in any order and repeated; ``slot_feature[group, slot]`` is a feature.
    The gain is that of the sum of squares over weight, which is Gini's for a 0/1 target.
    """
    slots = slot_feature.shape[1]
    feature, cut, gain = np.full(groups, -1), np.zeros(groups, np.int64), np.zeros(groups)
    size = groups * slots * 256
    code = group * 256 + bins
    if size <= 4 * len(code) or size <= 65_536:
        weight, total = np.bincount(code, w, size), np.bincount(code, s, size)
        key = np.flatnonzero(np.bincount(code, minlength=size))
        weight, total = weight[key], total[key]
    else:
        order = np.argsort(code)
        key, first = np.unique(code[order], return_index=True)
        weight, total = np.add.reduceat(w[order], first), np.add.reduceat(s[order], first)
    if not len(key):
        return feature, cut, gain
    block = key >> 8
    starts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
    own = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(key))))
    whole_w, whole_s = np.add.reduceat(weight, starts)[own], np.add.reduceat(total, starts)[own]
    cw, cs = np.cumsum(weight), np.cumsum(total)
    before = np.append(0, starts[1:] - 1)
    left_w = cw - np.where(starts > 0, cw[before], 0)[own]
    left_s = cs - np.where(starts > 0, cs[before], 0)[own]
    right_w, right_s = whole_w - left_w, whole_s - left_s
    inner = np.append(block[1:] == block[:-1], False) & (left_w > 0) & (right_w > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = np.where(inner, left_s**2 / left_w + right_s**2 / right_w - whole_s**2 / whole_w, -np.inf)
    node = block // slots
    firsts = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
    top = np.maximum.reduceat(value, firsts)
    hit = np.flatnonzero(value == np.repeat(top, np.diff(np.append(firsts, len(node)))))
    hit = hit[np.append(True, node[hit][1:] != node[hit][:-1])]  # the first of equals
    good = hit[value[hit] > GAIN * (1e-300 + np.abs(whole_s[hit]))]
    at = node[good]
    feature[at], cut[at], gain[at] = slot_feature[at, block[good] % slots], key[good] & 255, value[good]
    return feature, cut, gain


def grow_local(x: np.ndarray, s: np.ndarray, w: np.ndarray, features: np.ndarray, tried: int, seed: int, path: int = 1, deepest: int = DEEPEST, pure: bool = True) -> Nodes:
    """A tree on rows in memory: ``x`` are bins, ``s`` weighted targets, ``w`` weights. The root's path names its draws."""
    tree = Nodes()
    rows = np.flatnonzero(w > 0)
    total = w[rows].sum()
    ids = tree.add([s[rows].sum() / total if total > 0 else 0.0])
    place, paths = np.zeros(len(rows), np.int64), np.array([path], U)
    for _ in range(deepest):
        if not len(rows):
            break
        slots = feature_draw(paths, seed, features, tried)
        feature, cut = _splits_of(x, s, w, rows, place, slots)
        if tried < len(features) and (retry := np.flatnonzero(feature < 0)).size:  # as long as any feature parts the rows, a node is no leaf
            again = np.full(len(paths), -1)
            again[retry] = np.arange(len(retry))
            of = again[place] >= 0
            feature[retry], cut[retry] = _splits_of(x, s, w, rows[of], again[place[of]], np.broadcast_to(features, (len(retry), len(features))))
        parted = np.flatnonzero(feature >= 0)
        if not len(parted):
            break
        number = np.full(len(paths), -1)
        number[parted] = np.arange(len(parted))
        stay = number[place] >= 0
        rows, place = rows[stay], place[stay]
        right = x[rows, feature[place]] > cut[place]
        place = number[place] + right * len(parted)
        weight = np.bincount(place, w[rows], 2 * len(parted))
        value = np.bincount(place, s[rows], 2 * len(parted)) / weight
        new = tree.add(value.tolist())
        for i, at in enumerate(parted.tolist()):
            tree.split(int(ids[at]), int(feature[at]), int(cut[at]), int(new[i]), int(new[len(parted) + i]))
        paths = np.concatenate([child(paths[parted], 0), child(paths[parted], 1)])
        ids = new
        open_ = np.ones(len(new), bool)
        if pure:  # a node of one target is a leaf
            open_ = (value > 1e-12) & (value < 1 - 1e-12)
        number = np.full(len(new), -1)
        number[open_] = np.arange(int(open_.sum()))
        stay = number[place] >= 0
        rows, place, paths, ids = rows[stay], number[place[stay]], paths[open_], ids[open_]
    return tree


def _splits_of(x, s, w, rows, place, slots) -> tuple[np.ndarray, np.ndarray]:
    k = slots.shape[1]
    wanted = slots[place]
    group = (place[:, None] * k + np.arange(k)).ravel()
    bins = x[rows[:, None], wanted].ravel().astype(np.int64)
    feature, cut, _ = best_splits(group, slots, bins, np.repeat(w[rows], k), np.repeat(s[rows], k), len(slots))
    return feature, cut


def walk(nodes: dict[str, np.ndarray], x: np.ndarray, cuts: np.ndarray, start: int = 0) -> np.ndarray:
    """The node that each row ends in; ``cuts`` are compared with ``x``."""
    at = np.full(len(x), start)
    moving = np.arange(len(x))
    while len(moving):
        here = at[moving]
        feature = nodes["feature"][here]
        inner = feature >= 0
        moving, here, feature = moving[inner], here[inner], feature[inner]
        at[moving] = np.where(x[moving, feature] > cuts[here], nodes["right"][here], nodes["left"][here])
    return at


@dataclass(frozen=True)
class TreeEnsemble:
    """Trees with thresholds on the features themselves; a row goes left if its value is at most the threshold (null: right)."""

    features: tuple[str, ...]
    nodes: dict[str, np.ndarray]
    threshold: np.ndarray
    roots: np.ndarray
    base: float | None = None  # None: the mean of the trees is the probability, else log-odds are added up

    def probability(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for root in self.roots.tolist():
            total += self.nodes["value"][walk(self.nodes, x, self.threshold, root)]
        return total / len(self.roots) if self.base is None else 1 / (1 + np.exp(-(self.base + total)))

    def score(self, df: DataFrame) -> DataFrame:
        names = list(self.features)

        @F.pandas_udf("double")
        def p(x: pd.DataFrame) -> pd.Series:
            return pd.Series(self.probability(np.nan_to_num(x.to_numpy(dtype=float), nan=np.inf)))

        return df.withColumn("p", p(F.struct(*[F.col(f"`{n}`").cast("double") for n in names])))

    def table(self) -> pd.DataFrame:
        """One row per node, for storing."""
        roots = np.zeros(len(self.threshold), bool)
        roots[self.roots] = True
        return pd.DataFrame({"id": np.arange(len(self.threshold)), **{k: self.nodes[k] for k, _ in Nodes.FIELDS}, "threshold": self.threshold, "root": roots})

    @classmethod
    def of_table(cls, rows: pd.DataFrame, features: Sequence[str], base: float | None) -> TreeEnsemble:
        rows = rows.sort_values("id")
        return cls(tuple(features), {k: rows[k].to_numpy(kind) for k, kind in Nodes.FIELDS}, rows["threshold"].to_numpy(float), np.flatnonzero(rows["root"]), base)


def _ensemble(trees: list[dict[str, np.ndarray]], features: Sequence[str], edges: list[np.ndarray], base: float | None) -> TreeEnsemble:
    shift = np.cumsum([0] + [len(t["feature"]) for t in trees])
    joined = {k: np.concatenate([t[k] for t in trees]) for k, _ in Nodes.FIELDS}
    move = np.repeat(shift[:-1], np.diff(shift))
    for side in ("left", "right"):
        joined[side] = np.where(joined["feature"] >= 0, joined[side] + move, -1).astype(np.int32)
    threshold = np.array([edges[f][c] if f >= 0 else 0.0 for f, c in zip(joined["feature"].tolist(), joined["cut"].tolist())])
    return TreeEnsemble(tuple(features), joined, threshold, shift[:-1], base)


def bin_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Upper ends of the bins of each feature but the last: quantiles by mergeable sketches, a fixed number for each feature."""
    found = df.select(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)]).approxQuantile(
        [f"x{i}" for i in range(len(features))], [k / bins for k in range(1, bins)], QUANTILE_ERROR)
    return [np.unique(np.array(q, float)) for q in found]


def binned(df: DataFrame, features: Sequence[str], y: str, weights: Sequence[Column], edges: list[np.ndarray]) -> DataFrame:
    """Settled ``(rid, bins, y, w)`` with a byte for each feature; null is above all."""

    @F.pandas_udf("binary")
    def code(x: pd.DataFrame) -> pd.Series:
        values = np.nan_to_num(x.to_numpy(dtype=float), nan=np.inf)
        out = np.stack([np.searchsorted(e, values[:, i], "left") for i, e in enumerate(edges)], 1).astype(np.uint8)
        return pd.Series([r.tobytes() for r in out])

    columns = F.struct(*[F.col(f"`{f}`").cast("double").alias(f"x{i}") for i, f in enumerate(features)])
    w = F.array(*[F.coalesce(c.cast("double"), F.lit(0.0)) for c in weights])
    return settled(df.select(F.monotonically_increasing_id().alias("rid"), code(columns).alias("bins"), F.col(f"`{y}`").cast("double").alias("y"), w.alias("w")))


def _arrays(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    column = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
    x = np.frombuffer(b"".join(batch.column("bins").to_pylist()), np.uint8).reshape(batch.num_rows, -1)
    return column("rid"), x, column("y"), batch.column("w").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


HISTOGRAM = "tree int, node int, slot int, bin int, w double, s double, n long"


class _Growing:
    """Trees while their large nodes are split by passes over the rows."""

    def __init__(self, plan: Plan, k: int, rows: int):
        self.plan, self.seed, self.nodes = plan, plan.tree_seed(k), Nodes()
        self.nodes.add([0.0])
        self.paths, self.counts, self.leaf = {0: 1}, {0: rows}, set()

    def large(self) -> list[int]:
        return [n for n, c in self.counts.items() if c > LOCAL_ROWS and n not in self.leaf]

    def small(self) -> list[int]:
        return [n for n, c in self.counts.items() if c <= LOCAL_ROWS and n not in self.leaf]


def _level(rows: DataFrame, trees: list[_Growing]) -> None:
    """Split every large node of all trees by one pass."""
    todo = {t: np.array(g.large()) for t, g in enumerate(trees) if g.large()}
    state = {t: (trees[t].nodes.arrays(), trees[t].plan, trees[t].seed, nodes, np.array([trees[t].paths[int(n)] for n in nodes], U)) for t, nodes in todo.items()}

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rid, x, y, weights = _arrays(batch)
            for t, (nodes, plan, seed, large, paths) in state.items():
                w = weights[:, plan.weight] * drawn(rid, seed)
                place = np.full(len(nodes["feature"]), -1)
                place[large] = np.arange(len(large))
                at = place[walk(nodes, x, nodes["cut"])]
                own = np.flatnonzero((w > 0) & (at >= 0))
                slots = feature_draw(paths, seed, np.array(plan.features), plan.tried)
                k = slots.shape[1]
                code = ((at[own][:, None] * k + np.arange(k)) * 256 + x[own[:, None], slots[at[own]]]).ravel()
                key, inverse = np.unique(code, return_inverse=True)
                sums = [np.bincount(inverse, np.repeat(v[own], k), len(key)) for v in (w, w * y, np.ones(len(w)))]
                block = key >> 8
                made = [np.full(len(key), t), large[block // k], block % k, key & 255, sums[0], sums[1], sums[2].astype(np.int64)]
                kinds = [pa.int32()] * 4 + [pa.float64()] * 2 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(made, kinds)], names=[f.split()[0] for f in HISTOGRAM.split(", ")])

    def choose(part: pd.DataFrame) -> pd.DataFrame:
        t, node = int(part["tree"].iloc[0]), int(part["node"].iloc[0])
        _, plan, seed, large, paths = state[t]
        slots = feature_draw(paths[large == node], seed, np.array(plan.features), plan.tried)
        bins, w, s = part["bin"].to_numpy(np.int64), part["w"].to_numpy(), part["s"].to_numpy()
        feature, cut, _ = best_splits(part["slot"].to_numpy(np.int64), slots, bins, w, s, 1)
        used = part["slot"].to_numpy() == (int(np.flatnonzero(slots[0] == feature[0])[0]) if feature[0] >= 0 else part["slot"].iloc[0])
        left = used & (bins <= cut[0])
        sums = [float(v[m].sum()) for m in (left, used & ~left) for v in (w, s, part["n"].to_numpy())]
        return pd.DataFrame([(t, node, int(feature[0]), int(cut[0]), *sums)], columns=SPLIT_NAMES)

    parts = rows.mapInArrow(histograms, HISTOGRAM).groupBy("tree", "node", "slot", "bin").agg(F.sum("w").alias("w"), F.sum("s").alias("s"), F.sum("n").alias("n"))
    found = {(r["tree"], r["node"]): r for r in parts.groupBy("tree", "node").applyInPandas(choose, SPLITS).collect()}
    for t, nodes in todo.items():
        g = trees[t]
        for node in nodes.tolist():
            r = found.get((t, node))
            if r is None or r["feature"] < 0:
                g.leaf.add(node)
                if r is not None:
                    g.nodes.value[node] = (r["s0"] + r["s1"]) / (r["w0"] + r["w1"])
                continue
            new = g.nodes.add([r["s0"] / r["w0"], r["s1"] / r["w1"]]).tolist()
            g.nodes.split(node, r["feature"], r["cut"], *new)
            path = np.array([g.paths.pop(node)], U)
            del g.counts[node]
            for side, n in enumerate(new):
                g.paths[n], g.counts[n] = int(child(path, side)[0]), int(r[f"n{side}"])
                if not 1e-12 < g.nodes.value[n] < 1 - 1e-12:
                    g.leaf.add(n)


SPLITS = "tree int, node int, feature int, cut int, w0 double, s0 double, n0 double, w1 double, s1 double, n1 double"
SPLIT_NAMES = [f.split()[0] for f in SPLITS.split(", ")]


def _finish(rows: DataFrame, trees: list[_Growing]) -> None:
    """Send the rows of small nodes to tasks that finish them; trees of one forest whose roots are small share a task."""
    bundles: dict[tuple, list[int]] = {}
    for t, g in enumerate(trees):
        for node in g.small():
            key = (g.plan.weight, g.plan.features, t // BUNDLE) if node == 0 else (t, node)
            bundles.setdefault(key, []).append(t)
    if not bundles:
        return
    jobs = [(ts, 0 if len(key) == 3 else key[1]) for key, ts in bundles.items()]
    seeds, plans = [g.seed for g in trees], [g.plan for g in trees]
    paths = [{n: g.paths[n] for n in g.small()} for g in trees]
    state = {ts[0]: trees[ts[0]].nodes.arrays() for ts, node in jobs if node}
    whole = {j: plans[ts[0]].weight for j, (ts, node) in enumerate(jobs) if not node}
    apart: dict[int, dict[int, int]] = {}
    for j, (ts, node) in enumerate(jobs):
        if node:
            apart.setdefault(ts[0], {})[node] = j

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(j, own):
            return pa.RecordBatch.from_arrays([pa.array(np.broadcast_to(j, len(own)), pa.int32()), *(batch.column(c).take(pa.array(own)) for c in ("rid", "bins", "y", "w"))], names=["job", "rid", "bins", "y", "w"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rid, x, _, weights = _arrays(batch)
            for j, k in whole.items():
                if len(own := np.flatnonzero(weights[:, k] > 0)):
                    yield out(j, own)
            for t, places in apart.items():
                w = weights[:, plans[t].weight] * drawn(rid, seeds[t])
                job = np.full(len(state[t]["feature"]), -1)
                job[list(places)] = list(places.values())
                at = job[walk(state[t], x, state[t]["cut"])]
                if len(own := np.flatnonzero((w > 0) & (at >= 0))):
                    yield out(at[own], own)

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        j = int(part["job"].iloc[0])
        ts, node = jobs[j]
        part = part.sort_values("rid")
        x = np.frombuffer(b"".join(part["bins"]), np.uint8).reshape(len(part), -1)
        weights, y, rid = np.stack(part["w"].to_list()), part["y"].to_numpy(), part["rid"].to_numpy()
        out = []
        for t in ts:
            plan = plans[t]
            w = weights[:, plan.weight] * drawn(rid, seeds[t])
            tree = grow_local(x, w * y, w, np.array(plan.features), plan.tried, seeds[t], paths[t][node])
            out.append((t, node, *(v.tobytes() for v in tree.arrays().values())))
        return pd.DataFrame(out, columns=["tree", "node", *(n for n, _ in Nodes.FIELDS)])

    sent = rows.mapInArrow(send, "job int, rid long, bins binary, y double, w array<double>").repartition(len(jobs), "job")
    grown = sent.groupBy("job").applyInPandas(grow, "tree int, node int, " + ", ".join(f"{n} binary" for n, _ in Nodes.FIELDS))
    for r in grown.collect():
        nodes, sub = trees[r["tree"]].nodes, {n: np.frombuffer(r[n], kind) for n, kind in Nodes.FIELDS}
        new = np.append(r["node"], nodes.add(sub["value"][1:].tolist()))
        nodes.value[r["node"]] = float(sub["value"][0])
        for i in np.flatnonzero(sub["feature"] >= 0).tolist():
            nodes.split(int(new[i]), int(sub["feature"][i]), int(sub["cut"][i]), int(new[sub["left"][i]]), int(new[sub["right"][i]]))


def class_weights(df: DataFrame, y: str, members: Sequence[Column]) -> list[Column]:
    """For every member (a condition on rows) the weights ``n / (2 n_class)`` of its rows, 0 elsewhere."""
    inside = [F.coalesce(m.cast("boolean"), F.lit(False)) for m in members]
    target = F.col(f"`{y}`").cast("int")
    row = df.agg(*[F.count_if(m & (target == k)).alias(f"n{i}_{k}") for i, m in enumerate(inside) for k in (0, 1)]).first()
    out = []
    for i, m in enumerate(inside):
        n = [row[f"n{i}_{k}"] for k in (0, 1)]
        if not sum(n):
            raise ValueError("no rows to fit")
        classes = sum(c > 0 for c in n)
        out.append(F.when(m & (target == 1), F.lit(sum(n) / (classes * max(1, n[1])))).when(m & (target == 0), F.lit(sum(n) / (classes * max(1, n[0])))).otherwise(0.0))
    return out


def grow_forests(
    df: DataFrame, features: Sequence[str], y: str, members: Sequence[Column], sets: Sequence[Sequence[str]] | None = None, trees: int = 300,
    balanced: bool = True, seed: int = SEED,
) -> list[TreeEnsemble]:
    """A forest of deep trees for every member, or for every (member, feature set), over the same binned rows.

    Every tree draws its rows (about once each) and the square root of the features at a node; depth is bounded by DEEPEST only.
    """
    edges = bin_edges(df, features)
    weights = class_weights(df, y, members) if balanced else [F.coalesce(m.cast("double"), F.lit(0.0)) for m in members]
    rows = binned(df.where(F.col(f"`{y}`").isNotNull()), features, y, weights, edges)
    place = {f: i for i, f in enumerate(features)}
    plans = [
        Plan(k, tuple(place[f] for f in own), trees, max(1, int(len(own) ** 0.5)), seed) for k in range(len(members)) for own in (sets or [features])
    ]
    counts = rows.agg(*[F.count_if(F.get("w", F.lit(k)) > 0).alias(f"n{k}") for k in range(len(members))]).first()
    growing = [_Growing(plan, k, counts[f"n{plan.weight}"]) for plan in plans for k in range(plan.trees)]
    while any(g.large() for g in growing):
        _level(rows, growing)
    _finish(rows, growing)
    done = iter(growing)
    return [_ensemble([next(done).nodes.arrays() for _ in range(plan.trees)], features, edges, None) for plan in plans]


def grow_boosted(
    df: DataFrame, features: Sequence[str], y: str, members: Sequence[Column], rounds: int = 200, depth: int = 3, step: float = 0.1
) -> list[TreeEnsemble]:
    """Boosted shallow trees for every member, unweighted: log-loss, leaves by one Newton step.

    Rounds follow each other, so a member is fitted in one task; one with more than LOCAL_ROWS rows is refused.
    """
    edges = bin_edges(df, features)
    rows = binned(df.where(F.col(f"`{y}`").isNotNull()), features, y, [F.coalesce(m.cast("double"), F.lit(0.0)) for m in members], edges)
    counts = rows.agg(*[F.count_if(F.get("w", F.lit(k)) > 0).alias(f"n{k}") for k in range(len(members))]).first()
    if max(counts) > LOCAL_ROWS or not min(counts):
        raise ValueError("no rows to fit" if not min(counts) else f"a boosted member has at most {LOCAL_ROWS} rows")

    def boost(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rid")
        x = np.frombuffer(b"".join(part["bins"]), np.uint8).reshape(len(part), -1)
        target, w = part["y"].to_numpy(), np.ones(len(part))
        share = np.clip(target.mean(), 1e-9, 1 - 1e-9)
        base = float(np.log(share / (1 - share)))
        total, out, everything = np.full(len(part), base), [], np.arange(x.shape[1])
        for k in range(rounds):
            p = 1 / (1 + np.exp(-total))
            error, bend = target - p, p * (1 - p)
            tree = grow_local(x, error, w, everything, len(everything), k, deepest=depth, pure=False).arrays()
            leaf = walk(tree, x, tree["cut"])
            up, down = (np.bincount(leaf, v, len(tree["value"])) for v in (error, bend))
            tree["value"] = step * np.where(down > 1e-150, up / np.maximum(down, 1e-150), 0.0)
            total += tree["value"][leaf]
            out.append((int(part["job"].iloc[0]), k, base, *(v.tobytes() for v in tree.values())))
        return pd.DataFrame(out, columns=["job", "round", "base", *(n for n, _ in Nodes.FIELDS)])

    own = rows.select(F.posexplode("w").alias("job", "in"), "rid", "bins", "y").where(F.col("in") > 0).drop("in").repartition(len(members), "job")
    grown = own.groupBy("job").applyInPandas(boost, "job int, round int, base double, " + ", ".join(f"{n} binary" for n, _ in Nodes.FIELDS))
    by_job: dict[int, list] = {}
    for r in sorted(grown.collect(), key=lambda r: (r["job"], r["round"])):
        by_job.setdefault(r["job"], []).append(r)
    return [
        _ensemble([{n: np.frombuffer(r[n], kind) for n, kind in Nodes.FIELDS} for r in by_job[j]], features, edges, by_job[j][0]["base"]) for j in range(len(members))
    ]
