"""Near-duplicates by BagMinHash: weighted Jaccard of multisets of five-word shingles.

Signatures come from Poisson processes over dyadic intervals of the weights, so that two signatures agree in a component with
exactly the weighted Jaccard similarity of the multisets. Documents with the same multiset collapse first. Bands give buckets; inside a
bucket no list of all pairs is made: first every member meets the bucket's smallest member, then members that are still apart meet in
bounded blocks, most alike first, and only the links that join them leave the block. Every link is verified on the multisets
themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from dayrisk.llm.common import dealt_join, free_name, mixed, narrowed, settled, split_words, with_arrow_columns, word_hashes
from dayrisk.operators.components import connected_components, followed

SIMILARITY = 0.8
SHINGLE = 5
ROWS = 5
BANDS = 32
SIZE = ROWS * BANDS
#: Signatures that agree in fewer components than this have a similarity of 0.8 or more in 1 of 70 000 cases (4.2 deviations).
LEAST_EQUAL = int(SIZE * SIMILARITY - 4.2 * (SIZE * SIMILARITY * (1 - SIMILARITY)) ** 0.5)
BLOCK = 1024
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_SECOND = np.uint64(0xD1B54A32D192ED03)


def shingle_multiset(words: np.ndarray, length: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and their counts; a text with fewer words is one shingle of all its words."""
    n = len(words)
    width = min(length, n)
    if not n:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    total = np.full(n - width + 1, np.uint64(width), np.uint64)
    for i in range(width):
        total = total * _GOLDEN + words[i : n - width + 1 + i]
    keys, counts = np.unique(mixed(total), return_counts=True)
    return keys, counts.astype(np.int64)


def signature(keys: np.ndarray, counts: np.ndarray, size: int = SIZE) -> np.ndarray:
    """BagMinHash of a multiset: for each component the identity of the earliest point, as an unsigned 64-bit number.

    The weight axis of an element is cut into [0, 1), [1, 2), [2, 4), [4, 8) ...; each interval carries a Poisson process whose rate
    is its length and whose points fall on a random component and place. Points above the element's weight do not count. A process is
    followed only while it can still come before the latest first point of the signature.
    """
    levels = [np.zeros(len(keys), np.int64)]
    owners = [np.arange(len(keys))]
    top, level = int(counts.max()), 1
    while 1 << (level - 1) < top:
        own = np.flatnonzero(counts > 1 << (level - 1))
        owners.append(own)
        levels.append(np.full(len(own), level))
        level += 1
    owner, level = np.concatenate(owners), np.concatenate(levels)
    low = np.where(level == 0, 0.0, 2.0 ** (level - 1)).astype(np.float32)
    width = np.maximum(low, np.float32(1))
    weight = counts[owner].astype(np.float32)
    partly = bool((low + width > weight).any())  # else every point counts
    seed = mixed(keys[owner] + level.astype(np.uint64) * _SECOND)
    clock = np.zeros(len(owner), np.float32)
    first = np.full(size, np.inf, np.float32)
    tag = np.zeros(size, np.uint64)
    step, expected = 0, size * (np.log(size) + 1.5)
    while len(owner):
        points = int(np.clip(np.ceil(expected / len(owner)) + 1, 1, 2048)) if not step else max(1, min(256, size // len(owner)))
        drawn = mixed(seed[:, None] + np.arange(step + 1, step + points + 1, dtype=np.uint64) * _GOLDEN)
        # bits 40-63 give the waiting time, 20-39 the component, 0-19 the place in the interval
        gaps = -np.log(((drawn >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24))
        times = clock[:, None] + np.cumsum(gaps / width[:, None], axis=1, dtype=np.float32)
        component = ((((drawn >> np.uint64(20)) & np.uint64(0xFFFFF)) * np.uint64(size)) >> np.uint64(20)).astype(np.int64)
        if partly:
            place = low[:, None] + (drawn & np.uint64(0xFFFFF)).astype(np.float32) * np.float32(2.0**-20) * width[:, None]
            counted = place < weight[:, None]
            t, c, ids = times[counted], component[counted], drawn[counted]
        else:
            t, c, ids = times.ravel(), component.ravel(), drawn.ravel()
        np.minimum.at(first, c, t)
        won = t == first[c]
        tag[c[won]] = ids[won]
        clock = times[:, -1]
        step += points
        on = np.flatnonzero(clock < first.max())
        owner, low, width, weight, seed, clock = owner[on], low[on], width[on], weight[on], seed[on], clock[on]
    return tag


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Overlap of two multisets: sum of the smaller counts by sum of the larger."""
    at = np.searchsorted(a[0], b[0])
    at[at == len(a[0])] = 0
    hit = a[0][at] == b[0] if len(a[0]) else np.zeros(len(b[0]), bool)
    both = int(np.minimum(a[1][at[hit]], b[1][hit]).sum())
    return both / max(1, int(a[1].sum()) + int(b[1].sum()) - both)



def _multisets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    words = split_words(texts)
    hashes = word_hashes(words.unique)
    for i in range(len(words)):
        yield shingle_multiset(hashes[words.of(i)])


def _signed(texts: pa.Array) -> list:
    """Multiset fingerprint, number of shingles, band keys and one byte of every signature component."""
    fps, sizes, bands, sigs = [], [], [], []
    salt = np.arange(1, BANDS + 1, dtype=np.uint64) * _SECOND
    for text, (keys, counts) in zip(texts, _multisets(texts)):
        if not len(keys):  # without words only identical texts are copies
            fps.append(b"-" + xxhash.xxh3_128_digest(text.as_py().encode()))
            sizes.append(0)
            bands.append([])
            sigs.append(b"")
            continue
        tags = signature(keys, counts)
        key = salt.copy()
        for column in tags.reshape(BANDS, ROWS).T:
            key = mixed(key * _GOLDEN + column)
        fps.append(xxhash.xxh3_128_digest(keys.tobytes() + counts.tobytes()))
        sizes.append(int(counts.sum()))
        bands.append(key.view(np.int64).tolist())
        sigs.append((tags & np.uint64(255)).astype(np.uint8).tobytes())
    return [pa.array(fps, pa.binary()), pa.array(sizes, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sigs, pa.binary())]


SIGNED = [
    T.StructField("fp", T.BinaryType()), T.StructField("n", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sig", T.BinaryType()),
]
BAG = [T.StructField("keys", T.BinaryType()), T.StructField("counts", T.BinaryType())]
PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _bags(texts: pa.Array) -> list:
    bags = [Bag.write(*b) for b in _multisets(texts)]
    return [pa.array([k for k, _ in bags], pa.binary()), pa.array([c for _, c in bags], pa.binary())]


def _verified(pairs: DataFrame, bags: DataFrame) -> DataFrame:
    """The pairs whose multisets overlap by SIMILARITY or more."""

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            pairs = zip(rows["keys"], rows["counts"], rows["keys_b"], rows["counts_b"])
            good = [weighted_jaccard(Bag.read(*x[:2]), Bag.read(*x[2:])) >= SIMILARITY for x in pairs]
            yield rows.loc[good, ["a", "b"]]

    other = bags.select(F.col("node").alias("b"), F.col("keys").alias("keys_b"), F.col("counts").alias("counts_b"))
    return pairs.join(other, "b").join(bags.withColumnRenamed("node", "a"), "a").mapInPandas(check, PAIR)


class Bag:
    """A shingle multiset as stored: sorted keys and counts of 32 bits each.

    The shorter keys halve what the verification moves; two texts of 20 000 words share 0.1 shingles by chance.
    """

    @staticmethod
    def write(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
        short, at = np.unique((keys >> np.uint64(32)).astype(np.uint32), return_inverse=True)
        return short.tobytes(), np.bincount(at, counts, len(short)).astype(np.uint32).tobytes()

    @staticmethod
    def read(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(keys, np.uint32), np.frombuffer(counts, np.uint32).astype(np.int64)


def block_links(rows: list[tuple], band: int) -> list[tuple[int, int]]:
    """Verified links of one block of a bucket, enough to join what is linked: pairs most alike come first, and a pair whose
    members are joined already is not looked at again. ``rows``: (node, label, lead, n, side, sig, keys, counts, bands).

    A pair is looked at in the first band whose key it shares, unless one of the two is the lead, whom all members have met before.
    """
    rows = sorted(rows, key=lambda r: r[0])
    node, label, lead, n, side = (np.array(x, np.int64) for x in list(zip(*rows))[:5])
    sigs = np.stack([np.frombuffer(r[5], np.uint8) for r in rows])
    bands = np.stack([np.asarray(r[8], np.int64) for r in rows])
    crossing = bool((side != side[0]).any())
    found = []
    for i in range(len(rows) - 1):
        open_ = (label[i + 1 :] != label[i]) & (np.minimum(n[i + 1 :], n[i]) >= SIMILARITY * np.maximum(n[i + 1 :], n[i])) & (node[i] != lead[i + 1 :])
        if crossing:
            open_ &= side[i + 1 :] != side[i]
        after = np.flatnonzero(open_) + i + 1
        if not len(after):
            continue
        agree = (sigs[after] == sigs[i]).sum(axis=1)
        alike = agree >= LEAST_EQUAL
        after, agree = after[alike], agree[alike]
        first = np.argmax(bands[after] == bands[i], axis=1) == band
        found += [(-int(s), i, int(j)) for s, j in zip(agree[first], after[first])]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    links, bags = [], {}
    for _, i, j in sorted(found):
        p, q = root(int(label[i])), root(int(label[j]))
        if p == q:
            continue
        for k in (i, j):
            if k not in bags:
                bags[k] = Bag.read(*rows[k][6:8])
        if weighted_jaccard(bags[i], bags[j]) >= SIMILARITY:
            parent[q] = p
            links.append((int(node[i]), int(node[j])))
    return links


def _links_apart(buckets: DataFrame, labels: DataFrame, starred: DataFrame, signed: DataFrame, bags: DataFrame) -> DataFrame:
    """Links between members with different labels inside a bucket; a large bucket is cut into pairs of blocks of bounded size.

    A member with a link to its lead in ``starred(a, b)`` goes under the lead's label there.
    """
    met = starred.groupBy(F.col("b").alias("node")).agg(F.collect_set("a").alias("met"))  # at most BANDS leads
    led = F.coalesce(F.array_contains("met", F.col("lead.node")), F.lit(False))
    members = buckets.where("size > 2").join(labels.join(met, "node", "left"), "node").withColumn("met", led)
    own_label, lead_label = F.when(~F.col("met"), F.col("label")), F.when(F.col("node") == F.col("lead.node"), F.col("label"))
    open_ = members.groupBy("key").agg(F.min(own_label).alias("lo"), F.max(own_label).alias("hi"), F.max(lead_label).alias("lead_label")).where("lo <> hi")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    placed = (
        members.join(open_.select("key", "lead_label"), "key")
        .withColumn("label", F.when(F.col("met"), F.col("lead_label")).otherwise(F.col("label")))
        .withColumn("blocks", F.ceil(F.col("size") / BLOCK).cast("int"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    rows = (
        placed.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "band", "node", "label", F.col("lead.node").alias("lead"), "n", F.col("own").alias("side"))
        .join(signed.select("node", "sig", "bands"), "node")
        .withColumn("bands", F.slice("bands", F.lit(1), F.col("band") + 1))  # later bands do not count here
        .join(bags, "node")
    )
    order = ["key", "i", "j"]
    fields = ["node", "label", "lead", "n", "side", "sig", "keys", "counts", "bands"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, band, waiting = None, 0, []
        for batch in batches:
            out = []
            for group, number, row in zip(zip(*(batch[c] for c in order)), batch["band"], zip(*(batch[c] for c in fields))):
                if group != at:
                    if len(waiting) > 1:
                        out += block_links(waiting, band)
                    at, band, waiting = group, int(number), []
                waiting.append(row)
            yield pd.DataFrame(out, columns=["a", "b"]).astype("int64")
        if len(waiting) > 1:
            yield pd.DataFrame(block_links(waiting, band), columns=["a", "b"]).astype("int64")

    return rows.repartition(*order).sortWithinPartitions(*order).mapInPandas(run, PAIR).distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs whose members have different labels."""
    other = labels.select(F.col("node").alias("b"), F.col("label").alias("_b"))
    own = labels.select(F.col("node").alias("a"), F.col("label").alias("_a"))
    return pairs.join(own, "a").join(other, "b").where("_a <> _b").select("a", "b", "_a", "_b")


def _joined(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``(node, label)`` after the links have joined labelled components; a label is the smallest node of its component."""
    ends = settled(_apart(links.select("a", "b"), labels).select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct())
    if ends.isEmpty():
        return labels
    roots = connected_components(ends.select(F.explode(F.array("a", "b")).alias("node")).distinct(), ends)
    named = roots.where("node <> label").select(F.col("node").alias("label"), F.col("label").alias("_root"))
    return settled(labels.join(named, "label", "left").select("node", F.coalesce("_root", "label").alias("label")))


def _classes(signed: DataFrame, named: DataFrame) -> DataFrame:
    """``(node, label)`` for the nodes that share a bucket with another multiset."""
    firsts = signed.where("n > 0").groupBy("fp").agg(F.min(F.struct("node", "n", "bands")).alias("_first")).select("_first.*")
    bands = firsts.select("node", "n", F.posexplode("bands").alias("band", "key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min(F.struct("node", "n")).alias("lead")).where("size > 1")
    shared = settled(shared)
    buckets = settled(dealt_join(bands, shared, ["key"], "size", "node").select("key", "band", "node", "n", "size", "lead"))
    nodes = settled(buckets.select("node").distinct())
    keys = signed.join(nodes, "node", "left_semi").select("node", "doc_id", "text_key")
    same = keys["doc_id"].eqNullSafe(named["doc_id"]) & (keys["text_key"] == named["text_key"])
    texts = named.join(keys, same).select("node", named["text"]).dropDuplicates(["node"])
    bags = settled(with_arrow_columns(texts, _bags, BAG, carry=["node"]))
    near = F.least("n", "lead.n") >= SIMILARITY * F.greatest("n", "lead.n")
    stars = buckets.where((F.col("node") != F.col("lead.node")) & near).select(F.col("lead.node").alias("a"), F.col("node").alias("b")).distinct()
    # a member meets its smallest lead first, then the leads that it is still apart from; until all links are known, labels only tell
    # which pairs need no look, so a member goes under its lead's lead and components are found once, at the end
    first = settled(_verified(stars.groupBy("b").agg(F.min("a").alias("a")), bags))
    leads = first.select(F.col("b").alias("node"), F.col("a").alias("new"))
    parents = nodes.join(leads, "node", "left").select("node", F.coalesce("new", "node").alias("new"))
    labels = settled(followed(parents).select("node", F.col("new").alias("label")))
    links = first.union(settled(_verified(_apart(stars, labels), bags)))
    return _joined(labels, links.union(_links_apart(buckets, labels, links, signed, bags)))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, class_id, class_size, kept, text_key)``: one row per row of ``docs``.

    Classes are the components of links between texts whose multisets of five-word shingles (lower case, runs of letters,
    digits and _) have a weighted Jaccard similarity of 0.8 or more; ``class_id`` is the smallest id of the class, ``kept`` its one
    document that stays. A text of fewer than five words is one shingle; without words only identical texts are in one class. Null text
    counts as empty. Candidates come from 32 bands of 5 components: a pair at 0.8 shares none in 3 of a million cases.
    ``text_key`` tells rows with the same id apart.
    """
    clean = F.coalesce(F.col("text"), F.lit(""))
    named = narrowed(docs, id_col, text).toDF("doc_id", "text").withColumn("text", clean).withColumn("text_key", F.xxhash64("text"))
    signed = settled(with_arrow_columns(named, _signed, SIGNED, carry=["doc_id", "text_key"]).withColumn("node", F.monotonically_increasing_id()))
    labels = _classes(signed, named)
    members = signed.select("doc_id", "text_key", "fp", "node")
    firsts = members.groupBy("fp").agg(F.min("node").alias("first"), F.min(F.struct("doc_id", "node")).alias("least"), F.count(F.lit(1)).alias("copies"))
    classed = firsts.join(labels.withColumnRenamed("node", "first"), "first", "left").withColumn("label", F.coalesce("label", "first"))
    wholes = classed.groupBy("label").agg(F.min("least").alias("least"), F.sum("copies").alias("class_size"))
    by_fp = settled(classed.select("fp", "label", "copies").join(wholes, "label").select("fp", "least", "class_size", "copies"))
    return dealt_join(members, by_fp, ["fp"], "copies", "node").select(
        "doc_id",
        F.col("least.doc_id").alias("class_id"),
        "class_size",
        (F.col("least.node") == F.col("node")).alias("kept"),
        "text_key",
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of every class, with all its columns."""
    key, own_id = free_name(docs, "_text_key"), free_name(docs, "_id")
    kept = near_groups(docs, id_col, text).where("kept").select(F.col("doc_id").alias(own_id), F.col("text_key").alias(key))
    own = docs.withColumn(key, F.xxhash64(F.coalesce(F.col(f"`{text}`"), F.lit("")))).withColumn(own_id, F.col(f"`{id_col}`"))
    same = own[own_id].eqNullSafe(kept[own_id]) & (own[key] == kept[key])
    return own.join(kept, same, "left_semi").dropDuplicates([own_id, key]).select(*[F.col(f"`{c}`") for c in docs.columns])
