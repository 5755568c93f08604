"""Merkle manifest of a dataset with a proof for every row.

Rows of a group are its leaves, by rank. A node is labelled with the interval ``[lo, hi)`` of leaf ranks that it covers, so an ancestor of
a leaf is a node whose interval contains its rank, and the siblings on the way to the root are what is left of a parent's interval without
the child that contains the rank.

Levels are resolved in bands of ``BAND``: a bucket of ``FAN ** BAND`` consecutive entries is a small tree of its own, its top is an
entry of the next band. Entries meet the nodes of their bucket in one containment join, so no key of a join or of a
grouping has more than ``FAN ** BAND`` entries, however large a group is. Only the number of rows of the largest group and
nothing else of the tables reaches the driver.

``H`` is SHA-256 in lowercase hex of concatenated texts; digests go in as hex text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from dayrisk.llm.common import narrowed, settled

FAN = 3
BAND = 4
BUCKET = FAN**BAND
#: Rows of a sorted partition that get their offset from one row of the table of offsets.
STRETCH = 10_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<level:int, left:string, right:string>>"


def framed(value: Column) -> Column:
    """``-`` for null, else the byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """The digest of a row's values; two rows have the same only if all values are the same."""
    return F.sha2(F.concat(*map(framed, values)), 256)


def ranked(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """Add ``rank`` (from 0) by ``order`` within ``tree`` and ``n``, the rows of the tree; a tree is not gathered.

    Rows are sorted in ranges; ranks are places in a partition plus the counts of the partitions before it.
    """
    placed = settled(
        rows.repartitionByRange(tree, *order)
        .sortWithinPartitions(tree, *order)
        .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("_at"))
        .withColumn("_stretch", F.expr(f"_at div {STRETCH}"))
    )
    spans = placed.groupBy(tree, "_part").agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"), F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    based = spans.select(
        "*", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_base"), F.sum("_n").over(whole).alias("n"),
    )
    bases = based.select(tree, "_part", "_base", "n", F.expr(f"explode(sequence(_first div {STRETCH}, _last div {STRETCH}))").alias("_stretch"))
    joined = placed.join(bases, [tree, "_part", "_stretch"])
    return joined.withColumn("rank", F.col("_base") + F.col("_at")).drop("_part", "_stretch", "_at", "_base")


def _parents(digests: Column) -> Column:
    """H of each run of ``FAN`` digests."""
    starts = F.sequence(F.lit(0), F.floor((F.size(digests) - 1) / FAN).cast("int"))
    return F.transform(starts, lambda i: F.sha2(F.array_join(F.slice(digests, i * FAN + 1, FAN), ""), 256))


def bucket_trees(entries: DataFrame) -> DataFrame:
    """``(tree, bucket, n, l0 .. lBAND, top)``: the levels over each bucket of entries; a level that the tree does not reach is null.

    ``entries`` has ``(tree, rank, n, digest)``; a level is there as long as the one below it has more than one node in the whole tree.
    """
    own = F.sort_array(F.collect_list(F.struct("rank", "digest")))
    out = entries.groupBy("tree", _bucket().alias("bucket"), "n").agg(F.transform(own, lambda x: x["digest"]).alias("l0"))
    for k in range(1, BAND + 1):
        out = out.withColumn(f"l{k}", F.when(F.col("n") > FAN ** (k - 1), _parents(F.col(f"l{k - 1}"))))
    return out.withColumn("top", F.coalesce(*[F.col(f"l{k}") for k in range(BAND, -1, -1)])[0])


def _bucket() -> Column:
    return F.expr(f"rank div {BUCKET}")


def intervals(trees: DataFrame) -> DataFrame:
    """``(tree, bucket, level, lo, hi, children)``: every inner node of the buckets with its interval and its children's."""

    def nodes(k: int) -> Column:
        wide, narrow = FAN**k, FAN ** (k - 1)

        def node(_, i):
            lo = F.col("bucket") * BUCKET + i * wide
            below = F.transform(
                F.slice(F.col(f"l{k - 1}"), i * FAN + 1, FAN),
                lambda digest, j: F.struct((lo + j * narrow).alias("lo"), F.least(lo + (j + 1) * narrow, F.col("n")).alias("hi"), digest.alias("digest")),
            )
            return F.struct(F.lit(k).alias("level"), lo.alias("lo"), F.least(lo + wide, F.col("n")).alias("hi"), below.alias("children"))

        return F.coalesce(F.transform(F.col(f"l{k}"), node), F.array())

    return trees.select("tree", "bucket", F.inline(F.concat(*[nodes(k) for k in range(1, BAND + 1)])))


@dataclass
class Band:
    entries: DataFrame  # (tree, rank, n, digest[, row])
    trees: DataFrame  # bucket_trees(entries), settled
    level: int  # of the entries


def grow(entries: DataFrame) -> list[Band]:
    """All bands over the entries, the lowest first."""
    largest, bands = entries.agg(F.max("n")).first()[0] or 0, []
    while True:
        bands.append(Band(entries, settled(bucket_trees(entries)), BAND * len(bands)))
        if largest <= BUCKET:
            return bands
        largest = -(-largest // BUCKET)
        inner = bands[-1].trees.where(F.col("n") > BUCKET)
        entries = inner.select("tree", F.col("bucket").alias("rank"), F.ceil(F.col("n") / BUCKET).alias("n"), F.col("top").alias("digest"))


def tops(bands: list[Band]) -> DataFrame:
    """``(tree, digest)``: the last node of every tree."""
    out = None
    for band in bands:
        own = band.trees.where(F.col("n") <= BUCKET).select("tree", F.col("top").alias("digest"))
        out = own if out is None else out.unionByName(own)
    return out


def with_paths(bands: list[Band], above: DataFrame | None = None) -> DataFrame:
    """The lowest entries with ``path``, the siblings on the way up, and ``roots``, what ``above`` has for the tree and the tree's top.

    ``above`` is ``(tree, path, roots)``, the way on from the top of each tree.
    """
    carried = None
    for band in reversed(bands):
        last = band.trees.where(F.col("n") <= BUCKET).select("tree", "bucket", F.col("top").alias("digest"))
        if above is None:
            onward = last.select("tree", "bucket", F.array().cast(PATH).alias("onward"), F.array("digest").alias("roots"))
        else:
            onward = last.join(above, "tree").select("tree", "bucket", F.col("path").alias("onward"), F.concat(F.array("digest"), "roots").alias("roots"))
        if carried is not None:
            onward = onward.unionByName(carried.select("tree", F.col("rank").alias("bucket"), F.col("path").alias("onward"), "roots"))
        nodes = intervals(band.trees).withColumnsRenamed({"tree": "_tree", "bucket": "_bucket"})
        entries = band.entries.withColumn("bucket", _bucket())
        inside = (F.col("tree") == F.col("_tree")) & (F.col("bucket") == F.col("_bucket")) & (F.col("lo") <= F.col("rank")) & (F.col("rank") < F.col("hi"))
        side = lambda keep: F.array_join(F.transform(F.filter("children", keep), lambda c: c["digest"]), "")
        step = F.struct(
            (F.col("level") + band.level).cast("int").alias("level"),
            side(lambda c: c["hi"] <= F.col("rank")).alias("left"), side(lambda c: c["lo"] > F.col("rank")).alias("right"),
        )
        kept = [c for c in band.entries.columns if c not in ("tree", "rank")]
        steps = (
            entries.join(nodes, inside, "left")
            .select("tree", "bucket", "rank", F.struct(*kept).alias("kept"), F.when(F.col("level").isNotNull(), step).alias("step"))
            .groupBy("tree", "bucket", "rank").agg(F.first("kept").alias("kept"), F.sort_array(F.collect_list("step")).alias("own"))
        )
        carried = steps.join(onward, ["tree", "bucket"]).select("tree", "rank", "kept.*", F.concat("own", F.col("onward")).alias("path"), "roots")
    return carried


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's digest and the siblings on its path lead to; a step without siblings still hashes its one node."""
    return F.aggregate(path, leaf, lambda digest, step: F.sha2(F.concat(step["left"], digest, step["right"]), 256))


def proof_digest(path: Column) -> Column:
    """H of all siblings, level by level and from left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def manifest(docs: DataFrame, group: str = "source", order: str = "doc_id", fields: tuple[str, ...] = FIELDS, claim: Column | None = None) -> DataFrame:
    """``(order, group, leaf, claim, subroot, root, path)``, one row for each row of ``docs``.

    Leaves are digests of ``fields``. Of each group they ascend by ``order``, nulls first, and rows of one ``order`` by their digest, so equal
    rows are leaves of their own whose proofs differ only by which of them stands first. Null is a group of its own, before
    the others; the groups' roots in bytewise order are the leaves of the last tree. ``claim`` is a digest to be carried along, null by
    default. Columns not named are not read. An empty table gives an empty result.
    """
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("")).alias("tree"), F.col(f"`{order}`").alias("at"),
        leaf_digest(*[F.col(f"`{c}`") for c in fields]).alias("digest"), (F.lit(None) if claim is None else claim).cast("string").alias("claim"),
    )
    bands = grow(ranked(settled(rows), "tree", "at", "digest"))
    roots = ranked(tops(bands).select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), "tree", "name")
    above = with_paths(grow(roots)).select(F.col("name").alias("tree"), _lifted(F.col("path"), bands), "roots")
    return with_paths(bands, above).select(
        F.col("at").alias(order), F.when(F.col("tree") != "", F.expr("substring(tree, 2)")).alias(group), F.col("digest").alias("leaf"), "claim",
        F.col("roots")[0].alias("subroot"), F.col("roots")[1].alias("root"), "path",
    )


def _lifted(path: Column, below: list[Band]) -> Column:
    """Levels of the last tree are counted on from the highest that a group can have."""
    lift = BAND * len(below)
    return F.transform(path, lambda s: F.struct((s["level"] + lift).cast("int").alias("level"), s["left"].alias("left"), s["right"].alias("right"))).alias("path")


def check_documents(docs: DataFrame) -> DataFrame:
    """Proofs of all documents, folded again after tampering: documents whose id has an even CRC-32 lose their line breaks.

    A null id is in no such document; a null text stays null. A document without a line break folds to the root although
    its id is chosen. Repeated rows are leaves of their own.
    """
    docs = narrowed(docs, *FIELDS).withColumn("doc_id", F.col("doc_id").cast("long"))
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False)) & F.col("text").contains("\n")
    bare = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    claim = F.when(chosen, leaf_digest(*[bare if c == "text" else F.col(c) for c in FIELDS]))
    folded = fold(F.coalesce("claim", "leaf"), F.col("path"))
    rows = manifest(docs, claim=claim).withColumns({"proof_sha256": proof_digest(F.col("path")), "folded_root": folded})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
