"""Exact duplicates by counting quotient filters.

Every partition builds filters over the fingerprints of its texts, one for each range of fingerprints. Filters of
one range merge by their sorted remainders without loss, so copies are counted before anything is shuffled. Only
documents whose fingerprint was counted more than once go on to the comparison of all their bytes, by length and SHA-256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from dayrisk.llm.common import SHARES, dealt_join, free_name, narrowed, settled, with_arrow_columns

#: A fingerprint is a range, a quotient and a remainder; the ranges are as many as keep the fingerprints of one at about RANGE_ROWS.
REMAINDER_BITS = 32
RANGE_ROWS = 1 << 18
LEAST_RANGE_BITS, MOST_RANGE_BITS = 8, 31
#: Fingerprints that wait before they are sorted into a partition's own.
WAITING = 1 << 20


def range_bits(rows: int) -> int:
    return min(MOST_RANGE_BITS, max(LEAST_RANGE_BITS, (rows // RANGE_ROWS).bit_length()))


class CountingQuotientFilter:
    """Fingerprints of one range: occupied quotients, the length of each quotient's run, sorted remainders and counts."""

    def __init__(self, quotients: np.ndarray, runs: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.quotients, self.runs, self.remainders, self.counts = quotients, runs, remainders, counts

    @classmethod
    def of_sorted(cls, keys: np.ndarray, counts: np.ndarray) -> CountingQuotientFilter:
        """From sorted distinct keys (quotient above remainder) and their counts."""
        quotients, runs = np.unique((keys >> np.uint64(REMAINDER_BITS)).astype(np.uint32), return_counts=True)
        return cls(quotients, runs.astype(np.uint32), (keys & np.uint64(2**REMAINDER_BITS - 1)).astype(np.uint32), counts.astype(np.uint64))

    @classmethod
    def merge(cls, filters: list[CountingQuotientFilter]) -> CountingQuotientFilter:
        """Sum of filters of the same range: runs are merged by remainder, counts of equal remainders are added."""
        return cls.of_sorted(*merged_counts(np.concatenate([f.keys() for f in filters]), np.concatenate([f.counts for f in filters])))

    def keys(self) -> np.ndarray:
        return (np.repeat(self.quotients, self.runs).astype(np.uint64) << np.uint64(REMAINDER_BITS)) | self.remainders.astype(np.uint64)

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys with a count above one, and their counts."""
        more = self.counts > 1
        return self.keys()[more], self.counts[more]

    def to_bytes(self) -> list[bytes]:
        return [x.tobytes() for x in (self.quotients, self.runs, self.remainders, self.counts)]

    @classmethod
    def from_bytes(cls, quotients: bytes, runs: bytes, remainders: bytes, counts: bytes) -> CountingQuotientFilter:
        return cls(np.frombuffer(quotients, np.uint32), np.frombuffer(runs, np.uint32), np.frombuffer(remainders, np.uint32), np.frombuffer(counts, np.uint64))


def merged_counts(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


FILTER = T.StructType(
    [T.StructField("range", T.IntegerType())] + [T.StructField(n, T.BinaryType()) for n in ("quotients", "runs", "remainders", "counts")]
)
REPEATED = T.StructType([T.StructField("fp", T.LongType()), T.StructField("seen", T.LongType())])


def partition_filters(bits: int):
    """The filters of one partition, a row for each of the ``2 ** bits`` ranges of fingerprints that occurs in it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, counts, waiting = np.empty(0, np.uint64), np.empty(0, np.uint64), []

        def sort_in() -> tuple[np.ndarray, np.ndarray]:
            new = [np.ones(len(w), np.uint64) for w in waiting]
            return merged_counts(np.concatenate([keys, *waiting]), np.concatenate([counts, *new]))

        for batch in batches:
            waiting.append(batch["fp"].to_numpy(np.int64).view(np.uint64))
            if sum(map(len, waiting)) > max(WAITING, len(keys)):
                keys, counts = sort_in()
                waiting = []
        keys, counts = sort_in()
        inner = np.uint64(64 - bits)
        ranges = (keys >> inner).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], ranges[1:] != ranges[:-1]])) if len(ranges) else np.empty(0, np.int64)
        rows = []
        for a, b in zip(starts, [*starts[1:], len(keys)]):
            own = CountingQuotientFilter.of_sorted(keys[a:b] & ((np.uint64(1) << inner) - np.uint64(1)), counts[a:b])
            rows.append((int(ranges[a]), *own.to_bytes()))
        yield pd.DataFrame(rows, columns=FILTER.names)

    return run


def merged_filters(bits: int):
    """Fingerprints counted more than once; rows come sorted by range, and a range may go on in the next batch."""

    def repeated(number: int, filters: list[CountingQuotientFilter]) -> pd.DataFrame:
        keys, counts = CountingQuotientFilter.merge(filters).repeated()
        fps = (np.uint64(number) << np.uint64(64 - bits)) | keys
        return pd.DataFrame({"fp": fps.view(np.int64), "seen": counts.astype(np.int64)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, waiting = None, []
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                if row.range != number and waiting:
                    out.append(repeated(number, waiting))
                    waiting = []
                number = row.range
                waiting.append(CountingQuotientFilter.from_bytes(*row[1:]))
            if len(waiting) > 1:
                waiting = [CountingQuotientFilter.merge(waiting)]
            if out:
                yield pd.concat(out)
        if waiting:
            yield repeated(number, waiting)

    return run


def _digests(texts: pa.Array) -> list:
    """Fingerprint, length and SHA-256 of every text after lower-casing A-Z."""
    fps, sizes, shas = [], [], []
    for text in texts.to_pylist():
        data = text.encode().lower()  # of bytes, lower() changes A-Z only
        fps.append(xxhash.xxh3_64_intdigest(data))
        sizes.append(len(data))
        shas.append(hashlib.sha256(data).hexdigest())
    return [np.array(fps, np.uint64).view(np.int64), pa.array(sizes, pa.int64()), shas]


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shares: int = SHARES) -> DataFrame:
    """``(doc_id, keep_id, group_size, kept, text_sha256)``: one row per row of ``docs``.

    Texts are equal when they are identical after lower-casing A-Z; null counts as empty. The row with the largest
    id stays; a null id is smaller than any other, and of rows with the same id and text exactly one stays.
    An empty table gives an empty result; other columns are not looked at.
    """
    fields = [T.StructField("fp", T.LongType()), T.StructField("size", T.LongType()), T.StructField("text_sha256", T.StringType())]
    named = narrowed(docs, id_col, text).toDF("doc_id", "text")
    rows = settled(
        with_arrow_columns(named, _digests, fields, carry=["doc_id"]).withColumn("row", F.monotonically_increasing_id())
    )
    total = rows.count()
    bits = range_bits(total)
    filters = rows.select("fp").mapInPandas(partition_filters(bits), FILTER)
    repeated = filters.repartition("range").sortWithinPartitions("range").mapInPandas(merged_filters(bits), REPEATED)
    # settled, so that the groups below are pre-aggregated before their shuffle
    routed = settled(rows.join(repeated.select("fp"), "fp", "left_semi"))
    key = ["fp", "size", "text_sha256"]
    classes = settled(
        routed.groupBy(*key).agg(F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1")
    )
    joined = dealt_join(rows, classes, key, "n", "row", "left", shares)
    return joined.select(
        "doc_id",
        F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("last.doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("last.row") == F.col("row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    sha, key = free_name(docs, "_sha"), free_name(docs, "_id")
    kept = exact_groups(docs, id_col, text).where("kept").select(F.col("doc_id").alias(key), F.col("text_sha256").alias(sha))
    lower = F.translate(F.coalesce(F.col(f"`{text}`"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    own = docs.withColumn(sha, F.sha2(lower, 256)).withColumn(key, F.col(f"`{id_col}`"))
    same = own[key].eqNullSafe(kept[key]) & (own[sha] == kept[sha])
    return own.join(kept, same, "left_semi").dropDuplicates([key, sha]).select(*[F.col(f"`{c}`") for c in docs.columns])
