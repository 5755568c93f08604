"""Helpers of the training-data operators: text in bounded slices, words as codes, column names that cannot clash."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from dayrisk.session import ensure_checkpoint_dir

SLICE_BYTES = 2_000_000
CACHE_ENTRIES = 150_000
WORD_BREAK = r"[^\pL\pN\pM_]+"
LETTER_BREAK = r"[^\pL\pM]+"


def settled(df: DataFrame) -> DataFrame:
    """The rows of ``df`` written to the shared checkpoint folder: what is computed once survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted`` with underscores in front until no column of ``df`` is called so (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


#: A key with more than this part of all rows is large; at most so many keys are.
SHARES = 4096


def dealt_join(rows: DataFrame, by_key: DataFrame, keys: list[str], size: str, deal: str, how: str = "inner", shares: int = SHARES) -> DataFrame:
    """``rows`` joined to the one row of their key in the settled ``by_key``, whose column ``size`` counts the rows of the key.

    The rows of a large key are dealt into parts by the whole number ``deal``, and only that key's row is copied, once for each part.
    """
    share = max(1.0, (by_key.agg(F.sum(size)).first()[0] or 0) / shares)
    parts = F.when(F.col(size) > share, F.ceil(F.col(size) / share)).otherwise(1).cast("int")
    large = F.broadcast(by_key.where(F.col(size) > share).select(*keys, parts.alias("_parts")))  # at most ``shares`` rows
    dealt = rows.join(large, keys, "left").withColumn("_part", F.pmod(F.col(deal), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_parts")
    copies = by_key.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return dealt.join(copies, [*keys, "_part"], how).drop("_part")


def text_slices(batch: pa.RecordBatch, column: str = "text") -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Cut a batch into slices of about SLICE_BYTES of text (one row at least); null text counts as empty."""
    texts = batch.column(column).cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + SLICE_BYTES, side="right")))
        yield batch.slice(start, stop - start), texts.slice(start, stop - start)
        start = stop
    pa.default_memory_pool().release_unused()  # the process is used again by other tasks


class Words:
    """Words of many texts as codes: ``unique[codes[bounds[i]:bounds[i + 1]]]`` are the words of text ``i``."""

    def __init__(self, pieces: pa.Array):
        flat = pc.list_flatten(pieces)
        sizes = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
        filled = pc.not_equal(flat, "")
        keep = filled.to_numpy(zero_copy_only=False)
        owner = np.repeat(np.arange(len(sizes)), sizes)[keep]
        self.bounds = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(sizes)))]).astype(np.int64)
        encoded = flat.filter(filled).dictionary_encode()
        self.unique: list[str] = encoded.dictionary.to_pylist()
        self.codes = encoded.indices.to_numpy(zero_copy_only=False)

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def of(self, i: int) -> np.ndarray:
        return self.codes[self.bounds[i] : self.bounds[i + 1]]


def split_words(texts: pa.Array, break_pattern: str = WORD_BREAK, lower: bool = True) -> Words:
    """Words between matches of ``break_pattern``."""
    return Words(pc.split_pattern_regex(pc.utf8_lower(texts) if lower else texts, break_pattern))


class Cache(dict):
    """Bounded memo of a function of one word; it starts anew when full."""

    def __init__(self, make: Callable, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.make, self.entries = make, entries

    def __missing__(self, word):
        if len(self) >= self.entries:
            self.clear()
        value = self[word] = self.make(word)
        return value

    def all(self, words: list) -> list:
        return list(map(self.__getitem__, words))


def word_hashes(words: list[str]) -> np.ndarray:
    """A 64-bit hash of each word, the same in every process."""
    digest = xxhash.xxh3_64_intdigest
    return np.fromiter((digest(w.encode()) for w in words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers over all bits (finaliser of the splitmix generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def narrowed(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, whatever other columns there are."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def with_arrow_columns(df: DataFrame, make: Callable, fields: list[T.StructField], text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Add columns computed from the text in bounded slices; ``carry`` (all by default) are the columns that stay.

    ``make(texts)`` gets an Arrow array of texts and returns one list or array for each field.
    """
    kept = df if carry is None else narrowed(df, *dict.fromkeys([*carry, text]))
    out_names = list(kept.columns) if carry is None else list(carry)
    schema = T.StructType([kept.schema[c] for c in out_names] + fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch, text):
                made = [x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x) for x in make(texts)]
                columns = [rows.column(c) for c in out_names] + made
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema.fields])

    return kept.mapInArrow(run, schema)
