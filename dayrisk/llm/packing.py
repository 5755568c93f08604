"""Best-fit packing of token pieces by minimum bin slack.

The bins are planned on the histogram of lengths, which has at most ``capacity`` rows however large the corpus is.
Each bin pattern is the fullest combination a bitset subset-sum finds, and is repeated as long as the
lengths last. Rows then find their place from their rank among the pieces of their length; ranks are counted inside
each partition and offset by prefix sums over partitions, so pieces of one length never meet in one task.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from dayrisk.llm.common import Words, narrowed, settled, text_slices

CAPACITY = 2048
SPECIAL = "<|endoftext|>"
PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()), T.StructField("piece", T.IntegerType()), T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()), T.StructField("part", T.IntegerType()),
        T.StructField("rank", T.LongType()),
    ]
)
# a space before white space or the end of the text, or a zero character: such texts are encoded as a whole
UNEVEN = r"\x00| (?:[\s\x0b\x{85}\x{1c}-\x{1f}\pZ]|\z)"


class ByteTokenizer:
    """Ids of the byte-level vocabulary ``byte_bpe_50k``.

    The special token's string in a text is the special token, or ordinary text if ``special`` is off. A stretch of text from one space
    to before the next is encoded alike wherever it stands, so the distinct stretches of many texts are encoded as one text.
    """

    def __init__(self, ranks_file: str, special: bool = False):
        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.special = special
        self.encoding = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: len(ranks)})
        self.sizes = np.zeros(len(ranks) + 1, np.int64)
        self.sizes[list(ranks.values())] = list(map(len, ranks))

    def encode(self, text: str) -> np.ndarray:
        return self.encoding.encode_to_numpy(text, allowed_special={SPECIAL} if self.special else set(), disallowed_special=())

    def encode_flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the bounds of each text in them."""
        uneven = pc.match_substring_regex(texts, UNEVEN)
        if self.special:
            uneven = pc.or_(uneven, pc.match_substring(texts, SPECIAL))
        words = Words(pc.split_pattern(pc.replace_substring(pc.if_else(uneven, "", texts), " ", "\x00 "), "\x00"))
        whole = np.flatnonzero(uneven.to_numpy(zero_copy_only=False))
        # stretches that start with a space stand together in one text; their ids part where the bytes of a stretch end
        inner = np.fromiter((w[0] == " " for w in words.unique), bool, len(words.unique))
        joined = self.encoding.encode_to_numpy("".join([w for w in words.unique if w[0] == " "]), disallowed_special=())
        lone = [self.encode(w) for w in words.unique if w[0] != " "] + [self.encode(texts[int(i)].as_py()) for i in whole]
        sizes = np.zeros(len(words.unique) + len(whole), np.int64)
        bytes_of = pc.binary_length(pa.array(words.unique, pa.large_string())).to_numpy(zero_copy_only=False).astype(np.int64)[inner]
        sizes[: len(inner)][inner] = np.diff(np.searchsorted(np.cumsum(self.sizes[joined]), np.cumsum(bytes_of), "right"), prepend=0)
        apart = np.append(~inner, np.ones(len(whole), bool))
        sizes[apart] = list(map(len, lone))
        flat = np.concatenate([joined, *lone]).astype("<u4")
        starts = np.empty_like(sizes)
        starts[~apart] = np.cumsum(sizes[~apart]) - sizes[~apart]
        starts[apart] = len(joined) + np.cumsum(sizes[apart]) - sizes[apart]
        owners = np.concatenate([np.repeat(np.arange(len(words)), np.diff(words.bounds)), whole])
        codes = np.concatenate([words.codes, len(inner) + np.arange(len(whole))]).astype(np.int64)
        if len(whole):
            order = np.argsort(owners, kind="stable")
            owners, codes = owners[order], codes[order]
        taken = sizes[codes]
        ends = np.cumsum(taken)
        ids = flat[np.repeat(starts[codes] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)]
        return ids, np.append(0, np.cumsum(np.bincount(owners, taken, len(words)).astype(np.int64)))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of every text, as little-endian unsigned 32-bit numbers."""
        ids, bounds = self.encode_flat(texts)
        raw, cuts = ids.tobytes(), (4 * bounds).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]


_tokenizers: dict[tuple[str, bool], ByteTokenizer] = {}


def tokenizer(ranks_file: str, special: bool = False) -> ByteTokenizer:
    """One tokenizer of each kind for each worker process."""
    if (ranks_file, special) not in _tokenizers:
        _tokenizers[ranks_file, special] = ByteTokenizer(ranks_file, special)
    return _tokenizers[ranks_file, special]


def cuts(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, number, start, length) of the pieces of documents of ``sizes`` ids, one at least; a first piece takes what is over."""
    pieces = (sizes - 1) // capacity + 1
    owner = np.repeat(np.arange(len(sizes)), pieces)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    first = (sizes - capacity * (pieces - 1))[owner]
    return owner, number, np.where(number > 0, first + (number - 1) * capacity, 0), np.where(number > 0, capacity, first)


def places_among_equals(values: np.ndarray, before: np.ndarray) -> np.ndarray:
    """For each value how many equal ones came before it; ``before`` counts those of earlier calls and is carried on."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    fresh = np.append(True, ordered[1:] != ordered[:-1]) if len(ordered) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(fresh, np.arange(len(ordered)), 0)) if len(ordered) else ordered
    out = np.empty(len(values), np.int64)
    out[order] = before[ordered] + np.arange(len(ordered)) - start
    before += np.bincount(values, minlength=len(before))
    return out


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY, ranks_file: str | None = None, with_ids: bool = False) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, part, rank[, ids])``: every document as pieces of at most ``capacity`` ids.

    A document is its ids and a final 0; null text counts as empty, so it is the single id 0. Rows with the same or a null id are
    documents of their own. The special token's string in a text is the special token. ``part`` and ``rank`` number the pieces of one length within each partition and hold once the rows are settled.
    """
    file = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken")
    schema = T.StructType(PIECES.fields + [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, ranks = tokenizer(file, special=True).encode_flat, TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, texts in text_slices(batch):
                ids, bounds = encode(texts)
                ids = np.insert(ids, bounds[1:], 0).astype("<u4")
                bounds = bounds + np.arange(len(bounds))
                owner, number, start, length = cuts(np.diff(bounds), capacity)
                raw, begin = memoryview(ids.tobytes()), bounds[:-1][owner] + start
                crc = [zlib.crc32(raw[a:b]) for a, b in zip((4 * begin).tolist(), (4 * (begin + length)).tolist())]
                made = [
                    rows.column("doc_id").take(pa.array(owner)), pa.array(number, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()),
                    pa.array(np.full(len(owner), part), pa.int32()), pa.array(places_among_equals(length, ranks)),
                ]
                if with_ids:
                    made.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(ids)), pa.int32()), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(made, names=schema.names)

    return narrowed(docs, id_col, text).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(run, schema)


def fullest(counts: np.ndarray, lengths: list[int], room: int) -> list[tuple[int, int]]:
    """(length, copies) of a fullest combination of available lengths within ``room``, by a bitset subset-sum."""
    reach, mask, taken = 1, (1 << (room + 1)) - 1, []
    for length in lengths:
        left, chunk = min(int(counts[length]), room // length), 1
        while left:
            copies = min(chunk, left)
            taken.append((length, copies, reach))
            reach |= (reach << (length * copies)) & mask
            left, chunk = left - copies, chunk * 2
        if reach >> room & 1:
            break
    best, found = reach.bit_length() - 1, {}
    for length, copies, before in reversed(taken):
        if not before >> best & 1:
            found[length] = found.get(length, 0) + copies
            best -= length * copies
    return list(found.items())


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """Bin patterns ``({length: copies}, repeats)`` that hold all pieces: minimum bin slack, seeded with the longest piece left."""
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    patterns = []
    while (left := np.flatnonzero(counts)).size:
        longest = int(left[-1])
        counts[longest] -= 1
        room = capacity - longest
        pattern = {longest: 1}
        for length, copies in fullest(counts, [int(x) for x in left[::-1] if x <= room and counts[x]], room):
            pattern[length] = pattern.get(length, 0) + copies
        counts[longest] += 1
        repeats = min(int(counts[length]) // copies for length, copies in pattern.items())
        for length, copies in pattern.items():
            counts[length] -= copies * repeats
        patterns.append((pattern, repeats))
    return patterns


def _places(patterns: list[tuple[dict[int, int], int]]) -> dict[int, np.ndarray]:
    """For each length, rows (first rank, first sequence, copies in a sequence, offset of the first copy)."""
    places: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for pattern, repeats in patterns:
        offset = 0
        for length, copies in sorted(pattern.items(), reverse=True):
            places.setdefault(length, []).append((used.get(length, 0), sequence, copies, offset))
            used[length] = used.get(length, 0) + copies * repeats
            offset += length * copies
        sequence += repeats
    return {length: np.array(rows, np.int64) for length, rows in places.items()}


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to settled pieces with ``length``, ``part`` and ``rank``.

    The histogram that reaches the driver has at most ``capacity`` rows, and so has the number of patterns a bound that
    the corpus does not move. An empty table gives an empty result.
    """
    each = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    places = _places(plan_bins(histogram, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = each.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["length", "part"])
    schema = T.StructType([*ranked.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            rank, length = (rows["base"] + rows["rank"]).to_numpy(), rows["length"].to_numpy()
            sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
            for own in np.unique(length):
                at = np.flatnonzero(length == own)
                table = places[int(own)]
                first, start, copies, skip = table[np.searchsorted(table[:, 0], rank[at], side="right") - 1].T
                sequence[at] = start + (rank[at] - first) // copies
                offset[at] = skip + (rank[at] - first) % copies * own
            yield rows.assign(sequence_id=sequence, offset=offset)

    return ranked.mapInPandas(place, schema).drop("base", "part", "rank")


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return pack(settled(token_pieces(docs, id_col, text, capacity)), capacity)


def sequences(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(sequence_id, ids)``: the packed sequences themselves, at most ``capacity`` ids each."""
    packed = pack(settled(token_pieces(docs, capacity=capacity, with_ids=True)), capacity)
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda x: x["ids"])).alias("ids"))
