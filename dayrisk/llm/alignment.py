"""Alignment of the tokens of two tokenizers over the same text.

Tokens are byte ranges, so a tokenization is an ascending array of byte ends. Byte offsets where both end cut the tokens into groups. Most
groups are one token against one token, and then both arrays run on at a fixed index shift: probes of doubling width compare the arrays at
the current shift and skip such stretches; where they part, the smaller end steps on until both meet again, which closes an irregular
group and sets the next shift.

The corpus-wide counts of id pairs travel by chunk, a slice of some megabytes of text: a chunk asks once for each of its distinct pairs,
so a pair that every document holds is still one row of a chunk, and no document is shuffled by its pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from dayrisk.llm.common import Words, narrowed, settled, text_slices
from dayrisk.llm.packing import UNEVEN, tokenizer

MARK = "▁"


def piece_bytes(piece: str) -> bytes:
    """What a piece of the second tokenizer stands for."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace(MARK, " ").encode()


class TwinTokenizer:
    """Both tokenizers over a space and a text; distinct stretches from one space to before the next are encoded once, as neither joins over it."""

    def __init__(self, ranks_file: str, pieces_file: str):
        self.first = tokenizer(ranks_file).encoding
        self.second = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
        ranks = {i: token for token, i in self.first._mergeable_ranks.items()}
        self.a_bytes = [ranks.get(i, b"") for i in range(max(ranks) + 1)]
        self.b_bytes = [piece_bytes(self.second.id_to_piece(i)) for i in range(self.second.get_piece_size())]
        self.a_size, self.b_size = (np.fromiter(map(len, x), np.int64, len(x)) for x in (self.a_bytes, self.b_bytes))
        words = lambda n, ends: np.array([f"{i}{end}".encode() for end in ends for i in range(n)], object)
        self.a_words, self.b_words = words(len(self.a_bytes), ",|"), words(len(self.b_bytes), ",;")

    def encode(self, joint: list[str], apart: list[str]) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
        """For both tokenizers the ids of all stretches and how many each has; and whether both spell each stretch.

        Stretches start with a space; the ``joint`` ones may stand next to each other in one text for the first tokenizer.
        """
        stretches = joint + apart
        size = np.fromiter((len(s.encode()) for s in stretches), np.int64, len(stretches))
        parts = [self.first.encode_to_numpy(x, disallowed_special=()) for x in ("".join(joint), *apart)]
        counts = np.append(
            np.diff(np.searchsorted(np.cumsum(self.a_size[parts[0]]), np.cumsum(size[: len(joint)]), "right"), prepend=0), np.array([len(x) for x in parts[1:]], np.int64)
        ).astype(np.int64)
        seconds = self.second.encode([s[1:] for s in stretches], num_threads=1)
        coded = [
            (np.concatenate(parts).astype(np.int64), counts),
            (np.fromiter((i for ids in seconds for i in ids), np.int64), np.fromiter(map(len, seconds), np.int64, len(seconds))),
        ]
        same = np.ones(len(stretches), bool)
        for (ids, n), spelt in zip(coded, (self.a_bytes, self.b_bytes)):
            said = b"".join([spelt[i] for i in ids.tolist()])
            if said != "".join(stretches).encode():
                ends = np.cumsum(n)
                same &= [b"".join([spelt[i] for i in ids[e - k : e].tolist()]) == s.encode() for s, e, k in zip(stretches, ends, n)]
        return coded, same

    def tokens(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both for all texts together, and the bounds of each text in them; texts that have no tokens have none in both."""
        spaced = pc.binary_join_element_wise(pa.scalar("", pa.large_string()), texts, pa.scalar(" ", pa.large_string()))
        empty = pc.equal(texts, "").to_numpy(zero_copy_only=False)
        uneven = pc.match_substring_regex(spaced, UNEVEN).to_numpy(zero_copy_only=False) & ~empty
        words = Words(pc.split_pattern(pc.replace_substring(pc.if_else(pa.array(uneven | empty), "", spaced), " ", "\x00 "), "\x00"))
        whole = np.flatnonzero(uneven)
        coded, same = self.encode(words.unique, [spaced[int(i)].as_py() for i in whole])
        owners = np.concatenate([np.repeat(np.arange(len(words)), np.diff(words.bounds)), whole])
        codes = np.concatenate([words.codes, len(words.unique) + np.arange(len(whole))]).astype(np.int64)
        if len(whole):
            order = np.argsort(owners, kind="stable")
            owners, codes = owners[order], codes[order]
        broken = np.zeros(len(words), bool)
        broken[owners[~same[codes]]] = True
        stay = ~broken[owners]
        owners, codes = owners[stay], codes[stay]
        out = []
        for flat, sizes in coded:
            taken = sizes[codes]
            ends = np.cumsum(taken)
            at = np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - taken), taken) + np.arange(ends[-1] if len(ends) else 0)
            out += [flat[at], np.append(0, np.cumsum(np.bincount(owners, taken, len(words)).astype(np.int64)))]
        return out[0], out[2], out[1], out[3]


def cut_groups(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First token of every group in ``a`` and in ``b``, ascending byte ends whose last values are equal.

    A stretch of one-to-one groups is found by probes of doubling, then halving width at the current shift ``j - i``.
    """
    at, bt = memoryview(np.ascontiguousarray(a, np.int64)), memoryview(np.ascontiguousarray(b, np.int64))
    ab, bb = at.tobytes(), bt.tobytes()
    n, m, i, j = len(at), len(bt), 0, 0
    firsts, seconds, lengths = [], [], []
    while i < n:
        if at[i] == bt[j]:
            run, width, room = 1, 2, min(n - i, m - j)
            while run + width <= room and ab[8 * (i + run) : 8 * (i + run + width)] == bb[8 * (j + run) : 8 * (j + run + width)]:
                run += width
                width *= 2
            while width > 1:
                width //= 2
                if run + width <= room and ab[8 * (i + run) : 8 * (i + run + width)] == bb[8 * (j + run) : 8 * (j + run + width)]:
                    run += width
            firsts.append(i), seconds.append(j), lengths.append(run)
            i, j = i + run, j + run
            if i == n:
                break
        firsts.append(i), seconds.append(j), lengths.append(1)
        x, y = at[i], bt[j]
        while x != y:
            if x < y:
                i += 1
                x = at[i]
            else:
                j += 1
                y = bt[j]
        i, j = i + 1, j + 1
    size = np.array(lengths, np.int64)
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return np.repeat(np.array(firsts, np.int64), size) + step, np.repeat(np.array(seconds, np.int64), size) + step


class Aligned:
    """The texts of a slice, tokenized by both and cut into groups."""

    def __init__(self, twin: TwinTokenizer, texts: pa.Array):
        self.twin = twin
        self.a, self.b, self.a_bounds, self.b_bounds = twin.tokens(texts)
        self.a_ends, self.b_ends = np.cumsum(twin.a_size[self.a]), np.cumsum(twin.b_size[self.b])
        self.a_starts, self.b_starts = cut_groups(self.a_ends, self.b_ends)
        self.bounds = np.searchsorted(self.a_starts, self.a_bounds)
        self.n_a, self.n_b, self.n_groups = np.diff(self.a_bounds), np.diff(self.b_bounds), np.diff(self.bounds)
        #: Two overlapping tokens end a stretch of bytes that both cover at the end of either: links are the distinct ends.
        self.n_links = self.n_a + self.n_b - self.n_groups

    def digests(self) -> list[str]:
        """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each text, empty without tokens."""
        twin, n, m = self.twin, len(self.a), len(self.b)
        a_sizes, b_sizes = np.diff(np.append(self.a_starts, n)), np.diff(np.append(self.b_starts, m))
        a_last, b_last = np.zeros(n, bool), np.zeros(m, bool)
        a_last[self.a_starts + a_sizes - 1] = True
        b_last[self.b_starts + b_sizes - 1] = True
        words = np.empty(n + m, object)
        words[np.arange(n) + np.repeat(self.b_starts, a_sizes)] = twin.a_words[self.a + len(twin.a_bytes) * a_last]
        words[np.arange(m) + np.repeat(self.a_starts + a_sizes, b_sizes)] = twin.b_words[self.b + len(twin.b_bytes) * b_last]
        cuts = (self.a_bounds + self.b_bounds).tolist()
        return [hashlib.sha256(b"".join(words[s:e].tolist())[:-1]).hexdigest() if e > s else "" for s, e in zip(cuts, cuts[1:])]

    def links(self) -> np.ndarray:
        """The id pair of every link, text by text: ``a * (ids of the second tokenizer) + b``."""
        ends = np.concatenate([self.a_ends, self.b_ends])
        ends.sort(kind="stable")  # two ascending runs are merged
        ends = ends[np.append(True, ends[1:] != ends[:-1])] if len(ends) else ends
        return self.a[np.searchsorted(self.a_ends, ends)] * len(self.twin.b_bytes) + self.b[np.searchsorted(self.b_ends, ends)]


_twins: dict[tuple[str, str], TwinTokenizer] = {}


def twin_tokenizer(ranks_file: str | None, pieces_file: str | None) -> TwinTokenizer:
    """One for each worker process."""
    files = ranks_file or public_tokenizers.path("byte_bpe_50k.tiktoken"), pieces_file or public_tokenizers.path("piece_bpe_32k.model")
    if files not in _twins:
        _twins[files] = TwinTokenizer(*files)
    return _twins[files]


def _typed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    return narrowed(docs, id_col, text).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))


def token_groups(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranks_file: str | None = None, pieces_file: str | None = None) -> DataFrame:
    """``(doc_id, a, b, a_starts, b_starts)``: ids of both tokenizers and the first token of every group, from 0 in each document.

    Null and empty texts, and texts that one of the tokenizers does not spell byte for byte, have empty arrays.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twin = twin_tokenizer(ranks_file, pieces_file)
        for batch in batches:
            for rows, texts in text_slices(batch):
                x = Aligned(twin, texts)
                own = lambda values, bounds: pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(values, pa.int32()))
                starts = [s - np.repeat(b[:-1], x.n_groups) for s, b in ((x.a_starts, x.a_bounds), (x.b_starts, x.b_bounds))]
                columns = [rows.column("doc_id"), own(x.a, x.a_bounds), own(x.b, x.b_bounds), *(own(s, x.bounds) for s in starts)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "a", "b", "a_starts", "b_starts"])

    return _typed(docs, id_col, text).mapInArrow(run, "doc_id long, a array<int>, b array<int>, a_starts array<int>, b_starts array<int>")


ROWS = "doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups_sha256 array<string>"
CHUNKS = f"chunk long, {ROWS}, kinds array<long>, pair array<long>, links array<long>, packed binary, unpacked long"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
CODEC = "zstd"


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _chunks(docs: DataFrame, ranks_file: str | None, pieces_file: str | None) -> DataFrame:
    """One row per slice of texts: figures of its documents, its distinct pairs with their links, and which document has which pair how often.

    ``packed`` holds, for the documents one after the other, places in ``pair`` and then how often each occurs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twin, number = twin_tokenizer(ranks_file, pieces_file), TaskContext.get().partitionId() << 32
        one = lambda values, kind: pa.array([values], pa.list_(kind))
        for batch in batches:
            for rows, texts in text_slices(batch):
                x = Aligned(twin, texts)
                pairs, places, links = np.unique(x.links(), return_inverse=True, return_counts=True)
                each, times = np.unique(np.repeat(np.arange(len(x.n_links)), x.n_links) * max(1, len(pairs)) + places, return_counts=True)
                owners = each // max(1, len(pairs))
                raw = np.concatenate([each % max(1, len(pairs)), times]).astype("<u4").tobytes()
                figures = [one(v, pa.int64()) for v in (x.n_a, x.n_b, x.n_groups, x.n_links)]
                columns = [
                    pa.array([number]), one(rows.column("doc_id").to_pylist(), pa.int64()), *figures, one(x.digests(), pa.string()),
                    one(np.bincount(owners, minlength=len(x.n_links)), pa.int64()), one(pairs, pa.int64()), one(links, pa.int64()),
                    pa.array([pa.compress(raw, CODEC, asbytes=True)], pa.binary()), pa.array([len(raw)]),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=_names(CHUNKS))
                number += 1

    return docs.mapInArrow(run, CHUNKS)


def pair_counts(chunks: DataFrame, b_ids: int) -> DataFrame:
    """``(pair, count, best)``: links of every id pair in the whole corpus, and whether its second id has no pair with more."""
    counts = chunks.select(F.inline(F.arrays_zip("pair", "links"))).groupBy("pair").agg(F.sum("links").alias("count")).withColumn("b", F.col("pair") % b_ids)
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", ranks_file: str | None = None, pieces_file: str | None = None) -> DataFrame:
    """Figures of the alignment of every document, and how common its links are in the whole corpus.

    Null and empty texts, and texts that one tokenizer does not spell byte for byte (a text with U+2581 does not come back), have no
    tokens: zeros and an empty digest. Repeated rows and null or tied ids are documents of their own and each counts. Pairs of
    one count share the highest place. Columns not named are not read. An empty table gives an empty result.
    """
    chunks = settled(_chunks(_typed(docs, id_col, text), ranks_file, pieces_file))
    b_ids = len(twin_tokenizer(ranks_file, pieces_file).b_bytes)
    asked = chunks.select("chunk", F.explode("pair").alias("pair"))
    told = asked.join(pair_counts(chunks, b_ids), "pair").groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("pair", "count", "best"))).alias("told"))
    told = told.select("chunk", F.transform("told", lambda x: x["count"]).alias("counts"), F.transform("told", lambda x: x["best"]).alias("bests"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _names(RESULT)
        for batch in batches:
            for k in range(batch.num_rows):
                own = {c: batch.column(c)[k] for c in batch.schema.names}
                kinds = own["kinds"].values.to_numpy(zero_copy_only=False)
                raw = np.frombuffer(pa.decompress(own["packed"].as_buffer(), own["unpacked"].as_py(), CODEC), "<u4").astype(np.int64)
                places, times = raw[: len(raw) // 2], raw[len(raw) // 2 :]
                sums = []
                for values in ("bests", "counts"):
                    known = own[values].values.to_numpy(zero_copy_only=False).astype(np.int64) if own[values].is_valid else np.zeros(0, np.int64)
                    running = np.concatenate([[0], np.cumsum(known[places] * times)])
                    ends = np.cumsum(kinds)
                    sums.append(pa.array(running[ends] - running[ends - kinds]))
                made = {c: own[c].values for c in names if c in own} | {"n_best": sums[0], "count_sum": sums[1]}
                yield pa.RecordBatch.from_arrays([made[c] for c in names], names=names)

    return chunks.drop("pair", "links").join(told, "chunk", "left").mapInArrow(run, RESULT)
