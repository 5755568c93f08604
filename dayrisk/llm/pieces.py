"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

Texts fall into stretches that begin with white-space markers; as no piece has a marker after another character, the best segmentation of
a text is the best one of each stretch. Every distinct stretch of a batch is segmented once, all of them in lockstep.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, functions as F

from dayrisk.llm.common import Cache, Words, narrowed, text_slices

MARKER = "\u2581"
NORMAL, UNKNOWN, CONTROL, UNUSED, BYTE = 1, 2, 3, 5, 6
#: An unknown character costs this much more than the rarest piece.
UNKNOWN_PENALTY = 10.0
LOCKSTEP_BYTES, LOCKSTEP_ROWS = 96, 20_000


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of the fields of a protocol-buffer message."""

    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            byte = data[at]
            value |= (byte & 127) << shift
            at, shift = at + 1, shift + 7
            if byte < 128:
                return value, at

    at = 0
    while at < len(data):
        key, at = varint(at)
        kind = key & 7
        if kind == 0:
            value, at = varint(at)
        elif kind == 2:
            size, at = varint(at)
            value, at = data[at : at + size], at + size
        else:
            size = 4 if kind == 5 else 8
            value, at = struct.unpack("<f" if kind == 5 else "<d", data[at : at + size])[0], at + size
        yield key >> 3, value


def read_model(file: str) -> tuple[list[tuple[str, float, int]], dict]:
    """``(piece, score, type)`` of every id and the settings the encoder needs. The model's own normalisation must be the identity."""
    pieces, settings = [], {"model_type": 1, "byte_fallback": False, "dummy_prefix": True, "charsmap": b""}
    with open(file, "rb") as model:
        for number, value in _fields(model.read()):
            if number == 1:
                own = dict(_fields(value))
                pieces.append((own[1].decode(), float(own.get(2, 0.0)), int(own.get(3, NORMAL))))
            elif number == 2:
                own = dict(_fields(value))
                settings |= {"model_type": own.get(3, 1), "byte_fallback": bool(own.get(35, 0))}
            elif number == 3:
                own = dict(_fields(value))
                settings |= {"charsmap": own.get(2, b""), "dummy_prefix": bool(own.get(3, 1)), "extra_spaces": bool(own.get(4, 1))}
    return pieces, settings


class DoubleArrayTrie:
    """Byte trie in two arrays: the child of ``s`` by byte ``c`` is ``base[s] + c + 1`` if ``check`` there is ``s``; ``value`` is an id or -1."""

    def __init__(self, keys: list[tuple[bytes, int]]):
        children: list[dict[int, int]] = [{}]
        ends = {}
        for key, number in keys:
            node = 0
            for byte in key:
                if byte not in children[node]:
                    children[node][byte] = len(children)
                    children.append({})
                node = children[node][byte]
            ends[node] = number
        size = 2 * len(children) + 1024
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        used = bytearray(size)
        used[0] = 1
        place, free, roomy = {0: 0}, 1, 1
        for node in range(len(children)):  # parents come before their children
            own = sorted(children[node])
            here = place[node]
            self.value[here] = ends.get(node, -1)
            if not own:
                continue
            while used[free]:
                free += 1
            # nodes with several children search on from where the last of them found room
            start = first = max(0, (free if len(own) == 1 else max(free, roomy)) - own[0] - 1)
            while any(used[start + byte + 1] for byte in own):
                start += 1
                if len(own) == 1:  # the next free slot
                    start = max(start, used.find(0, start + own[0] + 1) - own[0] - 1)
                if start + 257 >= len(used):
                    grown = len(used)
                    used.extend(bytes(grown))
                    self.base = np.concatenate([self.base, np.zeros(grown, np.int32)])
                    self.check, self.value = (np.concatenate([x, np.full(grown, -1, np.int32)]) for x in (self.check, self.value))
            if len(own) > 1 and start - first > 64:
                roomy = start
            self.base[here] = start
            for byte in own:
                at = start + byte + 1
                used[at] = 1
                self.check[at] = here
                place[children[node][byte]] = at
        self.check[0] = -1

    def prefixes(self, data: bytes, at: int) -> Iterator[tuple[int, int]]:
        """(end, id) of every key that begins at ``at``."""
        state, size = 0, len(self.base)
        for end in range(at, len(data)):
            child = int(self.base[state]) + data[end] + 1
            if child >= size or self.check[child] != state:
                return
            state = child
            if self.value[state] >= 0:
                yield end + 1, int(self.value[state])


class PieceModel:
    """A vocabulary with log scores.

    A unigram model file brings its log probabilities. The scores of a merge model are ranks; there the log score of a piece is that of
    Zipf's law at its rank, ``-log((rank + 1) * harmonic)``: a rule, not a training.
    """

    def __init__(self, file: str, own_scores: bool | None = None):
        pieces, self.settings = read_model(file)
        if self.settings["charsmap"] or self.settings.get("extra_spaces"):
            raise ValueError("only models without normalisation of their own are supported")
        self.pieces = [p for p, _, _ in pieces]
        self.types = [t for _, _, t in pieces]
        usable = [(i, p) for i, (p, _, t) in enumerate(pieces) if t == NORMAL]
        if any(MARKER in p.lstrip(MARKER) for _, p in usable):
            raise ValueError("pieces with a white-space marker after another character are not supported")
        scores = np.array([s for _, s, _ in pieces], np.float64)
        if not (self.settings["model_type"] == 1 if own_scores is None else own_scores):
            ranks = np.zeros(len(pieces))
            order = sorted((i for i, _ in usable), key=lambda i: (-scores[i], i))
            ranks[order] = np.arange(len(order))
            scores = -np.log(ranks + 1) - np.log(np.sum(1.0 / np.arange(1, len(order) + 1)))
        self.scores = scores.astype(np.float32)
        self.unknown_score = np.float32(min(self.scores[i] for i, _ in usable) - np.float32(UNKNOWN_PENALTY))
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == BYTE} if self.settings["byte_fallback"] else {}
        self.trie = DoubleArrayTrie([(p.encode(), i) for i, p in usable])
        self.longest = max(len(p.encode()) for _, p in usable)
        self.surface = [bytes([int(p[3:5], 16)]) if t == BYTE else b"" if t == CONTROL else " \u2047 ".encode() if t == UNKNOWN else p.replace(MARKER, " ").encode() for p, _, t in pieces]
        self.lines_apart = bool(self.bytes) and not any("\n" in p for _, p in usable)  # then a line break is its byte wherever it stands
        self.cache = Cache(self._one, entries=300_000)

    def _ids(self, data: bytes, cuts: list[tuple[int, int, int]]) -> bytes:
        """Ids of a segmentation as 32-bit numbers; an unknown character falls back to its bytes."""
        out: list[int] = []
        for start, end, piece in cuts:
            if piece >= 0:
                out.append(piece)
            elif self.bytes:
                out += [self.bytes[b] for b in data[start:end]]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return np.array(out, "<i4").tobytes()

    def _one(self, stretch: str) -> bytes:
        """Viterbi over one stretch."""
        data = stretch.encode()
        n = len(data)
        best, back = [None] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = np.float32(0)
        at = 0
        while at < n:
            width = 1 if data[at] < 128 else 2 if data[at] < 224 else 3 if data[at] < 240 else 4
            single = False
            for end, piece in self.trie.prefixes(data, at):
                single |= end == at + width
                score = best[at] + self.scores[piece]
                if best[end] is None or score > best[end]:
                    best[end], back[end] = score, (at, piece)
            if not single:
                score = best[at] + self.unknown_score
                if best[at + width] is None or score > best[at + width]:
                    best[at + width], back[at + width] = score, (at, -1)
            at += width
        cuts, end = [], n
        while end:
            start, piece = back[end]
            cuts.append((start, end, piece))
            end = start
        return self._ids(data, cuts[::-1])

    def _many(self, stretches: list[str]) -> list[bytes]:
        """Viterbi over many stretches at once: all advance by one byte, and all walk the trie together."""
        raw = [s.encode() for s in stretches]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        width = int(size.max()) + 1
        data = np.zeros((len(raw), width + self.longest), np.int32)
        flat = np.frombuffer(b"".join(raw), np.uint8)
        starts = np.cumsum(size) - size
        data[np.repeat(np.arange(len(raw)), size), np.arange(len(flat)) - np.repeat(starts, size)] = flat.astype(np.int32) + 1
        best = np.full((len(raw), width + self.longest), -np.inf, np.float32)
        origin, piece = np.zeros(best.shape, np.int32), np.full(best.shape, -1, np.int32)
        best[:, 0] = 0
        base, check, value = self.trie.base, self.trie.check, self.trie.value
        for at in range(width - 1):
            first = data[:, at] - 1
            rows = np.flatnonzero((size > at) & ((first & 0xC0) != 0x80))
            if not len(rows):
                continue
            lead = first[rows]
            char = np.where(lead < 128, 1, np.where(lead < 224, 2, np.where(lead < 240, 3, 4)))
            single, live, state = np.zeros(len(rows), bool), np.arange(len(rows)), np.zeros(len(rows), np.int32)
            for step in range(self.longest):
                byte = data[rows[live], at + step]
                child = np.minimum(base[state] + byte, len(base) - 1)
                on = (byte > 0) & (check[child] == state)
                live, state = live[on], child[on]
                if not len(live):
                    break
                found = value[state]
                hit = found >= 0
                own, ids, end = rows[live[hit]], found[hit], at + step + 1
                single[live[hit]] |= char[live[hit]] == step + 1
                score = best[own, at] + self.scores[ids]
                better = score > best[own, end]
                best[own[better], end], origin[own[better], end], piece[own[better], end] = score[better], at, ids[better]
            own, end = rows[~single], at + char[~single]
            score = best[own, at] + self.unknown_score
            better = score > best[own, end]
            best[own[better], end[better]], origin[own[better], end[better]], piece[own[better], end[better]] = score[better], at, -1
        return self._traced(size, data, origin, piece)

    def _traced(self, size: np.ndarray, data: np.ndarray, origin: np.ndarray, piece: np.ndarray) -> list[bytes]:
        """Ids of the best paths of all stretches, followed back from their ends together."""
        row, end = np.arange(len(size)), size.copy()
        rows, starts, ends, ids = [], [], [], []
        while len(row):
            start = origin[row, end].astype(np.int64)
            rows.append(row)
            starts.append(start)
            ends.append(end)
            ids.append(piece[row, end])
            row, end = row[start > 0], start[start > 0]
        row, start, end, number = (np.concatenate(x) for x in (rows, starts, ends, ids))
        order = np.lexsort((start, row))
        row, start, end, number = row[order], start[order], end[order], number[order]
        lost = number < 0
        if not self.bytes:
            number[lost] = self.unknown
            again = np.flatnonzero(lost[1:] & lost[:-1] & (row[1:] == row[:-1])) + 1  # unknown characters in a row are one id
            row, number = np.delete(row, again), np.delete(number, again)
        else:
            width = np.where(lost, end - start, 1)
            at = np.repeat(np.arange(len(row)), width)
            step = np.arange(len(at)) - np.repeat(np.cumsum(width) - width, width)
            by_byte = np.zeros(256, np.int32)
            by_byte[list(self.bytes)] = list(self.bytes.values())
            number = np.where(lost[at], by_byte[data[row[at], start[at] + step] - 1], number[at])
            row = row[at]
        cuts = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(size)))]) * 4
        flat = number.astype("<i4").tobytes()
        return [flat[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and where each text ends in it; an empty text has no ids."""
        prefix = " " if self.settings["dummy_prefix"] else ""
        string = lambda x: pa.scalar(x, pa.large_string())
        prefixed = pc.binary_join_element_wise(string(prefix), pc.replace_substring(texts, MARKER, " "), string(""))
        marked = pc.if_else(pc.equal(texts, string("")), string(""), prefixed)
        cut = pc.replace_substring_regex(pc.replace_substring(marked, "\x00", "\x01\x02"), r"([^ ]) ", "\\1\x00 ")
        if self.lines_apart:
            cut = pc.replace_substring(cut, "\n", "\x00\n\x00")
        words = Words(pc.split_pattern(cut, "\x00"))
        stretches = [w.replace("\x01\x02", "\x00").replace(" ", MARKER) for w in words.unique]
        fresh = sorted((s for s in stretches if s not in self.cache and len(s.encode()) <= LOCKSTEP_BYTES), key=len)
        made = {}
        for start in range(0, len(fresh), LOCKSTEP_ROWS):
            own = fresh[start : start + LOCKSTEP_ROWS]
            made |= zip(own, self._many(own))
        found = [made[s] if s in made else self.cache[s] for s in stretches]
        if len(self.cache) + len(made) > self.cache.entries:
            self.cache.clear()
        self.cache.update(made)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<i4")
        starts, taken = np.cumsum(sizes) - sizes, sizes[words.codes]
        ends = np.concatenate([[0], np.cumsum(taken)]).astype(np.int64)
        ids = flat[np.repeat(starts[words.codes] - ends[:-1], taken) + np.arange(ends[-1])]
        return ids, ends[words.bounds[1:]]

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: markers become spaces, byte pieces become the characters their bytes form, the added first space goes."""
        data = b"".join([self.surface[i] for i in ids.tolist()])
        text = data.decode(errors="replace")
        return text[1:] if self.settings["dummy_prefix"] and text.startswith(" ") else text


_models: dict[str, PieceModel] = {}


def piece_model(file: str) -> PieceModel:
    """One model for each worker process."""
    if file not in _models:
        _models[file] = PieceModel(file)
    return _models[file]


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", model_file: str | None = None) -> DataFrame:
    """``(doc_id, n_ids, ids, ids_crc32, lossless)`` of every row, decoded again to see whether the text comes back.

    ``ids_crc32`` is over little-endian unsigned 32-bit ids. Null counts as empty; an empty text has no ids. A text with the marker
    character itself comes back with a space in its place, as the format has it, and is not lossless. An empty table
    gives an empty result; other columns are not looked at.
    """
    file = model_file or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = piece_model(file)
        for batch in batches:
            for rows, texts in text_slices(batch):
                ids, ends = model.encode_all(texts)
                bounds = np.concatenate([[0], ends]).astype(np.int32)
                own = [ids[a:b] for a, b in zip(bounds, bounds[1:])]
                lossless = [model.decode(x) == t for x, t in zip(own, texts.to_pylist())]
                crcs = [zlib.crc32(x.astype("<u4").tobytes()) for x in own]
                columns = [rows.column("doc_id"), pa.array(np.diff(bounds).astype(np.int64)), pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids, pa.int32())), pa.array(crcs, pa.int64()), pa.array(lossless)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_ids", "ids", "ids_crc32", "lossless"])

    named = narrowed(docs, id_col, text).toDF("doc_id", "text")
    return named.mapInArrow(run, f"doc_id {named.schema['doc_id'].dataType.simpleString()}, n_ids long, ids array<int>, ids_crc32 long, lossless boolean")


def decode_documents(encoded: DataFrame, ids: str = "ids", model_file: str | None = None) -> DataFrame:
    """``encoded`` with a column ``text`` made from its ids; null ids give a null text."""
    file = model_file or public_tokenizers.path("piece_bpe_32k.model")

    @F.pandas_udf("string")
    def decoded(values):
        model = piece_model(file)
        return values.map(lambda x: None if x is None else model.decode(np.asarray(x)))

    return encoded.withColumn("text", decoded(F.col(ids)))
