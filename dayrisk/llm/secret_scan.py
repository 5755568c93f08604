"""Secrets in texts: fixed patterns, and a linear-chain conditional random field that finds what looks like a secret beyond them.

Tokens are tagged begin, inside or outside from their shape, the words around them and figures of the file. The field is fitted on windows
around matches of the patterns and on windows without; a matched secret is also drawn anew from other alphabets, so that the
field learns what a random string in its surroundings looks like and not the patterns.

Decoding is exact. A token whose outside score leads by more than any transitions can give back is outside in every best path;
such tokens cut the chain, and what is left between them are short stretches that Viterbi decodes side by side.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from dayrisk.llm.common import narrowed, settled, text_slices

KINDS = ("assign", "access", "hex", "crf")
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # runs are maximal, so this is every run of 24 or more
LEAST_VALUE, LEAST_ACCESS = 6, 20
#: For a quick look at whole texts: a text that matches none of these has no match of the patterns.
HINTS = ((r"(?i)(?:password|passwd|secret|token|api_?key)[\"']? *[:=]", 0), ("AKIA[A-Z0-9]", 1), ("[0-9a-f]{24}", 2))

#: The field is fitted on at most so many windows with and without a match, chosen by their hash.
WINDOWS, CLEAN_WINDOWS = 600, 1_200
EACH_SLICE = 20
CONTEXT = 10
REDRAWN = 2
STEPS, RATE, RIDGE = 80, 0.2, 0.5
#: A neighbour's word is known if so many tokens of the windows are spelt like it, in small letters.
LEAST_WORD = 3
BEGIN, INSIDE, OUTSIDE = range(3)
BREAK = r"[ \t\n\x0b\f\r]"
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{16,}={1,2}(?![A-Za-z0-9=])|[\w+/-]+(?:\.[\w+/-]+)*|[^\w+/-]+")
NEAR = (-1, -2, -3, 1)


def base_spans(text: str, which: tuple[bool, bool, bool] = (True, True, True)) -> list[tuple[int, int, int, int, int]]:
    """``(start, kind, end, value start, value end)`` of the patterns' matches, leftmost and not overlapping within a kind, by start and kind."""
    found = []
    if which[0]:
        found += [(m.start(), 0, m.end(), m.start(2), m.end(2)) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_VALUE]
    for kind, pattern, least in ((1, ACCESS, LEAST_ACCESS), (2, HEX, 0)):
        if which[kind]:
            found += [(m.start(), kind, m.end(), m.start(), m.end()) for m in pattern.finditer(text) if m.end() - m.start() >= least]
    return sorted(found)


def hinted(texts: pa.Array) -> np.ndarray:
    """For each text, which patterns may match."""
    return np.stack([pc.match_substring_regex(texts, p).to_numpy(zero_copy_only=False).astype(bool) for p, _ in HINTS], 1)


def _kind_of_character() -> np.ndarray:
    """0 sign, 1 small, 2 capital, 3 digit for each code point below 0x3000."""
    return np.array([3 if c.isdigit() else 2 if c.isupper() else 1 if c.isalpha() or c == "_" else 0 for c in map(chr, range(0x3000))], np.int8)


KIND = _kind_of_character()
VOWEL, HEXADECIMAL = (np.isin(np.arange(0x3000), [ord(c) for c in x]) for x in ("aeiouyAEIOUYáéíóúäöüàèêëîïôûœ", "0123456789abcdefABCDEF"))
SIZES = np.array([1, 3, 7, 11, 15, 19, 23, 31, 39, 63])
#: Number of values of each feature of a token's own shape, and of a neighbour's class.
SHAPES = {"kinds": 16, "size": 11, "kinds by size": 176, "entropy": 16, "turns": 10, "turns in 8": 9, "size by entropy": 176, "vowels": 6, "letters": 12, "hexadecimal": 12, "marks": 4, "sign": 257}
CLASSES = 272
FIGURES = {"lines": 10, "digits": 6, "signs": 6}


def token_features(tokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each token its shape, one value of every feature of SHAPES, and the class that its neighbours see."""
    n = pc.utf8_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
    points = np.minimum(np.frombuffer("".join(tokens.to_pylist()).encode("utf-32-le"), np.uint32), 0x2FFF)
    first, owner = np.cumsum(n) - n, np.repeat(np.arange(len(n)), n)
    count = lambda flags: np.add.reduceat(flags.astype(np.int64), first) if len(n) else np.zeros(0, np.int64)
    kind = KIND[points]
    small, capital, digit = (count(kind == k) for k in (1, 2, 3))
    sign = n - small - capital - digit
    letters = small + capital
    same = np.append(False, owner[1:] == owner[:-1])
    sort = np.where(kind == 2, 1, kind)
    turns = count(same & np.append(False, sort[1:] != sort[:-1]))
    mixed = count(same & np.append(False, (kind[1:] == 2) & (kind[:-1] == 1))) > 0
    each, times = np.unique(owner << 16 | points.astype(np.int64), return_counts=True)
    share = times / n[each >> 16]
    entropy = np.minimum(15, np.bincount(each >> 16, -2 * share * np.log2(share), len(n)).astype(np.int64))
    size = np.searchsorted(SIZES, n)
    kinds = (small > 0) * 8 + (capital > 0) * 4 + (digit > 0) * 2 + (sign > 0)
    spelt = letters + digit > 0
    values = [
        kinds, size, kinds * 11 + size, entropy, np.minimum(9, turns), 8 * turns // np.maximum(1, n), size * 16 + entropy, 5 * count(VOWEL[points]) // np.maximum(1, letters),
        np.where(letters == n, size + 1, 0), np.where((n >= 8) & (count(HEXADECIMAL[points]) == n), size + 1, 0),
        (count(points == ord(".")) > 0) * 2 + mixed, np.where(spelt, 256, np.minimum(points[first], 255)),
    ]
    seen = np.where(letters > 0, (digit > 0) * 4 + np.minimum(3, n // 8), np.where(digit > 0, 8, 16 + np.minimum(points[first], 255)))
    bounds = np.cumsum([0, *SHAPES.values()])[:-1]
    return np.stack(values, 1) + bounds if len(n) else np.zeros((0, len(SHAPES)), np.int64), seen


def file_figures(texts: pa.Array) -> np.ndarray:
    """For each text, as values of FIGURES: how long its lines are, how much of it is digits and how much is signs of code or markup."""
    count = lambda pattern: pc.count_substring_regex(texts, pattern).to_numpy(zero_copy_only=False).astype(float)
    chars = np.maximum(1, pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(float))
    lines, digits, signs = chars / (1 + count("\n")), count("[0-9]+") / chars, count(r"[{}()\[\]=;<>\"|#]") / chars
    values = [np.clip(np.log2(lines + 1), 0, 9), np.clip(digits * 200, 0, 5), np.clip(signs * 50, 0, 5)]
    return np.stack(values, 1).astype(np.int64) + np.cumsum([0, *FIGURES.values()])[:-1]


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Spans of the tokens of a whole text: white space parts them and belongs to none."""
    return [(w.start() + m.start(), w.start() + m.end()) for w in re.finditer(r"[^ \t\n\x0b\f\r]+", text) for m in TOKEN.finditer(w[0])]


def _window(text: str, spans: list[tuple[int, int]], first: int, last: int, values: list[tuple[int, int]]) -> tuple[list[str], list[int]]:
    tokens, tags = [], []
    for s, e in spans[max(0, first) : last]:
        within = next(((a, b) for a, b in values if s < b and a < e), None)
        tags.append(OUTSIDE if within is None else BEGIN if s <= within[0] else INSIDE)
        tokens.append(text[s:e])
    return tokens, tags


def training_windows(docs: DataFrame, windows: int = WINDOWS, clean: int = CLEAN_WINDOWS, context: int = CONTEXT) -> list:
    """Rows ``(matched, tokens, tags, figures)``: at most ``windows`` around matches and ``clean`` without one.

    Every text is looked through for matches; of each slice the EACH_SLICE texts of least hash also give a window from a place that the hash chooses. Equal windows count
    once, and those of least hash are taken, so the choice hangs on the texts alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, texts in text_slices(batch):
                which, figures, out = hinted(texts), file_figures(texts), []
                hashes = [xxhash.xxh3_64_intdigest(t.as_buffer() or b"") for t in texts]
                least = set(np.argsort(np.array(hashes, np.uint64))[:EACH_SLICE].tolist())
                for i in np.flatnonzero(which.any(1) | np.isin(np.arange(len(texts)), list(least))).tolist():
                    text = texts[i].as_py()
                    values = [(x[3], x[4]) for x in base_spans(text, tuple(which[i]))]
                    spans = tokens_of(text)
                    starts = np.array([s for s, _ in spans], np.int64)
                    places = {max(0, int(np.searchsorted(starts, a, "right")) - 1) for a, _ in values}
                    for at in sorted(places):
                        out.append((True, *_window(text, spans, at - context, at + context + 1, values), figures[i].tolist()))
                    if i in least and spans:
                        at = hashes[i] % len(spans)
                        tokens, tags = _window(text, spans, at - context, at + context + 1, values)
                        out.append((BEGIN in tags or INSIDE in tags, tokens, tags, figures[i].tolist()))
                keys = [xxhash.xxh3_64_intdigest("\x00".join(x[1]).encode()) >> 1 for x in out]
                kinds = pa.int64(), pa.bool_(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip([keys, *(list(zip(*out)) or [[]] * 4)], kinds)], names=["key", "matched", "tokens", "tags", "figures"])

    found = docs.mapInArrow(run, "key long, matched boolean, tokens array<string>, tags array<int>, figures array<int>")
    each = settled(found.groupBy("key").agg(F.min(F.struct("matched", "tokens", "tags", "figures")).alias("x")).select("key", "x.*"))
    return [r for m, n in ((True, windows), (False, clean)) for r in each.where(F.col("matched") == m).orderBy("key").limit(n).collect()]


#: Alphabets of strings that keys and passwords are drawn from.
ALPHABETS = (
    "0123456789abcdef", "0123456789ABCDEF", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_",
)


def _drawn(draw: random.Random) -> str:
    return "".join(draw.choices(draw.choice(ALPHABETS), k=draw.randint(16, 48)))


def _redrawn(tokens: list[str], tags: list[int], draw: random.Random) -> tuple[list[str], list[int]]:
    """The secret drawn anew; where there is none, one drawn in place of a token."""
    if BEGIN in tags:
        return [t if tag == OUTSIDE or len(t) < LEAST_VALUE else _drawn(draw) for t, tag in zip(tokens, tags)], tags
    at = draw.randrange(len(tokens))
    return [_drawn(draw) if i == at else t for i, t in enumerate(tokens)], [BEGIN if i == at else tag for i, tag in enumerate(tags)]


class SecretField:
    """Weights of the conditional random field: tables of features, by offset for neighbours, and transitions between tags."""

    def __init__(self, words: list[str], weights: np.ndarray, transitions: np.ndarray):
        self.words, self.transitions = words, transitions
        cuts = np.cumsum([sum(SHAPES.values()), *[CLASSES + len(words)] * len(NEAR), sum(FIGURES.values())])
        self.shapes, *self.near, self.figures = np.split(weights, cuts[:-1])
        t, o = transitions, OUTSIDE
        #: What other tags of one token can gain on both transitions over the tag outside, whatever its neighbours are.
        self.gain = max(t[p, y] + t[y, n] - t[p, o] - t[o, n] for p in range(3) for n in range(3) for y in (BEGIN, INSIDE))

    @classmethod
    def fit(cls, rows: list, steps: int = STEPS, redrawn: int = REDRAWN, seed: int = 0) -> SecretField | None:
        """By Adam on the log-likelihood with a ridge; None if no window has a secret."""
        draw, windows = random.Random(seed), []
        for r in rows:
            if r["tokens"]:
                windows += [(r["tokens"], r["tags"], r["figures"])] + [(*_redrawn(r["tokens"], r["tags"], draw), r["figures"]) for _ in range(redrawn if r["matched"] else 1)]
        if not any(r["matched"] for r in rows):
            return None
        tokens = pa.array([t for w in windows for t in w[0]], pa.string())
        known = Counter(pc.utf8_lower(tokens).to_pylist())
        words = sorted(w for w, n in known.items() if n >= LEAST_WORD and any(map(str.isalpha, w)))
        sizes = np.array([len(w[0]) for w in windows])
        starts = np.append(0, np.cumsum(sizes))
        owner = np.repeat(np.arange(len(windows)), sizes)
        shapes, near = cls._features(tokens, words)
        columns, base = [shapes], sum(SHAPES.values())
        for d in NEAR:
            there, other = _shifted(owner, d)
            for values in near.T:
                column = np.full(len(owner), -1)
                column[there] = np.where((owner[there] == owner[other]) & (values[other] >= 0), values[other] + base, -1)
                columns.append(column[:, None])
            base += CLASSES + len(words)
        figures = np.array([w[2] for w in windows])[owner] + base
        features = np.hstack([*columns, figures])
        weights, transitions = _fit(features, np.array([y for w in windows for y in w[1]]), starts, base + sum(FIGURES.values()), steps)
        return cls(words, weights, transitions)

    @staticmethod
    def _features(tokens: pa.Array, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Shapes of the tokens, and what neighbours see: a class and, if it is known, a word (else -1)."""
        shapes, seen = token_features(tokens)
        word = pc.index_in(pc.utf8_lower(tokens), pa.array(words, tokens.type)).fill_null(-CLASSES - 1).to_numpy(zero_copy_only=False).astype(np.int64)
        return shapes, np.stack([seen, word + CLASSES], 1)

    def scan(self, texts: pa.Array) -> list[list[tuple[int, int]]]:
        """Spans of the secrets of every text."""
        out: list[list[tuple[int, int]]] = [[] for _ in range(len(texts))]
        split = pc.split_pattern_regex(texts, BREAK)
        flat = pc.list_flatten(split)
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        widths = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
        if not widths.any():
            return out
        owner = np.repeat(np.arange(len(texts)), counts)
        at = np.cumsum(widths + 1) - widths - 1
        at -= np.repeat(at[np.minimum(np.cumsum(counts) - counts, len(at) - 1)], counts)
        filled = widths > 0
        owner, at = owner[filled], at[filled]
        parts = flat.filter(pa.array(filled)).dictionary_encode()
        made = list(map(TOKEN.findall, parts.dictionary.to_pylist()))
        tokens = pa.array([t for x in made for t in x], pa.large_string()).dictionary_encode()
        long = pc.utf8_length(tokens.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)
        kind, sizes = tokens.indices.to_numpy(zero_copy_only=False), np.fromiter(map(len, made), np.int64, len(made))
        first = np.cumsum(sizes) - sizes
        begin = np.cumsum(long[kind]) - long[kind]
        begin -= np.repeat(begin[first], sizes)  # within the stretch
        codes = parts.indices.to_numpy(zero_copy_only=False)
        taken = sizes[codes]
        ends = np.cumsum(taken)
        rows = np.repeat(first[codes] - (ends - taken), taken) + np.arange(ends[-1])
        owner, begin, kind = np.repeat(owner, taken), begin[rows] + np.repeat(at, taken), kind[rows]
        shapes, near = self._features(tokens.dictionary, self.words)
        emission = self.shapes[shapes].sum(1)[kind] + self.figures[file_figures(texts)].sum(1)[owner]
        for d, table in zip(NEAR, self.near):
            there, other = _shifted(owner, d)
            scores = table[near[:, 0]] + np.where(near[:, 1:] >= 0, table[near[:, 1]], 0)
            emission[there] += scores[kind[other]] * (owner[there] == owner[other])[:, None]
        tags = self.decode(emission, owner)
        for i in np.flatnonzero(tags != OUTSIDE).tolist():
            own, end = out[owner[i]], int(begin[i] + long[kind[i]])
            if tags[i] == INSIDE and i and tags[i - 1] != OUTSIDE and owner[i - 1] == owner[i]:
                own[-1] = (own[-1][0], end)
            else:
                own.append((int(begin[i]), end))
        return out

    def decode(self, emission: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """The best tags; before and after each text stands an outside tag."""
        tags = np.full(len(emission), OUTSIDE)
        open_ = np.flatnonzero(emission[:, OUTSIDE] - emission[:, :OUTSIDE].max(1) <= self.gain)
        if not len(open_):
            return tags
        new = np.append(True, (np.diff(open_) > 1) | (np.diff(owner[open_]) != 0))
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(open_)))
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        best = emission[open_[first]] + self.transitions[OUTSIDE]
        back = np.zeros((len(open_), 3), np.int8)
        left = len(first)
        for step in range(1, int(size[0])):
            left = int(np.searchsorted(-size, -step, "left"))  # stretches longer than step
            ways = best[:left, :, None] + self.transitions
            back[first[:left] + step] = ways.argmax(1)
            best[:left] = ways.max(1) + emission[open_[first[:left] + step]]
        tag = (best + self.transitions[:, OUTSIDE]).argmax(1)
        for step in range(int(size[0]) - 1, -1, -1):
            left = int(np.searchsorted(-size, -step, "left"))
            where = first[:left] + step
            tags[open_[where]] = tag[:left]
            tag[:left] = back[where, tag[:left]]
        return tags


def _shifted(owner: np.ndarray, d: int) -> tuple[slice, slice]:
    """Places that have a neighbour at offset ``d``, and the neighbours."""
    return slice(max(0, -d), len(owner) - max(0, d)), slice(max(0, d), len(owner) - max(0, -d))


def _fit(features: np.ndarray, tags: np.ndarray, starts: np.ndarray, n_features: int, steps: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature weights and transitions of greatest penalised likelihood; windows run side by side, position by position."""
    n = len(tags)
    sizes = np.diff(starts)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = starts[:-1][order], sizes[order]
    longest = int(sizes[0])
    live = [int(np.searchsorted(-sizes, -k, "left")) for k in range(longest)]
    w, t = np.zeros((n_features + 1, 3)), np.zeros((3, 3))  # the last row is for features that are not there
    flat = features.ravel() % (n_features + 1)
    prior = np.bincount(tags, minlength=3) + 1.0
    truth = np.eye(3)[tags]
    inner = np.ones(n, bool)
    inner[starts[:-1]] = False
    edges = np.zeros((3, 3))
    np.add.at(edges, (np.where(inner, np.roll(tags, 1), OUTSIDE), tags), 1)
    np.add.at(edges, (tags[starts[1:] - 1], OUTSIDE), 1)
    t += np.log(prior / prior.sum()) / 2
    state = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(t), np.zeros_like(t)]
    soft = lambda x, axis: (m := x.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(x - m).sum(axis))
    for step in range(1, steps + 1):
        emission = w[flat].reshape(n, -1, 3).sum(1)
        ahead, behind = np.zeros((n, 3)), np.zeros((n, 3))
        ahead[first] = emission[first] + t[OUTSIDE]
        for k in range(1, longest):
            at = first[: live[k]] + k
            ahead[at] = emission[at] + soft(ahead[at - 1][:, :, None] + t, 1)
        ends = first + sizes - 1
        behind[ends] = t[:, OUTSIDE]
        for k in range(longest - 1, 0, -1):
            at = first[: live[k]] + k
            behind[at - 1] = soft((emission[at] + behind[at])[:, None, :] + t, 2)
        total = soft(ahead[ends] + t[:, OUTSIDE], 1)
        whole = np.empty(n)
        whole[np.repeat(first, sizes) + np.concatenate([np.arange(s) for s in sizes])] = np.repeat(total, sizes)
        node = np.exp(ahead + behind - whole[:, None])
        at = np.flatnonzero(inner)
        pair = np.exp(ahead[at - 1][:, :, None] + t + (emission[at] + behind[at])[:, None, :] - whole[at][:, None, None]).sum(0)
        pair[OUTSIDE] += node[first].sum(0)
        pair[:, OUTSIDE] += node[ends].sum(0)
        error = node - truth
        by_feature = [np.bincount(flat, np.repeat(error[:, y], features.shape[1]), n_features + 1) for y in range(3)]
        grads = [np.stack(by_feature, 1) + RIDGE * w, pair - edges + RIDGE * t]
        grads[0][-1] = 0
        for x, g, mean, square in ((w, grads[0], state[0], state[1]), (t, grads[1], state[2], state[3])):
            mean += 0.1 * (g - mean)
            square += 0.01 * (g * g - square)
            x -= RATE * min(1.0, 3 * (1 - step / (steps + 1))) * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w[:-1], t


def all_spans(base: list[tuple], found: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """``(start, kind, end)``: the patterns' spans, and those of the field that meet none of them."""
    own = [(s, k, e) for s, k, e, *_ in base]
    added = [(s, len(KINDS) - 1, e) for s, e in found if not any(s < b[2] and b[0] < e for b in own)]
    return sorted(own + added)


def said(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


RESULT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text: str = "text", windows: int = WINDOWS, clean: int = CLEAN_WINDOWS) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``: secrets of every whole text, in code points, end exclusive.

    A span of the patterns is the whole match. Null and empty texts have none: zeros, the digest of nothing, no spans. Repeated rows and null or
    tied ids are rows of their own with the same spans; equal windows are learnt from once. Without any match in the table the field is not
    fitted and adds nothing. Columns not named are not read. An empty table gives an empty result.
    """
    typed = narrowed(docs, id_col, text).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    field = SecretField.fit(training_windows(typed, windows, clean))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in text_slices(batch):
                which = hinted(texts)
                found = field.scan(texts) if field else [[]] * len(texts)
                out = []
                for i, own in enumerate(found):
                    base = base_spans(texts[i].as_py(), tuple(which[i])) if which[i].any() else []
                    kinds = Counter(x[1] for x in base)
                    plain = said([x[:3] for x in base])
                    out.append((kinds[0], kinds[1], kinds[2], hashlib.sha256(plain.encode()).hexdigest(), said(all_spans(base, own)) if own else plain))
                made = [pa.array(v, k) for v, k in zip(zip(*out), (pa.int64(),) * 3 + (pa.string(),) * 2)]
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *made], names=[f.split()[0] for f in RESULT.split(", ")])

    return typed.mapInArrow(run, RESULT)
