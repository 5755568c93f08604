"""Cross-tokenizer alignment against sets of byte ends and the tokenizers themselves."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dayrisk.llm import alignment

from .helpers import DOCS, documents, prose

TEXTS = [
    None, "", "a", " ", "  two  spaces ", "a <|endoftext|> b", "</s> <s> <unk> [INST]", "tab\tand\nline\r\n", "a ▁ b", "x▁", "naïve Übermut señor", "日本語のテキスト", "😀 zero\x00char",
    "ﬁ ① 　 wide", "same words here", "same words here", "é combining", "  \x85 odd", "A" * 3000, prose(3, 3000), "1234567890 " * 50, "trailing space ", "﻿mark",
]


@pytest.fixture(scope="module")
def plain():
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    alphabet = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in printable)}
    spelt = {i: bytes(alphabet[c] for c in t) for t, i in first.get_vocab().items() if i != 50256}

    def piece(i):
        p = second.id_to_piece(i)
        m = re.fullmatch("<0x([0-9A-F]{2})>", p)
        return bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()

    def ranges(text):
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        parts = [spelt[i] for i in a], [piece(i) for i in b]
        if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
            return [], [], [], []
        return a, b, *(np.cumsum([len(x) for x in p]).tolist() for p in parts)

    return ranges


def expected(plain, texts):
    docs, counts = [], Counter()
    for text in texts:
        a, b, ae, be = plain(text or "")
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(ae) & set(be)):
            i2, j2 = ae.index(cut) + 1, be.index(cut) + 1
            groups.append((a[i:i2], b[j:j2]))
            for u in range(i, i2):
                for v in range(j, j2):
                    if max(ae[u - 1] if u else 0, be[v - 1] if v else 0) < min(ae[u], be[v]):
                        links.append((a[u], b[v]))
            i, j = i2, j2
        counts.update(links)
        said = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(said.encode()).hexdigest() if a else ""))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    return [(na, nb, ng, len(ls), sum(counts[x] == highest[x[1]] for x in ls), sum(counts[x] for x in ls), said) for na, nb, ng, ls, said in docs]


def test_documents_equal_the_plain_version(spark, plain):
    docs = documents(spark, TEXTS).withColumns({c: F.lit(1) for c in ("chunk", "Pair", "packed", "n_a", "told")}).repartition(3, "doc_id")
    got = {r["doc_id"]: tuple(r)[1:] for r in alignment.align_documents(docs).collect()}
    for i, want in enumerate(expected(plain, TEXTS)):
        assert got[i] == want, TEXTS[i]
    assert got[0] == got[1] == (0, 0, 0, 0, 0, 0, "") == got[8]


def test_repeated_rows_and_null_ids(spark, plain):
    rows = [(None, "one two", None, None, 1), (4, "one two", "en", "s", 1), (4, "one two", "en", "s", 1), (5, "naïve two", "en", "s", 1)]
    got = alignment.align_documents(spark.createDataFrame(rows, DOCS).coalesce(1)).collect()
    assert sorted((str(r[0]), tuple(r)[1:]) for r in got) == sorted((str(r[0]), x) for r, x in zip(rows, expected(plain, [r[1] for r in rows])))


def test_empty_table(spark):
    out = alignment.align_documents(spark.createDataFrame([], DOCS))
    assert out.collect() == [] and out.columns == [f.split()[0] for f in alignment.RESULT.split(", ")]


def test_groups_of_a_document(spark):
    (row,) = alignment.token_groups(documents(spark, ["the tokenizers disagree"])).collect()
    twin = alignment.twin_tokenizer(None, None)
    parts = []
    for ids, starts, spelt in ((row.a, row.a_starts, twin.a_bytes), (row.b, row.b_starts, twin.b_bytes)):
        cuts = [*starts, len(ids)]
        parts.append([b"".join(spelt[i] for i in ids[s:e]) for s, e in zip(cuts, cuts[1:])])
    assert parts[0] == parts[1] and b"".join(parts[0]) == b" the tokenizers disagree"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=400), st.lists(st.integers(1, 200), max_size=4))
def test_cuts_are_the_common_ends(marks, runs):
    ends = [(i, x or not y, y) for i, (x, y) in enumerate(marks)]
    a, b = [i for i, x, _ in ends if x], [i for i, x, y in ends if y or not x]
    at = len(marks)
    for n in runs:  # long one-to-one stretches between irregular groups
        a += list(range(at, at + n)) + [at + n + 1]
        b += list(range(at, at + n)) + [at + n, at + n + 1]
        at += n + 2
    a, b = a + [at], b + [at]
    starts = alignment.cut_groups(np.array(a), np.array(b))
    common = sorted(set(a) & set(b))
    assert [s.tolist() for s in starts] == [[0] + [x.index(c) + 1 for c in common[:-1]] for x in (a, b)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=40), min_size=1, max_size=6))
def test_any_text(plain, texts):
    x = alignment.Aligned(alignment.twin_tokenizer(None, None), pa.array(texts, pa.large_string()))
    for i, (na, nb, ng, nl, _, _, said) in enumerate(expected(plain, texts)):
        assert (x.n_a[i], x.n_b[i], x.n_groups[i], x.n_links[i]) == (na, nb, ng, nl)
        assert x.digests()[i] == said
    assert Counter(x.links().tolist()) == Counter(a * len(x.twin.b_bytes) + b for t in texts for a, b in _links(plain, t))


def _links(plain, text):
    a, b, ae, be = plain(text)
    return [(a[u], b[v]) for u in range(len(a)) for v in range(len(b)) if max(ae[u - 1] if u else 0, be[v - 1] if v else 0) < min(ae[u], be[v])]
