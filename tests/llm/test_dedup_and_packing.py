import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer
import public_tokenizers

from dayrisk.llm import exact_dedup, near_dedup, packing
from tests.llm.helpers import documents, near_classes, prose

TEXTS = ["Ab c", "aB C", None, "", "É", "é", "ab c ", "x" * 50_000, "X" * 50_000, "Ab c", "\n", "only once"]


def folded(text):
    return (text or "").encode().lower()


def test_exact_groups_equal_a_dictionary(spark):
    got = {r.doc_id: r for r in exact_dedup.exact_groups(documents(spark, TEXTS)).collect()}
    groups = {}
    for i, t in enumerate(TEXTS):
        groups.setdefault(folded(t), []).append(i)
    for i, t in enumerate(TEXTS):
        own = groups[folded(t)]
        assert (got[i].keep_id, got[i].group_size, got[i].kept) == (max(own), len(own), i == max(own))
        assert got[i].text_sha256 == hashlib.sha256(folded(t)).hexdigest()


def test_exact_dedup_keeps_one_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a", "x", 1), (1, "A", "y", 2), (1, "b", "z", 3), (None, "c", "n", 4), (None, "C", "n", 5), (2, None, "q", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, size int")
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, folded(r.text)) for r in kept.collect()) == [(0, b"c"), (1, b"a"), (1, b"b"), (2, b"")]
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**52 - 1), max_size=60), min_size=1, max_size=4))
def test_filters_merge_without_loss(parts):
    filters = []
    for part in parts:
        keys, counts = np.unique(np.array(part, np.uint64), return_counts=True)
        own = exact_dedup.CountingQuotientFilter.of_sorted(keys, counts)
        filters.append(exact_dedup.CountingQuotientFilter.from_bytes(*own.to_bytes()))
    merged = exact_dedup.CountingQuotientFilter.merge(filters)
    keys, counts = np.unique(np.array(sum(parts, []), np.uint64), return_counts=True)
    assert merged.keys().tolist() == keys.tolist() and merged.counts.tolist() == counts.tolist()
    assert merged.repeated()[0].tolist() == keys[counts > 1].tolist()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 30), max_size=12))
def test_bins_hold_every_piece_and_none_is_too_full(histogram):
    patterns = packing.plan_bins(histogram, 60)
    held = {}
    for pattern, repeats in patterns:
        assert sum(length * n for length, n in pattern.items()) <= 60
        for length, n in pattern.items():
            held[length] = held.get(length, 0) + n * repeats
    assert held == histogram


def test_fullest_combination_is_the_best_there_is():
    counts = np.zeros(101, np.int64)
    counts[[7, 11, 23, 40]] = [3, 2, 1, 2]
    best = max(a * 7 + b * 11 + c * 23 + d * 40 for a in range(4) for b in range(3) for c in range(2) for d in range(3) if a * 7 + b * 11 + c * 23 + d * 40 <= 97)
    assert sum(length * n for length, n in packing.fullest(counts, [40, 23, 11, 7], 97)) == best


def test_pieces_are_the_tokenizers_ids_and_fit_together(spark):
    texts = ["one two", None, "", " lead", "tail ", "a  b", "x\n\n y", "nul\x00 z", "<|endoftext|> it's 12345", "a <|endoftext|> b<|endoftext|>", "日本語 テキスト 　x", "a  b", prose(1, 6000), "Z" * 9000, "same", "same"]
    docs = documents(spark, texts).repartition(3)
    encode = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack_documents(docs).toPandas()
    for i, text in enumerate(texts):
        ids = encode.encode(text or "", add_special_tokens=False).ids + [0]
        own = rows[rows.doc_id == i].sort_values("piece")
        assert own.length.sum() == len(ids) and own.piece.tolist() == list(range(len(own)))
        assert (own.length.iloc[1:] == 2048).all()
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    placed = rows.sort_values(["sequence_id", "offset"])
    assert (placed.groupby("sequence_id").length.cumsum() - placed.length == placed.offset).all()
    assert placed.groupby("sequence_id").length.sum().max() <= 2048
    assert rows.sequence_id.nunique() == -(-rows.length.sum() // 2048)
    whole = {r.sequence_id: r.ids for r in packing.sequences(docs).collect()}
    assert sum(map(len, whole.values())) == rows.length.sum() and max(map(len, whole.values())) <= 2048
    assert packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shares, waiting", [(1, 1 << 20), (4, 50), (4096, 1)])
def test_a_class_with_a_third_of_all_rows(spark, monkeypatch, shares, waiting):
    monkeypatch.setattr(exact_dedup, "WAITING", waiting)
    texts = ["Hot text"] * 200 + [f"copy {i // 2}" for i in range(200)] + [f"alone {i}" for i in range(200)]
    rows = exact_dedup.exact_groups(documents(spark, texts).repartition(5), shares=shares).collect()
    assert len(rows) == 600
    for r in rows:
        own = [i for i, t in enumerate(texts) if t == texts[r.doc_id]]
        assert (r.keep_id, r.group_size, r.kept) == (max(own), len(own), r.doc_id == max(own))


def test_ranges_grow_with_the_rows():
    assert [exact_dedup.range_bits(n) for n in (0, 10**6, 10**9, 10**11, 10**15)] == [8, 8, 12, 19, 31]
    keys = np.random.default_rng(0).integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2)
    for bits in (8, 19, 31):
        inner = np.uint64(64 - bits)
        own = np.unique(keys & ((np.uint64(1) << inner) - np.uint64(1)))
        assert (exact_dedup.CountingQuotientFilter.of_sorted(own, np.ones(len(own), np.uint64)).keys() == own).all()


PARTS = st.sampled_from([" ", "  ", "\n", "\t", "a", "Word", " the", "'s", "42", "é", "日本", "\x00", "\u3000", "\x85", "<|endoftext|>", "<|", "😀"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(PARTS, max_size=12).map("".join), min_size=1, max_size=6), st.booleans())
def test_stretches_encoded_together_give_the_ids_of_whole_texts(texts, special):
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    plain.encode_special_tokens = not special
    ids, bounds = packing.tokenizer(public_tokenizers.path("byte_bpe_50k.tiktoken"), special).encode_flat(pa.array(texts, pa.large_string()))
    for text, a, b in zip(texts, bounds, bounds[1:]):
        assert ids[a:b].tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(1, 6), max_size=20), max_size=4))
def test_places_among_equals(batches):
    before, seen = np.zeros(7, np.int64), {}
    for values in batches:
        got = packing.places_among_equals(np.array(values, np.int64), before)
        for v, place in zip(values, got.tolist()):
            assert place == seen.get(v, 0)
            seen[v] = place + 1


def test_signatures_agree_as_often_as_the_multisets_overlap():
    draw = np.random.default_rng(3)
    agree, overlap = [], []
    for _ in range(60):
        a = np.sort(draw.integers(0, 2**63, 200).astype(np.uint64))
        counts = draw.integers(1, 9, 200)
        other = counts.copy()
        other[:70] = draw.integers(1, 9, 70)
        agree.append((near_dedup.signature(a, counts) == near_dedup.signature(a, other)).mean())
        overlap.append(near_dedup.weighted_jaccard((a, counts), (a, other)))
    assert np.mean(agree) == pytest.approx(np.mean(overlap), abs=0.02)


def test_near_classes_equal_all_pairs(spark):
    texts = [None, "", "", "!!", "one two", "One, two!", "one two three"]
    for seed in range(6):
        words = prose(seed, 120).split()
        texts.append(" ".join(words))
        for k in range(12):  # copies with more and more words changed, some over the limit
            for j in range(1 + k // 3):
                words[(31 * k + 17 * j) % len(words)] = f"new{seed}x{k}x{j}"
            texts.append(" ".join(words))
    texts += [" ".join(["again and again my friend"] * n) for n in (3, 10, 11, 40)] + [prose(90, 3000), prose(90, 3000) + " end"]
    rows = near_dedup.near_groups(documents(spark, texts)).toPandas().sort_values("doc_id")
    assert rows.class_id.tolist() == near_classes(texts)
    assert (rows[rows.kept].doc_id == rows[rows.kept].class_id).all() and rows.kept.sum() == rows.class_id.nunique()
    assert (rows.class_size == rows.groupby("class_id").doc_id.transform("size")).all()


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 8)
    base = prose(5, 90).split()
    texts = []
    for k in range(60):
        words = list(base)
        for j in range(k % 5):
            words[(k * 13 + j * 29) % len(words)] = f"v{k}y{j}"
        texts.append(" ".join(words))
    rows = near_dedup.near_groups(documents(spark, texts)).toPandas().sort_values("doc_id")
    assert rows.class_id.tolist() == near_classes(texts)


def test_a_pair_is_not_lost_where_bytes_of_an_earlier_band_agree_by_chance():
    draw = np.random.default_rng(1)
    tags = np.tile(draw.integers(0, 2**63, near_dedup.SIZE, dtype=np.uint64), (2, 1))
    tags[1, : near_dedup.ROWS * 2] += np.uint64(1)
    tags[1, 0] += np.uint64(255)  # band 0: four components agree and one only in its last byte
    tags[1, 1 : near_dedup.ROWS] -= np.uint64(1)
    keys = [[hash(t[i : i + near_dedup.ROWS].tobytes()) for i in range(0, near_dedup.SIZE, near_dedup.ROWS)] for t in tags]
    assert [a == b for a, b in zip(*keys)] == [False, False] + [True] * (near_dedup.BANDS - 2)
    bag = near_dedup.Bag.write(np.arange(50, dtype=np.uint64) << np.uint64(32), np.ones(50, np.int64))
    rows = [(i + 1, i + 1, 0, 50, 0, (t & np.uint64(255)).astype(np.uint8).tobytes(), *bag, k) for i, (t, k) in enumerate(zip(tags, keys))]
    assert [near_dedup.block_links(rows, band) for band in (2, 3)] == [[(1, 2)], []]


def test_near_dedup_keeps_columns_and_repeated_rows_once(spark):
    rows = [(1, prose(1, 40), 1, "k"), (1, prose(1, 40), 1, "k"), (2, prose(1, 40).upper(), 2, "k"), (None, prose(2, 40), 3, "k")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node long, label string")
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1]
    assert near_dedup.near_groups(docs.limit(0)).count() == 0
