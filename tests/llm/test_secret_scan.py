"""Secret scans: the patterns against their plain form, the field against full Viterbi and plain counts."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from dayrisk.llm import secret_scan

from .helpers import DOCS, documents, prose

HEX40 = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
KEYWORDS = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def plain_base(text):
    found = [(m.start(), 0, m.end()) for m in KEYWORDS.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


PARTS = ["password", "PassWD", "ſecret", "secret", "toKen", "api_key", "apikey", "API_KEY", '"', "'", " ", "  ", ":", "=", "\t", "\n", "abcdef", "abc", "é", "AKIA", "A" * 16, "Z9" * 9, "0a" * 11, "f" * 13, "-./+", "K"]


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
def test_patterns(text):
    assert [x[:3] for x in secret_scan.base_spans(text)] == plain_base(text)
    which = secret_scan.hinted(pa.array([text], pa.large_string()))[0]
    assert [x[:3] for x in secret_scan.base_spans(text, tuple(which))] == plain_base(text)


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 60), st.floats(0.2, 6))
def test_cut_chains_give_the_best_path(seed, n, width):
    draw = np.random.default_rng(seed)
    field = secret_scan.SecretField([], np.zeros((sum(secret_scan.SHAPES.values()) + 4 * secret_scan.CLASSES + sum(secret_scan.FIGURES.values()), 3)), draw.normal(size=(3, 3)))
    owner = np.sort(draw.integers(0, 3, n))
    scores = draw.normal(size=(n, 3)) * width
    scores[:, secret_scan.OUTSIDE] += draw.choice([0, 8], n)
    got = field.decode(scores, owner)
    want = []
    for o in np.unique(owner):
        own, t = scores[owner == o], field.transitions
        best, back = own[0] + t[2], []
        for e in own[1:]:
            ways = best[:, None] + t
            back.append(ways.argmax(0))
            best = ways.max(0) + e
        tag = int((best + t[:, 2]).argmax())
        path = [tag]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        want += path[::-1]
    assert got.tolist() == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8", exclude_characters="\x00"), min_size=1, max_size=30), min_size=1, max_size=5))
def test_token_features(tokens):
    shapes, seen = secret_scan.token_features(pa.array(tokens, pa.large_string()))
    base = np.cumsum([0, *secret_scan.SHAPES.values()])[:-1]
    kind = lambda c: int(secret_scan.KIND[min(ord(c), 0x2FFF)])
    for token, row in zip(tokens, shapes - base):
        token_ = [chr(min(ord(c), 0x2FFF)) for c in token]
        kinds = Counter(map(kind, token))
        n = len(token)
        assert row[0] == (kinds[1] > 0) * 8 + (kinds[2] > 0) * 4 + (kinds[3] > 0) * 2 + (kinds[0] > 0)
        entropy = -sum(c / n * math.log2(c / n) for c in Counter(token_).values())
        assert abs(row[3] - min(15, 2 * entropy)) < 1 + 1e-9
        sort = ["l" if kind(c) in (1, 2) else kind(c) for c in token]
        assert row[4] == min(9, sum(a != b for a, b in zip(sort, sort[1:])))
    assert (shapes - base < np.array([*secret_scan.SHAPES.values()])).all() and (seen < secret_scan.CLASSES).all()


@pytest.mark.parametrize("seed", range(3))
def test_gradient_steps_raise_the_likelihood_of_the_tags(seed):
    draw = np.random.default_rng(seed)
    sizes = draw.integers(1, 5, 12)
    starts = np.append(0, np.cumsum(sizes))
    features = draw.integers(-1, 6, (starts[-1], 2))
    features[:, 1] += np.where(features[:, 1] >= 0, 6, 0)
    tags = draw.integers(0, 3, starts[-1])

    def loss(w, t):
        w, total = np.vstack([w, np.zeros(3)]), 0.0
        for s, e in zip(starts, starts[1:]):
            emission = w[features[s:e]].sum(1)
            score = lambda path: sum(emission[i, y] for i, y in enumerate(path)) + sum(t[a, b] for a, b in zip((2, *path), (*path, 2)))
            total += np.log(sum(np.exp(score(p)) for p in itertools.product(range(3), repeat=e - s))) - score(tags[s:e])
        return total + secret_scan.RIDGE / 2 * ((w**2).sum() + (t**2).sum())

    w, t = secret_scan._fit(features, tags, starts, 12, 400)
    best = loss(w, t)
    for _ in range(30):  # no neighbour of the optimum is better
        assert loss(w + draw.normal(size=w.shape) * 0.05, t + draw.normal(size=t.shape) * 0.05) >= best - 1e-3


def corpus(n=150):
    texts = [prose(i, 60) + f"\nnext {i} token = \"{hashlib.sha1(str(i).encode()).hexdigest()}\" " + prose(i + 1, 40) if i % 3 == 0 else prose(i, 120) for i in range(n)]
    return texts


def test_documents(spark):
    extra = [
        None, "", "password=hunter22", "password=short", f"é {HEX40} é", "AKIA" + "Q" * 16, "AKIA" + "Q" * 15, "x " * 60_000 + "secret: abcdef_123", "secret: abcdef_123\n" * 3,
        "secret=token:abcdefg", "tabs\tand　wide  spaces", f"{HEX40.upper()} " * 2,
    ]
    docs = documents(spark, corpus() + extra).withColumns({c: F.lit(0) for c in ("key", "matched", "tags", "spans")})
    rows = {r["doc_id"]: r for r in secret_scan.scan_documents(docs).collect()}
    texts = corpus() + extra
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        want = plain_base(text or "")
        kinds = Counter(k for _, k, _ in want)
        base = ",".join(f"{secret_scan.KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert (rows[i]["n_assign"], rows[i]["n_access"], rows[i]["n_hex"]) == (kinds[0], kinds[1], kinds[2])
        assert rows[i]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        said = [(int(s), secret_scan.KINDS.index(k), int(e)) for k, s, e in (x.split(":") for x in rows[i]["spans"].split(",") if x)]
        assert said == sorted(said) and [x for x in said if x[1] < 3] == want
        added = [x for x in said if x[1] == 3]
        assert not any(s < b[2] and b[0] < e for s, _, e in added for b in want)
        if i < 150:
            assert not added
    assert any("crf" in rows[i]["spans"] for i in range(150, len(texts)))


def test_the_field_finds_more_than_the_patterns_and_leaves_text_alone(spark):
    field = secret_scan.SecretField.fit(secret_scan.training_windows(documents(spark, corpus(400))))
    draw = random.Random(7)
    drawn = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", k=36)) for _ in range(40)]
    texts = [prose(900 + i, 30) + f" signed {x}, " + prose(950 + i, 30) for i, x in enumerate(drawn)]
    found = field.scan(pa.array(texts, pa.large_string()))
    assert sum([t[s:e] for s, e in spans] == [x] for t, spans, x in zip(texts, found, drawn)) >= 36
    calm = [prose(i, 300) for i in range(2000, 2040)] + ["call 4111111111111111 or 192.168.0.1, mail x.y@example.com, 12,345.67 on 2024-01-31"]
    assert not any(field.scan(pa.array(calm, pa.large_string())))


def test_repeated_rows_null_ids_and_no_match(spark):
    rows = [(None, "plain words", None, None, 1), (3, "plain words", "en", "s", 1), (3, "plain words", "en", "s", 1)]
    got = [tuple(r) for r in secret_scan.scan_documents(spark.createDataFrame(rows, DOCS)).collect()]
    nothing = (0, 0, 0, hashlib.sha256(b"").hexdigest(), "")
    assert sorted(got, key=str) == sorted([(None, *nothing), (3, *nothing), (3, *nothing)], key=str)


def test_empty_table(spark):
    assert secret_scan.scan_documents(spark.createDataFrame([], DOCS)).collect() == []
