"""The Merkle manifest against trees built by plain lists."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dayrisk.llm import merkle

from .helpers import DOCS


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def expected(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append((row[0] is not None, row[0], leaf((row[0], row[3], row[2], row[4], row[1])), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        groups[name].sort(key=lambda x: (x[0], x[1] or 0, x[2]))
    trees = {name: levels([x[2] for x in groups[name]]) for name in names}
    last = levels([trees[name][-1][0] for name in names])
    out = []
    for at, name in enumerate(names):
        for i, (_, doc, digest, row) in enumerate(groups[name]):
            text = row[1]
            if doc is not None and text is not None and zlib.crc32(str(doc).encode()) % 2 == 0:
                text = text.replace("\n", "")
            folded, proof = leaf((row[0], row[3], row[2], row[4], text)), ""
            for tree, j in ((trees[name], i), (last, at)):
                for level in tree[:-1]:
                    first = j // 3 * 3
                    left, right = "".join(level[first:j]), "".join(level[j + 1 : first + 3])
                    proof += left + right
                    folded, j = h(left + folded + right), j // 3
            out.append((doc, digest, trees[name][-1][0], last[-1][0], h(proof), folded, folded == last[-1][0]))
    return out


def check(spark, rows, extra=()):
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(7) for c in extra})
    got = [tuple(r) for r in merkle.check_documents(docs).collect()]
    assert sorted(got, key=str) == sorted(expected(rows), key=str)
    return got


def test_trees_of_many_depths(spark):
    rows = []
    for name, n in (("one", 1), ("two", 2), ("three", 3), ("nine", 9), ("ten", 10), ("bucket", 81), ("over", 82), ("hot", 7000), ("é", 28), ("Z", 27), ("z", 243), (None, 5), ("", 4)):
        rows += [(len(rows) * 7 + i, f"line {i}\nof {name}" if i % 3 else f"text {i}", "en", name, i) for i in range(n)]
    got = check(spark, rows)
    assert any(r[-1] for r in got) and not all(r[-1] for r in got)


def test_nulls_ties_and_clashing_columns(spark):
    rows = [
        (None, "a\nb", "en", "s", 3), (None, None, None, "s", None), (5, None, "en", "s", None), (5, "", "en", "s", 0), (5, "", "en", "s", 0),
        (6, "x\n" * 40_000, None, None, 80_000), (8, "ü\n§", "de", None, 3), (-2, "\n", "de", "t", 1),
    ]
    check(spark, rows, extra=("tree", "Rank", "n", "digest", "_part", "_at", "bucket", "path", "claim", "at"))


def test_empty_table(spark):
    out = merkle.check_documents(spark.createDataFrame([], DOCS))
    assert out.collect() == [] and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_paths_say_where_siblings_stand(spark):
    rows = [(i, f"t{i}", "en", f"s{i % 2}", i) for i in range(14)]
    got = merkle.manifest(spark.createDataFrame(rows, DOCS)).collect()
    for r in got:
        assert [s["level"] for s in r["path"]][:2] == [1, 2] and len(r["path"]) == 3
        node = r["leaf"]
        for step in r["path"]:
            node = h(step["left"] + node + step["right"])
        assert node == r["root"]


def test_ranks_of_one_large_group_come_from_many_partitions(spark):
    rows = spark.range(50_000).select(F.when(F.col("id") < 49_000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("tree"), F.hash("id").alias("v"), "id")
    out = merkle.ranked(rows, "tree", "v", "id")
    wrong = out.selectExpr("rank", "n", "row_number() OVER (PARTITION BY tree ORDER BY v, id) - 1 AS r", "count(*) OVER (PARTITION BY tree) AS c").where("rank <> r OR n <> c")
    assert wrong.count() == 0 and out.count() == 50_000


@pytest.mark.parametrize("text", ["plain", "", "\n"])
def test_a_lone_document_is_its_own_root(spark, text):
    (row,) = merkle.check_documents(spark.createDataFrame([(3, text, "en", "s", 0)], DOCS)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == h("")
