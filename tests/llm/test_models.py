import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dayrisk.llm import labelled, language_id, quality, toxicity
from tests.llm.helpers import documents, prose

WHITE = "[^\x20\x09-\x0d]+"


def base_counts(text):
    """The base counts of the contract, word by word."""
    words = re.findall(WHITE, text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(WHITE, line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeat = {k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(i, i + 3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(repeat)


EDGES = [None, "", " \t\n", "a b c a b c d", "x x x x", "l1\nl1\n \nl1\nl2 ## |", " é\x85 b\x0bc\x1cd", "α β γ " * 60, prose(1, 300)]


def test_base_counts_equal_the_plain_version(spark):
    rows = quality.judge_documents(documents(spark, EDGES), spark.createDataFrame([], "doc_id long, quality int, toxic int")).collect()
    for r in rows:
        expected = base_counts(EDGES[r.doc_id])
        assert tuple(r[c] for c in quality.BASE) == expected
        assert r.base_failed == (expected[0] < 50 or 100 * expected[4] > 50 * expected[0])
        assert not (r.base_failed and r.kept)


def test_quality_trees_tell_junk_and_empty_tables_pass(spark):
    good = [prose(i, 120, 4000) for i in range(150)]
    junk = [" ".join(w + "### ***" for w in prose(i, 120, 4000).split()) for i in range(150)]
    docs = documents(spark, good + junk)
    labels = spark.range(0, 300, 2).select(F.col("id").alias("doc_id"), (F.col("id") < 150).cast("int").alias("quality"), F.lit(0).alias("toxic"))
    rows = quality.judge_documents(docs, labels).toPandas()
    assert rows[rows.doc_id < 150].kept.all() and not rows[rows.doc_id >= 150].kept.any()
    assert quality.judge_documents(docs.limit(0), labels.limit(0)).count() == 0


def test_trees_are_monotonic_where_told():
    draw = np.random.default_rng(0)
    x = draw.random((3000, 3))
    y = (draw.random(3000) < np.clip(0.2 + 0.6 * x[:, 0] + 0.3 * np.sin(9 * x[:, 0]) - 0.5 * x[:, 1], 0, 1)).astype(float)
    trees = quality.BoostedTrees.fit(x, y, [1, -1, 0])
    grid = np.linspace(0, 1, 200)
    for other in draw.random((20, 3)):
        rows = np.tile(other, (200, 1))
        rows[:, 0] = grid
        assert (np.diff(trees.margin(rows)) >= -1e-9).all()
        rows = np.tile(other, (200, 1))
        rows[:, 1] = grid
        assert (np.diff(trees.margin(rows)) <= 1e-9).all()
    p = trees.probability(x)
    assert -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p)) < -np.mean(y * np.log(y.mean()) + (1 - y) * np.log(1 - y.mean()))


def test_toxicity_finds_held_out_texts(spark):
    texts = [prose(i, 80) + (" stupid idiot" if i % 4 == 0 else "") for i in range(400)] + [None, ""]
    labels = spark.range(400).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), (F.col("id") % 4 == 0).cast("int").alias("toxic"))
    rows = toxicity.score_documents(documents(spark, texts), labels).toPandas()
    held = rows[rows.held_out & (rows.doc_id < 400)]
    assert len(rows) == 402 and rows.score.between(0, 1).all()
    assert ((held.doc_id % 4 == 0).astype(int) == held.predicted).all()
    none = toxicity.score_documents(documents(spark, texts[:3]), labels.limit(0)).toPandas()
    assert (none.predicted == 0).all() and toxicity.score_documents(documents(spark, []), labels).count() == 0


def test_counterfactuals_take_the_weight_off_group_names():
    """A group named more often in toxic texts gets a weight; the penalty shrinks the change under exchange."""
    index = {"muslim": 0, "christian": 1, "idiot": 2}
    bag = lambda words: np.array(sorted(index[w] for w in words if w in index), np.uint16).tobytes()
    rows = []
    for i in range(400):
        words = (["muslim"] if i % 2 else ["christian"]) + (["idiot"] if i % 2 and i % 3 or i % 10 == 0 else [])
        other = toxicity.swapped(words)
        rows.append((int("idiot" in words), bag(words), bag(["christian" if w == "muslim" else "muslim" if w == "christian" else w for w in words])))
        assert other is not None
    data = pd.DataFrame(rows, columns=["label", "own", "other"])
    plain, fair = toxicity.fit(data, 3, 0.0), toxicity.fit(data, 3, 5.0)
    assert abs(fair[0] - fair[1]) < 0.5 * abs(plain[0] - plain[1]) and fair[2] > 2
    assert toxicity.swapped(["a", "neutral", "text"]) is None


LANGS = {"en": "the house and a river that was of with", "de": "das haus und der fluss mit dem nicht ein", "es": "la casa y el río que de con una"}


def test_language_of_held_out_documents(spark):
    draw = np.random.default_rng(1)
    texts, langs = [], []
    for i in range(300):
        lang = list(LANGS)[i % 3]
        texts.append(" ".join(draw.choice(LANGS[lang].split(), 30)))
        langs.append(lang)
    texts += [None, "", "123 !?", "hausfluss", "́"]
    langs += [None, "en", "de", None, "en"]
    rows = language_id.identify_documents(documents(spark, texts, langs)).toPandas().set_index("doc_id")
    assert (rows.lang_pred[:300].to_numpy() == np.array(langs[:300])).all() and rows.score.between(0, 1).all()
    assert rows.lang_pred[300:303].tolist() == ["und"] * 3 and rows.lang_pred[303] == "de" and rows.lang_pred[304] == "und"
    assert language_id.identify_documents(documents(spark, [])).count() == 0


def test_backoff_takes_the_longest_known_ngrams():
    entry = lambda names, value: language_id.Entries({n: i for i, n in enumerate(names)}, np.arange(len(names) + 1), np.zeros(len(names), int), np.full(len(names), value), np.zeros(1))
    model = language_id.LanguageModel(["xx"], {0: entry(["word"], 1.0), 5: entry([], 0), 4: entry([], 0), 3: entry(["<wo"], 2.0), 2: entry([], 0), 1: entry(["<"], 3.0)})
    assert [model.word(w)[0] for w in ("word", "worm", "zebra")] == pytest.approx([1.0, 2.0, 3.0])


def test_languages_are_told_as_by_the_sum_of_their_words(spark):
    draw = np.random.default_rng(2)
    texts, langs = [], []
    for i in range(240):
        lang = list(LANGS)[i % 3]
        texts.append(" ".join(draw.choice(LANGS[lang].split(), 12)) + (" zzqy 12" if i % 4 == 0 else ""))
        langs.append(lang)
    docs = documents(spark, texts, langs)
    model = language_id.LanguageModel.learn(docs, F.lit(True))
    asked = texts[:60] + ["", "x", "1 2", "hausfluss zebra", "é"]
    names, scores = model.predictor()(pa.array(asked, pa.large_string()))
    for text, name, score in zip(asked, names, scores):
        words = [w for w in re.findall(r"[^\W\d_]+", text.lower())]
        if not words:
            assert (name, score) == ("und", 0.0)
            continue
        total = sum((model.word(w) for w in words), np.zeros(3))
        odds = np.exp(total - total.max())
        assert name == model.languages[int(odds.argmax())] and score == pytest.approx(odds.max() / odds.sum(), rel=1e-4)


def test_three_hundred_languages_and_a_script_of_many_characters(spark):
    draw = np.random.default_rng(3)
    own = {f"l{k:03}": ["".join(draw.choice(list("abcdefghijklmnopqrstuvwxyz"), 7)) for _ in range(12)] for k in range(300)}
    signs = [chr(0x4E00 + i) for i in range(3000)]
    texts, langs = [], []
    for lang, words in own.items():
        for _ in range(4):
            texts.append(" ".join(draw.choice(words, 20)))
            langs.append(lang)
    for _ in range(60):
        texts.append(" ".join("".join(draw.choice(signs, 6)) for _ in range(60)))
        langs.append("signs")
    model = language_id.LanguageModel.learn(documents(spark, texts, langs), F.lit(True))
    assert len(model.languages) == 301 and sum(s in model.entries[1].rows for s in signs) > 2900
    names, _ = model.predictor()(pa.array([" ".join(words) for words in own.values()] + ["".join(draw.choice(signs, 5)) for _ in range(20)], pa.large_string()))
    assert names == [*own, *["signs"] * 20]


def test_repeated_ids_long_texts_and_clashing_columns(spark):
    long = "haus fluss " * 20_000
    rows = [(1, long, "de", "s", 1), (1, long, "de", "s", 1), (None, "house river", "en", "s", 1), (2, "house river", "en", "s", 1), (3, None, None, None, None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit("x") for c in ("entry", "kind", "lang_pred", "score", "n")})
    got = language_id.identify_documents(docs).collect()
    assert len(got) == 15 and {r.lang_pred for r in got if r.doc_id == 3} == {"und"} and all(0 <= r.score <= 1 for r in got)


def test_judges_and_scores_take_any_row(spark):
    long = "plain words of a long document that goes on and on, line after line. " * 20_000
    rows = [(1, long, "en", "s", 1), (1, long, "en", "s", 1), (None, "you stupid idiot " * 30, "en", "s", 1), (2, "", "en", "s", 1), (3, None, None, None, None)]
    rows += [(10 + i, prose(i, 80) + (" stupid idiot" if i % 2 else ""), "en", "s", 1) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumns({c: F.lit(9) for c in ("label", "kept", "score", "n_words", "probability")})
    labels = spark.createDataFrame([(10 + i, 1, i % 2) for i in range(60)] + [(1, 1, 0), (None, 1, 1), (12, None, None)], "doc_id long, quality int, toxic int")
    judged = quality.judge_documents(docs, labels).collect()
    scored = toxicity.score_documents(docs, labels).collect()
    assert len(judged) == len(scored) == len(rows)
    assert [r.base_failed for r in judged if r.doc_id in (2, 3)] == [True, True] and len({r.n_words for r in judged if r.doc_id == 1}) == 1
    assert len({r.score for r in scored if r.doc_id == 1}) == 1 and all(0 <= r.score <= 1 for r in scored)


def test_an_id_that_is_repeated_a_hundred_thousand_times_is_one_row_of_the_sample(spark):
    docs = spark.range(100_000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("hot text").alias("text")).unionByName(spark.createDataFrame([(8, None)], "doc_id long, text string"))
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 0)], "doc_id long, toxic int")
    got = {r.doc_id: (r.text, r.label) for r in labelled.labelled_sample(docs, labels, "toxic").collect()}
    assert got == {7: ("hot text", 1), 8: ("", 0)} and labelled.labelled_sample(docs, labels, "toxic").count() == 2
