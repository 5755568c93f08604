"""Toxicity by a logistic classifier that is regularised with counterfactuals.

Features are words, their beginnings and their character 4- and 5-grams, chosen over the labelled sample by how far their rates differ between the
labels. Texts that name a group are doubled with the group exchanged for another of the same kind; a change of the score
between the two is penalised, so that naming a group does not count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from dayrisk.llm.common import Cache, Words, narrowed, settled, split_words, text_slices, with_arrow_columns
from dayrisk.llm.labelled import SAMPLE, labelled_sample

FEATURES = 4096
LEAST_DOCS = 5
COUNTERFACTUAL = 1.0
RIDGE = 0.01
STEPS = 250
#: Groups of terms of one kind; a term is exchanged for the next one of its group.
IDENTITY_GROUPS = (
    ("christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "sikhs", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("woman", "man"), ("women", "men"), ("girl", "boy"), ("girls", "boys"), ("female", "male"),
    ("gay", "straight", "lesbian", "bisexual", "heterosexual", "queer", "transgender"),
    ("immigrant", "refugee", "foreigner", "native"), ("immigrants", "refugees", "foreigners", "natives"),
    ("deaf", "blind", "disabled", "autistic"), ("old", "young"), ("rich", "poor"),
    ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"), ("frau", "mann"), ("frauen", "männer"),
    ("schwul", "lesbisch", "heterosexuell"), ("schwarze", "weiße", "asiaten", "araber"),
    ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"), ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
    ("femme", "homme"), ("femmes", "hommes"), ("noir", "blanc", "arabe", "asiatique"), ("gai", "lesbienne", "hétérosexuel"),
    ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo"), ("cristianos", "musulmanes", "judíos", "budistas", "ateos"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("negro", "blanco", "asiático", "árabe"), ("homosexual", "heterosexual"),
)
SWAP = {term: group[(i + 1) % len(group)] for group in IDENTITY_GROUPS for i, term in enumerate(group)}


def grams(word: str) -> set[str]:
    """The marked word, its character 4- and 5-grams and its beginnings of five to seven characters."""
    marked = f"<{word}>"
    return {marked, *(marked[i : i + n] for n in (4, 5) for i in range(len(marked) - n + 1)), *(marked[:n] for n in (6, 7, 8))}


def _text_features(words: Words, i: int, of: Cache) -> set:
    return set().union(*(of[w] for w in {words.unique[c] for c in words.of(i)}))


def feature_rates(sample: DataFrame) -> DataFrame:
    """``(feature, toxic, clean)``: documents of either label that have the feature, summed in each partition first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, of = (Counter(), Counter()), Cache(grams, entries=20_000)

        def flush() -> pa.RecordBatch:
            names = list(counts[0].keys() | counts[1].keys())
            out = [pa.array(names, pa.string()), *(pa.array([counts[k][f] for f in names], pa.int64()) for k in (1, 0))]
            counts[0].clear()
            counts[1].clear()
            return pa.RecordBatch.from_arrays(out, names=["feature", "toxic", "clean"])

        for batch in batches:
            for rows, texts in text_slices(batch):
                words = split_words(texts)
                for i, label in enumerate(rows.column("label").to_pylist()):
                    counts[int(label > 0)].update(_text_features(words, i, of))
                if len(counts[0]) + len(counts[1]) > 300_000:
                    yield flush()
        yield flush()

    partial = sample.mapInArrow(run, "feature string, toxic long, clean long")
    return partial.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_features(rates: DataFrame, toxic: int, clean: int, most: int = FEATURES) -> list[str]:
    """The features whose rates differ most between the labels, in standard deviations."""
    both = F.col("toxic") + F.col("clean")
    rate = both / (toxic + clean)
    z = F.abs(F.col("toxic") / toxic - F.col("clean") / clean) / F.sqrt(rate * (1 - rate) * (1 / toxic + 1 / clean) + 1e-12)
    return [r["feature"] for r in rates.where(both >= LEAST_DOCS).orderBy(z.desc(), "feature").limit(most).select("feature").collect()]


def swapped(words: list[str]) -> list[str] | None:
    """The words with every group term exchanged; None if there is none."""
    return [SWAP.get(w, w) for w in words] if any(w in SWAP for w in words) else None


def sample_rows(sample: DataFrame, features: list[str]) -> pd.DataFrame:
    """``(label, own, other)``: chosen features of each sampled text and of its counterfactual, as bytes of 16-bit numbers."""
    index = {f: i for i, f in enumerate(features)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        of = Cache(lambda w: tuple(index[g] for g in grams(w) if g in index), entries=100_000)
        packed = lambda found: np.array(sorted(found), np.uint16).tobytes()
        for batch in batches:
            for rows, texts in text_slices(batch):
                words, out = split_words(texts), []
                for i, label in enumerate(rows.column("label").to_pylist()):
                    other = swapped([words.unique[c] for c in words.of(i)])
                    out.append((int(label > 0), packed(_text_features(words, i, of)), None if other is None else packed(set().union(*(of[w] for w in set(other))))))
                yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=["label", "own", "other"]).astype({"label": "int32"}), schema=pa.schema([("label", pa.int32()), ("own", pa.binary()), ("other", pa.binary())]), preserve_index=False)

    return sample.mapInArrow(run, "label int, own binary, other binary").toPandas()


class Sparse:
    """Rows of present features."""

    def __init__(self, rows: list[bytes], columns: int):
        parts = [np.frombuffer(r, np.uint16) for r in rows]
        self.n, self.columns = len(rows), columns
        self.column = np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
        self.row = np.repeat(np.arange(self.n), [len(p) for p in parts]) if parts else np.empty(0, np.int64)

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], self.n)

    def back(self, g: np.ndarray) -> np.ndarray:
        return np.bincount(self.column, g[self.row], self.columns)


def fit(rows: pd.DataFrame, columns: int, counterfactual: float = COUNTERFACTUAL) -> np.ndarray:
    """Weights and, last, the intercept: log-loss, a ridge and the squared change of the score under exchanged groups, by Adam."""
    w = np.zeros(columns + 1)
    if rows.empty or rows["label"].nunique() < 2:
        w[-1] = 4.0 * (2 * rows["label"].mean() - 1) if len(rows) else -4.0  # only one label is known
        return w
    y = rows["label"].to_numpy(float)
    x = Sparse(list(rows["own"]), columns)
    named = rows[rows["other"].notna()]
    own, other = Sparse(list(named["own"]), columns), Sparse(list(named["other"]), columns)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    mean, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, STEPS + 1):
        error = (1 / (1 + np.exp(-np.clip(x.dot(w[:-1]) + w[-1], -30, 30))) - y) / len(y)
        change = (own.dot(w[:-1]) - other.dot(w[:-1])) * (2 * counterfactual / max(1, len(named)))
        gradient = np.append(x.back(error) + own.back(change) - other.back(change) + RIDGE * w[:-1] / len(y) ** 0.5, error.sum())
        mean, square = 0.9 * mean + 0.1 * gradient, 0.99 * square + 0.01 * gradient**2
        rate = 0.1 * min(1.0, 4 * (1 - step / (STEPS + 1)))
        w -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
    return w


class ToxicityModel:
    """Chosen features and their weights; small enough to travel with the tasks (at most FEATURES rows)."""

    def __init__(self, features: list[str], weights: np.ndarray):
        self.features, self.weights = features, weights

    @classmethod
    def learn(cls, docs: DataFrame, labels: DataFrame, bound: int = SAMPLE, most: int = FEATURES, counterfactual: float = COUNTERFACTUAL) -> ToxicityModel:
        """Fit on at most ``bound`` labelled documents whose crc32(doc_id) mod 5 is not 0; without labels every score is low."""
        apart = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
        sample = settled(labelled_sample(docs, labels, "toxic", apart, bound))
        counts = {r["k"]: r["n"] for r in sample.groupBy((F.col("label") > 0).alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()}
        features = choose_features(feature_rates(sample), counts[True], counts[False], most) if len(counts) == 2 else []
        return cls(features, fit(sample_rows(sample, features), len(features), counterfactual))

    def scorer(self):
        """A function from Arrow texts to their scores."""
        weights, index = self.weights, {f: i for i, f in enumerate(self.features)}
        of = Cache(lambda w: tuple(sorted({index[g] for g in grams(w) if g in index})), entries=150_000)

        def score(texts: pa.Array) -> np.ndarray:
            words = split_words(texts)
            found = of.all(words.unique)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            doc = np.repeat(np.arange(len(words)), np.diff(words.bounds))
            hit = np.flatnonzero(sizes[words.codes])
            pairs = np.unique(doc[hit] * len(found) + words.codes[hit]) if len(hit) else np.empty(0, np.int64)
            doc, code = pairs // max(1, len(found)), pairs % max(1, len(found))
            features = np.array([f for c in code.tolist() for f in found[c]], np.int64)
            keys = np.unique(np.repeat(doc, sizes[code]) * max(1, len(index)) + features)
            total = np.bincount(keys // max(1, len(index)), weights[keys % max(1, len(index))], len(words)) + weights[-1]
            return 1 / (1 + np.exp(-np.clip(total, -30, 30)))

        return score

    def add_scores(self, docs: DataFrame, name: str = "score", text: str = "text", carry: list[str] | None = None) -> DataFrame:
        """``docs`` with the toxicity of every whole text (null: empty) in the column ``name``."""
        scorers: list = []

        def make(texts: pa.Array) -> list:
            if not scorers:
                scorers.append(self.scorer())
            return [pa.array(scorers[0](texts), pa.float64())]

        return with_arrow_columns(docs, make, [T.StructField(name, T.DoubleType())], text, carry)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``, one row for each row of ``docs``.

    Null and empty texts have the score of a text without features. Repeated rows and null or tied ids are scored each on their own (a null id is
    not held out and not learned from). Texts of any length are read whole. Other columns are not looked at. An empty table gives an empty result.
    """
    model = ToxicityModel.learn(docs, labels)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = model.add_scores(narrowed(docs, "doc_id", "text"), carry=["doc_id"])
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
