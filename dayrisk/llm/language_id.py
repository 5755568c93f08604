"""Language identification, word first with backoff.

A known word counts with its log frequency in each language; an unseen word with those of its longest known character n-grams,
from five characters down to one. The tables are counted by Spark over a bounded sample of each language; of each kind the most
frequent entries of every language travel with the tasks, as rows of the languages that have them.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from dayrisk.llm.common import LETTER_BREAK, Cache, narrowed, split_words, text_slices, with_arrow_columns

#: Documents learned from in each language (expected number; chosen by the hash of their id).
SAMPLE = 6_000
#: Entries kept of each kind over all languages (0 is whole words, n is character n-grams of the marked word), dealt evenly to the languages; and
#: those that every language keeps at least, however many languages there are. Single characters are many in some scripts.
ENTRIES = {0: 100_000, 5: 80_000, 4: 40_000, 3: 20_000, 2: 8_000, 1: 20_000}
LEAST_ENTRIES = {0: 1_000, 5: 1_000, 4: 600, 3: 600, 2: 400, 1: 5_000}
SMOOTHING = 0.5


def ngrams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def language_sample(docs: DataFrame, learn: Column, bound: int = SAMPLE) -> DataFrame:
    """``(lang, text)`` of about ``bound`` documents of each language."""
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) / 1_000_000
    return rows.join(sizes, "lang").where(share < bound / F.col("n")).select("lang", "text")


def partition_counts(sample: DataFrame) -> DataFrame:
    """``(lang, kind, entry, n)``: occurrences of words and of their n-grams, summed in each partition first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, own in words.items():
                for kind in ENTRIES:
                    counts = own
                    if kind:
                        counts = Counter()
                        for word, n in own.items():
                            for gram in ngrams(word, kind):
                                counts[gram] += n
                    columns = [pa.array([lang] * len(counts), pa.string()), pa.array([kind] * len(counts), pa.int32()), pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "kind", "entry", "n"])
            words.clear()

        for batch in batches:
            for rows, texts in text_slices(batch):
                found = split_words(texts, LETTER_BREAK)
                for i, lang in enumerate(rows.column("lang").to_pylist()):
                    codes, n = np.unique(found.of(i), return_counts=True)
                    own = words.setdefault(lang, Counter())
                    for code, k in zip(codes.tolist(), n.tolist()):
                        own[found.unique[code]] += k
                if sum(map(len, words.values())) > 300_000:
                    yield from flush()
        yield from flush()

    partial = sample.mapInArrow(run, "lang string, kind int, entry string, n long")
    return partial.groupBy("lang", "kind", "entry").agg(F.sum("n").alias("n"))


def quotas(languages: int) -> dict[int, int]:
    """Entries of each kind that a language keeps."""
    return {kind: max(LEAST_ENTRIES[kind], ENTRIES[kind] // max(1, languages)) for kind in ENTRIES}


def kept_counts(counts: DataFrame, quota: dict[int, int]) -> DataFrame:
    """The counts, in all languages, of the entries that are among the most frequent of any language, ties by the entry itself."""
    most = F.create_map(*[F.lit(x) for pair in quota.items() for x in pair])[F.col("kind")]
    rank = F.row_number().over(Window.partitionBy("lang", "kind").orderBy(F.desc("n"), "entry"))
    chosen = counts.withColumn("_rank", rank).where(F.col("_rank") <= most).select("kind", "entry").distinct()
    return counts.join(chosen, ["kind", "entry"])


class Entries:
    """Of one kind: a row number for every entry, and for each row the languages that have it with their logs over the usual log of the unseen."""

    def __init__(self, rows: dict[str, int], starts: np.ndarray, langs: np.ndarray, logs: np.ndarray, unseen: np.ndarray):
        self.rows, self.starts, self.langs, self.logs, self.unseen = rows, starts, langs, logs, unseen

    @classmethod
    def of(cls, entries: list[str], langs: np.ndarray, n: np.ndarray, sizes: np.ndarray, distinct: int) -> Entries:
        """From (entry, language, count), the entries in order; ``sizes`` are all occurrences of the kind in each language."""
        rows: dict[str, int] = {}
        own = np.fromiter((rows.setdefault(e, len(rows)) for e in entries), np.int64, len(entries))
        unseen = np.log(SMOOTHING / (sizes + SMOOTHING * distinct))
        logs = np.log((n + SMOOTHING) / (sizes[langs] + SMOOTHING * distinct)) - unseen[langs]
        return cls(rows, np.searchsorted(own, np.arange(len(rows) + 1)), langs.astype(np.int32), logs.astype(np.float32), unseen)

    def dense(self, row: int) -> np.ndarray:
        out = self.unseen.copy()
        at = slice(self.starts[row], self.starts[row + 1])
        out[self.langs[at]] += self.logs[at]
        return out


class LanguageModel:
    """Log frequencies of the kept entries, by kind."""

    def __init__(self, languages: list[str], entries: dict[int, Entries]):
        self.languages, self.entries = languages, entries

    @classmethod
    def learn(cls, docs: DataFrame, learn: Column, bound: int = SAMPLE) -> LanguageModel:
        """From the documents that meet ``learn``; no languages are known if there is none.

        What reaches the driver grows with the number of languages and not with the corpus.
        """
        counts = partition_counts(language_sample(docs, learn, bound)).persist()
        totals = counts.groupBy("lang", "kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct")).collect()
        languages = sorted({r["lang"] for r in totals})
        place = {lang: i for i, lang in enumerate(languages)}
        kept = kept_counts(counts, quotas(len(languages))).select("kind", "entry", "lang", "n").toArrow() if languages else None
        entries = {}
        for kind in ENTRIES:
            size, distinct = np.ones(len(languages)), 1
            for r in totals:
                if r["kind"] == kind:
                    size[place[r["lang"]]], distinct = r["n"], max(distinct, r["distinct"])
            table = kept.filter(pc.equal(kept["kind"], kind)).sort_by("entry") if kept is not None else None
            names = table["entry"].to_pylist() if table is not None else []
            langs = np.fromiter(map(place.__getitem__, table["lang"].to_pylist()), np.int64) if names else np.zeros(0, np.int64)
            entries[kind] = Entries.of(names, langs, table["n"].to_numpy() if names else np.zeros(0), size, distinct)
        counts.unpersist()
        return cls(languages, entries)

    def found(self, word: str) -> tuple[int, tuple[int, ...]]:
        """The kind that a word is known by, and its rows: its own, or those of its longest known n-grams; (-1, ()) if nothing is known."""
        known = self.entries[0].rows.get(word)
        if known is not None:
            return 0, (known,)
        for n in (5, 4, 3, 2, 1):
            rows = self.entries[n].rows
            found = [rows[g] for g in ngrams(word, n) if g in rows]
            if found:
                return n, tuple(found)
        return -1, ()

    def word(self, word: str) -> np.ndarray:
        """Log frequency of a word in each language, or the mean of its longest known n-grams; zeros if nothing is known."""
        kind, rows = self.found(word)
        return np.mean([self.entries[kind].dense(r) for r in rows], axis=0) if rows else np.zeros(len(self.languages))

    def predictor(self):
        """A function from Arrow texts to (languages, scores)."""
        of, count = Cache(self.found, entries=100_000), len(self.languages)
        kinds = list(self.entries)
        # all kinds one after the other, so that a row number says the kind as well
        shift = dict(zip(kinds, np.cumsum([0] + [len(self.entries[k].rows) for k in kinds])))
        widths = np.concatenate([np.diff(self.entries[k].starts) for k in kinds]) if count else np.zeros(0, np.int64)
        starts = np.cumsum(widths) - widths
        langs, logs = (np.concatenate([getattr(self.entries[k], name) for k in kinds]) for name in ("langs", "logs"))
        unseen = np.stack([self.entries[k].unseen for k in kinds])

        def totals(words) -> tuple[np.ndarray, np.ndarray]:
            """For each text and language the sum of the logs of its words, and whether the text has a letter."""
            found = of.all(words.unique)
            kind = np.array([kinds.index(k) if k >= 0 else -1 for k, _ in found], np.int64)
            sizes = np.fromiter((len(rows) for _, rows in found), np.int64, len(found))
            rows = np.fromiter((shift[k] + r for k, own in found for r in own), np.int64, int(sizes.sum()))
            lettered = pc.match_substring_regex(pa.array(words.unique, pa.string()), r"\pL").to_numpy(zero_copy_only=False).astype(bool)
            text = np.repeat(np.arange(len(words)), np.diff(words.bounds))
            use = lettered[words.codes] & (kind[words.codes] >= 0)
            pairs, times = np.unique(text[use] * len(found) + words.codes[use], return_counts=True)
            text, code = pairs // max(1, len(found)), pairs % max(1, len(found))
            share = times / sizes[code]
            n = sizes[code]
            at = rows[np.repeat((np.cumsum(sizes) - sizes)[code] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            text_of, weight = np.repeat(text, n), np.repeat(share, n)
            wide = widths[at]
            place = np.repeat(starts[at] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
            total = np.bincount(np.repeat(text_of, wide) * count + langs[place], np.repeat(weight, wide) * logs[place], len(words) * count).reshape(-1, count)
            used = np.bincount(text * len(kinds) + kind[code], times, len(words) * len(kinds)).reshape(-1, len(kinds))
            spoken = np.bincount(np.repeat(np.arange(len(words)), np.diff(words.bounds)), lettered[words.codes], len(words)) > 0
            return total + used @ unseen, spoken

        def predict(texts: pa.Array) -> tuple[list[str], np.ndarray]:
            if not count:
                return ["und"] * len(texts), np.zeros(len(texts))
            total, spoken = totals(split_words(texts, LETTER_BREAK))
            odds = np.exp(total - total.max(axis=1, keepdims=True))
            best = odds.argmax(axis=1)
            scores = np.where(spoken, odds[np.arange(len(best)), best] / odds.sum(axis=1), 0.0)
            return [self.languages[b] if s else "und" for b, s in zip(best.tolist(), spoken.tolist())], scores

        return predict

    def add_language(self, docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
        """``docs`` with ``lang_pred`` and ``score``; a text without a letter is ``und`` with score 0."""
        predictors: list = []

        def make(texts: pa.Array) -> list:
            if not predictors:
                predictors.append(self.predictor())
            names, scores = predictors[0](texts)
            return [pa.array(names, pa.string()), pa.array(scores, pa.float64())]

        return with_arrow_columns(docs, make, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())], text, carry)


def identify_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every document; learned where crc32(doc_id) mod 3 is not 1.

    Null text is ``und``; of equally likely languages the first by name is taken. Repeated rows and null ids are predicted each on their own (null ids
    are not learned from); an id that occurs often is learned from, or not, with all its rows. Columns not named are not read. An empty table gives an empty result.
    """
    part = F.crc32(F.col("doc_id").cast("string")) % 3
    model = LanguageModel.learn(narrowed(docs, "doc_id", "text", "lang"), F.coalesce(part != 1, F.lit(False)))
    found = model.add_language(narrowed(docs, "doc_id", "text"), carry=["doc_id"])
    return found.select("doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
