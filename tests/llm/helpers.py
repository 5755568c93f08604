"""Small tables and plain reference versions for the tests of the training-data operators."""

from __future__ import annotations

import random
import re
from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, langs=None, first=0):
    """A documents table; ``texts`` may hold nulls."""
    rows = [(first + i, t, langs[i] if langs else "en", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def prose(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join("w" + "".join(chr(97 + (k * 7 + 3 * i) % 26) for i in range(2 + k % 5)) + str(k) for k in (draw.randrange(vocabulary) for _ in range(n)))


def shingles(text):
    words = re.findall(r"\w+", (text or "").lower())
    width = min(5, len(words))
    return Counter(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if words else None


def near_classes(texts):
    """Class numbers by comparing every pair."""
    bags = [shingles(t) for t in texts]
    label = list(range(len(texts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = bags[i], bags[j]
            same = (texts[i] or "") == (texts[j] or "") if a is None or b is None else sum((a & b).values()) >= 0.8 * sum((a | b).values())
            if same:
                label[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(texts))]
