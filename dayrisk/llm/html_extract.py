"""Main text of web pages by minimum cut.

Every text block is a node. A logistic classifier over the shape of its text, trained on the pages themselves from what their markup
says outright, and the markup around it give the cost of either label; blocks that follow each other and blocks close in the
document tree are tied together. The minimum cut between source (article) and sink (boilerplate) labels all blocks of a page at once.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from dayrisk.llm.common import narrowed, with_arrow_columns
from dayrisk.llm.html_blocks import Block, Element, blocks_of

#: Pages and blocks that the classifier is trained on at most, chosen by hash.
SAMPLE_PAGES, SAMPLE_BLOCKS = 2_000, 100_000
#: Log-odds: of markup that says outright what is not the article, of article markup, of words that only may say something (whole, and as a part
#: of a name), and of the text at most. All but the first are of one order, so that text and ties can outweigh them.
OUTRIGHT, ARTICLE, MAYBE, PART, TEXT_MOST = 8.0, 2.6, 2.0, 1.5, 2.5
#: Ties of blocks that follow each other, and of blocks with the same grandparent; less for blocks that are linked differently.
FOLLOWS, NEAR = 2.0, 1.0
#: What is left of a tie over the border of a box that says outright what it is.
CROSS = 0.2
ARTICLE_TAGS = frozenset("article main".split())
OUTSIDE_TAGS = frozenset("nav footer aside menu dialog".split())
MAYBE_TAGS = frozenset(("fieldset",))
ARTICLE_WORDS = frozenset("article content main story post entry articlebody article-body article-content post-body post-content entry-content main-content story-body story-text post-text text prose blog-post maincontent page-content role=main role=article".split())
#: Class names and ids of what is not the article, wherever it stands; and those that also name parts of an article, and count inside one as a hint only.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies consent gdpr notice alert sidebar nav navbar navigation"
    " breadcrumb breadcrumbs masthead topbar newsletter subscribe subscription popup modal overlay pagination pager toolbar role=navigation role=banner"
    " role=contentinfo role=complementary role=search role=form role=dialog role=alert".split()
)
MAYBE_WORDS = frozenset("header footer banner menu widget related recommended share sharing social login signup skip copyright legal disclaimer tags".split())
#: Containers of comments; by a whole name, where what lies inside says so too; parts that only tell how a page is set, and parts of names of boxes.
COMMENT_WORDS = frozenset("comment comments commentlist reply replies respond disqus".split())
MAYBE_COMMENT_WORDS = frozenset("discussion responses".split())
STATE_PARTS = frozenset("with has have no without is open opened closed enabled disabled allowed on off".split())
BOX_PARTS = frozenset(
    "box slot wrap wrapper container area section list block top bottom left right center layout site page main global inner outer bar unit column col body form post"
    " thread item group panel holder region zone content primary secondary js row grid links link text title buttons button icons icon".split()
)
#: Article words that count inside what is marked as boilerplate, where most of the page's marked text lies in them.
SURE_WORDS = frozenset("articlebody article-body article-content post-body post-content entry-content main-content story-body story-text post-text maincontent page-content role=main role=article".split())
#: Shares of the page's text: a form that holds more is no mere form; a box that holds more is not boilerplate by its name alone.
FORM_SHARE, MOST = 0.25, 0.5
LAYOUT_TAGS = frozenset(("html", "body"))
#: Levels of the document tree that are looked up for a common ancestor of two blocks.
LEVELS = 12
FEATURES = ["one", "log_length", "linked", "stops", "words", "capitals", "paragraph", "item"]
#: Used where no page says outright what its article is.
PLAIN = np.array([-1.0, 0.35, -4.0, 0.8, 0.02, -0.5, 0.6, -0.4])


def _split(word: str) -> list[str]:
    return [p for p in re.split(r"[-_:]+", word) if p]


def named(words: frozenset, names: frozenset) -> bool:
    """Whether a class name or id is one of ``names``, or made of one of them and of parts of names of boxes (``comments-area``, ``ad-slot-3``).

    A state as ``with-sidebar`` or ``comments-open`` names nothing.
    """
    for word in words:
        if word in names:
            return True
        parts = set(_split(word)) if "=" not in word else set()
        if parts & names and not parts & STATE_PARTS and all(p in names or p in BOX_PARTS or p in MAYBE_WORDS or p in OUTSIDE_WORDS or p.isdigit() for p in parts):
            return True
    return False


def mentions(words: frozenset) -> bool:
    """Whether a part of a name is a word for what is not the article, as in ``share-price``."""
    for word in words:
        parts = set(_split(word)) if "=" not in word else set()
        if len(parts) > 1 and parts & (OUTSIDE_WORDS | MAYBE_WORDS | COMMENT_WORDS) and not parts & STATE_PARTS:
            return True
    return False


def _is_article(element: Element) -> bool:
    return element.tag in ARTICLE_TAGS or bool(element.words & SURE_WORDS)


class Shares:
    """How the text of a page outside links lies in its elements; ``marked`` is the part of it inside article tags and sure words."""

    def __init__(self, blocks: list[Block]):
        known: dict[int, Element] = {}
        for block in blocks:
            x = block.element
            while x is not None and x.number not in known:
                known[x.number] = x
                x = x.parent
        inside: dict[int, tuple[bool, bool]] = {}  # (in an article, in comments)
        for number in sorted(known):  # parents have smaller numbers
            x = known[number]
            article, comments = inside[x.parent.number] if x.parent is not None else (False, False)
            comments = comments or named(x.words, COMMENT_WORDS)
            inside[number] = ((article or _is_article(x)) and not comments, comments)
        self.text, self.marked = dict.fromkeys(known, 0), dict.fromkeys(known, 0)
        for block in blocks:
            number, own = block.element.number, max(0, len(block.text) - block.linked)
            self.text[number] += own
            self.marked[number] += own * inside[number][0]
        self.articles, self.comments = dict.fromkeys(known, 0), dict.fromkeys(known, 0)
        for number in sorted(known, reverse=True):
            x = known[number]
            if x.parent is not None:
                up = x.parent.number
                self.text[up] += self.text[number]
                self.marked[up] += self.marked[number]
                self.articles[up] += self.articles[number] + _is_article(x)
                self.comments[up] += self.comments[number] + named(x.words, COMMENT_WORDS)
        self.all, self.all_marked = self.text.get(0, 0), self.marked.get(0, 0)

    def share(self, x: Element) -> float:
        return self.text[x.number] / max(1, self.all)

    def most(self, x: Element) -> bool:
        """Whether an element holds most of the page's text and of what is marked as article in it."""
        return self.all > 0 and self.share(x) >= MOST and self.marked[x.number] >= MOST * self.all_marked

    def is_form(self, x: Element) -> bool:
        return x.tag == "form" and not self.articles[x.number] and self.share(x) <= FORM_SHARE

    def is_comments(self, x: Element) -> bool:
        """Named as comments, and either there is an article elsewhere or nothing in it looks like one."""
        if not (named(x.words, COMMENT_WORDS) or (x.words & MAYBE_COMMENT_WORDS and self.comments[x.number])):
            return False
        if self.all_marked:
            return self.all_marked > self.marked[x.number]
        return not self.articles[x.number] and not _is_article(x) and self.share(x) < MOST


def hint(element: Element, memo: dict[int, float], shares: Shares) -> float:
    """Log-odds that the markup around a block gives: above 0 article, below 0 not, 0 nothing.

    The innermost word counts, except that readers' comments and forms stay outside whatever they contain, and that a header
    inside an article belongs to it. A form or a box named as comments or boilerplate is not taken for one where the page's
    article would go with it (see ``Shares``). Words that also name parts of an article only lower the odds inside one.
    """
    chain, x = [], element
    while x is not None and x.number not in memo:
        chain.append(x)
        x = x.parent
    above = memo[x.number] if x is not None else 0.0
    for x in reversed(chain):
        above = memo[x.number] = _hint_below(above, x, shares)
    return above


def _hint_below(above: float, element: Element, shares: Shares) -> float:
    if element.tag in LAYOUT_TAGS:
        return above
    if shares.is_comments(element) or shares.is_form(element):
        return -2 * OUTRIGHT
    if above <= -2 * OUTRIGHT:
        return above
    if element.tag in OUTSIDE_TAGS or (element.tag == "header" and above <= 0):
        return -OUTRIGHT
    if element.tag in ARTICLE_TAGS:
        return ARTICLE
    title = above > 0 and element.tag in ("header", "h1", "h2")
    if element.words and not title and not shares.most(element):
        if named(element.words, OUTSIDE_WORDS):
            return -OUTRIGHT
        if named(element.words, MAYBE_WORDS) or element.words & COMMENT_WORDS:
            return -OUTRIGHT if above <= 0 else min(above, ARTICLE - MAYBE)
    if element.words & ARTICLE_WORDS and (above >= 0 or (element.words & SURE_WORDS and shares.marked[element.number] >= MOST * shares.all_marked > 0)):
        return ARTICLE
    if element.tag in MAYBE_TAGS:
        return min(above, ARTICLE - MAYBE) if above > 0 else above - MAYBE
    if element.words and not title and mentions(element.words) and not shares.most(element):
        return min(above, ARTICLE - PART) if above > 0 else min(above, -PART)
    return above


def shape(block: Block) -> list[float]:
    """FEATURES of the text of a block."""
    text = block.text
    words = text.split()
    return [
        1.0, float(np.log1p(len(text))), min(1.0, block.linked / max(1, len(text))), min(3.0, sum(map(text.count, ".!?,;"))) / 3, min(len(words), 50.0),
        sum(w[0].isupper() for w in words) / max(1, len(words)), float(block.element.tag in ("p", "blockquote", "pre")), float(block.element.tag in ("li", "a", "td")),
    ]


def train(rows: np.ndarray, article: np.ndarray) -> np.ndarray:
    """Logistic weights by damped Newton steps; PLAIN if only one label occurs."""
    if not len(article) or article.min() == article.max():
        return PLAIN
    weight = np.where(article > 0, 0.5 / article.mean(), 0.5 / (1 - article.mean()))
    w = np.zeros(rows.shape[1])
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        slope = rows.T @ (weight * (p - article)) + 0.01 * len(rows) * 0.01 * w
        curve = (rows * (weight * p * (1 - p))[:, None]).T @ rows + (1e-3 * len(rows)) * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


def closeness(a: Element, b: Element) -> float:
    """1 for blocks of one element or with one parent, less for each level further apart; 0 without a common ancestor within LEVELS."""
    path, x = {}, a
    for up in range(LEVELS):
        if x is None:
            break
        path[x.number] = up
        x = x.parent
    x = b
    for up in range(LEVELS):
        if x is None:
            break
        if x.number in path:
            return 1.0 / (1.0 + max(0, up + path[x.number] - 2))
        x = x.parent
    return 0.0


def ties(blocks: list[Block], hints: list[float]) -> list[tuple[int, int, float]]:
    """Smoothness edges: each block to the next, and to the last one before it with the same grandparent.

    Blocks that are linked alike are tied more; over the border of a box that is outright not the article little is left.
    """
    linked = [min(1.0, b.linked / max(1, len(b.text))) for b in blocks]
    outright = [h <= -OUTRIGHT for h in hints]
    tie = lambda a, b, w: (a, b, w * (1.0 - abs(linked[a] - linked[b])) * (1.0 if outright[a] == outright[b] else CROSS))
    edges = [tie(i, i + 1, FOLLOWS * closeness(blocks[i].element, blocks[i + 1].element)) for i in range(len(blocks) - 1)]
    last: dict[int, int] = {}
    for i, block in enumerate(blocks):
        parent = block.element.parent or block.element
        before = last.get(parent.number)
        if before is not None and before != i - 1:
            edges.append(tie(before, i, NEAR))
        last[parent.number] = i
    return [e for e in edges if e[2] > 0]


def minimum_cut(gain: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Labels of least cost: ``-gain`` is saved on the source side where positive, every edge between the sides costs its weight.

    A node whose own gain outweighs all its ties is settled beforehand and its ties are added to its neighbours' gains, which
    leaves the minimum as it is; the rest goes through the maximum flow.
    """
    n = len(gain)
    gain = list(gain)
    near: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, w in edges:
        near[a][b] = near[a].get(b, 0.0) + w
        near[b][a] = near[b].get(a, 0.0) + w
    side: list[bool | None] = [None] * n
    queue = deque(range(n))
    while queue:
        i = queue.popleft()
        if side[i] is None and abs(gain[i]) >= sum(near[i].values()):
            side[i] = gain[i] > 0
            for j, w in near[i].items():
                gain[j] += w if side[i] else -w
                del near[j][i]
                queue.append(j)
            near[i] = {}
    open_ = [i for i in range(n) if side[i] is None]
    if open_:
        for i in open_:
            side[i] = False
        for i in source_side(open_, gain, near):
            side[i] = True
    return [bool(s) for s in side]


def source_side(nodes: list[int], gain: list[float], near: list[dict[int, float]]) -> list[int]:
    """Nodes that the source still reaches after a maximum flow.

    Each node with something left to give looks for the nearest node that takes it. What a search without success has seen can
    give nothing to the sink any more: it is the source's, and no later search enters it. So a search stays near its node.
    """
    room = {i: dict(near[i]) for i in nodes}
    take = {i: max(0.0, -gain[i]) for i in nodes}
    owned: set[int] = set()
    for start in nodes:
        left = gain[start]
        while left > 1e-9 and start not in owned:
            came, queue, end = {start: start}, deque([start]), None
            while queue:
                a = queue.popleft()
                if take[a] > 1e-9:
                    end = a
                    break
                for b, r in room[a].items():
                    if r > 1e-9 and b not in came and b not in owned:
                        came[b] = a
                        queue.append(b)
            if end is None:
                owned.update(came)
                break
            flow, b = min(left, take[end]), end
            while b != start:
                flow = min(flow, room[came[b]][b])
                b = came[b]
            left -= flow
            take[end] -= flow
            b = end
            while b != start:
                a = came[b]
                room[a][b] -= flow
                room[b][a] = room[b].get(a, 0.0) + flow
                b = a
    return list(owned)


def labels(blocks: list[Block], weights: np.ndarray) -> tuple[list[float], list[bool]]:
    """For each block its log-odds, of text and markup, and its side of the page's minimum cut: the article's or not."""
    if not blocks:
        return [], []
    memo: dict[int, float] = {}
    shares = Shares(blocks)
    text = np.clip(np.array([shape(b) for b in blocks]) @ weights, -TEXT_MOST, TEXT_MOST)
    hints = [hint(b.element, memo, shares) for b in blocks]
    gain = [h + float(t) for h, t in zip(hints, text)]
    return gain, minimum_cut(gain, ties(blocks, hints))


def main_blocks(blocks: list[Block], weights: np.ndarray) -> list[str]:
    """Texts of the blocks on the article's side of the cut."""
    return [b.text for b, article in zip(blocks, labels(blocks, weights)[1]) if article]


def learn_weights(pages: DataFrame, bound: int = SAMPLE_PAGES, most: int = SAMPLE_BLOCKS) -> np.ndarray:
    """Weights from blocks whose markup says outright what they are, in at most ``bound`` pages and ``most`` blocks chosen by hash."""
    rows = narrowed(pages, "page_id", "html").where("html is not null")
    chosen = rows.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(bound)
    sample = rows.join(F.broadcast(chosen), "page_id", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for page in batch["html"]:
                memo: dict[int, float] = {}
                blocks = blocks_of(page)
                shares = Shares(blocks)
                found += [[*shape(b), float(h > 0)] for b in blocks if abs(h := hint(b.element, memo, shares)) >= ARTICLE]
            yield pd.DataFrame(found, columns=[*FEATURES, "article"], dtype=float)

    shapes = sample.mapInPandas(run, ", ".join(f"{c} double" for c in [*FEATURES, "article"]))
    each = shapes.orderBy(F.xxhash64(*shapes.columns), *shapes.columns).limit(most).toPandas()
    return train(each[FEATURES].to_numpy(), each["article"].to_numpy())


def extract_pages(pages: DataFrame) -> DataFrame:
    """``(page_id, url, text, n_chars)`` of every row: the main text of its whole html.

    Null html counts as empty; a page without an article has an empty text. Repeated rows and null or tied ids are pages of their own with the same text; a block
    whose two labels cost the same is not the article. Pages of any length are read whole; other columns are not looked at; an empty table gives an empty result.
    """
    weights = learn_weights(pages)

    def make(texts: pa.Array) -> list:
        out = ["\n".join(main_blocks(blocks_of(page), weights)) for page in texts.to_pylist()]
        return [pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64())]

    fields = [T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())]
    return with_arrow_columns(narrowed(pages, "page_id", "url", "html"), make, fields, text="html", carry=["page_id", "url"])
