import hashlib
import re
import time
import struct
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

from dayrisk.llm import chat, html_extract, line_dedup, pieces
from dayrisk.llm.html_blocks import blocks_of
from tests.llm.helpers import documents, prose

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def unigram_copy(model):
    """The vocabulary file as a unigram model with the operator's scores, for the library to read."""
    out, k = b"", 0
    for number, value in pieces._fields(open(MODEL, "rb").read()):
        if number == 1:
            own = dict(pieces._fields(value))
            value = b"\x0a" + varint(len(own[1])) + own[1] + b"\x15" + struct.pack("<f", float(model.scores[k])) + (b"\x18" + varint(own[3]) if 3 in own else b"")
            k += 1
        elif number == 2:
            value = b"\x18" + varint(1) + b"\x98\x02" + varint(1)  # unigram, byte fallback
        out += varint(number << 3 | 2) + varint(len(value)) + value
    return sentencepiece.SentencePieceProcessor(model_proto=out)


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(MODEL)


def test_segmentation_is_as_good_as_the_librarys(model):
    reference = unigram_copy(model)
    texts = ["", " ", "The river, the house.\nNext line", "  a   b ", "日本語 и русский", "𝔘ü\t\x00x", "a" * 300, "word" * 60 + " end", prose(3, 200)]
    ids, ends = model.encode_all(pa.array(texts, pa.large_string()))
    for text, a, b in zip(texts, [0, *ends], ends):
        mine, theirs = ids[a:b].tolist(), reference.encode(text)
        assert mine == theirs or float(sum(model.scores[i] for i in mine)) == pytest.approx(float(sum(model.scores[i] for i in theirs)), rel=1e-5)


@settings(max_examples=150, deadline=None)
@given(st.text(st.characters(blacklist_categories=["Cs"], blacklist_characters=pieces.MARKER), max_size=60))
def test_text_comes_back_and_lockstep_equals_one_by_one(text):
    own = pieces.piece_model(MODEL)
    ids, _ = own.encode_all(pa.array([text], pa.large_string()))
    assert own.decode(ids) == text
    stretch = pieces.MARKER + text.replace(" ", pieces.MARKER)
    assert own._one(stretch) == own._many([stretch, "x"])[0]


def test_trie_finds_its_prefixes():
    keys = [b"a", b"ab", b"abc", b"b", b"bcd", b"\xff\x00"]
    trie = pieces.DoubleArrayTrie([(k, i) for i, k in enumerate(keys)])
    for data in (b"abcd", b"bcde", b"\xff\x00a", b"zz"):
        assert [(e, keys[i]) for e, i in trie.prefixes(data, 0)] == [(len(k), k) for k in sorted(keys, key=len) if data.startswith(k)]


def test_encoding_documents_and_back(spark):
    texts = [None, "", "plain text", f"a{pieces.MARKER}b", prose(2, 500), "y" * 20_000]
    encoded = pieces.encode_documents(documents(spark, texts))
    rows = {r.doc_id: r for r in pieces.decode_documents(encoded).collect()}
    assert [rows[i].text for i in range(6)] == ["", "", "plain text", "a b", texts[4], texts[5]]
    assert [rows[i].lossless for i in range(6)] == [True, True, True, False, True, True] and rows[0].n_ids == 0
    assert pieces.encode_documents(documents(spark, [])).count() == 0


CONTROL_TEXT = st.lists(st.sampled_from([*chat.CONTROLS, "\\", "<", "[", "s>", "INST]", "<\\s>", "[\\\\END]", "x", " "]), max_size=12).map("".join)


@settings(max_examples=300, deadline=None)
@given(CONTROL_TEXT)
def test_escaping_is_reversible_and_leaves_no_control_string(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROLS)


def test_conversations_read_back(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "[INST] ok"), (1, 2, "assistant", None), (2, 0, "tool[/ROLE]", "r <s>\\"), (2, None, None, "é"), (None, 0, "system", "s")]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, "assistant", "long " * 20_000)]
    rows += [(c, 0, "user", t) for c, pair in ((5, ("ab", "ab!")), (6, ("<a", "<s>")), (7, ("[", "[INST]", "[\\INST]", "[Z"))) for t in pair]  # tied turns
    table = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, ids string")
    got = {r.conv_id: r for r in chat.conversation_digests(chat.format_turns(chat.with_probe(spark, table))).collect()}
    rows += [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1], r[2] or "", r[3] or ""))
        lost = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert got[conv].n_turns == len(own)
        assert got[conv].turns_sha256 == hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        signs = lambda t: len(re.findall("|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in chat.CONTROLS), t))
        said = lambda t: len(t) + signs(t)
        frame = lambda role: sum(map(len, chat.FORMS[role])) if role in chat.FORMS else len("[ROLE][/ROLE][END]") + said(role)
        assert got[conv].formatted_chars == sum(said(r[3] or "") + frame(r[2] or "") for r in own)
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(lost), hashlib.sha256(lost.encode()).hexdigest())
    assert chat.conversation_digests(chat.format_turns(table.limit(0))).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><div id="cookie-banner">We use cookies.</div>
<header><a href=/>Site</a></header><nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav><div class="layout-sidebar-left"><main><article>
<header><h1>Title &amp; more</h1></header><p>First <b>para</b>graph
 with   spaces.<p>Second, a &lt; b &#233;.<div class="ad">Buy now</div><script>var t="</p><p>no</p>";</script><ul><li>Item one</li><li>Item two</li></ul>
<form>Name <input></form><aside>Related</aside><!-- <p>hidden</p> --><p>Last.</p><footer>Share</footer></article>
<section class="comments"><article><p>I am a reader.</p></article></section></main></div><div class="sidebar">Side text</div><footer>&copy; x</footer></body></html>"""


def test_main_text_of_a_page():
    assert "\n".join(html_extract.main_blocks(blocks_of(PAGE), html_extract.PLAIN)) == "Title & more\nFirst paragraph with spaces.\nSecond, a < b é.\nItem one\nItem two\nLast."


BODY = "".join(f"<p>Paragraph {i} of the article tells the reader, in plain words, what happened and why it matters.</p>" for i in range(6))
MENU = "<nav><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></nav>"


@pytest.mark.parametrize(
    "page",
    [
        f"<form id=aspnetForm>{MENU}<div>{BODY}</div></form>",
        f"<form>{MENU}<article>{BODY}</article></form>",
        f"<form>{MENU}<div class=entry-content>{BODY}</div></form>",
        f"{MENU}<main><p>Abstract of it all.</p><section id=discussion>{BODY}</section></main>",
        f"{MENU}<div id=responses>{BODY}</div>",
        f"{MENU}<article class='post comments-open'>{BODY}</article>",
        f"{MENU}<div class='content with-sidebar'>{BODY}</div>",
        f"{MENU}<div class='columns right-sidebar'><div class=entry-content>{BODY}</div></div>",
        f"{MENU}<div class='comments-page'><article>{BODY}</article></div>",
        f"{MENU}<aside><div class=entry-content>{BODY}</div></aside>",
    ],
)
def test_an_article_is_not_lost_in_a_form_or_by_a_word_of_its_box(page):
    text = "\n".join(html_extract.main_blocks(blocks_of(page), html_extract.PLAIN))
    assert text.count("Paragraph") == 6 and "One" not in text


@pytest.mark.parametrize("box", ["form", "div class=comments", "div id=comments-area", "div class='discussion'", "div class=sidebar"])
def test_what_is_no_article_stays_outside(box):
    other = f"<{box}><div class=comment-body><p>I am a reader, and I say so.</p></div></{box.split()[0]}>"
    text = "\n".join(html_extract.main_blocks(blocks_of(f"{MENU}<article>{BODY}</article>{other}"), html_extract.PLAIN))
    assert text.count("Paragraph") == 6 and "reader, and" not in text


@pytest.mark.parametrize(
    "opening, closing",
    [(f"<div {a}>", "</div>") for a in (
        "class='legal-analysis'", "class='share-price'", "class='social-policy'", "class='reply-rates'", "class='header'", "id='related-work'", "id='copyright-law'", "class='login'",
        "class='respond-to-crisis'", "class='notice-period'")] + [("<fieldset>", "</fieldset>")],
)
def test_words_that_may_name_a_part_of_an_article_do_not_drop_it(opening, closing):
    inner = "<p>This part of the text has a name of its own, and the reader wants it, whatever the box is called.</p>"
    text = "\n".join(html_extract.main_blocks(blocks_of(f"{MENU}<article>{BODY}{opening}{inner}{closing}{BODY}</article>"), html_extract.PLAIN))
    assert text.count("Paragraph") == 12 and "whatever the box" in text and "One" not in text


@pytest.mark.parametrize("inside", ["<math><mi>x</mi><mo>=</mo><mn>2</mn></math>", "<svg><path d='M0 0'/></svg>", "<button>Copy</button>"])
def test_elements_within_a_line_do_not_split_it(inside):
    texts = [b.text for b in blocks_of(f"<article><p>Before it {inside} and after it.</p></article>")]
    assert len(texts) == 1 and texts[0].startswith("Before it") and texts[0].endswith("and after it.") and ("x=2" in texts[0]) == ("math" in inside)


def moved(page):
    """Texts whose label the cut changed, with the label that they got."""
    blocks = blocks_of(page)
    gain, side = html_extract.labels(blocks, html_extract.PLAIN)
    return [(b.text, s) for b, g, s in zip(blocks, gain, side) if (g > 0) != s]


def test_the_cut_makes_up_for_a_missing_and_for_a_wrong_hint():
    long = "<p>The council met on Monday, as it does each week, and it talked about the road, the school and the bridge for hours.</p>"
    bare = f"<div><div>{MENU}</div><div>{long * 3}<p>Of</p>{long * 3}</div></div>"  # no word says where the article is
    assert ("Of", True) in moved(bare)
    text = html_extract.main_blocks(blocks_of(bare), html_extract.PLAIN)
    assert len(text) == 7 and "One" not in text
    wrong = f"<article>{long * 3}<div class=banner>Yes</div>{long * 3}</article>"  # a title that is called a banner
    assert ("Yes", True) in moved(wrong) and len(html_extract.main_blocks(blocks_of(wrong), html_extract.PLAIN)) == 7
    stray = f"<div>{MENU}<div>{''.join(f'<div><a href=x>{w}</a></div>' for w in 'abc')}<div>Mail us, call us, or write</div>{''.join(f'<div><a href=x>{w}</a></div>' for w in 'def')}</div></div>"
    assert html_extract.main_blocks(blocks_of(stray), html_extract.PLAIN) in ([], ["Mail us, call us, or write"])


def test_share_of_labels_that_the_cut_moves():
    draw = np.random.default_rng(3)
    long = "<p>The council met on Monday, as it does each week, and it talked about the road, the school and the bridge for hours.</p>"
    pages = ["<div>" + MENU + "<div>" + "".join(long if draw.random() < 0.7 else "<p>Of</p>" for _ in range(30)) + "</div></div>" for _ in range(20)]
    blocks = sum(len(blocks_of(p)) for p in pages)
    changed = [x for p in pages for x in moved(p)]
    assert 0.1 < len(changed) / blocks < 0.4 and all(s for _, s in changed)


def test_long_pages_take_little_time():
    draw = np.random.default_rng(5)
    n = 20_000
    gain = draw.normal(0, 1.5, n).tolist()
    edges = [(i, i + 1, 2.0) for i in range(n - 1)] + [(i, i + 3, 1.0) for i in range(0, n - 3, 2)]
    start = time.process_time()
    html_extract.minimum_cut(gain, edges)
    deep = blocks_of("<div>" * 4000 + "".join(f"<p>line {i}</p>" for i in range(300)) + "</div>" * 4000)
    html_extract.main_blocks(deep, html_extract.PLAIN)
    assert time.process_time() - start < 6


def test_extraction_takes_any_page(spark):
    pages = [PAGE, None, "", "no markup at all, just one longer sentence, with commas.", "<p>open <b>x", "<" * 2000, "<a title='" + "x" * 5000, "<div>" * 3000 + "deep", PAGE]
    table = spark.createDataFrame([(i, f"http://h/{i}", p, "t") for i, p in enumerate(pages)], "page_id long, url string, html string, text string")
    rows = {r.page_id: r for r in html_extract.extract_pages(table).collect()}
    assert len(rows) == len(pages) and rows[0].text == rows[8].text and rows[0].text.startswith("Title & more\n")
    assert rows[1].text == rows[2].text == "" and all(r.n_chars == len(r.text) for r in rows.values())
    assert html_extract.extract_pages(table.limit(0)).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-6, 6), min_size=1, max_size=9), st.data())
def test_cut_is_a_minimum(gain, data):
    n = len(gain)
    edges = data.draw(st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(1, 5)), max_size=12))
    edges = [(a, b, float(w)) for a, b, w in edges if a != b]
    cost = lambda side: sum(g for g, s in zip(gain, side) if g > 0 and not s) + sum(-g for g, s in zip(gain, side) if g < 0 and s) + sum(w for a, b, w in edges if side[a] != side[b])
    best = min(cost([bool(k >> i & 1) for i in range(n)]) for k in range(2**n))
    assert cost(html_extract.minimum_cut([float(g) for g in gain], edges)) == pytest.approx(best)


def test_lines_of_many_pages_of_a_host_go(spark):
    pages = [(i, "http://User@Big.example:80/x", f"<p>menu</p><p>text {i}</p><p>menu</p><script>x</script>&amp;lt;") for i in range(8)]
    pages += [(8, "http://small.example/", "<p>menu</p>"), (9, None, "<p>menu</p>"), (10, "nonsense", "menu"), (11, "http://big.example", None), (11, "http://big.example", None)]
    table = spark.createDataFrame([(*p, 1, "q") for p in pages], "page_id long, url string, html string, lines int, host string")
    rows = line_dedup.drop_site_lines(table).collect()
    assert len(rows) == len(pages)
    for r in rows:
        if r.page_id < 8:
            assert (r.host, r.n_lines, r.n_dropped, r.text) == ("big.example", 4, 3, f"text {r.page_id}")
        else:
            assert r.n_dropped == 0 and r.text == ("" if r.page_id == 11 else "menu")
    assert line_dedup.drop_site_lines(table.limit(0)).count() == 0
    assert Counter(r.host for r in rows)["big.example"] == 10 and np.isfinite(line_dedup.RATIO)


@pytest.mark.parametrize("shares", [1, 3, 4096])
def test_small_hosts_and_a_host_with_most_pages(spark, shares):
    pages = [(i, f"http://hot.example/{i}", f"<p>menu</p><p>text {i}</p>" + "<p>often</p>" * (i % 5 == 0)) for i in range(200)]
    pages += [(1000 + 10 * h + i, f"http://s{h}.example/{i}", f"<p>menu {h}</p><p>own {i}</p>") for h in range(40) for i in range(h % 5 + 1)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    rows = line_dedup.drop_site_lines(table, shares=shares).collect()
    assert len(rows) == len(pages)
    for r in rows:
        if r.page_id < 1000:
            assert r.text == f"text {r.page_id}" + "\noften" * (r.page_id % 5 == 0)  # on a fifth of the pages only
        else:
            assert (r.n_dropped == 1) == ((r.page_id - 1000) // 10 % 5 + 1 >= 3)
    assert line_dedup.large_hosts(table.select(line_dedup.host_of(table["url"]).alias("host")), shares).count() <= shares
