"""Operators on single texts: pages, licences, tokens, quality."""

from __future__ import annotations

import html
import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm.bpe_count import Counter, load_merges, token_counts
from ledgerloom.llm.html_paths import extract, main_text
from ledgerloom.llm.licenses import RULES, SENTENCES, Scanner, licence_matches
from ledgerloom.llm.quality_fm import BUCKETS, INTERVALS, SIZE, Model, features, fit, quality, score_texts

public = pytest.importorskip("public_tokenizers")
library = pytest.importorskip("tokenizers")


def test_pages_of_the_test_data(spark, sf_dir):
    def article(page: str) -> str:
        inner = re.search(r"<article>(.*?)(</article>|\Z)", page, re.DOTALL)[1]
        return " ".join(html.unescape(re.sub(r"<[^>]*(>|\Z)", " ", inner)).split())

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    want = {r.page_id: article(r.html) for r in pages.collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in extract(pages).collect()}
    assert got == {k: (t, len(t)) for k, t in want.items()}


PAGE = """<!doctype html><html><head><title>T</title></head><body class="page"><header><h1>Site</h1></header><div class="top-menu"><a href=x>Home</a></div>
<div role="navigation"><p>Go to, the start, of it.</p></div><div id="content"><h2>Title &amp; more</h2><p>First para, with <a href=y>a
link</a> and <b>bold</b>face. More of it, really.<p>Unclosed &lt;one&gt;, as it happens; quite long too.</p><ul><li>one item<li>two items</ul>
<blockquote>Quoted words, well put.</blockquote><table><tr><td>cell one<td>cell two</table><div class="advert"><p>Buy now, it is cheap!</p></div>
<form>Name <input><select><option>A</select></form><script>if (a < b) document.write("<p>x</p>")</script><style>p{}</style><!-- <p>no</p> -->
<section id="comments"><p>Nice, great article. I liked it, really.</p></section></div><div class="cookie-notice">We use cookies, sorry.</div>
<aside><p>About us. Long text, of some sort.</p></aside><footer>c</footer></body></html>"""


def test_parts_of_a_page():
    assert main_text(PAGE) == (
        "Title & more First para, with a link and boldface. More of it, really. Unclosed <one>, as it happens; quite long too. one item two items "
        "Quoted words, well put. cell one cell two"
    )


def unmarked(page: str) -> str:
    """A page whose elements and classes tell nothing."""
    for tag in ("article", "nav", "footer"):
        page = page.replace(f"<{tag}>", "<div>").replace(f"</{tag}>", "</div>")
    return page.replace(' class="ad"', "")


def test_the_threshold_decides(spark, sf_dir):
    pages = [r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()]
    for page in pages:
        assert main_text(page, 10) == "" and len(main_text(page, 0)) > len(main_text(page))
    assert np.mean([main_text(unmarked(p)) == main_text(p) for p in pages]) > 0.8


LONG = "A paragraph of some length, with a comma; it has enough words, and stops, to be read as text. It goes on for a while, too. "


def test_telling_words_in_articles_only_lower_values():
    assert main_text(f'<article><h1>T</h1><p>{LONG}<p class="related">{LONG}<div class="side-effects">{LONG}</div><p class="notice-period">{LONG}</article>') == "T " + " ".join([LONG.strip()] * 4)
    assert main_text(f'<div class="widget"><h1>T</h1><p>{LONG}<p>{LONG}</div><div class="related"><p>See this.</div>') == f"T {LONG}{LONG}".strip()
    assert main_text(f"<form><nav><a href=x>Home</a></nav><div><h1>T</h1><p>{LONG}<p>{LONG}</div></form>") == f"T {LONG}{LONG}".strip()


def test_comments_and_boxes_go():
    other = "I liked it, really. Thank you, all of you, for these fine words!"
    page = f"""<body><header class="site-header"><h1>Site</h1><p>The best, of all sites.</header><div id="sidebar-left"><p>{other}</div><article><header><h1>T</h1></header><p>{LONG}
    <p>{LONG}<aside><p>{other}</aside><div class="share-links">Share this, now.</div><footer>By me, today.</footer><section class="comments-area"><article class="comment"><p>{LONG}</article></section></article>
    <div id="commentList"><p>{LONG}<p>{LONG}</div><form><label>Your name, please.</label></form><div role="dialog"><p>{other}</div><p hidden>{other}</p><footer>{other}</footer></body>"""
    assert main_text(page) == f"T {LONG}{LONG}".strip()


@pytest.mark.parametrize("page, text", [(None, ""), ("", ""), ("<p></p>", ""), ("plain, only.", "plain, only."), ("<p>cut &am", "cut &am"), ("<article><p>a<br>b", "a b"), ("<nav>x</nav>", "")])
def test_odd_pages(page, text):
    assert main_text(page) == text


@given(st.text(st.sampled_from(list("<>/=\"' ap!-&;")), max_size=60))
@settings(max_examples=300, deadline=None)
def test_no_page_breaks_it(page):
    assert isinstance(main_text(page), str)


def test_page_rows(frame):
    pages = frame("page_id long, url string, html string", [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", "<p>" + "long words, here. " * 50_000)])
    rows = sorted((tuple(r) for r in extract(pages).collect()), key=str)
    assert [(r[0], r[1], r[3]) for r in rows] == [(1, "u", len(main_text(PAGE)))] * 2 + [(2, "v", 50_000 * 18 - 1), (None, None, 0)]
    assert extract(pages.limit(0)).count() == 0


NOTICE = "Foo.\nCopyright 2020\n" + "\n".join(f"{SENTENCES[name][0]}." for name in ("mit-grant", "mit-notice", "as-is")).replace(" to ", "\nto ")


def test_licences_by_rules():
    scan = Scanner().scan
    assert [(m[0], m[2]) for m in scan(NOTICE)] == [("MIT", 3)]
    assert [m[0] for m in scan("x\nLicensed under CC BY-NC 4.0.\nreleased UNDER the MIT license. y")] == ["CC-BY-NC-4.0", "MIT"]
    assert scan("we licensed under pressure") == [] and scan(None) == [] and scan("") == []
    text = "İ say: Licensed under the Apache License, Version 2.0."
    (_, _, _, start, stop), = scan(text)
    assert text[start:stop].startswith("Licensed under")
    for licence, names in RULES:
        assert scan(". ".join(SENTENCES[n][0].replace("...", "Some Holder, Inc") for n in names) + ".")[0][0] == licence


def wrapped(text: str, width: int, before: str = "") -> str:
    import textwrap

    return "\n".join(before + line for line in textwrap.wrap(text, width, break_long_words=False))


@pytest.mark.parametrize("width, before", [(10, ""), (30, " * "), (60, "# "), (20, "\n\n   //     "), (500, "")])
def test_licences_wrapped_at_any_width(width, before):
    text = " ".join(f"{SENTENCES[name][0]}." for name in ("mit-grant", "mit-notice", "as-is"))
    assert [(m[0], m[2]) for m in Scanner().scan(wrapped(text, width, before))] == [("MIT", 3)]


def test_licences_with_names_in_them():
    scan = Scanner().scan
    three = ". ".join(SENTENCES[n][0] for n in ("bsd-grant", "bsd-source", "bsd-binary"))
    name = SENTENCES["bsd-name"][1]
    for holder in ("the University of Somewhere, Inc.", "Ann B. Example", "X"):
        assert [(m[0], m[2]) for m in scan(f"{three}. {name.replace('...', holder)}.")] == [("BSD-3-Clause", 4)]
        assert [(m[0], m[2]) for m in scan(wrapped(f"{three}. {name.replace('...', holder)}.", 25))] == [("BSD-3-Clause", 4)]
    assert [m[0] for m in scan(f"{three}.")] == ["BSD-2-Clause"]
    assert [m[0] for m in scan("x\n# SPDX-License-Identifier: MPL-2.0\n/* SPDX-License-Identifier: Apache-2.0 */\nMIT")] == ["MPL-2.0", "Apache-2.0"]
    assert scan("SPDX-License-Identifier: MIT OR Apache-2.0\n") == []
    assert scan("released under " * 50_000 + "the MIT license")[0][0] == "MIT"


def test_licences_equal_a_plain_search(spark, sf_dir, documents):
    lines = {"This work is licensed under the GNU General Public License, version 3.": "GPL-3.0", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0",
             "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    want = sorted((r.doc_id, lines[line]) for r in docs.collect() for line in r.text.split("\n") if line in lines)
    assert sorted((r.doc_id, r.licence) for r in licence_matches(docs).collect()) == want
    rows = documents([(1, NOTICE), (1, NOTICE), (None, NOTICE), (2, None), (3, "")])
    assert sorted(str(r.doc_id) for r in licence_matches(rows).collect()) == ["1", "1", "None"]
    assert licence_matches(documents([])).count() == 0


VOCABULARY = public.path("byte_bpe_50k.json")
ODD = ["<|endoftext|>a <|endoftext|> b", "  \n\n x  \t y's we'll 123 ½ Ⅷ 你好 🎉‍ x y \u0085 \x1c", "a" * 5000, "", " ", "\n", " " * 300 + "x", "é" * 999, "don't DON'T <|endoftext|><|endoftext|>  <|endoftext|>\n"]


def test_tokens_equal_the_library(spark, sf_dir, documents):
    counts = library.Tokenizer.from_file(VOCABULARY)
    rows = [(k, t) for k, t in enumerate(ODD)] + [(100, None), (None, "x"), (5, "twice"), (5, "twice")]
    docs = documents(rows).select("doc_id", "text").unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("doc_id + 1000 AS doc_id", "text"))
    size = lambda t: len(counts.encode(t or "", add_special_tokens=False).ids)
    want = sorted(((r.doc_id, len((r.text or "").encode()), size(r.text), size(r.text) > 1024) for r in docs.collect()), key=str)
    assert sorted((tuple(r) for r in token_counts(docs, VOCABULARY).collect()), key=str) == want
    assert token_counts(documents([]), VOCABULARY).count() == 0


@given(st.text(max_size=60))
@settings(max_examples=300, deadline=None)
def test_tokens_of_any_text(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text, add_special_tokens=False).ids)


COUNTER, LIBRARY = Counter(load_merges(VOCABULARY)), library.Tokenizer.from_file(VOCABULARY)


def test_features_one_by_one_and_together():
    texts = ["", None, "Some words, some WORDS | and | bars\nline", "x " * 1000, "é è\n\n", "word"]
    together = features(texts)
    for k, t in enumerate(texts):
        one = features([t])
        a, z = together.starts[k], together.starts[k + 1]
        assert together.index[a:z].tolist() == one.index.tolist() and np.allclose(together.value[a:z], one.value)


def test_a_stated_length_is_a_feature_of_its_own():
    same, other = features(["some words"], [10]), features(["some words"], [5000])
    assert same.index.tolist() == features(["some words"]).index.tolist() == features(["some words"], [None]).index.tolist()
    assert (same.index != other.index).sum() == 1 and features([None, ""], [-1, None]).starts[-1] == 2 * len(INTERVALS)


def test_score_is_the_sum_over_all_pairs():
    rng = np.random.default_rng(0)
    model = Model(0.3, rng.normal(0, 1, SIZE), rng.normal(0, 0.3, (SIZE, 4)))
    text = "a few words, and a few more"
    f = features([text])
    z = model.bias + model.linear[f.index] @ f.value
    for i in range(len(f.index)):
        for j in range(i):
            z += model.factors[f.index[i]] @ model.factors[f.index[j]] * f.value[i] * f.value[j]
    assert score_texts(model, [text])[0] == pytest.approx(1 / (1 + np.exp(-z)))
    assert f.index.max() < SIZE and (f.index < BUCKETS).sum() == 5


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality(docs, labels).join(labels.select("doc_id", "quality"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.98


def test_quality_of_odd_inputs(documents, frame):
    docs = documents([(1, None), (2, ""), (None, "words"), (3, "w " * 100_000), (3, "again")])
    labels = frame("doc_id long, quality int, toxic int", [(1, 1, 0), (None, 0, 0), (2, None, 0), (99, 0, 1)])
    got = quality(docs, labels).collect()
    assert len(got) == 5 and all(0 < r.score < 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert quality(documents([]), labels.limit(0)).count() == 0 and quality(docs, labels.limit(0)).count() == 5
    assert fit([], np.zeros(0)).bias == 0


def test_duckdb_agrees_on_the_held_out_rule(spark, sf_dir):
    import zlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = [r[0] for r in duckdb.sql(f"SELECT doc_id FROM '{sf_dir}/documents.parquet'").fetchall()]
    got = {r.doc_id: r.held_out for r in quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}
