"""Language, toxicity and HTML: accuracy on held-out rows and defined results for awkward rows."""

import random
import zlib

import numpy as np
import pytest

from homelake.llm.html_text import main_text, op2_html_text
from homelake.llm.language import BUCKETS, ngram_buckets, op4_language
from homelake.llm.toxicity import op5_toxicity, train_nnpu
from tests.llm.helpers import DOCS, write_tables

PAGES = [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\nb"), ("<p>a &lt; b &nbsp; c &amp;amp; d</p><scr", "a < b c &amp; d"),
    ("<article><p>x <a href='q'>link</a> y</p><ul><li>a<li>b</ul></article>", "x link y\na\nb"),
    ("<body><header><h1>Site</h1></header><main><article><header><h1>T</h1></header><section><p>One, two.</p></section><section><p>Three.</p>"
     "</section><form><p>x</p></form></article></main><div class='cookie-notice'>We use cookies</div></body>", "T\nOne, two.\nThree."),
    ("<div><h1>T</h1><div class='body'><p>Hello, world, this is a longer text.</p><p>Second, with words.</p></div></div><div class='sidebar'>"
     "<p>Side, side, side.</p></div><div id='comments'><p>Great, post, ok</p></div>", "T\nHello, world, this is a longer text.\nSecond, with words."),
    ("<nav><a href='/'>Home</a></nav><article><script>var t='</p><p>no'</script><p>Text<!-- no --> here</p></article><footer>f</footer>", "Text here"),
    ("<p title=\"a>b\">q</p>", "q"), ("<article><p>one<br>two</p><style>p{}</style></article>", "one two"), ("<nav>only menu</nav>", ""),
]


@pytest.mark.parametrize("page, text", PAGES)
def test_main_text(page, text):
    assert main_text(page) == text


NAMED = [
    ("<div class='content right-sidebar'><article><p>One, two.</p></article></div>", "One, two."),
    ("<div id='right-sidebar-layout'><article><p>One, two.</p></article></div><div>(c)</div>", "One, two."),
    ("<article><h2 id='related-work'>Related</h2><section id='search'><p id='notice-period'>One.</p></section>"
     "<div class='post-social-content'>Two.</div></article>", "Related\nOne.\nTwo."),
    ("<div class='sidebar'><p>One, two.</p></div>", "One, two."),
    ("<main><p>One, two, three.</p><div id='comments'><article><p>Nice.</p></article></div></main>", "One, two, three."),
    ("<article><p>One, two.</p><div class='post-comments'>Nice.</div></article><div class='related'><article>Other</article></div>", "One, two."),
]


@pytest.mark.parametrize("page, text", NAMED)
def test_names_of_wrappers_and_anchors_drop_nothing(page, text):
    assert main_text(page) == text


LONG = "Word word word, and so on. " * 11
SECTIONS = [
    ("<div id='content'><div>" + f"<p>{LONG}</p>" * 10 + "</div><div><h2>Next</h2><p>Short part of sixty characters.</p></div></div>",
     "\n".join([LONG.strip()] * 10 + ["Next", "Short part of sixty characters."])),
    (f"<body><div id='c'><h2>A</h2><div><p>{LONG}</p><p>{LONG}</p></div><p>Short.</p><ul><li>x</ul><table><tr><td>y</table></div>"
     "<div><a href='/'>Home</a> <a href='/b'>More</a></div></body>", "\n".join(["A", LONG.strip(), LONG.strip(), "Short.", "x", "y"])),
    (f"<div>Lead.<div><div><p>{LONG}</p><p>{LONG}</p></div><ul><li><a href='/'>Home page</a></ul></div><div><h3>B</h3><p>Last.</p></div></div>",
     "\n".join(["Lead.", LONG.strip(), LONG.strip(), "B", "Last."])),
]


@pytest.mark.parametrize("page, text", SECTIONS)
def test_sections_of_a_page_without_article_stay(page, text):
    assert main_text(page) == text


BODY = "<div><p>" + "</p><p>".join(f"Paragraph {i}, which has some length, and commas." for i in range(8)) + "</p></div>"
BODY_TEXT = "\n".join(f"Paragraph {i}, which has some length, and commas." for i in range(8))


@pytest.mark.parametrize("before, after, text", [
    ('<div class="col-left"><p>Weather 12 degrees</p></div>', '<div class="bottom">Imprint of Site</div>', BODY_TEXT),
    ('<div class="x1"><p>A lead paragraph, as long as such ones are.</p></div>', '<div class="x2"><h2>More</h2><p>A last section of forty characters or more.</p></div>',
     "A lead paragraph, as long as such ones are.\n" + BODY_TEXT + "\nMore\nA last section of forty characters or more."),
    ("<p>Short.</p>", "<ul><li>one</li><li>two</li></ul>", "Short.\n" + BODY_TEXT + "\none\ntwo"),
    ("", '<div class="x3"><p><a href="/">A link, and another, and one more to follow</a></p></div>', BODY_TEXT),
])
def test_only_the_score_tells_what_stays_beside_the_best_container(page_of, before, after, text):
    assert main_text(page_of(before + BODY + after)) == text


def test_without_points_for_length_and_commas_a_page_loses_its_lead(monkeypatch, page_of):
    page = page_of('<div class="x1"><p>A lead paragraph, as long as such ones are.</p></div>' + BODY)
    assert main_text(page).startswith("A lead")
    monkeypatch.setattr("homelake.llm.html_text.paragraph_points", lambda text: 1.0)
    assert not main_text(page).startswith("A lead")


@pytest.fixture()
def page_of():
    return lambda content: f"<html><body><div id='wrap'>{content}</div></body></html>"


def test_html_query_keeps_every_row(spark, tmp_path):
    rows = [(i, "u", page) for i, (page, _) in enumerate(PAGES)] + [(0, None, None), (50, "u", "<article>" + "<p>word, word</p>" * 20000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS __other")
    found = {(r["page_id"], r["url"]): (r["text"], r["n_chars"]) for r in op2_html_text(spark, write_tables(spark, tmp_path, pages=pages)).collect()}
    assert len(found) == len(rows) and found[4, "u"] == (PAGES[4][1], len(PAGES[4][1])) and found[0, None] == ("", 0)
    assert found[50, "u"][0].count("\n") == 19999
    none = write_tables(spark, tmp_path / "none", pages=spark.createDataFrame([], "page_id long, url string, html string"))
    assert op2_html_text(spark, none).collect() == []


def test_ngram_chunks_agree_with_whole_texts(monkeypatch):
    text = "".join(random.Random(0).choice("abcdeé ") for _ in range(1000))
    whole = np.bincount(np.concatenate(list(ngram_buckets(text))), minlength=BUCKETS)
    monkeypatch.setattr("homelake.llm.language._CHUNK_CHARS", 37)
    assert (np.bincount(np.concatenate(list(ngram_buckets(text))), minlength=BUCKETS) == whole).all()
    assert [len(x) for x in ngram_buckets("")] == [2, 1, 0]


def invented(seed, letters, n):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choice(letters) for _ in range(rng.randrange(2, 8))) for _ in range(rng.randrange(5, 40))) for _ in range(n)]


def test_language_on_held_out_rows(spark, tmp_path):
    texts = [("xx", t) for t in invented(1, "abcde", 60)] + [("yy", t) for t in invented(2, "cdefgé", 60)] + [(None, t) for t in invented(3, "abcde", 9)]
    rows = [(i, text, lang, "s", 0) for i, (lang, text) in enumerate(texts)] + [(900, None, "xx", "s", 0), (901, "123 !", "xx", "s", 0), (None, "abcab", None, None, None)]
    folder = write_tables(spark, tmp_path, documents=spark.createDataFrame(rows, DOCS).selectExpr("*", "1 AS score", "2 AS __best"))
    found = {r["doc_id"]: r for r in op4_language(spark, folder).collect()}
    assert len(found) == len(rows)
    held = [(i, lang) for i, (lang, _) in enumerate(texts) if lang and zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(found[i]["held_out"] for i, _ in held) and sum(found[i]["lang_pred"] == lang for i, lang in held) >= 0.9 * len(held)
    assert [(found[i]["lang_pred"], found[i]["score"]) for i in (900, 901)] == [("und", 0.0)] * 2
    assert all(0 <= r["score"] <= 1 for r in found.values())
    empty = write_tables(spark, tmp_path / "none", documents=spark.createDataFrame([(1, "abc", None, "s", 0)], DOCS))
    assert [(r["lang_pred"], r["score"]) for r in op4_language(spark, empty).collect()] == [("und", 0.0)]


def test_languages_in_blocks_agree_with_one_block(spark, tmp_path, monkeypatch):
    rows = [(i, t, f"l{i % 5}", "s", 0) for i, t in enumerate(invented(4, "abcdefghij", 60))]
    folder = write_tables(spark, tmp_path, documents=spark.createDataFrame(rows, DOCS))
    whole = sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in op4_language(spark, folder).collect())
    monkeypatch.setattr("homelake.llm.language.LANGUAGE_BLOCK", 2)
    assert sorted((r["doc_id"], r["lang_pred"], round(r["score"], 9)) for r in op4_language(spark, folder).collect()) == whole


def test_nnpu_ranks_positives_above_clean_texts():
    rng = np.random.default_rng(0)

    def row(toxic):
        common = rng.choice(np.arange(10, 60), 12, replace=False)
        return np.sort(np.append(common, rng.integers(0, 10) if toxic else rng.choice(np.arange(60, 100)))).astype(np.int32)

    positive, unlabelled = [row(True) for _ in range(300)], [row(i % 10 == 0) for i in range(1500)]
    weights, bias = train_nnpu(positive, unlabelled, 100, 0.1)
    scores = np.array([weights[x].sum() + bias for x in unlabelled])
    clean = np.delete(scores, np.s_[::10])
    assert (scores[::10, None] > clean[None, :]).mean() > 0.97


def test_toxicity_on_held_out_rows(spark, tmp_path):
    rng = random.Random(5)
    docs, labels = [], []
    for i, text in enumerate(invented(6, "abcdefghijkl", 900)):
        toxic = rng.random() < 0.15
        words = text.split()
        for _ in range(3 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(["zorq", "vexil", "krump"]))
        docs.append((i, " ".join(words), "en", "s", 0))
        labels += [(i, 1, int(toxic))] * (i % 2)
    docs += [(2000, None, "en", "s", 0), (2001, "", None, None, None), (2002, "zorq vexil " * 20000, "en", "s", 0), (None, "abc", "en", "s", 0)]
    labels += [(None, 1, 1), (1, None, None)]
    shape = "doc_id long, quality int, toxic int"
    tables = {"documents": spark.createDataFrame(docs, DOCS).selectExpr("*", "1 AS score", "'x' AS features"), "labels": spark.createDataFrame(labels, shape)}
    found = {r["doc_id"]: r for r in op5_toxicity(spark, write_tables(spark, tmp_path, **tables)).collect()}
    truth = {i: any(w in t for w in ("zorq", "vexil", "krump")) for i, t, *_ in docs if t}
    held = [i for i in truth if i is not None and i < 2000 and found[i]["held_out"]]
    assert sum(found[i]["predicted"] == truth[i] for i in held) >= 0.95 * len(held)
    assert found[2000]["score"] == found[2001]["score"] < 0.7 and found[2002]["predicted"] == 1
    none = {"documents": tables["documents"], "labels": spark.createDataFrame([], shape)}
    assert {r["predicted"] for r in op5_toxicity(spark, write_tables(spark, tmp_path / "none", **none)).collect()} == {0}
