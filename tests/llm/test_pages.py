"""Main text and language of pages."""

import html
import re

import duckdb
import pytest

from dwspark.llm import langid, queries, wrapper
from . import helpers as h

PAGES = "page_id long, url string, html string"


def article(markup):
    """The article's blocks, for pages of the synthetic table."""
    found = re.search(r"<article>(.*?)(?:</article>|\Z)", markup or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    return " ".join(x for x in (" ".join(html.unescape(re.sub("<[^>]*>", "", re.sub("<br>", " ", b))).split()) for b in blocks) if x)


def test_main_text_of_all_pages(spark):
    pages = {r[0]: r[1] for r in duckdb.sql(f"SELECT page_id, html FROM '{h.SF}/pages.parquet'").fetchall()}
    got = queries.queries()["op4_wrapper_induction"](spark, h.SF).collect()
    assert {r["page_id"]: r["text"] for r in got} == {k: article(v) for k, v in pages.items()}
    assert all(r["n_chars"] == len(r["text"]) for r in got)


def test_slot_without_semantic_elements(spark):
    """Same-host pages of plain containers: the varying container is found, constant ones are template."""
    def page(i):
        body = "".join(f"<p>Text {i} of paragraph {k} &amp; more\n words.</p>" for k in range(3))
        return (f"<html><body><div id=top><div>Welcome to our site</div></div><div class=x><div><h2>Title {i}</h2>{body}</div></div>"
                f"<div><p>Legal line of the site, always the same</p></div><div class='comments'><p>comment {i} by reader</p></div></body></html>")

    rows = [(i, f"https://h.example/{i}", page(i)) for i in range(6)]
    got = {r["page_id"]: r for r in wrapper.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i in range(6):
        assert got[i]["text"] == f"Title {i} " + " ".join(f"Text {i} of paragraph {k} & more words." for k in range(3))
        assert got[i]["aligned"]


@pytest.mark.parametrize("start, end", [("<article>", "</article>"), ("<div>", "</div>")])
def test_slot_holds_headline_and_sections(spark, start, end):
    """A headline, a short first section and a long second one: all varying text belongs to the slot."""
    def page(i):
        return (f"<html><body><div id=top><div>Welcome to our site</div></div>{start}<h1>Title {i}</h1><p>Standfirst {i}</p><div><p>Short {i}</p></div>"
                f"<div class=body><p>{f'Long text {i} of words. ' * 20}</p></div>{end}<div><p>Legal line of the site</p></div></body></html>")

    rows = [(i, f"https://h.example/{i}", page(i)) for i in range(6)]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: f"Title {i} Standfirst {i} Short {i} " + f"Long text {i} of words. " * 19 + f"Long text {i} of words." for i in range(6)}


@pytest.mark.parametrize("others", [[], ["", None], ["<html><body><table><tr><td>odd</table></body></html>"], ["copy"] * 4])
def test_slot_of_a_host_with_two_pages(spark, others):
    """Two pages, after empty or odd ones of smaller page_id or with copies: their varying text is found."""
    def page(i):
        return (f"<html><body><div id=top><div>Welcome to our site</div></div><div class=x><h2>Title {i}</h2><p>Text {i} of words.</p></div>"
                "<div><p>Legal line of the site</p></div></body></html>")

    rows = [(k, f"https://h.example/{k}", page(8) if m == "copy" else m) for k, m in enumerate(others)]
    rows += [(i, f"https://h.example/{i}", page(i)) for i in (8, 9)]
    got = {r["page_id"]: r for r in wrapper.extract(spark.createDataFrame(rows, PAGES)).collect()}
    for i in (8, 9):
        assert got[i]["text"] == f"Title {i} Text {i} of words." and got[i]["aligned"]


def test_constant_blocks_inside_the_slot_are_left_out(spark):
    """A disclaimer in every article goes; paragraphs of copies of one article stay."""
    def page(i):
        return f"<html><body><article><h1>Title {i}</h1><p>Text {i} of words.</p><p>Read more on our site.</p></article></body></html>"

    rows = [(k, f"https://h.example/{k}", page(i)) for k, i in enumerate((0, 1, 2, 3, 3, 3, 3, 3, 3))]
    got = {r["page_id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {k: f"Title {i} Text {i} of words." for k, i in enumerate((0, 1, 2, 3, 3, 3, 3, 3, 3))}


@pytest.mark.parametrize("inner, text", [
    ("<p>a<p>b", "a b"), ("<p>a<br>b</p>", "a b"), ("<p>a <b>b</b>c</p>", "a bc"), ("<p>x &lt;y&gt; &eacute; &#8364;</p>", "x <y> é €"),
    ("<script>var t='</p><p>no';</script><p>yes</p>", "yes"), ("<p>a</p><!-- <p>no</p> --><p>b</p>", "a b"), ("<ul><li>one<li>two</ul>", "one two"),
    ("<p>a</p><aside><p>no</p></aside><form><input value='x'>no</form><p>b</p>", "a b"), ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"),
    ("<p>a</p><div class='ad'>no</div><section id='comments'><p>no</p></section>", "a"), ("</p>a</div>b", "a b"), ("<p title='x>y'>z", "z"),
    ("<header><h1>t</h1></header><p>u", "t u"), ("a < b and c", "a < b and c"),
])
def test_markup(inner, text):
    page = wrapper.Page(f"<html><head><title>no</title></head><body><nav>no</nav><article>{inner}</article><footer>no</footer></body></html>")
    slot = page.own_slot()
    inside = set()
    for i, p in enumerate(page.parent):
        if i == slot or p in inside:
            inside.add(i)
    assert " ".join(t for n, t, _ in page.blocks if n in inside and not page.bad[n]) == text


def test_alignment_takes_the_most_nodes():
    page = wrapper.Page("<body><div><p>a</p><p>b</p></div><ul><li>x</li></ul><div><p>c</p></div></body>")
    other = wrapper.Page("<body><ul><li>x</li><li>y</li></ul><div><p>c</p></div></body>")
    to = wrapper.align(page, other.label, other.parent)
    assert sum(x >= 0 for x in to) == 6  # root, body, ul, li, div, p
    assert wrapper.align(page, page.label, page.parent) == list(range(len(page.label)))


def test_page_edges(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not an address", "<p>x"), (4, "http://a.example/", "<div>" * 3000 + "deep" + "</div>" * 3000),
            (5, "http://a.example/", "<article>" + "<p>word</p>" * 5000), (5, "http://a.example/", "<article>" + "<p>word</p>" * 5000), (None, None, "<p>y")]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "'z' AS text", "1 AS host")
    got = [(r["page_id"], r["text"]) for r in wrapper.extract(pages).collect()]
    assert sorted((a or 0, b) for a, b in got) == sorted([(1, ""), (2, ""), (3, "x"), (4, "deep"), (5, " ".join(["word"] * 5000)), (5, " ".join(["word"] * 5000)), (0, "y")])
    assert wrapper.extract(pages.limit(0)).count() == 0


def test_language_accuracy(spark):
    """Held-out: the pages are no training rows; their markup's language is hidden from half of them."""
    pages = spark.read.parquet(f"{h.SF}/pages.parquet")
    truth = {r["page_id"]: re.search('lang="([a-z]+)"', r["html"])[1] for r in pages.collect()}
    bare = pages.selectExpr("page_id", "regexp_replace(url, '/[a-z][a-z]/', '/') AS url", "regexp_replace(html, ' lang=\"[a-z]+\"', '') AS html")
    labelled = spark.read.parquet(f"{h.SF}/documents.parquet")
    for table in (pages, bare):
        got = langid.classify(table, labelled).collect()
        assert sum(truth[r["page_id"]] == r["lang"] for r in got) >= 0.95 * len(got) == 0.95 * len(truth)


def test_language_evidence(spark):
    labelled = spark.createDataFrame([(i, h.prose(1, 5) + " the of and", "en", "x") for i in range(5)] + [(9 + i, "und der die das nicht", "DE", "x") for i in range(5)] + [(30, None, "fr", "x"), (31, "x", None, None)],
                                     "doc_id long, text string, lang string, lang2 string")
    rows = [(1, "http://a.example/de/x", "<html lang=de-AT><p>"), (2, "http://b.example.de/", "<p>"), (3, None, None), (4, "http://a.example/", "<p>und der die das nicht" * 50),
            (4, "http://a.example/", "<p>und der die das nicht" * 50), (5, "http://a.example/", '<html lang="xx"><p>the of and the of and')]
    pages = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS lang", "2 AS host")
    got = {r["page_id"]: r for r in langid.classify(pages, labelled).collect()}
    assert [got[i]["declared"] for i in range(1, 6)] == ["de", "none", "none", "none", "other"]
    assert [got[i]["suffix"] for i in range(1, 6)] == ["de", "de", "none", "none", "none"]
    assert [got[i]["lang"] for i in (1, 2, 4, 5)] == ["de", "de", "de", "en"]
    assert langid.classify(pages, labelled).count() == 6
    assert langid.classify(pages.limit(0), labelled).count() == 0
    assert {r["lang"] for r in langid.classify(pages, labelled.limit(0)).collect()} == {None}
