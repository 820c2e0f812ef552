"""Hostile and very long input of the page parsers and of tool calls; the words that condemn a page region."""

import json
import time

import pytest

from dwspark.llm import chat, langid, wrapper

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("markup", [
    '<p "' * 250_000, "<div>" * 200_000, "<b>" * 200_000 + "</i>" * 200_000, "<h1>x" * 100_000, "<ul><li><b>" * 60_000, "<" * 1_000_000,
    "<!--" * 250_000, "<p a='b" * 120_000, "<p =" * 250_000, "<!x" * 300_000, "<p" + " " * 1_000_000, "<script>" * 100_000, "<i><div>" + "<b>" * 100_000 + "</i>" * 100_000])
def test_hostile_markup_takes_linear_time(markup):
    start = time.process_time()
    page = wrapper._safe(markup)
    assert len(page.label) <= 200_000
    langid.without_markup(markup)
    assert time.process_time() - start < 5  # about half a second; a quadratic parser takes minutes


def test_markup_free_text_is_unchanged():
    assert langid.without_markup("a <b>c</b> > d <!-- x --> e < f") == "a  c  > d   e < f"
    assert langid.without_markup("1 < 2") == "1 < 2" and langid.without_markup("a < b <script x") == "a < b  "


def test_deep_pages_keep_their_text():
    page = wrapper.Page("<div>" * 2000 + "<p>deep</p>" + "</div>" * 2000 + "<p>after</p>")
    assert [t for _, t, _ in page.blocks] == ["deep", "after"] and page.blocks[-1][0] == len(page.label) - 1
    assert page.parent[-1] == 0  # the end tags of what was too deep ended nothing else


@pytest.mark.parametrize("name", ["with-sidebar", "entry-header", "no-comments", "notice-period", "share-price-table", "main-menu-article", "content", "addition"])
def test_words_that_say_something_else(name):
    assert not wrapper._condemned(name)


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "cookie-banner", "comment-list", "ad-slot", "related_posts", "nav", "ad-2"])
def test_names_of_regions(name):
    assert wrapper._condemned(name)


def _extract(spark, page, n=6):
    rows = [(i, f"https://h.example/{i}", page(i)) for i in range(n)]
    return {r["page_id"]: r["text"] for r in wrapper.extract(spark.createDataFrame(rows, PAGES)).collect()}


def test_container_named_after_its_neighbour(spark):
    got = _extract(spark, lambda i: f'<body><div class="layout with-sidebar"><div class="entry-header"><h1>Title {i}</h1></div><p title="a hidden gem">Text {i} of words.</p>'
                   f'<p class="notice-period">Notice {i}.</p></div><div class="sidebar"><p>Other {i}</p></div><footer>Legal</footer></body>')
    assert got == {i: f"Title {i} Text {i} of words. Notice {i}." for i in range(6)}


def test_varying_line_beside_the_article(spark):
    got = _extract(spark, lambda i: f"<body><div><p>Posted on day {i}</p></div><article><h1>Title {i}</h1><p>Text {i} of many words.</p></article></body>")
    assert got == {i: f"Title {i} Text {i} of many words." for i in range(6)}


def test_tool_calls_with_odd_arguments(spark):
    deep = "[" * 700 + "]" * 700
    arguments = ['{"x":"\\ud800"}', f'{{"x":{deep}}}', '{"x":1e999}', '{"x":1e300}', '{"x":1.0}', '{"\\ud800":1}', "[" * 100_000, '{"x":{"$result":"\\ud800"}}', '{"x":-0.0}']
    calls = spark.createDataFrame([(1, f"c{i}", i, "t", a) for i, a in enumerate(arguments)], "conv_id long, call_id string, position long, name string, arguments string")
    results = spark.createDataFrame([(1, "c0", 50, "ok")], "conv_id long, call_id string, position long, content string")
    rows = {r.call_id: r for r in chat.link(calls, results, {"t": {"type": "object", "additionalProperties": True, "properties": {"x": {}}}}).collect()}
    assert rows["c0"].arguments == '{"x":"\\ud800"}' and rows["c0"].valid and rows["c0"].status == "linked"
    assert rows["c1"].errors == ["$: nested too deeply"] and rows["c2"].errors == ["$: not JSON"] and rows["c6"].errors == ["$: not JSON"]
    assert [rows[c].arguments for c in ("c3", "c4", "c5", "c8")] == ['{"x":1e+300}', '{"x":1}', '{"\\ud800":1}', '{"x":0}']
    assert rows["c7"].errors == ["$: unknown call \\ud800"]
    for r in rows.values():
        assert json.loads(r.json)["id"] == r.call_id


@pytest.mark.parametrize("text", [
    "then We counted the “red birds” over the old lake near our town every single spring", "We counted the red birds — over the old lake near our town every single spring",
    "x\xa0We counted the\xa0red birds over the old lake near «our town» every single spring…", "We counted the red birds over the old lake near our town's every single spring"])
def test_signs_beyond_ascii_part_words(spark, text):
    from dwspark.llm import decontam

    items = spark.createDataFrame([(7, "We counted the red birds over the old lake near our town every single spring")], "item_id long, text string")
    found = decontam.matches(spark.createDataFrame([(1, text), (2, "é" + text.replace("red", "réd"))], "doc_id long, text string"), items).collect()
    assert [r.doc_id for r in found] == ([1] if "'" not in text else [])


def test_scratch_deletes_what_was_made_inside(spark):
    from dwspark.llm import tables

    before = tables.save(spark.range(3), "outer")
    with tables.scratch(spark):
        inner = tables.save(spark.range(4), "inner")
        with tables.scratch(spark):
            nested = tables.save(spark.range(5), "nested")
        assert inner.count() == 4
        with pytest.raises(Exception):
            spark.read.parquet(*nested.inputFiles()).count()
    with pytest.raises(Exception):
        spark.read.parquet(f"{tables.shared_folder(spark)}/llm/inner-*").count()
    assert before.count() == 3
