"""Broken and deep pages in linear time; surrogates of crowded formats."""

import time

import pytest

from sluice.llm import html_text, surrogates


@pytest.mark.parametrize(
    "unit", ["<a b ", "<div>", "<p>", "</x>", "<i><div></div>", "<a '", '<a ">', "<", "<!x ", "<li>a", "<b x='", "<td><tr>"]
)
def test_a_page_of_a_megabyte(unit):
    page = unit * (1_000_000 // len(unit))
    start = time.time()
    elements, items = html_text.parse(page)
    assert time.time() - start < 20 and elements


def test_long_names_and_raw_ends():
    for page in ("<" + "a" * 500_000, "<a " + "b='" * 200_000, "<script>" + "x" * 500_000, "<!--" + "-" * 500_000):
        start = time.time()
        html_text.parse(page)
        assert time.time() - start < 2


def texts(page):
    return [x for x in html_text.parse(page)[1] if isinstance(x, str)]


def test_tags_without_an_end():
    assert texts("a <b>c <i d") == ["a ", "c <i d"]
    assert texts("a <b title='x>y'>c") == ["a ", "c"]
    assert texts("a <b title='x>y <i>c</i>") == ["a ", "y ", "c"]  # the quote never ends
    assert texts("1 < 2 </ 3> <4>") == ["1 < 2 </ 3> <4>"]


def nesting(page):
    elements, _ = html_text.parse(page)
    return [(e.tag, elements[e.parent].tag) for e in elements[1:]]


def test_open_elements_are_closed_where_html_closes_them():
    assert nesting("<div><p>a<b>c<p>d") == [("div", "#page"), ("p", "div"), ("b", "p"), ("p", "div")]
    assert nesting("<p><div><p>") == [("p", "#page"), ("div", "#page"), ("p", "div")]
    assert nesting("<ul><li>a<ul><li>b</ul><li>c") == [("ul", "#page"), ("li", "ul"), ("ul", "li"), ("li", "ul"), ("li", "ul")]
    assert nesting("<table><tr><td>a<td>b<tr><td>c") == [
        ("table", "#page"), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"), ("td", "tr")
    ]


def test_more_entities_than_short_names(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    boxes = [("email", f"{a}@{b}.com") for a in letters for b in letters]
    held = surrogates.surrogate_table(spark.createDataFrame(boxes, "kind string, value string"), key="k").toPandas()
    assert len(held) == 676 and held.surrogate.is_unique and not set(held.surrogate) & set(held.value)


def test_a_full_format_is_refused(spark, monkeypatch):
    monkeypatch.setattr(surrogates, "ATTEMPTS", 2)
    full = spark.createDataFrame([("ssn", str(i)) for i in range(10)], "kind string, value string")
    with pytest.raises(ValueError, match="no room for surrogates of kind ssn"):
        surrogates.surrogate_table(full, key="k")
