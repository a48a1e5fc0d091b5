"""HTML extraction: layout by example, nothing lost of the given pages, odd input."""

import html as entities
import re

import pytest

from tidemark.llm import html

CASES = [
    ("<p>one<p>two <b>bold</b>\n text", "one\n\ntwo bold text"),
    ("a<br>b<div>c</div>d", "a\nb\nc\nd"),
    ("<h1>T</h1>x<ul><li>a<li>b<ol><li>c</li><li>d</ol></ul>y", "T\n\nx\n\n- a\n- b\n  1. c\n  2. d\n\ny"),
    ("<ol start=9><li>i<li>j</ol>", "9. i\n10. j"),
    ("<ul><li>a<p>b</p></ul>", "- a\n\n  b"),
    ("<table><tr><td>a<td>long cell<tr><td>wider a<td>b</table>", "a        long cell\nwider a  b"),
    ("<table><caption>C<tr><th colspan=2>head<th>z<tr><td>a<td>b<td>c</table>", "C\nhead  z\na  b  c"),
    ("<table><tr><td rowspan=2>r<td>1<tr><td>2</table>", "r  1\n   2"),
    ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    ("<table>stray<tr><td>a</table>", "stray\n\na"),
    ("<td>no table</td>", "no table"),
    ("<pre> a\n  b</pre>", " a\n  b"),
    ("x<script>var t='</p>';</script>y<style>p{}</style><!-- z --> w", "xy w"),
    ("<title>t</title><p hidden>h</p><p style='display: none'>n</p><p>v", "v"),
    ("<details><summary>s</summary>hid</details><details open><summary>t</summary>shown</details>", "s\nt\nshown"),
    ("<select><option>a<option selected>b</select>", "b"),
    ("a &amp; b &lt;c&gt; &copy;&nbsp;&#233; &bogus; &amp;lt;", "a & b <c> ©\xa0é &bogus; &lt;"),
    ("</p></b></table>x", "x"),
    ("a < b > c <3 <", "a < b > c <3 <"),
    ("<!doctype html><html><head><title>t</title><body>b", "b"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"),
    ("<blockquote>q<p>r</blockquote>s", "  q\n\n  r\n\ns"),
    ("one<hr>two", "one\n\n---\n\ntwo"),
    ("<script>never closed <p>x", ""), ("<!-- never closed <p>x", ""), ("<p title='never closed>x</p> y", "x\n\ny"),
    ("", ""), (None, None), ("plain", "plain"), (" \n ", ""),
]


@pytest.mark.parametrize("page,want", CASES)
def test_layout(page, want):
    assert html.visible_text(page) == want


def test_deep_and_long_pages_end():
    assert html.visible_text("<div>" * 20000 + "x") == "x"
    assert html.visible_text("<table><tr><td>" * 500 + "x").strip() == "x"
    assert html.visible_text("<" * 50000) == "<" * 50000
    assert html.visible_text("<a " + "x='" * 3000).startswith("<a x=")
    assert len(html.visible_text("<p>word</p>" * 30000)) == 4 * 30000 + 2 * 29999
    assert html.visible_text("<table><tr><td colspan=999999 rowspan=999999>a<td>b</table>").split() == ["a", "b"]


def test_pages_keep_all_words(spark):
    """Against the words that plain deletion of head, scripts, comments and tags leaves."""
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in html.extract(pages).collect()}
    rows = pages.select("page_id", "html").collect()
    assert len(got) == len(rows)
    for r in rows:
        plain = re.sub(r"(?s)<head>.*?</head>|<script>.*?</script>|<!--.*?-->", " ", r.html)
        words = entities.unescape(re.sub(r"</?(?:p|li|br|div|h1|ul|nav|article|footer|body|html)\b[^>]*>", " ", plain))
        words = re.sub(r"<[^>]*>", "", words).split()
        assert [w for w in got[r.page_id].text.split() if w != "-"] == [w for w in words if w != "-"]
        assert got[r.page_id].n_lines == got[r.page_id].text.count("\n") + 1 and got[r.page_id].n_chars == len(got[r.page_id].text)


def test_odd_rows(spark):
    pages = spark.createDataFrame([(None, "<p>a", "t"), (1, None, "t"), (2, "", None), (3, "<p>b", "t"), (3, "<p>b", "t")], "page_id long, html string, text string")
    assert sorted((r.page_id or 0, r.text, r.n_chars, r.n_lines) for r in html.extract(pages).collect() if r.text is not None) == [
        (0, "a", 1, 1), (2, "", 0, 0), (3, "b", 1, 1), (3, "b", 1, 1)]
    assert html.extract(pages).where("page_id = 1").first().n_chars is None
    assert html.extract(pages.limit(0)).count() == 0


def test_drawings_formulas_and_examples_show_their_text():
    show = html.visible_text
    assert show("a<svg><title>t</title><desc>d</desc><path d='M0'/><text>seen</text><defs/><g><text>too</text></g></svg>b").split() == ["aseentoob"]
    assert show("<p>x<math><mi>y</mi><annotation>tex</annotation><mo>+</mo></math>z") == "xy+z"
    assert show("<p>a</p><xmp>1 <b>2</b>\n  3 &amp;</xmp>c") == "a\n\n1 <b>2</b>\n  3 &amp;\n\nc"
    assert show("<desc>outside</desc><svg><desc/>inside</svg>") == "outsideinside"
