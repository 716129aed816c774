"""Broken and odd markup: a defined text for each, in time linear in the page."""

import random
import time

import pytest

from stratalake.llm.html_text import rendered

CASES = {
    "<![foo bar]>x": "x", "<![if a]>b<![endif]>c": "bc", "<!-->x": "x", "<!-- a --!>x": "x", "<!-- never ends": "", "</>x</3 y>z": "xz",
    "1 < 2": "1 < 2", "a<b": "a", '<p a="x>y': "", "<p a = 'x>y": "", "<p a = \"x>y\" b='>' c=d/e>z": "z", "a&amp;b&lt": "a&b<",
    "<TITLE>x</b></Title>y": "y", "<script>a</scriptx></script >b": "b", "<plaintext>a<b>": "a<b>", "<textarea>\na\n <b></textarea>": "a\n <b>",
    "<pre><code>a\n  b</code></pre>": "a\n  b", "<pre>\n\na</pre>": "\na", "a<br>b<br><br>c": "a\nb\n\nc",
    "<select><option>a<option>b</select>": "a\nb", "<details><summary>s</summary>x</details>": "s", "<details open><summary>s</summary>x</details>": "s\nx",
    "<p style='visibility: hidden'>h<b style='visibility:visible'>v</b>": "v", "<p style='display :\nnone'>h</p>v": "v",
    "<ol><li value=4>a<li>b</ol>": "4. a\n5. b", "<ol start=0><li>a</ol>": "0. a",
    "<div>" * 200 + "<script>s</script><style>t</style><p hidden><b>u</b></p>v": "v",
    "<table><tr><td>" + "a" * 130 + "<td>b<tr><td>c<td>d</table>": "a" * 130 + "  b\nc  d",
}


@pytest.mark.parametrize("html", CASES)
def test_markup(html):
    assert rendered(html) == CASES[html]


def test_any_markup_is_rendered():
    parts = ["<p>", "</p>", "<![", "<!", "<!--", "-->", "]>", "<table>", "<tr>", "<td>", "</td>", "</table>", "<li>", "<ul>", "<ol start=x>", "a", " ",
             "\n", "<pre>", "</pre>", "<script>", "</script>", "&#", "x;", "<", ">", '"', "'", '<a href="', "<b", "</", "<?", "=", "<svg>", "\xa0", "<head>"]
    draw = random.Random(3)
    for _ in range(5_000):
        assert isinstance(rendered("".join(draw.choices(parts, k=20))), str)


@pytest.mark.parametrize("part", ["<a ", "<!--", '<p a="', "<p a='", "</", "<b>", "&", "<script>", "<a =", "<p><ul><li>", "<", "x<b></b>"])
def test_long_broken_pages(part):
    begin = time.monotonic()
    rendered(part * 40_000)
    assert time.monotonic() - begin < 20


TABLES = {
    "<table><thead><th>Name<th>Age</thead><tr><td>Bo<td>7</table>": "Name  Age\nBo    7",
    "<table><tbody><form><tr><td>a</td><td>b</td></tr></form></tbody></table>": "a  b",
    "<table><tr><form><td>a</td><td>b</td></form></tr></table>c": "a  b\n\nc",
    "<table><tbody><td>x<tbody><td>y</table>": "x\ny", "<table><td>x<td>y</table>": "x  y",
    "<table><tbody>words<tr><td>x</table>": "words\nx", "<table><tfoot><div>d</div><b>e</b> f<tr><td>x</table>": "d\ne f\nx",
    "<table><tbody><img alt=i><tr><td>x</table>": "i\nx", "<table><tbody hidden><tr><td>h</tbody><tr><td>v</table>": "v",
}


@pytest.mark.parametrize("html", TABLES)
def test_row_groups_keep_their_text(html):
    assert rendered(html) == TABLES[html]


OPEN_PARTS = {
    "<table><colgroup><col><col><tr><td>A</td></tr></table>": "A", "<table><colgroup><tbody><tr><td>A<td>B</table>": "A  B",
    "<table><colgroup>t<tr><td>A</table>": "t\nA", "<table><caption>c<colgroup><col><thead><tr><th>A<tbody><tr><td>B</table>": "c\nA\nB",
    "<table><caption>c<tr><td>A<td>B<tr><td>CC<td>D</table>": "c\nA   B\nCC  D", "<table><caption>c <b>d<td>A<td>B</table>": "c d\nA  B",
    "<table><tr><td><template><tr><td>h</template>A<td>B</table>": "A  B", "<table><div>d<tr><td>A<td>B</table>": "d\nA  B",
    "<table><tr><td><table><colgroup><tr><td>A</table>B<td>C</table>": "A  C\n\nB",
}


@pytest.mark.parametrize("html", OPEN_PARTS)
def test_open_captions_and_column_groups_end_with_rows(html):
    assert rendered(html) == OPEN_PARTS[html]


DRAWN = {
    "<head><title>T</title>First words <b>more</b>": "First words more", "<p>a</p><head>b <i>c</i></head>": "a\n\nb c",
    "<head><title>T</title> <meta><style>s</style>\n</head><body>x": "x", "<head><head>x": "x", "x<head>y": "xy",
    "<head><title>T</title><img alt=i>x": "i x", "<!doctype html> <head><title>T</title></head> <head>x": "x",
    "E is <math><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup><annotation>mc^2</annotation></math>.": "E is mc2.",
    "<math><mfrac><mn>1</mn><mn>2</mn></mfrac></math>": "1 2",
    "<svg><title>t</title><desc>d</desc><defs><text>h</text></defs><text x=1>Label</text><path d='M0'/><text>two</text></svg>b": "Label two b",
    "<svg><title/><defs/><metadata>m</metadata>loose<g><text>a<tspan>b</tspan><tspan dy=1>c</tspan></text></g></svg>": "ab c",
    "<svg><style/><script/><foreignObject><div>x</div>y</foreignObject></svg>": "x\ny", "<svg/>x": "x", "<math/>x": "x", "<desc>x": "x",
    "<svg><text><![CDATA[a<b]]></text></svg>": "a<b", "<svg><defs><g><p>x": "x", "<svg hidden><text>a</text></svg>b": "b",
    "<p>a <svg viewBox=0/><path/></svg>b": "a b", "<svg><text display=none>a</text><text>b</text></svg>": "b",
    "<svg>" + "<g>" * 200 + "<text>a</text>" + "</g>" * 200 + "</svg>": "a", "<math><mi><![CDATA[x]]></mi></math>": "x",
}


@pytest.mark.parametrize("html", DRAWN)
def test_drawings_formulas_and_open_heads(html):
    assert rendered(html) == DRAWN[html]


@pytest.mark.parametrize("html, text", [
    ("<table><tr><td rowspan=2>A<td>B<tr><td>C</table>", "A  B\n   C"),
    ("<table><tr><td>a<td rowspan=0>B<td>c<tr><td>d<td>e<tr><td>f<td>g</table>", "a  B  c\nd     e\nf     g"),
    ("<table><tbody><tr><td rowspan=9>A<td>b<tbody><tr><td>c</table>", "A  b\nc"),  # a span ends with its row group
    ("<table><tr><td rowspan=2 colspan=2>AA<td>b<tr><td>c<tr><td>d<td>e<td>f</table>", "AA     b\n       c\nd   e  f"),
    ("<p>a<div>b</div>c</p>d", "a\n\nb\nc\n\nd"),
    ("<p style='/*display:none*/color:red'>x", "x"),
    ("<p style='content:\"display:none\"'>y", "y"),
    ("<p style='display:none;display:block'>z", "z"),
    ("<p style='display : none !important ; display:block'>z", ""),
    ("<p style='color:red;; DISPLAY:NONE'>z", ""),
    ("<p style='visibility:hidden'>a<b style='visibility:visible'>b</b>", "b"),
    ("<ol reversed><li>x<li>y</ol>", "2. x\n1. y"),
    ("<ol type=a start=26><li>x<li>y</ol>", "z. x\naa. y"),
    ("<ol type=I start=9><li>x<li type=1>y</ol>", "IX. x\n10. y"),
])
def test_spans_styles_and_numbers(html, text):
    assert rendered(html) == text


def test_depth_changes_nothing():
    inner = "<table><tr><td>aa<td>b<tr><td>c<td>d</table><ul><li>x<ul><li>y</ul></ul>"
    assert rendered("<div>" * 5000 + inner) == rendered(inner) == "aa  b\nc   d\n\n- x\n  - y"
    assert rendered("<b>" * 50_000 + "deep") == "deep"
