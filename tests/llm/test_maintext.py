"""Main text against a second, plainer reading of the given pages, and hand-made pages."""

import html
import re

import pytest
from pyspark.sql import functions as F

from tillwarden.llm import maintext, queries
from tillwarden.llm.maintext import extract

LONG = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore."


def plain(page):
    """The given pages have an article of headings and paragraphs."""
    found = re.search(r"<article>(.*)</article>", page or "", re.S)
    parts = re.split(r"</?(?:p|h1)>", found[1]) if found else []
    lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in parts)
    return "\n".join(x for x in lines if x)


def test_query(spark, data):
    pages = {r.page_id: r for r in spark.read.parquet(f"{data}/pages.parquet").collect()}
    found = queries.op13_main_text(spark, data).collect()
    assert len(found) == len(pages)
    for r in found:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, plain(pages[r.page_id].html), len(r.text))


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<nav>only a menu</nav>", ""),
        ("<script>var a = '<p>x</p>'</script><style>p{}</style><!-- <p>no</p> -->", ""),
        ("bare &lt;text&gt; &amp;amp; a&nbsp;b<br>c", "bare <text> &amp; a b c"),
        ("<p>unclosed <b>bold <i>x</p><p>next", "unclosed bold x\nnext"),
        ("<p title=\"a>b\">x</p><!-- <p>no</p> --><!-->y", "x\ny"),
        ("a < b and c > d", "a < b and c > d"),
        ("<ul><li>one<li>two</ul><table><tr><td>a<td>b</table>", "one\ntwo\na\nb"),
        ("<p>" + "<div>" * 3_000 + "deep", "deep"),
        (f"<div class='wrap has-sidebar'><div id=menu><a href=x>A</a></div><div><h1>T</h1><p>{LONG}<p>{LONG} <a href=y>z</a></p><p>Short.</div><div class=sidebar>{LONG}</div><div id='comments'><p>{LONG * 5}</div></div>", f"T\n{LONG}\n{LONG} z\nShort."),
        (f"<article><header><h1>T</h1></header><section><h2>S</h2><p>{LONG}</section><section><h2>U</h2><p>x</section><ol class='comment-list'><li>{LONG * 9}</ol><footer>f</footer></article>", f"T\nS\n{LONG}\nU\nx"),
        (f"<form id=aspnet><div class=cookie-notice>{LONG}</div><main><p>{LONG}</main></form><div role=alert>{LONG}</div>", LONG),
        (f"<h1>T</h1><div><div>{''.join(f'<p>{LONG}</p>' for _ in range(4))}</div><ul>{'<li><a href=x>more</a>' * 30}</ul></div>", "\n".join(["T"] + [LONG] * 4)),
    ],
)
def test_pages(page, text):
    assert extract(page) == text


def test_densities():
    """By hand: two paragraphs below a box, one with a link over half of its characters."""
    nodes, texts = maintext.parse("<div><p>abcdefgh</p><p>abcd<a>efgh</a></p></div>")
    maintext.measure(nodes, texts)
    import math

    box, first, second, link = nodes[1:]
    assert (first.chars, second.chars, second.links, box.tags, box.link_tags) == (8, 8, 4, 3, 1)
    base = lambda c, l: math.log(c / max(c - l, 1) * l + 4 / 16 * c + math.e)
    assert first.density == pytest.approx(8 * math.log(8) / math.log(base(8, 0)))
    assert second.density == pytest.approx(8 * math.log(8 / 4) / math.log(base(8, 4)))
    assert box.total == pytest.approx(first.density + second.density)


def test_frame(spark):
    rows = [(1, "u", f"<p>{LONG}"), (1, "u", f"<p>{LONG}"), (None, None, None), (2, "", "<p>" + "word " * 200_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit(1), "n_chars": F.lit("x")})
    found = sorted((r.page_id or 0, r.n_chars) for r in maintext.extracted(df).collect())
    assert found == [(0, 0), (1, len(LONG)), (1, len(LONG)), (2, 999_999)]
    assert maintext.extracted(df.limit(0)).count() == 0
