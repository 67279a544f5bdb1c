import hashlib
import html
import re
import time

import pytest

from ledgerflow.llm import html_text

LONG = "The committee met on Monday, and after some hours, it agreed on a plan; nobody objected to the cost."
MORE = "Two members asked for figures, which the office had not prepared, so the vote was put off until spring."
SHORT = "Nothing more was said."

SEMANTIC = f"""<!doctype html><html><head><title>Plan agreed</title><style>p > b {{x:y}}</style>
<script>if (a < b) document.write("<p>{LONG}</p>");</script></head><body>
<header><h2>The Daily Paper</h2><p>{MORE}</p></header><nav><ul><li><a href=/a>News</a><li><a href=/b>Sport</a></ul></nav>
<div class="cookie-notice">We use cookies, and by reading on, you agree to that, as you know. {LONG}</div>
<main><article><header><h1>Plan &amp; cost agreed</h1></header><p>{LONG}</p><div class="ad-box"><p>{LONG} Buy now.</p></div>
<p>{MORE}<br>{SHORT}</p><ul><li>First point.</li><li>Second point.</li></ul><p>{SHORT}</p>
<form><label>Mail</label><input name=q><p>{LONG}</p></form></article>
<section id="comments"><p>I do not agree, and I never did, for many reasons. {MORE}</p></section></main>
<aside><p>{LONG}</p></aside><footer><p>&copy; 2020 The Daily Paper. {MORE}</p></footer></body></html>"""
SEMANTIC_TEXT = ["Plan & cost agreed", LONG, f"{MORE} {SHORT}", "First point.", "Second point.", SHORT]

DIVS = f"""<body><div id="top-nav"><a href=1>One</a> | <a href=2>Two</a></div><div class="pageContent">
<h1>Plan</h1><p>{LONG}</p><p>{MORE}</p><p>{SHORT}</p><p>{LONG}</p></div>
<div class="sidebar"><h3>Related</h3><p>{LONG}</p></div><div class="userComments"><p>{MORE}</p></div></body>"""

PLAIN = f"""<body><table><tr><td><a href=1>Home</a><td><a href=2>News</a><td><a href=3>About us</a></table>
<div><h1>Plan</h1><p>{LONG}<p>{MORE}<p>{SHORT}<p>{LONG} {MORE}</div>
<div><ul><li><a href=4>Read this</a><li><a href=5>Read that</a><li><a href=6>And this</a><li><a href=7>More</a>
<li><a href=8>Even more</a><li><a href=9>Last</a></ul></div></body>"""


def test_article_of_a_marked_page():
    assert html_text.content(SEMANTIC) == SEMANTIC_TEXT


def test_article_by_class_names():
    assert html_text.content(DIVS) == ["Plan", LONG, MORE, SHORT, LONG]


def test_article_by_ratios_alone():
    assert html_text.content(PLAIN) == ["Plan", LONG, MORE, SHORT, f"{LONG} {MORE}"]


@pytest.mark.parametrize("source, want", [
    (None, []), ("", []), ("   ", []), ("<p></p><div> </div>", []), ("plain words, no markup.", ["plain words, no markup."]),
    ("<p>a &lt; b &amp;amp; c&nbsp;&#x64; &eacute;&copy</p>", ["a < b &amp; c d é©"]),
    ("<p>one\n\t two<br/>three<b> fo</b>ur</p>", ["one two three four"]),
    ("<p>1 < 2 and 3 > 2</p>", ["1 < 2 and 3 > 2"]),
    ("<p>cut off <a href='x", ["cut off"]), ("<p>cut <!-- off <p>never", ["cut"]),
    ("<article><p>a<p>b</div></p>c</article>", ["a", "b", "c"]),
    ("<ARTICLE><P>Upper</P><SCRIPT>'</p>'</SCRIPT ></ARTICLE>", ["Upper"]),
    ("<article><p title='a > b'>x</p><p title=\"it's\">y</p></article>", ["x", "y"]),
    ("<article><p>same</p><p>same</p></article>", ["same", "same"]),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", ["1 2", "3"]),
    ("<article><p>see <a href=x>this page</a>, please.</p></article>", ["see this page, please."]),
    ("<article><p hidden>no</p><p style='display: none'>no</p><p>yes</p></article>", ["yes"]),
])
def test_cases(source, want):
    assert html_text.content(source) == want


def test_long_and_deep_pages_take_linear_time():
    t = time.perf_counter()
    assert len(html_text.content("<article>" + f"<p>{LONG}</p>" * 20_000)) == 20_000
    assert html_text.content("<div>" * 20_000 + LONG) == [LONG]
    html_text.content("<" * 50_000)
    html_text.content('<a "' * 5_000)
    html_text.content("<p>" + "<b><i>x</p>" * 5_000)
    assert time.perf_counter() - t < 20


def test_query_on_pages(spark):
    from ledgerflow.llm.catalog import LLM_QUERIES

    sf = "/root/testdata/sf0.001"
    got = {r.page_id: r for r in LLM_QUERIES["op13_html_extraction"](spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(got) == len(pages)
    for page in pages:  # brute force for these pages: what stands between the article's tags
        article = re.search(r"<article>(.*?)</article>", page.html, re.S).group(1).replace("<br>", " ")
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", article)]
        want = "\n\n".join(x for x in parts if x)
        assert got[page.page_id].text == want and got[page.page_id].n_chars == len(want)
        assert got[page.page_id].url == page.url


def test_nulls_repeats_clashes_and_empty_tables(spark):
    schema = "page_id long, html string, text int, N_CHARS string, url string"
    rows = [(1, None, 5, "x", None), (None, "<p>a.</p>", None, None, "u"), (None, "<p>a.</p>", None, None, "u")]
    out = html_text.extract(spark.createDataFrame(rows, schema))
    assert out.columns == ["page_id", "html", "url", "text", "n_chars"]
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in out.collect()) == [(0, "a.", 2), (0, "a.", 2), (1, "", 0)]
    assert html_text.extract(spark.createDataFrame([], schema)).count() == 0
