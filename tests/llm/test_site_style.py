import html
import math
import re

import pytest

from flowlake.llm import site_style
from flowlake.llm.queries import op10_site_style_tree


def text(page, low=frozenset()):
    return site_style.main_text(page, set(low))


@pytest.mark.parametrize("page,want", [
    ("", ""),
    ("plain &amp; simple\n text", "plain & simple text"),
    ("<p>one<p>two <b>bold</b>\n x<br>y</p>", "one\ntwo bold x y"),
    ("<html><head><title>t</title></head><body><nav>menu</nav><article><h1>A</h1><p>B&nbsp;C</p></article><footer>f</footer></body></html>", "A\nB C"),
    ("<article><p><b>open.<br><p>next</p><div class='ad box'>buy</div><form>q<input></form></article><aside>s</aside>", "open.\nnext"),
    ("<div>before</div><script>if (a < b) { '</p>' }</script><style>p{}</style><!-- <p>c</p> --><p>after</p>", "before\nafter"),
    ("<p>x</p><!-- never closed <p>y</p>", "x"),
    ("a < b and c > d <3 <p title='x > y'>e</p>", "a < b and c > d <3\ne"),
    ("<ul><li>1<li>2</ul><table><tr><td>a<td>b<tr><td>c</table>", "1\n2\na\nb\nc"),
    ("<p>&#x41;&#66;&lt;tag&gt; &unknown; &copy</p>", "AB<tag> &unknown; ©"),
    ("<section class='comments'><p>me too</p></section><div id='cookie-notice'>ok?</div><p class=lead>L</p>", "L"),
    ("<main><article class='comment'>no</article><p>yes</p></main>", "yes"),
    ("<div><p>unclosed", "unclosed"),
    ("<p>" * 3000 + "deep", "deep"),
    ("<span>" * 3000 + "deep" + "</span>" * 3000, "deep"),
])
def test_one_page(page, want):
    assert text(page) == want


def site(n, host="h.example"):
    out = []
    for i in range(n):
        story = "".join(f"<p>story {i} part {j}</p>" for j in range(i % 4 + 1))
        out.append((i, f"http://{host}/{i}", f"<div><div><p>All rights of this site</p><p>Call us</p></div><div class=s>{story}</div></div>"))
    return out


@pytest.mark.parametrize("most", [0, 1000])
def test_repeated_branches_go(spark, monkeypatch, most):
    monkeypatch.setattr(site_style, "BROADCAST_NODES", most)
    rows = site(12) + [(100, "http://other.example/a", "<div><div><p>All rights of this site</p></div></div>")]
    frame = spark.createDataFrame(rows, "page_id int, url string, html string")
    found = {r["page_id"]: r["text"] for r in site_style.extract(frame).collect()}
    assert found[100] == "All rights of this site"
    for i in range(12):
        assert found[i] == "\n".join(f"story {i} part {j}" for j in range(i % 4 + 1))


def test_importances_by_hand(spark):
    pages = [(i, "http://h/", f"<div><p>same</p></div><div class=x><h2>own {i}</h2></div>") for i in range(8)]
    frame = spark.createDataFrame(pages, "page_id int, url string, html string")
    rows = {(r["is_text"], r["node"]): r for r in site_style.importances(frame).collect()}
    same = rows[True, site_style.number("text", ">div>p")]
    own = rows[True, site_style.number("text", ">div.x>h2")]
    style = rows[False, site_style.number("style", ">div")]
    assert (same["pages"], own["pages"], style["pages"]) == (8, 8, 8)
    assert (same["content"], own["content"], style["presentation"]) == pytest.approx((0, 1, 0), abs=1e-12)
    half = [(i, "http://h/", f"<div><p>{'a' if i < 4 else i}</p></div>") for i in range(8)]
    row = {r["node"]: r for r in site_style.importances(spark.createDataFrame(half, "page_id int, url string, html string")).collect()}
    assert row[site_style.number("text", ">div>p")]["content"] == pytest.approx(1 - 4 / 8 * math.log(4) / math.log(8))


def test_copies_of_an_article_stay(spark):
    frame = spark.createDataFrame([(i, "http://h/", "<nav>m</nav><article><h1>T</h1><p>copy</p></article>") for i in range(30)], "page_id int, url string, html string")
    assert {r["text"] for r in site_style.extract(frame).collect()} == {"T\ncopy"}


def found(spark, pages):
    frame = spark.createDataFrame([(i, "http://h/", page) for i, page in enumerate(pages)], "page_id int, url string, html string")
    return [r["text"] for r in site_style.extract(frame).orderBy("page_id").collect()]


def test_repeated_blocks_inside_an_article_go(spark):
    body = lambda i: "".join(f"<p>story {i} part {j}</p>" for j in range(i % 4 + 1))
    got = found(spark, [f"<main><article><h1>T {i}</h1><p>All rights reserved</p>{body(i)}</article></main>" for i in range(12)])
    assert got == ["\n".join([f"T {i}", *(f"story {i} part {j}" for j in range(i % 4 + 1))]) for i in range(12)]


@pytest.mark.parametrize("most", [0, 1000])
def test_text_beside_teasers_stays_and_copies_count_once(spark, monkeypatch, most):
    monkeypatch.setattr(site_style, "BROADCAST_NODES", most)
    page = lambda i: f"<article><a>teaser {i}</a></article><div class=body><p>body {i}</p><p>more {i}</p></div><div class=end>Call us</div>"
    copies = [f"<div class=x><p>line {i}</p></div><article><h1>T</h1><p>copy</p></article>" for i in range(20)]
    got = found(spark, [page(i) for i in range(8)] + copies)
    assert got[:8] == [f"teaser {i}\nbody {i}\nmore {i}" for i in range(8)]
    assert all(text.endswith("T\ncopy") for text in got[8:])


def test_without_article_texts_of_one_path_are_judged_alone(spark):
    got = found(spark, [f"<div><p>own {i}</p><p>and {i}</p><p>Imprint</p></div>" for i in range(10)])
    assert got == [f"own {i}\nand {i}" for i in range(10)]


def test_odd_rows(spark):
    schema = "page_id int, url string, html string, host string, text int, node string"
    frame = spark.createDataFrame([(1, None, None, "h", 1, "n"), (None, "no url", "", "h", 1, "n"), (3, "http://U:p@H.example:80/x", "<p>x", None, None, None)] * 2, schema)
    got = sorted((r["text"], r["n_chars"], r["host"] or "") for r in site_style.extract(frame).collect())
    assert got == [("", 0, "h")] * 4 + [("x", 1, "")] * 2
    assert site_style.extract(frame.limit(0)).count() == 0


def test_query(spark, folder):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = op10_site_style_tree(spark, folder).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"(?s)<article>(.*)</article>", pages[row["page_id"]])[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        assert row["text"] == "\n".join(filter(None, blocks))
        assert row["n_chars"] == len(row["text"])


@pytest.mark.parametrize("page,want", [
    ("<article><h2 id='related-work'>Related work</h2><h2 id='market-share'>Share</h2><section id='search'><p>s</p></section></article>", "Related work\nShare\ns"),
    ("<div class='content has-sidebar'><article><p>a</p></article></div><div class='no-sidebar'>b</div>", "a\nb"),
    ("<div class='page sidebar'><main><p>a</p></main></div>", "a"),
    ("<div class='page sidebar'><article><p>a</p></article></div>", "a"),
    ("<article><p><label>l</label> <math><mi>x</mi></math> <audio>u</audio><video>v</video></p></article>", "l x uv"),
    ("<p>a <span class='ad'>buy</span> b</p><h2 id='search'>Search</h2>", "a b\nSearch"),
])
def test_names_take_no_text(page, want):
    assert text(page) == want


def test_a_name_is_refuted_by_the_tree(spark):
    kinds = ["<p>{0}</p><ul><li>x {0}</ul>", "<h2>{0}</h2><p>y {0}</p>", "<p>{0}</p><h2>z {0}</h2><p>q {0}</p>", "<blockquote>{0}</blockquote>", "<table><tr><td>{0}</table>", "<pre>{0}</pre>"]
    got = found(spark, [f"<div class='share'>{kind.format(f'text {i}')}</div><div class='ad'><p>buy {i}</p></div><p>end {i}</p>" for i, kind in enumerate(kinds)])
    assert all(f"text {i}" in one and f"end {i}" in one and "buy" not in one for i, one in enumerate(got))
