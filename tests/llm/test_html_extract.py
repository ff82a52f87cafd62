"""Operator 10: wrappers of hand-made hosts, and the given pages against their known layout."""

import html
import re

import pytest
from pyspark.sql import functions as F

from ledgerlens.llm import html_extract as hx
from ledgerlens.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string, text string, wrapper string, host string"


def wrapper_of(pages):
    w = hx.stream(hx.parsed(pages[0]))
    for p in pages[1:]:
        w = hx.joined(w, hx.stream(hx.parsed(p)), repeat=False)
    return w


def texts(pages):
    w = hx.marked(wrapper_of(pages))
    return [hx.extracted(hx.parsed(p), w) for p in pages]


def test_mismatches_become_slots_options_and_repeats():
    w = wrapper_of(["<div><h1>One</h1><p>a</p></div>", "<div><h1>Two</h1><ul><li>x<li>y</ul><p>a<p>b</div>"])
    assert hx.expression(w) == "<div> <h1> # </h1> ( <ul> ( <li> # </li> )+ </ul> )? ( <p> # </p> )+ </div>"
    assert hx.expression(wrapper_of(["<dl><dt>a<dd>b<dt>c<dd>d<dt>e<dd>f</dl>"])) == "<dl> ( <dt> # </dt> <dd> # </dd> )+ </dl>"


ARTICLE = """<html><head><title>T</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a>Menu</a></ul></nav>
<div id="cookie-notice"><p>We use cookies</p></div><main><article class="post"><header><h1>Title &amp; more</h1><span>by me</span></header>
<p>First <b>bold</b> and&nbsp;a<br>line &lt;x&gt;</p><script>var t="</p>";</script><p>Second<ul><li>one<li>two</ul>
<div class="ad">Buy</div><form><input><label>Mail</label></form><!-- <p>no</p> --></article></main><aside>Side</aside>
<section class="comments"><article class="comment"><p>Reader says a great many things here</p></article></section><footer>&copy; me</footer></body></html>"""


def test_article_without_its_surroundings():
    assert texts([ARTICLE]) == ["Title & more\nFirst bold and a\nline <x>\nSecond\none\ntwo"]


def test_main_part_by_the_bulk_of_the_text_and_template_text():
    page = lambda i: f"<body><div class='top'>Home About</div><div class='x1'><h1>Head {i}</h1><div class='c'><p>{'long text ' * 30}{i}</p><p>end {i}</p></div><div class='k'>Written by staff</div></div><div>tiny {i}</div></body>"
    got = texts([page(i) for i in range(6)])
    assert got[2] == "Head 2\n" + "long text " * 30 + "2\nend 2"


def test_a_constant_slot_in_the_article_is_template_text_unless_all_pages_are_copies():
    page = lambda i: f"<article><div class='tagline'>Always the same</div><p>body {i}</p></article>"
    assert texts([page(i) for i in range(6)])[3] == "body 3"
    assert texts([page(0)] * 6)[3] == "Always the same\nbody 0"
    assert texts([page(i) for i in range(3)])[1] == "Always the same\nbody 1"


def test_each_page_of_a_host_has_its_own_main_part():
    words = "some text of the page " * 20
    post = [f"<body><article class='post'><h1>T {i}</h1><p>{words}{i}</p></article></body>" for i in range(9)]
    other = ["<body><article class='opinion'><p>an opinion</p></article></body>", "<body><div>Top</div><main><p>only main</p></main></body>",
             f"<body><div>Top</div><div class='content'><p>{words}</p><p>no article here</p></div></body>"]
    assert texts(post + other)[9:] == ["an opinion", "only main", f"{words.strip()}\nno article here"]
    assert texts(post + ["<body><div>Top</div><article></article></body>"])[9] == ""
    most = [f"<body><div class='a'><p>{words}{i}</p><p>end</p></div></body>" for i in range(20)]
    assert texts(most + ["<body><div class='b'><p>another</p><p>template</p></div></body>"])[20] == "another\ntemplate"


def test_constant_text_of_some_pages_and_constant_headings_stay():
    plain = [f"<article><p>body {i}</p></article>" for i in range(20)]
    copies = ["<article><div>Only here</div><blockquote>Said once</blockquote><p>copied</p></article>"] * 6
    assert texts(plain + copies)[20:] == ["Only here\nSaid once\ncopied"] * 6
    assert texts(copies + plain)[0] == "Only here\nSaid once\ncopied"
    assert texts([f"<article><h2>Summary</h2><p>body {i}</p></article>" for i in range(9)])[4] == "Summary\nbody 4"


def test_pages_of_a_known_shape_count(spark):
    rows = [(i, "http://h.example/", f"<article><div>{'Read on' if i % 2 else 'Other'}</div><p>body {i}</p></article>", "", "", "") for i in range(12)]
    rows += [(i, "http://k.example/", f"<article><div>Same</div><p>body {i}</p></article>", "", "", "") for i in range(12)]
    pages = spark.createDataFrame(rows, SCHEMA).coalesce(2)
    got = {(r.url, r.page_id): r.text for r in hx.extract(pages, hx.wrappers(pages)).collect()}
    assert got["http://h.example/", 3] == "Read on\nbody 3" and got["http://k.example/", 3] == "body 3"


def test_text_after_a_region_nested_too_deep_stays_in_the_article():
    deep = "<div>" * 100 + "deep<p>est</p>er<div class='ad'><div>Buy</div> now</div><ul><li class='ad'>Buy<li>an item</ul>" + "</div>" * 100
    page = f"<body><div>Top</div><div><article><p>before</p>{deep}<p>after</p></article></div><div>End</div></body>"
    assert texts([page]) == ["before\ndeep\nest\ner\nan item\nafter"]
    many = "<ul>" + "<center>" * 50_000 + "<li>a" * 50_000
    assert texts([f"<article>{many}</article>"])[0].count("a") == 50_000


WORDS = "some text of the page " * 20


@pytest.mark.parametrize("around", ["<div class='content has-sidebar'>", "<div id='page' class='no-sidebar'>", "<section class='share-price'>", "<div class='page-widget'>", "<div class='widget'>"])
def test_a_name_does_not_drop_the_article(around):
    close = f"</{around[1:].split()[0]}>"
    end = f"<div class='related-posts'><article><p>{WORDS}teaser</p></article></div>"
    assert texts([f"<body><div class='site-header'>Top</div>{around}<article><h1>T</h1><p>{WORDS}</p></article>{end}{close}</body>"]) == [f"T\n{WORDS.strip()}"]
    if around != "<div class='widget'>":
        assert texts([f"<body><div>Top</div>{around}<p>{WORDS}</p><p>end {i}</p>{close}</body>" for i in range(3)])[1] == f"{WORDS.strip()}\nend 1"
        assert texts([f"<body><article>{around}<p>{WORDS}</p><p>end {i}</p>{close}</article></body>" for i in range(3)])[1] == f"{WORDS.strip()}\nend 1"


def test_boilerplate_names_in_an_article():
    inside = "<div class='post-header'><div><h1>T</h1></div>by me</div><h2 class='page-header'>H</h2><p>body</p><section class='share-price'><p>9.50</p></section><div class='share-buttons'>Tweet</div><div class='sidebar'>Side</div><div id='post-comments'><h3>Comments</h3><p>Reader</p></div>"
    assert texts([f"<article>{inside}</article>"]) == ["T\nH\nbody\n9.50"]
    assert texts([f"<body><div class='comments'><article><p>{WORDS * 9}</p></article></div><article><p>short</p></article></body>"]) == ["short"]


@pytest.mark.parametrize("page", ["", "   ", "plain text only", "<", "<p", "<!-- open", "<script>never closed", "</p></div>", "<p>" * 3000, "<div>" * 9000 + "deep", "<p a='unclosed>x</p>", "a < b & c", "<table><tr><td>a<td>b<tr><td>c</table>", "\x00<p>x</p>"])
def test_odd_pages_do_not_crash(page):
    assert isinstance(texts([page, page, "<p>x</p>"])[0], str)


def test_wrappers_stay_bounded():
    pages = ["<article>" + "".join(f"<div class='c{chr(97 + (i * k) % 26)}{'x' * (i % 9)}{'y' * (k % 11)}'><p>t {i} {k}</p></div><h{1 + (i * i + k) % 6}>u</h{1 + (i * i + k) % 6}>" for i in range(300)) + "</article>" for k in range(40)]
    w = wrapper_of(pages)
    assert len(hx.json.dumps(w)) < 60_000
    assert texts(pages)[7].count("t ") == 300


def test_odd_rows(spark):
    long = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    rows = [(1, None, None), (2, "http://A.example.com:80/x", ""), (3, "https://a.example.com/y", ARTICLE), (None, "nonsense", "<p>x</p>"), (3, "https://a.example.com/y", ARTICLE), (5, "http://u@b.example.com/", long)]
    pages = spark.createDataFrame([(i, u, h, "clash", "clash", "clash") for i, u, h in rows], SCHEMA)
    got = sorted((tuple(r) for r in hx.extract(pages, hx.wrappers(pages)).collect()), key=str)
    assert len(got) == 6 and (1, None, "") in got and (2, rows[1][1], "") in got and (None, "nonsense", "x") in got
    assert [t for i, _, t in got if i == 3][0].startswith("Title & more\n") and [t for i, _, t in got if i == 5][0].count("\n") == 19_999
    assert [r.h for r in pages.select(hx.host_column(F.col("url")).alias("h")).collect()] == [hx.host_of(u) for _, u, _ in rows]
    empty = pages.limit(0)
    assert hx.extract(empty, hx.wrappers(empty)).count() == 0


def test_given_pages(spark):
    sf = "/root/testdata/sf0.01"
    want = {}
    for r in spark.read.parquet(f"{sf}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = (html.unescape(re.sub(r"</?b>", "", x)).split() for x in re.split(r"<(?:/?p|/?h1|br)>", article))
        want[r.page_id] = "\n".join(" ".join(x) for x in parts if x)
    got = QUERIES["op10_html_extract"](spark, sf).collect()
    assert {r.page_id: r.text for r in got} == want and all(r.n_chars == len(r.text) for r in got)


def test_no_page_is_lost_whatever_its_url(spark):
    urls = ["\u212att" + "p://b.com/x", "http://B.com/y", "HTTP://\u0130x.org/", "http://stra\u00dfe.de/", None, "", "nonsense", "ftp://u@h:1/z", "http://\u212a.com"]
    page = "<body><article><h1>Title</h1><p>Text of the page</p></article></body>"
    pages = spark.createDataFrame([(i, u, page, "clash", "clash", "clash") for i, u in enumerate(urls)], SCHEMA)
    got = hx.extract(pages, hx.wrappers(pages)).collect()
    assert sorted((r.page_id, r.text) for r in got) == [(i, "Title\nText of the page") for i in range(len(urls))]
    none = hx.extract(pages, hx.wrappers(pages.where("page_id < 0"))).collect()  # hosts without a wrapper
    assert sorted((r.page_id, r.text) for r in none) == sorted((r.page_id, r.text) for r in got)
