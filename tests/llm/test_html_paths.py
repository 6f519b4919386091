"""Main text of pages of several templates, and the vote of hosts."""

import html
import re

import pytest

from sheafworks.llm import html_paths, queries

SCHEMA = "page_id long, url string, html string"

FULL = """<!doctype html><html><head><title>T</title><style>p{x}</style></head><body class="has-sidebar">
<header class="site-header"><a href=/>Home</a> My site</header><div id="cookie-notice">We use cookies</div>
<div class="wrap no-sidebar"><ul class="menu"><li><a href=1>One</a><li><a href=2>Two</a></ul>
<div class="post-123 entry"><div class="entry-header"><h1>Title &amp; more</h1></div>
<p>First para with <b>bold</b>text &lt;tag&gt;.<p>Second&nbsp;para,\n split<br>here.<ul><li>item a<li>item b</ul>
<table><tr><td>c1<td>c2</table><form><input>Subscribe</form><script>var x="</div>"</script><div class=ad>Buy</div></div>
<aside>Side</aside><div class="comments"><p>A very long comment that goes on and on, longer than the article itself,
for sure, it is really long and has no end at all, on and on.</div></div><footer>&copy; x</footer></body></html>"""
TEXT = "Title & more First para with boldtext <tag>. Second para, split here. item a item b c1 c2"


def test_everything_around_the_article_goes():
    path = html_paths.vote(FULL)
    assert path == "html>body.has-sidebar>div.no-sidebar.wrap>div.entry.post"
    assert html_paths.extract(FULL, path) == html_paths.extract(FULL, None) == TEXT


@pytest.mark.parametrize(
    "page,text",
    [
        ("", ""),
        ("text only", "text only"),
        ("a < b &amp &am; c", "a < b & &am; c"),
        ("<p>x<p>y", "x y"),
        ("<p", ""),
        ("<script>x", ""),
        ("<!-- a --><p>b<!-- </p> --> c", "b c"),
        ("<p title='a>b'>q</p>", "q"),
        ("<main><header><h1>H</h1></header><p>b</p><footer>f</footer></main><footer>g</footer>", "H b"),
        ("<article class=comment><p>a reader</p></article><article><p>the text</p></article>", "the text"),
        ("<div style='display:none'>no</div><div hidden>no</div><p>yes</p>", "yes"),
        ("<div class='newsletter'><p>only this</p></div>", "only this"),
        ("<ul><li><a href=x>only a link</a></ul>", "only a link"),
        ("<article><h1>t</h1><p><b>one<br><p>two</p></article><footer>f", "t one two"),
        ("<article><noscript>n</noscript><textarea>t</textarea><p>a&#8217;s &eacute;</p><nav>n</nav></article>", "a’s é"),
    ],
)
def test_pages_by_themselves(page, text):
    assert html_paths.extract(page, html_paths.vote(page)) == text


def test_deep_and_broken_pages_take_linear_time():
    assert html_paths.extract("<div>" * 5000 + "x" + "</p>" * 5000, None) == "x"
    assert html_paths.extract('<p class="' * 5000, None) == ""
    assert html_paths.extract("<p>x" * 5000, None) == " ".join("x" * 5000)


def page(article, remarks):
    said = "".join(f"<p>{r}</p>" for r in remarks)
    return f"<body><div class=a1><div class=b>{article}</div><div class=c>{said}</div></div></body>"


def test_host_vote_beats_the_page(spark):
    long = "words of an article that go on " * 5
    rows = [(i, "http://h.example/x", page(f"<p>{long}{i}</p>", ["ok"])) for i in range(5)]
    rows += [(9, "https://u:p@H.example:80/y?z", page("<p>short text</p>", ["a long remark " * 30, "and more of it " * 30]))]
    rows += [(10, "http://other.example", rows[5][2]), (11, None, rows[5][2]), (12, "no address", "<p>z</p>")]
    table = spark.createDataFrame(rows, SCHEMA)
    winners = {r["host"]: r["path"] for r in html_paths.host_paths(table).collect()}
    assert winners["h.example"] == "body>div.a>div.b"
    got = {r["page_id"]: r["text"] for r in html_paths.extract_pages(table).collect()}
    assert got[0] == f"{long}0".strip()
    assert got[9] == "short text"  # by the other pages of its host
    assert "remark" in got[10] and "remark" in got[11]
    assert got[12] == "z"


def test_ties_go_to_the_first_path(spark):
    rows = [(1, "http://h/1", "<div class=b>x</div>"), (2, "http://h/2", "<div class=a>y</div>")]
    table = spark.createDataFrame(rows, SCHEMA)
    assert html_paths.host_paths(table).first()["path"] == "div.a"
    got = {r["page_id"]: r["text"] for r in html_paths.extract_pages(table).collect()}
    assert got == {1: "x", 2: "y"}


def test_joined_by_shuffle_gives_the_same(spark, monkeypatch):
    rows = [(i % 5, f"http://h{i % 2}.example/{i}", FULL if i % 3 else None) for i in range(30)] + [(None, None, "")]
    table = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], f"{SCHEMA}, host string, path string, text string")
    plain = sorted(map(tuple, html_paths.extract_pages(table).collect()), key=repr)
    monkeypatch.setattr(html_paths, "BROADCAST_ROWS", 0)
    assert sorted(map(tuple, html_paths.extract_pages(table).collect()), key=repr) == plain
    assert sorted(plain, key=repr) == sorted(((p, u, TEXT if t else "") for p, u, t in rows), key=repr)


def test_empty_table(spark):
    assert html_paths.extract_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_on_the_given_pages(spark):
    folder = "/root/testdata/sf0.001"
    got = {r["page_id"]: r for r in queries.op12_host_paths(spark, folder).collect()}
    pages = spark.read.parquet(f"{folder}/pages.parquet").collect()
    assert len(got) == len(pages)
    for row in pages:
        inner = re.search("<article>(.*?)</article>", row["html"], re.DOTALL).group(1)
        text = re.sub("</?b>", "", re.sub("</?(?:p|h1|br)>", " ", inner))
        text = " ".join(html.unescape(text).split())
        assert (got[row["page_id"]]["text"], got[row["page_id"]]["n_chars"]) == (text, len(text))
