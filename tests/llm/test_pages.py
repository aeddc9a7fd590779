"""Main text of pages: rules on one page, templates over a host."""

from urllib.parse import urlsplit

import pytest
from pyspark.sql import types as T

from innlake.llm import page_text, page_tree
from tests.llm import cases

SCHEMA = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                       T.StructField("html", T.StringType()), T.StructField("host", T.StringType()),
                       T.StructField("text", T.IntegerType())])


@pytest.mark.parametrize("source, wanted", [
    ("", ""), ("plain &amp; simple", "plain & simple"),
    ("<p>a<p>b<br>c</p>d", "a\nb c\nd"),
    ("<article><h1>T&eacute;</h1><p><b>x\n y<br><p>z</article><footer>no</footer>", "Té\nx y\nz"),
    ("<body><nav><a>m</a></nav><div class='ad-box ad'>buy</div><div>keep</div></body>", "keep"),
    ("<main><header><h1>Head</h1></header><aside>no</aside><p>yes</p><section id=comments><p>no</p></section></main>",
     "Head\nyes"),
    ("<header>site</header><p>x</p>", "x"),
    ("<p>a<script>var t='</p>';</script>b<style>p{}</style></p>", "ab"),
    ("<!-- <p>no</p> --><p>1 &lt; 2</p><!-- open <p>no", "1 < 2"),
    ("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>", "a\nb\nc d\ne"),
    ("<p title=\"a > b\">x</p><p title=\"open>y</p>", "x\ny"),
    ("<div hidden>no</div><form><p>no</p></form><p style='display: none'>no</p><p>&nbsp;yes&nbsp; &#33;&amp</p>", "yes !&"),
    ("<article class=comment>no</article><article>yes</article>", "yes"),
    ("a < b and c > d", "a < b and c > d"),
])
def test_one_page(source, wanted):
    assert page_tree.text(page_tree.parse(source), set()) == wanted


def test_deep_and_odd_markup_is_read():
    assert page_tree.text(page_tree.parse("<div>" * 5000 + "x" + "</b></div>" * 10), set()) == "x"
    assert page_tree.text(page_tree.parse("<" * 2000 + "<p>y"), set()).endswith("y")


def site(host, n, box="<div><i>Follow us</i> today</div>"):
    return [(i, f"https://{host}/p{i}", f"<body>{box}<p>story {host} {i}</p></body>", "h", 1) for i in range(n)]


def test_recurring_subtrees_go(spark, tmp_path):
    rows = [(1000 + i, *r[1:]) for i, r in enumerate(site("one.example", 5))] + site("two.example", 2)
    rows += [(50, None, "<div><i>Follow us</i> today</div>", None, None), (51, "https://ONE.example:80/x", None, None, None),
             (52, "::", "<article><p>a</p></article>", None, None)]
    rows += [rows[-1], (None, "https://one.example/z", "<p>z</p>", None, None)]
    folder = cases.saved(spark.createDataFrame(rows, SCHEMA), tmp_path, "pages")
    found = page_text.query(spark, folder).collect()
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    by_id = {r["page_id"]: r["text"] for r in found}
    assert by_id[1000] == "story one.example 0" and by_id[0] == "Follow us today\nstory two.example 0"
    assert by_id[50] == "Follow us today" and by_id[51] == "" and by_id[52] == "a" and by_id[None] == "z"


def test_copied_articles_are_no_template(spark, tmp_path):
    rows = [(i, "http://a.example/", "<nav>x</nav><article><p>same</p></article>", None, None) for i in range(30)]
    folder = cases.saved(spark.createDataFrame(rows, SCHEMA), tmp_path, "pages")
    assert {r["text"] for r in page_text.query(spark, folder).collect()} == {"same"}


def test_empty_table(spark, tmp_path):
    folder = cases.saved(spark.createDataFrame([], SCHEMA), tmp_path, "pages")
    assert page_text.query(spark, folder).collect() == []


def texts(spark, tmp_path, sources, host="a.example"):
    rows = [(i, f"http://{host}/{i}", s, None, None) for i, s in enumerate(sources)]
    folder = cases.saved(spark.createDataFrame(rows, SCHEMA), tmp_path, "pages")
    return {r["page_id"]: r["text"] for r in page_text.query(spark, folder).collect()}


def test_labelled_boilerplate_inside_articles_goes_and_prose_stays(spark, tmp_path):
    notice = "<div class=promise>Read <b>more</b> every day</div>"
    prose = "<p>Released under a license.</p><ul><li>Les.</li></ul><blockquote>So it is</blockquote>"
    pages = [f"<article><h2>Sum</h2><p>story {i} is <b>so</b> long</p>{prose}{notice}</article>" for i in range(8)]
    copies = ["<article><p>same text</p><p>of all copies</p></article>"] * 9
    found = texts(spark, tmp_path, pages + copies)
    assert all(found[i] == f"Sum\nstory {i} is so long\nReleased under a license.\nLes.\nSo it is" for i in range(8))
    assert all(found[i] == "same text\nof all copies" for i in range(8, 17))


def test_text_does_not_depend_on_the_size_of_the_host(spark, tmp_path):
    def page(i):
        return f"<body><div class=top>Site</div><article><p>story {i} goes on</p><p>Les.</p></article></body>"
    small = texts(spark, tmp_path / "a", [page(i) for i in range(3)])
    large = texts(spark, tmp_path / "b", [page(i) for i in range(300)])
    assert all(large[i] == small[i] == f"story {i} goes on\nLes." for i in range(3))


def test_pages_without_marked_articles(spark, tmp_path):
    def page(i):
        return (f"<body><div id=top><p>Home</p><p>News</p></div><ul><li>One</li><li>Two</li></ul>"
                f"<div><h1>Title {i}</h1><p>story {i} goes on</p><p><b>Les.</b></p></div><div>Imprint</div></body>")
    found = texts(spark, tmp_path, [page(i) for i in range(6)])
    assert all(found[i] == f"Title {i}\nstory {i} goes on\nLes." for i in range(6))


def test_marked_teasers_are_not_the_main_text(spark, tmp_path):
    source = "<body><div><p>" + "long story " * 30 + "</p></div><section><article>next</article></section></body>"
    assert texts(spark, tmp_path, [source])[0] == ("long story " * 30).strip() + "\nnext"


def test_very_long_page(spark, tmp_path):
    body = "".join(f"<p>line {i} of many</p>" for i in range(60_000))
    found = texts(spark, tmp_path, [f"<nav>x</nav><article>{body}</article>"])
    assert found[0].split("\n") == [f"line {i} of many" for i in range(60_000)]


def test_templates_equal_a_single_count(spark):
    """All pages of a table, with templates counted in one process."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").select("page_id", "url", "html").collect()
    votes = {}
    for r in rows:
        host = urlsplit(r["url"] or "").hostname or ""
        for name, vote, inside in page_tree.prints(page_tree.parse(r["html"] or "")):
            votes.setdefault((host, name, inside), set()).add(vote)
    recurring = {(host, name) for (host, name, inside), found in votes.items() if len(found) >= (5 if inside else 3)}
    found = {r["page_id"]: r["text"] for r in page_text.query(spark, "/root/testdata/sf0.01").collect()}
    assert len(found) == len(rows) and recurring
    for r in rows:
        root = page_tree.parse(r["html"] or "")
        host = urlsplit(r["url"] or "").hostname or ""
        own = {name for name, _, _ in page_tree.prints(root) if (host, name) in recurring}
        assert found[r["page_id"]] == page_tree.text(root, own)


def test_texts_are_those_of_documents(spark):
    """The given pages are made of documents: their texts are whole."""
    def plain(text):
        return "".join((text or "").split())
    documents = {plain(r["text"]) for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("text").collect()}
    pages = page_text.query(spark, "/root/testdata/sf0.1").select("text").collect()
    whole = sum(plain(r["text"]) in documents or plain(r["text"].partition("\n")[2]) in documents for r in pages)
    assert whole == len(pages)


def test_bar_does_not_rise_with_the_host(spark, tmp_path):
    box = "<div>In our section</div>"
    found = texts(spark, tmp_path, [f"<body>{box if i < 4 else ''}<p>story {i}</p></body>" for i in range(600)])
    assert all(found[i] == f"story {i}" for i in range(600))


def test_hot_templates_and_copies(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(page_text, "HOT_ROWS", 2)
    monkeypatch.setattr(page_text, "HOT_COPIES", 2)
    pages = [f"<body><div>menu</div><p>story {i}</p></body>" for i in range(6)]
    found = texts(spark, tmp_path, pages + pages[:1] * 5)
    assert [found[i] for i in range(11)] == [f"story {i}" for i in [*range(6), *[0] * 5]]


def test_copied_unmarked_pages_are_one_page(spark, tmp_path):
    found = texts(spark, tmp_path, ["<body><div><p>own text</p><p>of a page</p></div></body>"] * 3)
    assert set(found.values()) == {"own text\nof a page"}


@pytest.mark.parametrize("source, wanted", [
    ("<div class='layout no-sidebar'><article>yes</article></div>", "yes"),
    ("<div id=with-nav><div class='header-fixed'><p>yes</p></div></div>", "yes"),
    ("<form><div><article>yes</article></div></form>", "yes"),
    ("<div class=sidebar><article>no</article></div><article>yes</article>", "yes"),
    ("<nav><article>no</article></nav><div class=comments><article>no</article></div><p>yes</p>", "yes"),
    ("<div class='cookie-banner'>no</div><div class='site-header'>no</div><p>yes</p>", "yes"),
])
def test_aside_words(source, wanted):
    assert page_tree.text(page_tree.parse(source), set()) == wanted
