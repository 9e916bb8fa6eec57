"""op8: main text against plain parsing, template counts, odd markup."""

import html
import os
import re
import sys

sys.path.insert(0, os.path.dirname(__file__))

import corpus  # noqa: E402
from tributary.llm import templates as tp  # noqa: E402

PAGES = "page_id long, url string, html string, key string, host string, parts string"


def pages(spark, sources, host="a.example"):
    rows = [(i, f"https://{host}/{i}", s, "k", "h", None) for i, s in enumerate(sources)]
    return spark.createDataFrame(rows, PAGES)


def text(source):
    root = tp.parse(source)
    return tp.assemble(tp.pieces(root, tp.subtrees(root)), set())


def plain(source):
    """Main text of the driver's pages: what is in <article>, cut at its paragraphs and headings."""
    a = re.search(r"<article>(.*?)(</article>|\Z)", source, re.S)[1]
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", a)]
    return "\n".join(b for b in blocks if b)


def test_whole_table(spark):
    table = corpus.read(spark, "pages", "/root/testdata/sf0.01")
    want = {r.page_id: (r.url, plain(r.html)) for r in table.collect()}
    got = tp.extract_main_text(table).collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want
    assert all(r.n_chars == len(r.text) for r in got)


def test_recurring_boxes_go_and_shared_sentences_stay(spark):
    box = "<div class=x><p>Read our other fine articles</p></div>"
    page = lambda i: (f"<body><div>Welcome to this site</div><div><p>Own text {i}.</p><p>A sentence of all.</p>{box}"  # noqa: E731
                      f"<ul><li>one {i}</ul></div></body>")
    got = {r.page_id: r.text for r in tp.extract_main_text(pages(spark, [page(i) for i in range(12)])).collect()}
    assert got == {i: f"Own text {i}.\nA sentence of all.\none {i}" for i in range(12)}
    few = {r.page_id: r.text for r in tp.extract_main_text(pages(spark, [page(i) for i in range(4)])).collect()}
    assert few[0].startswith("Welcome to this site\nOwn text 0.")


def test_an_article_keeps_its_lists_tables_and_names(spark):
    page = lambda i: (f"<body><div>Site {i % 2}</div><article><h1>T{i}</h1><ul><li>Salt</li><li>Own {i}</li></ul>"  # noqa: E731
                      "<table><tr><td>Yes</td><td>No</td></tr></table><section id='related-work'><p>Prior.</p></section>"
                      "<p id='share-prices'>Up.</p><p class='notice'>Note.</p><h2 class='comments'>Remarks</h2>"
                      "<div class='ad-hoc'>Quick.</div><div class='ad'>Buy</div><div id=comments>me too</div></article></body>")
    want = "T{0}\nSalt\nOwn {0}\nYes\nNo\nPrior.\nUp.\nNote.\nRemarks\nQuick."
    got = {r.page_id: r.text for r in tp.extract_main_text(pages(spark, [page(i) for i in range(3)])).collect()}
    assert got == {i: want.format(i) for i in range(3)}
    # a box without a telling name goes where the host repeats it; lists and tables stay
    many = {r.page_id: r.text for r in tp.extract_main_text(pages(spark, [page(i) for i in range(12)])).collect()}
    assert many == {i: want.format(i).replace("Prior.\n", "").replace("\nQuick.", "") for i in range(12)}


def test_subtree_counts_decide_where_nothing_is_named(spark):
    """Two hosts without articles or names: what a fifth of a host's pages share goes, on any number of pages."""
    page = lambda i: (f"<body><div><b>Shop</b> of things</div><div>Offer {i % 30}</div><div><p>Text {i}</p></div>"  # noqa: E731
                      f"<div>{'rare' if i % 10 == 0 else 'one ' + str(i)}</div></body>")
    for n in (12, 60):
        got = {r.page_id: r.text for r in tp.extract_main_text(pages(spark, [page(i) for i in range(n)])).collect()}
        assert got == {i: f"Offer {i % 30}\nText {i}\n" + ("rare" if i % 10 == 0 else f"one {i}") for i in range(n)}


def test_copies_of_a_page_are_no_template(spark):
    page = "<body><div><div>All of this</div><div>was published often</div></div></body>"
    got = tp.extract_main_text(pages(spark, [page] * 40)).collect()
    assert {r.text for r in got} == {"All of this\nwas published often"}


def test_markup():
    assert text("<p>a<b>b</b> c<br>d<p>e &amp; &#233;&eacute; f&nbsp;g") == "ab c d\ne & éé f g"
    assert text("<article><header><h1>T</h1></header>x<div class='ad'>no</div><aside>no</aside><div id=comments>no</div>"
                "y<script>if (a<b) '</p>'</script><!-- <p>no</p> --><form><input>no</form></article><footer>no</footer>"
                ) == "T\nx\ny"
    assert text("<header>no</header><nav>no</nav><p>yes</p><div class='cookie-notice'>no</div>") == "yes"
    assert text("<main>teaser<article>one</article><article>two</article></main>") == "one\ntwo"
    assert text("<div class='post no-sidebar'>a</div><div hidden>b</div><div style='display: none'>c</div>") == "a"
    assert text("a < b and <3, 1<2 </x></p> &amp &bogus; <p") == "a < b and <3, 1<2 & &bogus;"
    assert text("<p title=a\"b>one</p><p title='a>b' class=\"x>y\">two</p><p title=\">three") == "one\ntwo\nthree"
    assert text("<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table><pre>f\n  g</pre>") == "a\nb\nc\nd\ne\nf g"
    assert text("") == text("<!-- open") == text("<script>x") == ""
    deep = "<div>" * 20_000 + "x"
    assert text(deep) == "x"


def test_odd_pages_and_empty_table(spark):
    rows = [(1, None, None), (None, "no host", "<p>a"), (2, "http://u@Host:80/x?y", ""), (2, "http://u@Host:80/x?y", ""),
            (3, "http://b", "<p>" + corpus.prose(1, 60_000)), (4, None, "plain text only")]
    df = spark.createDataFrame([(*r, "k", "h", None) for r in rows], PAGES)
    got = tp.extract_main_text(df).collect()
    assert sorted((r.page_id or 0, r.url or "", r.text) for r in got) == sorted(
        [(1, "", ""), (0, "no host", "a"), (2, "http://u@Host:80/x?y", ""), (2, "http://u@Host:80/x?y", ""),
         (3, "http://b", corpus.prose(1, 60_000)), (4, "", "plain text only")])
    assert tp.extract_main_text(df.where("false")).collect() == []
