import re
from html import unescape

from tabeval.llm import htmlwrap

SCHEMA = "page_id bigint, url string, html string, host int, wrapper string, text string"
PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a>menu</a><li>x</ul></nav><!-- ad > <p>no</p> --><div class="cookie-notice">We use</div><aside>side</aside><main><article><h1>Head &amp; line</h1>
<p>one <b>two</b>three<br>four<p title="a > b">five &lt;x&gt; 3 < 4 <span class="ad">buy</span>&nbsp;six<ul><li>a<li>b</ul><form><input>q</form><table><tr><td>c1<td>c2</table>
<section id="comments"><article>hi</article></section><div style="display: none">no</div><footer>by</footer></article></main><div id="sidebar-2">s</div><footer>&copy;</footer>"""


def texts(spark, pages):
    frame = spark.createDataFrame([(p, u, h, 1, "w", "t") for p, u, h in pages], SCHEMA)
    return {r["page_id"]: (r["text"], r["n_chars"]) for r in htmlwrap.extract_text(frame).collect()}


def test_article_without_its_surroundings(spark):
    got = texts(spark, [(1, "http://a.com/x", PAGE), (2, "http://a.com/y", PAGE.replace("one", "uno"))])
    assert got[1][0] == "Head & line one twothree four five <x> 3 < 4 six a b c1 c2" and got[1][1] == len(got[1][0])
    assert got[2][0].startswith("Head & line uno")


def test_given_pages_against_their_articles(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: r["text"] for r in htmlwrap.extract_text(pages).collect()}
    for row in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", row["html"], re.S).group(1)
        parts = re.split(r"</?(?:h1|p)>", re.sub(r"<br>", " ", re.sub(r"</?b>", "", inner)))
        assert got[row["page_id"]] == " ".join(x for x in (" ".join(unescape(p).split()) for p in parts) if x)


def test_wrappers_align_pages_into_optional_and_repeated_groups():
    pages = ["<div><h1>a</h1><p>x<p>y</div>", "<div><h1>b</h1><p>z</p><ul><li>1<li>2</ul></div>", "<div><h1>b</h1><ul><li>1</ul><p>z</div>"]
    folded = htmlwrap.fold(htmlwrap.wrapper_of(htmlwrap.parse(p)) for p in pages[:2])
    assert htmlwrap.pattern(folded) == "<div><h1>#</h1>(<p>#</p>)+((<ul>(<li>#</li>)+</ul>))?".replace("((<ul>(<li>#</li>)+</ul>))?", "(<ul>(<li>#</li>)+</ul>)?") + "</div>"
    mixed = htmlwrap.fold([folded, htmlwrap.wrapper_of(htmlwrap.parse(pages[2]))])
    assert "(<p>" in htmlwrap.pattern(mixed) and htmlwrap.pattern(mixed).count("<p>") == 1 and ")+</div>" in htmlwrap.pattern(mixed)
    order = [htmlwrap.fold([htmlwrap.wrapper_of(htmlwrap.parse(pages[i])) for i in p]) for p in ((0, 1, 2), (2, 1, 0), (1, 0, 2))]
    assert len({str(sorted(map(str, o["kids"]["div"]["order"]))) for o in order}) == 1


def test_without_an_article_the_template_goes(spark):
    page = "<html><body><div class=top>Welcome to us</div><div class=content><p>{}</p><p>more {}</p></div><div class='legal'>All rights</div></body></html>"
    got = texts(spark, [(i, "http://b.org/", page.format(f"text {i}", i * i)) for i in range(5)])
    assert got[3][0] == "text 3 more 9"


def test_odd_pages(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 40_000 + "</article>"
    deep = "<div>" * 3000 + "<article><p>in</p></article>"
    pages = [(1, None, None), (2, "http://c/", ""), (3, "no url", "plain text"), (4, "http://c/", "<article><p>open"), (5, "http://c/", "<article>a<!-- never closed"), (6, "http://c/", '<article title="never'),
             (7, "http://c/", "<article><script>x</article>"), (8, "http://c/", "< b <3 <article>ok</article>"), (9, "http://d/", long), (10, "http://e/", deep), (None, "http://c/", "<article>n</article>"),
             (11, "http://f/", "<article>a</article>"), (11, "http://f/", "<article>a</article>"), (12, "http://c/", "</p></div><article></article>")]
    got = texts(spark, pages)
    assert [got[i][0] for i in (1, 2, 3, 4, 5, 7, 8, 12)] == ["", "", "plain text", "open", "a", "", "ok", ""]
    assert got[9][0] == " ".join(["word & word"] * 40_000) and got[10][0] == "in" and got[None][0] == "n" and got[11][0] == "a"
    assert texts(spark, []) == {}


def test_layout_classes_do_not_drop_content(spark):
    article = '<article><div class="article-header"><h1>Title</h1></div><div class="header">By</div><p>body {}</p><div class="elementor-widget-text-editor">more</div><div class="widget">w</div></article>'
    wrapped = ["<div class='content-area has-sidebar'>{}</div>", "<div class=no-sidebar>{}</div>", "<div class=widget>{}</div>", "<span id=sidebar>{}</span>", "<section class=comments>{}</section>"]
    pages = [(i, f"http://w{i}.org/{j}", f"<body>top{w.format(article.format(j))}end</body>") for i, w in enumerate(wrapped) for j in (0,)]
    assert {t for t, _ in texts(spark, pages).values()} == {"Title By body 0 more"}
    comment = "<article class='comment'>mine</article>"
    beside = [(1, "http://x.org/", article.format(1) + comment), (2, "http://y.org/", comment), (3, "http://z.org/", "<div class='has-sidebar'><p>plain</p></div>")]
    assert [texts(spark, beside)[i][0] for i in (1, 2, 3)] == ["Title By body 1 more", "mine", "plain"]


def test_copies_of_a_page_are_no_template(spark):
    page = "<body><h1>Head</h1><div>direct<p>{}</p></div></body>"
    pages = [(i, "http://three.org/", page.format("x")) for i in range(3)] + [(10 + i, None, page.format("null")) for i in range(4)]
    pages += [(100 + i, f"http://many.org/{i}", f"<!-- {i} -->" + page.format("y")) for i in range(3000)] + [(5000, "http://many.org/o", "<body><p>other</p></body>")]
    got = texts(spark, pages)
    assert got[2][0] == "Head direct x" and got[13][0] == "Head direct null" and got[5000][0] == "other"
    assert {got[100 + i][0] for i in range(3000)} == {"Head direct y"}
    same = [(i, "http://t.org/", page.format(f"text {i % 3}")) for i in range(9)]  # three contents, thrice each
    assert texts(spark, same)[7][0] == "text 1"


def test_deep_closed_nesting_keeps_what_follows(spark):
    for n in (100, 5000):
        deep = "<div><article>" + "<div>" * n + "in<nav>menu<div>m</div></nav><form>f</form>" + "</div>" * n + "<p>tail</p></article></div>"
        plain = "<body>" + "<div>" * n + "<p>a</p>b<nav>menu</nav>" + "</div>" * n + "<p>tail</p></body>"
        assert [texts(spark, [(1, "http://a/", deep), (2, "http://b/", plain)])[i][0] for i in (1, 2)] == ["in tail", "a b tail"]
