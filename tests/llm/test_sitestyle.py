"""Main texts of pages of known kinds; boilerplate that only the merged tree of a host shows."""

import re
import time
from html import unescape

from pyspark.sql import functions as F
from texts import awkward, empty

from revtide.llm import sitestyle
from revtide.llm.queries import op2_site_style_tree


def test_query_equals_plain(spark, sf_dir):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in op2_site_style_tree(spark, sf_dir).collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.DOTALL)[1]
        plain = " ".join(unescape(re.sub(r"<(?:h1|p|br|/h1|/p)[^>]*>", " ", article).replace("<b>", "").replace("</b>", "")).split())
        assert r["text"] == plain and r["n_chars"] == len(plain)


def test_markup():
    page = """<html><head><title>t</title></head><body><nav>menu</nav><div id=cookie-notice>ok</div><main><article>
    <h1>Ti<b>tle</b></h1><p>One &amp; two&nbsp;x<br>three<p>four <script>if (a < b) "</p>"</script><!-- c > d -->five
    <form>send</form><ul><li>a<li>b</ul><aside>side</aside><section class="reader-comments"><p>first!</p></section>
    </article></main><footer>f</footer>"""
    assert sitestyle.main_text(page) == "Title One & two x three four five a b"
    assert sitestyle.main_text(None) == sitestyle.main_text("") == ""
    assert sitestyle.main_text("plain < text &lt;b&gt;") == "plain < text <b>"
    assert sitestyle.main_text("<p>a</p>" * 3000 + "<div>" * 3000 + "x").count("a") == 3000


def test_tree_of_a_host(spark):
    page = "<body><div class='t1'>Acme daily, the best</div><div class='t2'><p>story {0} of {0}</p></div></body>"
    rows = [(i, f"http://h{i % 2}/x", page.format(i)) for i in range(40)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = sitestyle.extracted(frame).select("row.page_id", "text").collect()
    assert {(r["page_id"], r["text"]) for r in found} == {(i, f"story {i} of {i}") for i in range(40)}


def texts_of(spark, pages):
    rows = [(i, "http://h/x", page) for i, page in enumerate(pages)]
    found = sitestyle.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"))
    return {r["page_id"]: r["text"] for r in found.select("row.page_id", "text").collect()}


def test_long_articles(spark):
    body = "".join("<p>line {0} of %d</p>" % k for k in range(40))
    page = "<body><div>Acme daily</div>%s<div class=entry-content>" + body + "</div>%s</body>"
    text = " ".join("line {0} of %d" % k for k in range(40))
    for around in (("", ""), ("<article>", "</article>"), ("<main>", "</main>")):
        found = texts_of(spark, [(page % around).format(i) for i in range(40)])
        assert found == {i: text.format(i) for i in range(40)}


def test_text_of_few_pages_stays(spark):
    page = "<body><p>page {0}</p><div class=note><p>{1}</p></div></body>"
    found = texts_of(spark, [page.format(i, f"story {i}" if i < 4 else "Nothing new today") for i in range(200)])
    assert found == {i: f"page {i} story {i}" if i < 4 else f"page {i}" for i in range(200)}


def test_copies_of_a_page(spark):
    page = "<body><script>n={1}</script><div class=top>Acme daily</div><div class=text><p>story {0} of {0}</p></div></body>"
    pages = [page.format(7 if i < 180 else i, i) for i in range(200)]
    found = texts_of(spark, pages)
    assert found == {i: "story {0} of {0}".format(7 if i < 180 else i) for i in range(200)}
    alike = texts_of(spark, [page.format(7, i % 2) for i in range(16)])
    assert set(alike.values()) == {"Acme daily story 7 of 7"}


def test_hints_do_not_empty_a_page():
    for frame in (
        "<div id=page class='has-sidebar'>{}</div>", "<div class='content with-sidebar'>{}</div>",
        "<article class='post comments-open'>{}</article>", "<section class=legal>{}</section>",
        "<div class='social-studies'>{}</div>", "<div class=header><article>{}</article></div>",
    ):
        page = "<body>" + frame.format("<h1>Law</h1><p>one two three four") + "<div class=ad>buy</div></body>"
        assert sitestyle.main_text(page).startswith("Law one two three four"), frame
        assert "buy" not in sitestyle.main_text(page)
    legal = "<article><h1>A</h1><p>long text of a page<section class=legal><h2>Law</h2><p>b</section><div class=share>c</div></article>"
    assert sitestyle.main_text(legal) == "A long text of a page Law b"
    comments = "<article><p>long text of a page<div class=comments><h3 class=comments-title>2</h3><article class=comment>c</article></div></article>"
    assert sitestyle.main_text(comments) == "long text of a page"


def test_declared_parts():
    page = "<div>top</div><main><h1>Title</h1><p>lead<article>one</article><article>two</article></main><main>more</main>"
    assert sitestyle.main_text(page) == "Title lead one two more"
    teaser = "<div><p>the whole long text of this page</div><article>next</article>"
    assert sitestyle.main_text(teaser) == "the whole long text of this page next"


def test_small_hosts(spark):
    page = "<body><div class=top>Acme daily</div><div class=text><p>{}</p></div></body>"
    for n in (3, 7):
        found = texts_of(spark, [page.format(f"story {i} is long enough") for i in range(n)])
        assert found == {i: f"story {i} is long enough" for i in range(n)}
    page = "<body><p>read {} times</p><div class=text><p>the same long story on every page</p></div></body>"
    assert texts_of(spark, [page.format(i) for i in range(4)])[2] == "read 2 times the same long story on every page"


def test_comments_and_sidebars_go():
    page = ("<div class=text>{}</div><div class=comments><h3>3 comments</h3><p>first!</p></div>"
            "<div class=sidebar><h3>More</h3><a>links</a></div>")
    text = "a story of some length that goes on for a while"
    assert sitestyle.main_text(page.format(text)) == text
    legal = f"<div><p>{text} {text}</p><div class=notice><h2>Terms</h2><p>of the law</p></div></div>"
    assert sitestyle.main_text(legal) == f"{text} {text} Terms of the law"


def test_tree_without_telling_markup(spark):
    page = ("<body><div><ul><li>Home<li>News<li>Shop</ul></div><div><p>Acme daily, the best of the town</p></div>"
            "<div><h2>Story {0}</h2><p>what {0} did on day {0}<p>and then {0} left</div>"
            "<div><p>Buy at {1}</p></div><div>(c) Acme, all rights</div></body>")
    # Same places, so only the contents tell them apart; each element stands on a path of its own by its order.
    page = re.sub("<div>", lambda m, n=iter("vwxyz"): f"<div id={next(n)}>", page)
    for markup in (True, False):
        rows = [(i, "http://h/", page.format(i, i % 2)) for i in range(120)]
        found = sitestyle.extracted(spark.createDataFrame(rows, "page_id long, url string, html string"), markup=markup)
        for r in found.select("row.page_id", "text").collect():
            i = r["page_id"]
            assert r["text"] == f"Story {i} what {i} did on day {i} and then {i} left"


def test_few_pages_take_less(spark):
    page = "<body><div class=a><p>{0}</p></div><div class=b><p>{1}</p></div></body>"
    tag, story = "Acme daily", "story {} goes on and on for quite a while and has an end"
    for n in (2, 3, 12):
        assert texts_of(spark, [page.format(tag, story.format(i)) for i in range(n)]) == dict(enumerate(map(story.format, range(n))))
    half = story.format("of all")
    assert set(texts_of(spark, [page.format(half, story.format(i)) for i in range(2)]).values()) == {
        f"{half} {story.format(i)}" for i in range(2)}
    assert texts_of(spark, [page.format(half, story.format(i)) for i in range(12)]) == dict(enumerate(map(story.format, range(12))))


def test_hostile_pages_take_linear_time():
    for make in (
        lambda n: "<div>" * n + "x" + "</div>" * n, lambda n: "<a " * n, lambda n: "<a \"x>\"" * n + "'", lambda n: "<a" * n,
        lambda n: "<span>" * n + "<hr>" * n, lambda n: "<div>" * n + "</p>" * n, lambda n: "<div><p>word " * n,
        lambda n: "<!-" * n, lambda n: "<a '" * n, lambda n: "</" * n, lambda n: "&" * n, lambda n: "<li><ul>" * n,
    ):
        page = make(1_000_000 // len(make(1)))
        start = time.process_time()
        words, spans = sitestyle.outline(sitestyle.parse(page))
        sitestyle.styles(words, spans)
        sitestyle.main_text(page, {1: 1.0})
        assert time.process_time() - start < 30, page[:20]


def test_deep_elements_close_themselves():
    deep = "<div>" * 600 + "deep" + "</div>" * 600 + "<p>after</p>"
    root = sitestyle.parse(deep)
    assert sitestyle.main_text(deep) == "deep after" and len(root.children) == 2


def test_awkward_rows(spark):
    rows = awkward(spark).withColumn("url", F.col("source"))
    assert sitestyle.extracted(rows, html="text").count() == rows.count()
    none = empty(spark).withColumn("url", F.col("source"))
    assert sitestyle.extracted(none, html="text").count() == 0
