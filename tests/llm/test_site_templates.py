"""Site templates: what the parser keeps, what recurs on a host, odd pages."""

import html
import re

from candor.llm import site_templates as S
from candor.sources.tables import table
from llm_data import SF01

PAGES = "page_id bigint, url string, html string, host string, blocks string, body int, rid string"


def pages_of(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", "b", 1, "r") for i, u, h in rows], PAGES)


def text(page):
    return " ".join(t for t, _ in S.blocks(page))


def test_markup():
    assert text(None) == text("") == text("<p> \n </p>") == ""
    assert text("plain &amp; &lt;b&gt; &eacute;&#233;&nbsp;x") == "plain & <b> éé x"
    assert text("<p>a<p>b<br>c <i>d</i>e<li>f<li>g") == "a b c de f g"
    assert text("<script>var a='<p>x</p>'</script><style>p{}</style><!-- <p>c</p> -->t<title>no</title>") == "t"
    assert text("<p title='a>b'>x</p> 1 < 2 <3") == "x 1 < 2 <3"
    assert text("<P>Up</P><DIV CLASS=AD>no</DIV>") == "Up"
    assert text("<p>cut <b>off <a href='x") == "cut off <a href='x"


def test_what_is_not_the_article():
    inside = "<article><header><h1>T</h1></header><p>one</p><aside>x</aside><p>two <span class='ad'>x <span>x</span> x</span>end</p>" \
             "<form>x</form><div class='share-buttons'>x</div><footer>x</footer><section id=comments><p>x</p></section></article>"
    page = f"<html><body class='has-sidebar'><header>x</header><nav><ul><li>x</ul></nav><div class='cookie-notice'>x</div>" \
           f"<div class='layout with-sidebar'>{inside}</div><div role='complementary'>x</div><p>x</p><footer>x</footer></body></html>"
    assert text(page) == "T one two end"
    assert text(page.replace("article>", "main>")) == "T one two end"
    assert text("<div><p>body text</p></div><div id='sidebar'>x</div>") == "body text"


def test_names_of_a_topic_are_no_names_of_a_box():
    page = "<article><h1 id='cookie-recipes'>Cookies</h1><section id='search-algorithms'><p>Binary search.</p></section>" \
           "<div class='related-work'><p>Others did it.</p></div><div class='notice-board-history'>Boards.</div><h2 class='comments'>On comments</h2>" \
           "<p>So <math><mi>x</mi></math> is <object>a drawing</object>.</p><div class='comment-list item-3'>x</div><ul class='share-links'><li>x</ul></article>"
    assert text(page) == "Cookies Binary search. Others did it. Boards. On comments So x is a drawing."


def test_template_goes_and_copies_stay(spark):
    rows, want = [], {}
    for k in range(20):
        body = f"<p>Story {k} " + "word " * 20 + "</p><p>Shared words of a passage.</p>"
        rows.append((k, f"https://A.example/{k}", f"<body><div><b>Our site</b> since 1999</div><div>{body}</div><div><ul><li>Tip</li></ul></div>"))
        want[k] = f"Story {k} " + "word " * 20 + "Shared words of a passage."
    for k in range(20, 60):  # copies of one page, many times: not a template
        rows.append((k, "https://b.example/", "<body><div>First</div><div><p>Second</p></div>"))
        want[k] = "First Second"
    for k in range(60, 80):  # in an article a passage may recur, a generic box may not
        rows.append((k, "https://c.example/", f"<article><p>Tale {k} {'x ' * 30}</p><p>Again.</p><div>Read our other tales</div></article>"))
        want[k] = f"Tale {k} {'x ' * 30}Again."
    got = {r["page_id"]: r["text"] for r in S.extract(pages_of(spark, rows)).collect()}
    # outside an article nothing tells a recurring passage from the site's own: it goes
    want |= {k: want[k].removesuffix(" Shared words of a passage.") for k in range(20)}
    assert got == {k: " ".join(v.split()) for k, v in want.items()}


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "", ""), (2, "not a url", "<p>x</p>"), (2, "not a url", "<p>x</p>"), (3, None, "<article></article>"),
            (4, "http://[::1", "<p>" + "very long " * 50_000 + "</p>"), (5, "u", "\x00<p>é</p>")]
    got = S.extract(pages_of(spark, rows)).collect()
    assert sorted((-1 if r["page_id"] is None else r["page_id"], len(r["text"])) for r in got) == [
        (-1, 0), (1, 0), (2, 1), (2, 1), (3, 0), (4, 499_999), (5, 1 + 2)]
    assert S.extract(pages_of(spark, [])).count() == 0


def test_whole_table(spark):
    pages = {r["page_id"]: r["html"] for r in table(spark, SF01, "pages").collect()}
    for r in S.op3_site_templates(spark, SF01).collect():
        article = re.search(r"<article>(.*?)(</article>|\Z)", pages[r["page_id"]], re.S)[1]
        want = " ".join(html.unescape(re.sub("<[^>]*>", " ", article)).split())
        assert r["text"] == want and r["n_chars"] == len(want)


def test_equal_counts_on_a_small_and_a_large_host(spark):
    promo, rows, want = "<div><b>Read</b> our section on gardens</div>", [], {}
    for host, n in (("small.example", 20), ("large.example", 2000)):  # on each host 8 pages have the promo
        for k in range(n):
            story = f"Story {host} {k} " + "word " * 20
            rows.append((len(rows), f"https://{host}/{k}", f"<body>{promo if k < 8 else ''}<div><p>{story}</p></div>"))
            want[len(rows) - 1] = " ".join(story.split())
    got = {r["page_id"]: r["text"] for r in S.extract(pages_of(spark, rows)).collect()}
    assert got == want


def test_stub_page_loses_a_notice_longer_than_its_article(spark):
    notice = "<div><p>" + "All that stands here is shown as it was. " * 3 + "</p></div>"
    rows = [(k, f"https://h.example/{k}", f"<body><div><p>Story {k} {'word ' * 60}</p></div>{notice}") for k in range(8)]
    rows.append((8, "https://h.example/8", f"<body><div><p>Stub.</p></div>{notice}"))
    # pages that differ in a date alone: their common text is no template
    rows += [(k, "https://d.example/", f"<body><div><p>{'The text. ' * 9}</p></div><div>Day {k}</div>") for k in range(9, 20)]
    got = {r["page_id"]: r["text"] for r in S.extract(pages_of(spark, rows)).collect()}
    assert got == {k: " ".join(f"Story {k} {'word ' * 60}".split()) for k in range(8)} | {8: "Stub."} | {
        k: "The text. " * 9 + f"Day {k}" for k in range(9, 20)}


def test_teaser_articles_several_articles_and_no_article(spark):
    words = "word " * 40
    teasers = "".join(f"<article><h3>Tip {k}</h3><p>See this too.</p></article>" for k in range(3))
    rows, want = [], {}

    def add(host, page, text):
        rows.append((len(rows), f"https://{host}/{len(rows)}", page))
        want[len(rows) - 1] = " ".join(text.split())

    for k in range(8):  # the same teasers on every page: template, though they are article elements
        add("cards.example", f"<body><div><p>Story {k} {words}</p></div>{teasers}", f"Story {k} {words}")
        add("main.example", f"<body><main><p>Story {k} {words}</p>{teasers}</main><p>By us, {k}</p>", f"Story {k} {words}")
    add("other.example", f"<body><div><p>Story {words}</p></div>{teasers}",  # alone on its host: nothing is lost
        f"Story {words}" + " ".join(f"Tip {k} See this too." for k in range(3)))
    posts = "".join(f"<article><p>Post {k} {words}</p></article>" for k in range(3))
    add("posts.example", f"<body><p>All posts</p>{posts}", " ".join(f"Post {k} {words}" for k in range(3)))
    add("none.example", f"<body><p>Story {words}</p><p>and its end</p>", f"Story {words} and its end")
    for k in range(8):  # copies of an article in changing surroundings, and an article shorter than the template
        add("copies.example", f"<body><div>Day {k}</div><article><div>A part of it.</div><p>{words}</p></article>", f"A part of it. {words}")
        add("short.example", f"<body><article><p>Brief {k}.</p></article><div>One.</div><div>Two three four.</div><div>Five six.</div>", f"Brief {k}.")
    got = {r["page_id"]: r["text"] for r in S.extract(pages_of(spark, rows)).collect()}
    assert got == want
