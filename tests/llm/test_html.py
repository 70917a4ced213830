import html
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from corpusflow.llm import html_text as H

PAGES = "page_id long, url string, html string, text string"


def alone(page):
    """The main text of a page without neighbours."""
    lines = H.lines_of(page)
    return [lines[i][0] for i in H.kept_lines([r for _, r in lines], None, None)]


def test_markup_decides():
    page = """<html><head><title>T</title><script>var x='<p>no</p>'</script></head><body><header>Site</header><nav><ul><li>Menu</ul></nav>
    <div id="cookie-banner">Accept</div><main><h1>Head &amp; line</h1><header>By me</header><p>One<br>two  <b>th</b>ree<p>Next&nbsp;one <a href=x>link</a>.
    <aside>Side</aside><ul><li>a<li>b</ul><table><tr><td>1<td>2</table><div class="adBox ad">Buy</div><form><p>Mail</form><style>p{}</style><!-- <p>gone</p> -->
    <section class="comments"><article>Nice</article></section></main><p>Outside</p><footer>End</footer></body></html>"""
    assert alone(page) == ["Head & line", "By me", "One two three", "Next one link.", "a", "b", "1", "2"]


def test_names_of_wrappers_do_not_decide():
    text = alone
    article = "<article{}><h1>Head</h1><p>Body</p><div class='share'>Share</div></article>"
    for name in ("has-sidebar", "no-comments", "sidebar", "search", "post category-legal", "Comments"):
        assert text(f"<body><nav>Menu</nav><div class='{name}'><p>Out</p><div id=ad>{article.format('')}</div></div></body>") == ["Head", "Body"]
        assert text(f"<body><div class='{name}'><main><p>Body</p></main></div>") == ["Body"]
        assert text("<body>" + article.format(f" class='{name}'")) == ["Head", "Body"]
    assert text(f"<body><form action=x>{article.format('')}</form>") == ["Head", "Body"]
    assert text("<body><form id=aspnetForm><nav>Menu</nav><p>Body</p><form class=search><p>Find</p></form></form>") == ["Body"]
    assert text("<body><form><h1>Head</h1><p>Body</p></form>") == ["Head", "Body"]
    assert text("<div class='no-comments'><p>Body</p><div class='cookie-banner'>Accept</div><div id='comments'>Nice</div><form><p>Mail</p></form></div>") == ["Body"]
    assert text("<aside><article>Teaser</article></aside><main><p>Body</p><div class=comments><article>Nice</article></div></main>") == ["Body"]


def test_broken_markup():
    assert H.lines_of("") == [] and H.lines_of("plain &lt;text") == [("plain <text", H.OPEN_ROLE)]
    assert [x for x, _ in H.lines_of("<article><p>cut off &am")] == ["cut off &am"]
    assert [x for x, _ in H.lines_of("<p title='a>b'>in</p><p title=it's>x</p><div <p>y")][:1] == ["in"]
    H.lines_of("<" * 50_000 + "<a " * 20_000 + "'" * 1000)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_alignment_is_longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    got = H.aligned(a, b)
    assert len(got) == table[-1][-1]
    assert all(a[i] == b[j] for i, j in got) and got == sorted(got) and len({i for i, _ in got}) == len({j for _, j in got}) == len(got)


def test_shared_lines_go(spark):
    page = lambda k: f"<div>Welcome to our site, the best there is</div><p>Story {k} begins here and is told at length {k * 7}</p><p>It goes on for page {k} with many words {k * 11}</p><div>Imprint and more of our pages</div>"
    rows = [(k, f"http://a.org/news/{k:03}?x={k}", page(k), "old") for k in range(40)]
    rows += [(100, "http://b.org/1", page(100), None), (101, None, None, None), (102, "not a url", "", None), (103, "http://a.org/news/010?copy", page(10), None)]
    got = {r.page_id: r for r in H.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    assert len(got) == len(rows) and set(got[0].asDict()) == {"page_id", "url", "text"}
    for k in range(40):
        if k != 10:
            assert got[k].text.split("\n\n") == [f"Story {k} begins here and is told at length {k * 7}", f"It goes on for page {k} with many words {k * 11}"]
    assert "Story 10 " in got[10].text and "Story 10 " in got[103].text
    assert got[100].text.count("\n\n") == 3 and got[101].text == got[102].text == ""


def test_template_reaches_into_articles(spark):
    page = lambda k: f"<nav>Home of all</nav><article><p>Read our newsletter</p><p>Body {k} of the article is here, and it is long enough to tell it from others</p><p>Sentence all share</p><p>Last {k}</p></article>"
    rows = [(k, f"http://a.org/{k:03}", page(k), None) for k in range(9)]
    got = {r.page_id: r.text for r in H.extract_text(spark.createDataFrame(rows, PAGES)).collect()}
    for k in range(1, 8):
        assert got[k].split("\n\n") == [f"Body {k} of the article is here, and it is long enough to tell it from others", "Sentence all share", f"Last {k}"]


def test_runs_of_copies_have_other_neighbours(spark):
    page = lambda k: f"<div>The site's own menu of pages</div><p>Story {k} begins and is told at length {k * 7}, with all that belongs to it</p><p>End of {k}</p><div>Imprint of the site</div>"
    rows = [(k, f"http://a.org/{k:03}", page(k if k < 5 or k > 25 else 5), None) for k in range(30)]
    rows += [(100 + k, "http://a.org/004", page(4), None) for k in range(3)] + [(4, "http://a.org/004", page(4), None)]
    got = H.extract_text(spark.createDataFrame(rows, PAGES)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert "menu" not in r.text and "Imprint" not in r.text and "Story" in r.text and "End" in r.text


def test_text_is_the_same_however_partitioned(spark):
    stripped = "regexp_replace(html, '</?article>| class=\"[^\"]*\"', '')"
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").selectExpr("page_id", "url", f"CASE WHEN page_id % 2 = 0 THEN html ELSE {stripped} END AS html", "'' AS text")
    hosts = pages.selectExpr("page_id", "concat('http://one.org/', page_id % 50) AS url", "html", "text")
    for table in (pages, hosts):
        found = []
        for n in (1, 4, 61):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
            found.append(sorted((r.page_id, r.text) for r in H.extract_text(table.repartition(n)).collect()))
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert found[0] == found[1] == found[2]


def test_frames_go_without_article_and_class(spark):
    """Without marked articles and names, menus and footers go by their kind, and what pages of a host share by differencing."""
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()
    notice = "<div>This notice stands on every page</div>"
    plain = lambda h: re.sub(r' class="[^"]*"|</?article>', "", h).replace("<body>", "<body>" + notice)
    got = H.extract_text(spark.createDataFrame([(r.page_id, r.url, plain(r.html or ""), None) for r in rows], PAGES)).collect()
    frame = {r.page_id: [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.findall(r"(?s)<(?:nav|footer)\b.*?</(?:nav|footer)>", r.html)] for r in rows}
    host = lambda u: re.sub(r"^https?://([^/]*).*", r"\1", u)
    hosts = [host(r.url) for r in rows]
    for r in got:
        assert not any(len(x) > 40 and x in " ".join(r.text.split()) for x in frame[r.page_id])
    many = [r for r in got if hosts.count(host(r.url)) > 4]
    assert many and sum("This notice" in r.text for r in many) <= 0.1 * len(many)


def test_whole_articles_of_test_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = H.op5_html_text(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(?:>|\Z)", "", b)).split()) for b in re.split(r"</?(?:p|h1)>|<br>", article)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_empty_table(spark):
    assert H.extract_text(spark.createDataFrame([], PAGES)).collect() == []
