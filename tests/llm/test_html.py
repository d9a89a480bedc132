import html
import re

import pytest

from docspark.llm import html_text as H

ARTICLE = "<p>First paragraph, long enough, of the story. It goes on.</p><p>Second &amp; last, with <b>bold</b>ness.</p>"
TEXT = "First paragraph, long enough, of the story. It goes on. Second & last, with boldness."


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<body><header><h1>Site</h1><p>Motto, of the site.</p></header><article><h1>T</h1>{ARTICLE}</article></body>", f"T {TEXT}"),
        (f"<nav><ul><li><a href=/>Home</a></ul></nav><div class=post>{ARTICLE}</div><footer>&copy; me</footer>", TEXT),
        (f"<div class='content-with-sidebar'><div>{ARTICLE}</div><div class=sidebar><p>About, us. And more.</p></div></div>", TEXT),
        (f"<main>{ARTICLE}<section id=comments><article class=comment><p>I think, it is good, really.</p></article></section></main>", TEXT),
        (f"<article>{ARTICLE}<form><p>Your name, please.</p></form><aside>More, here.</aside><div class='ad banner'>Buy, now!</div></article>", TEXT),
        (f"<div role=alert>We use cookies, all the time.</div><article>{ARTICLE}<script>var a='</p>x'</script></article>", TEXT),
        (f"<article>{ARTICLE}<p hidden>secret, text</p><!-- no <p>comment</p> --></article>", TEXT),
        ("<article><p>a  b\n\tc<br>d<p>e&nbsp;f</article>", "a b c d e f"),
        ("<article><p>x &lt;b&gt; y</p></article>", "x <b> y"),
        ("plain text, no tags", "plain text, no tags"),
        ("<p title=\"a > b\" class='x'>in, here</p>", "in, here"),
        ("<p>x <a " + "\"" * 61, 'x <a ' + '"' * 61),
        ("<p>a < b and c<", "a < b and c<"),
        ("<script>only this", ""),
        ("", ""),
        (None, ""),
    ],
)
def test_main_text(page, text):
    assert H.main_text(page) == text


def test_pages_table(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    got = {r["page_id"]: r for r in H.extract(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", inner)).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_odd_rows(spark):
    rows = [(1, "u", None), (1, "u", None), (None, None, "<p>" * 5000 + "deep"), (2, None, "<div>" * 3000 + "x, y." + "</p>" * 10), (3, "", "<p>a" * 50_000)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = H.extract(df.withColumn("text", df["url"])).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, 4, 5, 99_999]
    assert H.extract(df.limit(0)).count() == 0


LINKS = "<ul><li><a href=/1>Another story, of today</a></li><li><a href=/2>And one more</a></li></ul>"
CARD = "<article><h3><a href=/c>Teaser</a></h3><p>A card, of words: with marks, so, it passes.</p></article>"


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<main><article>{ARTICLE}{ARTICLE}{ARTICLE}{ARTICLE}</article><article><h2>Part</h2>{ARTICLE}</article></main>", " ".join([TEXT] * 4 + ["Part", TEXT])),
        (f"<body><article>{ARTICLE}</article><article>{ARTICLE}</article><div><a href=/i>Imprint</a></div></body>", f"{TEXT} {TEXT}"),
        (f"<main><p>A lead that sums it up, in full.</p><article>{ARTICLE}{ARTICLE}</article></main>", f"A lead that sums it up, in full. {TEXT} {TEXT}"),
        (f"<main><h1>T</h1><div>{ARTICLE}{ARTICLE}</div>{CARD}</main>", f"T {TEXT} {TEXT} A card, of words: with marks, so, it passes."),
        (f"<article>{ARTICLE}{LINKS}</article>", TEXT),
    ],
)
def test_paths_choose_on_pages_with_articles(page, text):
    assert H.main_text(page) == text


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='layout sidebar-right'><div>{ARTICLE}</div></div>",
        f"<div id='page' class='header-fixed'><article>{ARTICLE}</article></div>",
        f"<article class='post category-social'>{ARTICLE}</article>",
        f"<main><article class='post tag-newsletter comment-status-open'>{ARTICLE}</article></main>",
        f"<div class='login-required'><p>{'Third, of many. ' * 9}</p></div><div class=ad>Buy, now!</div>",
        f"<div class=widget>{ARTICLE}</div>",
        f"<article>{ARTICLE}</article><div id=comments class=comments-area><article class=comment-body><p>{'I think, it is good, really. ' * 20}</p></article></div>",
        f"<article>{ARTICLE}</article><div class=comments><p>{'I think, it is good, really. ' * 20}</p></div>",
        f"<article>{ARTICLE}<p><span class='ad'>Buy, now!</span></p></article>",
    ],
)
def test_names_are_only_hints(page):
    want = " ".join(["Third, of many."] * 9) if "Third" in page else TEXT
    assert H.main_text(page) == want


MENU = "<ul><li><a href=/>Home</a></li><li><a href=/about>About us</a></li></ul>"


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>T</title><meta charset=utf-8><body><article>{ARTICLE}</article>",
        f"<html><head><title>T</title>{ARTICLE}",
        f"<head><link rel=x href=y><script>1</script><div>{ARTICLE}</div>",
        f"<body><form action=/ method=post><div id=top><a href=/>Home</a></div><article>{ARTICLE}</article><input type=hidden></form></body>",
        f"<body><form id=aspnetForm><div class=page><div>{ARTICLE}</div></div></form></body>",
        f"<body><form>{MENU}<main>{ARTICLE}</main><label>Search, here.</label><button>Go</button></form></body>",
        f"<body><nav>{MENU}<article>{ARTICLE}</article>",
        f"<body><nav>{MENU}<main>{ARTICLE}</main></nav>",
        f"<body><nav>{MENU}<div class=post>{ARTICLE}</div>",
        f"<body><header><h2>Site</h2><p>Motto.</p><article>{ARTICLE}</article>",
        f"<body><aside>{MENU}<p>Side, note.</p></aside><div>{ARTICLE}</div>",
        f"<body><div class=wrap><aside><article><p>Teaser, short.</p></article></aside><article>{ARTICLE}</article></div>",
        f"<body><object><p>Your browser, is old.</p></object><section>{ARTICLE}</section>",
        f"<body><table><tr><td>{MENU}</td><td>{ARTICLE}</td></tr></table>",
        f"<body><center><table><tr><td><font size=2>{ARTICLE}</font></td></tr></table></center>",
        f"<BODY><DIV ID=main>{ARTICLE.replace('<p>', '<P>').replace('</p>', '')}</DIV>{MENU}",
        f"<div>{MENU}</div><div><div><div>{ARTICLE}</div></div></div><footer><p>All, rights.</p></footer>",
        f"<section><header><h3>Nothing</h3></header></section><section>{ARTICLE}</section><form><p>Subscribe, now.</p><input></form>",
        f"<div>{ARTICLE}<form><label>Name, please</label><textarea>x, y</textarea><p>Send, it.</p></form></div>",
        f"<div role=main>{ARTICLE}</div><div role=complementary><p>More, to read. And more.</p></div>",
    ],
)
def test_no_layout_loses_its_article(page):
    got = H.main_text(page)
    assert TEXT in got
    for other in ("Motto", "Teaser", "Subscribe", "Send, it", "All, rights", "Search, here", "Side, note", "browser"):
        assert other not in got
