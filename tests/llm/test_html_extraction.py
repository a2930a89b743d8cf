from __future__ import annotations

import html
import re

import pytest

from skyledger.llm import html_extraction as hx
from skyledger.llm import queries

BODY = "".join(f"<p>Paragraph {k} of the article has enough words in it to count.</p>" for k in range(4))
TEXT = "\n".join(f"Paragraph {k} of the article has enough words in it to count." for k in range(4))


def page(main, before="", after=""):
    return f"<html><head><title>T</title><style>p{{}}</style></head><body>{before}{main}{after}</body></html>"


@pytest.mark.parametrize(
    "before",
    [
        "<nav><ul><li><a href='/'>Home page of the site</a></li></ul></nav>", "<header><h1>Site name</h1></header>", "<aside>See also these</aside>",
        "<div class='cookie-notice'>We use cookies</div>", "<div class='ad'>Buy this now</div>", "<form><p>Your name</p><input></form>",
        "<script>var x = '<p>no</p>';</script>", "<!-- <p>hidden</p> -->", "<div id='sidebar'><p>More of this</p></div>",
        "<div class='comments'><div class='comment'><p>I think that this is a very long reader comment.</p></div></div>",
        "<section class='related-posts'><p>Related text here</p></section>", "<footer><p>Imprint</p></footer>", "<textarea>typed text</textarea>",
    ],
)
def test_what_is_no_article(before):
    for main in (f"<article>{BODY}</article>", f"<div class='post-12'>{BODY}</div>", f"<main><div><div class='content'>{BODY}</div></div></main>"):
        assert hx.extract(page(main, before), []) == TEXT
        assert hx.extract(page(main, "", before), []) == TEXT


@pytest.mark.parametrize(
    "wrapper",
    ["div class='content with-sidebar'", "div id='page' class='no-sidebar'", "div class='site header-fixed'", "div class='has-comments'",
     "div class='widget'", "form id='page'", "div class='page-header'", "div class='comments'"],
)
def test_a_wrapper_with_the_article_stays(wrapper):
    inside = f"<div class='post'>{BODY}</div><div id='sidebar'><p>More of this</p></div><footer>Imprint</footer>"
    tag = wrapper.split()[0]
    source = page(f"<{wrapper}>{inside}</{tag}>", "<nav>Home</nav>")
    if wrapper == "div class='comments'":
        source = source.replace("<div id='sidebar'><p>More of this</p></div>", "")
    assert hx.extract(source, []) == TEXT


def test_long_comments_beside_a_short_article_go():
    many = "<div class='comments-area'>" + "<p>This is a reader's comment on it.</p>" * 90 + "</div>"
    assert hx.extract(page(f"<div class='post'>{BODY}</div>", "", many), []) == TEXT


@pytest.mark.parametrize("raw", ["<svg class='x'/>", "<video src='a.mp4' />", "<object data='a'/>", "<svg>", "<video src='a'>", "<iframe src='a'/>"])
def test_what_follows_a_self_closed_element_stays(raw):
    assert hx.extract(page(f"<article>{raw}{BODY}</article>"), []) == TEXT
    closed = f"<{raw[1:].split()[0].strip('/>')} class='y'></{raw[1:].split()[0].strip('/>')}>"
    if raw.endswith("/>"):
        assert hx.extract(page(f"<article>{raw}{BODY}{closed}</article>"), []) == TEXT


def test_headline_and_inner_parts():
    source = page(f"<article><header><h1>A  headline</h1></header><div class='body'>{BODY}<ul><li>One</li><li>Two &amp; three</li></ul></div><div class='ads'>Ad</div></article>")
    assert hx.extract(source, []) == f"A headline\n{TEXT}\nOne\nTwo & three"


SECTION = "".join(f"<p>Sentence {k} of the second section, which is as long.</p>" for k in range(5))
SECTION_TEXT = "\n".join(f"Sentence {k} of the second section, which is as long." for k in range(5))


@pytest.mark.parametrize("around", ["article", "main", "div class='post'"])
def test_articles_in_several_sections_are_whole(around):
    tag = around.split()[0]
    source = page(f"<{around}><section class='intro'>{BODY}</section><section class='analysis'>{SECTION}</section></{tag}>", "<nav>Home</nav>")
    assert hx.extract(source, []) == f"{TEXT}\n{SECTION_TEXT}"
    bare = page(f"<section class='intro'>{BODY}</section><section class='analysis'>{SECTION}</section>", "<nav>Home</nav>")
    assert hx.extract(bare, []) == f"{TEXT}\n{SECTION_TEXT}"
    two = page(f"<article class='a'>{BODY}</article><article class='b'>{SECTION}</article>", "<nav>Home</nav>")
    assert hx.extract(two, []) == f"{TEXT}\n{SECTION_TEXT}"
    links = "<div class='more'>" + "<p><a href='/'>Another page that is linked from here</a></p>" * 9 + "</div>"
    assert hx.extract(page(f"<div class='page'><div class='post'>{BODY}</div>{links}</div>"), []) == TEXT


def test_list_heavy_pages_keep_heading_and_paragraphs():
    items = "".join(f"<li>Item {k} of a long list on this page</li>" for k in range(20))
    source = page(f"<div class='content'><h1>Heading</h1>{BODY}<ul>{items}</ul></div>")
    assert hx.extract(source, []) == "\n".join(["Heading", TEXT, *(f"Item {k} of a long list on this page" for k in range(20))])


def test_pages_of_a_hosts_second_template(spark):
    rows = [(k, "http://h.org/", page(f"<div class='post'>{BODY}</div>")) for k in range(12)]
    rows += [(100 + k, "http://h.org/", page(f"<div class='long'>{BODY * 9}</div>", "<div class='post'><p>A short teaser.</p></div>")) for k in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r._text for r in hx.extract_main_text(pages, ["page_id"]).collect()}
    assert all(t == (TEXT if k < 100 else "\n".join([TEXT] * 9)) for k, t in found.items())


def test_broken_markup_and_references():
    source = "<article><h1>T &lt;b&gt; &#228;&copy</h1><p><b>Bold start.<br><p>Next&nbsp; one a<br>b <a href=\"x>y\">link</a> c<p>Last 1 < 2 words"
    assert hx.extract(source, []) == "T <b> ä©\nBold start.\nNext one a b link c\nLast 1 < 2 words"
    assert hx.extract("<div>" * 30_000 + "deep" + "<a href='" * 300, []).startswith("deep")
    assert hx.extract("<script>never closed <p>text</p>", []) == ""
    assert hx.extract("no markup at all", []) == "no markup at all"


def test_consensus_decides_for_pages_that_look_different(spark):
    """One page has more text beside the article than in it; its host's other pages say where the article is."""
    long = "<div class='extra'>" + "<p>" + "words that belong to something else. " * 40 + "</p></div>"
    rows = [(k, f"http://h.org/{k}", page(f"<div class='post-{k}'>{BODY}</div>", "", "<div class='extra'><p>x</p></div>")) for k in range(9)]
    rows.append((9, "http://h.org/9", page(f"<div class='post-9'>{BODY}</div>", "", long)))
    rows.append((10, "http://other.org/9", page(f"<div class='post-9'>{BODY}</div>", "", long)))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r._text for r in hx.extract_main_text(pages, ["page_id"]).collect()}
    assert all(found[k] == TEXT for k in range(10))
    assert found[10].startswith("words that belong")
    assert hx.winning_paths(pages.selectExpr("'h' AS _host", "html AS _html")).first()._winners[0] == "html/body/div.post-#"


def test_given_pages(spark, sf_dir):
    """A plain cut of the article element, for pages of the known template."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op4_html_extraction(spark, sf_dir).collect():
        inside = re.search("<article>(.*?)</article>", pages[r.page_id], re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", lambda m: " " if m[0] == "<br>" else "", b)).split()) for b in re.split("</?(?:p|h1)>", inside)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    from pyspark.sql import functions as F

    rows = [(1, None, None), (2, "x", ""), (None, "http://h.org", page(f"<article>{BODY}</article>")), (4, None, "<p>" + "long " * 100_000), (4, None, "<p>twice</p>"), (4, None, "<p>twice</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("_host2", "path", "votes", "_text")})
    found = sorted(((r.page_id or 0, r._text) for r in hx.extract_main_text(pages, ["page_id"]).collect()))
    assert found == [(0, TEXT), (1, ""), (2, ""), (4, ("long " * 100_000).strip()), (4, "twice"), (4, "twice")]
    assert hx.extract_main_text(pages.limit(0), ["page_id"]).collect() == []


@pytest.mark.parametrize("quote", ["'", '"'])
@pytest.mark.parametrize("length", [3, 5000, 200_000])
def test_an_attribute_of_any_length_is_no_text(quote, length):
    long = f"<div title={quote}{'x' * length}> leak <p>leak</p>{quote} class='c'>"
    assert hx.extract(page(f"<article>{long}{BODY}</div></article>"), []) == TEXT


def test_broken_quotes_do_not_take_long():
    tags = "<div title='never closed><p>word</p>" * 20_000 + '<a title="open>'
    assert "word" in hx.extract(page(f"<article>{tags}</article>"), [])


def test_the_headline_beside_the_text_and_links_stays():
    links = "<ul>" + "".join(f"<li><a href='/{k}'>One more story to read number {k}</a></li>" for k in range(12)) + "</ul>"
    for source in (
        page(f"<div class='top'><h1>The headline</h1></div>{links}<div class='body'>{BODY}</div>"),
        page(f"<div class='story'><div class='title'><h1>The headline</h1></div>{links}<div class='body'>{BODY}</div>{links}</div>"),
    ):
        assert hx.extract(source, []) == f"The headline\n{TEXT}"
    own = page(f"<div class='top'><h1>Name of the site</h1></div><article><h1>The headline</h1>{BODY}</article>")
    assert hx.extract(own, []) == f"The headline\n{TEXT}"


def test_reviews_and_the_like_go():
    for name in ("user-reviews", "responses", "discussion", "reader feedback"):
        after = f"<div class='{name}'><p>I have read it twice and liked it.</p></div>"
        assert hx.extract(page(f"<div class='post'>{BODY}{after}</div>"), []) == TEXT
    assert hx.extract(page(f"<div class='review'>{BODY}</div>"), []) == TEXT


def test_a_page_of_notices_has_no_text():
    assert hx.extract(page("<div class='cookie-banner'>We use cookies</div>"), []) == ""
    assert hx.extract(page("<div class='cookie-banner'>We use cookies</div><div class='newsletter'><p>Write to us</p></div>"), []) == ""


def plain_text(source, tag, name):
    """Blocks inside the one element of this class, cut out by a regular expression and parted at tags."""
    inside = re.search(rf"<{tag} class='{name}'>(.*?)</{tag}><!--end-->", source, re.S)[1]
    return "\n".join(" ".join(html.unescape(t).split()) for t in re.split(r"<[^>]+>", inside) if t.strip())


@pytest.mark.parametrize("tag, name", [("div", "post"), ("section", "story text"), ("main", "cell")])
def test_unlike_templates_agree_with_a_plain_cut(tag, name):
    """Three templates whose article is known by one class, each on a host of its own."""
    frame = {
        "div": "<div class='menu'><a href='/'>Home</a></div>{}<div class='footer'>End</div>",
        "section": "<header><h2>Site</h2></header><nav>Home</nav>{}<aside>More</aside>",
        "main": "<div><ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li></ul></div><div class='wrap'>{}</div>",
    }[tag]
    pages = [page(frame.format(f"<{tag} class='{name}'>" + "".join(f"<p>Story {k} has part {j} &amp; more words in its text.</p>" for j in range(3 + k)) + f"</{tag}><!--end-->")) for k in range(5)]
    winners = [hx.best_container(hx.parse(p)) for p in pages]
    assert len(set(winners)) == 1
    for p in pages:
        assert hx.extract(p, winners[:1]) == plain_text(p, tag, name)


def test_clashing_columns(spark):
    from pyspark.sql import functions as F

    names = ["_host", "_html", "_winners", "_keep"]
    rows = spark.createDataFrame([(1, "http://a.org/", page(f"<div class='post'>{BODY}</div>"))], "page_id long, url string, html string")
    rows = rows.withColumns({name: F.lit("clash") for name in [*names, "_text"]})
    row = hx.extract_main_text(rows, ["page_id", *names, "_text"]).first()
    assert all(row[name] == "clash" for name in names) and row._text == TEXT
    assert hx.extract_main_text(rows.limit(0), ["page_id", *names]).collect() == []
