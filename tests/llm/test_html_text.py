import pytest

from souk.llm import html_text as H

ARTICLE = """<h1>Head &amp; line</h1><p>The first paragraph, with <b>bold</b> and <a href="x">a link</a>; it goes on and on, as they do.
<p>Second one:   white
 space &eacute; &#65;, line<br>break.<ul><li>one, two<li>three</ul><table><tr><td>cell<td>next</table>"""
WANT = "Head & line\n\nThe first paragraph, with bold and a link; it goes on and on, as they do.\n\nSecond one: white space é A, line break.\n\none, two\n\nthree\n\ncell\n\nnext"
AROUND = [
    ("<nav><ul><li><a href=/>Home</a><li><a href=/b>News, more</a></ul></nav>", "<footer>&copy; all rights.</footer>"),
    ("<header><h1>The site</h1><p>Its motto, long and proud, with punctuation.</p></header>", "<aside><p>See also, all of these.</p></aside>"),
    ('<div class="cookie-notice">We use cookies, as all do.</div>', '<section id="comments"><h2>Comments</h2><p>I liked it, a lot, really.</p></section>'),
    ('<div class="ad-slot">Buy, now!</div><div role="banner">x, y.</div>', '<form action=x><p>Your name, please.</p><input><button>Send</button></form>'),
    ("<script>var t = '<p>no, no.</p>';</script><style>p{}</style><!-- <p>hidden, too.</p> -->", '<div hidden>later, maybe.</div><div style="display: none">x, y.</div>'),
    ('<div class="sidebarLeft"><p>Links, and more.</p></div>', '<div class="share social">Tell, all.</div>'),
]


@pytest.mark.parametrize(("before", "after"), AROUND)
@pytest.mark.parametrize("holder", ["article", 'div class="content"'])
def test_furniture_goes_and_the_article_stays(before, after, holder):
    page = f"<!DOCTYPE html><html><head><title>T, t.</title></head><body>{before}<{holder}>{ARTICLE}</{holder.split()[0]}>{after}</body></html>"
    assert H.main_text(page) == WANT


def test_defined_cases():
    assert H.main_text(None) == H.main_text("") == H.main_text("<p") == H.main_text("<script>x") == ""
    assert H.main_text("plain a < b &am text") == "plain a < b &am text"
    assert H.main_text("<article><p>cut off &amp; <b") == "cut off &"
    deep = "<div>" * 50_000 + "x, y." + "</div>" * 50_000
    assert H.main_text(deep) == "x, y."
    assert H.main_text("<p>" + "word, " * 200_000) == ("word, " * 200_000).strip()


def test_path_ratios_favour_text_with_punctuation():
    nodes = H.text_nodes("<body><ul><li>a<li>b<li>c<li>d</ul><div><p>A long sentence, with a comma and an end.<p>And another one, just as long.</div>")
    s = H.content_scores(nodes)
    assert s[-1] > 5 * s[0]


def test_query_rows(spark):
    t = spark.createDataFrame([(1, "u", "<p>a, b.</p>"), (1, "u", "<p>a, b.</p>"), (2, None, None), (None, "v", "")], "page_id long, url string, html string")
    out = H.extract(t).select("row.page_id", "main_text").collect()
    assert sorted(map(str, out)) == sorted(map(str, [(1, "a, b."), (1, "a, b."), (2, ""), (None, "")])) or len(out) == 4
    assert H.extract(t.limit(0)).count() == 0


LONG = "".join(f"<p>Paragraph number {k} of the story, which goes on, as stories do; it has an end.</p>" for k in range(6))
TEXT = [f"Paragraph number {k} of the story, which goes on, as stories do; it has an end." for k in range(6)]
MENU = "".join(f"<li><a href=/{k}>Item {k}</a></li>" for k in range(8))


def lines(body):
    return H.main_text(f"<html><head><title>t</title></head><body>{body}</body></html>").split("\n\n")


def test_a_wrapper_named_after_furniture_loses_nothing():
    assert lines(f'<div class="has-sidebar"><div>{LONG}</div></div>') == TEXT
    assert lines(f'<div class="page no-comments"><div class="widget-free"><h1>Head</h1>{LONG}</div><div class="comments"><p>Nice, really, yes.</p></div></div>') == ["Head", *TEXT]


@pytest.mark.parametrize("holder", ["div", "main", "body"])
def test_unknown_class_names(holder):
    inner = (f'<ul class="css-1ab2">{MENU}</ul><div class="x9"><a href=/>Home</a> <a href=/b>About us</a></div>'
             f'<h1>Head</h1>{LONG}<div class="css-7">Accept all</div>')
    assert lines(inner if holder == "body" else f"<{holder}>{inner}</{holder}>") == ["Head", *TEXT]
    with_comments = inner + '<div class="discussion"><p>I liked it, very much, as I said.</p><p>Me too, and more.</p></div>'
    assert lines(with_comments if holder == "body" else f"<{holder}>{with_comments}</{holder}>") == ["Head", *TEXT]


def test_linked_headlines_sources_and_marked_headings_stay():
    sources = "<p><a href=/s>The source, a page elsewhere</a></p><ul><li><a href=/1>First source</a></li><li><a href=/2>Second</a></li></ul>"
    got = lines(f'<nav>{MENU}</nav><article><h1><a href=/>Linked head</a></h1>{LONG}<h2 id="market-share">Market share</h2>'
                f'<p class="search-results">Found, at last.</p>{sources}</article>')
    assert got == ["Linked head", *TEXT, "Market share", "Found, at last.", "The source, a page elsewhere", "First source", "Second"]


def test_short_blocks_between_content_stay():
    got = lines(f"<div><h1>H</h1>{LONG}<h3>Mid</h3><ul><li>one<li>two</ul><blockquote>short</blockquote>{LONG}</div><div>Ads, all day.</div>")
    assert got == ["H", *TEXT, "Mid", "one", "two", "short", *TEXT]


def test_a_headline_before_the_body():
    assert lines(f'<div class="top"><h1>Head</h1></div><div class="b"><div>{LONG}</div></div>') == ["Head", *TEXT]


def test_the_scores_decide(monkeypatch):
    page = f'<div><div class="x1">Cheap, fine</div><h1>Head</h1>{LONG}<div class="x2">Yes</div></div>'
    assert lines(page) == ["Head", *TEXT]
    monkeypatch.setattr(H, "content_scores", lambda nodes: H.np.ones(len(nodes)))
    assert lines(page) == ["Cheap, fine", "Head", *TEXT, "Yes"]


def test_given_pages_keep_their_article(spark):
    import html as h
    import re
    for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect():
        body = re.search(r"<article>(.*)</article>", r["html"], re.S)[1]
        want = [" ".join(h.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", x))).split()) for x in re.split(r"</?(?:p|h1)>", body)]
        assert H.main_text(r["html"]).split("\n\n") == [w for w in want if w]
