import pytest

from registrar_feeds.llm import html_text as H

PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "<p>x</p>";</script></head><body class="has-sidebar">
<header><h1>Site</h1><a href=x>Home</a></header><div class="cookie-notice">We use cookies</div>
<div id=content><h2>Title &amp; more</h2><p>First   paragraph with a <a href=y>link</a> in it
and enough words&nbsp;to weigh.</p><p>Second.</p><div class="ads">Buy now</div><p>Third paragraph<br>goes on.</p></div>
<aside>Side</aside><section class="comments"><article class=comment><p>I agree with every single word of it</p></article></section>
<form>Name <input></form><footer>c 2020</footer>"""


def test_page_without_article():
    assert H.main_text(PAGE) == ("Title & more\n\nFirst paragraph with a link in it and enough words to weigh.\n\n"
                                 "Second.\n\nThird paragraph goes on.")


def test_article_keeps_all_its_blocks():
    page = ("<nav><ul><li><a>A</a></li></ul></nav><article><h1>Head</h1><p>x<p>" + "long text " * 30
            + "<aside>no</aside><p>y</p>" + "<div></div>" * 20 + "<p>z</p></article><footer>" + "foot " * 99 + "</footer>")
    assert H.main_text(page) == "Head\n\nx\n\n" + ("long text " * 30).strip() + "\n\ny\n\nz"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("<p", ""), ("plain  text", "plain text"), ("<script>x", ""), ("a < b & c", "a < b & c"),
    ("<!-- a --><p>b<!-- c", "b"), ("<div class=ad>x<article>y</article></div>", "y"), ("<article><p>a &amp b &am", "a & b &am"),
    ("<article hidden><p>a</p></article><main>b</main>", "b"), ("<p>a</p><p style='display: none'>b</p>", "a"),
    ("<nav>menu", ""), ("<nav>menu<article>text</article>", "text"), ("<p title='>'>x</p>", "x"), ("<p title='x>y</p>", "y"),
])
def test_small_pages(page, text):
    assert H.main_text(page) == text


def test_stretches_lie_between_surge_and_dive():
    assert H.stretches([0, 0, 5, 0, 9, 0, 0, 0, 4, 0]) == [(2, 5), (8, 9)]
    assert H.stretches([]) == [] and H.stretches([0, 0]) == []


def test_rows(spark):
    rows = [(1, "u", PAGE, 1), (1, "u", PAGE, 1), (None, None, None, None), (2, None, "", 2), (3, "v", "<p>" + "w " * 200_000, 3)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {(r["page_id"], len(r["text"])) for r in H.extract(df).collect()}
    assert got == {(1, len(H.main_text(PAGE))), (None, 0), (2, 0), (3, 399_999)}
    assert H.extract(df.limit(0)).count() == 0


@pytest.mark.parametrize("page,text", [
    ('<article><p>a<p class="ad">buy<p>b</p><p>c</p></article>', "a b c"),
    ('<article><p>a<p class="ad">buy <b>now<div>b</div>c</article><p>d', "a b c"),
    ("<article><ul><li>a<li class=ad>buy<li>b</ul><p>c</article>", "a b c"),
    ("<article><ul><li>a<ul><li>b<li class=ad>buy</ul><li>c</ul></article>", "a b c"),
    ("<article><dl><dt>a<dd class=ad>buy<dt>b<dd>c</dl>d</article>", "a b c d"),
    ("<article><dl><dt class=ad>buy<dd>b</dl>c</article>", "b c"),
    ("<article><table><tr><td>a<td class=ad>buy<td>b<tr class=ad><td>buy<td>it<tr><td>c</table>d</article>", "a b c d"),
    ("<article><table><tr><th class=ad>buy<td><p>b<tbody class=ad><tr><td>buy<tbody><tr><td>c</table>d</article>", "b c d"),
    ("<article><table><tr><td class=ad>buy<table><tr><td>it</table>now<td>b</table>c</article>", "b c"),
    ("<article>a<select><option>x<option>y</select>b<datalist><option>x</datalist><p>c</article>", "a b c"),
    ("<article><p>a<span class=ad>buy</p><p>b</article>", "a b"),
    ("<article><p>a</p><div class=ad>buy<p>x</p></article><main>b</main>", "a b"),
    ("<article><p>a<table><tr><td>b<td class=ad>buy</article><main>c</main>", "a b c"),
    ("<article><b><p class=ad>buy</b> it</p><p>b</article>", "b"),
    ("<div><article><p>a</div><p>b</p></article>", "a b"),
])
def test_optional_end_tags(page, text):
    assert H.main_text(page).split() == text.split()


@pytest.mark.parametrize("page", [
    "<p><a name=x>Start<p>{0}<p>{0}", "<div><a name=x>Start</div><p>{0}</p><div>{0}</div>", "<body><a name=x>Start<p>{0}</p>{0}",
    "<p>{0} <a href=x>Start <a href=y>and on</a> {0}</p>", "<ul><li><a href=x>Start<li>{0}</ul><p>{0}",
])
def test_open_links_end(page):
    words = "words that weigh " * 9
    assert H.main_text(page.format(words)).count("words that weigh") == 18


def test_deep_and_crossing_tags_end_in_time():
    deep = "<p><button>" + "<div><span>" * 20_000 + "</i></p>" * 20_000 + "</button><p>end"
    assert H.main_text(deep) == "end"
    assert H.main_text("<p>" + "<b><p>x" * 20_000).count("x") == 20_000


LEAD, BODY, END = "lead " * 60, "body " * 1000, "closing " * 20
TOC = "<ul><li><a href=1>One</a></li><li><a href=2>Two</a></li><li><a href=3>Three</a></li></ul>"
GAP = "<div class=ad>buy</div>" * 3


@pytest.mark.parametrize("page", [
    f"<div id=content><p>{LEAD}</p>{TOC}<p>{BODY}</p>{GAP}<p>{END}</p></div>",
    f"<p>{LEAD}{TOC}<p>{BODY}{GAP}<p>{END}",
    f"<div><section><p>{LEAD}</section>{TOC}<section><p>{BODY}</section>{GAP}<section><p>{END}</section></div>",
])
def test_light_stretches_of_the_main_element_stay(page):
    assert H.main_text(page).split() == (LEAD + BODY + END).split()


def test_paragraphs_of_links_stay_in_the_text():
    links = "<p>See <a href=x>the first long reference</a> and <a href=y>the second long reference</a></p>"
    see = "See the first long reference and the second long reference"
    for page in (f"<div><p>{LEAD}</p>{links}<p>{LEAD}</p></div>", f"<article><p>{LEAD}</p>{links}<p>{LEAD}</p></article>"):
        assert H.main_text(page) == f"{LEAD.strip()}\n\n{see}\n\n{LEAD.strip()}"
    assert H.main_text(f"<div><p>{LEAD}</p>{links}</div>{TOC}") == f"{LEAD.strip()}\n\n{see}"
    menu = "<p><a href=x>Home</a> | <a href=y>About</a></p>"
    assert H.main_text(f"<div>{menu}<p>{LEAD}</p></div>") == LEAD.strip()


def test_articles_beside_a_heavier_body():
    card = "<article><h3>Card</h3><p>teaser</p></article>"
    for page in (f"<div id=content><p>{LEAD}</p><p>{BODY}</p></div><aside>{card * 3}</aside>",
                 f"<div class=related-box>{card * 3}</div><div id=content><p>{LEAD}</p><p>{BODY}</p></div>"):
        assert H.main_text(page).split() == (LEAD + BODY).split()
    page = f"<div id=content><p>{LEAD}</p><p>{BODY}</p></div>{card * 3}"
    assert H.main_text(page).split()[:1060] == (LEAD + BODY).split()
    assert H.main_text(f"<div><p>{LEAD}</p></div><article><p>{BODY}</p></article>").split() == BODY.split()
    assert H.main_text(f"<nav>menu<article>card</article></nav><div><p>{BODY}</p></div>").split() == BODY.split()


@pytest.mark.parametrize("element", [
    '<section id="related-work">', '<section id="search-methods">', '<h2 id="comments-on-the-results">', '<p class="alert">',
    '<section id="search">', '<div class="section" id="navigation">', '<div id="sharing-of-results">', '<p class="social-theory">',
    '<span class="token comment">', '<span class="hljs-comment">', '<p role="alert">', '<div class="login-free">', '<p id=cookie-law>',
])
def test_names_of_text_inside_an_article(element):
    name = element[1:].split()[0]
    assert H.main_text(f"<article><p>a</p>{element}b</{name.strip('>')}><p>c</p></article>").split() == ["a", "b", "c"]


@pytest.mark.parametrize("element", [
    '<div class="ad">', '<p class="box ads">', '<div id=comments>', '<li class="comment even">', '<div role=navigation>',
    '<section class=newsletter>', '<section class="comments" id=x>', '<p hidden>', '<div class="wide Advert">',
])
def test_names_of_no_text_inside_an_article(element):
    name = element[1:].split()[0]
    assert H.main_text(f"<article><p>a</p>{element}b</{name}><p>c</p></article>").split() == ["a", "c"]


def test_names_elsewhere():
    assert H.main_text('<h2 id="comments-on-the-results">a</h2><section id="related-work"><p>b</p></section>').split() == ["a", "b"]
    assert H.main_text('<p>a</p><div id="cookie-banner">x</div><div class="related-posts">y</div>') == "a"
    assert H.main_text('<article id="search-methods" class="post share-enabled"><p>a</p></article><p>x') == "a"
    assert H.main_text('<article class="post comment"><p>x</p></article><main>a</main>') == "a"


WRAPS = ["<div class='site-content no-sidebar'>{}</div>", "<div class='main with-sidebar'>{}</div>", "<div class='page has-banner'>{}</div>",
         "<div class='social-science'>{}</div>", "<form id='aspnetForm'>{}</form>", "<div id=page><form><div>{}</div></form></div>",
         "<article>{}</article>", "<main>{}</main>", "<div id=content>{}</div>", "<div class='search-page'><article>{}</article></div>"]
NOISE = ["<div class='ad-slot'>Buy this today</div>", "<div class='cookie-notice'>We use cookies</div>", "<div class=notice>Please note</div>",
         "<div class=related>More to read</div>", "<div class='comments-area'><p>I agree with it</p></div>",
         "<ol class='comment-list'><li>First of all</ol>", "<div class=share>Tell others</div>", "<div class='sidebar-widget'>Latest</div>"]


def naive(page):
    """The paragraphs of the made pages: all that these pages mean as text stands in <p class=t>."""
    import re
    return "\n\n".join(re.findall("<p class=t>(.*?)</p>", page))


@pytest.mark.parametrize("wrap", WRAPS)
@pytest.mark.parametrize("noise", NOISE)
def test_weights_decide_over_names(wrap, noise):
    text = "<h1>Head</h1>" + "".join(f"<p class=t>Paragraph {i} of the text, with words that weigh.</p>" + noise * (i == 2) for i in range(5))
    page = "<header>Site</header><nav><a>Home</a></nav>" + wrap.format(text + noise) + "<footer>c 2020</footer>"
    assert H.main_text(page) == "Head\n\n" + naive(page)


def test_heavy_comments_go_and_links_at_the_ends_of_an_article():
    words = "words that weigh " * 20
    page = f"<div><p>{words}</p></div><div class='post-comments'><p>{words * 3}</p></div>"
    assert H.main_text(page) == words.strip()
    links = "<ul><li><a>one</a><li><a>two</a></ul>"
    assert H.main_text(f"<article>{links}<h1><a>T</a></h1><p>{words}</p>{links}<p>{words}</p>{links}</article>").split() == (
        "T " + words + "one two " + words).split()
    assert H.main_text(f"<article>{links}</article>").split() == ["one", "two"]
