import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from plantline.llm.html import extract, main_text
from plantline.llm.queries import op10_main_text

PROSE = "The article goes on for a while and says something in every sentence, as articles do. "
SIDES = [
    "<nav><ul><li><a href=/a>Home</a><li><a href=/b>About us</a></ul></nav>",
    "<header><h2>Site name</h2><p>All the news of today and of any other day</p></header>",
    "<footer>&copy; 2020 Example company, all rights reserved by us for ever</footer>",
    "<aside><h3>Read more</h3><p>Another story that is longer than the one above it</p></aside>",
    "<div class='cookie-notice'><p>We use cookies to make this page work, you may refuse them at any time</p></div>",
    "<div class=\"ad\">Buy one of these now and get another one for half of the price</div>",
    "<form action=x><label>Name <input name=n></label><button>Send</button></form>",
    "<script>var t = '<p>no</p>';</script><style>p{margin:0}</style><noscript><p>Turn it on</p></noscript>",
    "<section id=comments><h3>Comments</h3><p>First! I liked this article so much that I read it twice.</p></section>",
    "<!-- <p>not shown</p> --><div hidden><p>nor is this</p></div>",
]


@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div><div><section>{}</section></div></div>"])
@pytest.mark.parametrize("side", SIDES)
def test_sides_are_left_out(wrap, side):
    article = f"<h1>A &amp; B</h1><p>{PROSE * 3}</p><p>{PROSE}<b>bold</b>\n <a href=x>link</a>, end.</p><ul><li>one<li>two</ul>"
    expected = f"A & B\n{(PROSE * 3).strip()}\n{PROSE}bold link, end.\none\ntwo"
    pages = [side + wrap.format(article), wrap.format(article) + side]
    if "<header>" not in side:  # inside an article it is the article's own
        pages.append(wrap.format(article + side))
    for page in pages:
        assert main_text(f"<!DOCTYPE html><html><head><title>T</title></head><body>{page}</body></html>") == expected


def test_broken_markup():
    assert main_text("<article><h1>T</h1><p><b>One<br>two<p>Three &lt;x&gt; &eacute;&#233;&#xe9;&amp") == "T\nOne two\nThree <x> ééé&"
    assert main_text("<article><table><tr><td>a<td>b<tr><td>c</table></article></p></div>") == "a\nb\nc"
    assert main_text("<article>a <div>b</div> c</article>") == "a\nb\nc"
    assert main_text("<article><p>x<script>if (a<b) {'</p>'}") == "x"


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "<!--", "<script>", "</p>", "<html><body></body></html>"])
def test_pages_without_text(html):
    assert main_text(html) in ("", "<")


@settings(max_examples=200, deadline=None)
@given(st.text("<>/ap='\" !-&;#x1divlscript\n", max_size=120))
def test_never_fails(html):
    main_text(html)


def test_very_long_and_deep_pages():
    assert main_text("<article>" + f"<p>{PROSE}</p>" * 20000 + "</article>").count("\n") == 19999
    assert main_text("<div>" * 5000 + PROSE) == PROSE.strip()


def test_rows(spark):
    schema = "page_id bigint, url string, html string, text int, n_chars string"
    pages = spark.createDataFrame([(1, "u", "<p>x y</p>", 3, "c"), (1, "u", "<p>x y</p>", 3, "c"), (None, None, None, None, None)], schema)
    assert sorted((r.text, r.n_chars) for r in extract(pages).collect()) == [("", 0), ("x y", 3), ("x y", 3)]
    assert extract(pages.where("false")).collect() == []


def test_query_keeps_articles_whole(spark):
    folder = "/root/testdata/sf0.001"
    html = {r.page_id: r.html for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = op10_main_text(spark, folder).collect()
    assert len(rows) == len(html)
    for r in rows:
        title = html[r.page_id].split("<h1>")[1].split("</h1>")[0]
        assert r.text.split("\n")[0].split() == main_text(f"<p>{title}</p>").split() and r.n_chars == len(r.text)
        assert "track(" not in r.text and "©" not in r.text


LAYOUTS = ["content with-sidebar", "no-sidebar", "layout has-sidebar", "elementor-widget elementor-widget-text-editor", "page menu-open", "social-post"]


@pytest.mark.parametrize("name", LAYOUTS)
@pytest.mark.parametrize("wrap", ["<article>{}</article>", "<div>{}</div>", "<main>{}</main>"])
def test_names_of_layouts_do_not_drop_the_article(name, wrap):
    article = f"<h1>Title</h1><p>{PROSE * 3}</p><p>{PROSE}</p>"
    expected = f"Title\n{(PROSE * 3).strip()}\n{PROSE.strip()}"
    ad = '<div class="ad">Buy one of these now</div>'
    for page in (f"<div class='{name}'>{wrap.format(article)}</div>{ad}", wrap.format(f"<div class='{name}'>{article}</div>") + ad):
        assert main_text(f"<html><body>{page}</body></html>") == expected
    text_only = f"<body><h2>Other</h2><div id='{name}'><p>{PROSE * 3}</p><p>{PROSE}</p></div></body>"
    assert (PROSE * 3).strip() in main_text(text_only)


def test_form_around_the_page_is_no_side_part():
    page = f"<form id=aspnetForm>{{}}<nav><a href=x>Home</a></nav><div><p>{PROSE * 3}</p><p>{PROSE}</p></div>{{}}</form>"
    search = "<form><label>Search</label><button>Go</button></form>"
    assert main_text(f"<body>{page.format('', '')}{search}</body>") == f"{(PROSE * 3).strip()}\n{PROSE.strip()}"


def test_further_articles_and_the_headline_of_main():
    one, two = f"<article><p>{PROSE * 4}</p></article>", f"<article><p>{PROSE}</p><p>{PROSE}</p></article>"
    texts = f"{(PROSE * 4).strip()}\n{PROSE.strip()}\n{PROSE.strip()}"
    assert main_text(f"<body><main><h1>Head</h1>{one}<div>{two}</div></main><div>not this</div></body>") == "Head\n" + texts
    assert main_text(f"<body>{one}{two}</body>") == texts
    comments = f"<section id=comments><article><p>{PROSE}</p></article></section>"
    assert main_text(f"<body>{one}{comments}</body>") == (PROSE * 4).strip()


def test_hidden_styles_headline_beside_the_text_and_many_open_elements():
    text = f"<p>{PROSE * 3}</p><p>{PROSE}</p>"
    expected = f"{(PROSE * 3).strip()}\n{PROSE.strip()}"
    for style in ("display:none", "color: red; display : NONE;", "visibility:hidden"):
        hidden = f"<div style='{style}'><p>{PROSE * 9}</p><p>{PROSE * 9}</p></div>"
        assert main_text(f"<body>{hidden}<div>{text}</div></body>") == expected
    assert main_text(f"<body><div style='display:block'>{text}</div></body>") == expected
    assert main_text(f"<body><div><h1>The headline</h1></div><div>{text}</div></body>") == "The headline\n" + expected
    assert main_text(f"<body><h1>One</h1><div><h1>Other</h1></div><div>{text}</div></body>") == expected
    started = time.process_time()
    assert main_text("<article>" + "<b>x " * 20000 + "</article>").count("x") == 20000
    assert time.process_time() - started < 5
