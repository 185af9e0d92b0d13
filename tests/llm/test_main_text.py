import time

import pytest

from vitrine.llm.main_text import main_text, op1_main_text, with_main_text

LONG = "A sentence of the article that goes on for a while. "


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("   ", ""), ("<p></p>", ""), ("<", "<"), ("a < b", "a < b"), ("plain &amp; text", "plain & text"),
        ("<p>one<p>two<br>three", "one two three"), ("<article><p>x</article>", "x"), ("<p>a<!-- b --><p>c<!-- d", "a c"),
        ("<p>caf&eacute;&#8217;s &#x41;&nbsp;b</p>", "café’s A b"), ("<p>in<b>li</b>ne <i>mark</i></p>", "inline mark"),
        ("<script>if (a<b) '</p>'</script><p>after</p><style>p{}</style>", "after"), ("<p>1 <em title='a>b'>2</em></p>", "1 2"),
        ("<ul><li>a<li>b</ul>", "a b"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"), ("<p>x</p><svg><text>no</text></svg>", "x"),
    ],
)
def test_small_pages(page, text):
    assert main_text(page) == text


def test_what_is_no_article_goes():
    page = f"""<!doctype html><html><head><title>t</title></head><body class="has-sidebar">
    <header>Site</header><div id="topMenu"><a href="/">Home</a></div><div class="page"><div class="story">
    <h1>Title</h1><p>{LONG * 5}</p><p>Short.</p><div class="advert-box">Buy now</div><aside>Other</aside>
    <blockquote><p>{LONG * 2}</p></blockquote><form><label>Name</label><input></form></div>
    <div class="cookieNotice">We use cookies and say so in a long sentence. {LONG}</div>
    <section id="comments"><p>{LONG * 6}</p></section></div><div role="complementary">{LONG * 3}</div>
    <footer>&copy; us</footer></body></html>"""
    long = " ".join(LONG.split())
    assert main_text(page) == " ".join(["Title", " ".join([long] * 5), "Short.", " ".join([long] * 2)])


def test_links_weigh_little_and_regions_of_one_text_stay_together():
    links = "".join(f"<li><a href='/{n}'>A headline of another page {n}</a></li>" for n in range(30))
    page = f"<body><div><ul>{links}</ul></div><div><div><p>{LONG * 4}</p><p>b</p></div><div><p>{LONG * 3}</p></div></div></body>"
    long = " ".join(LONG.split())
    assert main_text(page) == " ".join([long] * 4 + ["b"] + [long] * 3)


@pytest.mark.parametrize("piece", ["<div>", "<p>word ", "<a b=\"", "<x ", "<!-- ", "</p", "<svg>", "&", "<b><i></b>", "='", "<a href='"])
def test_time_is_linear_in_hostile_pages(piece):
    started = time.time()
    main_text(piece * 20_000)
    assert time.time() - started < 10


def test_tables(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "<p>a</p>", "x"), (2, None, None, "y"), (None, "w", "", "z"), (1, "u", "<p>a</p>", "x")], "page_id bigint, url string, html string, text string")
    out = with_main_text(pages)
    assert sorted(map(str, out.collect())) == sorted(
        ["Row(page_id=1, url='u', text='a')", "Row(page_id=2, url=None, text='')", "Row(page_id=None, url='w', text='')", "Row(page_id=1, url='u', text='a')"]
    )
    pages.limit(0).write.parquet(f"{tmp_path}/pages.parquet")
    assert op1_main_text(spark, str(tmp_path)).count() == 0


STORY = f"<h1>Title</h1><p>{LONG * 5}</p><p>{LONG * 3}</p>"
TOLD = " ".join(["Title", " ".join(LONG.split() * 5), " ".join(LONG.split() * 3)])


@pytest.mark.parametrize(
    "page",
    [
        f"<div class='content no-sidebar'>{STORY}</div>", f"<div id='page' class='has-sidebar'>{STORY}</div>",
        f"<div class='widget-content'>{STORY}</div>", f"<form action='./' id='aspnetForm'>{STORY}<input name='x'></form>",
        f"<form><div class='has-sidebar'><div class='comments-open'>{STORY}</div></div></form>",
        f"<div title='the hidden truth'>{STORY}</div>", f"<div data-x=\"a class='menu'\">{STORY}</div>",
        f"<div class='no-sidebar'><article>{STORY}</article></div><div id='comments'><article>{LONG * 20}</article></div>",
        f"<div class='no-sidebar'>{STORY}<div class='sidebar'>{LONG}</div><form>{LONG}</form></div>",
        f"<div class='story'>{STORY}</div><div class='comments'>{LONG * 20}</div><div hidden>{LONG * 20}</div>",
    ],
)
def test_wrappers_of_the_article_stay(page):
    assert main_text(f"<body><div class='menu'><a href='/'>Home</a></div>{page}<div class='footer'>us</div></body>") == TOLD


ARTICLE = "<p>" + "The river rose over night and took the old bridge with it, so the market stays on this side. " * 4 + "</p>"


def test_comments_under_any_name_are_left_out():
    for name in ("discussion", "feedback", "zq7", "talk-list"):
        comments = "".join(f"<div class='m'><b>Reader {n}</b><p>I was there too and saw it happen, what a day it was for all of us.</p></div>" for n in range(9))
        page = f"<body><nav><a href='/'>Home</a></nav><article><h1>Bridge gone</h1>{ARTICLE}{ARTICLE}</article><div class='{name}'>{comments}</div></body>"
        assert main_text(page).startswith("Bridge gone The river rose") and "Reader" not in main_text(page)
        listed = page.replace("<div class='m'>", "<li>").replace("</p></div>", "</p></li>")
        assert "Reader" not in main_text(listed)


def test_sections_of_an_article_stay():
    sections = "".join(f"<section class='part'><h2>Part {n}</h2>{ARTICLE}</section>" for n in range(4))
    assert "Part 3" in main_text(f"<body><article><h1>Long read</h1>{sections}</article></body>")
    assert "Part 3" in main_text(f"<body><div id='text'><h1>Long read</h1>{sections}</div></body>")


def test_headlines_outside_and_in_an_articles_header():
    own = f"<body><header><a href='/'>The Daily</a></header><article><header><h1>Bridge gone</h1></header>{ARTICLE}{ARTICLE}</article></body>"
    assert main_text(own).startswith("Bridge gone The river")
    outside = f"<body><nav><a href='/'>Home</a></nav><h1>Bridge gone</h1><article>{ARTICLE}{ARTICLE}</article></body>"
    assert main_text(outside).startswith("Bridge gone The river")
    twice = f"<body><h1>Daily</h1><article><h1>Bridge gone</h1>{ARTICLE}{ARTICLE}</article></body>"
    assert main_text(twice).startswith("Bridge gone")
