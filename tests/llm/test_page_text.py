import random

import pytest

from meterloom.llm import page_text

LONG = "long running text of the article " * 10


@pytest.mark.parametrize(
    "html, want",
    [
        (None, ""),
        ("", ""),
        ("plain", "plain"),
        ("<p>a<p>b", "a b"),
        ("<p>un<b>cl</b>osed <i>x<p>y", "unclosed x y"),
        ("<script>var a = '<p>no</p>'</script><style>p{}</style><!-- no -->", ""),
        (f"<body><nav><a>Menu</a></nav><article><h1>T &amp; U</h1><p><b>T<br><p>{LONG}</p><p>Be.</p></article><footer>&copy; foot</footer></body>", f"T & U T {LONG.strip()} Be."),
        (f"<article><header><h1>T</h1></header><p>{LONG}</p><form><p>mail</p></form><section id='comments'><p>first!</p></section></article>", f"T {LONG.strip()}"),
        (f"<div class='cookie-notice'>{LONG}</div><div id=main><p>{LONG}</p><p>x&nbsp;y</p></div><div class='sidebar'><p>{LONG}</p></div>", f"{LONG.strip()} x y"),
        (f"<main><p>{LONG}</p><aside>more</aside><div class=ad>buy</div><div hidden>h</div></main><header>site</header>", LONG.strip()),
    ],
)
def test_main_text(html, want):
    assert page_text.main_text(html) == want


PARTS = f"<h1>Title</h1><div class='lead'><p>short</p></div><div class='body'><p>{LONG}</p></div><section><p>end</p></section>"


@pytest.mark.parametrize("wrapper", ["article", "main", "div", "section"])
def test_lead_body_and_sections_stay(wrapper):
    page = f"<body><nav><a>Menu</a></nav><{wrapper}>{PARTS}</{wrapper}><footer>foot</footer></body>"
    assert page_text.main_text(page) == f"Title short {LONG.strip()} end"


@pytest.mark.parametrize("box", ["section", "div", "ul", "table"])
def test_article_split_unevenly(box):
    inner = {"ul": ("<li>", "</li>"), "table": ("<tr><td>", "</td></tr>")}.get(box, ("<p>", "</p>"))
    part = lambda text: f"<{box}>{inner[0]}{text}{inner[1]}</{box}>"
    want = f"{LONG * 9}{LONG.strip()} tail of the text"
    assert page_text.main_text(f"<article>{part(LONG * 10)}{part('tail of the text')}</article>") == want
    assert page_text.main_text(f"<article>{part('head of the text')}{part(LONG * 10)}</article>") == f"head of the text {LONG * 9}{LONG.strip()}"


def test_unmarked_page_keeps_every_part_of_high_lines():
    less = "some more text of the same kind in another part " * 4
    page = f"<body><nav><a>Menu</a></nav><div id=a><div><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div><p>{less}</p></div></div></body>"
    assert page_text.main_text(page) == " ".join([LONG.strip()] * 3 + [less.strip()])


@pytest.mark.parametrize(
    "open_tags, close_tags",
    [
        ("<div class='layout with-sidebar'><article>", "</article></div>"),
        ("<div class='layout sidebar-right'><article>", "</article></div>"),
        ("<div id='header-layout'><div class='content-sidebar'>", "</div></div>"),
        ("<article class='post has-sidebar'>", "</article>"),
        ("<article class='post no-comments'>", "</article>"),
        ("<article class='post comments-open'>", "</article>"),
        ("<main><div class='widget wide'>", "</div></main>"),
    ],
)
def test_words_do_not_mark_what_holds_the_article(open_tags, close_tags):
    inner = f"<div class='article-header'><h1>Title</h1></div><p>short</p><p>{LONG}</p><div class='share'>tell others</div>"
    page = f"<body><nav>Menu</nav><h2>Site</h2>{open_tags}{inner}{close_tags}<div class='sidebar'><p>more</p></div><p>2020</p></body>"
    got = page_text.main_text(page)
    assert f"Title short {LONG.strip()}" in got and "Menu" not in got and "more" not in got and "tell others" not in got


@pytest.mark.parametrize("wrapper", ["article", "section"])
def test_header_of_the_text_stays(wrapper):
    page = f"<body><div class='header'>Site</div><{wrapper}><div class='post-header'><h1>Title</h1></div><p>{LONG}</p></{wrapper}></body>"
    assert page_text.main_text(page) == f"Title {LONG.strip()}"


def test_longer_comments_and_related_articles_stay_out():
    page = "<article><h1>T</h1><p>{0}</p></article><div id='comments'><article>{1}</article><article>{1}</article></div><div class='related'><article>{0}</article></div>"
    assert page_text.main_text(page.format(LONG, LONG * 3)) == f"T {LONG.strip()}"
    assert page_text.main_text(f"<div><h1>T</h1><p>{LONG}</p></div><div class='comments'><p>{LONG * 3}</p></div>") == f"T {LONG.strip()}"


@pytest.mark.parametrize("name", ["class='search-algorithms'", "class='social-science'", "id='side-effects'", "id=discussion", "class='binary search'"])
@pytest.mark.parametrize("wrapper", ["article", "main", "div"])
def test_names_with_another_meaning_need_the_support_of_their_lines(name, wrapper):
    text = "A short one, with a full stop."
    block = f"<section {name}><h2>Part</h2><p>{LONG}</p><p>{text}</p></section>"
    page = f"<nav><a>Menu</a></nav><{wrapper}><h1>T</h1><p>{LONG}</p>{{}}<p>{LONG}</p></{wrapper}><footer>foot</footer>"
    whole = f"T {LONG.strip()} Part {LONG.strip()} {text} {LONG.strip()}"
    assert page_text.main_text(page.format(block)) == whole
    assert page_text.main_text(page.format(f"<p {name}>{text}</p>")) == f"T {LONG.strip()} {text} {LONG.strip()}"
    links = f"<div {name}><a href=a>one more of them</a> <a href=b>another one that is linked</a></div>"
    assert page_text.main_text(page.format(links)) == f"T {LONG.strip()} {LONG.strip()}"


@pytest.mark.parametrize("wrapper", ["article", "main", "div"])
def test_page_of_nothing_but_blocks_with_such_names(wrapper):
    page = f"<{wrapper}><div class='search-algorithms'><p>{LONG}</p></div><div class='social-science'><p>{LONG}</p></div></{wrapper}>"
    assert page_text.main_text(page) == f"{LONG.strip()} {LONG.strip()}"


def test_named_by_places_only_stay_out_of_the_article():
    for name in ("comment-list", "sidebar-right", "ad-slot", "cookie-notice", "newsletter-box", "related-posts", "ads2"):
        assert page_text.main_text(f"<article><h1>T</h1><p>{LONG}</p><div class='{name}'><p>{LONG}</p></div></article>") == f"T {LONG.strip()}"


MORE = "<section><h2>More stories</h2><ul><li><a href=1>Other one</a></li><li><a href=2>Other two</a></li></ul></section>"
TEASER = "<article><h3><a href=3>Some other story</a></h3><p>What it is about.</p></article>"


@pytest.mark.parametrize("beside", ["", TEASER, TEASER * 5])
@pytest.mark.parametrize("trail", ["<div>Home / News</div>", "<div><a href=/>Home</a> / <a href=n>News</a></div>"])
def test_what_lies_beside_the_article_in_main(trail, beside):
    want = f"Title {LONG.strip()} Be."
    text = f"<p>{LONG}</p><p>Be.</p>"
    for page in (
        f"<main>{trail}<article><h1>Title</h1>{text}</article>{MORE}{beside}</main>",
        f"<main>{trail}<h1>Title</h1><article>{text}</article>{MORE}{beside}</main>",
        f"<main>{trail}<h1>Title</h1>{text}{MORE}{beside}</main>",
        f"<body><div id=a>{trail}<article><h1>Title</h1>{text}</article>{MORE}</div>{beside}</body>",
        f"<body>{beside}<div id=a>{trail}<div><h1>Title</h1>{text}</div>{MORE}</div></body>",
    ):
        assert page_text.main_text(page) == want, page


def test_several_long_articles_stay_and_a_short_one_beside_boilerplate():
    assert page_text.main_text(f"<article>{LONG}</article><article>{LONG}</article>{TEASER}") == f"{LONG.strip()} {LONG.strip()}"
    assert page_text.main_text(f"<div>{LONG}</div><article><h1>T</h1><p>A rather short article of one line only.</p></article>") == "T A rather short article of one line only."


def test_articles_in_an_article_are_comments_behind_its_text_only():
    assert page_text.main_text(f"<article><h1>T</h1><p>{LONG}</p><article><p>{LONG * 2}</p></article></article>") == f"T {LONG.strip()}"
    assert page_text.main_text(f"<article><h1>T</h1><article><p>{LONG}</p></article></article>") == f"T {LONG.strip()}"


def reference(blocks):
    """What a page made of known blocks should give: the text of those that are content."""
    return " ".join(text for content, text in blocks if content)


@pytest.mark.parametrize("seed", range(40))
def test_generated_pages_against_their_labels(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9)))
    line = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    shell = rng.choice(["article", "main", "div"])
    blocks, body = [], []
    for k in range(rng.randint(2, 12)):
        text = line(rng.randint(15, 60) if k % 2 == 0 else rng.randint(3, 60))
        blocks.append((True, text))
        name = rng.choice(["", " class='body'", " id='search-results-explained'", " class='social-history'"])
        body.append(rng.choice([f"<p{name}>{text}</p>", f"<section{name}><p>{text}</p></section>", f"<div{name}><p>{text}</div>"]))
        if rng.random() < 0.3:
            text = line(rng.randint(3, 40))
            blocks.append((False, text))
            body.append(rng.choice([f"<aside>{text}</aside>", f"<div class='ad'>{text}</div>", f"<form><p>{text}</p></form>", f"<div id='comments'>{text}</div>"]))
    title = line(5)
    nav = "".join(f"<li><a href=x>{word()}</a></li>" for _ in range(6))
    page = f"<html><body><nav><ul>{nav}</ul></nav><header><p>{line(20)}</p></header><{shell}><h1>{title}</h1>{''.join(body)}</{shell}>{MORE}<footer>{line(30)}</footer></body></html>"
    assert page_text.main_text(page) == f"{title} {reference(blocks)}"


def test_whole_page_however_long():
    body = "".join(f"<p>paragraph number {i} of the text</p>" for i in range(20_000))
    assert page_text.main_text(f"<article>{body}</article>").endswith("paragraph number 19999 of the text")


def test_edge_rows(spark):
    rows = [(1, "u", "<p>a</p>", "t", 1), (1, "u", "<p>a</p>", "t", 1), (None, None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    assert [r["text"] for r in page_text.extract(pages).orderBy("page_id").collect()] == ["", "a", "a"]
    assert page_text.extract(pages.where("false")).count() == 0
