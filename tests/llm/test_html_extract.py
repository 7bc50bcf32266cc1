import html as references
import re
import time

import numpy as np
import pytest
from corpus import MIDDLE, read

from storetally.llm import html_extract
from storetally.llm.html_extract import extract, main_text, op7_html

PARAGRAPHS = [
    "The first paragraph of the article is long enough to be seen as content by any measure of text.",
    "Short.",
    "A third one holds an <a href='/x'>inline link</a>, <b>bold</b> and <i>italic</i> words &amp; a reference.",
    "Another long paragraph with several sentences. It goes on for a while. It ends here.",
]
PLAIN = "\n".join(
    [PARAGRAPHS[0], "Short.", "A third one holds an inline link, bold and italic words & a reference.", PARAGRAPHS[3]]
)
BODY = "".join(f"<p>{p}</p>" for p in PARAGRAPHS)
AROUND = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{x:y}</style><script>if(a<b)document.write('<p>no</p>')</script></head>"
    "<body><header><h1>Site</h1></header><nav><ul><li><a href='/a'>A</a></li><li><a href='/b'>B</a></li></ul></nav>"
    "<div class='cookie-notice'>We use cookies. Accept them all, please, or do not.</div>%s"
    "<aside>Side words</aside><div id='comments'><div class='comment'><p>First! This is a long reader comment that is not content at all.</p></div></div>"
    "<form><input><label>Mail</label><button>Send</button></form><div class='ad'>Buy now</div><footer>&copy; 2024</footer></body></html>"
)


@pytest.mark.parametrize("page", ["<article>%s</article>", "<main><div>%s</div></main>", "<div class='content'>%s</div>", "<div>%s</div>"])
def test_article_alone(page):
    assert main_text(AROUND % (page % BODY)) == PLAIN


def test_unclosed_elements():
    page = AROUND % ("<article>" + "".join(f"<p>{p}" for p in PARAGRAPHS) + "</article>")
    assert main_text(page) == PLAIN
    cut = "<html><body><nav><a>x</a></nav><article><p><b>" + BODY.replace("</p>", "<br>")
    assert main_text(cut) == PLAIN
    assert main_text("<nav><ul><li>menu<article>" + BODY) == PLAIN


def test_white_space_and_references():
    text = main_text("<article><p> a\n\t b&nbsp;c &lt;p&gt; &#233;&#x20ac; </p><p>  </p><!-- no --><p>d</p></article>")
    assert text == "a b c <p> é€\nd"


def test_pages_without_text():
    for page in (None, "", "   ", "<html></html>", "<nav>menu</nav>", "<script>x"):
        assert main_text(page) == ""
    assert main_text("only text") == "only text"


def test_long_page():
    page = "<article>" + "".join(f"<p>paragraph {i} has some words</p>" for i in range(20_000)) + "</article>"
    assert main_text(page).count("\n") == 19_999
    deep = "<div>" * 3000 + "<p>deep text</p>"
    assert main_text(deep) == "deep text"


def plain(html):
    """The article of a page of the table by regular expressions: cut at its blocks, without tags."""
    article = html[html.index("<article>") + 9 : html.index("</article>")]
    blocks = re.split(r"</?(?:p|h1|h2|h3|ul|li|div|section)(?:\s[^>]*)?>", article)
    blocks = [" ".join(references.unescape(re.sub(r"<[^>]*>", " " if "br" in block else "", block)).split()) for block in blocks]
    return "\n".join(block for block in blocks if block)


def test_table(spark):
    rows = read("pages", MIDDLE)
    found = {row["page_id"]: row for row in op7_html(spark, MIDDLE).collect()}
    assert len(found) == len(rows)
    for page_id, url, html in rows:
        assert found[page_id]["url"] == url
        assert found[page_id]["text"] == plain(html)
        assert found[page_id]["n_chars"] == len(found[page_id]["text"]) > 0


def test_the_clusters_decide(monkeypatch):
    """Other clusters give other texts, on pages of the table and on pages without articles."""
    pages = [row[2] for row in read("pages", MIDDLE)][:100]
    pages += [page.replace("article>", "div>") for page in pages]
    right = [main_text(page) for page in pages]
    rng = np.random.default_rng(3)
    monkeypatch.setattr(html_extract, "clusters", lambda ratios, parts: rng.random(len(ratios)) < 0.5)
    changed = [main_text(page) != text for page, text in zip(pages, right)]
    assert sum(changed[:100]) > 25 and sum(changed[100:]) > 25


WORDS = "Text of the page that must stay, with enough words to be read as such by anyone."


@pytest.mark.parametrize(
    "page",
    [
        "<body><div id='page' class='has-sidebar'>%s</div></body>",
        "<body><div class='content no-sidebar'>%s</div></body>",
        "<article><p>First.</p><div id='discussion'>%s</div></article>",
        "<article><p>First.</p><div class='share-price'>%s</div></article>",
        "<article><p>First.</p><section id='related-work'>%s</section></article>",
        "<article><div class='article-header'><h1>Title</h1>%s</div></article>",
        "<article><p>First.</p><div class='legal-notice-period'>%s</div></article>",
        "<body><form id='all'>%s</form></body>",
        "<body class='nav'>%s</body>",
        "<main class='sidebar'>%s</main>",
        "<div class='widget'><nav><a>menu</a></nav>%s</div>",
    ],
)
def test_names_do_not_take_content(page):
    text = main_text(page % (f"<p>{WORDS}</p>" * 3))
    assert text.count(WORDS) == 3 and "menu" not in text
    if "Title" in page:
        assert text.startswith("Title\n")


def test_boilerplate_in_an_article_goes():
    page = "<article>%s<div class='ad'>Buy now</div><aside>Aside</aside>%s<ul class='share'><li>Send</li></ul><section class='comments'><article class='comment'><p>%s</p></article></section></article>"
    text = main_text(page % (BODY, BODY, "A reader's comment of some length that is no part of the article at all. " * 3))
    assert text == PLAIN + "\n" + PLAIN


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 50_000 + "</section>" * 50_000 + "<p>end</p>",
        "<div>" * 20_000 + "<body>" * 20_000 + "<p>end</p>",
        "<p><b>" * 50_000 + "</i></b>" * 50_000 + "end",
        "<ul>" + "<li><p>" * 50_000 + "end",
        "<nav>" * 50_000 + "</nav>" * 50_000 + "<p>end</p>",
    ],
    ids=["stray ends", "bodies", "inline", "items", "menus"],
)
def test_open_elements_cost_nothing(page):
    begin = time.perf_counter()
    assert main_text(page).endswith("end")
    assert time.perf_counter() - begin < 4


def test_smoothing_stays_in_its_part():
    ratios, parts = np.array([9.0, 9.0, 0.0, 9.0, 9.0]), np.array([0, 0, 5, 0, 0])
    assert html_extract._smoothed(ratios, parts).tolist() == ratios.tolist()
    even = html_extract._smoothed(np.arange(9.0), np.zeros(9))
    assert even[4] == pytest.approx(4) and even[0] > 0


def test_rows_and_columns_stay(spark):
    pages = spark.createDataFrame([(1, None, "x", 2), (None, "<p>a</p>", "y", 3), (None, "<p>a</p>", "y", 3)], "page_id int, html string, url string, n int")
    found = extract(pages, name="main")
    assert found.columns == ["page_id", "html", "url", "n", "main"]
    assert sorted(row["main"] for row in found.collect()) == ["", "a", "a"]
    assert extract(pages.limit(0)).collect() == []


LONG = "<p>" + "A long paragraph of the text that goes on for a while. " * 6 + "</p>"


def test_ratios_choose_beside_an_article():
    """A short teaser in an article does not keep the page's text out."""
    text = main_text(f"<body><div><a>x</a> <a>y</a></div><div>{LONG * 4}<article><p>Read on.</p></article></div></body>")
    assert text.count("A long paragraph") == 24 and "x" not in text.split("\n")
    inside = main_text(f"<body><div><a>x</a> <a>y</a></div><article>{LONG * 4}</article></body>")
    assert inside.count("A long paragraph") == 24 and "y" not in inside


@pytest.mark.parametrize(
    "short",
    [
        "<blockquote>Quote.</blockquote>",
        "<section><p>One.</p><p>Two.</p></section>",
        "<table><tr><td>a</td><td>b</td></tr></table>",
        "<div>Short.</div>",
        "<div><p>One.</p></div><div><p>Two.</p></div>",
    ],
)
def test_short_parts_stay(short):
    page = f"<body><div class='nav'><a>menu</a></div><div>{LONG * 5}{short}{short}{short}{short}{LONG * 5}</div></body>"
    text = main_text(page).split("\n")
    assert len(text) > 10 and text.count(LONG[3:-4].strip()) == 10 and "menu" not in text
    for word in ("Quote.", "One.", "Two.", "a", "b", "Short."):
        assert text.count(word) == 4 * (f">{word}<" in short)
    wrapped = f"<body><div>{''.join(f'<div>{part}</div>' for part in (LONG, '<p>Short.</p>', LONG, '<p>Tiny.</p>', '<p>Tiny.</p>'))}</div></body>"
    assert main_text(wrapped).count("Tiny.") == 2


def test_short_article_beside_long_ones():
    text = main_text(f"<article>{LONG * 9}</article><article><p>Brief.</p><p>End.</p></article><article>{LONG * 9}</article>")
    assert text.count("Brief.") == text.count("End.") == 1
