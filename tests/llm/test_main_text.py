"""Blocks and labels on small pages, and all given pages against their article element."""

import html
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import main_text, queries
from tests.conftest import MEDIUM

LONG = "It was in the garden of the house that we had the first of all the talks, and they were not the last of them. " * 3
PROSE = LONG.strip()


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain &amp; short", "plain & short"),
        ("<nav>menu</nav>", ""),
        ("<h1>Title</h1><p>Short.", "Title\n\nShort."),
        (PROSE, PROSE),
        (f"<nav><ul><li><a href='/x'>Home</a></ul></nav><p>{PROSE}</p><p>Short.</p><p>{PROSE}<footer>(c) we</footer>", f"{PROSE}\n\nShort.\n\n{PROSE}"),
        ("<article><h1>A  title</h1><p><b>One<br>two &lt;b&gt;</b></article><div>foot</div>", "A title\n\nOne two <b>"),
        (f"<article><p>{PROSE}</p><ul class='share'><li>Tweet</ul><section id=comments><p>{PROSE}</p></section></article>", PROSE),
        (f"<header><h1>Site</h1></header><main><p>x</p></main><aside><p>{PROSE}</p></aside>", "x"),
        (f"<div class='cookie-notice'>{PROSE}</div><p>{PROSE}</p><form><p>{PROSE}</p></form>", PROSE),
        (f"<p>{PROSE}<script>if (a < b) {{ '</p>' }}</script></p><style>p{{}}</style><!-- <p>no</p> -->", PROSE),
        (f"<p>{PROSE}</p><div><a href=1>one</a> <a href=2>two</a> <a href=3>three</a></div>", PROSE),
        ("<article><p>a &#65; &eacute;&nbsp;&copy; 1 < 2 &amp</p><p", "a A é © 1 < 2 &"),
        ("<article><div hidden>no</div><p style='display:none'>no</p><p>yes</p>", "yes"),
        ("<article><table><tr><td>1<td>2</table></article>", "1\n\n2"),
    ],
)
def test_pages(page, text):
    assert main_text.main_text(page) == text


def test_every_given_page(spark):
    """The given pages hold their article in one element of headings and paragraphs."""
    pages = {r.page_id: r for r in spark.read.parquet(f"{MEDIUM}/pages.parquet").collect()}
    rows = queries.QUERIES["op9_main_text"].plan(spark, MEDIUM).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[row.page_id].html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert row.text == "\n\n".join(b for b in blocks if b)
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "x"), (2, f"<p>{PROSE}</p>" * 2000, None), (None, "<p", "x")]
    df = spark.createDataFrame(rows, "page_id int, html string, text string")
    got = [r[0] for r in df.select(main_text.extracted(F.col("html"))).collect()]
    assert got[:2] == ["", ""] and got[2] == "\n\n".join([PROSE] * 2000) and got[3] == ""
    assert df.where("false").select(main_text.extracted(F.col("html"))).collect() == []


@pytest.mark.parametrize(
    "page, text",
    [
        ("<html><head><title>t</title><body><article><p>Hello", "Hello"),
        ("<html><head><title>t</title><meta x=1><article><p>Hello</p></article>", "Hello"),
        ("<head><title>a <b> c</title>Hello <b>there</b>", "Hello there"),
        ("<head><title>t<body><p>Hello", "Hello"),
        ("<head><title>t</title><noscript><p>no</noscript></head><p>Hello", "Hello"),
        ("<head><title>t</title>", ""),
        *((f"<article><p>One</p><{e}><p>Two</p></article><div><{e}>no</{e}></div>", "One\n\nTwo") for e in ("noscript", "template", "svg", "iframe", "object")),
        ("<article><p>One <svg><g>no</g></svg> two</p><object><object>no</object>no</object><p>Three", "One two\n\nThree"),
        ("<article><p>One</p><svg/><p>Two", "One\n\nTwo"),
    ],
)
def test_elements_left_open(page, text):
    assert main_text.main_text(page) == text


@pytest.mark.parametrize("name", ["with-sidebar", "no-sidebar", "has-banner", "search-page", "main-banner", "social", "search"])
def test_names_around_articles(name):
    page = f"<nav>menu</nav><div class='x {name}'><div><article><h1>Title</h1><p>Short.</p><p>{PROSE}</p><p>Short.</p></article></div></div>"
    assert main_text.main_text(page) == f"Title\n\nShort.\n\n{PROSE}\n\nShort."
    assert main_text.main_text(f"<div class={name}><article><p>Short.") == "Short."
    assert main_text.main_text(f"<div id={name}><h1>Title</h1><p>{PROSE}</p></div>") == f"Title\n\n{PROSE}"


@pytest.mark.parametrize(
    "page",
    [
        f"<article><p>{PROSE}</p></article><div class=related><article><p>{PROSE}</p></article></div>",
        f"<div class=main-sidebar><p>Short.</p></div><p>{PROSE}</p><div class=site-footer><p>(c) we</div>",
        f"<article><p>{PROSE}</p></article><section id=comments><article class=comment><p>{PROSE}</p></article></section>",
        f"<aside><article><p>Short.</p></article></aside><p>{PROSE}</p>",
    ],
)
def test_names_of_boilerplate(page):
    assert main_text.main_text(page) == PROSE


@pytest.mark.parametrize("anchor", ["<a name=top>", "<a name=x/>", "<a id='y' data-href='z'>", "<a href=x>"])
def test_links_left_open(anchor):
    both = f"{PROSE}\n\n{PROSE}"
    assert main_text.main_text(f"<article>{anchor}<p>{PROSE}</p><p>{PROSE}") == both
    assert main_text.main_text(f"<article><p>{anchor}<p>{PROSE}<p>{PROSE} <a href=1>x</a>") == both + " x"


def test_links_over_blocks():
    page = f"<p>{PROSE}</p><a href=1><p>one</p><p>two</p></a><ul><li><a href=1>three<li><a href=2>four</ul><p>{PROSE}</p>"
    assert main_text.main_text(page) == f"{PROSE}\n\n{PROSE}"


#: Two paragraphs of over 200 letters in languages without listed stop words, and in other scripts.
FOREIGN = {
    "pl": "Wczoraj rano dzieci poszły razem przez las, aby znaleźć stary młyn, który stał kiedyś nad rzeką. Po drodze spotkały "
          "leśniczego, który opowiedział im długą historię o powodzi sprzed stu lat oraz o młynarzu, który uratował całą wieś.",
    "ru": "Вчера утром дети вместе пошли через лес, чтобы найти старую мельницу, которая когда-то стояла над рекой. По дороге они "
          "встретили лесника, который рассказал им длинную историю о наводнении сто лет назад и о мельнике, спасшем деревню.",
    "it": "Ieri mattina i bambini andarono insieme attraverso il bosco per trovare il vecchio mulino che stava sopra il fiume. "
          "Lungo la strada incontrarono un guardaboschi che raccontò loro una lunga storia dell'alluvione di cento anni fa.",
    "tr": "Dün sabah çocuklar bir zamanlar nehrin üstünde duran eski değirmeni bulmak için birlikte ormandan geçtiler. Yolda "
          "onlara yüz yıl önceki sel ve bütün köyü kurtaran değirmenci hakkında uzun bir hikâye anlatan ormancıyla karşılaştılar.",
    "zh": "昨天早上，孩子们一起穿过森林，去寻找曾经矗立在河边的老磨坊。路上他们遇到了一位护林员，他给他们讲了一个很长的故事，说的是一百年前的洪水，"
          "以及救了全村的磨坊主。故事讲完时天已经黑了，大家只好在林中的小屋里过夜。",
    "el": "Χθες το πρωί τα παιδιά πήγαν μαζί μέσα από το δάσος για να βρουν τον παλιό μύλο που κάποτε στεκόταν πάνω από το ποτάμι. "
          "Στον δρόμο συνάντησαν έναν δασοφύλακα που τους διηγήθηκε μια μεγάλη ιστορία για την πλημμύρα πριν από εκατό χρόνια.",
    "nl": "Gisteren liepen kinderen samen door bossen, zoekend naar oude molens langs kronkelende rivieren. Onderweg ontmoetten "
          "ze boswachters, vertellend over overstromingen honderd jaar geleden, waarbij molenaars hele dorpen redden dankzij moed.",
}


@pytest.mark.parametrize("lang", FOREIGN)
@pytest.mark.parametrize("wrap", ["{}", "<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>"])
def test_languages_without_listed_stop_words(lang, wrap):
    text = FOREIGN[lang]
    page = "<nav><a href=/>Start</a></nav>" + wrap.format(f"<h1>{text[:20]}</h1><p>{text}</p><p>{text[5:]}</p>") + "<footer>x</footer>"
    assert main_text.main_text(page) == f"{text[:20].strip()}\n\n{text}\n\n{text[5:].strip()}"


@pytest.mark.parametrize("name", ["comment-list", "comment-body", "user-comments", "comments", "disqus-thread", "post_comments"])
@pytest.mark.parametrize(
    "page",
    [
        "<article><p>{0}</p></article><div class='{1}'><p>{2}</p><p>{2}</p></div>",
        "<article><p>{0}</p><div class='{1}'><p>{2}</p></div></article>",
        "<p>{0}</p><section id='{1}'><div><p>{2}</p></div></section>",
        "<div class='{1}'><p>{2}</p></div><main><p>{0}</p></main>",
    ],
)
def test_reader_comments_go_whatever_their_prose(name, page):
    assert main_text.main_text(page.format(PROSE, name, "I was there as well and it was the best of all the days that we had. " * 5)) == PROSE


@pytest.mark.parametrize("name", ["comments-open", "has-comments", "post comments-enabled"])
def test_pages_that_allow_comments_keep_their_text(name):
    assert main_text.main_text(f"<div class='{name}'><h1>One</h1><p>{PROSE}</p></div>") == f"One\n\n{PROSE}"


def test_page_of_comments_alone():
    assert main_text.main_text(f"<div class='comment-list'><p>{PROSE}</p></div>") == PROSE


def test_paragraph_of_an_article_that_is_one_link():
    link = "<a href='/x'>The whole of this paragraph is one link to another page</a>"
    page = f"<article><h2><a href=/t>Title</a></h2><p>{PROSE}</p><p>{link}</p><p>{PROSE}</p></article>"
    assert main_text.main_text(page) == f"Title\n\n{PROSE}\n\nThe whole of this paragraph is one link to another page\n\n{PROSE}"


@pytest.mark.parametrize("name", ["nav", "aside", "menu", "footer"])
@pytest.mark.parametrize("rest", ["<article><p>{0}</p><p>Short.</p></article>", "<div><p>{0}</p><p>Short.</p></div>", "<main><p>{0}</p><p>Short.</p>"])
def test_menu_that_is_never_closed(name, rest):
    page = f"<body><div><{name}><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul></div>" + rest.format(PROSE)
    assert main_text.main_text(page) == f"{PROSE}\n\nShort."
    page = f"<body><{name}><ul><li><a href=/>Home</a><li><a href=/a>About us</a></ul>" + rest.format(PROSE)
    assert main_text.main_text(page) == f"{PROSE}\n\nShort."
