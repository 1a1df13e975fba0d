import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.cases import SF, table
from tidemark.llm import html_text as H

LONG = "The house on the hill was built by the family that owned it for a long time and it is now a museum."


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title></head><body class='home nav'>{body}</body></html>"


@pytest.mark.parametrize("raw, want", [
    (None, ""), ("", ""), ("   ", ""), ("just text", ""), ("<", ""), ("<p", ""), ("<!-- never closed <p>" + LONG, ""),
    (f"<p>{LONG}</p>", LONG),
    (page(f"<nav><a href=/>Home</a></nav><article><h1>Title</h1><p>{LONG}<p>Short.</article><footer>c</footer>"),
     f"Title\n\n{LONG}\n\nShort."),
    (page(f"<article><p>a  b\n&amp;&nbsp;c<br>d &lt;p&gt; &eacute; 1 < 2</p><script>var x='</p>';</script></article>"),
     "a b & c d <p> é 1 < 2"),
    (page(f"<article><p>{LONG}</p><div class='share-buttons'>Share this</div><aside>More</aside>"
          f"<form>Sign up <input></form><p>End.</p><section id=comments><p>{LONG}</p></section></article>"), f"{LONG}\n\nEnd."),
    (page(f"<div class=cookie-notice>{LONG}</div><div><h2>Head</h2><p>{LONG}</p><p>Tail</p></div><div class=ad>{LONG}</div>"),
     f"Head\n\n{LONG}\n\nTail"),
    (page(f"<div><p>{LONG}</p></div><div><p><a href=a>One</a> <a href=b>Two</a></p></div>"), LONG),
    (page(f"<main><ul><li>one</li><li>two</li></ul><table><tr><td>x</td></tr></table></main>"), "one\n\ntwo\n\nx"),
    (page(f"<article><p title='a > b'>{LONG}</p><p hidden>gone</p><div style='display: none'>gone</div></article>"),
     LONG),
    (f"<body><article><p>{LONG}</p><p class=ad>Buy</p><p>cut <b>of", f"{LONG}\n\ncut of"),
])
def test_pages(raw, want):
    assert H.main_text(raw) == want


CHINESE = "这座房子建在山上，由拥有它的家族在很久以前建造，现在是一座博物馆，每天都有许多人来参观。"
ITALIAN = "Questa casa sorge sopra una collina, costruita molto tempo prima dalla famiglia proprietaria, oggi museo aperto ogni giorno."
RUSSIAN = "Дом на холме построила семья, которая владела им долгое время, а теперь здесь находится музей, открытый ежедневно."


@pytest.mark.parametrize("raw, want", [
    # elements without their end tag are ordinary
    (page(f"<article><p>{LONG}</p><object data=x><p>One.</p><canvas><p>Two.</p></article>"), f"{LONG}\n\nOne.\n\nTwo."),
    (page(f"<article><p>{LONG}</p><object><p>gone</p></object><svg><text>gone</text></svg><p>End.</p></article>"), f"{LONG}\n\nEnd."),
    (page(f"<article><p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p></article>"), f"{LONG} x=2 holds."),
    # the title in an article's own header, not its byline, nor the page's header
    (page(f"<header><h1>Site</h1></header><article><header><div><h1>Title</h1></div><p>by {LONG}</p></header><p>{LONG}</p></article>"),
     f"Title\n\n{LONG}"),
    (page(f"<article><header><nav><h2>Menu</h2></nav><h1>Title</h1></header><p>{LONG}</p></article>"), f"Title\n\n{LONG}"),
    # one word of a longer name
    (f"<body><div class='legal-history'><p>{LONG}</p></div></body>", LONG),
    (f"<body><div class='legal history-of-law' id='ad-free-zone'><p>{LONG}</p></div></body>", ""),
    (f"<body><div class='post-body adFree'><p>{LONG}</p></div><div class='site-footer'><p>{LONG}</p></div></body>", LONG),
    # languages and scripts without stop words in the list
    (f"<body><div><p>{CHINESE}</p><p>{CHINESE}</p></div><div><a href=x>首页</a><a href=y>新闻</a></div></body>", f"{CHINESE}\n\n{CHINESE}"),
    (f"<body><nav><p>{ITALIAN}</p></nav><div><h1>Casa</h1><p>{ITALIAN}</p></div></body>", f"Casa\n\n{ITALIAN}"),
    (f"<body><div><p>{RUSSIAN}</p></div><footer><p>{RUSSIAN}</p></footer></body>", RUSSIAN),
    (f"<body><div><p>{LONG}</p></div><div><p>{'xq zw vk ' * 30}</p></div></body>", LONG),
])
def test_other_markup_languages_and_names(raw, want):
    assert H.main_text(raw) == want


def brute(found):
    """The two passes as they are told: every block against all others."""
    listed = H.listed_language(found)
    label = [H.first_pass(b, listed) for b in found]
    out = list(label)
    for k, b in enumerate(found):
        if label[k]:
            continue
        own = [j for j in range(len(found)) if label[j] and found[j].container == b.container]
        if not own and b.hint == H.GOOD:
            out[k] = H.GOOD
            continue
        # on each side the nearest one counts
        all_ = own or [j for j in range(len(found)) if label[j]]
        gap = min((abs(j - k) for j in all_), default=None)
        near = [label[j] for j in all_ if abs(j - k) == gap]
        out[k] = H.BAD if not near else H.GOOD if H.GOOD in near else H.BAD
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["Short.", LONG, "xq zw " * 20, "a the of", CHINESE]), st.sampled_from([0.0, 0.2, 0.9]),
                          st.integers(0, 3), st.sampled_from([H.GOOD, H.BAD, H.OPEN])), max_size=14))
def test_two_passes_equal_brute_force(rows):
    hints = {}
    found = [H.Block(t, x, c, hints.setdefault(c, h)) for t, x, c, h in rows]
    listed = H.listed_language(found)
    assert H.second_pass(found, [H.first_pass(b, listed) for b in found]) == brute(found)


def test_unclosed_elements_are_searched_once():
    assert H.main_text(f"<article><p>{LONG}</p>" + "<canvas>" * 50_000 + "<p>End.</p></article>") == f"{LONG}\n\nEnd."


def test_a_small_article_does_not_replace_the_text_outside():
    body = "".join(f"<p>{LONG} {k}</p>" for k in range(4))
    want = "\n\n".join(f"{LONG} {k}" for k in range(4))
    card = "<article class=card><p>Next story</p></article>"
    assert H.main_text(page(f"<div class=post>{body}</div>{card}")).startswith(want)
    assert H.main_text(page(f"<main><p>{LONG}</p></main><div class=post>{body}</div>")) == f"{LONG}\n\n{want}"
    assert H.main_text(page(f"<article>{body}</article><div><p>{LONG}</p></div>")) == want


def test_long_and_deep_pages_are_linear():
    assert H.main_text("<div>" * 50_000 + LONG) == LONG
    assert H.main_text("<" * 200_000) == ""
    assert H.main_text('<a href="' * 20_000 + LONG) in ("", LONG)
    text = (LONG + " ") * 20_000
    assert H.main_text(f"<article><p>{text}</p></article>") == text.strip()


def test_undecided_blocks_follow_the_nearest_decided():
    block = lambda text, container=1, hint=0: H.Block(text, 0.0, container, hint)
    found = [block("a"), block("b"), block("c"), block("d"), block("e", 2)]
    assert H.second_pass(found, [H.GOOD, 0, 0, H.BAD, 0]) == [1, 1, -1, -1, -1]
    assert H.second_pass(found, [0, 0, 0, 0, 0]) == [-1] * 5


def test_rows(spark):
    rows = [(1, "u", f"<article>{LONG}</article>"), (2, None, None), (None, "v", ""), (1, "u", f"<article>{LONG}</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    assert sorted(map(tuple, H.extract(df).collect()), key=str) == sorted(
        [(1, "u", LONG, len(LONG))] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str)
    assert H.extract(df.where("false")).collect() == []


def test_whole_pages(spark):
    want = {}
    for r in table(SF, "pages"):
        body = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", r["html"], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub("</?b>", "", x.replace("<br>", " "))).split())
                  for x in re.split("</?(?:p|h1)>", body)]
        want[r["page_id"]] = "\n\n".join(b for b in blocks if b)
    got = {r.page_id: r.text for r in H.op7_html_text(spark, SF).collect()}
    assert got == want
