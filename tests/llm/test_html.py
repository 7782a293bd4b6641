import random

import numpy as np
import pyarrow as pa
import pytest

from tillroll.llm import html
from tillroll.llm.html import main_blocks

PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad <article> --><div class="ad box">Buy<div>now</div></div><div id="cookie-notice">Cookies</div>
<article><h1>Title&nbsp;&eacute;</h1><p><b>First
  line<br><p>sec<i>ond</i> &lt;tag&gt; &am</p><aside>Side</aside><form><input>Field</form><div class="comments"><p>Reader</p></div>
<noscript>none</noscript><table><tr><td>1</td><td>2</td></tr></table><img alt="a > b">end</article><footer>Foot &copy;</footer></body></html>"""


def test_article_without_chrome():
    assert main_blocks(PAGE) == (True, "Title é First line second <tag> &am 1 2 end")


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        (None, (False, "")),
        ("", (False, "")),
        ("just  text &amp; more", (False, "just text & more")),
        ("<main>in</main>out", (True, "in")),
        ("<main>m<article>a</article></main>", (True, "a")),
        ("<div class='ad'>never closed<article>kept</article>", (True, "kept")),
        ("<article>one</article><p>x</p><article>two", (True, "one two")),
        ("<article><div class='adapter'>kept</div><div class='Top-Nav'>gone</div></article>", (True, "kept")),
        ("<p>a<br/>b<span>c</span></p><p hidden>h</p><p style='display: none'>n</p>", (False, "a bc")),
        ("<article>a <!-- unclosed ", (True, "a")),
        ("<article>1 < 2 and <3</article>", (True, "1 < 2 and <3")),
        ("<article>x<script>if (a<b) {}", (True, "x")),
        ("<header>Site</header><article><header>Byline</header>Body</article>", (True, "Body")),
        ('<article><div class="content no-sidebar">Body</div></article>', (True, "Body")),
        ('<main><div class="story legal">All of it</div><p>end</p></main>', (True, "All of it end")),
        ('<article><div class="entry has-comments">Body</div><div class="comments-area"><p>Much longer words of readers</p></div></article>', (True, "Body")),
        ("<article>One<aside>Side<p>Two</p></article>out", (True, "One Two")),
        ("<main>whole text</main><article>Teaser</article>", (True, "whole text")),
        ("<main>Top<article>The long text</article></main><article>Teaser</article>", (True, "The long text")),
        ("<main>A long page of its own<article>Teaser</article></main>", (True, "A long page of its own Teaser")),
        ('<article>Text</article><article class="comment">Reader</article>', (True, "Text")),
        ('<article>Text<article id="comment-7">Reader</article></article>', (True, "Text")),
        ("<article></article><div>Only here</div>", (False, "Only here")),
        ("<header>Site<div>Line</div><p>Text", (False, "Line Text")),
        ("<div>" * 3000 + "deep" + "</div>" * 3000, (False, "deep")),
        ("<article>" + "<b>x</i>" * 3000 + "</article>", (True, "x" * 3000)),
        ("<p>" + "word " * 200_000, (False, ("word " * 200_000).strip())),
    ],
)
def test_odd_pages(page, expected):
    assert main_blocks(page) == expected


def brute_unique(pages, repeat=8, least=3, share=0.1, own=0.1):
    """Tokens outside runs of ``repeat`` that enough pages of the host have, equal pages being one."""
    seen, hosts = {}, {}
    for host, tokens in set(pages):
        hosts[host] = hosts.get(host, 0) + 1
        for run in {tokens[k : k + repeat] for k in range(len(tokens) - repeat + 1)}:
            seen[host, run] = seen.get((host, run), 0) + 1
    out = []
    for host, tokens in pages:
        covered = set()
        for k in range(len(tokens) - repeat + 1):
            if seen[host, tokens[k : k + repeat]] >= max(least, share * hosts[host]):
                covered.update(range(k, k + repeat))
        covered = set() if len(tokens) - len(covered) < own * len(tokens) else covered
        out.append(" ".join(t for k, t in enumerate(tokens) if k not in covered))
    return out


def test_unique_runs_of_hosts_equal_brute_force(spark):
    dice = random.Random(5)
    menu, legal = [f"m{i}" for i in range(12)], [f"l{i}" for i in range(9)]
    quote = [f"q{i}" for i in range(10)]
    pages = []
    for n in range(120):
        own = [f"u{dice.randrange(10**6)}" for _ in range(dice.randint(0, 40))]
        tokens = [*(menu if n % 2 else menu[:7]), *own, *(legal if n % 3 else []), *(menu[2:11] if n % 5 == 0 else []), *(quote if n in (4, 8) else [])]
        pages.append((f"http://h{n % 4}.example/{n}", tuple(tokens)))
    pages += [(f"http://h1.example/copy{n}", pages[9][1]) for n in range(20)]
    rows = [(n, url, f"<body><p>{' '.join(text)}</p></body>", "clash") for n, (url, text) in enumerate(pages)]
    got = {r.page_id: r for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, tokens string")).collect()}
    expected = brute_unique([(url[8], text) for url, text in pages])
    assert [got[n].text for n in range(140)] == expected and all(r.n_chars == len(r.text) for r in got.values())
    assert "m0" not in expected[1] and "q9" in expected[4] and "q9" in expected[8] and expected[9] == expected[139] != ""


def test_unmarked_copies_and_pages_without_own_text_stay(spark):
    body = " ".join(f"w{i}" for i in range(40))
    rows = [(n, f"http://a/{n}", f"<p>{body}</p>") for n in range(4)]
    rows += [(10 + n, f"http://b/{n}", f"<p>{body} n{n}</p>") for n in range(5)]  # nearly equal
    found = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(found[n] == body for n in range(4)) and all(found[10 + n] == f"{body} n{n}" for n in range(5))


def test_articles_that_repeat_stay_whole_and_rows_are_answered_each(spark):
    body = f"<article>{'same words ' * 30}</article>"
    rows = [(1, "http://a/1", body), (2, "http://a/2", body), (2, "http://a/2", body), (None, None, None), (3, None, "<p>loose</p>"), (4, "http://a/", "")]
    found = html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    texts = sorted((str(r.page_id), r.text) for r in found)
    same = ("same words " * 30).strip()
    assert texts == [("1", same), ("2", same), ("2", same), ("3", "loose"), ("4", ""), ("None", "")]


def test_empty_table(spark):
    assert html.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


@pytest.mark.parametrize("repeat", [1, 3, 8])
def test_array_is_the_sorted_order_of_suffixes(repeat):
    dice = random.Random(repeat)
    streams = [[dice.choice("a b c dd é".split()) for _ in range(dice.randint(1, 60))] for _ in range(30)]
    hosts = [dice.randrange(3) for _ in streams]
    array = html._Array(pa.array(" ".join(s) for s in streams), np.array(hosts), repeat)
    suffixes = [(hosts[p], s[k : k + repeat], p, k) for p, s in enumerate(streams) for k in range(len(s) - repeat + 1)]
    order = sorted(suffixes, key=lambda s: (s[0], [t.encode() for t in s[1]], *s[2:]))
    assert list(zip(array.page.tolist(), array.at.tolist(), strict=True)) == [s[2:] for s in order]
    equal = [[(s[0], s[1]) for s in order].index((s[0], s[1])) for s in order]
    assert array.begin[array.run].tolist() == equal
    assert array.held.tolist() == [len({s[2] for s in order[a:b]}) for a, b in zip(array.begin, [*array.begin[1:], len(order)], strict=True)]


def test_hosts_in_blocks_equal_brute_force(spark):
    """Boilerplate that about a tenth of a host's pages have is over the share in some blocks and not in others."""
    dice = random.Random(8)
    pages = []
    for n in range(240):
        own = [f"u{dice.randrange(10**6)}" for _ in range(30)]
        shared = [f"s{k}t{i}" for k in range(8) if dice.random() < 0.06 + 0.01 * k for i in range(10)]
        pages.append((f"http://h{min(n % 8, 1)}.example/{n}", tuple(shared + own)))
    pages += [(f"http://h1.example/copy{n}", pages[9][1]) for n in range(60)]
    rows = [(n, url, f"<p>{' '.join(text)}") for n, (url, text) in enumerate(pages)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    expected = brute_unique([(url[8], text) for url, text in pages])
    assert 0 < sum(text != " ".join(tokens) for text, (_, tokens) in zip(expected, pages, strict=True)) < len(pages)
    assert html.dealt(table.selectExpr("substring(url, 9, 1) AS host", "html"), 9000).agg({"blocks": "max"}).first()[0] > 3
    got = {r.page_id: r.text for r in html.main_text(table, shard=9000).collect()}
    assert [got[n] for n in range(len(pages))] == expected


def test_the_array_decides_pages_that_mark_their_article(spark):
    """Boilerplate does not outweigh the article, and goes as an element in it; a paragraph that pages share stays."""
    about = "this long text about the site stands on every single page of this host " * 3
    follow = "follow us on all of the networks and never miss a story again"
    rows = []
    for n in range(6):
        story = " ".join(f"w{n}x{i}" for i in range(20))
        rows.append((n, f"http://a/{n}", f"<main><p>{story}</p></main><article>{about}</article>"))
        rows.append((10 + n, f"http://b/{n}", f"<article><p>{story}</p><div class=x7>{follow}</div><p>{follow}</p></article><article>{about}</article>"))
    found = {r.page_id: r.text for r in html.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(6):
        story = " ".join(f"w{n}x{i}" for i in range(20))
        assert found[n] == story and found[10 + n] == f"{story} {follow}"
