import html
import re

import pandas as pd

from widetab.llm import html_tree as H

from shared_fixtures import ready  # noqa: F401


def test_sample_pages_give_their_article(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r.page_id: r for r in H.main_text(pages).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)(</article>|$)", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*(>|$)", " ", re.sub("</?b>", "", x))).split())
                  for x in re.split(r"</?(?:p|h1)>", article)]
        want = "\n\n".join(x for x in blocks if x)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


PAGE = ('<body><header>Site</header><div class="x"><h1>T &amp; x</h1>lead<p>one<br>two <b>three</b><ul><li>a<li>b</ul><table><tr><td>c'
        '<td>d</table></div><section class="comments"><p>first!</p></section><div class="cookie-notice">ok</div>'
        '<p>end <span class="ad">buy</span>x<form><p>q</p></form><p style="display:none">h</p><script>var t="</p>";</script>'
        '<!-- <p>no</p> --><aside>s</aside><p hidden>z<p title="a>b">last &#233;&nbsp;y')


def test_noise_and_unclosed_tags():
    assert [b[1] for b in H.parse(PAGE)[0]] == ["T & x", "lead", "one two three", "a", "b", "c", "d", "end x", "last é y"]
    assert [b[1] for b in H.parse("<main><p>in</p></main><p>out</p>")[0]] == ["in"]
    assert [b[1] for b in H.parse("<article><header><h1>t</h1></header><p>x</p></article><header>n</header>")[0]] == ["t", "x"]
    assert H.parse("plain &lt; text <p class='")[0] == [("", "plain < text", 0)]
    assert H.parse("")[0] == []


def test_low_importance_branches_go(spark):
    rows = [(i, "http://h/x", f"<body><div class='top'><p>Share this page now</p></div><div class='c'><p>words {i} {i * 7}</p></div>")
            for i in range(20)]
    rows += [(100, "https://other/y", "<div class='top'><p>Share this page now</p></div><p>only page</p>")]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got[3] == "words 3 21" and got[100] == "Share this page now\n\nonly page"


def test_recurring_blocks_and_wrappers_leave_the_content(spark):
    rows = []
    for blocks in (1, 2, 3, 4, 5):
        for i in range(10):
            same = "".join(f"<div class='b{k}'><p>Standing block {k}</p></div>" for k in range(blocks))
            page = f"<html><body>{'<div class=w>' * (blocks * 4)}<div class='c'><p>words {blocks} {i}</p></div>{same}"
            rows.append((blocks * 100 + i, f"http://h{blocks}/x", page))
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {b * 100 + i: f"words {b} {i}" for b in (1, 2, 3, 4, 5) for i in range(10)}


def test_copies_of_an_article_keep_their_text(spark):
    page = lambda a, ad: f"<body><h1>Title {a}</h1><p>First of {a}</p><p>Second of {a}</p><div class='ad x{ad}'>buy</div>"
    rows = [(i, f"http://one/{i}", page("one", "a" * (i % 3 + 1))) for i in range(20)]
    rows += [(100 + i, f"http://ten/{i}", page(i % 10, "").replace("<body>", "<body><div class='top'><p>Share this</p></div>")) for i in range(400)]
    got = {r.page_id: r.text for r in H.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    want = lambda a: f"Title {a}\n\nFirst of {a}\n\nSecond of {a}"
    assert got == {i: want("one") for i in range(20)} | {100 + i: want(i % 10) for i in range(400)}


def test_importance_of_nodes():
    nodes = pd.DataFrame([("h", "body", 10, None, 0.0), ("h", "body>nav", 10, 1.0, None), ("h", "body>p", 10, 0.0, None)],
                         columns=["host", "path", "m", "text_entropy", "style_entropy"])
    got = dict(zip(nodes.path, H.importances(nodes).importance))
    assert got["body>nav"] == 0.0 and got["body>p"] == 1.0 and abs(got["body"] - 0.9 ** 2 * 0.5) < 1e-9


def test_odd_rows(spark):
    rows = [(None, None, None, "x", 1), (1, "", "", None, None), (2, "//Host.example/a", "<p>a</p>", "", 0), (2, "//Host.example/a", "<p>a</p>", "", 0),
            (3, "x", "<p>" + "word " * 100_000, "", 0), (4, "x", "<div>" * 3000 + "deep", "", 0)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, host int")
    got = H.main_text(pages).collect()
    assert len(got) == len(rows)
    assert sorted(r.n_chars for r in got) == [0, 0, 1, 1, 4, 499_999]
    assert H.main_text(pages.limit(0)).count() == 0
    assert H.host_of("HTTP://u@Host.example:80/a?b") == "host.example" and H.host_of(None) == ""


STORY = "<h1>Title</h1><p>The story is told here in a sentence of some length.</p><p>And it goes on for a while longer.</p>"
TOLD = ["Title", "The story is told here in a sentence of some length.", "And it goes on for a while longer."]


def texts(page):
    return [b[1] for b in H.parse(page)[0]]


def test_pages_that_speak_of_noise_keep_their_text():
    assert texts(f'<body><div class="page no-sidebar">{STORY}</div>') == TOLD
    assert texts(f'<body><div class="layout has-comments">{STORY}<div class="comments"><p>First!</p></div></div>') == TOLD
    assert texts(f'<body><article class="post share-enabled">{STORY}</article>') == TOLD
    assert texts(f'<body><form id="aspnetForm" action="x">{STORY}<div class="search"><p>Find</p></div></form>') == TOLD
    assert texts(f'<body><div class="widget-area sidebar-left">{STORY}</div><div class="menu"><p>Home</p></div>') == TOLD
    assert texts('<p>Do <b class="notice">not</b> open</p><p><a class="share">Share</a> <a class="comments">3</a></p>') == ["Do not open"]
    assert texts(f'<div class="story">{STORY}</div><div><article><p>Teaser card</p></article></div>') == [*TOLD, "Teaser card"]
    # Comments may be longer than the story, adverts may stand in a sentence.
    assert texts(f'<div>{STORY}</div><div class="comments">{"<p>I think so too, and so on.</p>" * 40}</div>') == TOLD
    assert texts('<p>end <span class="ad">buy</span>x</p>') == ["end x"]


def test_stray_quotes_end_no_text():
    assert texts('<p title="a"">Hello</p><p>there</p>') == ["Hello", "there"]
    assert texts("<p class=it's>Hello</p><p>there</p>") == ["Hello", "there"]
    assert texts('<p title = "a > b" data-x=\'c>d\' y=e"f>Hello</p><a href=x"y>there</a>') == ["Hello", "there"]


def test_deep_pages_stay_small_and_fast():
    import time
    began = time.time()
    for page in ("<div>" * 50_000 + "deep", "<div><p>a" * 20_000, "<div>" * 20_000 + "</section>" * 20_000 + "x",
                 "<div class='" + "very-long-name " * 2000 + "'>" * 50 + "<p>b"):
        blocks, elements = H.parse(page)
        assert sum(len(p) + len(k) for p, k in elements) + sum(len(b[0]) for b in blocks) < 60 * len(page) + 20_000
    assert time.time() - began < 20


def test_node_features_against_plain_python(spark):
    """Brute force of the style tree's entropies over distinct pages of a host."""
    import math
    from collections import Counter, defaultdict
    rows = []
    for i in range(30):
        ps = "".join(f"<p>{'same' if k % 2 else i % (k + 2)}</p>" for k in range(1 + i % 4))
        rows.append((i, f"http://h{i % 2}/x", f"<body><div class='a'>{ps}</div><ul><li>menu</ul>{'<div>t</div>' if i % 3 else ''}"))
    rows += rows[:7]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {(r.host, r.path): r for r in H.node_features(H.parsed_pages(pages)).collect()}
    want = {}
    for host in ("h0", "h1"):
        parsed = {str(H.parse(h)): H.parse(h) for _, u, h in rows if H.host_of(u) == host}.values()      # distinct pages
        texts_at, pages_at, styles_at = defaultdict(Counter), Counter(), defaultdict(Counter)
        for blocks, elements in parsed:
            for path in {b[0] for b in blocks}:
                pages_at[path] += 1
            for path, text, _ in blocks:
                texts_at[path][text] += 1
            shown = defaultdict(set)
            for path, kids in elements:
                shown[path].add(kids)
            for path, kids in shown.items():
                styles_at[path][tuple(sorted(kids))] += 1
        for path, c in texts_at.items():
            m = pages_at[path]
            value = sum(n * math.log(n) for n in c.values()) / math.log(m) / sum(c.values()) if m > 1 else 0.0
            want.setdefault((host, path), {})["text"] = min(1.0, value)
        for path, c in styles_at.items():
            m = sum(c.values())
            want.setdefault((host, path), {})["style"] = -sum(n / m * math.log(n / m) for n in c.values()) / math.log(m) if m > 1 else 1.0
    assert set(got) == set(want)
    for k, w in want.items():
        for name, value in (("text", got[k].text_entropy), ("style", got[k].style_entropy)):
            assert (value is None) == (name not in w) and (value is None or abs(value - w[name]) < 1e-9)
