import html
import re

import pytest

from lakemart.llm.html_text import extract, main_text
from lakemart.llm.queries import op3_html

SF = "/root/testdata/sf0.01"


def test_whole_table_against_the_marked_article(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = op3_html(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inner = re.search("<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        plain = re.sub("</?b>", "", re.sub("</?(p|h1|br)>", " ", inner))
        assert r.text == " ".join(html.unescape(plain).split())
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))


BODY = "<p>First paragraph of the story with quite some words in it.</p><p>Second <i>par</i>agraph &amp; more words, as stories have.</p>"
TEXT = "First paragraph of the story with quite some words in it. Second paragraph & more words, as stories have."


@pytest.mark.parametrize("page", [
    f"<body><div id=menu><a href=1>Home</a> <a href=2>News</a></div><div class=story>{BODY}</div><div class='site-footer'>(c) us</div></body>",
    f"<body><main>{BODY}<form><input><button>Send</button></form></main><aside>Other things to read now</aside></body>",
    f"<article>{BODY}<section class=comments><p>{'I liked it. ' * 60}</p></section></article>",
    f"<body><form action=x><article>{BODY}</article></form><div class='cookie-notice'>We use cookies for this.</div>",
    f"<body><header><h1>Site</h1></header><article>{BODY}<script>var a='<p>no</p>'</script><style>p{{}}</style></article>",
    f"<body><article>{BODY}<ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></article>",
    f"<body><div><div>{BODY}</div></div><div style='display: none'>Hidden words here</div><nav><ul><li>x</ul></nav>",
])
def test_boilerplate_goes(page):
    assert main_text(page) == TEXT


def test_without_boilerplate_marks_density_decides():
    links = "".join(f"<div><a href={i}>Link {i}</a></div>" for i in range(30))
    assert main_text(f"<body><div>{links}</div><div>{BODY}</div><div>{links}</div></body>") == TEXT


def test_corner_cases(spark):
    rows = [(1, "u", None, "t"), (2, None, "", "t"), (None, "v", "<p>short", "t"), (3, "w", "<" * 3000, "t"),
            (3, "w", "<div>" * 3000 + "deep", "t"), (4, "x", "no markup at all", "t"), (5, "y", "<body></body>", "t"),
            (6, "z", "<p>" + "long words " * 50_000, "t")]
    got = extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    by = {(r.page_id, r.n_chars): r.text for r in got}
    assert len(got) == 8 and by[(1, 0)] == by[(2, 0)] == by[(5, 0)] == ""
    assert by[(None, 5)] == "short" and by[(3, 4)] == "deep" and by[(4, 16)] == "no markup at all"
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


MORE = "".join(f"<p>Paragraph {i} of the story goes on with some more words.</p>" for i in range(4))
ALL = f"{TEXT} " + " ".join(f"Paragraph {i} of the story goes on with some more words." for i in range(4))


@pytest.mark.parametrize("page, text", [
    (f"<article>{BODY}<h2 id='related-work'>Related work</h2>{MORE}</article>", ALL.replace(" Paragraph 0", " Related work Paragraph 0")),
    (f"<article>{BODY}<section id=search>{MORE}</section></article>", ALL),
    (f"<article><p class=notice>Mind this.</p>{BODY}{MORE}</article>", f"Mind this. {ALL}"),
    (f"<body><div class='content has-sidebar'>{BODY}{MORE}</div></body>", ALL),
    (f"<body><div class=sidebar>{BODY}{MORE}</div></body>", ALL),
    (f"<body><form action=x><div>{BODY}{MORE}</div></form></body>", ALL),
    (f"<article>{BODY}{MORE}<div class=related>Read this too</div></article>", ALL),
    (f"<main><article>{BODY}{MORE}</article><div class=comments><article class=comment><p>I liked it a lot.</p></article></div></main>", ALL),
    (f"<article>{BODY}{MORE}<article class='comment reply'><p>{'I liked it. ' * 60}</p></article></article>", ALL),
])
def test_names_take_no_article_text(page, text):
    assert main_text(page) == text


LONG = "".join(f"<p>Sentence {i} of another part, which has as many words as the first one.</p>" for i in range(4))
OTHER = " ".join(f"Sentence {i} of another part, which has as many words as the first one." for i in range(4))


@pytest.mark.parametrize("page, text", [
    (f"<main><article>{BODY}{MORE}</article><article>{LONG}</article></main>", f"{ALL} {OTHER}"),
    (f"<main><h1>Title</h1><article>{BODY}{MORE}</article></main>", f"Title {ALL}"),
    (f"<body><div><h1>Title</h1><div class=text>{BODY}{MORE}</div></div><div><a href=1>x</a> <a href=2>y</a></div></body>", f"Title {ALL}"),
    (f"<article>{BODY}<p>Let <math><mi>x</mi></math> hold.</p>{MORE}</article>", ALL.replace(" Paragraph 0", " Let x hold. Paragraph 0")),
    (f"<article>{BODY}{MORE}</article><div class=discussion><p>{'I liked it. ' * 60}</p></div>", ALL),
    (f"<main><article>{BODY}{MORE}</article><ul><li><a href=1>One</a><li><a href=2>Two</a><li><a href=3>Three</a></ul></main>", ALL),
])
def test_parts_beside_the_densest(page, text):
    assert main_text(page) == text


def test_deep_pages_take_linear_time():
    import time

    began = time.monotonic()
    assert main_text("<div>" * 100_000 + "deep") == "deep"
    assert main_text("<p><table><td>" + "<div>" * 50_000 + "deep" + "</i></div>" * 50_000) == "deep"
    assert time.monotonic() - began < 20


def test_densities_against_their_definition():
    """Counts by walking each subtree anew, densities from the published formula."""
    import math
    import random

    from lakemart.llm import html_text

    def build(rng, depth):
        tag = rng.choice(["div", "p", "a", "span", "ul"])
        inner = [rng.choice(["some words here ", "x", "", "  "]) if depth == 0 or rng.random() < 0.5 else build(rng, depth - 1)
                 for _ in range(rng.randint(0, 4))]
        return f"<{tag}>{''.join(inner)}</{tag}>"

    def nodes(n):
        return [c for c in n.children if not isinstance(c, str)]

    def chars(n, linked=False):
        if linked and n.tag == "a":
            return chars(n)
        own = 0 if linked else sum(len("".join(c.split())) for c in n.children if isinstance(c, str))
        return own + sum(chars(c, linked) for c in nodes(n))

    def tags(n, name=None):
        return sum((name is None or c.tag == name) + tags(c, name) for c in nodes(n))

    rng = random.Random(4)
    for _ in range(60):
        tree = html_text.Tree()
        tree.feed("<body>" + "".join(build(rng, 3) for _ in range(3)))
        tree.close()
        share = rng.random()
        for n in html_text._densities(tree.root, share):
            c, lc = chars(n), chars(n, True)
            t, lt = max(tags(n), 1), max(tags(n, "a") + (n.tag == "a"), 1)
            want = 0.0
            if c:
                base = math.log(math.log(c / max(c - lc, 1) * lc + share * c + math.e))
                want = c / t * max(math.log(c / max(lc, 1) * t / lt), 0.0) / max(base, 0.1)
            assert n.density == pytest.approx(want)
            assert n.total == pytest.approx(sum(x.density for x in nodes(n)))
