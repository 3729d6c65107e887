import pytest

from kerbside.llm import html_text
from kerbside.llm.html_blocks import blocks
from kerbside.llm.html_pages import labelled


@pytest.fixture(scope="module")
def field():
    return html_text.default_field()


LONG = "Seven boats left the harbour before dawn, and only five of them came back in the evening."
PAGES = [
    (f"<html><head><title>No</title><script>if (a < b) x('<p>no</p>')</script></head><body><nav><a href='/'>Home</a></nav><article><h1>Boats</h1>"
     f"<p>{LONG}<p>Second &amp; last,\n  with   space<br>and a break.</article><div class='comments'><p>{LONG}</p></div><footer>&copy; us</footer></body></html>",
     f"Boats\n{LONG}\nSecond & last, with space and a break."),
    (f"<body><div id='cookie-banner'>We use cookies on this site to make it work.</div><div class='content'><h1>A title</h1><p>{LONG}</p>"
     f"<div class='advert'>Buy our {LONG}</div><ul><li>First point of it</li><li>Second point of it</li></ul></div><aside>Read also {LONG}</aside></body>",
     f"A title\n{LONG}\nFirst point of it\nSecond point of it"),
    (f"<main><article><h1>Title here</h1><p>{LONG}</p><p>Sh&#111;rt.</p></article></main><form><label>Your name</label><p>{LONG}</p></form>",
     f"Title here\n{LONG}\nShort."),
    ("", ""),
    (None, ""),
    ("<div><span>", ""),
]


@pytest.mark.parametrize("page,text", PAGES)
def test_pages(field, page, text):
    assert html_text.main_text(page, field) == text


def test_unseen_layouts(field):
    right = total = 0
    for found, labels in labelled(200, seed=123):
        got = field.decode(html_text.features(found))
        right += sum(a == b for a, b in zip(got, labels, strict=True))
        total += len(labels)
    assert right / total > 0.99


def test_viterbi_equals_all_paths():
    from itertools import product
    from random import Random

    rng = Random(1)
    for _ in range(50):
        f = html_text.Field({str(i): rng.uniform(-3, 3) for i in range(9)}, 0.1, [[rng.uniform(-2, 2) for _ in "ab"] for _ in "ab"])
        names = [[str(rng.randrange(9)) for _ in range(2)] for _ in range(6)]
        s = f.scores(names)
        best = max(product((0, 1), repeat=6), key=lambda y: sum(a * b for a, b in zip(s, y)) + sum(f.pairs[a][b] for a, b in zip(y, y[1:])))
        assert f.decode(names) == list(best)


def test_forward_backward_equals_all_paths():
    from itertools import product

    import numpy as np

    s, pairs = np.array([0.3, -1.0, 2.0, 0.1]), np.array([[0.5, -0.2], [0.1, 0.9]])
    paths = list(product((0, 1), repeat=4))
    w = np.array([np.exp(sum(s[t] * y[t] for t in range(4)) + sum(pairs[a, b] for a, b in zip(y, y[1:]))) for y in paths])
    p, both = html_text._expected(s, pairs)
    assert np.allclose(p, [sum(w[i] for i, y in enumerate(paths) if y[t]) / w.sum() for t in range(4)])
    assert np.isclose(both.sum(), 3)


def test_broken_markup_ends():
    nested = "<div>" * 2000 + "text" + "<p" * 500
    assert [b.text[:4] for b in blocks(nested)] == ["text"]
    assert blocks("<a title='never closed>" * 300) is not None
    assert [b.text for b in blocks("a < b and c > d <!-- open")] == ["a < b and c > d"]
    assert [b.text for b in blocks("<table><tr><td>1<td>2<tr><td>3</table>x")] == ["1", "2", "3", "x"]


@pytest.mark.parametrize("tag", ["svg", "object", "canvas", "template"])
def test_an_element_without_its_end_tag_does_not_take_the_page(field, tag):
    page = f"<body><article><h1>Boats</h1><{tag} class='x'>no<title>no</title><i>no</i><p>{LONG}</p><p>{{}}{LONG}</p></article></body>"
    assert html_text.main_text(page.format(""), field) == f"Boats\n{LONG}\n{LONG}"
    closed = f"<{tag}><{tag}><p>no</p></{tag}><p>no</p></{tag}><{tag}/>"
    assert html_text.main_text(page.format(closed), field) == f"Boats\n{LONG}\n{LONG}"
    assert [b.text for b in blocks(f"<{tag}>" * 20000 + "<p>text")] == ["text"]
    assert blocks(f"<p>a<{tag}>b") and blocks("<p>a</p><script>b<p>c")[-1].text == "a"


def test_table(spark):
    rows = [(i, f"u{i}", p) for i, (p, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "'x' as n_chars")
    got = sorted((g.page_id, g.url, g.text, g.n_chars) for g in html_text.extract(pages).collect())
    assert got == sorted((i, u, t, len(t)) for (i, u, _), t in zip(rows, [t for _, t in PAGES] + [PAGES[0][1]], strict=True))
    assert html_text.extract(pages.limit(0)).collect() == []
