from __future__ import annotations

import numpy as np
import pytest

from tests.llm.tables import prose, with_strange_columns
from tradeloom.llm import extraction
from tradeloom.llm.html_blocks import Block, blocks

PAGE = "page_id long, url string, html string"


def page(i, main, title="The title of it"):
    menu = "".join(f"<li><a href=/{w}>{w}</a></li>" for w in prose(i, 5).split())
    return (
        f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{margin:0}}</style><script>var t='</p>';</script></head><body>"
        f"<nav><ul>{menu}</ul></nav><!-- ad --><div class='ad'>{prose(i + 1, 9)}.</div><article><h1>{title}</h1>"
        + "".join(f"<p>{m}" for m in main)
        + f"</article><footer>&copy; site &middot; {prose(i + 2, 9)}</footer></body></html>"
    )


def sample(n=40):
    return [(i, [f"{prose(50 * i + k, 30)}." for k in range(1 + i % 6)]) for i in range(n)]


@pytest.fixture(scope="module")
def labeller():
    return extraction.train([blocks(page(i, main)) for i, main in sample()])


def texts(markup):
    return [b.text for b in blocks(markup)]


@pytest.mark.parametrize(
    ("markup", "want"),
    [
        ("", []),
        ("plain  text\n here", ["plain text here"]),
        ("<p>a <b>b</b><i>c</i><br>d<p>e", ["a bc d", "e"]),
        ("<p>1 &lt; 2 &amp;&amp; x &#233;&eacute;&nbsp;y</p>", ["1 < 2 && x éé y"]),
        ("<p>a<script>if (1 < 2) '<p>x</p>'</script>b</p><style>x</style><!-- <p>no</p> -->c", ["a", "b", "c"]),
        ("<ul><li>one<li>two</ul>three", ["one", "two", "three"]),
        ("a < b and <3 c <", ["a < b and <3 c <"]),
        ("<div title='a > b'>x</div><br/><hr>y", ["x", "y"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p>never closed <b>bold", ["never closed bold"]),
        ("</p></div>x</b>", ["x"]),
        ("<textarea>typed</textarea><title>t</title><p>x", ["x"]),
        ("<script>open <p>x</p>", []),
    ],
)
def test_blocks(markup, want):
    assert texts(markup) == want


def test_paths_hold_tags_and_names():
    (one,) = blocks("<body><div class='Main content-box' id=top><p><a href=x>link</a> and</p></div>")
    assert one.path == (("body",), ("div", ".main", ".content", ".box", ".top"), ("p",)) and one.linked == 4


def test_known_and_strange_pages(labeller):
    rows = [(i, [f"{prose(9000 + 50 * i + k, 25)}." for k in range(1 + i % 4)]) for i in range(30)]
    pages = [blocks(page(700 + i, main)) for i, main in rows]
    for (_, main), own, keep in zip(rows, pages, extraction.labelled(labeller, pages)):
        assert [b.text for b, k in zip(own, keep) if k] == ["The title of it", *main]
    rng = np.random.default_rng(5)
    other = [extraction.altered(p, extraction.stated_labels(p), rng) for p in pages]
    found = extraction.labelled(labeller, [p for p, _ in other])
    right = np.mean([np.mean(f == (y > 0)) for f, (_, y) in zip(found, other)])
    assert right > 0.95


def test_gradient_is_that_of_the_loss():
    settings = extraction.Settings(hidden=3)
    model = extraction.Labeller.fresh(settings)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    rng = np.random.default_rng(0)
    sizes = np.array([4, 2])
    x = rng.standard_normal((4, 2, extraction.FIGURES + extraction.PATH + extraction.WORDS)).astype(np.float32)
    x[2:, 1] = 0
    y = np.array([[1, 0], [0, 1], [1, 0], [1, 0]], float)
    there = np.arange(4)[:, None] < sizes

    def loss():
        s = model.scores(x, sizes)
        return float(((np.logaddexp(0, s) - y * s) * there).sum() / there.sum())

    gradient = model.step(x, sizes, y)
    for name, g in gradient.items():
        for place in [tuple(rng.integers(n) for n in g.shape) for _ in range(6)]:
            kept, step = model.w[name][place], 1e-2
            model.w[name][place] = kept + step
            up = loss()
            model.w[name][place] = kept - step
            down = loss()
            model.w[name][place] = kept
            assert (up - down) / (2 * step) == pytest.approx(float(g[place]), abs=3e-3)


def test_extract_of_a_table(spark):
    rows = [(i, f"u{i}", page(i, main)) for i, main in sample()]
    rows += [(100, None, None), (101, "e", ""), (102, "s", "<html><body></body></html>"), (0, "u0", rows[0][2]), (None, "n", rows[1][2])]
    rows += [(103, "long", page(3, [prose(1, 30_000) + "."]))]
    frame = with_strange_columns(spark.createDataFrame(rows, PAGE), "text", "n_chars", "lang")
    out = extraction.extract(frame).collect()
    assert len(out) == len(rows)
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in out}
    for i, main in sample():
        text = "\n".join(["The title of it", *main])
        assert got[i] == (f"u{i}", text, len(text))
    assert got[100] == (None, "", 0) and got[101] == ("e", "", 0) and got[102] == ("s", "", 0)
    assert got[103][2] == len(got[103][1]) > 100_000
    assert sum(r["page_id"] == 0 for r in out) == 2 and got[None][1] == got[1][1]


@pytest.mark.parametrize("tag", ["svg", "select", "noscript", "template", "iframe", "textarea", "title", "object", "math"])
def test_an_element_without_end_loses_no_text(tag):
    assert [b.text for b in blocks(f"<p>a</p><{tag}><p>the rest</p><p>of it</p>")] == ["a", "the rest", "of it"]


def test_elements_that_are_skipped_may_be_nested():
    page = "<p>a</p><svg><text>x</text><svg><text>y</text></svg><!-- </svg> --><text>z</text></svg><p>b</p><svg/><p>c</p>"
    assert [b.text for b in blocks(page)] == ["a", "b", "c"]
    assert [b.text for b in blocks("<p>a <object>instead</object></p><math><mi>x</mi></math>")] == ["a", "instead", "x"]


def test_tables_of_long_pages_or_pages_without_id(spark):
    """They train on stretches of their blocks; never are blocks labelled by a network that was not trained."""
    mains = [[prose(40 * i + k, 900) + "." for k in range(14)] for i in range(4)]
    for ids, rows in (([1, 2, 3, 4], mains), ([None] * 4, [m[:1] for m in mains])):
        table = [(i, "u", page(n, main)) for n, (i, main) in enumerate(zip(ids, rows))]
        assert ids[0] is None or min(len(html) for _, _, html in table) > extraction.Settings().max_chars
        out = extraction.extract(spark.createDataFrame(table, PAGE)).collect()
        assert sorted(r["text"] for r in out) == sorted("\n".join(["The title of it", *main]) for main in rows)


def test_stretches_hold_the_edges_of_main_text():
    long = [Block((("nav",),), f"m{i}", 0) for i in range(300)] + [Block((("main",), ("p",)), f"t{i}" * 900, 0) for i in range(300)]
    cut = extraction.stretch(long, extraction.Settings(stretch=20))
    assert [b.text[:4] for b in cut] == [f"m{i}" for i in range(290, 300)] + [f"t{i}" * 2 for i in range(10)]
    assert max(len(b.text) for b in cut) == 1000
    assert [len(x) for x in extraction.labelled(None, [long, []])] == [600, 0]


def test_empty_table(spark):
    assert extraction.extract(spark.createDataFrame([], PAGE)).count() == 0
