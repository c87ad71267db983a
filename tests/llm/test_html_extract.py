import random
import time
from collections import Counter

import numpy as np
import pytest

from fadeclust.llm import html_extract as H
from fadeclust.llm.boost import BoostedTrees
from fadeclust.llm.dom import parse

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def real():
    import pyarrow.parquet as pq
    return pq.read_table(f"{SF}/pages.parquet")["html"].to_pylist()


@pytest.fixture(scope="module")
def extractor(real):
    return H.Extractor(real[:100], 400, 12)


def test_tree():
    nodes, pieces = parse("<ul><li>a<li>b<p>c<p>d</ul><p>x <b>y<br>z<div>w</div><script>a<b</script><!-- <p> --> t<table><tr><td>1<td>2<tr><td>3</table>")
    tags = [(n.tag, nodes[n.parent].tag if n.parent >= 0 else None) for n in nodes]
    assert tags == [("#root", None), ("ul", "#root"), ("li", "ul"), ("li", "ul"), ("p", "li"), ("p", "li"), ("p", "#root"), ("b", "p"), ("br", "b"),
                    ("div", "#root"), ("script", "#root"), ("table", "#root"), ("tr", "table"), ("td", "tr"), ("td", "tr"), ("tr", "table"), ("td", "tr")]
    assert "a<b" not in [s for _, s in pieces]


@pytest.mark.parametrize("page", ["", "<", "a < b", "</p></div>", "<p", "<a href='x>y'>z</a>", "&amp;&lt;&#233;&bogus;", "<script>never ends", "<!-- open", "<p>" * 3000])
def test_odd_pages_parse(page, extractor):
    parse(page)
    assert isinstance(extractor.extract([page], {})[0], str)


LONG = {"open tags": "<a" * 500_000, "open declarations": "<!" * 500_000, "depth": "<div>" * 100_000 + "text", "one tag": "<a " + "x" * 2_000_000,
        "odd quotes": "<a " * 300_000 + '">', "quoted ends": '<a "x>" ' * 100_000 + "'>", "mixed quotes": "<a '\"" * 200_000 + ">",
        "inline": "<div>" + "<i>" * 50_000 + "</b>" * 50_000, "paragraphs": "<i>" * 50_000 + "<p>" * 50_000, "blanks": "<a" + " " * 1_000_000 + ">"}


@pytest.mark.parametrize("kind", sorted(LONG))
def test_long_odd_pages_take_linear_time(kind):
    start = time.perf_counter()
    nodes, pieces = parse(LONG[kind])
    assert time.perf_counter() - start < 10
    if kind in ("open tags", "open declarations", "one tag"):
        assert len(nodes) == 1 and "".join(s for _, s in pieces) == LONG[kind]


def test_deep_and_unfinished_pages_are_extracted(extractor):
    for kind in ("depth", "open tags", "one tag"):
        start = time.perf_counter()
        assert isinstance(extractor.extract([LONG[kind]], {})[0], str)
        assert time.perf_counter() - start < 10, kind


def test_quotes_and_ends():
    def read(page):
        nodes, pieces = parse(page)
        return [(n.tag, n.attrs) for n in nodes[1:]], "".join(s or "|" for _, s in pieces)
    assert read("<a t='x>y'>z</a>") == ([("a", " t='x>y'")], "z")
    assert read("<a t='x>y") == ([("a", " t='x")], "y")              # the quote never ends
    assert read("<b x=\"1>u</b><i>it's</i>") == ([("b", " x=\"1"), ("i", "")], "uit's")
    assert read("a <!-- <b> --> c <?x y?> d <!doctype q> e") == ([], "a  c  d  e")
    assert read("x > y < z <b") == ([], "x > y < z <b")


def brute_role(forest, logp):
    """Best allowed roles by trying all assignments of a small tree."""
    from itertools import product
    best, out = -np.inf, None
    allowed = {0: (0, 1, 2), 1: (1, 2), 2: (2,)}
    for roles in product(range(3), repeat=len(forest.parent)):
        if all(p < 0 or r in allowed[roles[p]] for r, p in zip(roles, forest.parent.tolist())):
            v = sum(logp[i, r] for i, r in enumerate(roles))
            if v > best:
                best, out = v, roles
    return best, out


def test_decoding_is_the_best_consistent_choice():
    rng = np.random.default_rng(1)
    for page in ("<div><p>a</p><p>b<i>c</i></p></div><ul><li>d</ul>", "<a><b><i><u><s>x</s></u></i></b></a>"):
        forest = H.Forest([page], {})
        for _ in range(20):
            logp = np.log(rng.dirichlet(np.ones(3), len(forest.parent)))
            role = forest.decode(logp)
            best, _ = brute_role(forest, logp)
            assert np.isclose(sum(logp[i, r] for i, r in enumerate(role)), best)


def test_boosting_learns_and_is_repeatable():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 5))
    y = np.where(x[:, 0] > 0.3, np.where(x[:, 3] > 0, 2, 1), 0)
    a, b = (BoostedTrees(rounds=10).fit(x[:1000], y[:1000], 3) for _ in range(2))
    assert (a.log_proba(x).argmax(1) == b.log_proba(x).argmax(1)).all()
    assert (a.log_proba(x[1000:]).argmax(1) == y[1000:]).mean() > 0.97
    assert np.allclose(np.exp(a.log_proba(x)).sum(1), 1)


def test_held_out_pages_and_layouts(real, extractor):
    test = real[100:]
    forest = H.Forest(test, {})
    truth = forest.texts(H.weak_labels(forest))
    got = extractor.extract(test, {})
    assert sum(a == b for a, b in zip(got, truth)) >= 0.99 * len(test)
    rnd = random.Random(77)
    prose = [p.replace("&", "&amp;").replace("<", "&lt;") for t in truth for p in t.split("\n") if p][:2000]
    pages = [H.make_layout(rnd, prose) for _ in range(200)]
    made = H.Forest(pages, {})
    truth = made.texts(H.marked_labels(made))
    got = made.texts(made.decode(extractor.trees.log_proba(made.features())))

    def f1(a, b):
        x, y = Counter(a.split()), Counter(b.split())
        n = sum(x.values()) + sum(y.values())
        return 2 * sum((x & y).values()) / n if n else 1.0
    assert np.mean([f1(a, b) for a, b in zip(got, truth)]) > 0.88


def test_named_boilerplate_goes(extractor):
    body = "".join(f"<p>Paragraph {i} of the story, with a few words &amp; commas, here.</p>" for i in range(5))
    page = ("<html><body><header><h1>Site name</h1><nav><ul><li><a href=/>Home</a><li><a href=/x>More</a></ul></nav></header>"
            "<div class='cookie-notice'>We use cookies. <button>OK</button></div><aside class=sidebar><h3>Related</h3><ul><li><a href=#>One</a></ul></aside>"
            f"<article><h2>Title\n of it</h2>{body}<div class=ad>Buy now.</div></article><section id=comments><div class=comment><b>Ann</b><p>I like this.</p></div></section>"
            "<form><label>Search</label><input></form><footer>&copy; Site.</footer></body></html>")
    got = extractor.extract([page], {})[0]
    assert got == "Title of it\n" + "\n".join(f"Paragraph {i} of the story, with a few words & commas, here." for i in range(5))


def test_frame(spark, real):
    rows = [(1, "u", real[0], "x"), (1, "u", real[0], "x"), (None, None, real[1], "x"), (2, "v", None, "x"), (3, "w", "", "x"), (4, "w", "<article><p>" + "long words " * 50000, "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(2)
    got = H.main_text(df, fit_pages=20, layouts=150).collect()
    by = {r.page_id: r.text for r in got}
    assert len(got) == 6 and by[2] == by[3] == "" and by[1] and by[4] == ("long words " * 50000).strip()
    assert H.main_text(df.limit(0)).count() == 0
