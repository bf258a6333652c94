import math
import os
from functools import reduce

import duckdb
import numpy as np
import pytest

from ledgerflow.llm import block_ann, core, mixing, wrapper_html

from .helpers import awkward_texts, table


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, score string, payload string")


def brute(rows, k):
    usable = [(i, np.array(v, np.float32).astype(float)) for i, v, *_ in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    out = {}
    for q, a in usable:
        if q % 20 == 0:
            near = sorted((-reduce(lambda t, p: t + float(p[0]) * float(p[1]), zip(a, b), 0.0), i) for i, b in usable if i != q and len(b) == len(a))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


def test_nearest_equals_brute_force(spark, monkeypatch):
    core.ship(spark)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), 0, "x", "y") for i in range(150)]
    rows += [(200 + i, rows[3][1], 0, "x", "y") for i in range(30)]  # ties
    rows += [(300, None, 0, "x", "y"), (320, [0.0] * 8, 0, "x", "y"), (340, [1.0, None] * 4, 0, "x", "y"), (360, [math.nan] * 8, 0, "x", "y"), (380, [math.inf] * 8, 0, "x", "y")]
    rows += [(400, [1.0, 2.0], 0, "x", "y"), (401, [1e-30, 2e-30], 0, "x", "y"), (None, [1.0] * 8, 0, "x", "y"), (420, [1e20] * 8, 0, "x", "y")]
    monkeypatch.setattr(block_ann, "CANDIDATE_BLOCK", 40)
    monkeypatch.setattr(block_ann, "QUERY_BLOCK", 4)
    monkeypatch.setattr(block_ann, "_COLS", 16)
    got = {}
    for r in block_ann.nearest(vectors(spark, rows)).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == {q: v for q, v in brute(rows, 20).items() if v}
    assert block_ann.nearest(vectors(spark, [])).count() == 0


def test_error_bound_holds():
    rng = np.random.default_rng(0)
    a = rng.normal(size=(50, 16)) * np.exp(rng.normal(size=(50, 1)) * 3)
    small, scale, norm, loss = block_ann.quantise(a)
    near = (small.astype(float) @ small.astype(float).T) * scale[:, None] * scale[None]
    assert (np.abs(a @ a.T - near) <= norm[:, None] * loss[None] + loss[:, None] * (norm + loss)[None] + 1e-9).all()


def test_mixing_equals_duckdb(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", 5)
    texts = awkward_texts() * 3
    docs = table(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((tuple(r) for r in mixing.op7_mixing(spark, str(tmp_path)).collect()), key=str)
    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert got == sorted(duck.sql(mixing._sql()).fetchall(), key=str)
    out = mixing.mix(docs)
    assert out.schema == docs.schema and out.count() == sum(r[6] for r in got) and all(r[6] >= 1 for r in got)


def test_mixing_reaches_its_target(spark):
    rows = [(i, "w " * 50, "big") for i in range(300)] + [(1000 + i, "w " * 50, "mid") for i in range(60)] + [(2000 + i, "w " * 50, "small") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    plan = {r.source: r for r in mixing.plan(mixing.keyed(docs, "doc_id", "source", "text"), flatten=0.5, max_repeats=100).collect()}
    p = np.array([300, 60, 20]) / 380
    w = np.array([plan[s].weight for s in ("big", "mid", "small")])
    entropy = lambda x: -(x * np.log(x)).sum()
    assert entropy(w) == pytest.approx((entropy(p) + math.log(3)) / 2, abs=1e-9)
    limited = mixing.plan(mixing.keyed(docs, "doc_id", "source", "text"), flatten=1.0, max_repeats=4).collect()
    assert max(r.repeats for r in limited) == pytest.approx(4, abs=1e-6)
    mixed = {r.source: r["count"] for r in mixing.mix(docs, max_repeats=100).groupBy("source").count().collect()}
    assert mixed["big"] == 300 and all(abs(mixed[s] / mixed["big"] - plan[s].weight / plan["big"].weight) < 0.01 for s in mixed)
    assert mixing.mix(docs.limit(0)).count() == 0
    assert mixing.mix(table(spark, [None, "", None])).count() == 3  # no tokens at all


def test_a_pass_takes_each_document_once(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), ("a", "b", None)[i % 3]) for i in range(600)] + [(None, "w", "a")] * 50, "doc_id long, text string, source string")
    rows = mixing.keyed(docs, "doc_id", "source", "text")
    got = mixing.ordered(mixing.copies(rows, mixing.plan(rows))).collect()
    assert len(got) == 650
    for source in ("a", "b", None):
        mine = [r for r in got if r.source == source]
        by_place = {}
        for r in mine:
            by_place.setdefault(r.position, []).append(r)
        assert sum(p + len(rs) in by_place or p + len(rs) == len(mine) for p, rs in by_place.items()) == len(by_place)  # no gap
        order = [rs[0] for _, rs in sorted(by_place.items())]
        assert [(r.block_key, r.doc_key) for r in order] == sorted((r.block_key, r.doc_key) for r in order)
        assert [r.copies for r in order] == sorted((r.copies for r in order), reverse=True)  # the prefix gives one copy more


def test_many_sources_of_equal_size_are_one_entry(spark):
    tokens = [5] * 400 + [7] * 300 + [1000] * 2 + [0] * 3
    sources = spark.createDataFrame([(f"s{i}", t) for i, t in enumerate(tokens)], "source string, tokens long")
    row = mixing.totals(sources).first()
    assert row.total == sum(tokens) and [tuple(e) for e in row.t] == [(5, 400), (7, 300), (1000, 2)]
    p = np.array([t for t in tokens if t]) / sum(tokens)
    entropy = lambda x: -(p**x / (p**x).sum() * np.log(p**x / (p**x).sum())).sum()
    found = mixing.exponent(sources, 0.5, 1000.0).first()
    assert entropy(found.x) == pytest.approx((entropy(1) + math.log(len(p))) / 2, abs=1e-9)
    assert found.norm == pytest.approx((p**found.x).sum()) and found.top == pytest.approx(p.max()) and found.total == sum(tokens)


def test_mixing_stays_native(spark):
    plan = mixing.ordered(mixing.copies(mixing.keyed(table(spark, ["a b"]), "doc_id", "source", "text"), mixing.plan(mixing.keyed(table(spark, ["a b"]), "doc_id", "source", "text"))))
    assert not any(x in plan._jdf.queryExecution().toString() for x in ("Python", "Arrow", "Pandas"))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body><nav><ul><li><a href="/a">menu {i}</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><article><header><h1>Title &amp; {i}</h1><p class=byline>drop me</p></header><p>First  <b>bold
para {i}<br>two<p>Second &lt;para&gt; {i}<p>shared line</p><div class="ad">buy</div><form><p>mail</p></form>
<section class="comments"><p>nice {i}</p></section></article><aside>related</aside><footer>&copy; x</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, host string, body string, wrapper string")


def test_main_text(spark):
    core.ship(spark)
    plain = "<html><body><div id=top>Logo</div><div class=box><p>Always here</p><p>Story {i} is long enough to be the content of this page</p><p>More of {i}</p></div><div>Imprint</div></body></html>"
    rows = [(i, f"http://a.example/{i}", PAGE.format(i=i), "h", "b", "w") for i in range(6)]
    rows += [(100 + i, f"https://B.example:80/{i}", plain.format(i=i), "h", "b", "w") for i in range(6)]
    rows += [(200, "http://a.example/x", None, "h", "b", "w"), (201, None, "", "h", "b", "w"), (202, "nonsense", "just text &am", "h", "b", "w")]
    rows += [(203, "http://c.example/", "<article><p>cut off &amp; do", "h", "b", "w"), (None, "http://c.example/", "</p></div><p>x<script>if (a < b) {}", "h", "b", "w")]
    got = {r.page_id: r for r in wrapper_html.main_text(pages(spark, rows)).collect()}
    assert len(got) == len(rows)
    for i in range(6):
        assert got[i].text == f"Title & {i}\nFirst bold para {i} two\nSecond <para> {i}\nshared line"
        assert got[100 + i].text.endswith(f"Story {i} is long enough to be the content of this page\nMore of {i}") and "Logo" not in got[100 + i].text and "Imprint" not in got[100 + i].text
    assert [got[k].text for k in (200, 201, 202, 203, None)] == ["", "", "just text &am", "cut off & do", "x"]
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert wrapper_html.main_text(pages(spark, [])).count() == 0


def test_the_content_slot_is_taken_whole(spark):
    core.ship(spark)
    story = lambda i, k: " ".join(f"w{i}x{j}" for j in range(k))
    frame = "<html><body><div id=top>Logo</div><div class=box>{}</div><div>Imprint</div></body></html>"
    several = lambda i: f"<article><h1>One {i}</h1><p>{story(i, 60)}</p><p>shared</p></article><section><p>between {i}</p></section><article><h2>Two {i}</h2><p>{story(i, 40)}</p></article>"
    teaser = lambda i: f"<article><h3>Our magazine</h3><p>Read it every week</p></article><div><h1>Story {i}</h1><p>{story(i, 60)}</p></div><p>{story(i, 40)} end</p>"
    run = lambda i: "".join(f"<article>{story(i * 10 + j, 20)}</article>" for j in range(3))
    kinds = (several, teaser, run)
    rows = [(100 * k + i, f"http://k{k}.example/{i}", frame.format(make(i)), "h", "b", "w") for k, make in enumerate(kinds) for i in range(6)]
    got = {r.page_id: r.text for r in wrapper_html.main_text(pages(spark, rows)).collect()}
    for i in range(6):
        assert got[i] == f"One {i}\n{story(i, 60)}\nshared\nbetween {i}\nTwo {i}\n{story(i, 40)}"
        assert got[100 + i] == f"Story {i}\n{story(i, 60)}\n{story(i, 40)} end"
        assert got[200 + i] == "\n".join(story(i * 10 + j, 20) for j in range(3))


def test_anchors_inside_content_are_kept(spark):
    core.ship(spark)
    story = lambda i, k: " ".join(f"w{i}x{j}" for j in range(k))
    inside = lambda i: (
        f'<section id="related-work"><h2 id="search-methods">Methods {i}</h2><p id="notice">{story(i, 40)}</p></section><div id="form-factor"><p class="header-files">files {i}</p></div>'
        f'<div class="ad">buy {i}</div><div id="comments"><p>nice {i}</p></div><div class="related-posts">more {i}</div><div role="search">find {i}</div><p hidden>gone {i}</p><p class="cookie-notice">cookies {i}</p>')
    frames = ('<article id="notice-period">{}</article>', '<div class=box>{}</div>')
    rows = [(100 * k + i, f"http://k{k}.example/{i}", f'<html><body><div id="site-header">Logo {i}</div>{frame.format(inside(i))}<div class="page-footer-2">Imprint {i}</div></body></html>', "h", "b", "w")
            for k, frame in enumerate(frames) for i in range(6)]
    got = {r.page_id: r.text for r in wrapper_html.main_text(pages(spark, rows)).collect()}
    assert len(got) == 12 and all(t == f"Methods {k % 100}\n{story(k % 100, 40)}\nfiles {k % 100}" for k, t in got.items())


def tree_of(nested):
    """Arrays of a tree given as (label, children)."""
    tree = wrapper_html.Tree([], [], [], [], [], [])

    def add(node):
        at = len(tree.label)
        for column, value in zip(tree, (node[0], False, False, 0, 0, 1)):
            column.append(value)
        for child in node[1]:
            add(child)
        tree.size[at] = len(tree.label) - at

    add(nested)
    return tree


def largest_match(a, b):
    """Nodes in the largest order-preserving match of two trees, tried one child after the other."""
    if a[0] != b[0]:
        return 0

    def lists(x, y):
        return max(lists(x[1:], y), lists(x, y[1:]), largest_match(x[0], y[0]) + lists(x[1:], y[1:])) if x and y else 0

    return 1 + lists(a[1], b[1])


def test_tree_matching_is_the_largest():
    import random

    draw = random.Random(5)

    def grow(depth):
        return (draw.choice("xyz"), tuple(grow(depth - 1) for _ in range(draw.randrange(4))) if depth else ())

    for _ in range(300):
        x, y = grow(2), grow(2)
        a, b = tree_of(x), tree_of(y)
        pairs = wrapper_html.align(a, b)
        assert len(pairs) == largest_match(x, y)
        assert len({n for n, _ in pairs}) == len({r for _, r in pairs}) == len(pairs)
        assert all(a.label[n] == b.label[r] for n, r in pairs)
        assert all((n < m) == (r < s) and (m < n + a.size[n]) == (s < r + b.size[r]) for n, r in pairs for m, s in pairs if n < m)
    assert wrapper_html.align(tree_of(("ul", ())), tree_of(("p", ()))) == []


def test_deep_and_long_pages(spark):
    core.ship(spark)
    frame = "<html><body><div id=top>Logo</div><div class=box>{}</div><div>Imprint</div></body></html>"
    story = lambda i, k: " ".join(f"w{i}x{j}" for j in range(k))
    deep = lambda i: "<div>" * 5000 + "<b>" * 3000 + story(i, 30) + "</b>" * 3000 + "</div>" * 5000
    long = lambda i: "".join(f"<div><h2>{i} {j}</h2>{f'<ul><li>x{i}</ul>' * (i * j % 4)}<p>y{i} {j}</p></div>" for j in range(4000))
    rows = [(100 * k + i, f"http://k{k}.example/{i}", frame.format(make(i)), "h", "b", "w") for k, make in enumerate((deep, long)) for i in range(5)]
    got = {r.page_id: r.text for r in wrapper_html.main_text(pages(spark, rows)).collect()}
    for i in range(5):
        assert got[i] == story(i, 30)
        assert got[100 + i] == "\n".join(b for j in range(4000) for b in [f"{i} {j}", *[f"x{i}"] * (i * j % 4), f"y{i} {j}"])


def test_extraction_over_the_test_pages(spark):
    import html
    import re

    core.ship(spark)
    sf = "/root/testdata/sf0.01"
    source = {r.page_id: r.html for r in core.read(spark, sf, "pages").collect()}
    for r in wrapper_html.op9_wrapper_html(spark, sf).collect():
        article = re.search(r"<article>(.*?)(?:</article>|$)", source[r.page_id], re.S).group(1)
        blocks = [re.sub(r"[\x20\x09-\x0D]+", " ", html.unescape(re.sub(r"</?b>|<br>", " " if "<br>" in x else "", x).replace("<br>", " "))).strip(" ") for x in re.split(r"</?(?:p|h1)>", article)]
        assert r.text.split() == " ".join(blocks).split()


def test_shipped_package_is_complete():
    assert os.path.exists(os.path.join(os.path.dirname(core.__file__), "queries.py"))
