"""HTML extraction: block reading, the field's arithmetic, and held-out pages."""

import html
import itertools
import re

import numpy as np
from tripgauge.llm import htmlcrf, htmltraining
from tripgauge.llm.htmlblocks import blocks, features
from tripgauge.llm.queries import op5_html_extraction

SF = "/root/testdata/sf0.001"


def test_blocks_of_untidy_markup():
    page = """<!DOCTYPE html><title>T</title><body class=home><p><b>One &amp; two<br>three<p>Four <i>five</i>&nbsp; six<ul><li><a href=x>a<li>b</ul>
    <script>var p = "</p><p>no</p>";</script><!-- <p>no</p> --><div id="sideBar">x<style>p{}</style> y</div><td>&lt;p&gt; &#233; &copy;<p>&am</body> tail"""
    found = blocks(page)
    assert [b.text for b in found] == ["T", "One & two three", "Four five six", "a", "b", "x y", "<p> é ©", "&am", "tail"]
    assert [b.linked > 0 for b in found] == [False, False, False, True, False, False, False, False, False]
    assert "name side" in features(found)[5] and "name bar" in features(found)[5]
    assert blocks("") == [] and blocks("<p></p>") == [] and blocks("<p") [0].text == "<p"
    assert blocks("<!-- x")[:1] == [] and blocks("<script>x") == []


def test_decode_and_expectations_match_enumeration():
    rng = np.random.default_rng(3)
    model = htmlcrf.Crf({"a": 0, "b": 1, "c": 2}, rng.normal(size=(3, 2)), rng.normal(size=(2, 2)), rng.normal(size=2))
    found = [["a"], ["b", "c"], ["c", "unknown"], ["a", "b"], ["b"]]
    score = np.array([[sum(model.weights[model.index[f], y] for f in names if f in model.index) for y in (0, 1)] for names in found])

    def total(y):
        return model.first[y[0]] + sum(score[t, v] for t, v in enumerate(y)) + sum(model.pairs[a, b] for a, b in zip(y, y[1:]))

    ways = list(itertools.product((0, 1), repeat=5))
    assert model.decode(found) == [bool(v) for v in max(ways, key=total)]
    weight = np.exp([total(y) for y in ways])
    weight /= weight.sum()
    live = np.array([[True] * 5 + [False] * 2])
    once, twice = model._expected(np.pad(score, ((0, 2), (0, 0)))[None], live)
    want = np.array([[sum(w for w, y in zip(weight, ways) if y[t] == v) for v in (0, 1)] for t in range(5)])
    assert np.allclose(once[0, :5], want) and np.allclose(once[0, 5:], 0)
    pairs = np.zeros((2, 2))
    for w, y in zip(weight, ways):
        for a, b in zip(y, y[1:]):
            pairs[a, b] += w
    assert np.allclose(twice, pairs)


def test_held_out_pages():
    model = htmlcrf.default_model()
    right = total = 0
    for page, labels in htmltraining.pages(250, 4321):
        got = model.decode(features(blocks(page)))
        right += sum(a == b for a, b in zip(got, labels))
        total += len(labels)
    assert right / total > 0.985, right / total


def article(page):
    inner = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", p))).strip() for p in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(p for p in parts if p)


def test_op5_on_the_table(spark):
    want = {r.page_id: (r.url, article(r.html)) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    out = op5_html_extraction(spark, SF).collect()
    assert len(out) == len(want)
    assert all((r.url, r.text, r.n_chars) == (*want[r.page_id], len(want[r.page_id][1])) for r in out)


def test_rows_nulls_long_pages_and_clashes(spark):
    long = "<article>" + "<p>Some words, and more of them here.</p>" * 20000 + "</article>"
    rows = [(1, None, "x"), (2, "", "x"), (3, long, "x"), (3, long, "x"), (4, "<nav><a href=a>menu</a></nav>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    out = htmlcrf.extract_main_text(pages).collect()
    by = {r.page_id: r.text for r in out}
    assert len(out) == 5 and by[1] == "" and by[2] == "" and by[4] == "" and by[3].count("\n") == 19999
    assert htmlcrf.extract_main_text(pages.limit(0)).count() == 0


def test_deeply_nested_pages_in_bounded_memory():
    import time
    import tracemalloc

    model = htmlcrf.default_model()
    pages = {"open": "<div>x" * 100_000, "named": "".join(f"<div class='n{i} m{i}'>x" for i in range(20_000)), "unclosed items": "<div>" * 50_000 + "<li>x</ul>" * 50_000,
             "stray ends": "<div>x</p></section>" * 50_000, "links": "<ul>" + "<li><a href=x>y" * 50_000}
    for name, page in pages.items():
        htmlcrf.main_text("<p>warm", model)
        tracemalloc.start()
        begin = time.time()
        htmlcrf.main_text(page, model)
        found = blocks(page, model.names)
        assert len(found) >= 20_000 and tracemalloc.get_traced_memory()[1] < 300 << 20 and time.time() - begin < 60, name
        tracemalloc.stop()
