"""Main text of pages: marks, host suffix arrays, brute force."""

import random
from collections import Counter, defaultdict

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.llm import html
from marketloom.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def marks(page):
    return [(t, m) for t, m in html.blocks(page)]


def test_blocks():
    a, f, o, m = html.ARTICLE, html.FURNITURE, html.OPEN, html.MAIN
    assert marks("plain &amp; simple") == [("plain & simple", o)]
    assert marks("<p><b>one<br><p>two &lt;b&gt;\n x</b> y<p>three") == [("one", o), ("two <b> x y", o), ("three", o)]
    assert marks("<nav><ul><li><a href='/x>y'>x</a><li>y</ul></nav>z") == [("x", f), ("y", f), ("z", o)]
    assert marks('<article><header><h1>T</h1></header><p>a<aside>b</aside>c<div class="ad">d</div></article>') == [
        ("T", a), ("a", a), ("b", f), ("c", a), ("d", f)
    ]
    assert marks("<main><p>x<section id=comments><article>y</article></section></main>") == [("x", m), ("y", f)]
    assert marks('<head><title>t</title><script>if (a<b) "</p>"</script><body>x<!-- <p>no</p> -->y') == [("xy", o)]
    assert marks('<p>a<script>b</script>c<svg><text>d</text></svg>e <span hidden>f</span>g') == [("ace g", o)]
    assert marks('<div style="display: none">a<p>b</div>c<form>d<input value=">">e</form>') == [("c", o), ("de", f)]
    assert marks('<div class="layout has-sidebar"><div class="cookie-notice">s</div><p>x</div>') == [("s", f), ("x", o)]
    assert marks("a<div>b</span>c</div></div>d<br/>e<hr>f") == [("a", o), ("bc", o), ("d e", o), ("f", o)]
    assert marks("1 < 2 <3 & &unknown; &#65;&#x42;&nbsp;x") == [("1 < 2 <3 & &unknown; AB x", o)]
    assert marks("") == [] and marks("<p> \n</p>") == [] and marks("<") == [("<", o)] and marks("<p") == []


def tokens(page):
    return [(w, m) for text, m in html.blocks(page or "") for w in text.split(" ")]


def brute(pages, window):
    """Main texts by counting windows on sets of pages."""
    hosts = defaultdict(lambda: defaultdict(set))
    streams = {}
    for no, (_, url, page) in enumerate(pages):
        streams[no] = tokens(page)
        host = url.split("://", 1)[1].split("/")[0].lower() if url and "://" in url else ""
        if host:
            words = [w for w, _ in streams[no]]
            for i in range(len(words) - window + 1):
                hosts[host][tuple(words[i : i + window])].add(tuple(words))
    out = []
    for no, (page_id, url, page) in enumerate(pages):
        words = [w for w, _ in streams[no]]
        ms = [m for _, m in streams[no]]
        host = url.split("://", 1)[1].split("/")[0].lower() if url and "://" in url else ""
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            if host and len(hosts[host][tuple(words[i : i + window])]) > 1 and set(ms[i : i + window]) != {html.ARTICLE}:
                gone[i : i + window] = [True] * window
        wanted = html.ARTICLE if html.ARTICLE in ms else html.MAIN if html.MAIN in ms else html.OPEN
        kept, at = [], 0
        for text, m in html.blocks(page or ""):
            n = len(text.split(" "))
            if m == wanted:
                left = [w for w, g in zip(text.split(" "), gone[at : at + n]) if not g or m == html.ARTICLE]
                if left:
                    kept.append(" ".join(left))
            at += n
        text = "\n\n".join(kept)
        repeated = sum(g and m != html.ARTICLE for g, m in zip(gone, ms))
        out.append((page_id, url, text, len(text), len(words), repeated))
    return Counter(out)


def site():
    """Pages of a few hosts whose furniture nothing marks, and odd pages."""
    rng = random.Random(3)
    p = lambda n: corpus.prose(rng, n)
    pages, no = [], 0
    for host, n in (("One.example.org", 30), ("two.example.org", 6), ("three.example.com", 1)):
        menu, foot, notice = p(9), p(12), p(20)
        for _ in range(n):
            body = "".join(f"<p>{p(rng.randint(1, 30))} é &amp; 中</p>" for _ in range(rng.randint(0, 4)))
            body = f"<div>{menu}</div><div>{body}</div><div>{notice if no % 2 else ''}</div><div>Page {no} {foot}</div>"
            if no % 5 == 0:
                body = f"<div>{menu}</div><article>{notice}<p>{p(15)}</article><div>{foot}</div>"
            if no % 7 == 0:
                body = f"<main>{body}</main> outside"
            pages.append((no, f"https://{host}/{no}", body))
            no += 1
    copy = pages[3][2]
    pages += [(100, "https://copies.example.org/1", copy), (101, "https://copies.example.org/2", copy)]
    pages += [
        (102, None, copy), (103, "no host", copy), (104, "https://one.example.org/x", None), (105, "https://one.example.org/y", ""),
        (None, "https://one.example.org/z", pages[1][2]), (None, None, None), pages[1], pages[1],
        (106, "https://two.example.org/long", "<p>" + p(20000) + "</p>"),
    ]
    return pages


@pytest.mark.parametrize("window", [8, 3])
def test_main_text(spark, monkeypatch, window):
    data = site()
    frame = spark.createDataFrame(data, SCHEMA).withColumns({"text": F.lit("clash"), "host": F.lit(1)}).repartition(4)
    want = brute(data, window)
    assert Counter(map(tuple, html.main_text(frame, window).collect())) == want
    monkeypatch.setattr(html, "STREAM_TOKENS", 50)
    monkeypatch.setattr(html, "FLUSH_WINDOWS", 30)
    assert Counter(map(tuple, html.main_text(frame, window).collect())) == want


def test_unmarked_furniture_goes(spark):
    """The suffix array alone tells an unmarked menu and footer from the text."""
    rng = random.Random(8)
    menu, foot = corpus.prose(rng, 12), corpus.prose(rng, 10)
    texts = {i: corpus.prose(rng, 40) for i in range(20)}
    data = [(i, "http://h/x", f"<div>{menu}</div><p>{t}</p><div>{foot}</div>") for i, t in texts.items()]
    got = html.main_text(spark.createDataFrame(data, SCHEMA)).collect()
    assert {r["page_id"]: r["text"] for r in got} == texts
    assert all(r["n_repeated"] == 22 for r in got)


def test_suffix_array():
    rng = np.random.default_rng(1)
    streams = []
    for page in range(12):
        t = rng.integers(0, 3, int(rng.integers(5, 40))).astype(np.uint64)
        streams.append((page % 2, page, t, np.arange(len(t) - 4)))
    d1, d2, least, greatest = html.repeated_substrings(streams, 5)
    got = dict(zip(zip(d1.tolist(), d2.tolist()), zip(least.tolist(), greatest.tolist())))
    want = defaultdict(list)
    for host, page, t, starts in streams:
        for key in zip(*(d.tolist() for d in html.digests(t, starts, host, 5))):
            want[key].append(page)
    assert got == {k: (min(v), max(v)) for k, v in want.items()}


def test_empty(spark):
    assert html.main_text(spark.createDataFrame([], SCHEMA)).collect() == []


def test_registered(spark, tmp_path):
    rng = random.Random(4)
    pages = [(i, f"https://a.example/{i}", f"<nav>x</nav><article><h1>T {i}</h1><p>{corpus.prose(rng, 30)}<p>y</article>") for i in range(9)]
    spark.createDataFrame(pages, SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    got = QUERIES["op13_html_extraction"](spark, str(tmp_path))
    assert [(f.name, f.dataType.simpleString()) for f in got.schema][:4] == [
        ("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")
    ]
    assert Counter(map(tuple, got.collect())) == brute(pages, html.WINDOW)
