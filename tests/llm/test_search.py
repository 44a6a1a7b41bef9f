"""Ranked search against brute force."""

import math
import random
import re
from collections import Counter

import corpus
import numpy as np
from pyspark.sql import functions as F

from marketloom.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    held = [(d, Counter(terms(t))) for d, t, *_ in docs if terms(t)]
    n_docs, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, ts in wanted.items():
        found = []
        for doc, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in ts if t in c
            )
            if score > 0:
                found.append((-score, doc is None, doc, score))
        found.sort()
        out += [(item, i + 1, doc, score) for i, (_, _, doc, score) in enumerate(found[:k])]
    return Counter(out)


def items_of(data):
    rng = random.Random(3)
    out = [(i, " ".join((t or "").split()[3:40])) for i, (_, t, *_) in enumerate(data) if i % 4 == 0]
    out += [(900, None), (901, ""), (902, "..."), (903, "notfound"), (None, data[8][1]), (0, "again WORD loop"),
            (904, corpus.prose(rng, 300) + " é 中文 loop x y")]
    return out


def test_ranked(spark, monkeypatch):
    data = corpus.rows()
    items = spark.createDataFrame(items_of(data), "item_id long, text string").withColumn("doc_id", F.lit("clash"))
    docs = corpus.frame(spark).withColumn("item_id", F.lit(1)).withColumn("rank", F.lit("clash"))
    want = brute(data, items_of(data))
    got = search.rank_documents(docs, items)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "int", "bigint", "bigint"]
    assert Counter(map(tuple, got.collect())) == want
    # small shards, many blocks of items
    monkeypatch.setattr(search, "SHARD_DOCS", 5)
    monkeypatch.setattr(search, "SLICE", 2)
    got = search.rank_documents(docs, items, block_terms=1500)
    assert Counter(map(tuple, got.collect())) == want


def test_many_equal_documents(spark):
    """A group of copies ties at the end of the list: the least ids stay."""
    data = [(i, "alpha beta gamma" if i % 3 else f"other words here {i}", None, None, 0) for i in range(300)]
    items = [(1, "beta alpha"), (2, "here words 33")]
    got = search.rank_documents(corpus.frame(spark, data), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute(data, items)


def test_stops_early_and_exactly():
    rng = np.random.default_rng(4)
    saved = 0
    for _ in range(40):
        docs, vocabulary = 2000, 6
        rows = sorted({(int(d), int(t)) for d, t in zip(rng.integers(0, docs, 5000), rng.integers(0, vocabulary, 5000))})
        owner, term = (np.array(c, dtype=np.int32) for c in zip(*rows))
        impact = np.floor(rng.pareto(1.0, len(rows)) * 100).astype(np.int64)
        shard = search.Shard(owner, term, impact, vocabulary)
        wanted = sorted(rng.choice(vocabulary, 3, replace=False).tolist())
        got, scores, met = shard.best(wanted, 5)
        total = Counter()
        for d, t, v in zip(owner.tolist(), term.tolist(), impact.tolist()):
            if t in wanted:
                total[d] += v
        want = sorted(((-v, d) for d, v in total.items() if v > 0))[:5]
        assert [(-s, d) for d, s in zip(got.tolist(), scores.tolist())] == want
        saved += met < len(total)
    assert saved > 20


def test_empty(spark):
    items = spark.createDataFrame([(1, "word")], "item_id long, text string")
    assert search.rank_documents(corpus.frame(spark, []), items).collect() == []
    assert search.rank_documents(corpus.frame(spark), items.limit(0)).collect() == []


def test_very_long_text(spark):
    rng = random.Random(2)
    data = [(1, corpus.prose(rng, 200000), None, None, 0), (2, "abc " * 30, None, None, 0), (3, "needle", None, None, 0)]
    items = [(1, "needle abc"), (2, corpus.prose(rng, 20000))]
    got = search.rank_documents(corpus.frame(spark, data), spark.createDataFrame(items, "item_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute(data, items)
