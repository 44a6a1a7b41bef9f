"""Substring dedup and the Jaccard join against brute force."""

import hashlib
import random
import re
from collections import Counter

import corpus
import pytest
from pyspark.sql import functions as F

from marketloom.llm import jaccard, substrings
from marketloom.llm.components import connected_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def brute_substrings(data, window):
    seen = Counter()
    for _, text, *_ in data:
        w = words(text)
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for doc, text, *_ in data:
        w = words(text)
        hit = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                hit[i : i + window] = [True] * window
        kept = " ".join(x for x, h in zip(w, hit) if not h)
        out.append((doc, len(w), sum(hit), hashlib.sha256(kept.encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("window", [35, 10])
def test_substrings(spark, window):
    data = corpus.rows()
    got = substrings.remove_repeats(corpus.frame(spark), window).collect()
    assert Counter(tuple(r[:4]) for r in got) == brute_substrings(data, window)
    texts = {d: t for d, t, *_ in data if d is not None}
    for r in got:
        if r["doc_id"] is not None:
            if r["n_removed"] == 0:
                assert r["text"] == texts[r["doc_id"]]
            kept = " ".join(words(r["text"]))
            assert hashlib.sha256(kept.encode()).hexdigest() == r["kept_sha256"]


def test_salted_anchor(spark, monkeypatch):
    """Many contexts around one passage that is shorter than a window."""
    monkeypatch.setattr(substrings, "ANCHOR_SEGMENTS", 5)
    rng = random.Random(1)
    phrase = corpus.prose(rng, 20)
    data = [(i, f"{corpus.prose(rng, 30)} {phrase} {corpus.prose(rng, 30)}", None, None, 0) for i in range(60)]
    data += [(100 + i, data[i][1] + " more", None, None, 0) for i in range(5)]
    got = substrings.remove_repeats(corpus.frame(spark, data), 35).collect()
    assert Counter(tuple(r[:4]) for r in got) == brute_substrings(data, 35)


def test_one_passage_between_different_words(spark, monkeypatch):
    """No group grows with the number of documents that hold a passage."""
    monkeypatch.setattr(substrings, "ANCHOR_SEGMENTS", 5)
    largest = []
    marked = substrings._marked

    def spy(reference, window):
        key = [c for c in ("anchor", "salt") if c in reference.columns]
        largest.append(reference.groupBy(key).count().agg(F.max("count")).first()[0] or 0)
        return marked(reference, window)

    monkeypatch.setattr(substrings, "_marked", spy)
    rng = random.Random(6)
    passage = corpus.prose(rng, 60)
    data = [(i, f"{corpus.prose(rng, 20)} {passage} {corpus.prose(rng, 20)}", None, None, 0) for i in range(80)]
    data += [(100 + i, " ".join(words(data[i][1])[:70]), None, None, 0) for i in range(3)]
    got = substrings.remove_repeats(corpus.frame(spark, data), 35).collect()
    assert Counter(tuple(r[:4]) for r in got) == brute_substrings(data, 35)
    assert max(largest) <= 5


def test_spans_of_repeated_rows(spark, monkeypatch):
    """Repeated rows, with an id and without, add nothing to what is gathered."""
    largest = []
    marked = substrings._marked

    def spy(reference, window):
        largest.append(reference.groupBy("anchor").count().agg(F.max("count")).first()[0] or 0)
        return marked(reference, window)

    monkeypatch.setattr(substrings, "_marked", spy)
    rng = random.Random(7)
    passage = corpus.prose(rng, 60)
    text, other, third = (f"{corpus.prose(rng, 20)} {passage} {corpus.prose(rng, 20)}" for _ in range(3))
    data = [(1, text, None, None, 0)] * 30 + [(None, other, None, None, 0)] * 30 + [(2, third, None, None, 0)]
    docs = corpus.frame(spark, data)
    spans = substrings.repeated_spans(docs, 35).collect()
    assert len(spans) == 3
    for r in spans:
        assert len({tuple(s) for s in r["spans"]}) == len(r["spans"])
    assert largest == [3]  # three texts
    got = substrings.remove_repeats(docs, 35).collect()
    assert Counter(tuple(r[:4]) for r in got) == brute_substrings(data, 35)


def test_automaton_counts():
    rng = random.Random(3)
    for _ in range(30):
        texts = [[rng.randrange(3) for _ in range(rng.randint(1, 30))] for _ in range(4)]
        weights = [rng.randint(1, 2) for _ in texts]
        automaton = substrings.SuffixAutomaton()
        for t, w in zip(texts, weights):
            automaton.add(t, w)
        automaton.finish()
        for size in (2, 4, 7):
            seen = Counter()
            for t, w in zip(texts, weights):
                for i in range(len(t) - size + 1):
                    seen[tuple(t[i : i + size])] += w
            for t in texts:
                want = [i + size - 1 for i in range(len(t) - size + 1) if seen[tuple(t[i : i + size])] > 1]
                assert automaton.repeated_ends(t, size) == want


def test_long_texts_are_cut_into_blocks_alike():
    rng = random.Random(4)
    hashed = substrings.word_hashes(corpus.prose(rng, 3000).encode())
    whole = substrings.segments(hashed, 35, 8)
    assert int(whole[3].sum()) == 3000 - 34
    assert (whole[3] <= 28).all()


def brute_classes(data, k=5, percent=80):
    def shingles(text):
        w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        if len(w) < k:
            return frozenset([tuple(w)] if w else [])
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))

    sets = [shingles(t) for _, t, *_ in data]
    root = list(range(len(data)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, *_) in enumerate(data):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [
        (d[0], len(s), least.get(find(i)) if s else d[0]) for i, (d, s) in enumerate(zip(data, sets))
    ]


@pytest.mark.parametrize("percent", [80, 50])
def test_jaccard_classes(spark, percent):
    data = corpus.rows()
    got = jaccard.jaccard_classes(corpus.frame(spark), percent=percent).collect()
    assert Counter(map(tuple, got)) == Counter(brute_classes(data, percent=percent))


def test_large_group_of_near_copies(spark):
    rng = random.Random(9)
    base = corpus.prose(rng, 100).split()
    data = []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randint(0, 4)):
            copy[rng.randrange(len(copy))] = "w%d" % rng.randrange(10**6)
        data.append((i, " ".join(copy), None, None, 0))
    got = jaccard.jaccard_classes(corpus.frame(spark, data)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_classes(data))


def test_keep_one(spark):
    docs = corpus.frame(spark).withColumn("row", F.lit("clash")).withColumn("n", F.lit(7))
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    classes = brute_classes(corpus.rows())
    want = {c for _, n, c in classes if n} | {d for d, n, _ in classes if not n}
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(i for i in want if i is not None)
    assert ids.count(None) == 1  # the one without an id that is like no other


def test_empty(spark):
    empty = corpus.frame(spark, [])
    assert jaccard.jaccard_classes(empty).collect() == []
    assert substrings.remove_repeats(empty).collect() == []
    assert jaccard.keep_one(empty).collect() == []


def test_signature_bounds_the_intersection():
    import numpy as np

    rng = np.random.default_rng(2)
    for _ in range(50):
        pool = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
        a, b = (np.unique(rng.choice(pool, rng.integers(1, 200))) for _ in range(2))
        bits = [jaccard.signature(x).view(np.uint64) for x in (a, b)]
        most = jaccard.bound(np.array([len(a)]), np.array([len(b)]), bits[0][None, :], bits[1][None, :])[0]
        assert most >= len(np.intersect1d(a, b))


def test_components(spark):
    rng = random.Random(8)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges += [(100 + i, 101 + i) for i in range(40)]  # a long path
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {n: n for e in edges for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    assert got == {n: r for n, r in root.items() if any(n in e and e[0] != e[1] for e in edges)}


def test_null_and_text_do_not_share_a_name(spark):
    """(id = t, no text) and (no id, text = t) are two rows."""
    rng = random.Random(12)
    t = corpus.prose(rng, 60)
    data = [(t, None), (None, t), ("a", "head " + t), ("b", t + " tail"), (None, None), (t, None)]
    docs = spark.createDataFrame(data, "doc_id string, text string")
    got = substrings.remove_repeats(docs, 35).collect()
    assert Counter(tuple(r[:4]) for r in got) == brute_substrings(data, 35)
    got = jaccard.jaccard_classes(docs).collect()
    assert Counter(r["n_shingles"] for r in got) == Counter([0, 0, 0, 56, 57, 57])
    kept = jaccard.keep_one(docs).collect()
    assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter([(t, None), (None, None), ("a", "head " + t)])


def test_a_hot_tile_with_one_outsider():
    """The work is in proportion to the tile, not to its square."""
    import time

    import numpy as np

    n = 200_000
    rng = np.random.default_rng(3)
    tile = {
        "group": np.zeros(n, dtype=np.int64), "n": np.full(n, 100), "place": np.zeros(n, dtype=np.int64),
        "label": np.ones(n, dtype=np.int64), "home": np.ones(n, dtype=bool), "wide": np.ones(n, dtype=bool),
        "bits": rng.integers(0, 1 << 63, (n, 8), dtype=np.uint64),
    }
    tile["label"][77] = 5
    tile["bits"][78] = tile["bits"][77]
    at = time.time()
    found = [(int(i), int(j)) for a, b in jaccard.tile_pairs(tile, 80, False) for i, j in zip(a, b)]
    assert found == [(77, 78)] and time.time() - at < 5


def test_outsiders_meet_everything_once():
    import numpy as np

    rng = np.random.default_rng(5)
    for _ in range(20):
        n = int(rng.integers(2, 60))
        group = np.sort(rng.integers(0, 4, n))
        tile = {
            "group": group, "n": np.full(n, 10), "place": np.zeros(n, dtype=np.int64), "label": rng.integers(0, 4, n),
            "home": np.ones(n, dtype=bool), "wide": np.ones(n, dtype=bool), "bits": np.zeros((n, 8), dtype=np.uint64),
        }
        got = Counter((min(i, j), max(i, j)) for a, b in jaccard.tile_pairs(tile, 80, False) for i, j in zip(a.tolist(), b.tolist()))
        want = Counter((i, j) for j in range(n) for i in range(j) if group[i] == group[j] and tile["label"][i] != tile["label"][j])
        assert got == want


def test_tiles_over_many_batches(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK_SETS", 3)
    monkeypatch.setattr(jaccard, "FLUSH_PAIRS", 2)
    data = corpus.rows()
    got = jaccard.jaccard_classes(corpus.frame(spark)).collect()
    assert Counter(map(tuple, got)) == Counter(brute_classes(data))
