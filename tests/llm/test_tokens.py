"""Token counts, packing and sharding."""

import random
import zlib
from collections import Counter, defaultdict

import corpus
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from marketloom.llm import packing, sharding, token_counts

ODD = [
    "I'll don't café. ÉCOLE!! école?' <|endoftext|> x<|y 12½ ﬁn a b ''s' #$% a,b c., ,",
    "<|ENDOFTEXT|>. \x1c a\x85b 𝒳 ẞß ŒU'RE é é.  x İstanbul ΑΣ naïve", "", "\n \t",
]


def ids_of(texts):
    t = Tokenizer.from_file(public_tokenizers.path(packing.VOCABULARY))
    return [[*e.ids, 2] for e in t.encode_batch(texts, add_special_tokens=False)]


def test_encoder_equals_the_tokenizer():
    texts = ODD + [t for _, t, *_ in corpus.rows() if t is not None]
    for remember in (10**6, 3):
        got = packing.Encoder(remember=remember)([t.encode() for t in texts])
        assert [g.tolist() for g in got] == ids_of(texts)


def test_packing(spark):
    data = corpus.rows()
    got = packing.pack_documents(corpus.frame(spark), bucket_pieces=20).collect()
    ids = ids_of([t or "" for _, t, *_ in data])
    want = Counter()
    for (doc, *_), own in zip(data, ids):
        for s in range(0, len(own), 4096):
            piece = np.array(own[s : s + 4096], dtype="<u4")
            want[(doc, s, len(piece), zlib.crc32(piece.tobytes()), len(own))] += 1
    assert Counter(tuple(r[:5]) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_repeated_rows_fill_many_buckets(spark):
    data = [(None, None, None, None, None)] * 200 + [(5, "same text", None, None, 9)] * 200
    got = packing.pack_documents(corpus.frame(spark, data), bucket_pieces=20).collect()
    assert Counter((r["doc_id"], r["length"]) for r in got) == {(None, 1): 200, (5, len(ids_of(["same text"])[0])): 200}
    assert max(Counter(r["sequence_id"] % 20 for r in got).values()) <= 60


def test_best_fit_takes_the_tightest_window():
    rng = random.Random(2)
    lengths = sorted((rng.randint(1, 100) for _ in range(300)), reverse=True)
    free: list[int] = []
    for length, (window, offset) in zip(lengths, packing.best_fit_decreasing(lengths, 100)):
        fits = [c for c in free if c >= length]
        if not fits:
            assert window == len(free) and offset == 0
            free.append(100 - length)
        else:
            assert free[window] == min(fits) and offset == 100 - free[window]
            free[window] -= length
    assert 9 * len(free) * 100 <= 11 * sum(lengths) + 900


def test_sequences(spark):
    docs = corpus.frame(spark)
    pieces = packing.cut_tokens(docs)
    plan = packing.pack(pieces)
    built = packing.sequences(pieces, plan).collect()
    assert all(len(r["ids"]) == 4096 for r in built)
    total = sum(len(x) for x in ids_of([t or "" for _, t, *_ in corpus.rows()]))
    assert sum(sum(1 for i in r["ids"] if i) for r in built) >= total - sum(
        x.count(0) for x in ids_of([t or "" for _, t, *_ in corpus.rows()])
    )


@pytest.mark.parametrize("shards", [1, 7])
def test_sharding(spark, shards):
    data = corpus.rows()
    got = sharding.shard_by_bytes(corpus.frame(spark), shards, partitions=3).collect()
    size = lambda t: len((t or "").encode()) + 8
    want = Counter((d, size(t), zlib.crc32((t or "").encode())) for d, t, *_ in data)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r["shard"]].append(r)
    assert set(held) <= set(range(shards))
    most = max(r["size"] for r in got)
    for rows in held.values():
        assert sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - sum(r["size"] for r in got) / shards) <= 2 * most


def test_sharding_ignores_the_partitions(spark):
    one = sharding.shard_by_bytes(corpus.frame(spark), 5, partitions=1).collect()
    many = sharding.shard_by_bytes(corpus.frame(spark), 5, partitions=6).collect()
    assert Counter((r["doc_id"], r["shard"]) for r in one) == Counter((r["doc_id"], r["shard"]) for r in many)


def brute_counts(text, sections, rule):
    t = token_counts.tokens(None)
    ends, owner, first = t.ends(text).tolist(), Counter(), 0
    lengths = np.cumsum([0] + [len(c.encode()) for c in text]).tolist()
    spans = [(lengths[min(a, len(text))], lengths[min(b, len(text))]) for a, b in sections]
    for end in ends:
        inside = [len(range(max(first, a), min(end, b))) for a, b in spans]
        if rule == "start":
            hit = [i for i, (a, b) in enumerate(spans) if a <= first < b]
        elif rule == "end":
            hit = [i for i, (a, b) in enumerate(spans) if a <= end - 1 < b]
        else:
            hit = [inside.index(max(inside))] if inside and max(inside) else []
        owner[hit[0] if hit else -1] += 1
        first = end
    return owner


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_given_sections(spark, rule):
    rng = random.Random(rule)
    data, texts = [], {}
    for i, text in enumerate([*ODD, *(t for _, t, *_ in corpus.rows()[4:30] if t)]):
        cuts = sorted(rng.sample(range(len(text) + 5), min(len(text) + 5, 8)))
        sections = list(zip(cuts[::2], cuts[1::2])) + ([(cuts[-1], cuts[-1] + 2)] if cuts else [])
        data.append((i, text, [{"start": a, "end": b} for a, b in sections]))
        texts[i] = (text, sections)
    data += [(900, None, [{"start": 0, "end": 4}]), (901, "text", None)]
    frame = spark.createDataFrame(data, "doc_id long, text string, parts array<struct<start:int,end:int>>")
    got = defaultdict(Counter)
    for r in token_counts.section_tokens(frame, sections_col="parts", rule=rule).collect():
        got[r["doc_id"]][r["section"]] += r["n_tokens"]
    for i, (text, sections) in texts.items():
        assert +got[i] == brute_counts(text, sections, rule), (i, text)
    assert got[900] == {0: 0} and got[901] == {-1: 1}


def test_lines_hold_all_tokens(spark):
    got = Counter()
    for r in token_counts.section_tokens(corpus.frame(spark)).collect():
        got[r["doc_id"]] += r["n_tokens"]
    t = token_counts.tokens(None)
    want = Counter()
    for doc, text, *_ in corpus.rows():
        want[doc] += len(t.ends(text or ""))
    assert got == +want


def test_empty(spark):
    empty = corpus.frame(spark, [])
    assert packing.pack_documents(empty).collect() == []
    assert sharding.shard_by_bytes(empty, 4).collect() == []
    assert token_counts.section_tokens(empty).collect() == []
