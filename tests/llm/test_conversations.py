"""The prefix trie against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from marketloom.llm import conversations
from marketloom.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows, heads=True):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [t[3:] for t in sorted(ts)] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if heads else 0
        base = int(c - (abs(c) % 100) * (1 if c >= 0 else -1))
        built[c] = own.get(base, [])[:h] + ts[h:]
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = Counter(), Counter()
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(m) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in m if len(built[c]) == len(node))
        out.append((
            m[0], len(node), members[node[:-1]][0] if node else None, len(m), len(kids[node]), leaves[node],
            saved[node], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return Counter(out)


def sample(n=260, seed=1):
    rng = random.Random(seed)
    shared = [("user", "same start"), ("assistant", "same answer é中"), ("user", "same again"), (None, None)]
    rows = []
    for c in [*range(n), -5, -100, -203, 10**12, 777]:
        length = rng.choice([1, 1, 2, 3, 5, 8, 30 if c % 50 == 0 else 4])
        turns = list(shared[: rng.randint(0, 4)]) if c % 3 else []
        turns += [(rng.choice(["user", "assistant", None]), rng.choice(["a", "b", "", None, "long " * 300])) for _ in range(length)]
        for i, (role, text) in enumerate(turns):
            rows.append((c, i, role, text))
    rows += [(3, None, "user", "before all"), (3, 1, "user", "tie"), (3, 1, "system", "tie"), (None, 0, "user", "nobody")]
    rows += [(900, 0, "user", "x"), (900, 0, "user", "x"), (205, 0, "user", "only one")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("convs,rows", [(4000, 50000), (40, 300), (1, 1), (300, 60)])
def test_trie(spark, convs, rows):
    data = sample()
    frame = spark.createDataFrame(data, SCHEMA).withColumns({"conv": F.lit("clash"), "depth": F.lit(9)}).repartition(5)
    got = conversations.conversation_trie(frame, conversations.with_heads, convs, rows)
    assert Counter(map(tuple, got.collect())) == brute(data)


def test_plain_trie_and_one_giant(spark):
    """One conversation with most rows, and two equal ones, over many ranges."""
    rng = random.Random(2)
    long = [(rng.choice("ab"), str(i)) for i in range(400)]
    data = [(c, i, r, t) for c in (1, 2) for i, (r, t) in enumerate(long)]
    data += [(5, i, r, t) for i, (r, t) in enumerate(long[:50] + long[:20])]
    data += [(10 + c, 0, "a", "0") for c in range(30)]
    frame = spark.createDataFrame(data, SCHEMA)
    got = conversations.conversation_trie(frame, shard_convs=5, shard_rows=30)
    assert Counter(map(tuple, got.collect())) == brute(data, heads=False)


def test_copies_in_packs(spark, monkeypatch):
    monkeypatch.setattr(conversations, "PACK_IDS", 7)
    data = [(c, i, "user", f"turn {i}") for c in range(200) for i in range(2)]
    got = conversations.conversation_trie(spark.createDataFrame(data, SCHEMA), shard_convs=10)
    assert Counter(map(tuple, got.collect())) == brute(data, heads=False)


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert conversations.conversation_trie(empty, conversations.with_heads).collect() == []
    nobody = spark.createDataFrame([(None, 1, "a", "b")], SCHEMA)
    assert conversations.conversation_trie(nobody).collect() == []


def test_registered(spark, tmp_path):
    data = sample(60, 3)
    spark.createDataFrame(data, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op11_conversation_trie"](spark, str(tmp_path))
    assert [(f.name, f.dataType.simpleString()) for f in got.schema] == [
        (n, "string" if n == "ends_sha256" else "bigint") for n in
        ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    ]
    assert Counter(map(tuple, got.collect())) == brute(data)
