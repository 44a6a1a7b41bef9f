"""Prefix trie of conversations from vertical bitmaps.

Conversations are sequences of turns (role, text).  A node of the trie is a distinct
sequence of first turns; its members are the conversations that start with it.

1. Turns are numbered within their conversation by a global sort, so that a
   conversation of any length is spread over tasks, and reduced to 128-bit
   digests.  ``with_heads`` may rebuild conversations from a shared base.
2. The digests of (place, turn) are summed by exclusive or along a conversation,
   again over global ranges: equal sums are equal prefixes.  Per prefix, members
   and rows below it are counted in sums that merge.  Prefixes with more than
   ``SHARD_CONVS`` members or ``SHARD_ROWS`` rows below, and the root, are the top
   of the trie.  A shard is a prefix just below the top with all its members.
3. Inside a shard, each (place, turn) has a bitset of conversations.  Depth first,
   a node's bitset is cut with the posting of the next turn of its lowest
   conversation, which gives the child's bitset, then with that of the lowest one left,
   and so on: children, popcounts, the list of those that end, and, on the way
   back, sums over the subtree.
4. The top's sums come from the roots of the shards: an item (a shard's root or a
   node of the top) counts on the path of its least member, from its depth upwards.

Ids of conversations that end at one node are hashed in order; at the top they
are packed by range first, and one task streams the packs of a node (a hash over a
sequence cannot be split).

Nulls: a null turn number sorts first, a null role or text is empty, a row without
conversation id belongs to no conversation.  Ties in the turn number are ordered
by the MD5 digest of ``turn_digest``.  Repeated rows are turns of their own.  Empty
tables have no node, not even a root.  Very long texts are digested, very long
conversations are spread over ranges.  Only the four columns are read, so extra
columns of any name do no harm."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.common import broadcast_if_small
from marketloom.llm.jaccard import by_group
from marketloom.operators.ranking import number_within, positions
from marketloom.sources.tables import write_scratch

#: Conversations and rows of one shard.
SHARD_CONVS = 250
SHARD_ROWS = 2_000
#: Ids in one pack; rows handed on at a time.
PACK_IDS = 10_000
FLUSH_ROWS = 10_000

#: Conversations that share a base, and the most turns taken from it.
GROUP, HEAD_TURNS = 100, 5

EMPTY_SHA = hashlib.sha256(b"").hexdigest()
NODE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)


def turn_digest(role: Column, text: Column) -> Column:
    """MD5 of the role's length in characters, a colon, the role and the text."""
    return F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))


def numbered_turns(turns: DataFrame) -> DataFrame:
    """(conv, pos, tie, chars): turns from 1 within each conversation, written."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    narrow = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"), F.col("turn").alias("turn"),
        turn_digest(role, text).alias("tie"), F.char_length(text).cast("long").alias("chars"),
    )
    numbered = number_within(narrow, "conv", ["turn", "tie"], "pos")
    return write_scratch(numbered.select("conv", F.col("pos").cast("long").alias("pos"), "tie", "chars"), "turns")


def as_they_are(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, depth, tie, chars, len) of every turn, and (conv, len)."""
    lengths = numbered.groupBy("conv").agg(F.max("pos").alias("len"))
    rows = numbered.join(lengths, "conv").select("conv", F.col("pos").alias("depth"), "tie", "chars", "len")
    return rows, lengths


def with_heads(numbered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """As ``as_they_are``, for conversations that start with the first turns of
    the base of their hundred, in place of as many turns of their own."""
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % (HEAD_TURNS + 1)
    bases = numbered.filter((F.col("conv") % GROUP == 0) & (F.col("pos") <= HEAD_TURNS)).groupBy(
        F.col("conv").alias("base")
    ).agg(F.sort_array(F.collect_list(F.struct("pos", "tie", "chars"))).alias("turns"))
    convs = numbered.groupBy("conv").agg(F.max("pos").alias("n")).withColumns({
        "h": head, "base": F.col("conv") - F.col("conv") % GROUP,
    }).join(bases, "base", "left").select(
        "conv", "n", "h",
        F.slice(F.coalesce("turns", F.array().cast("array<struct<pos:bigint,tie:string,chars:bigint>>")), F.lit(1), F.col("h").cast("int"))
        .alias("head"),
    ).withColumn("len", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    convs = write_scratch(convs, "heads")
    taken = convs.select("conv", "len", F.explode("head").alias("t")).select(
        "conv", F.col("t.pos").alias("depth"), "t.tie", "t.chars", "len"
    )
    own = numbered.filter(F.col("pos") > head).join(
        convs.select("conv", "len", (F.size("head") - F.col("h")).alias("shift")), "conv"
    ).select("conv", (F.col("pos") + F.col("shift")).alias("depth"), "tie", "chars", "len")
    return taken.union(own), convs.select("conv", "len")


def _prefix_keys(rows: DataFrame) -> DataFrame:
    """Adds ``k1``, ``k2``, the name of the sequence up to each row, and ``s1``, ``s2``,
    what the row itself adds to it; written."""
    salted = rows.withColumns({
        "s1": F.when(F.col("depth") > 0, F.xxhash64("depth", "tie")).otherwise(0),
        "s2": F.when(F.col("depth") > 0, F.xxhash64(F.lit(1), F.col("depth"), F.col("tie"))).otherwise(0),
    }).drop("tie")
    columns = ["conv", "depth", "chars", "len", "s1", "s2"]
    placed = salted.select(columns).repartitionByRange("conv", "depth").sortWithinPartitions(
        "conv", "depth"
    ).withColumn("pid", F.spark_partition_id())

    def run(batches):
        last, carry = None, (np.int64(0), np.int64(0))
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column("conv").to_numpy()
            new = np.r_[conv[0] != last, conv[1:] != conv[:-1]]
            first = np.maximum.accumulate(np.where(new, np.arange(len(conv)), -1))
            sums, rest = [], []
            for name, before in zip(("s1", "s2"), carry):
                x = batch.column(name).to_numpy()
                total = np.bitwise_xor.accumulate(x)
                base = np.where(first > 0, total[first - 1], np.int64(0))  # what came before the run
                base = np.where(first < 0, before, base)
                sums.append(total ^ base)
                rest.append(sums[-1][-1])
            last, carry = conv[-1], tuple(rest)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(s) for s in sums)], [*batch.schema.names, "x1", "x2"]
            )

    summed = write_scratch(placed.mapInArrow(
        run, "conv long, depth long, chars long, len long, s1 long, s2 long, pid int, x1 long, x2 long"
    ), "prefixes")
    # one row per range: what its first conversation had before
    ends = summed.groupBy("pid").agg(
        F.min("conv").alias("first"), F.max("conv").alias("last"),
        F.max_by(F.struct("x1", "x2"), F.struct("conv", "depth")).alias("tail"),
    )
    same = Window.partitionBy("last").orderBy("pid")
    ends = ends.select(
        "pid", "first", "last",
        F.bit_xor("tail.x1").over(same).alias("r1"), F.bit_xor("tail.x2").over(same).alias("r2"),
    )
    by_pid = Window.orderBy("pid")
    goes_on = F.lag("last").over(by_pid) == F.col("first")
    ends = ends.select(
        "pid", "first", *[F.when(goes_on, F.lag(f"r{i}").over(by_pid)).otherwise(0).alias(f"o{i}") for i in (1, 2)]
    )
    offset = lambda i: F.when(F.col("conv") == F.col("first"), F.col(f"o{i}")).otherwise(0)
    return summed.join(F.broadcast(ends), "pid").select(
        *columns, *[F.col(f"x{i}").bitwiseXOR(offset(i)).alias(f"k{i}") for i in (1, 2)]
    )


def _bits(bitset: int):
    while bitset:
        low = bitset & -bitset
        yield low.bit_length() - 1
        bitset ^= low


def trie_nodes(convs: list[int], turns: list[list[tuple]], depth: int, above: int) -> list[list]:
    """Nodes (as in NODE) of conversations that share their first turn, given by
    ascending id; ``turns`` are (symbol, characters), the first of them at ``depth``."""
    postings: dict[tuple, int] = {}
    ends: dict[int, int] = {}
    for i, path in enumerate(turns):
        for place, (symbol, _) in enumerate(path):
            postings[place, symbol] = postings.get((place, symbol), 0) | 1 << i
        ends[len(path) - 1] = ends.get(len(path) - 1, 0) | 1 << i
    nodes: list[list] = []
    parents: list[int] = []
    waiting = [((1 << len(convs)) - 1, 0, above, -1)]
    while waiting:
        members, place, parent, parent_no = waiting.pop()
        least = (members & -members).bit_length() - 1
        ended = members & ends.get(place, 0)
        ids = ",".join(str(convs[i]) for i in _bits(ended))
        n, children, rest = members.bit_count(), 0, members ^ ended
        while rest:
            lowest = (rest & -rest).bit_length() - 1
            child = rest & postings[place + 1, turns[lowest][place + 1][0]]
            rest ^= child
            children += 1
            waiting.append((child, place + 1, convs[least], len(nodes)))
        nodes.append([
            convs[least], depth + place, parent, n, children, int(not children),
            (n - 1) * turns[least][place][1], hashlib.sha256(ids.encode()).hexdigest() if ids else EMPTY_SHA,
        ])
        parents.append(parent_no)
    for no in range(len(nodes) - 1, 0, -1):  # a parent comes before its children
        nodes[parents[no]][5] += nodes[no][5]
        nodes[parents[no]][6] += nodes[no][6]
    return nodes


def _shards(rows: DataFrame) -> DataFrame:
    """NODE and, for a shard's root, its parent's name (p1, p2)."""
    schema = NODE + ", p1 long, p2 long"
    names = [c.split()[0] for c in schema.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in schema.split(", ")]

    def batch_of(nodes):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*nodes), types)], names)

    def run(batches):
        out = []
        for rows in by_group(batches, ["g1", "g2"], lambda rows: [rows]):
            convs, turns = [], []
            for r in rows:
                if not convs or convs[-1] != r["conv"]:
                    convs.append(r["conv"])
                    turns.append([])
                turns[-1].append(((r["s1"], r["s2"]), r["chars"]))
            nodes = trie_nodes(convs, turns, rows[0]["depth"], rows[0]["above"])
            out += [[*n, None, None] for n in nodes]
            out[-len(nodes)][-2:] = rows[0]["p1"], rows[0]["p2"]
            if len(out) >= FLUSH_ROWS:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    placed = rows.repartition("g1", "g2").sortWithinPartitions("g1", "g2", "conv", "depth")
    return placed.mapInArrow(run, schema)


def _end_hashes(ends: DataFrame) -> DataFrame:
    """(k1, k2, ends_sha256) from (k1, k2, conv)."""

    def packed(batches):
        key, ids = None, []

        def pack():
            return pa.RecordBatch.from_arrays(
                [pa.array([x], t) for x, t in zip((*key, ids[0], ",".join(map(str, ids))), 3 * [pa.int64()] + [pa.string()])],
                ["k1", "k2", "first", "ids"],
            )

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "conv"))):
                if ids and (row[:2] != key or len(ids) >= PACK_IDS):
                    yield pack()
                    ids = []
                key = row[:2]
                ids.append(row[2])
        if ids:
            yield pack()

    def hashed(batches):
        key, state, done = None, None, []
        for batch in batches:
            for k1, k2, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (k1, k2) == key:
                    state.update(b",")
                else:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256()
                state.update(ids.encode())
        if key:
            done.append((*key, state.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], ["k1", "k2", "ends_sha256"])

    packs = ends.repartitionByRange("conv").sortWithinPartitions("k1", "k2", "conv").mapInArrow(
        packed, "k1 long, k2 long, first long, ids string"
    )
    return packs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "first").mapInArrow(
        hashed, "k1 long, k2 long, ends_sha256 string"
    )


def _below(paths: DataFrame, roots: DataFrame) -> DataFrame:
    """(k1, k2, n_leaves, saved_tokens) of the top: ``paths`` are rows of the top
    with what their node adds (leaf, saved) where the row's conversation is its least."""
    shards = roots.select(
        F.col("conv_id").alias("conv"), F.col("n_leaves").alias("below_leaves"), F.col("saved_tokens").alias("below_saved")
    )
    # conversations with an item; the shard's root counts at the deepest row
    owning = paths.filter("own").select("conv").union(shards.select("conv")).distinct()
    rows = paths.join(owning, "conv").join(shards, "conv", "left").withColumns({
        "up": -F.col("depth"),
        "leaves": F.col("leaf") + F.when(F.col("deepest"), F.coalesce("below_leaves", F.lit(0))).otherwise(0),
        "saves": F.col("saved") + F.when(F.col("deepest"), F.coalesce("below_saved", F.lit(0))).otherwise(0),
    }).select("conv", "up", "k1", "k2", "leaves", "saves")
    order = ["conv", "up"]
    rows = positions(rows, order, "leaves", "leaves").withColumnRenamed("before", "b_leaves")
    rows = positions(rows, order, "saves", "saves").withColumnRenamed("before", "b_saves")
    rows = write_scratch(rows, "below")
    starts = rows.groupBy("conv").agg(F.min("b_leaves").alias("f_leaves"), F.min("b_saves").alias("f_saves"))
    return rows.join(starts, "conv").groupBy("k1", "k2").agg(
        F.sum(F.col("leaves") + F.col("b_leaves") - F.col("f_leaves")).alias("n_leaves"),
        F.sum(F.col("saves") + F.col("b_saves") - F.col("f_saves")).alias("saved_tokens"),
    )


def conversation_trie(
    turns: DataFrame, rebuild=as_they_are, shard_convs: int | None = None, shard_rows: int | None = None,
) -> DataFrame:
    """One row (NODE) per node of the trie of ``turns`` (conv_id, turn, role, text)."""
    most_convs, most_rows = shard_convs or SHARD_CONVS, shard_rows or SHARD_ROWS
    rows, lengths = rebuild(numbered_turns(turns))
    root_rows = lengths.select(
        "conv", F.lit(0).cast("long").alias("depth"), F.lit("").alias("tie"), F.lit(0).cast("long").alias("chars"), "len"
    )
    keyed = write_scratch(_prefix_keys(rows.select(root_rows.columns).union(root_rows)), "keyed")
    key = ["k1", "k2"]
    top = keyed.groupBy(*key, "depth").agg(
        F.count("*").alias("n"), F.min("conv").alias("least"), F.sum(F.col("len") - F.col("depth") + 1).alias("rows"),
        F.max("len").alias("longest"), F.max("chars").alias("node_chars"), F.max("s1").alias("t1"), F.max("s2").alias("t2"),
    ).filter((F.col("depth") == 0) | (F.col("n") > most_convs) | (F.col("rows") > most_rows))
    top = write_scratch(top, "top")
    flagged = keyed.join(
        broadcast_if_small(top.select(*key, "n", "least", "longest", "node_chars")), key, "left"
    )
    flagged = write_scratch(flagged, "flagged")
    is_top = F.col("n").isNotNull()
    borders = write_scratch(flagged.groupBy("conv").agg(
        F.max(F.when(is_top, F.struct("depth", "least", "k1", "k2"))).alias("deep"),
        F.min(F.when(~is_top, F.struct("depth", "k1", "k2"))).alias("root"),
    ), "borders")
    below = flagged.filter(~is_top).select("conv", "depth", "chars", "s1", "s2").join(
        borders.filter("root is not null").select(
            "conv", F.col("root.k1").alias("g1"), F.col("root.k2").alias("g2"), F.col("deep.least").alias("above"),
            F.col("deep.k1").alias("p1"), F.col("deep.k2").alias("p2"),
        ), "conv",
    )
    shards = write_scratch(_shards(below), "shards")
    roots = shards.filter("p1 is not null")

    own = F.col("conv") == F.col("least")
    paths = flagged.filter(is_top).join(
        borders.select("conv", F.col("deep.depth").alias("deepest")), "conv"
    ).select(
        "conv", "depth", *key, own.alias("own"), (F.col("depth") == F.col("deepest")).alias("deepest"),
        F.when(own & (F.col("longest") == F.col("depth")), 1).otherwise(0).alias("leaf"),
        F.when(own, (F.col("n") - 1) * F.col("node_chars")).otherwise(0).alias("saved"),
    )
    sums = _below(paths, roots)
    parent = [F.col(f"k{i}").bitwiseXOR(F.col(f"t{i}")).alias(f"p{i}") for i in (1, 2)]
    top = top.select("*", *parent)
    children = roots.select("p1", "p2").union(top.filter("depth > 0").select("p1", "p2")).groupBy(
        F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("n_children"))
    ended = _end_hashes(flagged.filter(is_top & (F.col("depth") == F.col("len"))).select(*key, "conv"))
    parents = top.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("least").alias("parent_conv_id"))
    upper = top.filter("depth > 0").join(parents, ["p1", "p2"]).unionByName(
        top.filter("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long"))
    )
    upper = upper.join(sums, key).join(children, key, "left").join(ended, key, "left").select(
        F.col("least").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"),
    )
    return shards.drop("p1", "p2").unionByName(upper)
