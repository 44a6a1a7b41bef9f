"""Exact self-join of documents on the Jaccard similarity of word shingles.

Two documents link when ``percent`` of the union of their shingle sets is not
more than 100 times the intersection, in hundredths.  Documents with equal sets
are one class from the start and compared once.

1. Every distinct set is dealt out, shingle by shingle, to ranges of the hash
   space in packed columns; a range counts in how many sets each cell (the top
   48 bits of a shingle) occurs.
2. Rarest cells first, two sets that link share a cell among the first
   size - need + 1 of either one, where need is the least intersection.  Cells of one
   set alone come first, so only sets with ``need`` shared cells stay, with
   few, rare cells each.
3. Tiles hold the sets that share such a cell and lie in a size band or its
   upper neighbour.  Inside a tile, sizes, the cells before the common one and the
   bits that differ between hashed bitmap signatures bound the intersection from
   above.
4. Pairs that pass are checked on the sorted shingle arrays.  First every set
   meets two leaders only, those with the fewest rare cells, in its widest tiles;
   what these links connect is not compared again.  Then the sets outside of a
   tile's largest component meet the tile.  A large group of near copies with a few
   outsiders thus costs a few pairs per member, and no link between different
   components can be missed.

Shingles are compared by 64-bit hashes.  Nulls: a null or empty text has an
empty set and links with nothing; a null id is carried, and a class's id is the
least id that is not null.  Fewer words than a shingle: the whole sequence is one
shingle.  Repeated rows are members of one class.  Empty tables give no rows.
Only the id and the text are read, so extra columns of any name do no harm."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import broadcast_if_small, row_name, text_bytes
from marketloom.llm.components import connected_components
from marketloom.llm.words import gram_hashes, mix, word_hashes
from marketloom.sources.tables import write_scratch

CELL_SHIFT = np.uint64(16)
CELL_BITS = 48
SIGNATURE_BITS = 512
#: Tiles in which a set meets the leaders.
WIDE_CELLS = 2
#: Shingles of one counting task, and shingles gathered before a map task hands on.
RANGE_SHINGLES = 1_000_000
#: Sets whose tiles are compared together, and pairs found before they are handed on.
CHUNK_SETS = 60_000
FLUSH_PAIRS = 200_000
FLUSH_SHINGLES = 500_000


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    words = word_hashes(text.lower() if text else None)  # bytes: A-Z alone
    if not len(words):
        return words
    return np.unique(gram_hashes(words, min(k, len(words))))


def set_key(shingles: np.ndarray) -> int:
    """A signed 64-bit name for a set."""
    place = np.arange(1, len(shingles) + 1, dtype=np.uint64)
    total = np.add.reduce(mix(shingles + mix(place)), dtype=np.uint64)
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def needed(n, percent: int):
    """Least intersection of a set of ``n`` with a set it links to."""
    return (n * percent + 99) // 100


def signature(shingles: np.ndarray) -> np.ndarray:
    """SIGNATURE_BITS bits, one set for each shingle's hash."""
    bits = np.zeros(SIGNATURE_BITS, dtype=np.uint8)
    bits[(mix(shingles) % np.uint64(SIGNATURE_BITS)).astype(np.int64)] = 1
    return np.packbits(bits)


def members(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(row, id, key, n, m): each row's set by name, its size and its cells."""
    source = docs.select(
        row_name(F.col(id_col), F.col(text_col)).alias("row"), F.col(id_col).alias("id"),
        text_bytes(text_col).alias("text"),
    )
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, k)
                cells = s >> CELL_SHIFT
                m = 1 + np.count_nonzero(cells[1:] != cells[:-1]) if len(s) else 0
                out.append((set_key(s), len(s), m))
            at = np.array(out, dtype=np.int64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), *(pa.array(at[:, i]) for i in range(3))],
                ["row", "id", "key", "n", "m"],
            )

    return source.mapInArrow(run, f"row struct<r1:bigint,r2:bigint>, id {id_type}, key long, n long, m long")


def _deal(docs: DataFrame, k: int, text_col: str, ranges: int) -> DataFrame:
    """Packed shingles by range: sorted cells and, for each, the set it is in."""
    width = -(-(1 << CELL_BITS) // ranges)

    def packed(sets: list[tuple[int, np.ndarray]]):
        keys = np.array([key for key, _ in sets], dtype=np.int64)
        cells = np.concatenate([c for _, c in sets])
        owner = np.repeat(np.arange(len(sets), dtype=np.int32), [len(c) for _, c in sets])
        order = np.argsort(cells, kind="stable")
        cells, owner = cells[order], owner[order]
        cuts = np.searchsorted(cells, np.arange(ranges + 1, dtype=np.uint64) * np.uint64(width))
        rows = []
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            a, b = cuts[r], cuts[r + 1]
            present, local = np.unique(owner[a:b], return_inverse=True)
            part = cells[a:b]
            rows.append((
                r, keys[present].tobytes(), local.astype(np.uint32 if len(present) > 65535 else np.uint16).tobytes(),
                part.astype(np.uint32).tobytes(), (part >> np.uint64(32)).astype(np.uint16).tobytes(),
            ))
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary() if i else pa.int32()) for i, c in enumerate(zip(*rows))],
            ["r", "keys", "owner", "low", "high"],
        )

    def run(batches):
        sets: dict[int, np.ndarray] = {}
        size = 0
        for batch in batches:
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, k)
                key = set_key(s)
                if len(s) and key not in sets:
                    sets[key] = np.unique(s >> CELL_SHIFT)
                    size += len(s)
                    if size > FLUSH_SHINGLES:
                        yield packed(list(sets.items()))
                        sets, size = {}, 0
        if sets:
            yield packed(list(sets.items()))

    return docs.select(text_bytes(text_col).alias("text")).mapInArrow(
        run, "r int, keys binary, owner binary, low binary, high binary"
    )


def _shared_cells(dealt: DataFrame, ranges: int, buckets: int) -> DataFrame:
    """Cells of two sets or more, dealt on to buckets of sets: (bucket, keys,
    cells, counts) packed."""

    def counted(blobs):
        keys = np.concatenate([
            np.frombuffer(b["keys"], np.int64)[
                np.frombuffer(b["owner"], np.uint16 if len(b["owner"]) * 2 == len(b["low"]) else np.uint32)
            ] for b in blobs
        ])
        cells = np.concatenate([
            np.frombuffer(b["low"], np.uint32).astype(np.uint64)
            | (np.frombuffer(b["high"], np.uint16).astype(np.uint64) << np.uint64(32))
            for b in blobs
        ])
        order = np.lexsort((keys, cells))
        keys, cells = keys[order], cells[order]
        first = np.ones(len(cells), dtype=bool)
        first[1:] = (cells[1:] != cells[:-1]) | (keys[1:] != keys[:-1])
        keys, cells = keys[first], cells[first]
        _, inverse, count = np.unique(cells, return_inverse=True, return_counts=True)
        count = count[inverse]
        shared = count > 1
        keys, cells, count = keys[shared], cells[shared], count[shared]
        bucket = (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        bucket, keys, cells, count = (x[order] for x in (bucket, keys, cells, count))
        cuts = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = [
            (int(s), keys[a:b].tobytes(), cells[a:b].tobytes(), count[a:b].astype(np.uint32).tobytes())
            for s, a, b in zip(range(buckets), cuts[:-1], cuts[1:]) if b > a
        ]
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))],
                ["bucket", "keys", "cells", "counts"],
            )

    placed = dealt.repartition(ranges, "r").sortWithinPartitions("r")
    return placed.mapInArrow(
        lambda batches: by_group(batches, ["r"], counted),
        "bucket int, keys binary, cells binary, counts binary",
    )


def by_group(batches, key: list[str], use):
    """Calls ``use`` with the rows (dicts) of each run of equal ``key``."""
    group, now = [], None
    for batch in batches:
        for row in batch.to_pylist():
            this = tuple(row[c] for c in key)
            if this != now and group:
                yield from use(group)
                group = []
            now = this
            group.append(row)
    if group:
        yield from use(group)
    pa.default_memory_pool().release_unused()  # the worker lives on


def _prefixes(shared: DataFrame, sets: DataFrame, buckets: int, percent: int) -> DataFrame:
    """(cell, key, n, place, wide): the shared cells in the prefix of each set, how
    many of its cells come before, and whether it is one of the last, which most
    sets share."""

    def to_buckets(batches):
        for batch in batches:
            keys = batch.column("key").to_numpy()
            b = (mix(keys.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(b, kind="stable")
            columns = [batch.column(c).to_numpy()[order] for c in ("key", "n", "m")]
            cuts = np.searchsorted(b[order], np.arange(buckets + 1))
            rows = [(s, *(c[cuts[s] : cuts[s + 1]].tobytes() for c in columns))
                    for s in np.unique(b).tolist()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[0] for r in rows], pa.int32()), *(pa.array([r[i] for r in rows], pa.binary()) for i in (1, 2, 3))],
                    ["bucket", "keys", "n", "m"],
                )

    def prefixes(rows):
        known = [r for r in rows if r["n"] is not None]
        found = [r for r in rows if r["n"] is None]
        if not known or not found:
            return
        join = lambda rows, c, kind: np.concatenate([np.frombuffer(r[c], kind) for r in rows])
        set_keys, n, m = (join(known, c, np.int64) for c in ("keys", "n", "m"))
        set_keys, at = np.unique(set_keys, return_index=True)
        n, m = n[at], m[at]
        keys, cells, count = join(found, "keys", np.int64), join(found, "cells", np.uint64), join(found, "counts", np.uint32)
        order = np.lexsort((cells, count, keys))
        keys, cells = keys[order], cells[order]
        own = np.searchsorted(set_keys, keys)
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        lengths = np.diff(np.r_[starts, len(keys)])
        rank = np.arange(len(keys)) - np.repeat(starts, lengths)
        place = m[own] - np.repeat(lengths, lengths) + rank  # after the cells of one set alone
        keep = place < n[own] - needed(n[own], percent) + 1
        kept = np.add.reduceat(keep.astype(np.int64), starts)  # a prefix of each set's cells
        wide = rank >= np.repeat(kept - WIDE_CELLS, lengths)
        if keep.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[keep]) for x in (cells.astype(np.int64), keys, n[own], place, wide)],
                ["cell", "key", "n", "place", "wide"],
            )

    sizes = sets.select("key", "n", "m").mapInArrow(
        to_buckets, "bucket int, keys binary, n binary, m binary"
    )
    empty = F.lit(None).cast("binary")
    rows = shared.select("bucket", "keys", "cells", "counts", empty.alias("n"), empty.alias("m")).union(
        sizes.select("bucket", "keys", empty.alias("cells"), empty.alias("counts"), "n", "m")
    )
    placed = rows.repartition(buckets, "bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(
        lambda batches: by_group(batches, ["bucket"], prefixes), "cell long, key long, n long, place long, wide boolean"
    )


def _candidate_sets(docs: DataFrame, wanted: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """(key, n, signature, shingles) of the documents in ``wanted`` (column row)."""
    source = docs.select(
        row_name(F.col(id_col), F.col(text_col)).alias("row"), text_bytes(text_col).alias("text")
    ).join(wanted, "row", "left_semi").select("text")

    def run(batches):
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, k)
                out.append((set_key(s), len(s), signature(s).tobytes(), s.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*out)], ["key", "n", "signature", "shingles"]
                )

    return source.mapInArrow(run, "key long, n long, signature binary, shingles binary")


def bound(n: np.ndarray, m: np.ndarray, bits: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Upper bounds of intersections, pair by pair: every differing bit of the
    signatures needs a shingle of its own that is not in both sets."""
    differ = np.bitwise_count(bits ^ others).sum(axis=1, dtype=np.int64)
    return np.minimum(np.minimum(n, m), (n + m - differ) // 2)


def largest_component(own: np.ndarray, label: np.ndarray, tiles: int) -> np.ndarray:
    """The label that most rows of each tile have."""
    order = np.lexsort((label, own))
    o, l = own[order], label[order]
    first = np.flatnonzero(np.r_[True, (o[1:] != o[:-1]) | (l[1:] != l[:-1])])
    count = np.diff(np.r_[first, len(o)])
    most = np.lexsort((count, o[first]))  # the last run of each tile is its largest
    last = np.r_[o[first][most][1:] != o[first][most][:-1], True]
    out = np.zeros(tiles, dtype=label.dtype)
    out[o[first][most][last]] = l[first][most][last]
    return out


def tile_pairs(tile: dict[str, np.ndarray], percent: int, leaders_only: bool):
    """Index pairs within the tiles (rows of equal ``group``, by size) that may
    link and are not known to be connected.

    Two sets whose first common cell is the tile's have no more in common than
    what comes from there on in either; with an earlier common cell they meet in
    that cell's tile too, so it is enough to pass once."""
    group, n, place, label, home = (tile[c] for c in ("group", "n", "place", "label", "home"))
    bits = tile["bits"]
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(group)])

    def pairs():
        if leaders_only:
            # the sets with the fewest rare cells: the common core of near copies
            own = np.repeat(np.arange(len(start)), size)
            typical = np.lexsort((place, group))
            rows = np.flatnonzero(tile["wide"])
            for leader in (typical[start], typical[np.minimum(start + 1, start + size - 1)]):
                yield leader[own[rows]], rows
        else:
            # only sets outside of a tile's largest component meet the tile
            own = np.repeat(np.arange(len(start)), size)
            main = largest_component(own, label, len(start))
            outside = np.flatnonzero(label != main[own])
            number = np.arange(len(outside)) - np.searchsorted(own[outside], own[outside])
            order = np.argsort(number, kind="stable")
            outside, number = outside[order], number[order]
            cuts = np.searchsorted(number, np.arange(int(number[-1]) + 2)) if len(number) else []
            for a, b in zip(cuts[:-1], cuts[1:]):  # one outsider of every tile at a time
                tiles = own[outside[a:b]]
                n_rows = size[tiles]
                rows = np.arange(n_rows.sum()) + np.repeat(start[tiles] - (np.cumsum(n_rows) - n_rows), n_rows)
                lead = np.repeat(outside[a:b], n_rows)
                ok = (label[rows] == main[own[rows]]) | (rows > lead)  # two outsiders meet once
                yield lead[ok], rows[ok]

    for i, j in pairs():
        ok = (label[i] != label[j]) & (home[i] | home[j])
        i, j = i[ok], j[ok]
        total = n[i] + n[j]
        most = np.minimum(n[i], n[j])
        if not leaders_only:
            most = np.minimum(n[i] - place[i], n[j] - place[j])
        ok = 100 * most >= percent * (total - most)
        i, j, total, most = i[ok], j[ok], total[ok], most[ok]
        most = np.minimum(most, bound(n[i], n[j], bits[i], bits[j]))
        ok = 100 * most >= percent * (total - most)
        yield i[ok], j[ok]


def _pairs(tiles: DataFrame, labels: DataFrame | None, percent: int, leaders_only: bool) -> DataFrame:
    named = tiles.withColumn("label", F.col("key")) if labels is None else tiles.join(
        labels.select(F.col("node").alias("key"), F.col("root").alias("label")), "key", "left"
    ).withColumn("label", F.coalesce("label", "key"))

    def pairs_of(batch: pa.RecordBatch):
        column = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        cell, band, key = column("cell"), column("band"), column("key")
        first = np.r_[True, (cell[1:] != cell[:-1]) | (band[1:] != band[:-1])]
        group = np.cumsum(first) - 1
        # a tile of one set, or of sets that are known to be connected, is done
        label, start = column("label"), np.flatnonzero(first)
        many = (np.minimum.reduceat(label, start) != np.maximum.reduceat(label, start))[group]
        bits = np.frombuffer(b"".join(batch.column("signature").to_pylist()), np.uint64)
        tile = {c: column(c)[many] for c in ("n", "place", "label", "home", "wide")}
        tile |= {"group": group[many], "bits": bits.reshape(len(key), -1)[many]}
        key = key[many]
        if not len(key):
            return
        held, size = [], 0

        def handed():
            a, b = np.unique(np.concatenate(held, axis=1), axis=1)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        for i, j in tile_pairs(tile, percent, leaders_only):
            if len(i):
                held.append(np.stack([np.minimum(key[i], key[j]), np.maximum(key[i], key[j])]))
                size += len(i)
            if size >= FLUSH_PAIRS:
                yield handed()
                held, size = [], 0
        if size:
            yield handed()

    def run(batches):
        """Whole tiles, many at a time; rows are put together once."""
        waiting: list[pa.RecordBatch] = []
        held, last = 0, None
        whole = lambda parts: pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, band = batch.column("cell").to_numpy(), batch.column("band").to_numpy()
            if held >= CHUNK_SETS:
                turn = np.flatnonzero(np.r_[
                    (cell[0], band[0]) != last, (cell[1:] != cell[:-1]) | (band[1:] != band[:-1])])
                if len(turn):
                    cut = int(turn[-1])
                    yield from pairs_of(whole([*waiting, batch.slice(0, cut)] if cut else waiting))
                    waiting, held, batch = [], 0, batch.slice(cut)
            waiting.append(batch)
            held += batch.num_rows
            last = (cell[-1], band[-1])
        if held:
            yield from pairs_of(whole(waiting))

    placed = named.repartition("cell", "band").sortWithinPartitions("cell", "band", "n", "key")
    columns = ["cell", "band", "home", "key", "n", "place", "wide", "signature", "label"]
    return placed.select(*columns).mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets link: intersection of the sorted arrays."""
    side = lambda c: sets.select(F.col("key").alias(c), F.col("shingles").alias(f"s{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("sa"), batch.column("sb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                both = np.count_nonzero(y[np.minimum(at, len(y) - 1)] == x)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            mask = pa.array(keep, pa.bool_())
            yield batch.select(["a", "b"]).filter(mask)

    return both.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def rooted_rows(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(row, id, n, root), written: rows with one root are linked; a row with an
    empty set (n = 0) is linked with nothing."""
    rows = write_scratch(members(docs, k, id_col, text_col), "members")
    sets = rows.filter("n > 0").groupBy("key").agg(
        F.min("row").alias("row"), F.min("n").alias("n"), F.min("m").alias("m")
    )
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(parts, -(-total // RANGE_SHINGLES))
    shared = _shared_cells(_deal(docs, k, text_col, ranges), ranges, ranges)
    prefixes = write_scratch(_prefixes(shared, sets, ranges, percent), "prefixes")
    wanted = write_scratch(
        prefixes.select("key").distinct().join(sets.select("key", "row"), "key").select("row"), "wanted"
    )
    candidates = write_scratch(
        _candidate_sets(docs, broadcast_if_small(wanted), k, id_col, text_col).dropDuplicates(["key"]),
        "candidates",
    )
    band = F.floor(F.ln("n") / math.log(100 / percent)).cast("int")
    homes = prefixes.join(candidates.select("key", "signature"), "key").withColumn("own", band)
    tiles = homes.withColumn(
        "tile", F.explode(F.array(F.struct(F.col("own").alias("band"), F.lit(True).alias("home")),
                                   F.struct((F.col("own") - 1).alias("band"), F.lit(False).alias("home"))))
    ).select("cell", "tile.band", "tile.home", "key", "n", "place", "wide", "signature")
    tiles = write_scratch(tiles, "tiles")
    first = write_scratch(_verified(_pairs(tiles, None, percent, True), candidates, percent), "links")
    labels = write_scratch(connected_components(first), "labels")
    rest = _verified(_pairs(tiles, labels, percent, False), candidates, percent)
    links = first.union(write_scratch(rest, "links"))
    roots = connected_components(links)
    rooted = rows.join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn(
        "root", F.coalesce("root", "key")
    )
    return write_scratch(rooted.select("row", "id", "n", "root"), "rooted")


def jaccard_classes(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, component_id): component_id is the least id that links
    lead to, one row per row of ``docs``."""
    rooted = rooted_rows(docs, k, percent, id_col, text_col)
    least = rooted.filter("n > 0").groupBy("root").agg(F.min("id").alias("least"))
    return rooted.join(least, "root", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id")).alias("component_id"),
    )


def keep_one(
    docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns: of linked rows the one with the least
    id (nulls last), and every row with an empty set.  Of rows that repeat id and
    text one stays."""
    rooted = rooted_rows(docs, k, percent, id_col, text_col)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = rooted.filter("n > 0").groupBy("root").agg(F.min(order).alias("first"))
    names = first.select(F.col("first.row").alias("row")).union(
        rooted.filter("n = 0").select("row")
    ).distinct()
    copies = rooted.groupBy("row").agg((F.count("*") > 1).alias("repeated"))
    kept = write_scratch(names.join(copies, "row"), "kept")
    found = docs.select(
        F.struct(*docs.columns).alias("doc"), row_name(F.col(id_col), F.col(text_col)).alias("row")
    ).join(kept, "row")
    once = found.filter("not repeated").select("doc")
    # rows that differ in other columns: the least of them, so that reruns agree
    again = found.filter("repeated").groupBy("row").agg(F.min("doc").alias("doc")).select("doc")
    return once.union(again).select("doc.*")
