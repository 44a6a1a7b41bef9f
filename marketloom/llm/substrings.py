"""Substring dedup: words of long repeated passages are removed everywhere.

A window is ``window`` consecutive words.  A word goes if it is covered by a
window whose word sequence also starts anywhere else in the corpus.

1. Every window has one anchor, the run of ``ANCHOR`` words inside it with the
   least hash.  Windows next to each other with one anchor form a segment.  Equal
   windows have equal anchors, so only segments with one anchor can share a window.
2. Segments are counted by anchor (packed columns, dealt by anchor hash).  Anchors
   met once are dropped.  An anchor whose segments are all equal needs no
   more work: its windows all repeat.
3. The distinct segments of the other anchors are the reference.  It is cut
   into shards of whole anchors; a task builds a suffix automaton of its shard,
   sums how often each state occurs, and streams the shard's segments through it:
   the matching statistics say, at every word, how long a match ends there and
   how often it occurs.  Matches of ``window`` words found twice or more mark
   windows.  An anchor with very many distinct segments would outgrow a task:
   each of its windows is one row with a digest of its words, and windows are
   counted by digest in sums that merge, so no group is gathered.
4. Marked windows go back to the documents that hold the segments.

A shard's automaton is sent to the one task that holds the segments which can
match it, not to all: every shard against every document would be work in the
square of the corpus.

Nulls: a null text has no words; a null id is carried.  Texts shorter than a
window keep all words.  Repeated rows are copies of each other.  Empty tables give
no rows.  Only the id and the text are read, so extra columns of any name do no
harm.  Segments are found by 64-bit hashes; windows are compared word by word, those
of anchors with very many segments by 128-bit digests."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from marketloom.llm.common import broadcast_if_small, row_name, text_bytes
from marketloom.llm.decontaminate import merge
from marketloom.llm.jaccard import by_group
from marketloom.llm.words import gram_hashes, mix, word_hashes, word_spans
from marketloom.sources.tables import write_scratch

WINDOW = 35
ANCHOR = 8
#: Segments of one counting task; words of an automaton; distinct segments of an
#: anchor beyond which its windows are counted one by one; segments and windows
#: gathered before a map task hands on.
RANGE_SEGMENTS = 500_000
SHARD_WORDS = 20_000
ANCHOR_SEGMENTS = 1_000
FLUSH_SEGMENTS = 200_000
FLUSH_WINDOWS = 50_000

_PLACE_BITS = 24
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` neighbours, by doubling."""
    least, size = values, 1
    while 2 * size <= width:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    rest = width - size
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def segments(words: np.ndarray, window: int, k: int) -> tuple[np.ndarray, ...]:
    """anchor hash, segment hash, first window and number of windows of all
    segments of a text of word hashes."""
    found = []
    step = (1 << _PLACE_BITS) - window  # places are packed beside the hash
    for at in range(0, max(0, len(words) - window + 1), step):
        part = words[at : at + step + window - 1]
        grams = gram_hashes(part, k)
        place = np.arange(len(grams), dtype=np.uint64)
        packed = (grams >> np.uint64(_PLACE_BITS) << np.uint64(_PLACE_BITS)) | place
        anchor = (sliding_least(packed, window - k + 1) & np.uint64((1 << _PLACE_BITS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        count = np.diff(np.r_[first, len(anchor)])
        powers = np.multiply.accumulate(np.full(len(part), _BASE, dtype=np.uint64))
        inverse = np.multiply.accumulate(np.full(len(part), _INVERSE, dtype=np.uint64))
        sums = np.r_[np.uint64(0), np.cumsum(part * powers, dtype=np.uint64)]
        content = mix((sums[first + count + window - 1] - sums[first]) * inverse[first])
        found.append((grams[anchor[first]], mix(content ^ count.astype(np.uint64)), first + at, count))
    if not found:
        return tuple(np.zeros(0, dtype=t) for t in (np.uint64, np.uint64, np.int64, np.int64))
    return tuple(np.concatenate(c) for c in zip(*found))


def _row(id_col: str, text_col: str) -> Column:
    return row_name(F.col(id_col), F.col(text_col))


_PACKED = (("anchor", np.uint64), ("seg", np.uint64), ("r1", np.int64), ("r2", np.int64), ("start", np.uint32), ("windows", np.uint16))


def _deal(source: DataFrame, window: int, ranges: int) -> DataFrame:
    """Packed segments by range of the anchor hash."""

    def packed(parts: list[tuple]):
        columns = [np.concatenate(c) for c in zip(*parts)]
        r = (columns[0] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)
        order = np.argsort(r, kind="stable")
        cuts = np.searchsorted(r[order], np.arange(ranges + 1, dtype=np.uint64))
        columns = [c[order] for c in columns]
        rows = [
            (i, *(c[cuts[i] : cuts[i + 1]].tobytes() for c in columns))
            for i in np.flatnonzero(np.diff(cuts)).tolist()
        ]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary() if i else pa.int32()) for i, c in enumerate(zip(*rows))],
            ["r", *(name for name, _ in _PACKED)],
        )

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                anchor, seg, start, count = segments(word_hashes(text), window, ANCHOR)
                if len(anchor):
                    parts.append((
                        anchor, seg, np.full(len(anchor), row["r1"]), np.full(len(anchor), row["r2"]),
                        start.astype(np.uint32), count.astype(np.uint16),
                    ))
                    size += len(anchor)
                    if size > FLUSH_SEGMENTS:
                        yield packed(parts)
                        parts, size = [], 0
        if parts:
            yield packed(parts)

    return source.mapInArrow(run, "r int, " + ", ".join(f"{n} binary" for n, _ in _PACKED))


def _repeated(dealt: DataFrame, ranges: int) -> DataFrame:
    """Segments whose anchor is met twice or more, with ``copies`` of the segment,
    ``kinds`` of segments at the anchor, and ``rep`` on one of the copies."""

    def counted(blobs):
        columns = {
            n: np.concatenate([np.frombuffer(b[n], kind) for b in blobs]) for n, kind in _PACKED
        }
        order = np.lexsort((columns["seg"], columns["anchor"]))
        columns = {n: c[order] for n, c in columns.items()}
        new_anchor = np.r_[True, columns["anchor"][1:] != columns["anchor"][:-1]]
        new_seg = new_anchor | np.r_[True, columns["seg"][1:] != columns["seg"][:-1]]
        group = np.cumsum(new_anchor) - 1
        kind = np.cumsum(new_seg) - 1
        copies = np.bincount(kind)[kind]
        kinds = np.bincount(group[new_seg])[group]
        keep = (copies > 1) | (kinds > 1)
        if not keep.any():
            return
        data = [columns["anchor"].view(np.int64), columns["seg"].view(np.int64), columns["r1"], columns["r2"],
                columns["start"].astype(np.int64), columns["windows"].astype(np.int64),
                copies.astype(np.int64), kinds.astype(np.int64), new_seg]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c[keep]) for c in data],
            ["anchor", "seg", "r1", "r2", "start", "windows", "copies", "kinds", "rep"],
        )

    placed = dealt.repartition(ranges, "r").sortWithinPartitions("r")
    found = placed.mapInArrow(
        lambda batches: by_group(batches, ["r"], counted),
        "anchor long, seg long, r1 long, r2 long, start long, windows long, copies long, kinds long, rep boolean",
    )
    return found.withColumn("row", F.struct("r1", "r2")).drop("r1", "r2")


class SuffixAutomaton:
    """Of several sequences of symbols, with how often each state occurs."""

    def __init__(self):
        self.moves: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]
        self.count = [0]

    def _state(self, length: int, moves: dict, link: int) -> int:
        self.moves.append(moves)
        self.length.append(length)
        self.link.append(link)
        self.count.append(0)
        return len(self.length) - 1

    def _split(self, p: int, symbol, q: int) -> int:
        """The state for the match through ``p``, a clone of ``q`` if ``q`` is longer."""
        moves, link, length = self.moves, self.link, self.length
        if length[p] + 1 == length[q]:
            return q
        clone = self._state(length[p] + 1, moves[q].copy(), link[q])
        link[q] = clone
        while p >= 0 and moves[p].get(symbol) == q:
            moves[p][symbol] = clone
            p = link[p]
        return clone

    def add(self, symbols, weight: int) -> None:
        moves, link, length, count = self.moves, self.link, self.length, self.count
        last = 0
        for symbol in symbols:
            q = moves[last].get(symbol)
            if q is not None:
                last = self._split(last, symbol, q)
            else:
                p, last = last, self._state(length[last] + 1, {}, 0)
                while p >= 0 and symbol not in moves[p]:
                    moves[p][symbol] = last
                    p = link[p]
                if p >= 0:
                    target = self._split(p, symbol, moves[p][symbol])
                    link[last] = target
            count[last] += weight

    def finish(self) -> None:
        """Pass the counts of longer matches on to their suffixes."""
        link, count = self.link, self.count
        for s in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            if link[s] > 0:
                count[link[s]] += count[s]

    def repeated_ends(self, symbols, window: int) -> list[int]:
        """Ends of the matches of ``window`` symbols that occur twice or more."""
        moves, link, length, count = self.moves, self.link, self.length, self.count
        ends, state, matched = [], 0, 0
        for at, symbol in enumerate(symbols):
            while state and symbol not in moves[state]:
                state = link[state]
                matched = length[state]
            if symbol in moves[state]:
                state = moves[state][symbol]
                matched += 1
            while length[link[state]] >= window:
                state = link[state]
                matched = length[state]
            if matched >= window and count[state] > 1:
                ends.append(at)
        return ends


def _texts(docs: DataFrame, segments: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts, repeated rows once, with those of ``segments`` that are taken from
    them (``parts``)."""
    wanted = segments.groupBy("row").agg(
        F.collect_list(F.struct("anchor", "seg", "start", "windows", "copies")).alias("parts")
    )
    source = docs.select(_row(id_col, text_col).alias("row"), text_bytes(text_col).alias("text"))
    return source.dropDuplicates(["row"]).join(wanted, "row").select("text", "parts")


def _reference(docs: DataFrame, repeated: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Texts of the distinct segments whose anchor has several, at most ANCHOR_SEGMENTS."""

    def run(batches):
        for batch in batches:
            rows = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                _, starts, ends = word_spans(text)
                for p in parts:
                    s, e = starts[p["start"]], ends[p["start"] + p["windows"] + window - 2]
                    rows.append((p["anchor"], p["seg"], p["copies"], text[s:e]))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*rows)], ["anchor", "seg", "copies", "words"]
                )

    several = repeated.filter(F.col("rep") & F.col("kinds").between(2, ANCHOR_SEGMENTS))
    return _texts(docs, several, id_col, text_col).mapInArrow(
        run, "anchor long, seg long, copies long, words binary"
    )


def _windows(docs: DataFrame, many: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Every window of the distinct segments ``many``, its words as a digest."""

    def packed(rows: list[tuple]):
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in zip(*rows)], ["anchor", "seg", "off", "copies", "digest"]
        )

    def run(batches):
        for batch in batches:
            rows = []
            for text, parts in zip(batch.column("text").to_pylist(), batch.column("parts").to_pylist()):
                words = text.split()
                for p in parts:
                    for off in range(p["windows"]):
                        at = p["start"] + off
                        own = hashlib.blake2b(b" ".join(words[at : at + window]), digest_size=16)
                        rows.append((p["anchor"], p["seg"], off, p["copies"], own.digest()))
                    if len(rows) > FLUSH_WINDOWS:
                        yield packed(rows)
                        rows = []
            if rows:
                yield packed(rows)

    wanted = write_scratch(many.select("row").distinct(), "wanted")
    named = wanted.select(F.col("row").alias("_wanted_row"))
    few = docs.join(broadcast_if_small(named), _row(id_col, text_col) == F.col("_wanted_row"), "left_semi")
    return _texts(few, many, id_col, text_col).mapInArrow(
        run, "anchor long, seg long, off long, copies long, digest binary"
    )


def _counted(windows: DataFrame) -> DataFrame:
    """(anchor, seg, a, b) as in _marked, from ``windows`` (written)."""
    key = ["anchor", "digest"]
    repeats = windows.groupBy(key).agg(F.sum("copies").alias("n")).filter("n > 1").select(key)
    repeats = write_scratch(repeats, "repeats")
    # a segment has few windows
    marked = windows.join(broadcast_if_small(repeats), key).groupBy("anchor", "seg").agg(
        F.array_sort(F.collect_list("off")).alias("offs")
    )
    first = F.filter("offs", lambda i: ~F.array_contains("offs", i - 1))
    last = F.filter("offs", lambda i: ~F.array_contains("offs", i + 1))
    runs = F.explode(F.arrays_zip(first.alias("a"), last.alias("b"))).alias("run")
    return marked.select("anchor", "seg", runs).select(
        "anchor", "seg", "run.a", (F.col("run.b") + 1).alias("b")
    )


def _marked(reference: DataFrame, window: int) -> DataFrame:
    """(anchor, seg, a, b): windows a to b of a segment repeat."""

    def judged(groups: list[list[dict]]):
        automaton = SuffixAutomaton()
        symbols: dict[bytes, int] = {}
        streams = []
        for rows in groups:
            for r in rows:
                coded = [symbols.setdefault(w, len(symbols)) for w in r["words"].split()]
                automaton.add(coded, r["copies"])
                streams.append((r, coded))
        automaton.finish()
        out = []
        for r, coded in streams:
            first = [e - window + 1 for e in automaton.repeated_ends(coded, window)]
            out += [(r["anchor"], r["seg"], a, b) for a, b in merge([(i, i + 1) for i in first])]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], ["anchor", "seg", "a", "b"]
            )

    def run(batches):
        shard, size = [], 0
        for rows in by_group(batches, ["anchor"], lambda rows: [rows]):
            shard.append(rows)
            size += sum(len(r["words"]) for r in rows) // 6
            if size > SHARD_WORDS:
                yield from judged(shard)
                shard, size = [], 0
        if shard:
            yield from judged(shard)

    placed = reference.repartition("anchor").sortWithinPartitions("anchor")
    return placed.mapInArrow(run, "anchor long, seg long, a long, b long")


def repeated_spans(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(row, spans): word spans [a, b) of each row's text that repeat; ``row`` is
    the hash of id and text."""
    spark = docs.sparkSession
    source = docs.select(_row(id_col, text_col).alias("row"), text_bytes(text_col).alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(parts, -(-size // (80 * RANGE_SEGMENTS)))  # a segment for about 80 bytes
    repeated = write_scratch(_repeated(_deal(source, window, ranges), ranges), "repeated")
    reference = _reference(docs, repeated, window, id_col, text_col)
    marked = write_scratch(_marked(reference, window), "marked")
    many = repeated.filter(F.col("rep") & (F.col("kinds") > ANCHOR_SEGMENTS))
    if not many.isEmpty():
        windows = write_scratch(_windows(docs, many, window, id_col, text_col), "windows")
        marked = marked.union(write_scratch(_counted(windows), "marked"))
    last = F.lit(window - 1)
    whole = repeated.filter("kinds = 1").select(
        "row", F.col("start").alias("a"), (F.col("start") + F.col("windows") + last).alias("b")
    )
    part = repeated.filter("kinds > 1").join(marked, ["anchor", "seg"]).select(
        "row", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b") + last).alias("b")
    )
    # repeated rows have the same spans: once each, they are no more than the text's words
    return whole.union(part).dropDuplicates(["row", "a", "b"]).groupBy("row").agg(
        F.collect_list(F.struct(F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"))).alias("spans")
    )


RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_removed", T.LongType()),
    T.StructField("kept_sha256", T.StringType()),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())
    ]))),
    T.StructField("text", T.StringType()),
])


def cleaned_rows(
    docs: DataFrame, carry: list, window: int = WINDOW, id_col: str = "doc_id",
    text_col: str = "text", with_text: bool = True,
) -> DataFrame:
    """``row`` (the carried columns) and ``out`` (RESULT; the text only on
    request) for every row of ``docs``."""
    spans = repeated_spans(docs, window, id_col, text_col)
    source = docs.select(
        F.struct(*carry).alias("row"), _row(id_col, text_col).alias("key"),
        text_bytes(text_col).alias("text"),
    ).join(spans.withColumnRenamed("row", "key"), "key", "left").select("row", "text", "spans")
    fields = list(to_arrow_type(RESULT))

    def run(batches):
        for batch in batches:
            out = [
                without(text, merge([(s["a"], s["b"]) for s in found or []]), with_text)
                for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist())
            ]
            columns = list(zip(*out)) or [()] * len(fields)
            struct = pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields
            )
            yield pa.RecordBatch.from_arrays([batch.column("row"), struct], ["row", "out"])

    return source.mapInArrow(run, T.StructType([source.schema["row"], T.StructField("out", RESULT)]))


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    with_text: bool = True,
) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space), spans (word numbers) and the text without the repeats, which keeps its
    own white space elsewhere."""
    found = cleaned_rows(docs, [id_col], window, id_col, text_col, with_text)
    return found.select(F.col("row").getField(id_col).alias(id_col), "out.*")


def drop_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    length_col: str = "n_chars",
) -> DataFrame:
    """``docs`` with repeats cut out of the text and the length brought up to
    date; a document goes if words were cut and none is left."""
    found = cleaned_rows(docs, docs.columns, window, id_col, text_col)
    found = found.filter((F.col("out.n_removed") == 0) | (F.col("out.n_removed") < F.col("out.n_words")))
    text = {text_col: F.col("out.text"), length_col: F.char_length("out.text").cast("long")}
    changed = F.col("out.n_removed") > 0
    return found.select([
        F.when(changed, text[c]).otherwise(F.col("row").getField(c)).alias(c) if c in text
        else F.col("row").getField(c).alias(c)
        for c in docs.columns
    ])


def without(text: bytes | None, spans: list[list[int]], with_text: bool) -> tuple:
    """What remains of a text without the words of ``spans``."""
    words = (text or b"").split()
    kept, at = [], 0
    for a, b in spans:
        kept += words[at:a]
        at = b
    kept += words[at:]
    digest = hashlib.sha256(b" ".join(kept)).hexdigest()
    pairs = [{"a": a, "b": b} for a, b in spans]
    result = (len(words), len(words) - len(kept), digest, pairs)
    if not with_text:
        return (*result, None)
    if text is None or not spans:
        return (*result, None if text is None else text.decode("utf-8", "replace"))
    _, starts, ends = word_spans(text)
    pieces, at = [], 0
    for a, b in spans:
        pieces.append(text[at : starts[a]])
        at = starts[b] if b < len(starts) else len(text)
    return (*result, b"".join([*pieces, text[at:]]).decode("utf-8", "replace"))
