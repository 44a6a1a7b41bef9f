"""Benchmark decontamination with an Aho-Corasick automaton over item windows.

Benchmark items are normalised (A-Z lower-cased, every other ASCII character
that is no letter or digit separates words) and cut into windows of ``window``
consecutive words; a shorter item is one window.  Each distinct benchmark word
becomes one code point, each window a string of code points, and one automaton
holds all windows.  A document is normalised once, turned into the same code
points and scanned once; the position of a match is a word number, and word
numbers are mapped back to character offsets of the original text.

The benchmark is the stated query set.  It is read in blocks of about
``block_words`` words (normally one; a longer item is a block of its own size), each
block one automaton.  With several blocks the documents are scanned by one job per
block, so the driver and the workers hold one block at a time; what a job finds is
written by text and merged at the end.

Nulls: a null text has no words and is never hit; null items are ignored, a
null item_id is listed as "null".  Empty tables give empty or clean results.
Repeated items count once, by item_id.  Every input row gives one result, so
repeated rows and extra columns of any name are kept as they are."""

from __future__ import annotations

import hashlib
import re
import uuid
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from marketloom.llm.common import map_texts, text_bytes
from marketloom.sources.tables import save_table, shared_dir, write_scratch

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

SPAN = T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())
])
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
    T.StructField("spans", T.ArrayType(SPAN)),
])


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Windows:
    """The automaton of one block of items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        import ahocorasick

        self.codes: dict[bytes, str] = {}
        found: dict[str, set[str]] = defaultdict(set)
        for item, text in items:
            coded = "".join(self._code(w) for w in words_of(text))
            for i in range(max(1, len(coded) - window + 1) if coded else 0):
                found[coded[i : i + window]].add(item)
        self.automaton = ahocorasick.Automaton()
        for key, names in found.items():
            self.automaton.add_word(key, (len(key), tuple(names)))
        self.empty = not found
        if found:
            self.automaton.make_automaton()

    def _code(self, word: bytes) -> str:
        # code point 1 stands for all words of no item; surrogates are skipped
        n = len(self.codes) + 2
        return self.codes.setdefault(word, chr(n if n < 0xD800 else n + 0x800))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Matches as word ranges [first, last + 1), and the items they belong to."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        if not self.empty:
            get = self.codes.get
            coded = "".join([get(w, "\x01") for w in words])
            for end, (length, names) in self.automaton.iter(coded):
                spans.append((end + 1 - length, end + 1))
                items.update(names)
        return spans, items


def merge(spans: list) -> list[list[int]]:
    runs: list[list[int]] = []
    for a, b in sorted(spans):
        if runs and a <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b])
    return runs


def character_spans(text: bytes, runs: list[list[int]]) -> list[tuple[int, int]]:
    """Word runs as character offsets of the original text."""
    at = [m.span() for m in _WORD.finditer(text)]
    chars = lambda byte: len(text[:byte].decode("utf-8", "replace"))
    return [(chars(at[a][0]), chars(at[b - 1][1])) for a, b in runs]


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_words: int) -> tuple:
    """The number of blocks and the items; several blocks are written, by ``block``."""
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("null")).alias("item"),
        text_bytes(text_col).alias("text"),
    ).filter("text is not null").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-total // (block_words * 4)))  # a word with its separator has 4 bytes or more, mostly
    if n > 1:
        items = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(n)))
        items = write_scratch(items.repartition("block").sortWithinPartitions("block"), "benchmark")
    return n, items


def _collected(items: DataFrame) -> list[tuple[str, bytes]]:
    return [(r["item"], bytes(r["text"])) for r in items.select("item", "text").collect()]


def scan_rows(
    docs: DataFrame, benchmark: DataFrame, carry: list[str], window: int = 10,
    item_col: str = "item_id", text_col: str = "text", block_words: int = 500_000,
) -> DataFrame:
    """``row`` (the carried columns) and ``out`` (RESULT) for every row of ``docs``."""
    n, items = _blocks(benchmark, item_col, text_col, block_words)
    if n > 1:
        return _merged(docs, _block_hits(docs, n, items, window, text_col), carry, text_col)
    shared = docs.sparkSession.sparkContext.broadcast((_collected(items), window))

    def compute(texts):
        automaton = _automaton(shared)
        out = []
        for text in texts:
            words = words_of(text)
            spans, names = automaton.scan(words)
            out.append(report(text, words, merge(spans), names))
        return out

    return map_texts(docs, carry, text_bytes(text_col), RESULT, compute)


def _text_key(text_col: str):
    return F.sha2(text_bytes(text_col), 256)


def _block_hits(docs: DataFrame, n: int, items: DataFrame, window: int, text_col: str) -> DataFrame:
    """(key, block, spans, items) of the texts that a block hits; one job per block."""
    spark = docs.sparkSession
    source = docs.select(_text_key(text_col).alias("key"), text_bytes(text_col).alias("text"))
    path = f"{shared_dir(spark)}/scratch/hits-{uuid.uuid4().hex[:12]}"
    types = [pa.string(), pa.int64(), pa.list_(pa.list_(pa.int32())), pa.list_(pa.string())]

    def scan(shared, block: int):
        def run(batches):
            automaton = _automaton(shared)
            for batch in batches:
                rows = []
                for key, text in zip(batch.column("key").to_pylist(), batch.column("text").to_pylist()):
                    spans, names = automaton.scan(words_of(text))
                    if spans:
                        rows.append((key, block, merge(spans), sorted(names)))
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types)], ["key", "block", "spans", "items"]
                    )

        return source.mapInArrow(run, "key string, block long, spans array<array<int>>, items array<string>")

    for block in range(n):
        shared = spark.sparkContext.broadcast((_collected(items.filter(F.col("block") == block)), window))
        hits = save_table(scan(shared, block), path, "append")
        shared.destroy()
    return hits


def _merged(docs: DataFrame, hits: DataFrame, carry: list[str], text_col: str) -> DataFrame:
    """The rows of scan_rows from what the blocks hit."""
    # equal texts have equal hits: one of each block is enough
    found = hits.groupBy("key", "block").agg(F.first("spans").alias("spans"), F.first("items").alias("items"))
    found = write_scratch(found.groupBy("key").agg(
        F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list("items"))).alias("items"),
    ), "hits")
    source = docs.select(
        F.struct(*carry).alias("row"), _text_key(text_col).alias("key"), text_bytes(text_col).alias("text"),
    ).join(found, "key", "left").select("row", "text", "spans", "items")
    fields = list(to_arrow_type(RESULT))

    def run(batches):
        for batch in batches:
            out = [
                report(text, words_of(text), merge(spans or []), set(names or []))
                for text, spans, names in zip(*(batch.column(c).to_pylist() for c in ("text", "spans", "items")))
            ]
            columns = list(zip(*out)) or [()] * len(fields)
            struct = pa.StructArray.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields
            )
            yield pa.RecordBatch.from_arrays([batch.column("row"), struct], ["row", "out"])

    return source.mapInArrow(run, T.StructType([source.schema["row"], T.StructField("out", RESULT, False)]))


def report(text: bytes | None, words: list[bytes], runs: list[list[int]], items: set[str]) -> tuple:
    names = ",".join(sorted(items))
    return (
        len(words), sum(b - a for a, b in runs), len(items),
        hashlib.sha256(names.encode()).hexdigest(), bool(runs),
        [{"start": a, "end": b} for a, b in character_spans(text, runs)] if runs else [],
    )


_built: dict[int, Windows] = {}


def _automaton(shared) -> Windows:
    """The automaton of a block; a worker process keeps the last one it built."""
    if shared not in _built:
        _built.clear()
        _built[shared] = Windows(*shared.value)
    return _built[shared]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id",
    text_col: str = "text", item_col: str = "item_id",
) -> DataFrame:
    """Per row: id, n_words, n_hit, n_items, items_sha256, contaminated, spans
    (character offsets of the hit stretches in the original text)."""
    found = scan_rows(docs, benchmark, [id_col], window, item_col, text_col)
    return found.select(F.col("row").getField(id_col).alias(id_col), "out.*")


def keep_clean(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that no benchmark window occurs in."""
    found = scan_rows(docs, benchmark, docs.columns, window, text_col=text_col)
    return found.filter(~F.col("out.contaminated")).select("row.*")
