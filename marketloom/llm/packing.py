"""Sequence packing: best-fit decreasing with a segment tree over capacities.

Documents are tokenised whole and end with a separator token.  A document
longer than the window is first cut into full windows and a rest.  Pieces are
dealt by a hash, salted with a row number so that repeated rows part, into buckets
of bounded size, and each bucket is packed by itself: pieces in decreasing length, each into the open window with the least
remaining capacity that still holds it.  The open windows stand in a segment
tree indexed by remaining capacity, so that window is found in a few steps.

Nulls: a null text is an empty document and gives its separator alone; a null
id is carried.  Repeated rows are packed as often as they occur.  Ties in
length are packed by id and start.  An empty table gives no pieces."""

from __future__ import annotations

import string
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import text_bytes
from marketloom.sources.tables import write_scratch

WINDOW = 4096
SEPARATOR = 2
#: Pieces of one packing task.
BUCKET_PIECES = 50_000

VOCABULARY = "word_bpe_49k.json"


#: Fixed value: how the vocabulary's pre-tokenizer cuts a lower-cased text.
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Chunks of these characters alone lower-case and normalise character by character.
_PLAIN = regex.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_LETTERS = regex.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
#: Punctuation that ends a word and is a pre-token of its own.
TAIL = string.punctuation.replace("'", "").encode()


def byte_letters() -> dict[int, int]:
    """Code points that byte-level vocabularies use for bytes: printable Latin-1
    stands for itself, other bytes follow from 256 on.  Space stays a separator."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in shown]
    return {b: 256 + i for i, b in enumerate(others) if b != 32}


class Chunks(dict):
    """Ids, as little-endian bytes, of space-delimited chunks of text.

    The tokenizer drops white space and never merges across it, so a text's ids
    are those of its chunks, one after the other.  Letters and a tail of
    punctuation are looked up apart, plain letters go straight to the
    vocabulary's BPE, and whatever is not plain to the whole tokenizer."""

    def __init__(self, path: str | None):
        from tokenizers import Tokenizer, pre_tokenizers

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.words_known: set[bytes] = set()
        # the same vocabulary for words that need no normalising
        self.words = Tokenizer(self.model)
        self.words.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.ends[number] = token.endswith("</w>")

    def learn(self, chunks: set[bytes]) -> None:
        """Look up many chunks at once: lower-case ASCII words in one call."""
        cores = [c for c in {c.rstrip(TAIL) for c in chunks} if c and c not in self]
        cores = [c for c in cores if c.isalpha() or _LETTERS.fullmatch(c.decode("utf-8", "replace"))]
        for at in range(0, len(cores), 20_000):
            part = cores[at : at + 20_000]
            text = b" ".join(part).decode().lower().encode().decode("latin-1")
            found = self.words.encode_batch_fast(
                [text.translate(self.letters)], add_special_tokens=False
            )[0].ids
            ids = np.array(found, dtype="<u4")
            stops = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
            data = ids.tobytes()
            self.update(zip(part, [data[a:b] for a, b in zip([0, *stops], stops)], strict=True))
        self.words_known.update(cores)
        for c in chunks:
            if c not in self:
                self[c]

    def __missing__(self, chunk: bytes) -> bytes:
        core = chunk.rstrip(TAIL)
        if core in self.words_known:
            found = self[core] + self[chunk[len(core) :]]
        elif _PLAIN.fullmatch(text := chunk.decode("utf-8", "replace")) and "<|" not in text:
            found = b"".join(map(self._bpe, PRE_TOKENS.findall(text.lower())))
        else:
            found = as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)
        self[chunk] = found
        return found

    def _bpe(self, token: str) -> bytes:
        shown = token.encode().decode("latin-1").translate(self.letters)
        return as_bytes([t.id for t in self.model.tokenize(shown)])


class Encoder:
    """Token ids of whole texts; keeps the ids of at most about ``remember`` chunks."""

    def __init__(self, path: str | None = None, remember: int = 600_000):
        self.remember = remember
        self.chunks = Chunks(path)
        self.separator = as_bytes([SEPARATOR])

    def __call__(self, texts: list[bytes | None]) -> Iterator[np.ndarray]:
        """The ids of each text, learning the new chunks of about 4 MB at a time."""
        part: list[list[bytes]] = []
        size = 0
        for text in texts:
            text = text or b""
            # the tokenizer lower-cases, but for its special tokens
            part.append(text.split() if b"<|" in text else text.lower().split())
            size += len(text)
            if size > 4_000_000:
                yield from self._encode(part)
                part, size = [], 0
        yield from self._encode(part)

    def _encode(self, part: list[list[bytes]]) -> Iterator[np.ndarray]:
        if len(self.chunks) > self.remember:
            self.chunks.clear()
            self.chunks.words_known.clear()
        known = self.chunks
        found = [list(map(known.get, chunks)) for chunks in part]
        new = set()
        for chunks, ids in zip(part, found):
            if None in ids:
                new.update(c for c, i in zip(chunks, ids) if i is None)
        known.learn(new)
        for chunks, ids in zip(part, found):
            if None in ids:
                ids = [known[c] if i is None else i for c, i in zip(chunks, ids)]
            yield np.frombuffer(b"".join(ids) + self.separator, dtype="<u4")


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


_encoders: dict[str | None, Encoder] = {}


def encoder(path: str | None) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def cut_tokens(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    tokenizer_path: str | None = None, with_ids: bool = True,
) -> DataFrame:
    """Pieces of at most ``window`` tokens: id, start, length, ids_crc32,
    doc_tokens and, on request, the ids themselves."""
    source = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"
    schema += ", ids array<int>" if with_ids else ""

    def run(batches):
        encode = encoder(tokenizer_path)
        for batch in batches:
            rows: list[tuple] = []
            kept: list[np.ndarray] = []
            for n, ids in enumerate(encode(batch.column("text").to_pylist())):
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    rows.append((n, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
                    if with_ids:
                        kept.append(piece)
            if not rows:
                continue
            table = np.array(rows, dtype=np.int64)
            columns = [batch.column("id").take(pa.array(table[:, 0]))]
            columns += [pa.array(table[:, i]) for i in range(1, 5)]
            if with_ids:
                bounds = np.concatenate([[0], np.cumsum(table[:, 2])]).astype(np.int32)
                columns.append(
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.concatenate(kept).astype(np.int32)))
                )
            names = ["id", "start", "length", "ids_crc32", "doc_tokens", "ids"]
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    return source.mapInArrow(run, schema)


class OpenWindows:
    """Open windows in a segment tree over their remaining capacity.

    Leaf c counts the open windows with c tokens left, inner nodes hold sums;
    ``tightest`` walks to the first non-empty leaf at or after a size."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(window + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def push(self, capacity: int, window: int) -> None:
        self.windows[capacity].append(window)
        self._add(capacity, 1)

    def tightest(self, size: int) -> int | None:
        """Least capacity of at least ``size`` among the open windows."""
        node = size + self.leaves
        if self.count[node]:
            return size
        while node > 1:
            if not node & 1 and self.count[node + 1]:
                node += 1
                while node < self.leaves:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.leaves
            node >>= 1
        return None

    def pop(self, capacity: int) -> int:
        self._add(capacity, -1)
        return self.windows[capacity].pop()


def best_fit_decreasing(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(window number, offset) of each piece; ``lengths`` must not increase."""
    tree = OpenWindows(window)
    placed, opened = [], 0
    for length in lengths:
        capacity = tree.tightest(length)
        if capacity is None:
            number, capacity, opened = opened, window, opened + 1
        else:
            number = tree.pop(capacity)
        placed.append((number, window - capacity))
        if capacity > length:
            tree.push(capacity - length, number)
    return placed


def pack(
    pieces: DataFrame, window: int = WINDOW, bucket_pieces: int = BUCKET_PIECES
) -> DataFrame:
    """``pieces`` without ids, plus sequence_id and offset."""
    # written: the salt must not change between reads
    salted = pieces.drop("ids").withColumn("salt", F.monotonically_increasing_id())
    pieces = write_scratch(salted, "pieces")
    buckets = max(1, -(-pieces.count() // bucket_pieces))
    key = F.pmod(F.xxhash64("id", "start", "ids_crc32", "salt"), F.lit(buckets)).cast("long")

    def place(pdf):
        pdf = pdf.sort_values(
            ["length", "id", "start"], ascending=[False, True, True], kind="stable"
        )
        found = best_fit_decreasing(pdf["length"].tolist(), window)
        at = np.array(found, dtype=np.int64).reshape(-1, 2)
        pdf["sequence_id"] = at[:, 0] * buckets + pdf["bucket"].to_numpy()
        pdf["offset"] = at[:, 1]
        return pdf.drop(columns=["bucket"])

    dealt = pieces.withColumn("bucket", key).drop("salt")
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.drop("bucket").schema)
    return dealt.groupBy("bucket").applyInPandas(
        place, f"{names}, sequence_id long, offset long"
    )


def pack_documents(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
    tokenizer_path: str | None = None, bucket_pieces: int = BUCKET_PIECES,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    cut = cut_tokens(docs, window, id_col, text_col, tokenizer_path, with_ids=False)
    return pack(cut, window, bucket_pieces).withColumnRenamed("id", id_col)


def sequences(pieces: DataFrame, plan: DataFrame, window: int = WINDOW, pad: int = 0) -> DataFrame:
    """The packed sequences themselves: sequence_id and ids padded to ``window``.

    ``pieces`` carries ids; a sequence has at most ``window`` ids, so a group is
    bounded.  Repeated rows are matched once by (id, start, ids_crc32)."""
    key = ["id", "start", "ids_crc32"]
    distinct = pieces.select(*key, "ids").dropDuplicates(key)
    same = [plan[c].eqNullSafe(distinct[c]) for c in key]
    parts = plan.join(distinct, same).select("sequence_id", F.struct("offset", "ids").alias("part"))
    joined = parts.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list("part")), lambda p: p["ids"])).alias("ids")
    )
    return joined.select(
        "sequence_id",
        F.concat("ids", F.array_repeat(F.lit(pad), F.lit(window) - F.size("ids"))).alias("ids"),
    )
