"""Token counts of document sections by offset-mapped attribution.

A document is encoded whole, once, with a byte-level vocabulary that loses
nothing: the byte lengths of its tokens, summed up, are the tokens' byte spans.
Token spans and section spans are joined as intervals, both in order, and every
token goes to exactly one section by an explicit rule:

* ``start``: the section that holds the token's first byte;
* ``end``: the section that holds its last byte;
* ``most``: the section that holds most of its bytes, the first of equals.

A token whose bytes lie in no section is counted in section -1 of its document,
so the counts of a document always add up to its tokens.  Sections are given as
character spans, in order and without overlap, or are the lines of the text, each
with its newline.

Nulls: a null or empty text has no tokens and no lines; given sections of it
count 0, and null sections are none.  A span beyond the text ends with the text.
Repeated rows are counted as often as they occur; empty tables give no rows; only
the named columns are read, so extra columns of any name do no harm."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import text_bytes

RANKS = "byte_bpe_50k.tiktoken"
RULES = ("start", "end", "most")


class Tokens:
    """The vocabulary, and the byte length of each of its tokens."""

    def __init__(self, path: str | None):
        import public_tokenizers
        import tiktoken

        with open(path or public_tokenizers.path(RANKS), "rb") as source:
            pairs = [line.split() for line in source if line.strip()]
        ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.encoding = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self.lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self.lengths[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Byte offset at which each token ends."""
        return np.cumsum(self.lengths[self.encoding.encode_ordinary(text)])


_tokens: dict[str | None, Tokens] = {}


def tokens(path: str | None) -> Tokens:
    if path not in _tokens:
        _tokens[path] = Tokens(path)
    return _tokens[path]


def line_spans(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines, newlines included."""
    b = np.frombuffer(data, dtype=np.uint8)
    ends = np.flatnonzero(b == 10) + 1
    if len(b) and (not len(ends) or ends[-1] < len(b)):
        ends = np.append(ends, len(b))
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends, ends


def character_starts(data: bytes) -> np.ndarray:
    """Byte offset of every character, and the length of the text at the end."""
    b = np.frombuffer(data, dtype=np.uint8)
    return np.append(np.flatnonzero((b & 0xC0) != 0x80), len(b))


def attribute(
    token_ends: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str
) -> tuple[np.ndarray, int, np.ndarray]:
    """Tokens of each section, tokens outside of all, and for each section the
    tokens it was given though they also lie in another or in none."""
    n = len(starts)
    if not n or not len(token_ends):
        return np.zeros(n, dtype=np.int64), len(token_ends), np.zeros(n, dtype=np.int64)
    first = np.concatenate([[0], token_ends[:-1]])
    last = token_ends - 1

    def holder(at):
        s = np.searchsorted(starts, at, side="right") - 1
        return np.where((s >= 0) & (at < ends[np.maximum(s, 0)]), s, -1)

    def part(s):  # bytes of each token in section s (0 for none)
        k = np.clip(s, 0, n - 1)
        inside = np.minimum(token_ends, ends[k]) - np.maximum(first, starts[k])
        return np.where((s >= 0) & (s < n), np.maximum(inside, 0), 0)

    size = token_ends - first
    if rule == "most":
        low = np.searchsorted(ends, first, side="right")
        high = np.searchsorted(starts, last, side="right") - 1
        owner, most = np.full(len(size), -1), np.zeros(len(size), dtype=np.int64)
        for step in range(int(max(0, (high - low).max())) + 1):
            here = np.where(low + step <= high, low + step, -1)
            held = part(here)
            owner, most = np.where(held > most, here, owner), np.maximum(held, most)
    else:
        owner = holder(first if rule == "start" else last)
    inside = owner >= 0
    crossing = inside & (part(owner) < size)
    count = np.bincount(owner[inside], minlength=n)
    return count, int((~inside).sum()), np.bincount(owner[crossing], minlength=n)


def section_tokens(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sections_col: str | None = None,
    rule: str = "start", tokenizer_path: str | None = None,
) -> DataFrame:
    """One row per section: id, section (number from 0; -1: outside of all),
    start and end (characters), n_tokens, n_crossing.

    ``sections_col`` holds an array of structs (start, end) in characters; without
    it the sections are the lines."""
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    columns = [F.col(id_col).alias("id"), text_bytes(text_col).alias("text")]
    if sections_col:
        columns.append(F.col(sections_col).alias("sections"))
    source = docs.select(*columns)
    id_type = source.schema["id"].dataType.simpleString()

    def run(batches):
        vocabulary = tokens(tokenizer_path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            given = batch.column("sections").to_pylist() if sections_col else [None] * len(texts)
            rows: list[np.ndarray] = []
            for i, (data, spans) in enumerate(zip(texts, given)):
                data = data or b""
                at = character_starts(data)
                if sections_col:
                    pairs = [(s["start"], s["end"]) for s in spans or [] if s is not None]
                    chars = np.array(pairs, dtype=np.int64).reshape(-1, 2).clip(0, len(at) - 1)
                    starts, ends = at[chars[:, 0]], at[chars[:, 1]]
                else:
                    starts, ends = line_spans(data)
                    chars = np.stack([np.searchsorted(at, starts), np.searchsorted(at, ends)], axis=1)
                count, outside, crossing = attribute(
                    vocabulary.ends(data.decode("utf-8", "replace")), starts, ends, rule
                )
                number = np.arange(len(starts))
                part = np.stack([np.full(len(starts), i), number, *chars.T, count, crossing], axis=1)
                if outside:
                    part = np.vstack([part, [i, -1, -1, -1, outside, 0]])
                rows.append(part)
            table = np.concatenate(rows) if rows else np.zeros((0, 6))
            table = table.astype(np.int64)
            arrays = [batch.column("id").take(pa.array(table[:, 0]))]
            arrays += [pa.array(table[:, c]) for c in range(1, 6)]
            yield pa.RecordBatch.from_arrays(
                arrays, ["id", "section", "start", "end", "n_tokens", "n_crossing"]
            )

    return source.mapInArrow(
        run,
        f"id {id_type}, section long, start long, end long, n_tokens long, n_crossing long",
    ).withColumnRenamed("id", id_col)
