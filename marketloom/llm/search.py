"""Ranked lexical search by the Best Position Algorithm.

Every item of a query set is ranked against all documents.  Terms are the
maximal runs of ASCII letters and digits and of characters beyond ASCII, A-Z
lower-cased.  A document's score for an item is the sum, over the item's terms, of
an integer impact that grows with the term's weight and frequency and falls with
the document's length (``weights``, ``impacts``).

1. Items are cut into blocks of bounded vocabulary (``block_terms``; an item with
   more distinct terms is a block of its own), one pass over the documents each.  A
   pass keeps, for every document, its length and the frequencies of the block's
   terms, packed, in a written table.  Document frequencies and lengths are
   summed in Spark over all documents.
2. The written table is read in shards of at most ``SHARD_DOCS`` documents or
   ``SHARD_POSTINGS`` postings.  A shard holds one list per term, sorted by falling
   impact.
3. An item reads its lists in step, from the top.  Each document it meets is
   scored at once by direct access to all lists, and its places in all of them
   count as seen.  A list's best position is the last before its first unseen
   place.  The sum of the impacts at the best positions bounds the score of every
   document not met; the scan stops when that sum is strictly below the k-th score,
   so ties are never lost.  The depth of a step doubles, so that a scan has few.
4. The k best of an item in every shard meet in one ranking.

Nulls: a null text has no terms and is never found, nor counted; a null document
id is carried and ranks behind the others on equal scores; a null item text has no
terms, and items without a hit have no row.  A null item id names an item like
any other; rows that repeat an item id add their terms to it.  Repeated
documents are ranked each for itself.  Empty tables give no rows.  Very long texts are
read whole; their postings are no more than the block's vocabulary.  Ties: ascending
document id, then nothing distinguishes the rows.  Only ids and texts are read, so
extra columns of any name do no harm."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketloom.llm.common import text_bytes
from marketloom.sources.tables import write_scratch

TOP = 10
#: Distinct terms of a block of items.
BLOCK_TERMS = 200_000
#: Documents and postings of one shard, whichever comes first.
SHARD_DOCS = 50_000
SHARD_POSTINGS = 2_000_000
SLICE = 1000
#: Places of each list that the first step reads.
FIRST_STEP = 16

_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32
    for b in range(256)
)


def terms_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    """Integer weight of terms held by ``df`` of ``n_docs`` documents."""
    return np.array(
        [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()],
        dtype=np.int64,
    )


def impacts(weight: np.ndarray, tf: np.ndarray, length: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Integer share of a term in the score of a document of ``length`` terms."""
    m = 100 - 90 + (90 * length * n_docs) // n_terms
    return weight * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Shard:
    """Impact lists of some documents, numbered in the order of their ids."""

    def __init__(self, owner: np.ndarray, term: np.ndarray, impact: np.ndarray, vocabulary: int):
        # by document: what direct access reads
        self.term, self.impact, self.vocabulary = term, impact, vocabulary
        self.docs = int(owner[-1]) + 1 if len(owner) else 0
        self.first = np.searchsorted(owner, np.arange(self.docs + 1))
        # by term and falling impact: what is read in step
        order = np.lexsort((-impact, term))
        self.owner, self.falling = owner[order], impact[order]
        self.place = np.empty(len(order), dtype=np.int32)
        self.place[order] = np.arange(len(order), dtype=np.int32)
        self.ends = np.searchsorted(term[order], np.arange(vocabulary + 1))

    def _postings_of(self, docs: np.ndarray) -> np.ndarray:
        start, size = self.first[docs], self.first[docs + 1] - self.first[docs]
        return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)

    def best(self, terms: list[int], k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The documents of the ``k`` highest scores above 0 (equal scores in their
        order), the scores, and how many documents were met."""
        lists = [(self.ends[t], self.ends[t + 1]) for t in terms if self.ends[t] < self.ends[t + 1]]
        wanted = np.zeros(self.vocabulary, dtype=bool)
        wanted[terms] = True
        seen = {a: np.zeros(b - a + 1, dtype=bool) for a, b in lists}  # the last flag is never set
        starts = np.array([a for a, _ in lists], dtype=np.int64)
        best = dict.fromkeys(seen, 0)  # places before it are all seen
        met = np.zeros(self.docs, dtype=bool)
        docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        depth, step = 0, FIRST_STEP
        while lists:
            now = np.concatenate([self.owner[a + depth : min(b, a + depth + step)] for a, b in lists])
            fresh = np.unique(now[~met[now]])
            met[fresh] = True
            at = self._postings_of(fresh)
            at = at[wanted[self.term[at]]]
            if len(fresh):
                own = np.searchsorted(self.first, at, side="right") - 1
                turn = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
                docs = np.concatenate([docs, fresh])
                scores = np.concatenate([scores, np.add.reduceat(self.impact[at], turn)])
                place = np.sort(self.place[at])
                cut = np.searchsorted(place, starts)
                for i, (a, _) in enumerate(lists):
                    part = place[cut[i] : cut[i + 1] if i + 1 < len(cut) else None]
                    seen[a][part - a] = True
            depth, step = depth + step, 2 * step
            limit, more = 0, False
            for a, b in lists:
                best[a] += int(np.argmin(seen[a][best[a] :]))
                if a + best[a] < b:  # a document not met is there or further on
                    limit, more = limit + int(self.falling[a + best[a]]), True
            if not more or (len(scores) >= k and limit < np.partition(scores, len(scores) - k)[len(scores) - k]):
                break
        top = np.lexsort((docs, -scores))[:k]
        top = top[scores[top] > 0]
        return docs[top], scores[top], int(met.sum())


def _blocks(items: DataFrame, block_terms: int) -> list[DataFrame]:
    """(item, text) in blocks whose texts have at most ``block_terms`` terms, or of
    one item.  A term with its separator has two bytes or more."""
    sized = items.groupBy("item").agg(F.sum(F.octet_length("text")).alias("bytes"))
    total = sized.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    if total <= 2 * block_terms:
        return [items]
    n = -(-total // block_terms)  # halves of a full block, so that few are over
    named = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(n)))
    named = write_scratch(named.repartition("block").sortWithinPartitions("block"), "search-items")
    return [named.filter(F.col("block") == b) for b in range(n)]


def _postings(docs: DataFrame, shared, id_type: str) -> DataFrame:
    """(id, n, terms, tfs): every document with terms; packed int32 arrays."""

    def run(batches):
        _, codes, _ = shared.value
        get = codes.get
        for batch in batches:
            ids, lengths, terms, counts = [], [], [], []
            for at, text in enumerate(batch.column("text").to_pylist()):
                words = terms_of(text)
                if not words:
                    continue
                known = np.array([c for c in map(get, words) if c is not None], dtype=np.int32)
                term, count = np.unique(known, return_counts=True)
                ids.append(at)
                lengths.append(len(words))
                terms.append(term.astype(np.int32).tobytes())
                counts.append(count.astype(np.int32).tobytes())
            if ids:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(ids, pa.int64())), pa.array(lengths, pa.int64()),
                     pa.array(terms, pa.binary()), pa.array(counts, pa.binary())],
                    ["id", "n", "terms", "tfs"],
                )

    return docs.mapInArrow(run, f"id {id_type}, n long, terms binary, tfs binary")


def _frequencies(postings: DataFrame, vocabulary: int) -> np.ndarray:
    """In how many documents each of the block's terms occurs."""

    def run(batches):
        df = np.zeros(vocabulary, dtype=np.int64)
        for batch in batches:
            blobs = batch.column("terms").to_pylist()
            df += np.bincount(np.frombuffer(b"".join(blobs), np.int32), minlength=vocabulary)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], ["term", "df"])

    counted = postings.select("terms").mapInArrow(run, "term long, df long")
    out = np.zeros(vocabulary, dtype=np.int64)
    for r in counted.groupBy("term").agg(F.sum("df").alias("df")).collect():  # the block's vocabulary
        out[r["term"]] = r["df"]
    return out


def _ranked(postings: DataFrame, shared, weight, n_docs: int, n_terms: int, k: int, id_type: str) -> DataFrame:
    """(no, doc, score): the best ``k`` of every item in every shard."""

    def best(parts: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(parts)
        # numbered in the order of ids
        rows = rows.take(pc.sort_indices(rows.column("id"), null_placement="at_end"))
        blobs = rows.column("terms").to_pylist()
        owner = np.repeat(np.arange(len(blobs), dtype=np.int32), [len(b) // 4 for b in blobs])
        terms = np.frombuffer(b"".join(blobs), np.int32)
        tfs = np.frombuffer(b"".join(rows.column("tfs").to_pylist()), np.int32).astype(np.int64)
        length = rows.column("n").to_numpy()[owner]
        shard = Shard(owner, terms, impacts(weight.value[terms], tfs, length, n_docs, n_terms), len(weight.value))
        for no, wanted in enumerate(shared.value[2]):
            docs, scores, _ = shard.best(wanted, k)
            if len(docs):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(docs), no)), rows.column("id").take(pa.array(docs)).combine_chunks(),
                     pa.array(scores)],
                    ["no", "doc", "score"],
                )

    def run(batches):
        parts, docs, held = [], 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                parts.append(part)
                docs += part.num_rows
                held += pc.sum(pc.binary_length(part.column("terms"))).as_py() // 4
                if docs >= SHARD_DOCS or held >= SHARD_POSTINGS:
                    yield from best(parts)
                    parts, docs, held = [], 0, 0
        if parts:
            yield from best(parts)

    found = postings.mapInArrow(run, f"no long, doc {id_type}, score long")
    order = Window.partitionBy("no").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def rank_documents(
    docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item, rank, id, score): the ``k`` documents of highest score above 0 of
    each item, written."""
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("text"))
    id_type = source.schema["id"].dataType.simpleString()
    queries = items.select(F.col(item_col).alias("item"), text_bytes(item_text_col).alias("text"))
    item_type = queries.schema["item"].dataType.simpleString()
    results = None
    for block in _blocks(queries, block_terms):
        wanted: dict = defaultdict(set)  # one block of items
        for r in block.collect():
            wanted[r["item"]].update(terms_of(bytes(r["text"] or b"")))
        codes = {t: i for i, t in enumerate(sorted(set().union(*wanted.values())))}
        order = sorted(wanted, key=lambda i: (i is None, i))
        coded = [sorted(codes[t] for t in wanted[i]) for i in order]
        shared = spark.sparkContext.broadcast((order, codes, coded))
        postings = write_scratch(_postings(source, shared, id_type), "postings")
        n_docs, n_terms = postings.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        weight = spark.sparkContext.broadcast(weights(_frequencies(postings, len(codes)), n_docs))
        found = _ranked(postings, shared, weight, n_docs, max(1, n_terms), k, id_type)
        numbers = spark.createDataFrame(list(enumerate(order)), f"no long, item {item_type}")
        named = found.join(F.broadcast(numbers), "no").select(
            F.col("item").alias(item_col), "rank", F.col("doc").alias(id_col), "score"
        )
        named = write_scratch(named, "ranked")
        shared.destroy()
        weight.destroy()
        results = named if results is None else results.union(named)
    return results
