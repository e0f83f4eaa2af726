"""Ranked lexical search with exact results: posting lists in geometric blocks that a summary lets whole queries skip.

Documents are read once: their lengths and their counts of the terms that any query holds are written, and from these
come the corpus statistics. The index is cut by documents into shards of bounded size, which tasks build and search one
after the other. Within a shard each term has a posting list of its documents. A list is clustered by the similarity
of whole documents (each joins the most similar of some pivots of the list), and each cluster, a block, keeps the
coordinatewise maximum of its documents' term impacts as its summary. A query's inner product with a summary bounds the
score of every document of the block, so a block is skipped exactly when that bound is under the query's tenth best
score so far. Lists are skipped by the same rule with the maxima of whole lists: a document that holds only terms whose
maxima together stay under the tenth best score cannot enter.

Every task reports at most ten documents a query, and one grouped ranking merges them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from feira.llm.common import col, ship, small_batches
from feira.llm.negatives import Best
from feira.session import materialize

TOP = 10
#: Terms of the queries that one pass over the shards serves, and that one pass over the texts looks for.
BLOCK_TERMS = 8192
PASS_TERMS = 64 * BLOCK_TERMS
#: Mean documents of a block; cells of a shard's matrix of documents and terms.
BLOCK_DOCUMENTS = 32
SHARD_CELLS = 1 << 23
_SKETCH = 16
_PIECE = 1 << 20
_LAST = (1 << 63) - 1

#: Bytes of a term: digits, letters lower-cased, and all of a character beyond ASCII. All others end a term.
_TERM = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text in UTF-8 in lists of bounded size: runs of digits, letters and other characters, A-Z lowered."""
    flat = text.translate(_TERM)
    start = 0
    while start < len(flat):
        end = flat.find(b" ", start + _PIECE)
        end = len(flat) if end < 0 else end
        yield flat[start:end].split()
        start = end


class Query(NamedTuple):
    """Places of a query's terms in the block's vocabulary, rising, and their weights times their occurrences."""

    row: int
    terms: np.ndarray
    weights: np.ndarray


def weight(df: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


class Blocks(NamedTuple):
    """A posting list: its documents block by block, where blocks start, and their summaries on ``coordinates``."""

    members: np.ndarray
    starts: np.ndarray
    coordinates: np.ndarray
    summary: np.ndarray


class Shard:
    """Documents as rows of a matrix of impacts, with posting lists that are clustered when first needed."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, matrix: np.ndarray, together: list[np.ndarray]):
        self.ids, self.rows, self.matrix = ids, rows, matrix
        self.together = together
        self.most = matrix.max(axis=0).astype(np.int64)
        self.lists: dict[int, Blocks] = {}
        places = np.random.Generator(np.random.PCG64(11)).standard_normal((matrix.shape[1], _SKETCH), dtype=np.float32)
        sketch = matrix.astype(np.float32) @ places
        self.sketch = sketch / np.maximum(np.sqrt((sketch * sketch).sum(axis=1, keepdims=True)), 1e-30)

    def blocks(self, term: int) -> Blocks:
        if term not in self.lists:
            held = np.flatnonzero(self.matrix[:, term])
            pivots = held[:: BLOCK_DOCUMENTS]
            nearest = np.argmax(self.sketch[held] @ self.sketch[pivots].T, axis=1)
            order = np.argsort(nearest, kind="stable")
            members, nearest = held[order], nearest[order]
            starts = np.flatnonzero(np.append(True, nearest[1:] != nearest[:-1]))
            coordinates = self.together[term]
            summary = np.maximum.reduceat(self.matrix[np.ix_(members, coordinates)], starts, axis=0).astype(np.int64)
            self.lists[term] = Blocks(members, starts, coordinates, summary)
        return self.lists[term]

    def search(self, query: Query, best: Best) -> tuple[int, int]:
        """Put the shard's best documents into ``best``; returns how many blocks were looked at and skipped."""
        reach = query.weights * self.most[query.terms]
        order = np.argsort(reach, kind="stable")
        least = max(best.least(), 1.0)
        # Lists whose maxima, with those of all smaller ones, stay under the limit hold no new document by themselves.
        needed = order[np.cumsum(reach[order]) >= least][::-1]
        seen = np.zeros(len(self.rows), bool)
        opened = skipped = 0
        for t in needed:
            if not reach[t]:
                continue
            blocks = self.blocks(int(query.terms[t]))
            at = np.searchsorted(blocks.coordinates, query.terms)
            bounds = blocks.summary[:, at] @ query.weights
            ends = np.append(blocks.starts[1:], len(blocks.members))
            for b in np.argsort(-bounds, kind="stable"):
                if bounds[b] < max(best.least(), 1.0):
                    break
                opened += 1
                found = blocks.members[blocks.starts[b] : ends[b]]
                found = found[~seen[found]]
                if not len(found):
                    continue
                seen[found] = True
                score = self.matrix[np.ix_(found, query.terms)].astype(np.int64) @ query.weights
                fits = score >= max(best.least(), 1.0)
                if fits.any():
                    best.add(score[fits], self.ids[found[fits]], self.rows[found[fits]])
            skipped += len(blocks.starts)
        return opened, skipped - opened


def _counts(vocabulary: dict[bytes, int]) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(row, id, n, terms, tfs): length of every document and how often it holds terms of the vocabulary."""

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            lengths, ends, terms, tfs = [], [0], [], []
            for text in batch.column("text"):
                n, known = 0, []
                for part in words(text.as_py()):
                    n += len(part)
                    known.append(np.array([vocabulary[w] for w in part if w in vocabulary], np.int32))
                term, tf = np.unique(np.concatenate(known), return_counts=True) if known else (np.zeros(0, np.int32),) * 2
                lengths.append(n)
                terms.append(term)
                tfs.append(tf)
                ends.append(ends[-1] + len(term))
            flat = [np.concatenate(x) if x else np.zeros(0) for x in (terms, tfs)]
            lists = [
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values.astype(np.int32))) for values in flat
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(lengths, pa.int64()), *lists],
                ["row", "id", "n", "terms", "tfs"],
            )

    return work


def _terms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, term, times) of the queries."""
    for batch in small_batches(batches, "text"):
        for row, text in zip(batch.column("row").to_pylist(), batch.column("text"), strict=True):
            counted: dict[bytes, int] = {}
            for part in words(text.as_py()):
                for w in part:
                    counted[w] = counted.get(w, 0) + 1
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row] * len(counted), pa.int64()),
                    pa.array(list(counted), pa.binary()),
                    pa.array(list(counted.values()), pa.int64()),
                ],
                ["row", "term", "times"],
            )


def _searched(
    queries: list[Query], places: np.ndarray, documents: int, total: int, top: int
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Best documents per query of the shards of a task; ``places`` are the vocabulary's rising term numbers."""
    wide = len(places)
    most = max(16, SHARD_CELLS // max(wide, 1))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: list[list[np.ndarray]] = [[] for _ in range(wide)]
        for query in queries:
            for t in query.terms.tolist():
                met[t].append(query.terms)
        together = [np.unique(np.concatenate(m)) if m else np.zeros(0, np.int64) for m in met]
        best = [Best(top) for _ in queries]

        def solve(rows: pa.Table) -> None:
            ends = np.cumsum(pa.compute.list_value_length(rows.column("terms")).to_numpy())
            term = rows.column("terms").combine_chunks().flatten().to_numpy()
            tf = rows.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            owner = np.repeat(np.arange(rows.num_rows), np.diff(np.append(0, ends)))
            # Lengths meet Python's whole numbers, since n times the number of documents may leave 64 bits.
            m = np.array([25 + (75 * n * documents) // total for n in rows.column("n").to_pylist()], np.int64)
            at = np.searchsorted(places, term)
            here = places[np.minimum(at, wide - 1)] == term
            owner, at, tf = owner[here], at[here], tf[here]
            matrix = np.zeros((rows.num_rows, wide), np.int32)
            matrix[owner, at] = (1_000_000_000 * tf) // (1000 * tf + 8 * m[owner])
            shard = Shard(rows.column("id").to_numpy(), rows.column("row").to_numpy(), matrix, together)
            for query, found in zip(queries, best, strict=True):
                shard.search(query, found)

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, most - size)
                held.append(part)
                size += part.num_rows
                start += part.num_rows
                if size == most:
                    solve(pa.Table.from_batches(held))
                    held, size = [], 0
        if held and size:
            solve(pa.Table.from_batches(held))
        columns = [
            np.concatenate([np.full(len(b.row), q.row, np.int64) for q, b in zip(queries, best, strict=True)]),
            *[np.concatenate([getattr(b, c) for b in best]) for c in ("row", "id", "score")],
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query", "row", "id", "score"])

    return work


def _pass(asked: DataFrame, texts: DataFrame, top: int) -> list[DataFrame]:
    """Best documents of the queries of one pass over the texts: (query, row, id, score), more than ``top`` a query."""
    vocabulary = asked.select("term").distinct().toArrow().column("term").to_pylist()
    if not vocabulary:
        return []
    numbered = {term: i for i, term in enumerate(sorted(vocabulary))}
    counted = materialize(
        texts.mapInArrow(_counts(numbered), "row bigint, id bigint, n bigint, terms array<int>, tfs array<int>"),
        "term-counts",
    )
    totals = counted.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n")).first()
    documents, total = totals[0], totals[1]
    if not total:
        return []
    frequent = counted.select(F.explode("terms").alias("t")).groupBy("t").count().toArrow()
    df = dict(zip(frequent.column("t").to_pylist(), frequent.column("count").to_pylist(), strict=True))
    weights = {t: weight(n, documents) for t, n in df.items()}
    found = []
    some = counted.filter(F.size("terms") > 0)
    for (number,) in asked.select("block").distinct().orderBy("block").collect():
        table = asked.filter(F.col("block") == number).orderBy("row").toArrow()
        grouped: dict[int, list[tuple[int, int]]] = {}
        for row, term, times in zip(*[table.column(c).to_pylist() for c in ("row", "term", "times")], strict=True):
            t = numbered[term]
            if weights.get(t, 0) > 0:
                grouped.setdefault(row, []).append((t, times * weights[t]))
        places = np.array(sorted({t for pairs in grouped.values() for t, _ in pairs}), np.int64)
        queries = []
        for row, pairs in grouped.items():
            pairs.sort()
            terms = np.searchsorted(places, np.array([t for t, _ in pairs], np.int64))
            queries.append(Query(row, terms, np.array([w for _, w in pairs], np.int64)))
        if queries:
            shape = "query bigint, row bigint, id bigint, score bigint"
            found.append(materialize(some.mapInArrow(_searched(queries, places, documents, total, top), shape), "ranked"))
    return found


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    block_terms: int = BLOCK_TERMS,
    pass_terms: int = PASS_TERMS,
) -> DataFrame:
    """(item, rank, document, score): each item's ``top`` best documents with a score above 0, all if fewer.

    Scores and weights are those of the registered query's contract. Null texts have no terms. Equal scores are ranked
    by document id, null ids last. Rows that repeat a document id are documents of their own, rows that repeat an item
    are items of their own. Without items, documents or shared terms the result is empty. Ids of documents are whole
    numbers. Queries are dealt to blocks of about ``block_terms`` terms, so tasks and driver hold as much for many
    items as for some; texts are read once for every ``pass_terms`` terms.
    """
    spark = docs.sparkSession
    ship(spark)

    def text(name: str):
        return F.coalesce(col(name).cast("string"), F.lit("")).cast("binary").alias("text")

    number = F.monotonically_increasing_id().alias("row")
    named = materialize(items.select(number, col(item_col).alias("item"), text(item_text_col)), "items")
    asked = materialize(named.select("row", "text").mapInArrow(_terms, "row bigint, term binary, times bigint"), "asked")
    texts = docs.select(number, F.coalesce(col(id_col).cast("bigint"), F.lit(_LAST)).alias("id"), text(text_col))
    terms = asked.count()
    blocks = max(1, -(-terms // block_terms))
    per_pass = max(1, pass_terms // block_terms)
    asked = asked.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    found = [
        part
        for first in range(0, blocks, per_pass)
        for part in _pass(asked.filter(F.col("block").between(first, first + per_pass - 1)), texts, top)
    ]
    merged = spark.createDataFrame([], "query bigint, row bigint, id bigint, score bigint")
    for part in found:
        merged = merged.unionByName(part)
    ranked = W.partitionBy("query").orderBy(F.desc("score"), "id", "row")
    best = merged.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= top)
    names = named.select(F.col("row").alias("query"), "item")
    return best.join(names, "query").select(
        F.col("item").alias(item_col), "rank", F.nullif(F.col("id"), F.lit(_LAST)).alias(id_col), "score"
    )
