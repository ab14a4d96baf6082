"""Ranked lexical search: the k documents that score highest for each query text, exactly.

Documents are scored where they lie. Each task takes its partition in blocks and turns a block into an inverted
list for each term. A query's terms are taken one at a time, rarest first. While documents that hold only
the remaining terms could still reach the kth best score known so far, a term opens accumulators for its documents;
after that no accumulator is opened, and those open go on to be updated exactly. The kth best score known is the
larger of the kth partial score of the block and the kth final score of the blocks before it in the task. A
task hands on k documents a query, and the k best of those are the answer.

Queries come to the driver in blocks of a bounded size, so the terms and queries that are broadcast are bounded
whatever the table of queries; the documents are read once for each block. Frequencies, lengths and the number
of documents are counted over all rows.

Scores are integers. A term's weight is floor(1000 * ln((2 * N + 2) / (2 * df + 1))), a document's length factor
m is 100 - 25 + ((25 * n * N) div L), and a query's score sums weight * ((10^9 * tf) div (1000 * tf + 12 * m)) over
its terms, repeats included. N counts the documents with a term, L their terms.

Defined results: a null or empty text has no term, is not in N, and is never found; a query without terms, or one
whose terms no document holds, has no rows. Documents are rows: repeated rows, and rows that share an id, are ranked
each. Equal scores go by ascending id, rows without an id last. A repeated query row is ranked on its own. Without
documents or queries there are no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.llm.plain_terms import term_parts
from wardline.session import written

TOP = 20
# Code points of the queries that one pass over the documents answers, and documents that are scored together.
QUERY_CHARS = 2_000_000
BLOCK = 8192


@dataclass(frozen=True)
class Query:
    """Terms by number, rarest first, with how often the query repeats each times its weight."""

    item: object
    terms: list[int]
    weights: list[int]


def query_blocks(items: DataFrame, item: str, text: str, chars: int = QUERY_CHARS) -> Iterator[list[tuple[object, Counter]]]:
    """(item, terms) of all query rows, in blocks; rows come to the driver one partition at a time."""
    block, size = [], 0
    for row in items.select(F.col(item).alias("item"), F.col(text).alias("text")).toLocalIterator():
        found = Counter()
        for part in term_parts(row["text"]):
            found.update(part)
        if not found:
            continue
        block.append((row["item"], found))
        size += len(row["text"])
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


def postings(docs: DataFrame, id: str, text: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(id, n, terms, counts): how many terms each document has, and its terms that the vocabulary numbers."""
    kind = docs.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            sizes, terms, counts = [], [], []
            for value in batch.column("text"):
                seen = Counter()
                for part in term_parts(value.as_py()):
                    seen.update(part)
                own = [(known[term], n) for term, n in seen.items() if term in known]
                sizes.append(seen.total())
                terms.append([term for term, _ in own])
                counts.append([n for _, n in own])
            columns = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "terms", "counts"])

    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n bigint, terms array<int>, counts array<bigint>")


class Lists:
    """Inverted lists of a block of documents, which are numbered in the order of their ids."""

    def __init__(self, batch: pa.RecordBatch, terms: int, n_docs: int, n_terms: int):
        batch = batch.take(pc.sort_indices(batch.column("id"), sort_keys=[("", "ascending")], null_placement="at_end"))
        self.ids, self.size = batch.column("id"), batch.num_rows
        lengths = batch.column("n").to_numpy()
        each = pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False)
        of = np.repeat(np.arange(self.size), each)
        term, tf = batch.column("terms").flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
        # n * N may pass 64 bits for a very long text among very many; such lengths are divided as whole numbers
        shares = [100 - 25 + (25 * n * n_docs) // n_terms for n in lengths.tolist()] if self.size else []
        norm = np.array(shares, np.int64)
        parts = (1_000_000_000 * tf) // (1000 * tf + 12 * norm[of])
        order = np.argsort(term, kind="stable")
        self.docs, self.parts = of[order], parts[order]
        self.edges = np.searchsorted(term[order], np.arange(terms + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        low, high = self.edges[term], self.edges[term + 1]
        return self.docs[low:high], self.parts[low:high]


def search(lists: Lists, query: Query, k: int, least: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores), best first: the k best of a block with a score above 0 and not under least."""
    found = [lists.of(term) for term in query.terms]
    bounds = [weight * int(parts.max()) if len(parts) else 0 for weight, (_, parts) in zip(query.weights, found, strict=True)]
    remaining = sum(bounds)
    scores, live, opening = np.zeros(lists.size, np.int64), np.zeros(lists.size, bool), True
    for weight, bound, (docs, parts) in zip(query.weights, bounds, found, strict=True):
        if opening:
            partial = scores[live]
            kth = int(np.partition(partial, len(partial) - k)[len(partial) - k]) if len(partial) >= k else 0
            opening = remaining >= max(kth, least)
        if not opening:
            kept = live[docs]
            docs, parts = docs[kept], parts[kept]
        scores[docs] += weight * parts
        live[docs] = True
        remaining -= bound
    docs = np.flatnonzero(scores >= max(1, least))
    docs = docs[np.argsort(-scores[docs], kind="stable")][:k]
    return docs, scores[docs]


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    held, rows = [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            part = batch.slice(at, size)
            if rows and rows + part.num_rows > size:
                yield pa.concat_batches(held)
                held, rows = [], 0
            held.append(part)
            rows += part.num_rows
    if rows:
        yield pa.concat_batches(held)


def _order(pair: tuple[int, object]) -> tuple:
    """Highest score first, then smallest id, then rows without one."""
    score, id = pair
    return (-score, id is None, id) if id is not None else (-score, True)


def best(spark: SparkSession, index: DataFrame, queries: list[Query], terms: int, n_docs: int, n_terms: int, k: int = TOP, size: int = BLOCK) -> DataFrame:
    """(query, id, score): each partition's k best documents of each query, by number of the query."""
    shared = spark.sparkContext.broadcast(queries)
    kind = index.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: list[list[tuple[int, object]]] = [[] for _ in shared.value]
        type_of_id = None
        for block in _blocks(batches, size):
            lists = Lists(block, terms, n_docs, n_terms)
            type_of_id = lists.ids.type
            for number, query in enumerate(shared.value):
                top = tops[number]
                docs, scores = search(lists, query, k, top[-1][0] if len(top) == k else 0)
                if len(docs):
                    new = zip(scores.tolist(), (lists.ids[d].as_py() for d in docs.tolist()), strict=True)
                    tops[number] = sorted([*top, *new], key=_order)[:k]
        if type_of_id is not None:
            rows = [(number, id, score) for number, top in enumerate(tops) for score, id in top]
            arrays = [pa.array([row[at] for row in rows], t) for at, t in enumerate((pa.int32(), type_of_id, pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["query", "id", "score"])

    return index.mapInArrow(run, f"query int, id {kind}, score bigint")


def rank(
    docs: DataFrame, id: str, text: str, items: DataFrame, item: str, item_text: str, k: int = TOP, chars: int = QUERY_CHARS, size: int = BLOCK
) -> DataFrame:
    """(item, rank, id, score): the k documents that score highest for each row of items."""
    spark = docs.sparkSession
    kinds = [frame.select(F.col(name).alias("x")).schema["x"].dataType.simpleString() for frame, name in ((items, item), (docs, id))]
    out = []
    for block in query_blocks(items, item, item_text, chars):
        vocabulary = {term: at for at, term in enumerate(sorted({term for _, terms in block for term in terms}))}
        index = written(postings(docs, id, text, vocabulary), "postings")
        n_docs, n_terms = index.agg(F.sum((F.col("n") > 0).cast("bigint")), F.sum("n")).first()
        if not n_terms:
            return spark.createDataFrame([], f"item {kinds[0]}, rank int, id {kinds[1]}, score bigint")
        df = dict(index.select(F.explode("terms").alias("term")).groupBy("term").count().collect())
        weights = {term: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for term, n in df.items()}
        queries = []
        for name, terms in block:
            own = sorted((df[at], at, n) for term, n in terms.items() if (at := vocabulary[term]) in df)
            queries.append(Query(name, [at for _, at, _ in own], [n * weights[at] for _, at, n in own]))
        found = best(spark, index, queries, len(vocabulary), n_docs, n_terms, k, size)
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
        top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(at, query.item) for at, query in enumerate(queries)], f"query int, item {kinds[0]}")
        out.append(written(top.join(names, "query").select("item", "rank", "id", "score"), "ranked"))
    if not out:
        return spark.createDataFrame([], f"item {kinds[0]}, rank int, id {kinds[1]}, score bigint")
    return reduce(DataFrame.unionAll, out)
