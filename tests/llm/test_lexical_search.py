"""Ranked search against scores of all pairs, and on awkward tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import awkward
from wardline.llm import lexical_search, queries
from wardline.llm.plain_terms import term_parts


def plain_terms(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain_ranks(docs, items, k=20):
    """(item, rank, id, score) by scoring every pair."""
    own = [(i, Counter(plain_terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, n_terms = len(own), sum(c.total() for _, c in own)
    df = Counter(t for _, c in own for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, counts in own:
            m = 100 - 25 + (25 * counts.total() * n_docs) // n_terms
            score = 0
            for term in plain_terms(text):
                if term in counts:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[term] + 1)))
                    score += weight * ((1_000_000_000 * counts[term]) // (1000 * counts[term] + 12 * m))
            if score > 0:
                scored.append((-score, i is None, i))
        scored.sort(key=lambda x: x if x[2] is not None else x[:2])
        out += [(item, at + 1, i, -s) for at, (s, _, i) in enumerate(scored[:k])]
    return out


def made(draw, n):
    vocabulary = [f"t{k}" for k in range(60)] + ["É", "é", "x9"]
    shares = [1 / (k + 1) for k in range(len(vocabulary))]
    docs = [(k, " ".join(draw.choices(vocabulary, shares, k=draw.choice([0, 1, 5, 30, 200])))) for k in range(n)]
    docs += [(k, docs[7][1]) for k in range(n, n + 40)] + [(3, docs[9][1]), (None, docs[7][1]), (n + 99, None), (n + 98, "- ' .")]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([1, 3, 12, 40])))) for k in range(15)]
    return docs, [*items, (4, items[5][1]), (None, "T1-t2 T2"), (50, None), (51, "nowhere"), (52, docs[7][1])]


@pytest.mark.parametrize("options", [{}, {"size": 16}, {"size": 16, "chars": 40, "k": 3}])
def test_ranks_are_those_of_all_pairs(spark, options):
    docs, items = made(random.Random(8), 300)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    got = [tuple(r) for r in lexical_search.rank(frame, "doc_id", "text", asked, "item_id", "text", **options).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_ranks(docs, items, options.get("k", 20))))


def test_accumulators_are_limited_and_scores_stay_exact():
    """A document with the rare term opens; those with only the common one are never opened, and no score changes."""
    terms = [[0, 1]] * 3 + [[1]] * 500
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(503)), pa.array([len(t) for t in terms], pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array([[1] * len(t) for t in terms], pa.list_(pa.int64()))],
        names=["id", "n", "terms", "counts"],
    )
    lists = lexical_search.Lists(batch, 2, 503, 506)
    touched = []

    class Seen(lexical_search.Lists):
        def __init__(self):
            self.__dict__ = lists.__dict__

        def of(self, term):
            docs, parts = lists.of(term)
            touched.append(len(docs))
            return docs, parts

    query = lexical_search.Query("q", [0, 1], [5000, 10])
    docs, scores = lexical_search.search(Seen(), query, 3)
    assert docs.tolist() == [0, 1, 2] and touched == [3, 503]
    one = lists.parts[lists.edges[0]] * 5000 + lists.parts[lists.edges[1]] * 10
    assert scores.tolist() == [one] * 3
    every, _ = lexical_search.search(lists, query, 4)
    assert every.tolist() == [0, 1, 2, 3]  # a fourth is wanted, so the common term opens one
    none, _ = lexical_search.search(lists, query, 3, least=int(one) + 1)
    assert not len(none)


def test_terms_are_the_maximal_runs():
    for text in ["", None, "It's 12² ÀÉx don't_stop CamelCase\x7fx\x80", "\U0001f600 a　b", "a" * 50 + " " + "B c" * 40]:
        told = [t.encode() for t in plain_terms(text)]
        assert [t for part in term_parts(text) for t in part] == told == [t for part in term_parts(text, size=5) for t in part]


def test_query_on_awkward_tables(spark, docs, store):
    items = [(5, "over the lazy dog near the old river"), (None, "id word"), (6, None), (7, "")]
    bench = spark.createDataFrame([(*row, "x", 1) for row in items], "item_id bigint, text string, id string, score int")
    got = [tuple(r) for r in queries.op12_lexical_search(spark, store(documents=docs, benchmark=bench)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, plain_ranks([(i, t) for i, t, _ in awkward()], items)))


@pytest.mark.parametrize("left", ["documents", "benchmark"])
def test_query_with_an_empty_table(spark, docs, store, left):
    tables = {"documents": docs, "benchmark": spark.createDataFrame([(5, "over the lazy dog")], "item_id bigint, text string")}
    tables[left] = tables[left].limit(0)
    assert queries.op12_lexical_search(spark, store(**tables)).collect() == []


def test_lengths_of_very_long_texts_do_not_overflow():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([10**12]), pa.array([[0]], pa.list_(pa.int32())), pa.array([[10**9]], pa.list_(pa.int64()))], names=["id", "n", "terms", "counts"])
    lists = lexical_search.Lists(batch, 1, 10**10, 10**13)
    m = 75 + (25 * 10**12 * 10**10) // 10**13
    assert lists.parts.tolist() == [(10**18) // (10**12 + 12 * m)] and lists.parts.dtype == np.int64
