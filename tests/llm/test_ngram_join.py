"""The n-gram Jaccard join against all pairs, with lists cut small, and on awkward tables."""

import random

import numpy as np
import pytest

from check import compare
from tests.llm.conftest import LONG, awkward
from tests.llm.test_shingle_join import WORDS, alike, edited, plain_set, texts
from tests.llm.test_simhash import plain_roots
from wardline.llm import ngram_join, queries


def components(told):
    """Smallest place reachable by links, for each text."""
    sets = [plain_set(x) for x in told]
    near = {(i, j) for i in range(len(told)) for j in range(len(told)) if i == j or (sets[i] and alike(sets[i], sets[j]))}
    return plain_roots(range(len(told)), lambda i, j: (i, j) in near)


def found(spark, told, **options):
    docs = spark.createDataFrame(list(enumerate(told)), "doc_id bigint, text string").repartition(5)
    rows = ngram_join.near_duplicates(docs, "doc_id", "text", **options).collect()
    assert sorted(r["id"] for r in rows) == list(range(len(told)))
    assert all(r["size"] == len(plain_set(told[r["id"]])) for r in rows)
    return {r["id"]: r["component"] for r in rows}


@pytest.mark.parametrize("options", [{}, {"heavy": 2, "block": 3}, {"heavy": 10**6, "block": 16}])
def test_components_are_those_of_all_pairs(spark, options):
    told = texts()
    assert found(spark, told, **options) == components(told)


def test_relatives_are_compared_when_bounds_leave_them_open(spark):
    """Two dense groups whose centres are just too far apart, with members that lie between them."""
    draw = random.Random(11)
    told = []
    for _ in range(12):
        one = draw.choices(WORDS, k=200)
        two = edited(draw, one, 6)
        told += [one, two, *[edited(draw, x, 1) for x in (one, two) for _ in range(6)]]
        told.append([*one[:100], *two[100:]])
    told = [" ".join(x) for x in told]
    assert found(spark, told, block=4) == components(told)


def test_a_shingle_of_very_many_unlike_texts(spark):
    """A passage that 3,000 unlike texts share links none of them; near copies among them are found."""
    draw = random.Random(3)
    passage = draw.choices(WORDS, k=60)
    told = [[*draw.choices(WORDS, k=draw.randint(5, 40)), *passage, *draw.choices(WORDS, k=draw.randint(10, 40))] for _ in range(3000)]
    told += [edited(draw, told[k], 1) for k in range(0, 300, 3)]
    told = [" ".join(x) for x in told]
    got = found(spark, told, heavy=10**6, block=256)
    sets = [plain_set(x) for x in told]
    for k, root in got.items():
        assert root == k or alike(sets[k], sets[root]) or root in got.values()
    for at, k in enumerate(range(0, 300, 3)):
        assert not alike(sets[k], sets[3000 + at]) or got[k] == got[3000 + at]
    assert found(spark, told, heavy=8) == got


def test_bounds_by_bitmaps_and_prefixes_never_lose_a_pair():
    draw = np.random.default_rng(2)
    none = np.zeros(0, np.uint64)
    for _ in range(300):
        pool = np.unique(draw.integers(0, 2**63, draw.choice([60, 900]), dtype=np.uint64))
        one, two = (np.sort(draw.choice(pool, draw.integers(1, len(pool)), replace=False)) for _ in range(2))
        both = len(np.intersect1d(one, two))
        bits = np.array([ngram_join.bitmap(x).tobytes() for x in (one, two, pool)], object)
        apart = ngram_join.apart(bits, np.array([0, 0, 2]), np.array([1, 2, 2]))
        assert (len(one) + len(two) - apart[0]) // 2 >= both
        assert (len(one) + len(pool) - apart[1]) // 2 >= len(one) and apart[2] == 0
        late = np.sort(draw.choice(pool, 20, replace=False))
        for heavy, counts in ((none, none), (late, draw.integers(3, 9, len(late)))):
            first = [set(ngram_join.prefix(x, heavy, counts).tolist()) for x in (one, two)]
            assert 5 * both < 4 * (len(one) + len(two) - both) or first[0] & first[1]


def test_long_texts_in_parts(monkeypatch):
    told = ["", " ", "a", "a b c d", "A b c d e", "x " * 50, LONG[:5000], "É é \x1c\x85 " * 30, "w" * 500 + " b c d e f"]
    whole = [ngram_join.shingles(x) for x in told]
    monkeypatch.setattr(ngram_join, "PART", 7)
    assert all(np.array_equal(x, ngram_join.shingles(y)) for x, y in zip(whole, told, strict=True))
    sizes = [len({tuple(b[k : k + 5]) for k in range(max(1, len(b) - 4))}) if (b := x.encode().lower().split()) else 0 for x in told]
    assert [len(x) for x in whole] == sizes


def test_query_on_awkward_documents(spark, docs, store):
    rows = queries.op11_ngram_join(spark, store(documents=docs)).collect()
    assert len(rows) == len(awkward())
    got = {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in rows}
    assert got[1, 11] == got[2, 11] == 1
    assert got[4, 0] == 4 and got[5, 0] == 5 and got[6, 0] == 6 and got[None, 0] is None  # the empty set links with nothing
    assert got[9, 1] == 9 and {c for (i, _), c in got.items() if i == 3} == {3}


def test_query_over_an_empty_table(spark, no_docs, store):
    assert queries.op11_ngram_join(spark, store(documents=no_docs)).collect() == []


def test_hot_copies_are_one_set(spark, store):
    rows = [(k, "one text that very many rows of the table repeat word for word", None, None, None) for k in range(400)]
    docs = spark.createDataFrame([*rows, (1000, "one text that very many rows of the table repeat word for word again", None, None, None)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = queries.op11_ngram_join(spark, store(documents=docs)).collect()
    assert {r["component_id"] for r in got} == {0} and len(got) == 401


def test_query_equals_its_sql_on_sf_0_01(spark):
    assert compare(spark, "/root/testdata/sf0.01", "op11_ngram_join") is None
