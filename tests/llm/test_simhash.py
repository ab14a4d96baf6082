"""Fingerprints and components against brute force."""

import random

import pytest
import xxhash

from tests.llm.conftest import awkward
from wardline.llm import queries, simhash
from wardline.llm.components import components


def plain_print(text, size=4):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(nodes, near):
    """Smallest node reachable from each."""
    root = {}
    for start in sorted(nodes):
        stack = [start] if start not in root else []
        while stack:
            at = stack.pop()
            if at not in root:
                root[at] = start
                stack += [x for x in nodes if x not in root and near(at, x)]
    return root


def test_prints_are_plain_ones(monkeypatch):
    for step in (100_000, 7):
        monkeypatch.setattr(simhash, "STEP", step)
        for _, text, _ in awkward():
            assert simhash.fingerprint((text or "")[:3000]) == plain_print((text or "")[:3000])


def groups(n, seed):
    """Dense groups around a few centres, and values on their own."""
    draw, out = random.Random(seed), set()
    for _ in range(6):
        centre = draw.getrandbits(64)
        for _ in range(n):
            out.add(centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 5))))
    return sorted(out | {draw.getrandbits(64) for _ in range(n)} | {0, 1, (1 << 64) - 1})


@pytest.mark.parametrize(("large", "max_bits", "agree"), [(4096, 4, 2), (5, 4, 2), (4096, 7, 2), (5, 3, 1), (4096, 0, 2)])
def test_links_connect_what_all_links_would(spark, monkeypatch, large, max_bits, agree):
    monkeypatch.setattr(simhash, "LARGE_KEY", large)
    values = groups(40, seed=max_bits)
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    found = [tuple(r) for r in simhash.links(spark.createDataFrame(signed, "print bigint"), max_bits, agree).collect()]
    near = lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= max_bits
    assert all(near(a, b) for a, b in found)
    linked = {frozenset(pair) for pair in found}
    nodes = [v for (v,) in signed]
    assert plain_roots(nodes, lambda a, b: frozenset((a, b)) in linked) == plain_roots(nodes, near)
    keys = 15 if agree == 2 else 4
    assert len(found) <= len(nodes) * keys * 10  # trees, not pairs


def test_batches_cut_keys_anywhere(spark):
    values = [(v - (1 << 63),) for v in groups(40, seed=9)]
    frame = spark.createDataFrame(values, "print bigint")
    whole = {tuple(r) for r in simhash.roots(frame).collect()}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert {tuple(r) for r in simhash.roots(frame).collect()} == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_components(spark):
    chain = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, None), (100, 101)]
    star = [(1000, 1001 + i) for i in range(50)] + [(1050, 1200)]
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain + star, "a bigint, b bigint"), "a", "b").collect()}
    assert found == {**{i: 0 for i in range(61)}, 100: 100, 101: 100, **{1000 + i: 1000 for i in range(51)}, 1200: 1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint"), "a", "b").collect() == []


def test_query(spark, docs, no_docs, store):
    rows = queries.op7_simhash(spark, store(documents=docs)).collect()
    assert len(rows) == docs.count()
    prints = {(i, plain_print(t)) for i, t, _ in awkward()}
    assert {(r["doc_id"], int(r["fingerprint"], 16)) for r in rows} == prints
    nodes = {p for _, p in prints}
    roots = plain_roots(nodes, lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, p in prints:
        if i is not None:
            least[roots[p]] = min(i, least.get(roots[p], i))
    assert all(r["component_id"] == least.get(roots[int(r["fingerprint"], 16)]) for r in rows)
    assert {r["component_id"] for r in rows if r["doc_id"] in (4, 5, 6)} == {4}


def test_query_over_an_empty_table(spark, no_docs, store):
    assert queries.op7_simhash(spark, store(documents=no_docs)).collect() == []
