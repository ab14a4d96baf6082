"""Importance resampling against a plain version that sorts everything, and on awkward tables."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.conftest import awkward
from tests.llm.test_lexical_search import plain_terms
from wardline.llm import queries, resampling


def plain_features(text, run):
    words = plain_terms(text)
    return [" ".join(words[k : k + n]) for n in range(1, run + 1) for k in range(len(words) - n + 1)]


def plain_draw(docs, target, percent=10, least_words=20, run=1, buckets=10_000, seed=2024):
    """(id, n_features, weight, score, rank) of all rows."""
    of = lambda t: zlib.crc32(t.encode()) % buckets
    own = Counter(of(f) for _, t in docs for f in plain_features(t, run))
    wanted = Counter(of(f) for t in target for f in plain_features(t, run))
    total, goal = own.total(), wanted.total()
    rows = []
    for i, text in docs:
        found = [of(f) for f in plain_features(text, run)]
        each = [math.floor(1000 * math.log((wanted[b] + 1) * (total + buckets) / ((own[b] + 1) * (goal + buckets)))) for b in found]
        weight = sum(each) // len(each) if each else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(plain_terms(text))])
    able = sorted((r for r in rows if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for at, row in enumerate(able[: len(able) * percent // 100]):
        row[4] = at + 1
    return sorted(str(tuple(r[:5])) for r in rows)


def made(draw, n):
    vocabulary = [f"t{k}" for k in range(300)]
    docs = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([0, 3, 19, 20, 21, 60])))) for k in range(n)]
    docs += [(k, docs[5][1] + " more" * 30) for k in range(n, n + 30)] + [(n + 1, "x " * 20)] * 3 + [(None, "y " * 30), (n + 50, None)]
    return docs, [" ".join(draw.choices(vocabulary[:40], k=50)) for _ in range(10)] + [None, ""]


@pytest.mark.parametrize("options", [{}, {"few": 5}, {"run": 2, "buckets": 64, "percent": 50, "few": 3}, {"percent": 0}, {"percent": 100, "least_words": 0, "few": 1}])
def test_draw_is_that_of_sorting_everything(spark, options):
    docs, target = made(random.Random(6), 500)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(6)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    got = resampling.resample(frame, "doc_id", "text", wanted, "text", **options).collect()
    plain = {k: v for k, v in options.items() if k != "few"}
    ranks = sorted(r["rank"] for r in got if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1))
    # rows that are equal in id and text share their places in any order
    assert sorted(str(tuple(r)) for r in got) == plain_draw(docs, target, **plain)


@pytest.mark.parametrize("count", [1, 2, 499, 500, 501, 999, 1000])
def test_cutoff_is_the_key_at_its_place(spark, count):
    draw = random.Random(count)
    keys = [(draw.randint(0, 30), draw.choice([None, *range(50)]), k) for k in range(1000)]
    frame = spark.createDataFrame(keys, "score bigint, id bigint, row bigint").repartition(7)
    key = resampling.cutoff(frame, count, few=4)
    wanted = sorted(({"score": s, "id": i, "row": r} for s, i, r in keys), key=resampling._place)[count - 1]
    assert {k: key[k] for k in wanted} == wanted


def test_weighted_median_leaves_a_quarter_on_either_side():
    draw = random.Random(1)
    for _ in range(200):
        parts = [sorted(draw.choices(range(1000), k=draw.randint(1, 40))) for _ in range(draw.randint(1, 9))]
        medians = [{"score": -p[(len(p) - 1) // 2], "id": at, "row": 0, "n": len(p)} for at, p in enumerate(parts)]
        middle, total = -resampling.weighted_median(medians)["score"], sum(map(len, parts))
        values = [x for p in parts for x in p]
        assert sum(x <= middle for x in values) * 4 >= total and sum(x >= middle for x in values) * 4 >= total


def test_features_of_long_texts_in_parts(monkeypatch):
    import wardline.llm.plain_terms as plain

    text = "One two, three four five six SEVEN eight " * 20
    found = [resampling.Features(97).of(text, run) for run in (1, 2, 3)]
    whole = [np.sort(np.concatenate([f for _, f in parts])).tolist() for parts in found]
    monkeypatch.setattr(resampling, "term_parts", lambda t: plain.term_parts(t, size=9))
    cut = [np.sort(np.concatenate([f for _, f in resampling.Features(97).of(text, run)])).tolist() for run in (1, 2, 3)]
    assert whole == cut == [sorted(zlib.crc32(f.encode()) % 97 for f in plain_features(text, run)) for run in (1, 2, 3)]


def test_query_on_awkward_tables(spark, docs, store):
    bench = spark.createDataFrame([(5, "over the lazy dog", 3), (None, None, None)], "item_id bigint, text string, score int")
    got = queries.op13_resampling(spark, store(documents=docs, benchmark=bench)).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_draw([(i, t) for i, t, _ in awkward()], ["over the lazy dog"])


@pytest.mark.parametrize("left", ["documents", "benchmark"])
def test_query_with_an_empty_table(spark, docs, store, left):
    tables = {"documents": docs, "benchmark": spark.createDataFrame([(5, "over the lazy dog")], "item_id bigint, text string")}
    tables[left] = tables[left].limit(0)
    got = queries.op13_resampling(spark, store(**tables)).collect()
    assert len(got) == (0 if left == "documents" else len(awkward()))
