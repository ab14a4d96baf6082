"""Near texts of the pipeline against all pairs compared by their shingles."""

import random

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_simhash import plain_print, plain_roots
from wardline.llm import shingle_join

WORDS = [f"w{k}" for k in range(5000)]


def plain_set(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def alike(a, b):
    return 5 * len(a & b) >= 4 * len(a | b)


def edited(draw, words, edits):
    out = list(words)
    for at in draw.sample(range(len(out)), edits):
        out[at] = draw.choice(WORDS)
    return out


def texts():
    """Originals of 60 to 400 words with copies of 1 to 4 % changed words, a dense group, a shared beginning."""
    draw, out = random.Random(4), []
    line = draw.choices(WORDS, k=60)
    for k in range(40):
        own = draw.choices(WORDS, k=draw.choice([60, 150, 400]))
        out += [own, *[edited(draw, own, max(1, round(len(own) * draw.choice([0.01, 0.02, 0.025, 0.03, 0.04])))) for _ in range(4)]]
        out.append(line + draw.choices(WORDS, k=draw.choice([12, 15, 20, 200])))
    centre = draw.choices(WORDS, k=120)
    out += [edited(draw, centre, draw.randint(0, 4)) for _ in range(60)]
    return [" ".join(x) for x in out] + ["", "one", "one two", "ONE two"]


@pytest.mark.parametrize(("many", "common"), [(4, 10), (0, 2), (10**9, 10**9)])
def test_stage_links_what_all_pairs_would(spark, monkeypatch, many, common):
    monkeypatch.setattr(shingle_join, "MANY", many)
    monkeypatch.setattr(shingle_join, "COMMON", common)
    told = texts()
    sets = [plain_set(x) for x in told]
    near = {(i, j) for i in range(len(told)) for j in range(len(told)) if alike(sets[i], sets[j])}
    assert sum(5 * len(sets[i] & sets[j]) < 4.25 * len(sets[i] | sets[j]) for i, j in near if i < j) > 10
    roots = plain_roots(range(len(told)), lambda i, j: (i, j) in near)
    docs = spark.createDataFrame(list(enumerate(told)), "doc_id bigint, text string")
    kept = sorted(r["doc_id"] for r in pipeline.near_duplicates(spark, docs, "").collect())
    assert kept == sorted(set(roots.values()))


def test_near_prints_alone_do_not_link(spark):
    """Texts within 7 bits of each other whose shingles are less alike all stay."""
    told = texts()
    sets, prints = [plain_set(x) for x in told], [plain_print(x, 5) for x in told]
    pairs = [(i, j) for i in range(len(told)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 7 and not alike(sets[i], sets[j])]
    assert len(pairs) > 5
    for pair in pairs[:2]:
        docs = spark.createDataFrame([(k, told[k]) for k in pair], "doc_id bigint, text string")
        assert pipeline.near_duplicates(spark, docs, "").count() == 2
