"""The pipeline's stages against plain versions of what they decide, and on awkward tables."""

import pytest

import corpus_pipeline as pipeline
from tests.llm.test_matching import plain_hits
from tests.llm.test_shingle_join import alike
from tests.llm.test_simhash import plain_roots
from wardline.llm import queries
from wardline.session import written

SF = "/root/testdata/sf0.001"


def ids(frame):
    return sorted(r["doc_id"] for r in frame.select("doc_id").collect())


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage leaves of the test documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), name))
    return out


def test_stages_only_drop_rows(stages):
    for before, after in zip(stages, stages[1:-1], strict=False):
        assert after.columns == before.columns and after.exceptAll(before).count() == 0


def test_languages(spark, stages):
    assert ids(stages[1]) == ids(stages[0])  # every test document is in a language


def test_quality_goes_by_labels(spark, stages):
    marks = {r["doc_id"]: r["quality"] for r in queries.read(spark, SF, "labels").collect()}
    kept = set(ids(stages[2]))
    told = [marks[i] == (i in kept) for i in ids(stages[1]) if i in marks]
    assert sum(told) >= 0.97 * len(told)


def test_one_of_each_group_stays(stages):
    """Groups of texts that are linked by a Jaccard similarity of 0.8 over five-word shingles, by all pairs."""
    before = {}
    for row in stages[2].collect():
        words = row["text"].encode().lower().split()
        before[row["doc_id"]] = frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))
    roots = plain_roots(before, lambda a, b: alike(before[a], before[b]))
    least = {}
    for i in sorted(before, reverse=True):
        least[roots[i]] = i
    assert ids(stages[3]) == sorted(least.values()) and len(least) < len(before)


def test_contaminated_rows_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    clean = [r["doc_id"] for r in stages[3].collect() if not plain_hits(r["text"], items)[1]]
    assert ids(stages[4]) == sorted(clean)


def test_tokens_of_what_is_left(stages):
    assert ids(stages[5]) == ids(stages[4])
    assert {r["decoded_sha256"] for r in stages[5].collect()} == {queries._hex(r["text"]) for r in stages[4].collect()}


def test_run_applies_all_stages(spark, stages):
    assert sorted(map(tuple, pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1].collect()))


@pytest.mark.parametrize("empty", [False, True])
def test_awkward_documents(spark, docs, store, empty):
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id bigint, quality int, toxic int")
    bench = spark.createDataFrame([(1, "no id at all here"), (None, None)], "item_id bigint, text string")
    rows = docs.limit(0) if empty else docs
    folder = store(documents=rows, labels=labels, benchmark=bench)
    for _, stage in pipeline.STAGES[:-1]:
        kept = stage(spark, rows, folder)
        assert kept.columns == docs.columns
        rest = kept.collect()
        assert len(rest) <= docs.count()
    assert pipeline.run(spark, folder).count() == 0 if empty else pipeline.run(spark, folder).count() > 0


def test_near_duplicates_without_ids(spark, docs):
    kept = [tuple(r)[:2] for r in pipeline.near_duplicates(spark, docs, "").collect()]
    assert len(kept) == len(set(kept)) and {i for i, _ in kept} >= {1, 3, 7, 8, 9}
    assert 2 not in {i for i, _ in kept}  # a copy of 1
