"""Decontamination, licence phrases and url rules: against SQL, brute force, and on awkward rows."""

import random

import pytest

from check import compare
from tests.llm.conftest import awkward
from wardline.llm import decontamination, license_scan, queries, url_filter
from wardline.llm.license_scan import plain_words

NATIVE = ("op4_url_filter", "op6_decontamination")
SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    assert compare(spark, SF, name) is None


@pytest.mark.parametrize("name", NATIVE)
def test_native_plans_have_no_python(spark, name):
    text = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in text for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "BroadcastNestedLoopJoin"))


def plain_hits(text, items):
    words, hit, found = plain_words(text or ""), set(), set()
    for item, body in items:
        own = plain_words(body or "")
        for k in range(max(1, len(own) - 9)) if own else ():
            run = own[k : k + 10]
            for at in range(len(words) - len(run) + 1):
                if words[at : at + len(run)] == run:
                    hit.update(range(at, at + len(run)))
                    found.add("" if item is None else str(item))
    return len(words), len(hit), sorted(found)


def test_overlaps_are_those_brute_force_finds(spark):
    draw = random.Random(5)
    vocabulary = ["the", "The", "of", "É", "é", "b2", "rare", "x"]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.choice([1, 2, 9, 10, 11, 14])))) for k in range(12)]
    items += [(3, items[0][1]), (None, "rare rare"), (40, None), (41, " -- "), (42, items[1][1]), (10, "the of the of the of the of the of the of")]
    texts = []
    for k in range(60):
        parts = [" ".join(draw.choices(vocabulary, k=draw.randint(0, 12))) for _ in range(3)]
        parts.insert(draw.randint(0, 3), draw.choice(items)[1] or "")
        texts.append((k % 50, draw.choice([" ", "-", "\n"]).join(parts)))
    texts += [(1, None), (2, ""), (None, items[0][1]), (7, "of the " * 200), *[(8, items[9][1])] * 5]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = [(r["id"], r["n_words"], r["n_hit"], r["items"]) for r in decontamination.overlaps(frame, "doc_id", "text", bench, "item_id", "text").collect()]
    assert sorted(map(str, found)) == sorted(str((i, *plain_hits(t, items))) for i, t in texts)
    assert sum(r[2] > 0 for r in found) > 20


def test_overlap_query_on_awkward_tables(spark, docs, no_docs, store):
    bench = spark.createDataFrame([(5, "over the lazy dog near the old river bank today"), (None, None)], "item_id bigint, text string")
    rows = queries.op6_decontamination(spark, store(documents=docs, benchmark=bench)).collect()
    assert len(rows) == docs.count()
    assert {r["doc_id"] for r in rows if r["contaminated"]} == {1, 2} and {r["n_hit"] for r in rows if r["contaminated"]} == {10}


@pytest.mark.parametrize("left", ["documents", "benchmark"])
def test_overlap_query_with_an_empty_table(spark, docs, no_docs, store, left):
    bench = spark.createDataFrame([(5, "over the lazy dog")], "item_id bigint, text string")
    tables = {"documents": docs, "benchmark": bench}
    tables[left] = tables[left].limit(0)
    rows = queries.op6_decontamination(spark, store(**tables)).collect()
    assert len(rows) == (0 if left == "documents" else docs.count()) and not any(r["contaminated"] for r in rows)


def licences(spark, *texts):
    frame = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string")
    return {r["id"]: r for r in license_scan.scan(frame, "doc_id", "text").collect()}


def test_phrases_at_all_places(spark):
    rows = licences(spark, "All rights Reserved. x CC-BY cc by, all rights reserved General Public License", "CC", "by", "all rights", None, "", "cc bý", "ALL  RIGHTS\nRESERVED " * 2)
    assert tuple(rows[0])[1:6] == (14, 5, 0, 11, ["cc-by", "gpl", "reserved"]) and rows[0]["score"] == 1.0
    assert all(rows[k]["n_base"] == 0 and rows[k]["first_word"] is None and rows[k]["labels"] == [] and rows[k]["score"] == 0 for k in range(1, 7))
    assert (rows[7]["n_base"], rows[7]["first_word"], rows[7]["last_word"]) == (2, 0, 3)


def test_notices_with_changes_are_found_and_scattered_runs_are_not(spark):
    notice = license_scan.NOTICES[1][0].split()
    changed = notice[:20] + ["(as", "amended)"] + notice[20:33] + notice[34:]
    scattered = " ".join(" ".join(notice[k : k + 4]) + " filler" * 40 for k in range(0, len(notice), 4))
    rows = licences(spark, " ".join(changed), "Before. " + " ".join(notice) + " After.", scattered, " ".join(notice[:12]))
    assert rows[0]["labels"] == ["mit"] and 0.6 <= rows[0]["score"] < 1
    assert rows[1]["labels"] == ["mit"] and rows[1]["score"] == 1.0
    assert rows[2]["labels"] == rows[3]["labels"] == []


def test_sibling_notices_are_told_apart(spark):
    kinds = ["", "-ShareAlike", "-NonCommercial", "-NoDerivatives", "-NonCommercial-NoDerivatives", "-NonCommercial-ShareAlike"]
    told = [f"This work is licensed under a Creative Commons Attribution{k} 4.0 International License" for k in kinds]
    rows = licences(spark, *told, f"{told[0]}. {told[1]}.")
    assert [rows[k]["labels"] for k in range(7)] == [["cc-by"], ["cc-by-sa"], [], [], [], [], ["cc-by", "cc-by-sa"]]
    assert [rows[k]["score"] for k in range(7)] == [1.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]


def test_licence_query_on_awkward_documents(spark, docs, no_docs, store):
    rows = queries.op10_license_scan(spark, store(documents=docs)).collect()
    assert sorted(map(str, ((r["doc_id"], r["n_words"]) for r in rows))) == sorted(str((i, len(plain_words(t or "")))) for i, t, _ in awkward())


def test_licence_query_over_an_empty_table(spark, no_docs, store):
    assert queries.op10_license_scan(spark, store(documents=no_docs)).collect() == []


PAGES = [
    (1, "http://Example.ORG/es/a", None),
    (2, "http://elsewhere.net/a?x=1#frag", '<LINK href="http://example.org/es/a#top" REL="x canonical">'),
    (3, "http://elsewhere.net/b", "<link rel=canonical href=/a?x=1>"),
    (4, "http://other.net/c", "<meta content='0; url=http://elsewhere.net/b' http-equiv=Refresh>"),
    (5, "http://site.com/de/x", '<link rel="canonical" href="//site.com/fr/y">'),
    (6, "http://alias.net/z", "<link rel='canonical' href='http://site.com/de/x'>"),
    (7, "http://lonely.net/", '<link rel="stylesheet" href="http://example.org/es/a"><a href="http://example.org/es/a">'),
    (8, None, '<link rel="canonical" href="http://example.org/es/a">'),
    (9, "no scheme", '<link rel="canonical" href="http://example.org/es/a">'),
    (10, "http://rel.net/dir/page", '<link rel="canonical" href="other">'),
    (11, "http://rel.net/dir/other", '<meta http-equiv="refresh" content="5;url=http://sub.example.org/en/1x">'),
    (12, "https://a.org", ""),
    (13, "http://b.example.org/en/1?q", None),
    (None, "http://alias.net/z", None),
    (14, "http://empty.net/", '<link rel="canonical" href=""><link rel="canonical">'),
    (15, "http://q.net/?a=1&b=2", None),
    (16, "http://r.net/", '<link rel="canonical" href="http://q.net/?a=1&amp;b=2"><link rel="canonical" href="http://com/de/">'),
    (17, "x://y://com/fr/", None),
]
VERDICTS = {
    1: ("example.org/es/", "block"), 2: (None, "block"), 3: (None, "block"), 4: (None, "block"), 5: ("com/de/", "block"),
    6: (None, "allow"), 7: (None, "allow"), 8: (None, "allow"), 9: (None, "allow"), 10: (None, "block"), 11: (None, "block"),
    12: (None, "allow"), 13: ("example.org/en/1", "block"), None: (None, "allow"), 14: (None, "allow"), 15: (None, "block"),
    16: (None, "block"), 17: (None, "allow"),
}


@pytest.fixture
def pages(spark):
    rows = [(i, url, html, "h", "r") for i, url, html in PAGES * 2]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string, host string, rule string")


def test_verdicts_reach_aliases(spark, pages, store):
    folder = store(pages=pages)
    rows = queries.op4_url_filter(spark, folder).collect()
    assert len(rows) == 2 * len(PAGES)
    assert {r["page_id"]: (r["rule"], r["verdict"]) for r in rows} == VERDICTS
    where = {r["page_id"]: (r["host"], r["path"]) for r in rows}
    assert where[1] == ("example.org", "/es/a") and where[2] == ("elsewhere.net", "/a") and where[12] == ("a.org", "")
    assert where[8] == where[9] == ("", "") and where[17] == ("y:", "//com/fr/")


def test_verdicts_equal_their_sql_with_links(spark, pages, store, monkeypatch):
    import check

    folder = store(pages=pages)
    monkeypatch.setattr(check, "TABLES", ["pages"])
    monkeypatch.setattr(check, "open_tables", lambda _: __import__("duckdb").sql(f"create or replace view pages as select * from '{folder}/pages.parquet/*.parquet'") or __import__("duckdb"))
    assert compare(spark, folder, "op4_url_filter") is None


def test_url_query_over_an_empty_table(spark, pages, store):
    assert queries.op4_url_filter(spark, store(pages=pages.limit(0))).collect() == []


def test_longest_rule_wins(spark):
    rules = url_filter.rule_table(spark, [("a.net", "/", "block"), ("net", "/deep/er/", "allow"), ("b.a.net", "/deep", "block")])
    urls = spark.createDataFrame([("x.b.a.net", "/deep/er/1"), ("a.net", "/deep/er/1"), ("xa.net", "/"), ("a.net", ""), ("", "")], "host string, path string")
    found = {(r["host"], r["path"]): r["rule"] for r in url_filter.decide(urls, rules).collect()}
    assert list(found.values()).count(None) == 3
    assert found["x.b.a.net", "/deep/er/1"] == "net/deep/er/" and found["a.net", "/deep/er/1"] == "net/deep/er/"
