"""Chat templates and MinHash fingerprints: round trips, brute force, and awkward rows."""

import hashlib
import pickle
import random

import pytest

from tests.llm.conftest import LONG, awkward
from wardline.llm import minhash, queries
from wardline.llm.chat_template import Branch, Literal, Output, Template, TemplateError, turns_of, turns_template

CONTROLS = ["<s>", "</s>", "[INST]", "[/INST]", "\\", "[", "<", "INST]", " ", "ok", "\n", "[\\INST]", "é"]


def render(source, control=(), constants=None, **values):
    return Template(source, control, constants).render(**values)


def test_language():
    items = [{"a": "x", "n": 1}, {"a": "y", "n": 2}]
    source = "{# no #}{% for i in items -%} {{ loop.index }}{{ i['a'] | upper }}{% if not loop.last %}, {% elif i.n >= 2 and i.a in 'xyz' %}.{% else %}?{% endif %}{% endfor %}"
    assert render(source, items=items)[0] == "1X, 2Y."
    assert render("{% set x = 'a' + \"b\" %}{{ x ~ 3 }}{{ none }}{{ missing.key }}{{ 1 if false or x == 'ab' else 2 }}{{ items | length }}", items=items)[0] == "ab312"
    assert render("a  {{- 'b' -}}  c{{ '\\n' }}")[0] == "abc\n"


def test_generation_spans_count_code_points():
    text, spans = render("é{% generation %}{{ t }}!{% endgeneration %}-{% generation %}{% endgeneration %}", t="\U0001f600x")
    assert text == "é\U0001f600x!-" and spans == [(1, 4), (5, 5)]


def test_constants_are_folded():
    made = Template("{{ bos }}a{% if ask and x %}b{% endif %}{% if 1 < 2 %}c{{ 'd' | upper }}{% endif %}{% if false %}{{ y }}{% endif %}", (), {"bos": "<", "ask": False})
    assert made.tree == (Output(Literal("<acD")),)
    assert isinstance(Template("{% if x %}{{ 'a' ~ 'b' }}{% endif %}").tree[0], Branch)
    assert Template("{% set bos = 'z' %}{{ bos }}", (), {"bos": "<"}).render()[0] == "z"


@pytest.mark.parametrize("source", ["{{ x( ) }}", "{{ x | open }}", "{% import os %}", "{{ }}", "{% for x in %}{% endfor %}", "{% if x %}", "{{ 'a' + 1 }}", "{{ ((" + "(" * 50 + "1" + ")" * 52 + " }}", "{{ a b }}", "x" * 200_000])
def test_what_is_refused(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_sandbox():
    assert render("{{ x.__class__ }}{{ x['__len__'] }}", x="text")[0] == ""
    with pytest.raises(TemplateError):
        render("{% for c in x %}{{ c }}{% endfor %}", x="text")


def test_escaping_round_trip():
    template, draw = turns_template(), random.Random(3)
    for _ in range(3000):
        turns = [{"role": draw.choice(["user", "assistant", "".join(draw.choices(CONTROLS, k=3))]), "text": "".join(draw.choices(CONTROLS, k=draw.randint(0, 6)))} for _ in range(draw.randint(0, 4))]
        text, spans = template.render(messages=turns)
        assert turns_of(template, text) == [(t["role"], t["text"]) for t in turns]
        assert [template.escaper.unescape(text[a:b]) for a, b in spans] == [t["text"] for t in turns if t["role"] == "assistant"]
        bare = text
        for control in ("</s>", "<s>", "[INST]", "[/INST]"):
            expected = {"<s>": 1}.get(control, len(turns))
            assert bare.count(control) == expected
    assert pickle.loads(pickle.dumps(template)).render(messages=[]) == template.render(messages=[])
    assert turns_template(ask=True).render(messages=[])[0] == "<s>[INST] assistant [/INST] "


def test_chat_query(spark, store):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (1, 1, "assistant", None), (1, None, None, "first"), (2, 0, "assistant", LONG), (None, 5, "user", "n"), (None, 4, "assistant", "</s>"), *[(3, 0, "user", "same")] * 3]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, spans int")
    found = {r["conv_id"]: r for r in queries.op1_chat_format(spark, store(conversations=frame)).collect()}
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    assert set(found) == {1, 2, 3, None, -7}
    assert (found[1]["n_turns"], found[1]["turns_sha256"]) == (4, digest("\nfirst\nuser\na\nassistant\n\nassistant\nb\n"))
    assert (found[1]["loss_chars"], found[1]["loss_sha256"]) == (1, digest("b"))
    assert found[2]["loss_sha256"] == digest(LONG) and found[2]["loss_chars"] == len(LONG)
    assert found[None]["turns_sha256"] == digest("assistant\n</s>\nuser\nn\n") and found[3]["n_turns"] == 3
    assert found[-7]["turns_sha256"] == digest("user\n</s>[INST] ok [/INST]\nassistant\n</s>[INST] ok [/INST]\n")
    assert found[-7]["loss_sha256"] == digest("</s>[INST] ok [/INST]")


def test_chat_query_over_an_empty_table(spark, store):
    frame = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert [r["conv_id"] for r in queries.op1_chat_format(spark, store(conversations=frame)).collect()] == [-7]


def shingles(text):
    words = text.encode().lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_likeness_estimates_the_jaccard_likeness():
    draw, errors = random.Random(8), []
    words = [f"w{k}" for k in range(5000)]
    for _ in range(60):
        base = draw.choices(words, k=draw.choice([12, 60, 400]))
        other = [draw.choice(words) if draw.random() < draw.choice([0, 0.01, 0.05, 0.2]) else w for w in base]
        a, b = " ".join(base), " ".join(other)
        real = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        errors.append(minhash.likeness(minhash.fingerprint(a), minhash.fingerprint(b)) - real)
    assert max(map(abs, errors)) < 0.35 and abs(sum(errors)) / len(errors) < 0.03
    assert sum(e * e for e in errors) / len(errors) < 0.01


def test_equal_and_unlike_texts(monkeypatch):
    for _, text, _ in awkward():
        own = minhash.fingerprint(text)
        assert own == minhash.fingerprint(text or "") and minhash.likeness(own, own) == 1.0 and len(own) == 128
    assert minhash.fingerprint(None) == minhash.fingerprint("  ") == bytes(128)
    assert minhash.likeness(minhash.fingerprint("a b c d e f g h"), bytes(128)) < 0.2
    whole = minhash.fingerprint(LONG)
    monkeypatch.setattr("wardline.llm.texts.PART", 64)
    monkeypatch.setattr("wardline.llm.minhash.parts", lambda text: split(text, 64))
    assert minhash.fingerprint(LONG) == whole


split = minhash.parts


@pytest.mark.parametrize("partitions", ["1", "4", "50"])
def test_fingerprint_query(spark, docs, store, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = queries.op8_minhash(spark, store(documents=docs)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) as h").collect()}
    order = sorted(((i, t) for i, t, _ in awkward()), key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]], r[1] or ""))
    expected = []
    for (i, t), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        changed = queries.edited(t or "", after or "")
        a, b, c = map(minhash.fingerprint, (t, changed, after))
        expected.append((i, len(t or ""), hashlib.sha256(changed.encode()).hexdigest(), a.hex(), b.hex(), minhash.likeness(a, b), minhash.likeness(a, c)))
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_fingerprint_query_of_few_rows(spark, docs, no_docs, store, tmp_path):
    assert queries.op8_minhash(spark, store(documents=no_docs)).collect() == []
    docs.where("doc_id = 1").write.parquet(f"{tmp_path}/one/documents.parquet")
    row = queries.op8_minhash(spark, f"{tmp_path}/one").first()
    text = awkward()[0][1]
    assert row["edited_sha256"] == hashlib.sha256(queries.edited(text, text).encode()).hexdigest() and row["near_next"] == 1.0
