"""Both tokenizers against the libraries of their vocabularies."""

import random
import unicodedata

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.conftest import LONG, awkward
from wardline.llm import queries
from wardline.llm.bpe_codec import BpeUdfs, Codec, boundaries
from wardline.llm.token_counts import CountUdfs, PrefixCounter

RANKS, WORDS = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
PIECES = ["'", "s", "t", "re", "Ve", "LL", "d", " ", "\n", "a", "É", "1", "²", "!", ".", "　", "你", "\U0001f600", "\x1c", "\x85", "Σ", "İ", "é", "<|", "|>", "<|endoftext|>", "the", "ing"]


def texts(n, seed=1):
    draw = random.Random(seed)
    return ["".join(draw.choices(PIECES, k=draw.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as file:
        return Codec(file.read())


@pytest.fixture(scope="module")
def counter():
    with open(WORDS, "rb") as file:
        return PrefixCounter(file.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORDS)


def count(library, text):
    return len(library.encode(text, add_special_tokens=False).ids)


def reference(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.merges.ranks, special_tokens={})


def every_letter(size):
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(0, len(letters), size):
        yield " ".join(f"a{c}b1{c}2!{c}?" for c in letters[k : k + size])


def test_ids_are_the_library_ones(codec):
    own = [t for _, t, _ in awkward() if t] + texts(3000) + [""]
    ids, begin = codec.encode(own)
    expected = [reference(codec).encode_ordinary(t) for t in own]
    assert [ids[a:b].tolist() for a, b in zip(begin, begin[1:], strict=False)] == expected
    assert codec.decode(ids).tobytes() == "".join(own).encode()
    offsets = codec.offsets(ids, begin)
    for k, text in enumerate(own[:200]):
        starts = offsets[begin[k] : begin[k + 1]].tolist()
        assert starts == np.cumsum([0, *(len(codec.decode(ids[i : i + 1])) for i in range(begin[k], begin[k + 1]))])[:-1].tolist()


def test_every_code_point_is_cut_as_by_the_library(codec):
    for text in every_letter(5000):
        assert codec.encode([text])[0].tolist() == reference(codec).encode_ordinary(text)


def test_blocks_do_not_change_boundaries():
    text = "".join(texts(400, seed=2))
    whole = boundaries(text, np.array([0]))
    for block in (1, 2, 3, 7, 64):
        assert boundaries(text, np.array([0]), block).tolist() == whole.tolist()


def test_forgetting_slices_changes_nothing(codec, monkeypatch):
    own = texts(50, seed=3)
    before = codec.encode(own)[0].tolist()
    monkeypatch.setattr("wardline.llm.bpe_codec.CACHED_SLICES", 3)
    assert codec.encode(own)[0].tolist() == before == codec.encode(own)[0].tolist()


def test_counts_are_the_library_ones(counter, library):
    for text in [t for _, t, _ in awkward() if t] + texts(2000):
        assert counter.tally(text)[0] == count(library, text)


def test_every_code_point_counts_as_in_the_library(counter, library):
    for text in every_letter(2000):
        assert counter.tally(text)[0] == count(library, text)


def test_every_prefix_counts_as_in_the_library(counter, library):
    for text in texts(800, seed=4):
        if unicodedata.normalize("NFC", text) != text or "İ" in text:
            continue
        expected = [count(library, text[:k]) for k in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == expected
        for limit in (0, 1, 3, 100):
            fits = max(k for k, n in enumerate(expected) if n <= limit)
            assert counter.tally(text, limit) == (expected[-1], fits)


def test_long_texts_in_blocks(counter, library, monkeypatch):
    monkeypatch.setattr("wardline.llm.token_counts.BLOCK", 1000)
    assert counter.tally(LONG, 50)[0] == count(library, LONG)


def test_columns(spark, docs, no_docs):
    codec, counts = BpeUdfs(spark, RANKS), CountUdfs(spark, WORDS)
    rows = docs.select("text", codec.encode("text").alias("e"), counts.tally("text", 5).alias("c"), counts.prefix_counts("text").alias("p"))
    for row in rows.select("*", codec.decode("e.ids").alias("back")).collect():
        assert bytes(row["back"]) == (row["text"] or "").encode()
        assert len(row["e"]["ids"]) == len(row["e"]["offsets"])
        assert row["p"][-1] == row["c"]["n_tokens"]
    assert no_docs.select(codec.encode("text"), counts.tally("text", 5)).collect() == []
    assert spark.sql("select cast(null as array<int>) as ids").select(codec.decode("ids")).first()[0] is None


def test_queries(spark, docs, no_docs, store, library, codec):
    folder = store(documents=docs)
    counted = queries.op3_token_counts(spark, folder).collect()
    assert len(counted) == docs.count()
    sizes = {(i, len((t or "").encode())): count(library, t or "") for i, t, _ in awkward()}
    assert all(sizes[r["doc_id"], r["n_bytes"]] == r["n_tokens"] and r["over_limit"] == (r["n_tokens"] > 2048) for r in counted)
    encoded = queries.op5_byte_bpe(spark, folder).collect()
    digests = {(i, queries._hex(t or "")): reference(codec).encode_ordinary(t or "") for i, t, _ in awkward()}
    for row in encoded:
        ids = digests[row["doc_id"], row["decoded_sha256"]]
        assert (row["n_tokens"], row["ids_sha256"]) == (len(ids), queries._hex(" ".join(map(str, ids))))


def test_queries_over_empty_tables(spark, no_docs, store):
    folder = store(documents=no_docs)
    assert queries.op3_token_counts(spark, folder).collect() == queries.op5_byte_bpe(spark, folder).collect() == []
