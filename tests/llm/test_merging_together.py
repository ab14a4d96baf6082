"""Slices that are merged together against slices that are merged one by one."""

import random

import public_tokenizers
import pytest
import tiktoken

from wardline.llm import bpe_codec
from wardline.llm.bpe_codec import SHORT, Codec, Merges

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def codec():
    with open(RANKS, "rb") as file:
        return Codec(file.read())


def pieces(n):
    draw = random.Random(5)
    parts = [b"a", b"aa", b"the", b"ing", b" ", "ß".encode(), "你".encode(), b"\xff", b"0", b"ab", b"ba"]
    out = {b"".join(draw.choices(parts, k=draw.randint(1, 14)))[: draw.randint(1, SHORT)] for _ in range(n)}
    out |= {draw.randbytes(draw.randint(1, SHORT)) for _ in range(n)} | {b"a" * k for k in range(1, SHORT + 1)}
    return sorted(out)


def test_together_as_one_by_one(codec):
    own = pieces(3000)
    ids, sizes = codec.merges._together(own)
    expected = [codec.merges._ids(piece) if piece not in codec.merges.ranks else (codec.merges.ranks[piece],) for piece in own]
    ends = sizes.cumsum()
    assert [tuple(ids[e - n : e].tolist()) for e, n in zip(ends, sizes, strict=True)] == expected


def test_only_long_slices_are_merged_one_by_one(codec, monkeypatch):
    """One by one, new slices were most of the encoder's time."""
    alone, merge = [], Merges._ids
    monkeypatch.setattr(Merges, "_ids", lambda self, data: alone.append(data) or merge(self, data))
    merges = Merges(codec.merges.ranks)
    own = [*pieces(500), b"xq" * SHORT]
    ids, sizes = merges(own)
    assert alone == [b"xq" * SHORT]
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.merges.ranks, special_tokens={})
    assert ids.tolist() == [x for piece in own for x in reference._encode_single_piece(piece)]
    assert merges(own[::-1])[1].tolist() == sizes.tolist()[::-1] and len(alone) == 1  # now from memory


def test_vocabulary_without_all_bytes_is_merged_one_by_one():
    merges = Merges({b"a": 0, b"b": 1, b"ab": 2, b"abab": 3})
    assert merges([b"abab", b"ababa", b"aab"])[0].tolist() == [3, 3, 0, 0, 2]


def test_a_full_memory_gives_the_same(codec, monkeypatch):
    monkeypatch.setattr(bpe_codec, "CACHED_SLICES", 50)
    own, merges = pieces(300), Merges(codec.merges.ranks)
    expected = Merges(codec.merges.ranks)(own)[0].tolist()
    found = [x for low in range(0, len(own), 20) for x in merges(own[low : low + 20])[0].tolist()]
    assert found == expected
