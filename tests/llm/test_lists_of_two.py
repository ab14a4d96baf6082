"""Lists of two sets are compared once and not carried through the rounds; longer ones are cut into blocks."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.test_ngram_join import components, found
from tests.llm.test_shingle_join import WORDS, edited
from wardline.llm import ngram_join


def plain_cut(told, block):
    """(key, node, size, at, block, mate's node, size, at) of the rows that share their key."""
    lists, out = defaultdict(list), []
    for key, node, place in told:
        lists[key].append((node, place >> 32, place & 0xFFFFFFFF))
    for key, rows in lists.items():
        if len(rows) == 2:
            out.append((key, *rows[0], 0, *rows[1]))
        elif len(rows) > 2:
            out += [(key, *row, k // block, None, None, None) for k, row in enumerate(rows)]
    return out


@pytest.mark.parametrize("step", [1, 2, 3, 4, 7, 1000])
def test_lists_are_cut_alike_in_batches_of_any_size(step):
    draw = random.Random(step)
    for sizes in ([2], [1], [3], [2, 2], [1, 2, 1], [3, 2], [2, 9, 1, 2], [draw.randint(1, 6) for _ in range(60)]):
        told = [(key, draw.randint(0, 99), (k << 32) + draw.randint(0, 9)) for key, n in enumerate(sizes) for k in range(n)]
        columns = [np.array(x, np.int64) for x in zip(*told, strict=True)]
        batches = [pa.RecordBatch.from_arrays([pa.array(x[k : k + step]) for x in columns], names=["key", "node", "place"]) for k in range(0, len(told), step)]
        batches.insert(len(batches) // 2, batches[0].slice(0, 0))
        got = pa.Table.from_batches(ngram_join._cut(4)(iter(batches)))
        assert sorted(map(repr, zip(*got.to_pydict().values(), strict=True))) == sorted(map(repr, plain_cut(told, 4)))


def test_pairs_alone_need_no_round(spark, monkeypatch):
    draw, carried = random.Random(5), []
    told = [x for _ in range(40) for one in [draw.choices(WORDS, k=80)] for x in (one, edited(draw, one, draw.choice([1, 20])))]
    told = [" ".join(x) for x in told]
    families = ngram_join._families

    def counted(lists, near, roots, least):
        carried.append(lists.count())
        return families(lists, near, roots, least)

    monkeypatch.setattr(ngram_join, "_families", counted)
    assert found(spark, told) == components(told)
    assert len(set(components(told).values())) < len(told) and not any(carried)
