"""SimHash fingerprints and the components of near ones.

A bit of a fingerprint is 1 if it is set in over half the hashes of the text's word shingles. Two fingerprints
link if they differ in at most max_bits bits. Cut into blocks, a pair that differs in d bits agrees in all but
d of them, so every link has a set of agreeing blocks as its key: fingerprints are dealt by each such key, and
links are looked for inside a key only, with the distance verified. Inside a key a breadth-first walk takes out
each fingerprint it reaches, so a dense group costs a walk and gives a tree, never all its pairs.

A key that holds very many fingerprints is dealt again by the blocks of its remaining bits, by the same
argument; what is left in one key is then bounded by the bits that are still free. Equal fingerprints are one
node from the start: copies never meet in a key.

Defined results: a null text has no words, and no words give fingerprint zero, which links like any other;
rows are kept as they are, repeated ones too. The component of a row is the smallest non-null id among the
rows reachable from it, null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.components import components
from wardline.session import written

WORDS = 4
MAX_BITS = 4
SEED = 42
# Fingerprints in one key above which the key is dealt again by more blocks.
LARGE_KEY = 4096
# Words hashed at once, to bound memory on long texts.
STEP = 100_000


def fingerprint(text: str, words: int = WORDS) -> int:
    """Fingerprint of a whole text."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    total, ones = max(1, len(found) - words + 1), np.zeros(64, dtype=np.int64)
    for low in range(0, total, STEP):
        part = found[low : min(low + STEP, total) + words - 1]
        joined = b" ".join(part)
        sizes = np.fromiter(map(len, part), dtype=np.int64, count=len(part)) + 1
        ends = np.cumsum(sizes)
        starts = (ends - sizes)[: max(1, len(part) - words + 1)].tolist()
        stops = (ends - 1)[min(words, len(part)) - 1 :].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[i:j], SEED) for i, j in zip(starts, stops, strict=True)]
        bits = np.unpackbits(np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits((ones * 2 > total).astype(np.uint8), bitorder="little").view("<u8")
    return int(value[0])


def fingerprint_column(text: str, words: int = WORDS) -> Column:
    """The fingerprint as a bigint (the same 64 bits, signed)."""

    @F.arrow_udf("bigint")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            values = np.array([fingerprint(x.as_py() or "", words) for x in batch], dtype=np.uint64)
            yield pa.array(values.view(np.int64))

    return column(F.col(text))


def _cut(bits: list[int], parts: int) -> list[int]:
    """Masks of a list of bit positions cut into nearly equal blocks."""
    edges = [round(k * len(bits) / parts) for k in range(parts + 1)]
    return [sum(1 << b for b in bits[i:j]) for i, j in zip(edges, edges[1:], strict=False)]


def _masks(bits: list[int], max_bits: int, agree: int) -> list[int]:
    """Masks so that values at most max_bits apart on these bits agree under at least one."""
    blocks = _cut(bits, min(max_bits + agree, len(bits)))
    return [sum(chosen) for chosen in combinations(blocks, max(0, len(blocks) - max_bits))]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _keyed(prints: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """One row for each mask of a row's table: the mask and the bits under it."""
    tables = F.create_map(*[x for t, own in masks.items() for x in (F.lit(t), F.array(*[F.lit(_signed(m)) for m in own]))])
    rows = prints.select("print", "mask", F.explode(tables[F.col("mask")]).alias("more"))
    return rows.select("print", F.col("mask").bitwiseOR(F.col("more")).alias("mask")).withColumn(
        "bits", F.col("print").bitwiseAND(F.col("mask"))
    )


def tree(values: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect what is connected among distinct unsigned values, one for each value that is reached."""
    out, left = [], values
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(left ^ at) <= max_bits
            if near.any():
                found = left[near]
                out += [(at, x) for x in found]
                queue += list(found)
                left = left[~near]
    return out


def _linked(max_bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by key; a key that goes on in the next batch is held back."""
        held = (np.zeros(0, np.int64),) * 3
        for batch in batches:
            new = [batch.column(n).to_numpy(zero_copy_only=False) for n in ("mask", "bits", "print")]
            mask, bits, value = (np.concatenate([h, x]) for h, x in zip(held, new, strict=True))
            starts = _starts(mask, bits)
            last = starts[-1] if len(starts) else 0
            held = (mask[last:], bits[last:], value[last:])
            yield _links(starts[:-1] if len(starts) else starts, last, value, max_bits)
        yield _links(np.zeros(min(1, len(held[0])), np.int64), len(held[0]), held[2], max_bits)

    return run


def _starts(mask: np.ndarray, bits: np.ndarray) -> np.ndarray:
    if not len(mask):
        return np.zeros(0, np.int64)
    return np.concatenate([[0], np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1])


def _links(starts: np.ndarray, end: int, value: np.ndarray, max_bits: int) -> pa.RecordBatch:
    value = value.view(np.uint64)  # bits of signed numbers would be counted of their absolute values
    sizes = np.diff(np.concatenate([starts, [end]])) if len(starts) else np.zeros(0, np.int64)
    pairs = starts[sizes == 2]  # by far the most
    a, b = value[pairs], value[pairs + 1] if len(pairs) else value[pairs]
    near = np.bitwise_count(a ^ b) <= max_bits
    more = [link for i in np.flatnonzero(sizes > 2) for link in tree(np.unique(value[starts[i] : starts[i] + sizes[i]]), max_bits)]
    left = np.concatenate([a[near], np.array([x for x, _ in more], np.uint64)]).view(np.int64)
    right = np.concatenate([b[near], np.array([y for _, y in more], np.uint64)]).view(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], names=["a", "b"])


def links(prints: DataFrame, max_bits: int = MAX_BITS, agree: int = 2) -> DataFrame:
    """(a, b): links that connect distinct fingerprints (column print) exactly as all links would.

    agree is how many blocks a pair has in common at least: more blocks mean more keys and fewer
    fingerprints in each. It changes the work, not the result.
    """
    whole = list(range(64))
    first = _masks(whole, max_bits, agree)
    prints = prints.select("print", F.lit(0).cast("bigint").alias("mask"))
    keyed = written(_keyed(prints, {0: first}), "keys")
    large = written(keyed.groupBy("mask", "bits").count().filter(F.col("count") > LARGE_KEY).drop("count"), "large")
    if not large.isEmpty():
        second = {_signed(m): _masks([b for b in whole if not m >> b & 1], max_bits, agree + 2) for m in first}
        again = _keyed(keyed.join(large, ["mask", "bits"], "left_semi"), second)
        keyed = keyed.join(large, ["mask", "bits"], "left_anti").select("print", "mask", "bits").unionByName(again)
    dealt = keyed.repartition("mask", "bits").sortWithinPartitions("mask", "bits")
    return dealt.mapInArrow(_linked(max_bits), "a bigint, b bigint").distinct()


def roots(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """(print, root): each distinct fingerprint with the one that stands for its component."""
    distinct = written(prints.select("print").distinct(), "classes")
    found = components(links(distinct, max_bits), "a", "b")
    return distinct.join(found, F.col("print") == F.col("node"), "left").select("print", F.coalesce("root", "print").alias("root"))


def near_duplicates(docs: DataFrame, id: str, text: str, words: int = WORDS, max_bits: int = MAX_BITS) -> DataFrame:
    """(id, print, component): every row of docs with its fingerprint and its component's smallest id."""
    rows = written(docs.select(F.col(id).alias("id"), fingerprint_column(text, words).alias("print")), "prints")
    rooted = roots(rows, max_bits).join(rows.groupBy("print").agg(F.min("id").alias("least")), "print")
    least = rooted.groupBy("root").agg(F.min("least").alias("component"))
    labels = rooted.join(least, "root").select("print", "component")
    return rows.join(labels, "print").select("id", "print", "component")


def hex_digits(print_column: str) -> Column:
    """A fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(F.col(print_column)), 16, "0"))
