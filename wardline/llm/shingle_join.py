"""Components of texts whose sets of word shingles are alike, exactly: Jaccard similarity of at least LEAST.

Equal sets are one node from the start. Under any fixed order of all shingles, two sets of that likeness share a
shingle among the first n // 5 + 1 of each (n is the set's size, for 0.8), so every near pair meets under such a
key. Shingles that are common in a sample come last in the order, which keeps keys small; a poor sample costs
time, never a pair. A pair found under a key is compared by its whole sets before it links.

Dense groups are joined first: under each key every node is compared with one of the key's nodes, for a few
rounds while that leaves many pairs. Then all pairs that share a key, lie in different components, and could be
alike by sizes and places are compared, so the components are those that all pairs would give.

Defined results: texts are split and lowered as bytes, as for fingerprints; fewer words than a shingle has are
one shingle, a text without words has the empty set, which is alike to itself only. Shingles are 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.components import components
from wardline.llm.simhash import SEED, STEP
from wardline.session import written

WORDS = 5
LEAST = Fraction(4, 5)
# Expected texts in the sample that tells common shingles, in how many of them one is common, and how many are kept.
SAMPLE = 10_000
COMMON = 10
MOST_COMMON = 200_000
# Rounds that compare with one node of a key, and the pairs per row that call for another.
ROUNDS = 3
MANY = 4
# Pairs handed on at once.
PAIRS = 100_000


def shingles(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of words of a whole text."""
    found = text.encode("utf-8", "surrogatepass").lower().split()
    out = np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    total = max(1, len(found) - words + 1) if found else 0
    for low in range(0, total, STEP):
        part = found[low : min(low + STEP, total) + words - 1]
        hashes = [digest(b" ".join(part[k : k + words]), SEED) for k in range(max(1, len(part) - words + 1))]
        out = np.union1d(out, np.array(hashes, np.uint64))
    return out


def prefix(found: np.ndarray, common: np.ndarray, counts: np.ndarray, least: Fraction = LEAST) -> np.ndarray:
    """The set's first shingles (rare ones before common, then by hash) that a near set must share one of."""
    n = len(found)
    if not n:
        return found
    size = n + (-least.numerator * n // least.denominator) + 1
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        found = found[np.lexsort((found, np.where(common[at] == found, counts[at], 0)))]
    return found[:size]


def _common(docs: DataFrame, text: str, words: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in order, counts) of the shingles that many texts of a sample hold."""

    @F.arrow_udf("array<bigint>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shingles(x.as_py() or "", words).view(np.int64) for x in batch], pa.list_(pa.int64()))

    draw = F.pmod(F.xxhash64(text, F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    texts = docs.select(text).filter(draw < min(1.0, SAMPLE / max(1, docs.count())))
    counted = texts.select(F.explode(column(F.col(text))).alias("key")).groupBy("key").count().filter(F.col("count") >= COMMON)
    found = counted.orderBy(F.desc("count"), "key").limit(MOST_COMMON).toArrow()
    keys, counts = found["key"].to_numpy().view(np.uint64), found["count"].to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def set_column(docs: DataFrame, text: str, words: int = WORDS, least: Fraction = LEAST) -> Column:
    """Struct of a text's set: digest (equal for equal sets), size, and keys to meet near sets under."""
    shared = docs.sparkSession.sparkContext.broadcast(_common(docs, text, words))
    kind = pa.struct([("digest", pa.binary()), ("size", pa.int64()), ("keys", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<digest:binary,size:bigint,keys:array<bigint>>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        common, counts = shared.value
        for batch in batches:
            out = []
            for x in batch:
                found = shingles(x.as_py() or "", words)
                keys = prefix(found, common, counts, least).view(np.int64)
                out.append({"digest": xxhash.xxh128_digest(found.tobytes()), "size": len(found), "keys": keys})
            yield pa.array(out, kind)

    return column(F.col(text))


def _by_key(names: list[str], out: Callable[[dict[str, np.ndarray], np.ndarray], Iterator[pa.RecordBatch]]):
    """Rows come sorted by key; out gets whole keys and where each begins (and the end)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict[str, np.ndarray]] = []
        for batch in batches:
            new = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            if not batch.num_rows:
                continue
            if held and held[0]["key"][0] == new["key"][-1]:  # one key goes on
                held.append(new)
                continue
            rows = {n: np.concatenate([h[n] for h in [*held, new]]) for n in names}
            starts = np.flatnonzero(np.concatenate([[True], rows["key"][1:] != rows["key"][:-1]]))
            held = [{n: x[starts[-1] :] for n, x in rows.items()}]
            if len(starts) > 1:
                yield from out({n: x[: starts[-1]] for n, x in rows.items()}, starts)
        if held:
            rows = {n: np.concatenate([h[n] for h in held]) for n in names}
            yield from out(rows, np.array([0, len(rows["key"])]))

    return run


ROW = ["key", "node", "size", "at"]


def _repeated(rows: dict[str, np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    kept = np.repeat(np.diff(edges) > 1, np.diff(edges))
    yield pa.RecordBatch.from_arrays([pa.array(rows[n][kept]) for n in ROW], names=ROW)


def _possible(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, least: Fraction) -> np.ndarray:
    """Whether rows i and j of one key can be near if this is the first shingle in order that they share."""
    one, two = rows["size"][i], rows["size"][j]
    most = 1 + np.minimum(one - rows["at"][i], two - rows["at"][j]) - 1
    return most * (least.numerator + least.denominator) >= least.numerator * (one + two)


def _pairs(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, least: Fraction) -> pa.RecordBatch:
    kept = (rows["root"][i] != rows["root"][j]) & _possible(rows, i, j, least)
    a, b = rows["node"][i[kept]], rows["node"][j[kept]]
    both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])


def _one(least: Fraction):
    """Pairs of each row with its key's first row."""

    def out(rows: dict[str, np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        firsts = np.repeat(edges[:-1], np.diff(edges))
        yield _pairs(rows, firsts, np.arange(len(firsts)), least)

    return out


def _all(least: Fraction):
    """All pairs of a key in different components: rows outside its largest component with every row."""

    def out(rows: dict[str, np.ndarray], edges: np.ndarray) -> Iterator[pa.RecordBatch]:
        i, j, waiting = [], [], 0
        for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            own = rows["root"][low:high]
            names, counts = np.unique(own, return_counts=True)
            if len(names) < 2:
                continue
            others = np.arange(low, high)
            for at in low + np.flatnonzero(own != names[np.argmax(counts)]):
                i.append(np.full(len(others), at))
                j.append(others)
                waiting += len(others)
                if waiting >= PAIRS:
                    yield _pairs(rows, np.concatenate(i), np.concatenate(j), least)
                    i, j, waiting = [], [], 0
        if i:
            yield _pairs(rows, np.concatenate(i), np.concatenate(j), least)

    return out


def _verified(pairs: DataFrame, texts: DataFrame, words: int, least: Fraction) -> DataFrame:
    """The pairs whose whole sets are alike. texts has node and text."""

    @F.arrow_udf("binary")
    def packed(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([shingles(x.as_py() or "", words).tobytes() for x in batch], pa.binary())

    @F.arrow_udf("boolean")
    def alike(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for ones, twos in batches:
            out = []
            for x, y in zip(ones, twos, strict=True):
                one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                out.append(both * least.denominator >= least.numerator * (len(one) + len(two) - both))
            yield pa.array(out, pa.bool_())

    needed = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = written(texts.join(needed, "node", "left_semi").select("node", packed("text").alias("found")), "sets")
    one, two = (sets.select(F.col("node").alias(n), F.col("found").alias(f"{n}_set")) for n in "ab")
    joined = pairs.join(one, "a").join(two, "b")
    return written(joined.filter(alike("a_set", "b_set")).select("a", "b"), "near")


def roots(texts: DataFrame, words: int = WORDS, least: Fraction = LEAST) -> DataFrame:
    """(node, root): each node that is near another with the smallest node of its component.

    texts has node (a bigint, one for each distinct set), text, size and keys.
    """
    keyed = texts.select("node", "size", F.posexplode("keys").alias("at", "key"))
    keyed = keyed.select("key", "node", "size", F.col("at").cast("bigint").alias("at"))
    schema = "key bigint, node bigint, size bigint, at bigint"
    dealt = keyed.repartition("key").sortWithinPartitions("key")
    shared = written(dealt.mapInArrow(_by_key(ROW, _repeated), schema), "shared")
    plain, near, found, total = texts.select("node", "text"), None, None, shared.count()
    for turn in range(ROUNDS + 1):
        rooted = shared.withColumn("root", F.col("node"))
        if found is not None:
            rooted = shared.join(found, "node", "left").select(*ROW, F.coalesce("root", "node").alias("root"))
        counts = rooted.groupBy("key", "root").count().groupBy("key")
        left = counts.agg(((F.sum("count") * F.sum("count") - F.sum(F.col("count") * F.col("count"))) / 2).alias("n"))
        left = left.agg(F.sum("n")).first()[0] or 0
        if not left:
            break
        last = turn == ROUNDS or left <= MANY * total
        salted = F.xxhash64("node", F.lit(turn))
        sorted_rows = rooted.repartition("key").sortWithinPartitions("key", salted)
        names, make = [*ROW, "root"], (_all if last else _one)(least)
        pairs = written(sorted_rows.mapInArrow(_by_key(names, make), "a bigint, b bigint").distinct(), "pairs")
        more = _verified(pairs, plain, words, least)
        near = more if near is None else near.union(more)
        found = written(components(near, "a", "b"), "found")
        if last:
            break
    return found if found is not None else texts.select("node", F.col("node").alias("root")).limit(0)
