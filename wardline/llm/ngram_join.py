"""Links between texts whose sets of word n-grams have a Jaccard similarity of at least LEAST, exactly.

Equal sets are one node from the start. All shingles have one order: those that many sets have among their
smallest hashes, counted over all of them, come last, the others by hash. Two sets that link share a shingle among the
first n - ceil(LEAST * n) + 1 of each (n is the set's size), so the sets of an inverted list, one for each such shingle,
hold every pair that links.

A list of two sets is one pair, compared and done. Longer lists are sorted by size and position and cut into blocks. Two blocks are compared only if their sizes, and what their
sets have left behind their positions, can reach LEAST; other pairs of blocks are skipped whole. A pair of blocks is
one task's work, so a list that holds very many sets is dealt to many tasks.

Answers are derived. First every set of a block is compared with one set of the block, the same for many lists, which
links most of a dense group. A set that is highly similar to the one it was compared with takes over that one's
answers: the overlap of x with z is known to be within |y - x| of that of y, so one comparison of x and z rules out
z for all relatives of x, and only where that leaves it open is a relative compared itself. Nothing is compared
within what is connected already. Before sets move, bitmaps of one to four bits a shingle bound how much two of them can share.

Defined results: words are what stands between ASCII white space, only A-Z is lower-cased. A text of fewer words than a shingle
has one shingle, all of it. A null text, or one without words, has the empty set, which links with nothing, not even
its copies. A row's component is the smallest non-null id reachable, null if there is none; rows that share an id are
rows of their own. Shingles are 64-bit hashes. No rows give no rows; other columns are not looked at.
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
from wardline.llm.plain_terms import SPACED, byte_parts
from wardline.session import written

WORDS = 5
LEAST = Fraction(4, 5)
# Sets under one shingle above which it comes late in the order, and for how many shingles that is remembered.
HEAVY = 128
MOST_HEAVY = 1 << 20
# Rows of a list that are compared with each other at once.
BLOCK = 2048
# Rounds that compare with one set of a block; another is called for by many open pairs a row, and these fewer than before.
ROUNDS = 5
MANY = 4
LESS = 0.7
# Similarity from which a set takes over another's answers.
RELATED = Fraction(9, 10)
# 64-bit words of the shortest bitmap, bits up to which one is fine, and buckets of marks (a bounded list of which sets are needed).
LANES = 4
FINE = 2048
BUCKETS = 1 << 20
# Pairs of rows that are tested at once, 64-bit words of their bitmaps, bytes of a text that are hashed at once, and digests a task remembers.
PAIRS = 100_000
WORDS_AT_ONCE = 1 << 18
PART = 1 << 20
SEEN = 50_000

ODD, MIXED = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
VALUES = np.random.PCG64(WORDS).random_raw(256)
POWERS = np.cumprod(np.full(64, 0x5851F42D4C957F2D, np.uint64))


def word_hashes(part: bytes) -> np.ndarray:
    """A hash of each word: its bytes' random values times powers of an odd number, summed and mixed."""
    raw = np.frombuffer(part, np.uint8)
    inside = raw != 32
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, sizes = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.flatnonzero(inside)
    place = at - np.repeat(starts, sizes)
    powers = POWERS if sizes.max() <= len(POWERS) else np.cumprod(np.full(sizes.max(), POWERS[0], np.uint64))
    out = np.add.reduceat(VALUES[raw[at]] * powers[place], np.cumsum(sizes) - sizes)
    out ^= out >> np.uint64(29)
    out *= MIXED
    return out ^ (out >> np.uint64(32))


def rolled(hashes: np.ndarray, words: int) -> np.ndarray:
    """A hash of every run of so many words, from the words' hashes."""
    n = len(hashes) - words + 1
    out = hashes[:n] + np.uint64(words)
    for k in range(1, words):
        out *= ODD
        out += hashes[k : k + n]
    out ^= out >> np.uint64(31)
    out *= MIXED
    return out ^ (out >> np.uint64(32))


def _distinct(found: np.ndarray) -> np.ndarray:
    found.sort()
    return found[np.concatenate([[True], found[1:] != found[:-1]])] if len(found) else found


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a whole text."""
    out, before, total = np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0
    for part in byte_parts(text, SPACED, PART):
        new = word_hashes(part)
        total += len(new)
        found = np.concatenate([before, new]) if len(before) else new
        if len(found) >= words:
            new = _distinct(rolled(found, words))
            out = _distinct(np.concatenate([out, new])) if len(out) else new
        before = found[max(0, len(found) - words + 1) :]
    return rolled(before, total) if 0 < total < words else out


def needed(sizes: int | np.ndarray, least: Fraction) -> int | np.ndarray:
    """Common shingles that sets of so many shingles together must have, rounded up."""
    return -(-least.numerator * sizes // (least.numerator + least.denominator))


def prefix(found: np.ndarray, heavy: np.ndarray, counts: np.ndarray, least: Fraction = LEAST) -> np.ndarray:
    """The first shingles of a set in the common order, of which a set that links shares one."""
    n = len(found)
    if len(heavy) and n:
        at = np.minimum(np.searchsorted(heavy, found), len(heavy) - 1)
        found = found[np.lexsort((found, np.where(heavy[at] == found, counts[at], 0)))]
    return found[: n + (-least.numerator * n // least.denominator) + 1] if n else found


def bitmap(found: np.ndarray) -> np.ndarray:
    """Parities of how many shingles fall on each bit: two bitmaps differ in at most as many bits as the sets.

    Its length is a power of two: four bits a shingle up to FINE bits, then one to two; the exclusive or of its halves is the bitmap of half that length.
    """
    wanted = min(4 * len(found), max(FINE, len(found)))
    size = max(64 * LANES, 1 << max(0, wanted - 1).bit_length())
    bits = np.bincount((found >> np.uint64(17)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(bits.astype(np.uint8), bitorder="little").view("<u8")


def _lanes(bits: np.ndarray, lanes: int) -> np.ndarray:
    """Bitmaps of one length (bytes objects) as rows of so many words, folded to that length."""
    rows = np.frombuffer(b"".join(bits), "<u8").reshape(len(bits), -1, lanes)
    return np.bitwise_xor.reduce(rows, axis=1)


def apart(bits: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """In how many bits the bitmaps of rows p and q differ, at the length of the shorter one."""
    out = np.zeros(len(p), np.int64)
    if not len(p):
        return out
    sizes = np.fromiter(map(len, bits), np.int64, len(bits)) // 8
    for one, two in np.unique(np.stack([sizes[p], sizes[q]]), axis=1).T.tolist():
        at, lanes = np.flatnonzero((sizes[p] == one) & (sizes[q] == two)), min(one, two)
        for low in range(0, len(at), step := max(1, WORDS_AT_ONCE // max(one, two))):
            part = at[low : low + step]
            (a, i), (b, j) = (np.unique(x[part], return_inverse=True) for x in (p, q))
            differ = _lanes(bits[a], lanes)[i] ^ _lanes(bits[b], lanes)[j]
            out[part] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
    return out


def _digest(found: np.ndarray) -> bytes:
    return xxhash.xxh128_digest(found.tobytes())


def _new(texts: pa.Array, seen: set[bytes]) -> Iterator[str | None]:
    """The texts that have not come before in the task, as far as it remembers."""
    for x in texts:
        raw = xxhash.xxh128_digest(x.as_buffer() or b"")
        if raw not in seen:
            if len(seen) >= SEEN:
                seen.clear()
            seen.add(raw)
            yield x.as_py()


def _row_sets(docs: DataFrame, id: str, text: str, words: int, least: Fraction) -> DataFrame:
    """(id, mark, digest, size, bits, keys) of every row: a hash of its text, its set's bitmap, and keys by hash alone.

    bits and keys are null for a row whose set came just before in the same task.
    """
    kind = docs.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()
    none = np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        known: dict[bytes, tuple[bytes, int]] = {}  # digest and size by the digest of a text
        for batch in batches:
            rows = []
            for x in batch.column("text"):
                raw = xxhash.xxh128_digest(x.as_buffer() or b"")
                if raw in known:
                    rows.append((*known[raw], None, None))
                    continue
                found = shingles(x.as_py(), words)
                digest = _digest(found)
                if len(known) >= SEEN:
                    known.clear()
                known[raw] = digest, len(found)
                if digest in seen:
                    rows.append((digest, len(found), None, None))
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(digest)
                rows.append((digest, len(found), bitmap(found).tobytes(), prefix(found, none, none, least).view(np.int64)))
            kinds = (pa.binary(), pa.int32(), pa.binary(), pa.list_(pa.int64()))
            arrays = [pa.array([row[at] for row in rows], kind) for at, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("mark"), *arrays], names=["id", "mark", "digest", "size", "bits", "keys"])

    rows = docs.select(F.col(id).alias("id"), F.xxhash64(text).alias("mark"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, mark bigint, digest binary, size int, bits binary, keys array<bigint>")


def _heavy(keyed: DataFrame, heavy: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles in order, counts) of those that more than heavy sets have as keys; the most frequent if there are very many."""
    counted = keyed.select(F.explode("keys").alias("key")).groupBy("key").count().filter(F.col("count") > heavy)
    found = counted.orderBy(F.desc("count"), "key").limit(MOST_HEAVY).toArrow()
    keys, counts = found["key"].to_numpy().view(np.uint64), found["count"].to_numpy()
    order = np.argsort(keys)
    return keys[order], counts[order]


def _changed(docs: DataFrame, text: str, heavy: tuple[np.ndarray, np.ndarray], words: int, least: Fraction) -> DataFrame:
    """(digest, keys) of the sets whose first shingles by hash hold a heavy one, with keys by the common order."""
    shared, none = docs.sparkSession.sparkContext.broadcast(heavy), np.zeros(0, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, counts = shared.value
        seen: set[bytes] = set()
        for batch in batches:
            digests, keys = [], []
            for text in _new(batch.column("text"), seen):
                found = shingles(text, words)
                first = prefix(found, none, none, least)
                at = np.minimum(np.searchsorted(late, first), len(late) - 1)
                if (late[at] == first).any():
                    digests.append(_digest(found))
                    keys.append(prefix(found, late, counts, least).view(np.int64))
            columns = [pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["digest", "keys"])

    rows = docs.select(F.col(text).alias("text")).mapInArrow(run, "digest binary, keys array<bigint>")
    return rows.groupBy("digest").agg(F.first("keys").alias("keys"))


ROW = {"key": pa.int64(), "node": pa.int64(), "size": pa.int32(), "at": pa.int32()}
MATE = ["node", "size", "at"]
LISTS = "key bigint, node bigint, size int, at int, block int, mate_node bigint, mate_size int, mate_at int"


def _cut(block: int) -> Callable:
    """Rows come sorted by key, size and position; those that share their key go on, with the number of their block.

    Two rows that have a key for themselves go on as one, the second as the mate of the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = None, 0  # the last rows, all of one key, and how many of that key have gone on before
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column("place").to_numpy()
            rows = {"key": batch.column("key").to_numpy(), "node": batch.column("node").to_numpy(), "size": place >> 32, "at": place & 0xFFFFFFFF}
            if held is not None:
                rows = {n: np.concatenate([held[n], x]) for n, x in rows.items()}
            key = rows["key"]
            starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            counts = np.diff(np.append(starts, len(key)))
            place = np.arange(len(key)) - np.repeat(starts, counts)
            place[: counts[0]] += index
            counts[0] += index
            many = np.repeat(counts > 2, np.diff(np.append(starts, len(key))))
            # the last key may go on: its rows wait while they are two at most, else only the last of them
            waiting = 1 if counts[-1] > 2 else int(counts[-1])
            many[-waiting:] = False
            at = np.sort(np.concatenate([np.flatnonzero(many), starts[:-1][counts[:-1] == 2]]))
            yield _batch(rows, at, place[at] // block, ~many[at])
            held, index = {n: x[-waiting:] for n, x in rows.items()}, int(place[-waiting])
        if held is not None and (index or len(held["key"]) == 2):
            yield _batch(held, np.array([0]), np.array([index // block]), np.array([not index]))

    return run


def _batch(rows: dict[str, np.ndarray], at: np.ndarray, block: np.ndarray, mated: np.ndarray) -> pa.RecordBatch:
    """The rows at these places; the mated ones with the row after them."""
    arrays = [pa.array(rows[n][at], kind) for n, kind in ROW.items()]
    mates = [pa.array(rows[n][at + mated], ROW[n], mask=~mated) for n in MATE]
    return pa.RecordBatch.from_arrays([*arrays, pa.array(block, pa.int32()), *mates], names=[*ROW, "block", *[f"mate_{n}" for n in MATE]])


def _twos(lists: DataFrame, least: Fraction) -> DataFrame:
    """(a, b) of the lists of two rows, if they can link; they need no comparison but this one."""
    left = F.least(F.col("size") - F.col("at"), F.col("mate_size") - F.col("mate_at")) * (least.numerator + least.denominator)
    near = lists.filter(F.col("mate_node").isNotNull() & (left >= (F.col("size") + F.col("mate_size")) * least.numerator))
    return near.select(F.least("node", "mate_node").alias("a"), F.greatest("node", "mate_node").alias("b")).distinct()


def _groups(batches: Iterator[pa.RecordBatch], by: list[str], names: list[str]) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Whole groups of rows, which come sorted by group, and where each begins (and the end)."""
    held: list[dict[str, np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
        if held and all(held[0][n][0] == new[n][-1] for n in by):  # one group goes on
            held.append(new)
            continue
        rows = {n: np.concatenate([h[n] for h in [*held, new]]) for n in names}
        fresh = np.ones(len(rows[by[0]]), bool)
        fresh[1:] = np.any([rows[n][1:] != rows[n][:-1] for n in by], axis=0)
        starts = np.flatnonzero(fresh)
        held = [{n: x[starts[-1] :] for n, x in rows.items()}]
        if len(starts) > 1:
            yield {n: x[: starts[-1]] for n, x in rows.items()}, starts
    if held:
        rows = {n: np.concatenate([h[n] for h in held]) for n in names}
        yield rows, np.array([0, len(rows[by[0]])])


def _possible(rows: dict[str, np.ndarray], p: np.ndarray, q: np.ndarray, least: Fraction) -> np.ndarray:
    """Whether rows p and q, not connected, can link if they share no shingle before this one."""
    size, left = rows["size"].astype(np.int64), (rows["size"] - rows["at"]).astype(np.int64)
    return (rows["root"][p] != rows["root"][q]) & (np.minimum(left[p], left[q]) >= needed(size[p] + size[q], least))


def _with_one(least: Fraction) -> Callable:
    """Pairs of each row of a block with the block's first row."""
    names = ["key", "block", "node", "size", "at", "root"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in _groups(batches, ["key", "block"], names):
            p, q = np.repeat(edges[:-1], np.diff(edges)), np.arange(edges[-1])
            near = _possible(rows, p, q, least)
            a, b = rows["node"][p[near]], rows["node"][q[near]]
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in both], names=["a", "b"])

    return run


FOUND = ["a", "b", "more", "sizes", "one", "two"]
DEALT = ["key", "i", "j", "block", "node", "size", "at", "root", "lead", "more", "bits"]


def _to_compare(rows: dict[str, np.ndarray], edges: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows, so many at once: of one block those with a row outside its largest component, else all across."""
    sizes = np.diff(edges)
    twos = edges[:-1][sizes == 2]
    yield twos, twos + 1
    p, q, waiting = [], [], 0
    for low, high in zip(edges[:-1][sizes > 2].tolist(), edges[1:][sizes > 2].tolist(), strict=True):
        if rows["i"][low] == rows["j"][low]:
            roots, at, counts = np.unique(rows["root"][low:high], return_inverse=True, return_counts=True)
            firsts, others = low + np.flatnonzero(at != np.argmax(counts)), np.arange(low, high)
        else:
            own = rows["block"][low:high] == rows["i"][low]
            firsts, others = low + np.flatnonzero(own), low + np.flatnonzero(~own)
        for x in firsts.tolist():
            p.append(np.full(len(others), x))
            q.append(others)
            waiting += len(others)
            if waiting >= PAIRS:
                yield np.concatenate(p), np.concatenate(q)
                p, q, waiting = [], [], 0
    if p:
        yield np.concatenate(p), np.concatenate(q)


def _across(least: Fraction) -> Callable:
    """Pairs of rows of two blocks (or one) that are not connected and whose bitmaps leave them possible.

    a and b are whose answers the rows (one, two) take over, more is how far theirs can be above them, sizes the
    size of both rows. Of the pairs with the same a and b that are met at once, the one that is furthest open goes on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, edges in _groups(batches, ["key", "i", "j"], DEALT):
            for p, q in _to_compare(rows, edges):
                kept = _possible(rows, p, q, least)
                p, q = p[kept], q[kept]
                sizes = rows["size"][p].astype(np.int64) + rows["size"][q]
                kept = (sizes - apart(rows["bits"], p, q)) // 2 >= needed(sizes, least)
                p, q, sizes = p[kept], q[kept], sizes[kept]
                if len(p):
                    one, two = rows["lead"][p], rows["lead"][q]
                    found = [np.minimum(one, two), np.maximum(one, two), rows["more"][p] + rows["more"][q], sizes, rows["node"][p], rows["node"][q]]
                    yield _widest(np.stack(found), least)

    return run


def _widest(found: np.ndarray, least: Fraction) -> pa.RecordBatch:
    """One column for each (a, b): that which needs the least of what a and b share."""
    a, b, more, sizes = found[:4]
    found = found[:, np.lexsort((needed(sizes, least) - more, b, a))]
    first = np.concatenate([[True], (found[:2, 1:] != found[:2, :-1]).any(axis=0)])
    return pa.RecordBatch.from_arrays([pa.array(x) for x in found[:, first].astype(np.int64)], names=FOUND)


class Sets:
    """Where whole sets come from: texts are hashed again, but only those whose mark is in a bounded list of buckets."""

    def __init__(self, docs: DataFrame, text: str, nodes: DataFrame, words: int):
        self.docs, self.text, self.nodes, self.words = docs, text, nodes, words

    def of(self, pairs: DataFrame) -> DataFrame:
        """(node, found) of the nodes in pairs a and b."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        wanted = written(self.nodes.join(ends, "node", "left_semi").select("node", "digest", "mark"), "wanted")
        marks = np.zeros(BUCKETS, bool)
        marks[[row[0] for row in wanted.select(F.pmod("mark", F.lit(BUCKETS))).distinct().collect()]] = True  # at most BUCKETS
        shared, words = self.docs.sparkSession.sparkContext.broadcast(marks), self.words

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[bytes] = set()
            for batch in batches:
                chosen = batch.filter(pa.array(shared.value[batch.column("bucket").to_numpy()]))
                sets = [shingles(text, words) for text in _new(chosen.column("text"), seen)]
                arrays = [pa.array([_digest(x) for x in sets], pa.binary()), pa.array([x.tobytes() for x in sets], pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["digest", "found"])

        texts = self.docs.select(F.pmod(F.xxhash64(self.text), F.lit(BUCKETS)).alias("bucket"), F.col(self.text).alias("text"))
        sets = texts.mapInArrow(run, "digest binary, found binary").groupBy("digest").agg(F.first("found").alias("found"))
        return written(sets.join(wanted.select("node", "digest"), "digest").select("node", "found"), "sets")


def _shared(pairs: DataFrame, source: Sets) -> DataFrame:
    """pairs with both, the exact number of common shingles, and total, the sizes of a and b together.

    Sets are compared once: a filter on the result of a deterministic function would be pushed below it with a second call,
    and that with a second Python worker for each task.
    """

    @F.arrow_udf("struct<both:bigint,total:bigint>")
    def compared(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("both", pa.int64()), ("total", pa.int64())])
        for ones, twos in batches:
            out = []
            for x, y in zip(ones, twos, strict=True):
                one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                out.append({"both": both, "total": len(one) + len(two)})
            yield pa.array(out, kind)

    sets = source.of(pairs)
    one, two = (sets.select(F.col("node").alias(n), F.col("found").alias(f"{n}_set")) for n in "ab")
    joined = pairs.join(one, "a").join(two, "b").withColumn("x", compared.asNondeterministic()("a_set", "b_set"))
    return joined.select(*pairs.columns, "x.both", "x.total")


def _bounded(pairs: DataFrame, maps: DataFrame, least: Fraction) -> DataFrame:
    """The pairs that their bitmaps leave possible."""

    @F.arrow_udf("boolean")
    def possible(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for sizes, ones, twos in batches:
            bits, total = np.array([*ones.to_pylist(), *twos.to_pylist()], object), sizes.to_numpy()
            p = np.arange(len(total))
            yield pa.array((total - apart(bits, p, p + len(total))) // 2 >= needed(total, least))

    one, two = (maps.select(F.col("node").alias(n), F.col("bits").alias(f"{n}_bits"), F.col("size").alias(f"{n}_size")) for n in "ab")
    joined = pairs.join(one, "a").join(two, "b")
    return joined.filter(possible((F.col("a_size") + F.col("b_size")).cast("bigint"), "a_bits", "b_bits")).select("a", "b")


def _is_link(least: Fraction, both: str = "both", total: str = "total") -> Column:
    return F.col(both) * (least.numerator + least.denominator) >= F.col(total) * least.numerator


def _families(lists: DataFrame, near: DataFrame | None, roots: DataFrame | None, least: Fraction) -> DataFrame:
    """lists with root, lead (whose answers the node takes over) and more (shingles that the node has beyond it)."""
    if near is None:
        return lists.select("*", F.col("node").alias("root"), F.col("node").alias("lead"), F.lit(0).cast("bigint").alias("more"))
    related = near.filter(_is_link(RELATED))
    ends = related.select(F.col("a").alias("node"), F.col("b").alias("lead"), "both").union(related.select("b", "a", "both"))
    ends = ends.filter(F.xxhash64("lead") < F.xxhash64("node"))
    lead = ends.groupBy("node").agg(F.min_by(F.struct("lead", "both"), F.xxhash64("lead")).alias("to"))
    facts = roots.join(lead, "node", "left").select("node", "root", "to.lead", "to.both")
    more = F.when(F.col("lead").isNotNull(), F.col("size") - F.col("both")).otherwise(0)
    joined = lists.join(facts, "node", "left")
    return joined.select(*lists.columns, F.coalesce("root", "node").alias("root"), F.coalesce("lead", "node").alias("lead"), more.cast("bigint").alias("more"))


def _block_pairs(rows: DataFrame, least: Fraction, done: int = 2) -> DataFrame:
    """(key, i, j, n): pairs of blocks of a list with rows to compare, and how many pairs of rows at most.

    A block of two rows has been compared in the first round, so blocks of up to done rows are passed over. Rows move
    once, by block; both groupings keep that partitioning.
    """
    moved = rows.select("key", "block", "root", "size", (F.col("size") - F.col("at")).alias("left")).repartition("key", "block")
    per_root = moved.groupBy("key", "block", "root").agg(
        F.count("*").alias("rows"), F.min("size").alias("low"), F.max("size").alias("high"), F.max("left").alias("left")
    )
    blocks = per_root.groupBy("key", "block").agg(
        F.sum("rows").alias("rows"),
        F.max("rows").alias("most"),
        F.min("root").alias("first"),
        F.max("root").alias("last"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.max("left").alias("left"),
    )
    blocks = written(blocks, "blocks")
    inside = blocks.filter(f"first < last and rows > {done}")
    inside = inside.select("key", F.col("block").alias("i"), F.col("block").alias("j"), (F.col("rows") * (F.col("rows") - F.col("most"))).alias("n"))
    long = blocks.join(blocks.filter("block > 0").select("key").distinct(), "key", "left_semi")
    i, j = long.alias("i"), long.alias("j")
    wanted = (F.col("i.low") + F.col("j.low")) * least.numerator
    joined = i.join(
        j,
        (F.col("i.key") == F.col("j.key"))
        & (F.col("i.block") < F.col("j.block"))
        & (F.col("j.low") * least.numerator <= F.col("i.high") * least.denominator)
        & (F.least("i.left", "j.left") * (least.numerator + least.denominator) >= wanted)
        & ~((F.col("i.first") == F.col("i.last")) & (F.col("j.first") == F.col("j.last")) & (F.col("i.first") == F.col("j.first"))),
    )
    apart = joined.select("i.key", F.col("i.block").alias("i"), F.col("j.block").alias("j"), (F.col("i.rows") * F.col("j.rows")).alias("n"))
    return inside.union(apart)


def _dealt(rows: DataFrame, pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """Rows with their bitmaps, once for each pair of blocks that theirs is in, sorted by pairs."""
    one = pairs.select("key", F.col("i").alias("block"), "i", "j")
    two = pairs.filter("i < j").select("key", F.col("j").alias("block"), "i", "j")
    sent = rows.join(one.union(two), ["key", "block"]).join(maps.select("node", "bits"), "node")
    return sent.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "size", "at")


def links(nodes: DataFrame, keyed: DataFrame, source: Sets, least: Fraction = LEAST, block: int = BLOCK) -> DataFrame | None:
    """(a, b): links of nodes that connect exactly what all links would; None if no two sets share a list.

    nodes has node, size and bits, one of each set; keyed has node, size and keys.
    """
    rows = keyed.select("node", "size", F.posexplode("keys").alias("at", "key"))
    # size and position in one number, which sorts as both
    rows = rows.select("key", "node", (F.col("size").cast("bigint") * (1 << 32) + F.col("at")).alias("place"))
    dealt = rows.repartition("key").sortWithinPartitions("key", "place")
    lists = written(dealt.mapInArrow(_cut(block), LISTS), "lists")
    if lists.isEmpty():
        return None
    twos = written(_twos(lists, least), "twos")
    lists = lists.filter("mate_node is null").select(*ROW, "block")  # from here on, lists of three rows and more
    total = lists.count()
    ends = lists.select("node").union(twos.select("a")).union(twos.select("b")).distinct()
    maps = written(nodes.join(ends, "node", "left_semi").select("node", "size", "bits"), "bitmaps")
    near = roots = before = None
    for turn in range(ROUNDS + 1):
        rows = _families(lists, near, roots, least)
        if turn:
            rows = written(rows, "families")
            open_blocks = written(_block_pairs(rows, least), "open_blocks")
            left = open_blocks.agg(F.sum("n")).first()[0] or 0
            if not left:
                return near
            if turn == ROUNDS or left <= MANY * total or (before and left > before * LESS):
                break
            before = left
        # One set leads many lists at first; later each list has its own, so that a set is compared with many.
        order = F.xxhash64("node", "key", F.lit(turn)) if turn else F.xxhash64("node")
        sorted_rows = rows.repartition("key", "block").sortWithinPartitions("key", "block", order)
        pairs = sorted_rows.mapInArrow(_with_one(least), "a bigint, b bigint")
        pairs = (pairs if turn else pairs.union(twos)).distinct()
        found = _shared(written(_bounded(pairs, maps, least), "pairs"), source).filter(_is_link(least))
        found = written(found, "near")
        near = found if near is None else near.union(found)
        roots = written(components(near, "a", "b"), "roots")
    opened = _dealt(rows, open_blocks, maps).mapInArrow(_across(least), ", ".join(f"{n} bigint" for n in FOUND))
    # over all lists, the pair of relatives that needs the least of their leads' common shingles
    short = F.ceil(F.col("sizes") * least.numerator / (least.numerator + least.denominator)) - F.col("more")
    opened = written(opened.groupBy("a", "b").agg(F.min(short).alias("short")), "open")
    answers = written(_shared(opened, source), "answers")
    found = answers.filter(_is_link(least))
    near = near.unionByName(found.select(*near.columns))
    unsure = answers.filter(~_is_link(least) & ((F.col("both") >= F.col("short")))).select("a", "b")
    unsure = written(unsure, "unsure")
    if unsure.isEmpty():
        return near
    # relatives of those are compared themselves; blocks of whom only two are left may have had more before
    ends = unsure.select(F.explode(F.array("a", "b")).alias("lead")).distinct()
    some = rows.join(ends, "lead", "left_semi").select(*rows.columns)
    again = _dealt(some.withColumn("lead", F.col("node")).withColumn("more", F.lit(0).cast("bigint")), _block_pairs(some, least, 1), maps)
    members = again.mapInArrow(_across(least), ", ".join(f"{n} bigint" for n in FOUND)).select("a", "b").distinct()
    leads = rows.select("node", "lead").distinct()
    one, two = (leads.select(F.col("node").alias(n), F.col("lead").alias(f"{n}_lead")) for n in "ab")
    of = members.join(one, "a").join(two, "b")
    of = of.select("a", "b", F.least("a_lead", "b_lead").alias("x"), F.greatest("a_lead", "b_lead").alias("u"))
    wanted = of.join(unsure.select(F.col("a").alias("x"), F.col("b").alias("u")), ["x", "u"], "left_semi").select("a", "b")
    return near.unionByName(written(_shared(written(wanted, "members"), source).filter(_is_link(least)), "near"))


def linked(docs: DataFrame, id: str, text: str, words: int = WORDS, least: Fraction = LEAST, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """(id, row, node, size, root): every row of docs with the number of its set and of its component's."""
    rows = _row_sets(docs, id, text, words, least).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "row_sets")
    # A set's node is its first row; one that came before in its task is not the first.
    nodes = written(rows.filter("size > 0 and keys is not null").groupBy("digest").agg(F.min("row").alias("node")), "nodes")
    keyed = rows.withColumnRenamed("row", "node").join(nodes.select("node"), "node", "left_semi")
    late = _heavy(rows, heavy)
    known = keyed.select("node", "size", "keys")
    if len(late[0]):
        changed = _changed(docs, text, late, words, least).join(nodes, "digest").select("node", F.col("keys").alias("again"))
        known = known.join(written(changed, "changed"), "node", "left").select("node", "size", F.coalesce("again", "keys").alias("keys"))
    near = links(keyed, known, Sets(docs, text, keyed, words), least, block)
    narrow = rows.select("id", "row", "digest", "size").join(nodes, "digest", "left")
    narrow = narrow.withColumn("node", F.when(F.col("size") > 0, F.col("node")).otherwise(F.col("row")))
    if near is None:
        return narrow.select("id", "row", "node", "size", F.col("node").alias("root"))
    roots = written(components(near, "a", "b"), "roots")
    return narrow.join(roots, "node", "left").select("id", "row", "node", "size", F.coalesce("root", "node").alias("root"))


def near_duplicates(docs: DataFrame, id: str, text: str, words: int = WORDS, least: Fraction = LEAST, heavy: int = HEAVY, block: int = BLOCK) -> DataFrame:
    """(id, size, component): every row of docs, its number of shingles and its component's smallest id."""
    rows = written(linked(docs, id, text, words, least, heavy, block), "linked")
    smallest = rows.groupBy("root").agg(F.min("id").alias("component"))
    return rows.join(smallest, "root").select("id", F.col("size").cast("bigint").alias("size"), "component")
