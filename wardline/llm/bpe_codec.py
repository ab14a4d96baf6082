"""Byte-level BPE: encode whole texts to token ids and decode ids to bytes.

Where a token may not cross is found without a regular expression. Every code point gets a class (letter,
number, white space, other) from one array; together with its right neighbours that makes a symbol, and a
symbol is a function from scanner state to scanner state. Functions compose associatively, so a text is cut
into rows of equal length, all rows are composed at once, the row results are chained, and a second pass
turns states into boundaries. The slices between boundaries go through cached pair merging.

Defined results: a null text is encoded as the empty one, which has no tokens; repeated rows give repeated
results; other columns are never read and stay as they are, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Code points scanned at once. Longer texts go through in pieces that carry the scanner's state.
BLOCK = 1 << 18
# Slices of several tokens whose ids a worker keeps; beyond that it forgets those not used lately.
CACHED_SLICES = 200_000
# Bytes up to which a slice is merged by looking at all its pairs again (64 at most); longer ones need a heap.
SHORT = 40
NO_RANK = 1 << 40

LETTER, NUMBER, SPACE, OTHER = range(4)

# Scanner states: what the last code point left open.
S_CLOSED, S_LETTERS, S_NUMBERS, S_OTHERS, S_GAP, S_LEAD, S_ONE_MORE, S_TWO_MORE = range(8)
STATES = 8

# Symbols: a code point as seen with its right neighbours. SPACE_IN is followed by more white space or the
# end, SPACE_LAST is the last before something else, BLANK_LAST likewise and an ordinary blank; TICK_2 and
# TICK_3 start an English contraction of two or three code points. IDLE changes nothing (padding).
Y_LETTER, Y_NUMBER, Y_OTHER, Y_SPACE_IN, Y_SPACE_LAST, Y_BLANK_LAST, Y_TICK_2, Y_TICK_3, Y_IDLE = range(9)
SYMBOLS = 9


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every code point, by general category; white space as Unicode's White_Space property."""
    of = {"L": LETTER, "N": NUMBER}
    table = np.array([of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)], dtype=np.uint8)
    blanks = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
    table[blanks] = SPACE
    return table


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """(next state, boundary before this code point), both by symbol and state. The upper half of the
    symbols, from SYMBOLS on, does the same for the first code point of a text."""
    step = np.zeros((SYMBOLS, STATES), dtype=np.uint8)
    cut = np.zeros((SYMBOLS, STATES), dtype=bool)
    for state in range(STATES):
        for symbol, run in ((Y_LETTER, S_LETTERS), (Y_NUMBER, S_NUMBERS), (Y_OTHER, S_OTHERS)):
            step[symbol, state], cut[symbol, state] = run, state not in (run, S_LEAD)
        step[Y_SPACE_IN, state], cut[Y_SPACE_IN, state] = S_GAP, state != S_GAP
        step[Y_SPACE_LAST, state], cut[Y_SPACE_LAST, state] = S_CLOSED, True
        step[Y_BLANK_LAST, state], cut[Y_BLANK_LAST, state] = S_LEAD, True
        for symbol, left in ((Y_TICK_2, S_ONE_MORE), (Y_TICK_3, S_TWO_MORE)):
            inside = state in (S_OTHERS, S_LEAD)
            step[symbol, state], cut[symbol, state] = (S_OTHERS, False) if inside else (left, True)
        step[Y_IDLE, state] = state
    # A contraction takes its code points whatever they are.
    step[:Y_IDLE, S_ONE_MORE], cut[:Y_IDLE, S_ONE_MORE] = S_CLOSED, False
    step[:Y_IDLE, S_TWO_MORE], cut[:Y_IDLE, S_TWO_MORE] = S_ONE_MORE, False
    first_step = np.repeat(step[:, S_CLOSED : S_CLOSED + 1], STATES, axis=1)
    first_cut = np.ones_like(cut)
    return np.concatenate([step, first_step]).ravel(), np.concatenate([cut, first_cut]).ravel()


STEP, CUT = _automaton()
STEP = STEP.astype(np.intp)

# States that lead to the same next state by every symbol are of one kind; a row is composed for one of each.
STARTS = np.array([S_CLOSED, S_OTHERS, S_ONE_MORE, S_TWO_MORE], dtype=np.intp)
KIND = [0, 0, 0, 1, 0, 1, 2, 3]


def symbols(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
    """Symbol of each code point. starts: where texts begin; nothing is looked up across a text's end."""
    n = len(codes)
    kind = classes()[codes]
    last = np.zeros(n + 3, dtype=bool)  # the next code point belongs to another text, or there is none
    last[n - 1 :] = True
    last[starts[starts > 0] - 1] = True
    ahead = np.concatenate([codes, np.zeros(3, dtype=codes.dtype)])
    out = np.array([Y_LETTER, Y_NUMBER, Y_SPACE_IN, Y_OTHER], dtype=np.uint8)[kind]
    follow = np.concatenate([kind, np.full(1, SPACE, dtype=np.uint8)])[1:]
    final = (kind == SPACE) & (follow != SPACE) & ~last[:n]
    out[final] = Y_SPACE_LAST
    out[final & (codes == 0x20)] = Y_BLANK_LAST
    ticks = np.flatnonzero((codes == 0x27) & ~last[:n])
    if len(ticks):
        one, two = ahead[ticks + 1], ahead[ticks + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = np.zeros(len(ticks), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long |= (one == ord(a)) & (two == ord(b))
        out[ticks[short]] = Y_TICK_2
        out[ticks[long & ~last[ticks + 1] & ~short]] = Y_TICK_3
    out[starts] += SYMBOLS
    return out


def scan(marks: np.ndarray, state: int = S_CLOSED, width: int = 256) -> tuple[np.ndarray, int]:
    """(boundary before each symbol, state after the last), by composing the symbols' functions."""
    n = len(marks)
    if n == 0:
        return np.zeros(0, dtype=bool), state
    width = max(1, min(width, int(n**0.5) + 1))
    rows = -(-n // width)
    grid = np.full(rows * width, Y_IDLE, dtype=np.uint8)
    grid[:n] = marks
    columns = np.ascontiguousarray(grid.reshape(rows, width).T).astype(np.intp) * STATES
    composed = np.tile(STARTS, (rows, 1)).T.copy()  # one line for each kind of state a row may start in
    index = np.empty_like(composed)
    for column in columns:
        np.add(composed, column, out=index)
        np.take(STEP, index, out=composed, mode="clip")
    at = np.empty(rows, dtype=np.intp)
    for row, ends in enumerate(composed.T.tolist()):
        at[row] = state
        state = ends[KIND[state]]
    seen, index = np.empty((width, rows), dtype=np.intp), np.empty(rows, dtype=np.intp)
    for k, column in enumerate(columns):
        np.add(column, at, out=seen[k])
        np.take(STEP, seen[k], out=at, mode="clip")
    return CUT[seen.T.ravel()[:n]], state


def boundaries(text: str, starts: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Positions where a slice starts, for texts joined to one string that begin at starts."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    state, found = S_CLOSED, []
    for low in range(0, len(codes), block):
        high = min(low + block, len(codes))
        here = starts[(starts >= low) & (starts < min(high + 3, len(codes)))] - low
        marks = symbols(codes[low : min(high + 3, len(codes))], here)[: high - low]
        cuts, state = scan(marks, state)
        found.append(np.flatnonzero(cuts) + low)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


class Pairs:
    """Rank of what two tokens make together, for many pairs at once."""

    def __init__(self, ranks: dict[bytes, int]):
        splits = array("q")
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                if (one := ranks.get(token[:k])) is not None and (two := ranks.get(token[k:])) is not None:
                    splits.extend((one, two, rank))
        found = np.array(splits, dtype=np.int64).reshape(-1, 3)
        self.base = max(ranks.values(), default=0) + 1
        keys = found[:, 0] * self.base + found[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = np.append(keys[order], 1 << 60), np.append(found[order, 2], NO_RANK)

    def __call__(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """NO_RANK for two tokens that make none."""
        wanted = one * self.base + two
        at = np.searchsorted(self.keys, wanted)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_RANK)


class Merges:
    """Ids of slices already merged: slice -> slot, and for each slot its ids' place in one flat array.

    A slice that is one token needs no slot: the vocabulary has it. A full memory keeps what was used since the last time.
    New slices of up to SHORT bytes are merged together, one pair of each a round.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        letters = [ranks.get(bytes([k]), -1) for k in range(256)]
        self.letters = np.array(letters, dtype=np.int64) if -1 not in letters else None  # else slices are merged one by one
        self.pairs = Pairs(ranks)
        self._begin([], [])

    def _begin(self, pieces: list[bytes], ids: list[tuple[int, ...]]) -> None:
        self.slots = {piece: k for k, piece in enumerate(pieces)}
        self.used = np.zeros(0, dtype=bool)
        self.ids, self.first = array("i"), array("q", [0])
        for own in ids:
            self.ids.extend(own)
            self.first.append(len(self.ids))

    def _forget(self) -> None:
        """Keep the slices used since the last time, if they are less than half, else none."""
        keep = np.zeros(len(self.slots), dtype=bool)
        keep[: len(self.used)] = self.used
        if keep.sum() * 2 > CACHED_SLICES:
            keep[:] = False
        kept = [(piece, k) for piece, k in self.slots.items() if keep[k]]
        self._begin([piece for piece, _ in kept], [tuple(self.ids[self.first[k] : self.first[k + 1]]) for _, k in kept])

    def __call__(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, how many each piece has)."""
        if len(self.slots) > CACHED_SLICES or len(self.ids) > 8 * CACHED_SLICES:
            self._forget()
        slots, ranks = self.slots, self.ranks
        self._add(set(pieces).difference(slots, ranks))
        single = np.fromiter(map(ranks.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        many = np.flatnonzero(single < 0)
        at = np.fromiter(map(slots.__getitem__, map(pieces.__getitem__, many.tolist())), dtype=np.int64, count=len(many))
        if len(self.used) < len(slots):
            self.used = np.concatenate([self.used, np.zeros(len(slots) - len(self.used), dtype=bool)])
        self.used[at] = True
        first, known = np.frombuffer(self.first, np.int64), np.frombuffer(self.ids, np.int32)
        sizes = np.ones(len(pieces), dtype=np.int64)
        sizes[many] = first[at + 1] - first[at]
        begin = np.cumsum(sizes) - sizes
        out = np.empty(int(sizes.sum()), dtype=np.int32)
        out[begin] = single
        out[ranges(begin[many], sizes[many])] = known[ranges(first[at], sizes[many])]
        return out, sizes

    def _add(self, pieces: set[bytes]) -> None:
        most = SHORT if self.letters is not None else 0
        short = [piece for piece in pieces if len(piece) <= most]
        long = [piece for piece in pieces if len(piece) > most]
        self.slots.update(zip([*short, *long], range(len(self.slots), len(self.slots) + len(pieces)), strict=True))
        if short:
            ids, sizes = self._together(short)
            self.first.frombytes((len(self.ids) + np.cumsum(sizes)).tobytes())
            self.ids.frombytes(ids.astype(np.int32).tobytes())
        for piece in long:
            self.ids.extend(self._ids(piece))
            self.first.append(len(self.ids))

    def _together(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in a row, how many each piece has). Parts are linked lists over the places of their first bytes."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        stops = np.cumsum(lengths)
        starts, end = stops - lengths, int(stops[-1])
        within = np.arange(end) - np.repeat(starts, lengths)  # place in the own piece
        part = self.letters[np.frombuffer(b"".join(pieces), dtype=np.uint8)]
        after, before = np.arange(1, end + 1), np.arange(-1, end)
        after[stops - 1], before[starts] = end, -1
        # Rank of each part with the next one, then its place: the least is the leftmost of those with the lowest rank.
        first = np.full(end, NO_RANK << 6)
        first[:-1] = (self.pairs(part[:-1], part[1:]) << 6) + within[:-1]
        first[stops - 1] = NO_RANK << 6
        alive, left = np.ones(end, dtype=bool), starts
        while len(left):
            least = np.minimum.reduceat(first, left)  # pieces that are done have no pair, so they may lie between
            some = least < NO_RANK << 6
            left, least = left[some], least[some]
            at, made = left + (least & 63), least >> 6
            gone = after[at]
            follow = after[gone]
            part[at], after[at], before[follow] = made, follow, at
            first[gone], alive[gone], first[at] = NO_RANK << 6, False, NO_RANK << 6
            inner, ahead = follow < end, before[at]
            behind = ahead >= 0
            one, two = np.concatenate([at[inner], ahead[behind]]), np.concatenate([follow[inner], at[behind]])
            first[one] = (self.pairs(part[one], part[two]) << 6) + within[one]
        return part[alive], np.add.reduceat(alive, starts, dtype=np.int64)

    def _ids(self, data: bytes) -> tuple[int, ...]:
        """Merge by rank, the lowest first and of equal ones the leftmost; a known slice is one token."""
        ranks, n = self.ranks, len(data)
        if (whole := ranks.get(data)) is not None:
            return (whole,)
        if n <= SHORT:
            rank = ranks.get
            parts = [data[i : i + 1] for i in range(n)]
            pairs = [rank(data[i : i + 2], NO_RANK) for i in range(n - 1)]
            while pairs and (lowest := min(pairs)) != NO_RANK:
                i = pairs.index(lowest)
                parts[i] += parts[i + 1]
                del parts[i + 1], pairs[i]
                if i:  # only the neighbours of what was merged have other pairs now
                    pairs[i - 1] = rank(parts[i - 1] + parts[i], NO_RANK)
                if i < len(pairs):
                    pairs[i] = rank(parts[i] + parts[i + 1], NO_RANK)
            return tuple(map(ranks.__getitem__, parts))
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # parts as a linked list over their starts
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or end[i] >= n or end[end[i]] != stop:
                continue  # one of the two parts has changed since
            alive[end[i]] = False
            end[i] = stop
            if stop < n:
                before[stop] = i
                if (r := ranks.get(data[i : end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (left := before[i]) >= 0 and (r := ranks.get(data[left:stop])) is not None:
                heapq.heappush(heap, (r, left, stop))
        ids, i = [], 0
        while i < n:
            ids.append(ranks[data[i : end[i]]])
            i = end[i]
        return tuple(ids)


def ranges(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first[0], first[0]+1, ... (sizes[0] numbers), then first[1], ... in one array."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - sizes), sizes)


class Codec:
    """A vocabulary of ranked byte strings, in the format of public rank files."""

    def __init__(self, data: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line)}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.length_of = np.array([len(token) for token in tokens], dtype=np.int64)
        self.first_of = np.cumsum(self.length_of) - self.length_of
        self.letters = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.merges = Merges(ranks)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text's ids start, and the end)."""
        joined = "".join(texts)
        lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        begin = np.concatenate([[0], np.cumsum(lengths)])
        cuts = boundaries(joined, begin[:-1][lengths > 0])
        data = joined.encode("utf-8", "surrogatepass")
        edges = cuts
        if len(data) > len(joined):
            codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
            wide = np.flatnonzero(codes > 0x7F)
            extra = np.cumsum(1 + (codes[wide] > 0x7FF) + (codes[wide] > 0xFFFF).astype(np.int64))
            edges = cuts + np.concatenate([[0], extra])[np.searchsorted(wide, cuts)]
        edges = [*edges.tolist(), len(data)]
        ids, sizes = self.merges([data[a:b] for a, b in pairwise(edges)])
        total = np.concatenate([[0], np.cumsum(sizes)])
        return ids, total[np.searchsorted(cuts, begin)]

    def offsets(self, ids: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Byte position of each token in its own text."""
        ends = np.cumsum(self.length_of[ids])
        starts = ends - self.length_of[ids]
        first = np.concatenate([starts, [ends[-1] if len(ends) else 0]])[begin[:-1]]
        return (starts - np.repeat(first, np.diff(begin))).astype(np.int32)

    def decode(self, ids: np.ndarray, places: np.ndarray | None = None) -> np.ndarray:
        """The bytes that the ids stand for, in a row, or each id's where its place says."""
        sizes = self.length_of[ids]
        found = self.letters[ranges(self.first_of[ids], sizes)]
        if places is None:
            return found
        out = np.zeros(len(found), dtype=np.uint8)
        out[ranges(places, sizes)] = found
        return out


@lru_cache(maxsize=4)
def _codec(digest: str, data: bytes) -> Codec:
    return Codec(data)


def groups(texts: pa.Array, size: int = BLOCK) -> Iterator[list[str]]:
    """The texts of an Arrow batch, a few at a time: up to about size code points, one text at least."""
    held, n = [], 0
    for text in texts:
        value = text.as_py() or ""
        if held and n + len(value) > size:
            yield held
            held, n = [], 0
        held.append(value)
        n += len(value)
    if held:
        yield held


class BpeUdfs:
    """Column functions for one rank file. The driver reads it, once; the 800 KB go out as a broadcast."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            data = file.read()
        shared = spark.sparkContext.broadcast(data)
        digest = hashlib.sha256(data).hexdigest()

        def lists(begin: np.ndarray, values: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(begin.astype(np.int32)), pa.array(values))

        # A few texts at a time go back as they are done, so a worker never holds the ids of a whole batch.
        @F.arrow_udf("struct<ids:array<int>,offsets:array<int>>")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _codec(digest, shared.value)
            for texts in (texts for batch in batches for texts in groups(batch)):
                found, begin = codec.encode(texts)
                both = [lists(begin, found), lists(begin, codec.offsets(found, begin))]
                yield pa.StructArray.from_arrays(both, names=["ids", "offsets"])

        @F.arrow_udf("struct<ids:array<int>,decoded:binary>")
        def both_ways(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _codec(digest, shared.value)
            for texts in (texts for batch in batches for texts in groups(batch)):
                found, begin = codec.encode(texts)
                own = lists(begin, found)
                decoded = _decoded(codec, own, lists(begin, codec.offsets(found, begin)))
                yield pa.StructArray.from_arrays([own, decoded], names=["ids", "decoded"])

        @F.arrow_udf("array<int>")
        def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _codec(digest, shared.value)
            for texts in (texts for batch in batches for texts in groups(batch)):
                found, begin = codec.encode(texts)
                yield lists(begin, found)

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = _codec(digest, shared.value)
            for batch in batches:
                for k in range(0, len(batch), 64):
                    yield _decoded(codec, batch[k : k + 64])

        @F.arrow_udf("binary")
        def placed(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
            codec = _codec(digest, shared.value)
            for lists, offsets in batches:
                for k in range(0, len(lists), 64):
                    yield _decoded(codec, lists[k : k + 64], offsets[k : k + 64])

        self._encode, self._ids, self._decode, self._placed, self._both_ways = encode, ids, decode, placed, both_ways

    def encode(self, text: Column | str) -> Column:
        """Struct of ids and offsets (each token's first byte within the text)."""
        return self._encode(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")))

    def both_ways(self, text: Column | str) -> Column:
        """Struct of ids and decoded, the bytes that those ids stand for, each id's put where its offset says.

        Both come from one worker of a task; encode() and decode_at() in a row need two.
        """
        return self._both_ways(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")))

    def ids(self, text: Column | str) -> Column:
        """The ids alone, where offsets are not needed."""
        return self._ids(F.coalesce(text if isinstance(text, Column) else F.col(text), F.lit("")))

    def decode(self, ids: Column | str) -> Column:
        """The bytes the ids stand for; null for null."""
        return self._decode(ids if isinstance(ids, Column) else F.col(ids))

    def decode_at(self, ids: Column | str, offsets: Column | str) -> Column:
        """The bytes the ids stand for, each id's put where its offset says; null for null."""
        return self._placed(*(x if isinstance(x, Column) else F.col(x) for x in (ids, offsets)))


def _decoded(codec: Codec, lists: pa.Array, offsets: pa.Array | None = None) -> pa.Array:
    flat = lists.flatten()
    ids = flat.to_numpy(zero_copy_only=False)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    bytes_to = np.concatenate([[0], np.cumsum(codec.length_of[ids])])[ends]
    edges = pa.py_buffer(bytes_to.astype(np.int32))
    valid = None
    if lists.null_count:
        valid = pa.py_buffer(np.packbits(lists.is_valid().to_numpy(zero_copy_only=False), bitorder="little"))
    places = None
    if offsets is not None:
        places = np.repeat(bytes_to[:-1], sizes) + offsets.flatten().to_numpy(zero_copy_only=False)
    return pa.Array.from_buffers(pa.binary(), len(lists), [valid, edges, pa.py_buffer(codec.decode(ids, places))])
