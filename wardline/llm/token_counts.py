"""Exact token counts of whole texts and of their prefixes, for a BPE vocabulary with word ends.

A text falls into pieces (words, single digits, runs of signs). Inside a piece, dynamic programming over its
prefixes keeps the last token of each: the encoding of a prefix ends in token t exactly if t's bytes end
there, the prefix before t has a known encoding, and t may stand after that one's last token, that is, merging
the two of them gives these two again. One of the candidates fits, so counts are exact, and the counts of all
prefixes come from one pass. A budget or a cut is answered from them; tally() encodes the word over the limit again.

Prefixes are counted in code points of the normalised text (NFC, lower case); for texts in NFC without
U+0130 these are the code points of the text itself. Strings of special tokens inside a text count as one
token, as the tokenizer's own library has it. A null text counts as the empty one: no tokens.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Entries of a worker's memory of token pairs and of words; when full it is emptied.
REMEMBERED = 600_000
# Code points handled at once; longer texts are cut before white space that follows a non-space.
BLOCK = 1 << 20

# How the tokenizer of this vocabulary cuts normalised text, with the white space before a
# piece kept as a part of it.
CONTRACTION = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d")
PIECE = regex.compile(
    r"\p{White_Space}*(?:'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+)|\p{White_Space}+"
)
END = "</w>"
# str.split() also parts at these four, which are no white space in Unicode.
SEPARATORS = regex.compile("[\x1c-\x1f]")
WORD = regex.compile(r"\P{White_Space}+")
BLANKS = "".join(filter(regex.compile(r"\p{White_Space}").match, map(chr, range(0x3001))))
# Letters whose lower case is newer than this Python's tables.
NEW_LETTERS = {"\ua7cb": "\u0264", "\ua7dc": "\u019b"}


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on, in order."""
    kept = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in kept else next(spare)) for b in range(256)]


class PrefixCounter:
    def __init__(self, data: bytes):
        model = json.loads(data)
        self.ranks = {tuple(x.split(" ") if isinstance(x, str) else x): r for r, x in enumerate(model["model"]["merges"])}
        letters = byte_letters()
        self.of_byte = {chr(b): letter for b, letter in enumerate(letters)}
        self.made = {left + right: (rank, left, right) for (left, right), rank in self.ranks.items()}
        self.open, self.closed = set(), set()  # tokens inside a word, and those that end one, without the mark
        for token in model["model"]["vocab"]:
            symbols = self._symbols(token.removesuffix(END), token.endswith(END)) if token != END else []
            if symbols and self._merged(symbols) == [token]:
                (self.closed if token.endswith(END) else self.open).add(token.removesuffix(END))
        self.reach_open, self.reach_closed = _reach(self.open), _reach(self.closed)
        special = [t["content"] for t in model["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pairs: dict[tuple[str, str], bool] = {}
        self.words = Words(self)

    @staticmethod
    def _symbols(word: str, ends: bool) -> list[str]:
        symbols = list(word)
        if ends and symbols:
            symbols[-1] += END
        return symbols

    def _merged(self, symbols: list[str]) -> list[str]:
        parts, ranks, none = list(symbols), self.ranks, len(self.ranks)
        while len(parts) > 1:
            found = [ranks.get(pair, none) for pair in zip(parts, parts[1:], strict=False)]
            lowest = min(found)
            if lowest == none:
                break
            i = found.index(lowest)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether merging the letters of both gives just these two tokens.

        Merges are undone from the latest back. If at some stage the two parts that meet could have merged
        before the merge undone last, they would have, and the two tokens would not stand side by side. Of
        equal merges the one further left comes first.
        """
        fits = self.pairs.get((left, right))
        if fits is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            a, b, before, base = left, right, len(self.ranks), (-1, "", "")
            while fits is None:
                if self.ranks.get((a, b), before) < before:
                    fits = False
                    break
                made_a, made_b = self.made.get(a, base), self.made.get(b, base)
                if made_a[0] > made_b[0]:
                    before, a = made_a[0], made_a[2]
                elif made_b[0] >= 0:
                    before, b = made_b[0] + 1, made_b[1]
                else:
                    fits = True
            self.pairs[left, right] = fits
        return fits

    def _states(self, word: str) -> list[tuple[int, str]]:
        """(tokens, last token) of each prefix of a word's letters, the word going on after it."""
        states = [(0, "")]
        tokens, reach = self.open, self.reach_open
        for stop in range(1, len(word) + 1):
            for start in range(max(0, stop - reach.get(word[max(0, stop - 2) : stop], 1)), stop):
                token = word[start:stop]
                if token in tokens:
                    count, last = states[start]
                    if start == 0 or self._may_follow(last, token):
                        states.append((count + 1, token))
                        break
        return states

    def _closed(self, word: str, states: list[tuple[int, str]], stop: int) -> int:
        """Tokens of word[:stop] taken as a whole word."""
        for start in range(max(0, stop - self.reach_closed.get(word[max(0, stop - 2) : stop], 1)), stop):
            token = word[start:stop]
            if token in self.closed and (start == 0 or self._may_follow(states[start][1], token + END)):
                return states[start][0] + 1
        raise ValueError(f"no encoding ends at {stop} of {word!r}")

    def _letters(self, piece: str) -> str:
        return "".join(map(self.of_byte.__getitem__, piece.encode("utf-8", "surrogatepass").decode("latin-1")))

    def piece(self, piece: str) -> int:
        """Tokens of a piece with any white space before it."""
        word = self._letters(piece.lstrip(BLANKS))
        return self._closed(word, self._states(word[:-1]), len(word)) if word else 0

    def inside(self, piece: str) -> list[int]:
        """Tokens of each prefix of a piece, by code points, from one on."""
        body = piece.lstrip(BLANKS)
        counts = [0] * (len(piece) - len(body))
        if CONTRACTION.fullmatch(body):  # cut short, the tick and the letters are pieces of their own
            tick = self.piece("'")
            return counts + [tick] + [tick + self.piece(body[1:k]) for k in range(2, len(body))] + [self.piece(body)]
        word = self._letters(body)
        states, stop = self._states(word), 0
        for c in body:
            stop += len(c.encode("utf-8", "surrogatepass"))
            counts.append(self._closed(word, states, stop))
        return counts

    def parts(self, text: str) -> Iterator[tuple[str, bool]]:
        """Normalised stretches of a text and special strings (flag set), in order."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            if found.start() > at:
                yield normalised(text[at : found.start()]), False
            yield found.group(), True
            at = found.end()
        if at < len(text):
            yield normalised(text[at:]), False

    def tally(self, text: str, limit: int | None = None) -> tuple[int, int]:
        """(tokens of the text, code points of its longest prefix within limit tokens)."""
        tokens = chars = fit = 0
        open_piece = ""  # the piece at which the last stretch ended: a special string cut short would go on from it
        for stretch, special in self.parts(text):
            if special:
                if limit is not None and tokens <= limit:
                    before = tokens - (self.piece(open_piece) if open_piece else 0)
                    for k in range(1, len(stretch)):
                        if before + self._plain(open_piece + stretch[:k]) <= limit:
                            fit = chars + k
                tokens, chars, open_piece = tokens + 1, chars + len(stretch), ""
                if limit is None or tokens <= limit:
                    fit = chars
                continue
            for block in blocks(stretch):
                words = self._words(block)
                sizes = list(map(self.words.__getitem__, words))
                total = sum(sizes)
                if limit is None or tokens + total <= limit:
                    fit = chars + len(block)
                elif tokens <= limit:
                    fit = chars + self._within(block, limit - tokens)
                tokens, chars = tokens + total, chars + len(block)
                tail = "" if block[-1] in BLANKS else words[-1]
                open_piece = PIECE.findall(tail)[-1] if tail else ""
        return tokens, fit

    @staticmethod
    def _words(text: str) -> list[str]:
        return WORD.findall(text) if SEPARATORS.search(text) else text.split()

    def _within(self, text: str, budget: int) -> int:
        """Code points of the longest prefix within a budget that the whole text exceeds."""
        words = self._words(text)
        ends = np.cumsum(np.fromiter(map(self.words.__getitem__, words), dtype=np.int64, count=len(words)))
        k = int(np.searchsorted(ends, budget, side="right"))
        if SEPARATORS.search(text):
            rest = text[[found.start() for found in WORD.finditer(text)][k] :]
        else:
            rest = text.split(None, k)[k]  # from the word that exceeds it on
        done, held, fit = len(text) - len(rest), int(ends[k - 1]) if k else 0, 0
        fit = done
        for piece in PIECE.findall(rest):
            fit = max([fit, *(done + j for j, n in enumerate(self.inside(piece), 1) if held + n <= budget)])
            done, held = done + len(piece), held + self.piece(piece)
            if held > budget:
                return fit
        return fit

    def _plain(self, text: str) -> int:
        return sum(map(self.piece, PIECE.findall(normalised(text))))

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of every prefix of the normalised text, from the empty one on."""
        counts, tokens, open_piece = [0], 0, ""
        for stretch, special in self.parts(text):
            if special:
                before = tokens - (self.piece(open_piece) if open_piece else 0)
                counts += [before + self._plain(open_piece + stretch[:k]) for k in range(1, len(stretch))]
                tokens, open_piece = tokens + 1, ""
                counts.append(tokens)
                continue
            for piece in PIECE.findall(stretch):
                counts += [tokens + n for n in self.inside(piece)]
                tokens, open_piece = tokens + self.piece(piece), piece
        return np.array(counts, dtype=np.int32)


def _reach(tokens: set[str]) -> dict[str, int]:
    """Length of the longest token that ends in two given letters."""
    out: dict[str, int] = {}
    for token in tokens:
        out[token[-2:]] = max(len(token), out.get(token[-2:], 1))
    return out


class Words(dict):
    """Tokens of what stands between white space."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        count = self[word] = sum(map(self.counter.piece, PIECE.findall(word)))
        return count


def normalised(text: str) -> str:
    """NFC and lower case, each code point by itself (no final sigma)."""
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
    for letter, lower in NEW_LETTERS.items():
        text = text.replace(letter, lower)
    return text


def blocks(text: str, size: int = BLOCK) -> Iterator[str]:
    """A long text in parts; each but the first begins with white space after something else."""
    start = 0
    gap = regex.compile(r"(?<=\P{White_Space})\p{White_Space}")
    while len(text) - start > size:
        found = gap.search(text, start + size)
        if not found:
            break
        yield text[start : found.start()]
        start = found.start()
    if start < len(text):
        yield text[start:] if start else text


@lru_cache(maxsize=4)
def _counter(digest: str, data: bytes) -> PrefixCounter:
    return PrefixCounter(data)


class CountUdfs:
    """Column functions for one vocabulary file. The driver reads it; its few MB go out as a broadcast."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            data = file.read()
        shared, digest = spark.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()
        self._shared, self._digest = shared, digest

        @F.arrow_udf("array<int>")
        def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            counter = _counter(digest, shared.value)
            for batch in batches:
                yield pa.array([counter.prefix_counts(text.as_py() or "") for text in batch], pa.list_(pa.int32()))

        self._counts = counts

    def tally(self, text: str, limit: int) -> Column:
        """Struct of n_tokens and n_fit, the code points of the longest prefix within limit tokens."""
        shared, digest = self._shared, self._digest
        kind = pa.struct([("n_tokens", pa.int64()), ("n_fit", pa.int64())])

        @F.arrow_udf("struct<n_tokens:bigint,n_fit:bigint>")
        def tally(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            counter = _counter(digest, shared.value)
            for batch in batches:
                found = [counter.tally(text.as_py() or "", limit) for text in batch]
                yield pa.array([{"n_tokens": n, "n_fit": fit} for n, fit in found], kind)

        return tally(F.col(text))

    def prefix_counts(self, text: str) -> Column:
        """Tokens of every prefix of the text, element i for i code points."""
        return self._counts(F.col(text))
