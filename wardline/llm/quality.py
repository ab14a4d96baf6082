"""Quality of whole texts by a generalised additive model with pairwise interactions.

Each text becomes a few numbers (shape of its words, signs, capitals, repetition, lines). Training goes round
the features again and again; each turn fits a shallow tree to the gradient over that feature's bins and adds a
little of it to the feature's lookup table. When the single features are done, the pairs that explain most of
what is left get two-way tables in the same manner. A score is the sum of one entry per table through the
logistic function, so scoring is a bin search and an addition per feature.

Features are computed on Spark for every row. The fit takes at most sample_rows distinct labelled rows
(expected; drawn by a hash of id and features) with how often each occurs, as feature numbers, never texts.

Defined results: null and empty texts have the features of the empty text and get a score like any other. With
no labelled rows the score is 0.5 everywhere; with one class only, its smoothed share.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.session import written

SAMPLE_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIRS = 6
PAIR_ROUNDS = 40
RATE = 0.15
# Hessian weight that a leaf has at least, and what is added to it against overfitting.
LEAF_WEIGHT = 2.0
RIDGE = 1.0
BLOCK = 1 << 20

FEATURES = (
    "log_chars",
    "word_length",
    "long_words",
    "capitals",
    "shouted_words",
    "digits",
    "sign_kinds",
    "signs",
    "marks_in_words",
    "bars",
    "exclamations",
    "distinct_words",
    "top_word",
    "same_as_before",
    "lines",
    "distinct_lines",
    "sentence_ends",
    "non_ascii",
)

UPPER = regex.compile(r"\p{Lu}")
DIGIT = regex.compile(r"\p{Nd}")
SIGN = regex.compile(r"[^\p{L}\p{M}\p{N}\s]+")
INSIDE = regex.compile(r"\S[^\p{L}\p{M}\p{N}\s.,;:!?'’-]{2,}(?=\s|$)")


def features(text: str) -> list[float]:
    """The numbers of FEATURES for a whole text; long texts are gathered in parts."""
    n = len(text)
    words: Counter[str] = Counter()
    lines: Counter[int] = Counter()
    sums = Counter()
    kinds: set[str] = set()
    held: list[str] = []  # of a line that goes on in the next part
    last = ""
    for part, gap in _parts(text):
        found = part.split()
        words.update(found)
        sums["again"] += sum(map(str.__eq__, found, [last, *found[:-1]]))
        last = found[-1] if found else last
        sums["upper"] += len(UPPER.findall(part))
        sums["digit"] += len(DIGIT.findall(part)) if any(map(part.__contains__, "0123456789")) or not part.isascii() else 0
        signs = SIGN.findall(part)
        sums["sign"] += sum(map(len, signs))
        kinds.update(signs)
        sums["inside"] += len(INSIDE.findall(part))
        sums["bar"] += part.count("|")
        sums["bang"] += part.count("!")
        sums["end"] += part.count(". ") + part.count(".\n") + (gap != "" and part.endswith("."))
        sums["ascii"] += len(part.encode("utf-8", "surrogatepass")) - len(part)
        ended = part.split("\n")
        goes_on = [ended.pop(), gap] if gap == " " else []
        if ended:
            ended[0] = "".join([*held, ended[0]])
            held = []
        held += goes_on
        lines.update(map(hash, ended))
    total = words.total()
    count = max(1, total)
    lengths = sum(len(w) * k for w, k in words.items())
    return [
        float(np.log1p(n)),
        lengths / count,
        sum(k for w, k in words.items() if len(w) > 12) / count,
        sums["upper"] / max(1, n),
        sum(k for w, k in words.items() if len(w) > 1 and w.isupper()) / count,
        sums["digit"] / max(1, n),
        float(len(kinds)),
        sums["sign"] / max(1, n),
        sums["inside"] / count,
        sums["bar"] / count,
        sums["bang"] / count,
        len(words) / count,
        max(words.values(), default=0) / count,
        sums["again"] / count,
        lines.total() / count,
        len(lines) / max(1, lines.total()),
        sums["end"] / count,
        sums["ascii"] / max(1, n),
    ]


def _parts(text: str) -> Iterator[tuple[str, str]]:
    """A text in parts of BLOCK code points that end at a line's end, or at white space, with what follows each."""
    start = 0
    while len(text) - start > BLOCK:
        stop = text.find("\n", start + BLOCK)
        stop = stop if 0 <= stop < start + 2 * BLOCK else text.find(" ", start + BLOCK)
        if stop < 0:
            break
        yield text[start:stop], text[stop]
        start = stop + 1
    yield text[start:], ""


def features_column(text: str) -> Column:
    @F.arrow_udf("array<double>")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([features(x.as_py() or "") for x in batch], pa.list_(pa.float64()))

    return column(F.col(text))


class Additive:
    """An intercept, a lookup table per feature and one per chosen pair of features."""

    def __init__(self, intercept: float, edges: list[np.ndarray], tables: list[np.ndarray]):
        self.intercept, self.edges, self.tables = intercept, edges, tables
        self.pairs: list[tuple[int, int]] = []
        self.pair_edges: list[np.ndarray] = []
        self.pair_tables: list[np.ndarray] = []

    def logits(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for k, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, k], side="right")]
        if self.pairs:
            coarse = [np.searchsorted(edges, x[:, k], side="right") for k, edges in enumerate(self.pair_edges)]
            for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
                total += table[coarse[i], coarse[j]]
        return total

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x), -30, 30)))


def _edges(column: np.ndarray, bins: int, weights: np.ndarray) -> np.ndarray:
    """Cut points between distinct values, at (nearest) quantiles of the values repeated by their weights."""
    order = np.argsort(column, kind="stable")
    upto = np.cumsum(weights[order])
    places = np.rint(np.linspace(0, 1, bins + 1)[1:-1] * (upto[-1] - 1))
    values = np.unique(column[order][np.searchsorted(upto, places, side="right")])
    distinct = np.unique(column)
    after = np.searchsorted(distinct, values, side="right")
    values, after = values[after < len(distinct)], after[after < len(distinct)]
    return (values + distinct[after]) / 2


def _split(grad: np.ndarray, hess: np.ndarray) -> tuple[float, int]:
    """(gain, place) of the best cut of a row of bins in two."""
    g, h = np.cumsum(grad)[:-1], np.cumsum(hess)[:-1]
    G, H = grad.sum(), hess.sum()
    fits = (h >= LEAF_WEIGHT) & (H - h >= LEAF_WEIGHT)
    if not fits.any():
        return 0.0, 0
    gain = np.where(fits, g**2 / (h + RIDGE) + (G - g) ** 2 / (H - h + RIDGE) - G**2 / (H + RIDGE), 0)
    place = int(np.argmax(gain))
    return float(gain[place]), place + 1


def _tree(grad: np.ndarray, hess: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value of every bin of a tree of the given depth."""
    gain, place = _split(grad, hess) if depth and len(grad) > 1 else (0.0, 0)
    if gain <= 1e-9:
        return np.full(len(grad), grad.sum() / (hess.sum() + RIDGE))
    return np.concatenate([_tree(grad[:place], hess[:place], depth - 1), _tree(grad[place:], hess[place:], depth - 1)])


def _tree2(grad: np.ndarray, hess: np.ndarray) -> tuple[np.ndarray, float]:
    """(leaf values, gain) of a tree that cuts one feature and then the other on each side."""
    best = (np.full(grad.shape, grad.sum() / (hess.sum() + RIDGE)), 0.0)
    for turned in (False, True):
        g, h = (grad.T, hess.T) if turned else (grad, hess)
        for cut in range(1, g.shape[0]):
            leaves, total = [], -g.sum() ** 2 / (h.sum() + RIDGE)
            for part_g, part_h in ((g[:cut], h[:cut]), (g[cut:], h[cut:])):
                one_g, one_h = part_g.sum(axis=0), part_h.sum(axis=0)
                row = _tree(one_g, one_h, 1)
                total += float((row * one_g).sum())
                leaves.append(np.tile(row, (len(part_g), 1)))
            if total > best[1]:
                values = np.concatenate(leaves)
                best = (values.T if turned else values, total)
    return best


def fit(x: np.ndarray, y: np.ndarray, weights: np.ndarray | None = None) -> Additive:
    """Learn from feature rows x and labels y (0 or 1), each as often as its (whole) weight says."""
    width = len(FEATURES)
    if not len(y):
        return Additive(0.0, [np.zeros(0)] * width, [np.zeros(1)] * width)
    w = np.ones(len(y)) if weights is None else weights
    share = ((w * y).sum() + 0.5) / (w.sum() + 1)
    edges = [_edges(x[:, k], BINS, w) for k in range(width)]
    model = Additive(float(np.log(share / (1 - share))), edges, [np.zeros(len(e) + 1) for e in edges])
    if y.min() == y.max():
        return model
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]
    logits = np.full(len(y), model.intercept)
    for _ in range(ROUNDS):
        for k, (own, table) in enumerate(zip(bins, model.tables, strict=True)):
            p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
            grad = np.bincount(own, w * (y - p), minlength=len(table))
            step = RATE * _tree(grad, np.bincount(own, w * p * (1 - p), minlength=len(table)))
            table += step
            logits += step[own]
    model.pair_edges = [_edges(x[:, k], PAIR_BINS, w) for k in range(width)]
    coarse = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(model.pair_edges)]
    shapes = [len(e) + 1 for e in model.pair_edges]

    def tables(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logits, -30, 30)))
        cell, size = coarse[i] * shapes[j] + coarse[j], shapes[i] * shapes[j]
        sums = [np.bincount(cell, v, minlength=size).reshape(shapes[i], shapes[j]) for v in (w * (y - p), w * p * (1 - p))]
        return cell, *sums

    gains = sorted(((-_tree2(*tables(i, j)[1:])[1], i, j) for i, j in combinations(range(width), 2)))
    model.pairs = [(i, j) for gain, i, j in gains[:PAIRS] if gain < -1e-9]
    model.pair_tables = [np.zeros((shapes[i], shapes[j])) for i, j in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            cell, grad, hess = tables(i, j)
            step = RATE * _tree2(grad, hess)[0]
            table += step
            logits += step.ravel()[cell]
    return model


def train(rows: DataFrame, labels: DataFrame, id: str, label: str, sample_rows: int = SAMPLE_ROWS) -> Additive:
    """Learn from rows (id, features) and labels (id, label 0 or 1); rows without either are left out.

    Several labels for an id count once each by their distinct values, repeated rows by how often they occur.
    """
    marks = labels.select(F.col(id).alias("id"), F.col(label).cast("int").alias("y")).filter("y in (0, 1)").distinct()
    known = rows.select(F.col(id).alias("id"), "features").join(marks, "id")
    known = written(known.groupBy("id", "y", "features").agg(F.count("*").alias("weight")), "known")
    draw = F.pmod(F.xxhash64("id", "features", F.lit(9)), F.lit(1 << 30)) / (1 << 30)
    sample = known.filter(draw < min(1.0, sample_rows / max(1, known.count()))).orderBy("id", "y", "features").toArrow()
    x = np.array(sample["features"].to_pylist(), dtype=float).reshape(sample.num_rows, len(FEATURES))
    return fit(x, sample["y"].to_numpy().astype(float), sample["weight"].to_numpy().astype(float))


def score_column(model: Additive, features: str) -> Column:
    """Score (0 to 1) of a feature column."""

    @F.arrow_udf("double")
    def column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            x = batch.flatten().to_numpy(zero_copy_only=False).reshape(len(batch), len(FEATURES))
            yield pa.array(model.scores(x))

    return column(F.col(features))
