"""Positions of chosen words in whole texts, with DataFrame functions only.

Words are runs of digits, letters and anything beyond ASCII; only A-Z is lower-cased. For joins a word stands
as a bucket, a hash of its lower case modulo BUCKETS: a table of distinct buckets has a bounded size whatever
it was made from, so it may be broadcast to drop almost all words of a corpus before anything is shuffled.
Buckets only pre-select; what they let through is compared word for word afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what stands between two words (the letters' case is settled later, on far fewer words).
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# At most so many buckets: a broadcast of all of them takes some 30 MB.
BUCKETS = 1 << 20


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def split_words(text: str) -> Column:
    """The words of a text column in order, as written; none for null."""
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), BETWEEN), "")


def bucket(*words: Column) -> Column:
    return F.pmod(F.xxhash64(*[F.lower(word) for word in words]), F.lit(BUCKETS))
