"""Terms of whole texts as bytes, with only A-Z lower-cased.

Terms are runs of digits, a-z and anything beyond ASCII; spaced words are whatever stands between ASCII white space.
"""

from __future__ import annotations

from collections.abc import Iterator

# What a part of a long text is cut at: bytes, plus whatever is left of the term there.
PART = 1 << 22
LOWER = bytes(k + 32 if 65 <= k <= 90 else k for k in range(256))
# Bytes between terms become spaces, A-Z become a-z, all else stays.
TERMS = bytes(low if k > 0x7F or chr(low).isalnum() else 32 for k, low in enumerate(LOWER))
SPACED = bytes(32 if 9 <= k <= 13 else low for k, low in enumerate(LOWER))


def byte_parts(text: str | None, table: bytes = TERMS, size: int = PART) -> Iterator[bytes]:
    """A whole text's bytes with spaces between its terms, a part at a time; no term is cut."""
    whole = (text or "").encode("utf-8", "surrogatepass").translate(table)
    start = 0
    while len(whole) - start > size and (end := whole.find(b" ", start + size)) >= 0:
        yield whole[start:end]
        start = end
    yield whole[start:] if start else whole


def term_parts(text: str | None, table: bytes = TERMS, size: int = PART) -> Iterator[list[bytes]]:
    """The terms of a whole text in order, a part at a time. None and empty texts have none."""
    for part in byte_parts(text, table, size):
        yield part.split()
