"""Long texts in parts, so that no operator holds more than a part's worth of Python objects."""

from __future__ import annotations

import re
from collections.abc import Iterator

GAP = re.compile(r"\s")
PART = 1 << 20


def parts(text: str, size: int = PART) -> Iterator[str]:
    """A text in parts of about size code points, each but the first beginning with white space.

    The parts put together are the text; no word is cut, so a word may make a part longer.
    """
    start = 0
    while len(text) - start > size and (found := GAP.search(text, start + size)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text
