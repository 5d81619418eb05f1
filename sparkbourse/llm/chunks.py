"""Token ids of texts by way of their chunks: what a tokenizer makes of a chunk is computed once and kept for a while."""

from __future__ import annotations

from collections.abc import Callable, Iterator

#: Longer chunks are rare and are not kept.
LONGEST_KEPT = 64


class Kept(dict):
    """Results by chunk, computed when first asked for. ``turn`` forgets what the last two generations did not use."""

    def __init__(self, compute: Callable[[str], bytes], keep: int):
        self._compute, self._keep, self._before = compute, keep, {}

    def __missing__(self, chunk):
        found = self._before.get(chunk)
        if found is None:
            found = self._compute(chunk)
        if len(chunk) <= LONGEST_KEPT:
            self[chunk] = found
        return found

    def turn(self) -> None:
        if len(self) > self._keep:
            self._before = dict(self)
            self.clear()


def slices(texts: list[str], chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Ranges of texts with about so many characters together; a longer text is alone."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield start, i
            start, held = i, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)
