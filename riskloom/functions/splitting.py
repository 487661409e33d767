"""Separator-aware splitting of one text, used inside a vectorised UDF."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

# Paragraph, line, word, character.
SEPARATORS = ("\n\n", "\n", " ", "")


def _pieces(text: str, separator: str) -> Iterator[str]:
    """Cut before every separator, so each piece but the first begins with it."""
    if separator == "":
        yield from text
        return
    start = 0
    at = text.find(separator)
    while at >= 0:
        if at > start:
            yield text[start:at]
        start = at
        at = text.find(separator, at + len(separator))
    if start < len(text):
        yield text[start:]


def _packed(pieces: list[str], size: int, overlap: int) -> Iterator[str]:
    """Fill chunks up to ``size``; each one starts with the last pieces of the one before."""
    held: deque[str] = deque()
    length = 0
    for piece in pieces:
        if held and length + len(piece) > size:
            yield "".join(held)
            while held and (length > overlap or length + len(piece) > size):
                length -= len(held.popleft())
        held.append(piece)
        length += len(piece)
    if held:
        yield "".join(held)


def split_text(
    text: str, size: int = 500, overlap: int = 50, separators: tuple[str, ...] = SEPARATORS
) -> list[str]:
    """Chunks of at most ``size`` characters, cut at the coarsest separator that serves."""
    level = next((i for i, s in enumerate(separators) if s in text), len(separators) - 1)
    finer = separators[level + 1 :]
    chunks: list[str] = []
    small: list[str] = []

    def flush() -> None:
        chunks.extend(c for c in map(str.strip, _packed(small, size, overlap)) if c)
        small.clear()

    for piece in _pieces(text, separators[level]):
        if len(piece) < size:
            small.append(piece)
            continue
        flush()
        if finer:
            chunks.extend(split_text(piece, size, overlap, finer))
        else:
            chunks.append(piece)
    flush()
    return chunks
