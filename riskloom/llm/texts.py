"""Words and word windows of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is hashed from its bytes by a polynomial over random byte values, modulo 2**64, so all words
of a batch come from one running sum. A to Z count as a to z. Nothing here knows Spark; the tasks
call it on the Arrow batches that Spark hands them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts that are worked on at once, and bytes that are hashed at once: what a task holds beside
#: its batch is some forty times the former at most.
CHUNK_BYTES = 1 << 19
BLOCK_BYTES = 1 << 18
_ODD = 0x9E3779B97F4A7C15 | 1
_STEP = np.uint64(0xD6E8FEB86659FD93)
_LENGTH = np.uint64(0xA24BAED4963EE407)


def _lowered() -> np.ndarray:
    codes = np.arange(256)
    return np.where((codes >= 65) & (codes <= 90), codes + 32, codes)


_LOWER = _lowered()
_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_FOLDED_VALUES = _BYTE_VALUES[_LOWER]

#: Bytes of words that white space parts: [^\x20\x09-\x0D].
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[32, *range(9, 14)]] = False
#: Bytes of words made of letters and digits: [^\x00-\x2F\x3A-\x60\x7B-\x7F] once lower-cased.
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True

_powers_made: tuple[np.ndarray, np.ndarray] | None = None


def _made_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    made = []
    for base in (_ODD, pow(_ODD, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        made.append(np.multiply.accumulate(steps))
    return made[0], made[1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd base, and of its inverse modulo 2**64, up to n; those of a block are kept."""
    global _powers_made
    if n > BLOCK_BYTES:
        return _made_powers(n)
    if _powers_made is None:
        _powers_made = _made_powers(BLOCK_BYTES)
    return _powers_made


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(
    column: pa.Array, limit: int = CHUNK_BYTES
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: first row, last row, bytes, bounds.

    A null is an empty text. A text longer than the limit is a run of its own.
    """
    if column.null_count:
        column = column.fill_null("")
    if column.type != pa.string():
        column = column.cast(pa.string())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    bounds = bounds.astype(np.int64)
    values = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        last = min(max(last, first + 1), len(column))
        yield first, last, values[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first]
        first = last


def word_bounds(
    data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, in order."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = is_word[data]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    before = np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    before[edges] = False
    after = np.empty_like(inside)
    after[-1], after[:-1] = False, inside[1:]
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(bounds, starts, "right") - 1


def word_hashes(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True
) -> np.ndarray:
    """Hash of each run of bytes, starts and ends both ascending; with ``fold``, A to Z count as a to z."""
    values = _FOLDED_VALUES if fold else _BYTE_VALUES
    found = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, base + BLOCK_BYTES, "right")))
        n = int(ends[last - 1]) - base
        power, inverse = _powers(n)
        running = np.zeros(n + 1, np.uint64)
        np.cumsum(values[data[base : base + n]] * power[:n], out=running[1:])
        left, right = starts[first:last] - base, ends[first:last] - base
        found[first:last] = mix((running[right] - running[left]) * inverse[left])
        first = last
    return found


def window_hashes(
    words: np.ndarray, owner: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """First word and hash of every run of ``length`` words within one text."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.full(n, length, np.uint64) * _LENGTH
    for j in range(length):
        total = total * _STEP + words[j : j + n]
    whole = np.flatnonzero(owner[:n] == owner[length - 1 :])
    return whole, mix(total[whole])


def shingle_sets(
    data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray, length: int
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending within it, and the texts' numbers.

    A text of fewer words than ``length`` has one shingle of all its words; one without words
    has none.
    """
    starts, ends, owner = word_bounds(data, bounds, is_word)
    words = word_hashes(data, starts, ends)
    counts = np.bincount(owner, minlength=len(bounds) - 1)
    at, hashes = window_hashes(words, owner, length)
    owners, values = [owner[at]], [hashes]
    for short in range(1, length):
        if not (counts == short).any():
            continue
        at, hashes = window_hashes(words, owner, short)
        whole = counts[owner[at]] == short
        owners.append(owner[at][whole])
        values.append(hashes[whole])
    owner, hashes = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    return hashes[new], owner[new]
