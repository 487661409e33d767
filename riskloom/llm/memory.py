"""Python workers live on for later tasks; what a task has freed goes back to the machine."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Hand freed memory back: Arrow's pool and the C library would keep it for the next task."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over the batches of a task, giving its memory back at the end."""

    def through(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()

    return through
