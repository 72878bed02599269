"""Memory of Python workers, which Spark keeps for later tasks of other operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator

import pyarrow as pa


def give_back() -> None:
    """Return what the allocators hold unused to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(parts: Iterable) -> Iterator:
    """The parts as they come; before the first and after the last one memory is given back."""
    give_back()
    try:
        yield from parts
    finally:
        give_back()
