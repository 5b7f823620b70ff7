"""Return memory that a task no longer uses, as workers live on from task to task."""

from __future__ import annotations

import ctypes

import pyarrow as pa


def give_back() -> None:
    """Hand freed memory of Arrow and of the C library back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library; it has its own ways
        pass


def tidy(function):
    """A function of batches that gives back memory when its partition is done."""

    def run(batches):
        yield from function(batches)
        give_back()

    return run
