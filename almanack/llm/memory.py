"""Gives a Python worker's free memory back, so that workers that wait for their next task hold little."""

from __future__ import annotations

import ctypes
import functools
import inspect

import pyarrow as pa


def trim() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library than glibc
        pass


def trimmed(f):
    """``f`` for mapInPandas, mapInArrow or applyInPandas, trimming when it is done with its batches or group."""
    if inspect.isgeneratorfunction(f):

        @functools.wraps(f)
        def over_batches(batches):
            try:
                yield from f(batches)
            finally:
                trim()

        return over_batches

    @functools.wraps(f)
    def over_group(*group):
        try:
            return f(*group)
        finally:
            trim()

    # Spark counts the arguments
    over_group.__signature__ = inspect.signature(f)
    return over_group
