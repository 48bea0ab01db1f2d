"""Caches of Python workers, which outlive tasks: only the operator at work holds any.

A module that keeps something between tasks registers how it is dropped; a task claims the caches
of its operator when it starts, and what others left behind in the same worker goes. Results never
depend on a cache. What is freed then is given back to the system, as the memory of idle workers
counts against their executor.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable

import pyarrow as pa

_DROP: dict[str, Callable[[], None]] = {}
_owner: str | None = None


def register(owner: str, drop: Callable[[], None]) -> None:
    _DROP[owner] = drop


def claim(owner: str) -> None:
    """From here on this worker holds the caches of ``owner`` only."""
    global _owner
    if owner != _owner:
        for other, drop in _DROP.items():
            if other != owner:
                drop()
        give_back()
        _owner = owner


def give_back() -> None:
    """Return free memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)
