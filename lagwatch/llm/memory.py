"""What a Python worker keeps between tasks belongs to one operator at a time.

Workers live as long as their executor and run the tasks of many operators. An operator that keeps words
or a vocabulary for its next task says so here; when a task of another operator begins in the same worker, what
the first one kept is given back. So a chain of operators needs the memory of the largest, not of all.
"""

from __future__ import annotations

import gc
from collections.abc import Callable

import pyarrow as pa

_held: dict[str, Callable[[], None]] = {}


def begin(owner: str, release: Callable[[], None] | None = None) -> None:
    """Called by a task of ``owner``: others release what they hold, ``release`` gives back the owner's."""
    others = [name for name in _held if name != owner]
    for name in others:
        _held.pop(name)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
    if release:
        _held[owner] = release
