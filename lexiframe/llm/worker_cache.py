"""One cache per Python worker: workers outlive stages, so what a stage kept is dropped when another asks for its own."""

from __future__ import annotations

from collections.abc import Callable, Hashable
from typing import TypeVar

import pyarrow as pa

Kept = TypeVar("Kept")
_held: dict[Hashable, object] = {}


def only_cache(name: Hashable, make: Callable[[], Kept]) -> Kept:
    """What ``make`` gave when this worker first asked for ``name``; asking for another name lets go of it."""
    if name not in _held:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[name] = make()
    return _held[name]
