"""What a Python worker keeps between batches.

Workers are used again by later stages, so they keep one tool only (a tokenizer
or a model with its cache): another one, or work that needs none, makes it go,
and what Arrow holds unused for it goes back to the system.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Hashable, Iterator
from contextlib import contextmanager
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_HELD: dict[Hashable, object] = {}


def held(key: Hashable | None, build: Callable[[], object] = lambda: None):
    """The tool named ``key``, built if the worker has it not; None lets it go."""
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            pa.default_memory_pool().release_unused()
        if key is None:
            return None
        _HELD[key] = build()
    return _HELD[key]


class Recent:
    """A mapping of bounded size that keeps what is used: the older half goes
    when the newer half is full, and what is found in the older half moves up."""

    def __init__(self, half: int):
        self.half, self.new, self.old = half, {}, {}

    def older(self, key):
        """The value of a key that ``new`` lacks, or None."""
        value = self.old.get(key)
        if value is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.new) >= self.half:
            self.old, self.new = self.new, {}
        self.new[key] = value


@contextmanager
def no_cycles() -> Iterator[None]:
    """For work that makes many objects and no reference cycles: the collector,
    which would look through a whole cache again and again, waits till its end."""
    before = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if before:
            gc.enable()


def in_slices(texts: pa.Array, work: Callable[[list], pa.Array], most_bytes: int = 2 << 20) -> pa.Array:
    """``work`` over slices of about ``most_bytes``, so that memory follows the
    slice and not the Arrow batch."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    edges = np.unique([0, *np.searchsorted(sizes, np.arange(most_bytes, sizes[-1] if len(sizes) else 0, most_bytes), "right"), len(texts)])
    parts = [work(texts.slice(a, b - a).to_pylist()) for a, b in pairwise(edges.tolist())]
    return pa.concat_arrays(parts) if parts else work([])
