"""Arrow batches in parts, so that what Python makes of them at once is bounded by bytes and not by rows."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from typing import TypeVar

import pyarrow as pa

Batch = TypeVar("Batch", pa.Array, pa.RecordBatch)

# Bytes of a part; a single row may be larger.
PART_BYTES = 1 << 20


def parts(batch: Batch, most: int = PART_BYTES) -> Iterator[Batch]:
    """The batch, halved until a part is small or one row; the rows keep their order."""
    if len(batch) <= 1 or batch.nbytes <= most:
        yield batch
    else:
        half = len(batch) // 2
        yield from parts(batch.slice(0, half), most)
        yield from parts(batch.slice(half), most)


def give_back() -> None:
    """Hands freed memory to the system; the allocators would keep it while a worker waits for its next task."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:  # only the GNU library has it
        trim(0)


def giving_back(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The work of a task, after which its memory is given back."""

    @wraps(work)
    def task(batches):
        yield from work(batches)
        give_back()

    return task


def in_parts(batches: Iterable[Batch], most: int = PART_BYTES) -> Iterator[Batch]:
    """The parts of all batches."""
    for batch in batches:
        yield from parts(batch, most)
