"""Memory of Python workers, which Spark keeps for later stages."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa


def release() -> None:
    """Gives free memory back to the system, that of Arrow's pool and that of the C library where it can be asked."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def releasing(work: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for mapInArrow that gives back what Arrow's pool holds of batches that are done, and all free memory at its end.

    Otherwise a worker keeps some of its largest batches as free memory, also while it is idle.
    """

    def given(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch
            del batch
            pa.default_memory_pool().release_unused()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(given(batches))
        release()

    return run
