"""Memory of Python workers. Spark keeps idle workers, so what they hold counts on."""

from __future__ import annotations

import ctypes
import functools

import pyarrow as pa

#: ``mallopt``: blocks of this size and more are mapped, and go back to the system when freed.
_MMAP_THRESHOLD, MAPPED = -3, 1 << 20


def _libc():
    libc = ctypes.CDLL(None)
    return libc if hasattr(libc, "mallopt") and hasattr(libc, "malloc_trim") else None


def _set_allocator():
    libc = _libc()
    pa.set_memory_pool(pa.system_memory_pool())
    if libc:
        libc.mallopt(_MMAP_THRESHOLD, MAPPED)
    return libc


def frugal(run):
    """``run``, a function of ``mapInPandas``, so that its worker gives freed memory back to the system."""

    @functools.wraps(run)
    def work(batches):
        libc = _set_allocator()
        yield from run(batches)
        if libc:
            libc.malloc_trim(0)

    return work


def frugal_group(run):
    """The same for ``run``, a function of a key and its rows for ``applyInPandas``."""

    def work(key, pdf):
        libc = _set_allocator()
        out = run(key, pdf)
        if libc:
            libc.malloc_trim(0)
        return out

    return work
