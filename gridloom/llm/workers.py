"""What tasks do for the process they run in, which runs many others after them."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa


def _give_back():
    gc.collect()
    trim()


def trim() -> None:
    """Gives freed memory back to the system; cheap enough for every few MB of rows."""
    pa.default_memory_pool().release_unused()
    found = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has that
    if found is not None:
        found(0)


def tidied_group(function):
    """The function for ``applyInArrow`` of one or two groups, giving freed memory back after each group."""
    if function.__code__.co_argcount == 2:
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            found = function(left, right)
            _give_back()
            return found
    else:
        def run(group: pa.Table) -> pa.Table:
            found = function(group)
            _give_back()
            return found
    return run


def tidied(function):
    """The function for ``mapInArrow``, giving freed memory back to the system when its task ends.

    A worker process runs tasks of many stages; without this, each keeps the largest heap that any of them needed.
    """

    def run(batches):
        try:
            yield from function(batches)
        finally:
            _give_back()

    return run
