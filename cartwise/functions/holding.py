"""Frames that operators persist, so that whoever runs them can release just those.

An operator returns a lazy frame that may read what it persisted, so it can't
release it itself. A job runner opens a ``scope`` around each job: what is held
inside it, in this thread, is released when it ends, also by an error. Outside
any scope ``release`` gives up what was held. A caller's own cached frames, and what
another scope holds, are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark import StorageLevel
from pyspark.sql import DataFrame

_HELD: list[DataFrame] = []
_SCOPE: ContextVar[list[DataFrame] | None] = ContextVar("held_frames", default=None)


def _frames() -> list[DataFrame]:
    scope = _SCOPE.get()
    return _HELD if scope is None else scope


def hold(df: DataFrame) -> DataFrame:
    """Persist ``df`` (memory, then disk) until the scope ends, or until ``release``."""
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    _frames().append(held)
    return held


def release() -> int:
    """Unpersist what is held in this scope (outside any, in none); returns how many frames."""
    frames = _frames()
    n = len(frames)
    while frames:
        frames.pop().unpersist()
    return n


@contextmanager
def scope() -> Iterator[None]:
    """Hold frames for the time of the block."""
    token = _SCOPE.set([])
    try:
        yield
    finally:
        release()
        _SCOPE.reset(token)
