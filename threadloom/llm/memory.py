"""What a worker process keeps between tasks: one model, and the words it has seen with it."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable, Iterable
from typing import Any

import pyarrow as pa

_kept: dict[Hashable, Any] = {}


def keep_only(key: Hashable, build: Callable[[], Any] = lambda: None) -> Any:
    """The object under `key`, built at the first call; whatever was kept before it is let go.

    A worker process serves the stages of a job one after the other. Each of them calls this, so
    that it never holds the models of two, and the memory of the former goes back to the system.
    """
    if key not in _kept:
        _kept.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            pass  # not the C library that has it
        _kept[key] = build()
    return _kept[key]


class Memory:
    """Results by key, in two generations of at most `most` keys.

    When the newer one is full it becomes the older one, and a key found there comes back, so
    common keys stay. Keys longer than `longest` are forgotten at the next call.
    """

    def __init__(self, work: Callable[[list], Iterable], most: int, longest: int):
        self.work, self.most, self.longest = work, most, longest
        self.new, self.old, self.passing = {}, {}, []

    def of(self, keys: set) -> dict:
        """A dict that holds at least `keys`, right until the next call."""
        for key in self.passing:
            del self.new[key]
        self.passing = []
        missing = keys.difference(self.new)
        if missing:
            if len(self.new) + len(missing) > self.most:
                self.old, self.new, missing = self.new, {}, keys
            unknown = []
            for key in missing:
                value = self.old.get(key)
                if value is None:
                    unknown.append(key)
                else:
                    self.new[key] = value
            if unknown:
                self.new.update(zip(unknown, self.work(unknown), strict=True))
            self.passing = [k for k in unknown if len(k) > self.longest]
        return self.new
