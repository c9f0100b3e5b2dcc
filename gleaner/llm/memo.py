"""Bounded memory that a Python worker keeps from one task to the next."""

from __future__ import annotations

import ctypes
import gc
import pickle
import sys
import types
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa

from pyspark import Broadcast, SparkContext, cloudpickle


def per_worker(key: Hashable, make: Callable[[], object]) -> object:
    """The object made for ``key`` in this worker; made anew where it is not there.

    Task functions travel by value and have fresh globals in every task, so
    the object hangs on a module of its own. There is one at a time: a new
    kind of work drops what the one before remembered, and gives its memory back.
    """
    store = sys.modules.setdefault("_gleaner_worker_memo", types.ModuleType("_gleaner_worker_memo"))
    if getattr(store, "key", None) != key:
        if getattr(store, "held", None) is not None:
            store.held = store.key = None
            give_back()
        store.held, store.key = make(), key
    return store.held


def give_back() -> None:
    """Memory that nothing holds any more goes back to the machine; allocators keep it for themselves otherwise."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own counsel
        pass


def sent(context: SparkContext, thing: object) -> Broadcast:
    """``thing`` on its way to the tasks together with the code of its class, for executors without this package."""
    return context.broadcast(cloudpickle.dumps(thing))


def received(parcel: Broadcast) -> object:
    """What :func:`sent` sent."""
    return pickle.loads(parcel.value)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` as a task function that leaves no memory behind: a worker that waits for other stages to end holds nothing of its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            store = sys.modules.get("_gleaner_worker_memo")
            if store is not None:
                store.held = store.key = None
            give_back()

    return run


class Memo(dict):
    """``memo[key]`` is ``compute(key)``; long keys are not kept.

    At ``limit`` entries a new generation begins and the one before the last
    is forgotten. What is asked for again moves on to the new one, so that
    frequent keys stay.
    """

    def __init__(self, compute: Callable[[str], object], limit: int, longest: int = 40):
        super().__init__()
        self.compute, self.limit, self.longest = compute, limit, longest
        self.old: dict = {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(key) <= self.longest:
            if len(self) >= self.limit:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


def fresh(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column has it."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name
