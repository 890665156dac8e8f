"""Helpers shared by the operators: row functions on Arrow batches, memos."""

from __future__ import annotations

import weakref
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.sources.storage import ship_package

#: White space of the word contracts: space and U+0009 to U+000D, the same bytes that ``bytes.split()`` cuts at.
BLANKS = b" \t\n\x0b\x0c\r"

#: Rows and bytes of a batch that goes back from Python.
BATCH_ROWS, BATCH_BYTES = 4096, 8 << 20

_ENTRY = 200  # bytes of an entry besides its texts, about


def _cells(column: pa.Array) -> Callable:
    """A function that gives the value of a row."""
    kind = column.type
    if not (pa.types.is_list(kind) and (pa.types.is_integer(kind.value_type) or pa.types.is_floating(kind.value_type))):
        return lambda i: column[i].as_py()
    return lambda i: column[i].values.to_numpy(zero_copy_only=False) if column[i].is_valid else None


def _bytes(value) -> int:
    if isinstance(value, (str, bytes)):
        return len(value)
    if isinstance(value, np.ndarray):
        return value.nbytes
    return 16 * len(value) if isinstance(value, (list, tuple, frozenset)) else 8


def map_rows(df: DataFrame, schema: T.StructType, start: Callable[[], Callable[..., Iterable[tuple]]]) -> DataFrame:
    """One call per row on Arrow batches; each call gives any number of rows of ``schema``.

    ``start`` runs once per task and returns the function that is called with the columns of ``df``, arrays of
    numbers as numpy arrays. If that function has an attribute ``close``, its rows are added at the end of the task. Output goes back
    in batches of some thousand rows or some megabytes, so memory does not follow the size of a partition.
    """
    ship_package(df.sparkSession)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = start()
        out: list[tuple] = []
        held = 0
        for given in batches:
            cells = [_cells(column) for column in given.columns]
            for i in range(given.num_rows):
                for row in call(*(cell(i) for cell in cells)):
                    out.append(row)
                    held += sum(map(_bytes, row))
                    if len(out) >= BATCH_ROWS or held >= BATCH_BYTES:
                        yield batch(out)
                        out, held = [], 0
        out.extend(getattr(call, "close", tuple)())
        if out:
            yield batch(out)
        pa.default_memory_pool().release_unused()  # the worker stays for later tasks

    return df.mapInArrow(run, schema)


class Memo(dict):
    """Remembers ``make(key)`` of short keys; the keys and values of all memos of a process have one budget of bytes.

    A memo that holds half the budget lets its older half go. If all together pass the budget, those that were not
    added to for the longest time are emptied: a worker that goes on to another stage does not keep what the last one remembered.
    """

    budget = 64 << 20
    longest = 256
    _live: list[weakref.ref] = []  # the one that was added to last comes last

    def __init__(self, make: Callable):
        super().__init__()
        self.make, self.old, self.size, self.old_size, self.added = make, {}, 0, 0, 0
        Memo._live.append(weakref.ref(self))

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        self.put(key, value)
        return value

    def lacking(self, keys: Iterable) -> list:
        """The distinct keys that are not remembered."""
        return [k for k in set(keys) if k not in self and k not in self.old]

    def recalled(self, keys: Iterable) -> dict:
        """Those of the keys that the older half holds, with their values."""
        return {k: x for k in set(keys) if (x := self.old.get(k)) is not None}

    def put(self, key, value) -> None:
        if len(key) > self.longest:
            return
        self[key] = value
        self._grown(1, _bytes(key) + _bytes(value) + _ENTRY)

    def fill(self, pairs: dict[bytes, bytes]) -> bool:
        """Remembers many short texts at once; says whether all of them were short."""
        short = pairs if max(map(len, pairs), default=0) <= self.longest else {k: v for k, v in pairs.items() if len(k) <= self.longest}
        self.update(short)
        self._grown(len(short), sum(map(len, short)) + sum(map(len, short.values())) + _ENTRY * len(short))
        return short is pairs

    def _grown(self, n: int, size: int) -> None:
        self.size += size
        if self.size > self.budget // 2:
            self.old, self.old_size, self.size = dict(self), self.size, 0
            self.clear()
        self.added += n
        if self.added % 256 < n:
            self._share()

    def _share(self) -> None:
        others = [m for r in Memo._live if (m := r()) is not None and m is not self]
        while others and self.size + self.old_size + sum(m.size + m.old_size for m in others) > self.budget:
            first = others.pop(0)
            first.clear()
            first.old, first.size, first.old_size = {}, 0, 0
        Memo._live[:] = [weakref.ref(m) for m in [*others, self]]


_kept: dict = {}


def per_process(key, make: Callable):
    """An object that a Python worker makes once and keeps for its later tasks (a tokenizer, a memo)."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]

