"""Stateful work on many keys at once.

A call of Python for each key and batch costs more than the rows of most keys. So keys are dealt by a hash, their ``place``, to
``SLOTS`` groups; a call handles the rows of a slot's keys together, and a slot's state is a set of tables in which each row names its key.
The tables are kept in parts by place, ``PART_KEYS`` keys to a part or fewer on average: a batch reads and writes the parts of its
own keys, and the parts double as keys come.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

#: Groups that keys are dealt to, a power of two; keys of a part; rows of a key that are sorted at once.
SLOTS, PART_KEYS, RUN_ROWS = 512, 64, 1 << 18
_SLOT_BITS = SLOTS.bit_length() - 1


def place(*keys: str) -> Column:
    return F.xxhash64(*keys)


def slot(at: Column) -> Column:
    return at.bitwiseAND(F.lit(SLOTS - 1)).cast("int")


def slot_runs(frames: Iterator[pd.DataFrame], order: list[str], run_rows: int = RUN_ROWS) -> Iterator[pd.DataFrame]:
    """The rows of a slot, sorted: all rows of a key in one run, unless it has ``run_rows`` or more. Such a key is handled in runs of about
    so many, in the order of arrival."""
    waiting, rows, look = [], 0, run_rows
    for frame in frames:
        if len(frame):
            waiting.append(frame)
            rows += len(frame)
        if rows >= look:
            held = pd.concat(waiting, ignore_index=True)
            code = pd.factorize(held["place"])[0]
            hot = np.bincount(code)[code] >= run_rows
            if hot.any():
                yield held[hot].sort_values(order, ignore_index=True)
                held = held[~hot]
            waiting, rows, look = [held], len(held), len(held) + run_rows
    if rows:
        yield pd.concat(waiting, ignore_index=True).sort_values(order, ignore_index=True)


def codes(*columns: pd.Series) -> tuple[list[np.ndarray], np.ndarray]:
    """Numbers for the values of all ``columns`` together, null among them, and the values."""
    found, values = pd.factorize(np.concatenate([c.to_numpy(dtype=object) for c in columns]), use_na_sentinel=False)
    return np.split(found, np.cumsum([len(c) for c in columns])[:-1]), np.where(pd.isna(values), None, values)


class Parts:
    """The tables of a slot. ``tables`` names each with its schema, in which ``place`` is the place of the row's key. A part of a
    table may be cut further, into blocks."""

    def __init__(self, handle: StatefulProcessorHandle, tables: dict[str, pa.Schema]):
        self.tables = tables
        self.size = handle.getValueState("size", "keys long, bits int")
        self.maps = {name: handle.getMapState(name, "part int, block long", "rows binary") for name in tables}

    def open(self) -> Parts:
        self.keys, self.bits = self.size.get() if self.size.exists() else (0, 0)
        return self

    def of(self, places) -> np.ndarray:
        return (np.asarray(places, dtype=np.int64) >> _SLOT_BITS) & ((1 << self.bits) - 1)

    def _batches(self, name: str, stored: list[bytes]) -> list[pa.RecordBatch]:
        return [pa.ipc.read_record_batch(pa.py_buffer(s), self.tables[name]) for s in stored]

    def _frame(self, name: str, batches: list[pa.RecordBatch]) -> pd.DataFrame:
        return pa.Table.from_batches(batches, self.tables[name]).to_pandas()

    def read(self, name: str, parts: np.ndarray, blocks: np.ndarray | None = None) -> pd.DataFrame:
        """The rows of these parts, or of these pairs of part and block."""
        where = np.stack([parts, np.zeros_like(parts) if blocks is None else blocks])
        found = (self.maps[name].getValue((int(part), int(block))) for part, block in np.unique(where, axis=1).T)
        return self._frame(name, self._batches(name, [value[0] for value in found if value is not None]))

    def write(self, name: str, rows: pd.DataFrame, blocks: np.ndarray | None = None) -> None:
        """Replace the parts, or blocks of parts, that ``rows`` belong to."""
        where = np.stack([self.of(rows["place"]), np.zeros(len(rows), dtype=np.int64) if blocks is None else blocks])
        order = np.lexsort(where[::-1])
        where = where[:, order]
        batch = pa.RecordBatch.from_pandas(rows.iloc[order], self.tables[name], preserve_index=False)
        cuts = np.flatnonzero((np.diff(where) != 0).any(axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rows)]):
            if a < b:
                # Taken, not sliced: what is written of a slice may hold all rows.
                some = batch.take(pa.array(np.arange(a, b)))
                self.maps[name].updateValue((int(where[0, a]), int(where[1, a])), (some.serialize().to_pybytes(),))

    def remove(self, name: str, part: int, block: int) -> None:
        self.maps[name].removeKey((part, block))

    def add(self, keys: int) -> None:
        """Count new keys; more parts, where there are too many for those that are."""
        self.keys, bits = self.keys + keys, self.bits
        while self.keys > PART_KEYS << bits:
            bits += 1
        if bits != self.bits:
            stored = {name: list(of.iterator()) for name, of in self.maps.items()}
            self.bits = bits
            for name, entries in stored.items():
                batches = self._batches(name, [value[0] for _, value in entries])
                self.maps[name].clear()
                blocks = np.repeat(np.array([key[1] for key, _ in entries], dtype=np.int64), [b.num_rows for b in batches])
                self.write(name, self._frame(name, batches), blocks)
        if keys or not self.size.exists():
            self.size.update((self.keys, self.bits))

    def clear(self) -> None:
        for state in [self.size, *self.maps.values()]:
            state.clear()


class Slotted(StatefulProcessor):
    """Running values of the keys of a slot. With ``idle_s`` a group is a single key, whose state a timer ends ``idle_s`` after its last
    row, in event time."""

    tables: dict[str, pa.Schema]

    def __init__(self, order: list[str], idle_s: float | None):
        self.order, self.idle_s = order, idle_s

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = Parts(handle, self.tables)

    def run(self, rows: pd.DataFrame) -> pd.DataFrame:
        """The output for a sorted run, whose state is read and written."""
        raise NotImplementedError

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        self.parts.open()
        last_ts = None
        for run in slot_runs(rows, self.order):
            last_ts = float(run["ts"].iloc[-1])
            yield self.run(run)
        if self.idle_s is not None and last_ts is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(int((last_ts + self.idle_s) * 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.parts.clear()
        return iter(())

    def close(self) -> None:
        pass
