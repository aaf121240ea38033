"""Moments and projections of all sliding windows of a series, without writing the windows out.

A window of 168 hours and 5 signals is a vector of 840 numbers, of which the next window repeats 835. So the products of all windows follow
from single rows: entry (i, i + d) sums the 5 x 5 products of rows d apart, for every lag d once over the whole stretch, and for
other i by taking rows in at one border and out at the other. Projections add up one small product for each hour of
the window. Rows are dealt to the blocks of :mod:`hourloom.operators.neighbours`; a row travels once, and a twentieth of them twice.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.operators.neighbours import BLOCK, BLOCK_DAYS, HOME, SERIES, TIME, with_neighbours

_KEEP, _VALUES = "__keep", "__values"
_HOUR = 3600
#: Windows that are written out at a time, of the ones taken one by one.
_AT_ONCE = 256


def lagged_products(x: np.ndarray, low: int, high: int, length: int) -> np.ndarray:
    """Sum of the outer products of all windows of ``length`` rows that end at ``low`` .. ``high - 1``.

    Windows are flat, oldest row first. With M[i, d] the sum over the window ends t of the product of rows t - i and t - i - d: M[0, d] is one
    matrix product, and M[i, d] differs from M[i - 1, d] by the row that comes in before ``low`` and the one that goes before ``high``.
    """
    width = x.shape[1]
    out = np.zeros((length, length, width, width))
    for d in range(length):
        first = x[low:high].T @ x[low - d : high - d]
        back = np.arange(1, length - d)
        come = x[low - back][:, :, None] * x[low - back - d][:, None, :]
        go = x[high - back][:, :, None] * x[high - back - d][:, None, :]
        every = np.concatenate([first[None], first + np.cumsum(come - go, axis=0)])
        at = length - 1 - np.arange(length - d)
        out[at, at - d] = every
        out[at - d, at] = every.transpose(0, 2, 1)
    return out.transpose(0, 2, 1, 3).reshape(length * width, length * width)


def _window_sums(x: np.ndarray, low: int, high: int, length: int) -> np.ndarray:
    """Sum of all windows that end at ``low`` .. ``high - 1``: position h sums the rows h - length + 1 from the ends."""
    sums = np.concatenate([np.zeros((1, x.shape[1])), np.cumsum(x, axis=0)])
    h = np.arange(length) - length + 1
    return (sums[high + h] - sums[low + h]).ravel()


class _Moments:
    """Number, sum and products of the kept windows of all blocks of a task."""

    def __init__(self, length: int, width: int, contiguous: bool) -> None:
        self.length, self.contiguous = length, contiguous
        self.n, self.sum, self.products = 0, np.zeros(length * width), np.zeros((length * width, length * width))

    def add(self, time: np.ndarray, home: np.ndarray, keep: np.ndarray, x: np.ndarray) -> None:
        low = max(int(np.argmax(home)) if home.any() else len(x), self.length - 1)
        if low >= len(x):
            return
        ends = np.arange(low, len(x))
        good = keep[ends]
        if self.contiguous:
            good = good & (time[ends] - time[ends - self.length + 1] == (self.length - 1) * _HOUR)
        self.n += int(good.sum())
        sign, single = 1.0, ends[good]
        if 2 * len(single) > len(ends):  # all windows, less the few that do not count
            self.sum += _window_sums(x, low, len(x), self.length)
            self.products += lagged_products(x, low, len(x), self.length)
            sign, single = -1.0, ends[~good]
        windows = np.lib.stride_tricks.sliding_window_view(x, self.length, axis=0)
        for first in range(0, len(single), _AT_ONCE):
            some = windows[single[first : first + _AT_ONCE] - self.length + 1].transpose(0, 2, 1).reshape(-1, len(self.sum))
            self.sum += sign * some.sum(axis=0)
            self.products += sign * (some.T @ some)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """The batches of one block at a time; rows come sorted by series and block."""
    key, held = None, []
    for batch in batches:
        keys = list(zip(batch.column(SERIES).to_pylist(), batch.column(BLOCK).to_pylist()))
        low = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[low]:
                if held and keys[low] != key:
                    yield held
                    held = []
                key = keys[low]
                held.append(batch.slice(low, i - low))
                low = i
    if held:
        yield held


def _numbers(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def window_moments(
    rows: DataFrame, signals: Iterable[str], length: int, keep: Column, contiguous: bool = False, block_days: int = BLOCK_DAYS
) -> tuple[int, np.ndarray, np.ndarray]:
    """(n, mean, covariance) of the windows whose last row has ``keep``; signals must not be null.

    The result is of fixed size, so it comes to the driver; every task sums its own blocks, and tasks are summed hour by hour of the window.
    """
    signals = list(signals)
    width = len(signals)
    narrow = rows.select(SERIES, TIME, F.array(*[F.col(s).cast("double") for s in signals]).alias(_VALUES), F.coalesce(keep, F.lit(False)).alias(_KEEP))
    dealt = with_neighbours(narrow, back_rows=length - 1, block_days=block_days)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _Moments(length, width, contiguous)
        for block in _blocks(batches):
            table = pa.Table.from_batches(block)
            time, home, kept = (table[c].to_numpy() for c in (TIME, HOME, _KEEP))
            total.add(time, home, kept, _numbers(table[_VALUES], width))
        if total.n:
            lines = [np.concatenate([total.sum[h * width : (h + 1) * width], total.products[h * width : (h + 1) * width].ravel()]) for h in range(length)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(length), pa.int32()), pa.array([total.n] * length, pa.int64()), pa.array([line.tobytes() for line in lines], pa.binary())],
                names=["hour", "n", "sums"],
            )

    def add_up(parts: pa.Table) -> pa.Table:
        summed = np.zeros(width + width * width * length)
        for line in parts["sums"].to_pylist():
            summed += np.frombuffer(line)
        n = int(parts["n"].to_numpy().sum())
        return pa.table({"hour": pa.array([parts["hour"][0].as_py()], pa.int32()), "n": pa.array([n], pa.int64()), "sums": pa.array([summed.tobytes()], pa.binary())})

    schema = "hour int, n long, sums binary"
    partial = dealt.repartition(SERIES, BLOCK).sortWithinPartitions(SERIES, BLOCK, TIME).mapInArrow(run, schema)
    found = {r["hour"]: r for r in partial.groupBy("hour").applyInArrow(add_up, schema).toLocalIterator()}
    if not found:
        return 0, np.zeros(length * width), np.zeros((length * width, length * width))
    n, lines = found[0]["n"], np.stack([np.frombuffer(found[h]["sums"]) for h in range(length)])
    mean = lines[:, :width].reshape(-1) / n
    products = lines[:, width:].reshape(length * width, length * width)
    return n, mean, (products - n * np.outer(mean, mean)) / max(n - 1, 1)


def projection_errors(
    rows: DataFrame, signals: Iterable[str], length: int, mean: np.ndarray, components: np.ndarray, contiguous: bool = False, block_days: int = BLOCK_DAYS
) -> DataFrame:
    """``(ba, ts_unix, error)``: the mean square of what the orthonormal ``components`` (columns) leave of every window less ``mean``.

    A window belongs to its last row; rows with fewer predecessors have none.
    """
    signals = list(signals)
    width, kept = len(signals), components.shape[1]
    by_hour = np.concatenate([components, mean[:, None]], axis=1).reshape(length, width, kept + 1)
    offset, square = mean @ components, float(mean @ mean)

    def score(table: pa.Table) -> pa.Table:
        table = table.sort_by(TIME)
        time, home, x = table[TIME].to_numpy(), table[HOME].to_numpy(), _numbers(table[_VALUES], width)
        low = max(int(np.argmax(home)) if home.any() else len(x), length - 1)
        m = max(len(x) - low, 0)
        products = np.zeros((m, kept + 1))
        for h in range(length if m else 0):
            first = low - length + 1 + h
            products += x[first : first + m] @ by_hour[h]
        sums = np.concatenate([[0.0], np.cumsum((x**2).sum(axis=1))])
        ends = np.arange(low, low + m)
        energy = sums[ends + 1] - sums[ends - length + 1] - 2 * products[:, kept] + square
        error = np.maximum((energy - ((products[:, :kept] - offset) ** 2).sum(axis=1)) / (length * width), 0.0)
        if contiguous:
            whole = time[ends] - time[ends - length + 1] == (length - 1) * _HOUR
            ends, error = ends[whole], error[whole]
        return pa.table({SERIES: table[SERIES].take(pa.array(ends)), TIME: time[ends], "error": error})

    kind = rows.schema[SERIES].dataType.simpleString()
    narrow = rows.select(SERIES, F.col(TIME).cast("long").alias(TIME), F.array(*[F.col(s).cast("double") for s in signals]).alias(_VALUES))
    dealt = with_neighbours(narrow, back_rows=length - 1, block_days=block_days)
    return dealt.groupBy(SERIES, BLOCK).applyInArrow(score, f"{SERIES} {kind}, {TIME} long, error double")
