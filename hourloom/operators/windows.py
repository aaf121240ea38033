"""Lags, rolling statistics, leads and sequences per series."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.functions import schema as S
from hourloom.operators.labels import add_labels
from hourloom.operators.neighbours import BLOCK, BLOCK_DAYS, HOME, IN_BLOCK, SERIES, TIME, over_series, with_neighbours

HOUR = 3600


def _over(frame: str = "") -> str:
    return f"OVER ({IN_BLOCK} {frame})"


_HISTORY, _MOMENTS = "__history", "__moments"


def history_column(signals: Iterable[str] = S.HISTORY_SIGNALS, rows: int = max(S.LAG_HOURS)) -> str:
    """The last ``rows`` rows before the current one, as an array.

    One window frame in place of one per lag: building 48 frames costs every task more than a second.
    """
    values = ", ".join(f"{s}_mw" for s in signals)
    return f"collect_list(struct({values})) {_over(f'ROWS BETWEEN {rows} PRECEDING AND 1 PRECEDING')} AS {_HISTORY}"


def lag_columns(signals: Iterable[str] = S.HISTORY_SIGNALS, hours: Iterable[int] = S.LAG_HOURS) -> list[str]:
    """Past values by row, read from the history: after a gap a lag reaches further back in time."""
    return [f"try_element_at({_HISTORY}, -{h}).{s}_mw AS {S.lag_name(s, h)}" for h in hours for s in signals]


def time_history_columns(signals: Iterable[str] = S.HISTORY_SIGNALS, hours: int = max(S.LAG_HOURS)) -> list[str]:
    """Times and values of the rows of the last hours, the current one left out, oldest first: two lists over one frame."""
    values = ", ".join(f"{s}_mw" for s in signals)
    recent = _over(f"RANGE BETWEEN {hours * HOUR} PRECEDING AND {HOUR} PRECEDING")
    return [f"collect_list({TIME}) {recent} AS {_MOMENTS}", f"collect_list(struct({values})) {recent} AS {_HISTORY}"]


def time_lag_columns(signals: Iterable[str] = S.HISTORY_SIGNALS, hours: Iterable[int] = S.LAG_HOURS) -> list[str]:
    """Past values by time: of the row exactly so many hours earlier, found by its time in the history, or null."""
    place = "CAST(nullif(array_position({m}, {t} - {seconds}), 0) AS INT)"
    return [
        f"try_element_at({_HISTORY}, {place.format(m=_MOMENTS, t=TIME, seconds=h * HOUR)}).{s}_mw AS {S.lag_name(s, h)}"
        for h in hours
        for s in signals
    ]


def rolling_columns(signals: Iterable[str] = S.HISTORY_SIGNALS, windows: dict[str, int] = S.ROLLING_HOURS) -> list[str]:
    """Mean and population deviation over the last hours, current hour included, by time."""
    columns = []
    for label, hours in windows.items():
        recent = _over(f"RANGE BETWEEN {(hours - 1) * HOUR} PRECEDING AND CURRENT ROW")
        for s in signals:
            columns.append(f"avg({s}_mw) {recent} AS {S.rolling_name(s, label, 'mean')}")
            columns.append(f"stddev_pop({s}_mw) {recent} AS {S.rolling_name(s, label, 'std')}")
    return columns


def lead_columns(signals: Iterable[str] = S.LEAD_SIGNALS, hours: Iterable[int] = S.LEAD_HOURS) -> list[str]:
    """Future values, by row."""
    return [f"lead({s}_mw, {h}) {_over()} AS {S.lead_name(s, h)}" for h in hours for s in signals]


def add_lags(panel: DataFrame, mode: str = "row", block_days: int = BLOCK_DAYS) -> DataFrame:
    """All lags; ``row`` counts rows back, ``time`` hours."""
    reach = max(S.LAG_HOURS)
    if mode == "time":
        windowed = over_series(panel, time_history_columns(), back_seconds=reach * HOUR, block_days=block_days)
        return windowed.selectExpr(*panel.columns, *time_lag_columns())
    if mode == "row":
        windowed = over_series(panel, [history_column()], back_rows=reach, block_days=block_days)
        return windowed.selectExpr(*panel.columns, *lag_columns())
    raise ValueError(f"mode must be 'row' or 'time', got {mode!r}")


#: Values of windows laid side by side at once, for deviations; a window with more stands alone.
_SIDE_BY_SIDE = 1 << 20


def _deviations(values: np.ndarray, valid: np.ndarray, means: np.ndarray, counts: np.ndarray, first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Population deviation of every window around its own mean, so that no digits cancel."""
    squares = np.empty(len(means))
    upto = np.cumsum(sizes)
    low = 0
    while low < len(means):
        high = max(low + 1, int(np.searchsorted(upto, upto[low] - sizes[low] + _SIDE_BY_SIDE, side="right")))
        size = sizes[low:high]
        begin = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(first[low:high] - begin, size)
        off = np.where(valid[place], values[place] - np.repeat(means[low:high], size), 0.0)
        squares[low:high] = np.add.reduceat(off * off, begin)
        low = high
    return np.sqrt(squares / counts)


def _roll(signals: list[str], windows: dict[str, int], statistics: list[str]):
    """Sorted whole blocks to the rows that are at home there, with the statistics of their windows.

    Blocks of a batch are rolled side by side: their times are laid one after another, further apart than a window reaches.
    """
    reach = (max(windows.values()) - 1) * HOUR

    def starts(rows: pa.Table) -> np.ndarray:
        series = rows[SERIES].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
        block = rows[BLOCK].to_numpy()
        return np.flatnonzero(np.append(True, (series[1:] != series[:-1]) | (block[1:] != block[:-1])))

    def rolled(rows: pa.Table, begin: np.ndarray) -> pa.Table:
        time = rows[TIME].fill_null(0).to_numpy()  # rows without a time have blocks of their own
        sizes = np.diff(np.append(begin, len(time)))
        time = time - np.repeat(time[begin], sizes)
        time += np.repeat(np.arange(len(begin)) * (int(time.max()) + reach + 1), sizes)
        found = {}
        with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
            for label, hours in windows.items():
                first = np.searchsorted(time, time - (hours - 1) * HOUR, side="left")
                end = np.searchsorted(time, time, side="right")
                ends = np.column_stack([first, end]).ravel()
                for s in signals:
                    column = rows[f"{s}_mw"].cast(pa.float64())
                    valid, values = column.is_valid().to_numpy(), column.fill_null(0.0).to_numpy()
                    counts = np.add.reduceat(np.append(valid, False).astype(np.int64), ends)[::2]
                    means = np.add.reduceat(np.append(values, 0.0), ends)[::2] / counts
                    found[s, label, "mean"] = pa.array(means, mask=counts == 0)
                    if "std" in statistics:
                        found[s, label, "std"] = pa.array(_deviations(values, valid, means, counts, first, end - first), mask=counts == 0)
        for s, label, statistic in [(s, w, f) for w in windows for s in signals for f in statistics]:
            rows = rows.append_column(S.rolling_name(s, label, statistic), found[s, label, statistic])
        return rows.filter(rows[HOME]).drop_columns([BLOCK, HOME])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last block of a batch may go on in the next one
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            if rows.num_rows:
                begin = starts(rows)
                rest = rows.slice(int(begin[-1]))
                if len(begin) > 1:
                    yield from rolled(rows.slice(0, int(begin[-1])), begin[:-1]).to_batches()
        if rest is not None:
            yield from rolled(rest, np.zeros(1, dtype=np.int64)).to_batches()

    return run


def add_rolling(panel: DataFrame, block_days: int = BLOCK_DAYS, statistics: Iterable[str] = ("mean", "std")) -> DataFrame:
    """The rolling ``statistics`` of :func:`rolling_columns`.

    A window frame goes over all its rows anew for every row, value by value; here numpy adds up the rows of each
    frame, in blocks that Spark deals.
    """
    statistics, reach = list(statistics), (max(S.ROLLING_HOURS.values()) - 1) * HOUR
    names = [S.rolling_name(s, w, f) for w in S.ROLLING_HOURS for s in S.HISTORY_SIGNALS for f in statistics]
    schema = T.StructType([*panel.schema.fields, *[T.StructField(n, T.DoubleType()) for n in names]])
    reached = with_neighbours(panel, back_seconds=reach, block_days=block_days)
    dealt = reached.repartition(SERIES, BLOCK).sortWithinPartitions(SERIES, BLOCK, TIME)
    return dealt.mapInArrow(_roll(list(S.HISTORY_SIGNALS), S.ROLLING_HOURS, statistics), schema)


def add_leads(panel: DataFrame, block_days: int = BLOCK_DAYS) -> DataFrame:
    return over_series(panel, lead_columns(), ahead_rows=max(S.LEAD_HOURS), block_days=block_days)


def feature_table(panel: DataFrame, lag_mode: str = "row", block_days: int = BLOCK_DAYS) -> DataFrame:
    """Panel, lags, rolling statistics, mismatch and lead targets: one shuffle, one sort, one window.

    Columns of these names that the panel already has are computed anew.
    """
    by_row = lag_mode == "row"
    panel = panel.drop(*S.LAG_COLUMNS, *S.ROLLING_COLUMNS, *S.LEAD_COLUMNS, *S.MISMATCH_COLUMNS)
    windowed = over_series(
        panel,
        [*([history_column()] if by_row else time_history_columns()), *rolling_columns(), *lead_columns()],
        back_rows=max(S.LAG_HOURS) if by_row else 0,
        ahead_rows=max(S.LEAD_HOURS),
        back_seconds=(max(S.ROLLING_HOURS.values()) - 1) * HOUR,
        block_days=block_days,
    )
    lags = lag_columns() if by_row else time_lag_columns()
    return add_labels(windowed.selectExpr(*panel.columns, *lags, *S.ROLLING_COLUMNS, *S.LEAD_COLUMNS)).select(
        *panel.columns, *S.LAG_COLUMNS, *S.ROLLING_COLUMNS, *S.MISMATCH_COLUMNS, *S.LEAD_COLUMNS
    )


def sequences(
    panel: DataFrame,
    signals: Iterable[str] = S.SEQUENCE_SIGNALS,
    length: int = S.SEQUENCE_HOURS,
    contiguous: bool = False,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """``(ba, ts_unix, sequence)``: the last ``length`` rows of a series as one flat array.

    Hour by hour, oldest first, the signals of an hour next to each other; rows with fewer
    predecessors have no sequence.  ``contiguous`` drops sequences that step over a gap.  Every
    row appears in ``length`` arrays: reduce them in the same stage and do not store them.
    """
    signals = list(signals)
    reached = with_neighbours(panel.select(SERIES, TIME, *signals), back_rows=length - 1, block_days=block_days)
    recent = _over(f"ROWS BETWEEN {length - 1} PRECEDING AND CURRENT ROW")
    built = reached.selectExpr(
        SERIES,
        TIME,
        HOME,
        f"collect_list(array({', '.join(signals)})) {recent} AS steps",
        f"{TIME} - min({TIME}) {recent} AS span",
    ).where(F.col(HOME) & (F.size("steps") == length))
    if contiguous:
        built = built.where(F.col("span") == (length - 1) * HOUR)
    return built.select(SERIES, TIME, F.flatten("steps").alias("sequence"))


def hourly_grid(panel: DataFrame) -> DataFrame:
    """Every full hour from the first to the last of each series, with nulls where the panel has no row.

    Rows off the hour, or without a series or time, stay as they are, between the hours.  Days are listed first and
    hours within them second, so no single array spans a long history.
    """
    day_seconds = 24 * HOUR
    hours = (
        panel.groupBy(SERIES)
        .agg(F.expr(f"CAST(ceil(min({TIME}) / {HOUR}) * {HOUR} AS BIGINT)").alias("first"), F.max(TIME).cast("long").alias("last"))
        .where("first <= last")
        .select("*", F.explode(F.sequence(F.col("first"), F.col("last"), F.lit(day_seconds).cast("long"))).alias("start"))
        .select(
            SERIES,
            F.explode(
                F.sequence(
                    F.col("start"),
                    F.least(F.col("last"), F.col("start") + (day_seconds - HOUR)),
                    F.lit(HOUR).cast("long"),
                )
            ).alias(TIME),
        )
    )
    return hours.join(panel, [SERIES, TIME], "full")
