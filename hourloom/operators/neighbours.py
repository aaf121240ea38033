"""Windows over one long series without putting the series into one task.

A window partitioned by series alone gives each series to one task, however long it is.  Here
a series is cut into blocks of whole days, and every block also receives copies of the
rows next to it that its windows can reach.  Each row then sees the same neighbours as
in a window over the whole series, and a block holds a bounded stretch of time.

Which neighbours are needed:

* a range frame (``back_seconds``) needs the rows of a fixed time before the block;
* a row offset (``back_rows``, ``ahead_rows``) needs a fixed number of rows, which after a gap
  may lie any distance away.

Copies of the days next to a block follow from the date alone.  Where gaps leave these days
with too few rows, the rows per series and day (a small table) tell exactly which further
days the block needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.session import durable

SERIES = "ba"
TIME = "ts_unix"
BLOCK = "__block"
HOME = "__home"
_DAY = "__day"
_SECONDS_PER_DAY = 86_400

#: 4,320 hourly rows, and a twentieth more in copies.
BLOCK_DAYS = 180


def _day(time: Column) -> Column:
    return F.floor(time / _SECONDS_PER_DAY)


def _block_of(day: Column, block_days: int) -> Column:
    return F.floor(day / block_days)


def distant_days(
    panel: DataFrame, back_rows: int, ahead_rows: int, back_days: int, ahead_days: int, block_days: int
) -> DataFrame:
    """``(ba, day, block)`` for days a block needs although they lie outside its margin.

    Row numbers of the first and last row of each day follow from running counts.  A window over
    one series here runs over days, not rows, so the calendar bounds it.
    """
    by_day = Window.partitionBy(SERIES).orderBy(_DAY)
    days = (
        panel.groupBy(SERIES, _day(F.col(TIME)).alias(_DAY))
        .agg(F.count("*").alias("n"))
        .withColumn("last", F.sum("n").over(by_day))
        .withColumn("first", F.col("last") - F.col("n"))
        .withColumn(BLOCK, _block_of(F.col(_DAY), block_days))
    )
    # Every block that exists has a row, so the next `back_rows` blocks are all that a row can reach.
    by_block = Window.partitionBy(SERIES).orderBy(BLOCK)
    start, end = F.struct(BLOCK, F.col("start").alias("edge")), F.struct(BLOCK, F.col("end").alias("edge"))
    blocks = (
        days.groupBy(SERIES, BLOCK)
        .agg(F.min("first").alias("start"), F.max("last").alias("end"))
        .select(
            SERIES,
            BLOCK,
            F.lead("start").over(by_block).alias("next_start"),
            F.lag("end").over(by_block).alias("previous_end"),
            F.collect_list(start).over(by_block.rowsBetween(1, max(back_rows, 1))).alias("later"),
            F.collect_list(end).over(by_block.rowsBetween(-max(ahead_rows, 1), -1)).alias("earlier"),
        )
    )
    day, first, last = F.col(_DAY), F.col("first"), F.col("last")
    needed = F.concat(
        F.filter(
            "later",
            lambda b: (last > b["edge"] - back_rows) & (b[BLOCK] > _block_of(day + back_days, block_days)),
        ),
        F.filter(
            "earlier",
            lambda b: (first < b["edge"] + ahead_rows) & (b[BLOCK] < _block_of(day - ahead_days, block_days)),
        ),
    )
    near_border = (last > F.col("next_start") - back_rows) | (first < F.col("previous_end") + ahead_rows)
    return (
        days.join(blocks, [SERIES, BLOCK])
        .where(near_border)
        .select(SERIES, _DAY, F.explode(F.transform(needed, lambda b: b[BLOCK])).alias(BLOCK))
    )


def with_neighbours(
    panel: DataFrame, back_rows: int = 0, ahead_rows: int = 0, back_seconds: int = 0, block_days: int = BLOCK_DAYS
) -> DataFrame:
    """Rows of ``panel`` and the copies their windows need, with ``__block`` and ``__home``.

    ``__home`` is false for copies.  Rows must be unique per ``(ba, ts_unix)``, as they are after
    deduplication.  With row offsets a job over two columns first lists the days that need
    distant rows; on a panel without long gaps the list is empty and nothing is joined.
    """
    back_days = -(-max(back_seconds, 2 * back_rows * 3600) // _SECONDS_PER_DAY)
    ahead_days = -(-2 * ahead_rows * 3600 // _SECONDS_PER_DAY)
    dated = panel.withColumn(_DAY, _day(F.col(TIME)))
    day = F.col(_DAY)
    targets = F.sequence(_block_of(day - ahead_days, block_days), _block_of(day + back_days, block_days))
    # a row without a time has no neighbours: it gets a block of its own, below all blocks of time
    alone = F.array(-F.pmod(F.xxhash64(*panel.columns), F.lit(1 << 62)) - (1 << 40))
    dealt = dated.select(*panel.columns, day, F.explode(F.coalesce(targets, alone)).alias(BLOCK))
    if back_rows or ahead_rows:
        further = durable(distant_days(panel, back_rows, ahead_rows, back_days, ahead_days, block_days))
        if not further.isEmpty():
            dealt = dealt.unionByName(dated.join(further, [SERIES, _DAY]).select(dealt.columns))
    return dealt.select(*panel.columns, BLOCK, F.coalesce(F.col(BLOCK) == _block_of(day, block_days), F.lit(True)).alias(HOME))


#: The window of one block, for SQL expressions; a frame may follow it.
IN_BLOCK = f"PARTITION BY {SERIES}, {BLOCK} ORDER BY {TIME}"


def over_series(
    panel: DataFrame,
    columns: list[str],
    back_rows: int = 0,
    ahead_rows: int = 0,
    back_seconds: int = 0,
    block_days: int = BLOCK_DAYS,
) -> DataFrame:
    """``panel`` plus window ``columns``, SQL texts over :data:`IN_BLOCK`; one row per input row.

    Texts, since a table of 170 window columns takes seconds to build call by call.
    """
    reached = with_neighbours(panel, back_rows, ahead_rows, back_seconds, block_days)
    return reached.selectExpr("*", *columns).where(HOME).drop(BLOCK, HOME)
