"""Dates as bits: which days a meter was occupied, for any range of dates.

A row has the dates of 64 neighbouring days as one number, for a meter and an
hour. Tables of different arrivals are merged by ``or``, a range of dates and a
weekday are a mask, and days are counted as bits, so no session is read again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbside.functions.timeparse import check_hour, weekday_name
from curbside.schemas import CLOSE_HOUR, OPEN_HOUR, WEEKDAYS

_KEYS = ("POST_ID", "hour", "block")
_DAYS = 64
# Stands for any time of the day: the dates on which a meter has a session at all.
ANY_HOUR = -1


def date_bits(
    occupied: DataFrame, open_hour: int = OPEN_HOUR, close_hour: int = CLOSE_HOUR
) -> DataFrame:
    """``(POST_ID, hour, block, bits)`` of an ``occupancy`` table.

    ``block`` numbers the 64 days from 1 January 1970 on, and the lowest bit is
    the first of them. ``hour`` is ``ANY_HOUR`` for all dates with a session.
    Dates that are none are left out; a NULL meter is one of its own.
    """
    day = F.unix_date(F.col("EventDate").try_cast("date"))
    hours = F.filter(
        F.sequence(F.lit(open_hour), F.lit(close_hour)),
        lambda h: F.col("hours").bitwiseAND(F.call_function("shiftleft", F.lit(1), h)) != 0,
    )
    every = F.concat(F.array(F.lit(ANY_HOUR)), hours)
    seen = occupied.select("POST_ID", day.alias("day"), F.explode(every).alias("hour"))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("day", F.lit(_DAYS)))
    return (
        seen.where("day IS NOT NULL")
        .groupBy("POST_ID", "hour", F.floor(F.col("day") / _DAYS).cast("int").alias("block"))
        .agg(F.bit_or(bit).alias("bits"))
    )


def merge_date_bits(parts: DataFrame) -> DataFrame:
    """The rows of several such tables as one; the same dates again change nothing."""
    return parts.groupBy(*_KEYS).agg(F.bit_or("bits").alias("bits"))


def _weekday_mask(day: str) -> Column:
    """The bits of a weekday in each block; blocks begin a day of the week later each."""
    wanted = WEEKDAYS.index(weekday_name(day))
    masks = []
    for start in range(7):
        bits = sum(1 << i for i in range(_DAYS) if (start + i) % 7 == wanted)
        masks.append(F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long"))
    # 1 January 1970 was a Thursday.
    begins = F.pmod(F.col("block").cast("long") * _DAYS + 3, F.lit(7)).cast("int")
    return F.get(F.array(*masks), begins)


def _range_mask(first: date, last: date) -> Column:
    """The bits of a block from one day to another, both included."""
    epoch = date(1970, 1, 1).toordinal()
    begin = F.col("block").cast("long") * _DAYS
    low = F.lit(first.toordinal() - epoch) - begin
    high = F.lit(last.toordinal() - epoch) - begin
    ones = F.lit(-1).cast("long")

    def shifted(name: str, by: Column) -> Column:
        return F.call_function(name, ones, F.least(F.greatest(by, F.lit(0)), F.lit(63)).cast("int"))

    inside = shifted("shiftleft", low).bitwiseAND(shifted("shiftrightunsigned", 63 - high))
    return F.when((low < _DAYS) & (high >= 0), inside).otherwise(F.lit(0).cast("long"))


def _cut(
    bits: DataFrame, hour: int, first: str, last: str, day: str | None
) -> DataFrame:
    """Rows of an hour with the bits of the dates asked for."""
    mask = _range_mask(date.fromisoformat(first), date.fromisoformat(last))
    if day is not None:
        mask = mask.bitwiseAND(_weekday_mask(day))
    blocks = [date.fromisoformat(d).toordinal() - date(1970, 1, 1).toordinal() for d in (first, last)]
    near = F.col("block").between(blocks[0] // _DAYS, blocks[1] // _DAYS)
    cut = bits.where((F.col("hour") == hour) & near)
    return cut.select("POST_ID", "block", F.col("bits").bitwiseAND(mask).alias("bits")).where("bits <> 0")


def occupied_days_between(
    bits: DataFrame, hour: int, first: str, last: str, day: str | None = None
) -> DataFrame:
    """``(POST_ID, n_days)``: days occupied in the hour, from ``first`` to ``last``.

    As ``occupied_days`` gives for the sessions of those dates that
    ``occupied_in_hour`` keeps, with ``day`` of one weekday. ``bits`` is a merged
    table of :func:`date_bits`; dates are ``yyyy-MM-dd`` and included.
    """
    check_hour(hour)
    days = _cut(bits, hour, first, last, day).where("POST_ID IS NOT NULL")
    return days.groupBy("POST_ID").agg(F.sum(F.bit_count("bits")).alias("n_days"))


def observed_days_between(
    bits: DataFrame, first: str, last: str, day: str | None = None
) -> DataFrame:
    """``(n_days)``: dates with any session, from ``first`` to ``last``."""
    seen = _cut(bits, ANY_HOUR, first, last, day)
    blocks = seen.groupBy("block").agg(F.bit_or("bits").alias("bits"))
    return blocks.agg(F.coalesce(F.sum(F.bit_count("bits")), F.lit(0)).cast("long").alias("n_days"))
