"""Time functions (D1-D4, D11). The session clock is UTC (see ``session``)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellscope.functions._util import as_col


def epoch_to_timestamp(c: str | Column) -> Column:
    """Epoch seconds to a timestamp."""
    return F.timestamp_seconds(as_col(c))


def hour_of_day(ts: str | Column) -> Column:
    """Hour of day as int."""
    return F.hour(as_col(ts))


def hour_text(ts: str | Column) -> Column:
    """Hour of day as zero-padded ``HH`` text."""
    return F.date_format(as_col(ts), "HH")


def weekday_short(ts: str | Column) -> Column:
    """D3: short weekday name (``Tue``)."""
    return F.date_format(as_col(ts), "E")


def weekday_long(ts: str | Column) -> Column:
    """D3: long weekday name (``Tuesday``)."""
    return F.date_format(as_col(ts), "EEEE")


def calendar_date(ts: str | Column) -> Column:
    """Calendar date."""
    return F.to_date(as_col(ts))


def engineer_time_features(df: DataFrame, epoch_col: str = "timestamp", long_weekday: bool = False,
                           with_date: bool = False) -> DataFrame:
    """Add ``datetime``, ``hour_of_day``, ``day_of_week`` (and ``date``).

    ``epoch_col`` holds epoch seconds, or is already a timestamp column (then
    it is used as is). ``long_weekday`` gives ``Tuesday`` instead of ``Tue``,
    as the local notebook does; ``with_date`` adds the calendar date.
    """
    is_ts = isinstance(df.schema[epoch_col].dataType, (T.TimestampType, T.TimestampNTZType))
    ts = F.col(epoch_col) if is_ts else epoch_to_timestamp(epoch_col)
    cols = {
        "datetime": ts,
        "hour_of_day": hour_of_day(ts),
        "day_of_week": weekday_long(ts) if long_weekday else weekday_short(ts),
    }
    if with_date:
        cols["date"] = calendar_date(ts)
    return df.withColumns(cols)
