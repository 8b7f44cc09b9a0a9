"""Timestamps, life spans and their bins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds in seconds of the resolution-time bins; the last bin is open.
RESOLUTION_BINS = {"minutes": 3_600, "hours": 86_400, "days": 604_800, "weeks": 2_592_000}
RESOLUTION_LABELS = (*RESOLUTION_BINS, "months")

_DATE = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"[T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?"
_ZONE = r"(Z|[+-]\d{2}:\d{2})"


def utc_timestamp(text: Column, strict: bool = True) -> Column:
    """Timestamp of an ISO-like string; a string without zone is UTC.

    Accepts ``Z``, numeric offsets, fractions, a blank instead of ``T`` and bare
    dates, whatever the session time zone is. Null stays null. Anything else
    fails the job when ``strict`` and is null otherwise.
    """
    value = text.cast("string")
    zoned = (
        F.when(value.rlike(rf"^{_DATE}{_CLOCK}{_ZONE}\z"), value)
        .when(value.rlike(rf"^{_DATE}{_CLOCK}\z"), F.concat(value, F.lit("Z")))
        .when(value.rlike(rf"^{_DATE}\z"), F.concat(value, F.lit("T00:00:00Z")))
    )
    parsed = zoned.try_cast("timestamp")
    if not strict:
        return parsed
    complaint = F.raise_error(F.concat(F.lit("Unrecognized timestamp: "), value)).cast("timestamp")
    return F.when(value.isNotNull() & parsed.isNull(), complaint).otherwise(parsed)


def life_span_seconds(created: Column, closed: Column) -> Column:
    micros = F.unix_micros(closed.cast("timestamp")) - F.unix_micros(created.cast("timestamp"))
    return micros / F.lit(1e6)


def resolution_bin(seconds: Column) -> Column:
    label = None
    for name, bound in RESOLUTION_BINS.items():
        test = seconds < bound
        label = F.when(test, name) if label is None else label.when(test, name)
    return label.when(seconds.isNotNull(), RESOLUTION_LABELS[-1])
