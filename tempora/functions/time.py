"""Timestamps of subtitles as expressions on integer microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def srt_time(us: Column) -> Column:
    """HH:MM:SS,mmm; negative times are 0, halves of a millisecond round up."""
    ms = F.floor((F.greatest(us, F.lit(0)) + 500) / 1000)
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3_600_000), F.floor(ms / 60_000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def ass_time(us: Column) -> Column:
    """H:MM:SS.cc."""
    cs = F.floor((F.greatest(us, F.lit(0)) + 5000) / 10_000)
    return F.format_string("%d:%02d:%02d.%02d", F.floor(cs / 360_000), F.floor(cs / 6000) % 60, F.floor(cs / 100) % 60, cs % 100)


def from_srt_time(text: Column) -> Column:
    """Microseconds of HH:MM:SS,mmm or HH:MM:SS.mmm; null if it is neither."""
    parts = [F.try_to_number(F.regexp_extract(text, r"^(\d{1,3}):(\d{2}):(\d{2})[,.](\d{3})$", i), F.lit("999")) for i in (1, 2, 3, 4)]
    h, m, s, ms = (p.cast("long") for p in parts)
    return ((h * 3600 + m * 60 + s) * 1000 + ms) * 1000


def retry_after(value: Column, now: Column) -> Column:
    """Whole seconds to wait: a number, or an HTTP date; at least 0, null if neither."""
    seconds = F.ceil(value.try_cast("double"))
    date = F.try_to_timestamp(F.regexp_extract(value, r"^\w{3}, (\d{2} \w{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    wait = F.ceil((F.unix_micros(date) - F.unix_micros(now)) / 1_000_000)
    return F.greatest(F.coalesce(seconds, wait), F.lit(0)).cast("long")
