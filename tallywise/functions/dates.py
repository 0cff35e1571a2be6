"""Timestamps and zero-padded date parts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallywise.functions.text import col_

__all__ = ["parse_offset_ts", "iso_utc", "date_parts", "drop_offsets", "lookback"]


def parse_offset_ts(c, fmt: str = "yyyy-MM-dd HH:mm:ss xx") -> Column:
    """Text with a numeric offset, ISO text of the API, or text without offset
    (which is UTC) to an instant; bad text gives null. One parse a row: the text's form tells which."""
    c = col_(c)
    plain = F.concat(F.replace(c, F.lit("T"), F.lit(" ")), F.lit(" +0000"))
    return (F.when(F.length(c) == 19, F.try_to_timestamp(plain, F.lit("yyyy-MM-dd HH:mm:ss xx")))
            .when(F.substring(c, 11, 1) != "T", F.try_to_timestamp(c, F.lit(fmt)))
            .when(F.substring(c, -3, 1) == ":", F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))
            .when(c.endswith("Z"), F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")))
            .otherwise(F.try_to_timestamp(c, F.lit("yyyy-MM-dd'T'HH:mm:ssxx"))))


def utc_wall(ts) -> Column:
    """The instant's UTC date and time, without a zone (no gap or overlap of the session's zone touches it)."""
    seconds = (F.unix_micros(col_(ts)).cast("decimal(20,0)") / F.lit(1_000_000)).cast("decimal(18,6)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)


def iso_utc(ts) -> Column:
    """Instant printed as UTC ``yyyy-MM-ddTHH:mm:ss+0000`` whatever the session zone."""
    wall = F.substring(utc_wall(ts).cast("string"), 1, 19)
    return F.concat(F.replace(wall, F.lit(" "), F.lit("T")), F.lit("+0000"))


def date_parts(ts, null_year: str = "0", prefix: str = "", suffix: str = "paid") -> list[Column]:
    """Day, month (two digits) and year of an instant in UTC; null gives
    ``00``, ``00`` and ``null_year``."""
    wall = utc_wall(ts)
    text = wall.cast("string")
    return [
        F.coalesce(F.substring(text, 9, 2), F.lit("00")).alias(f"{prefix}day_{suffix}"),
        F.coalesce(F.substring(text, 6, 2), F.lit("00")).alias(f"{prefix}month_{suffix}"),
        F.coalesce(F.year(wall.cast("date")).cast("string"), F.lit(null_year)).alias(f"{prefix}year_{suffix}"),
    ]


def drop_offsets(c, offsets) -> Column:
    """Remove offset texts without shifting the time."""
    out = col_(c)
    for o in offsets:
        out = F.replace(out, F.lit(o), F.lit(""))
    return out


def lookback_start(as_of: str, days: int, zone: str | None = None) -> Column:
    """``as_of - days``; ``as_of`` is read in ``zone`` (default: the session's)."""
    return F.lit(f"{as_of} {zone}" if zone else as_of).cast("timestamp") - F.make_dt_interval(days=F.lit(int(days)))


def lookback(ts, as_of: str, days: int | None, zone: str | None = None) -> Column:
    """Predicate ``ts >= as_of - days``; ``days=None`` keeps everything."""
    if days is None:
        return F.lit(True)
    return col_(ts) >= lookback_start(as_of, days, zone)
