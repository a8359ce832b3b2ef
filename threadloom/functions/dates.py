"""Forum dates: absolute, relative ("n days ago") and ISO text to UTC instants."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.text import strip

# The shapes of dates that forums show, and the units of "n ... ago".
# Full calendar ISO 8601; a bare cast would also take "10:30" or "2024" for a date.
_ISO = r"^\d{4}-\d\d-\d\d(?:[T ]\d\d:\d\d(?::\d\d(?:\.\d{1,6})?)?(?:Z|[+-]\d\d:?\d\d)?)?$"
_OFFSET = r":\d\d(?:\.\d+)?(?:Z|[+-]\d\d:?\d\d)$"
_ISO_OFFSET = r"^\d{4}-\d\d?-\d\d?T\d\d?:\d\d?:\d\d?(?:Z|[+-]\d\d:?\d\d)$"
_UTC_TEXT = r"^\d{4}-\d\d?-\d\d? \d\d?:\d\d?:\d\d? UTC$"
_SLASH = r"^\d{4}/\d{2}/\d{2} \d{2}:\d{2}:\d{2}$"

# Days, hours and minutes ago, with the largest count that stays inside the calendar.
_AGO = (("天前", "days", 700_000), ("小时前", "hours", 16_800_000), ("分钟前", "mins", 1_000_000_000))


def instant(as_of: datetime | str | Column) -> Column:
    """'Now': one for a whole job, as a UTC timestamp literal, or a timestamp column of each row."""
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, datetime):
        moment = as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc)
        as_of = moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast("timestamp")


def forum_date_ts(c: Column, as_of: Column, zone: str = "Asia/Shanghai") -> Column:
    """Instant of ``YYYY/MM/DD HH:MM:SS`` in ``zone`` or of "n days/hours/minutes ago"; else null."""
    raw = strip(c)
    # ``as_of`` may differ from row to row.
    absolute = F.when(
        raw.rlike(_SLASH),
        F.to_utc_timestamp(F.try_to_timestamp(raw, F.lit("yyyy/MM/dd HH:mm:ss")), zone),
    )
    relative = []
    for unit, part, most in _AGO:
        n = F.regexp_extract(raw, rf"^(\d+){unit}", 1).try_cast("int")
        relative.append(F.when(n <= most, as_of - F.make_dt_interval(**{part: n})))
    return F.coalesce(absolute, *relative)


def forum_date_text(c: Column, ts: Column, zone: str = "Asia/Shanghai", offset: str = "+0800") -> Column:
    """ISO text in the forum's zone; text that is no date comes back stripped, empty gives null."""
    local = F.date_format(F.from_utc_timestamp(ts, zone), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(c != "", F.coalesce(F.concat(local, F.lit(offset)), strip(c)))


def offset_date_ts(c: Column) -> Column:
    """Instant of ``YYYY-MM-DDTHH:MM:SS`` text that carries an offset; else null."""
    return F.when(c.rlike(_ISO_OFFSET), c.try_cast("timestamp"))


def iso_date_ts(c: Column, zone: str = "UTC") -> Column:
    """Instant of ISO text (read in ``zone`` without an offset) or of ``… UTC`` text; else null."""
    parsed = c.try_cast("timestamp")
    return (
        F.when(c.rlike(_UTC_TEXT), F.try_to_timestamp(c, F.lit("yyyy-M-d H:m:s 'UTC'")))
        .when(c.rlike(_ISO) & c.rlike(_OFFSET), parsed)
        .when(c.rlike(_ISO), F.to_utc_timestamp(parsed, zone))
    )


def utc_text(c: Column, ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS UTC``; text without an instant, or already so written, is unchanged."""
    return F.when(c.rlike(_UTC_TEXT), c).otherwise(
        F.coalesce(F.date_format(ts, "yyyy-MM-dd HH:mm:ss 'UTC'"), c)
    )
