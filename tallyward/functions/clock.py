"""Time: parsing and calendar parts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# One- or two-digit parts are fine, fractions and offsets are not.
_STRICT = r"^\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{1,2}:\d{1,2}Z$"


_OFFSET = r"([+-])(\d{2}):?(\d{2})$"


def _behind_utc(text: Column) -> Column:
    """Minutes that an offset such as ``+02:00`` is ahead of UTC; 0 without one."""
    minutes = F.regexp_extract(text, _OFFSET, 2).try_cast("int") * 60 + F.regexp_extract(text, _OFFSET, 3).try_cast("int")
    return F.coalesce(F.when(text.rlike("T.*" + _OFFSET), F.when(F.regexp_extract(text, _OFFSET, 1) == "-", -minutes).otherwise(minutes)), F.lit(0))


def parse(text: Column) -> Column:
    """ISO text to UTC wall-clock time; a bad text fails the job (batch meaning).

    The zone-less type keeps ``hour`` and friends free of the session zone; an offset in the text is applied.
    """
    local = F.to_timestamp_ntz(F.regexp_replace(text, "(?<=T.{0,20})" + _OFFSET, ""))
    return local - F.make_dt_interval(mins=_behind_utc(text))


def parse_or_null(text: Column) -> Column:
    """As ``parse``, but a bad text is null."""
    local = F.regexp_replace(text, "(?<=T.{0,20})" + _OFFSET, "").try_cast("timestamp_ntz")
    return local - F.make_dt_interval(mins=_behind_utc(text))


def parse_strict(text: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ`` to time, anything else to null (stream meaning)."""
    return F.when(text.rlike(_STRICT), text.try_cast("timestamp_ntz"))


def to_text(ts: Column) -> Column:
    """``yyyy-MM-ddTHH:mm:ssZ``; by way of the zone-less text, which has no clock change in it."""
    text = ts.cast("timestamp_ntz").cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("Z"))


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def day_of_week(ts: Column) -> Column:
    """Monday is 0."""
    return F.weekday(ts)


def is_weekend(ts: Column) -> Column:
    return (F.weekday(ts) >= 5).cast("int")


def is_night(ts: Column) -> Column:
    hour = F.hour(ts)
    return ((hour < 6) | (hour >= 22)).cast("int")


def calendar(ts: Column) -> dict[str, Column]:
    """The six calendar features of one time column."""
    return {
        "hour_of_day": hour_of_day(ts),
        "day_of_week": day_of_week(ts),
        "month": F.month(ts),
        "day_of_month": F.dayofmonth(ts),
        "is_weekend": is_weekend(ts),
        "is_night": is_night(ts),
    }


# fixed values: what an unreadable time gives on the stream
_UNREADABLE = {
    "hour_of_day": 0, "day_of_week": 0, "month": 1, "day_of_month": 1, "is_weekend": 0, "is_night": 0,
}


def calendar_or_default(ts: Column) -> dict[str, Column]:
    return {name: F.coalesce(part, F.lit(_UNREADABLE[name])) for name, part in calendar(ts).items()}


def epoch_now(now: Column | None = None) -> Column:
    """Seconds since the epoch; give ``now`` to make a run repeatable."""
    return F.unix_seconds(F.current_timestamp() if now is None else now)


def iso_now(now: Column | None = None) -> Column:
    """UTC wall-clock text, whatever zone the session is in."""
    since = F.make_dt_interval(secs=epoch_now(now))
    text = (F.lit("1970-01-01").cast("timestamp_ntz") + since).cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))


def epoch(ts: Column) -> Column:
    """Epoch seconds of a zone-less UTC time."""
    days = F.unix_date(ts.cast("date")).cast("long")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def utc_date(seconds: Column) -> Column:
    """Epoch seconds to the UTC date as text."""
    return F.date_from_unix_date(F.floor(seconds / 86400).cast("int")).cast("string")
