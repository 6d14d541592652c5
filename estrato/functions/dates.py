"""Date and time rules.  Wall-clock values are TIMESTAMP_NTZ, so no session time
zone takes part; a time of day is text ``HH:mm:ss``."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from estrato.functions.text import strip

TIME_ZONE = "America/Sao_Paulo"

_DAY_FIRST = r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})"
_SHORT_YEAR = r"^(\d{1,2}[/.-]\d{1,2}[/.-])(\d{2})(?!\d)"
_SHORT = r"^(\d{1,2})[/.-](\d{1,2})[/.-]"
#: Two-digit years from here on are of the last century.
LAST_CENTURY = 75
_WALL_CLOCK = r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?)?$"
_ISO_DATE = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}.*)?)?$"
_BR_DATE = r"^\d{1,2}/\d{1,2}/\d{4}$"
_CLOCK = r"^\d{1,2}:\d{1,2}(:\d{1,2}(\.\d{1,6})?)?$"


def _year_first(c: Column) -> Column:
    return F.regexp_replace(c, _DAY_FIRST, "$3-$2-$1")


def _wall_clock(c: Column) -> Column:
    """A wall-clock timestamp, NULL where the text isn't one; the text is looked at once."""
    return F.regexp_extract(c, _WALL_CLOCK, 0).try_cast("timestamp_ntz")


def _full_year(c: Column) -> Column:
    """A day-first date with its year in four digits."""
    short = F.regexp_extract(c, _SHORT_YEAR, 2)
    century = F.when(short >= f"{LAST_CENTURY}", "19").otherwise("20")
    return F.when(short != "", F.regexp_replace(c, F.lit(_SHORT_YEAR), F.concat(F.lit("$1"), century, F.lit("$2")))).otherwise(c)


def day_first_timestamp(c: Column) -> Column:
    """``31/12/2025 10:20[:30]``, with a year of two digits too, or ISO as a wall-clock
    timestamp, NULL if neither."""
    s = strip(c)
    tens, ones = divmod(LAST_CENTURY, 10)
    last = rf"([{tens + 1}-9]\d|{tens}[{ones}-9])(?!\d)"
    late = F.regexp_replace(s, _SHORT + last, "19$3-$2-$1")
    # each text goes once through each pattern; most are read by the first two
    return F.coalesce(_wall_clock(_year_first(s)), _wall_clock(F.regexp_replace(late, _SHORT + r"(\d{2})(?!\d)", "20$3-$2-$1")))


def day_first_date(c: Column) -> Column:
    return day_first_timestamp(c).cast("date")


def _by_day(c: Column) -> Column:
    s = _full_year(strip(c))
    return F.when(s.rlike(_DAY_FIRST), day_first_timestamp(c)).cast("date")


def _by_month(c: Column) -> Column:
    s = F.regexp_replace(_full_year(strip(c)), _DAY_FIRST, "$3-$1-$2")
    return F.when(strip(c).rlike(r"^\d{1,2}[/.-]") & s.rlike(_WALL_CLOCK), s.try_cast("timestamp_ntz")).cast("date")


def _by_year(c: Column) -> Column:
    s = strip(c)
    return F.when(s.rlike(_WALL_CLOCK), s.try_cast("timestamp_ntz")).cast("date")


#: Formats that a column of dates may have, in the order in which equals are preferred: what
#: each reads, NULL for a text that it doesn't.
DATE_FORMATS = {"day first": _by_day, "month first": _by_month, "year first": _by_year}


def time_of(ts: Column) -> Column:
    """Time of day of a wall-clock timestamp, as text."""
    return F.substring(ts.cast("string"), 12, 8)


def time_of_day(c: Column) -> Column:
    """Time-only text (``9:05``, ``10:20:30``) as ``HH:mm:ss``; a full timestamp is
    accepted too, anything else is NULL."""
    s = strip(c)
    full = F.when(s.rlike(_CLOCK), F.concat(F.lit("1970-01-01 "), s)).otherwise(_year_first(s))
    return time_of(F.when(full.rlike(_WALL_CLOCK), full.try_cast("timestamp_ntz")))


def iso_or_br_date(c: Column) -> Column:
    """ISO date (a time part is ignored), else ``dd/MM/yyyy``, else NULL."""
    s = F.regexp_replace(strip(c), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    iso = F.when(s.rlike(_ISO_DATE), F.substring(s, 1, 10).try_cast("date"))
    br = F.when(s.rlike(_BR_DATE), _year_first(s).try_cast("date"))
    return F.coalesce(iso, br)


def scraped_at(day: Column, clock: Column, run_ts: datetime, tz: str = TIME_ZONE) -> Column:
    """Instant of a scrape from its date and time texts, read in ``tz``.

    A missing time is midnight; a missing or unreadable date or time is the run time.
    """
    d = strip(day)
    t = F.when(clock.isNull() | (clock == ""), F.lit("00:00:00")).otherwise(strip(clock))
    iso = d.rlike(r"^\d{4}-\d{2}-\d{2}$") & t.rlike(r"^\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?$")
    br = d.rlike(_BR_DATE) & t.rlike(r"^\d{1,2}:\d{1,2}:\d{1,2}$")
    stamp = F.concat_ws(" ", _year_first(d), t, F.lit(tz))
    return F.coalesce(F.when(iso | br, stamp.try_cast("timestamp")), F.lit(run_ts))


def snapshot_until_yesterday(run_date: date, start: date = date(2025, 1, 1)) -> tuple[date, date]:
    return start, run_date - timedelta(days=1)


def today_only(run_date: date) -> tuple[date, date]:
    return run_date, run_date


def last_days(run_date: date, days: int = 4 * 365) -> tuple[date, date]:
    return run_date - timedelta(days=days), run_date


def look_back(run_ts: datetime, hours: int = 48) -> datetime:
    return run_ts - timedelta(hours=hours)
