"""Times: relative phrases, business hours, textual forms."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bound

STAMP = "yyyy-MM-dd HH:mm"
#: Words for days, periods and hours.
DAYS = {"今天": 0, "明天": 1, "后天": 2, "today": 0, "tomorrow": 1, "day after tomorrow": 2}
HOURS = {"十二": 12, "十一": 11, "十": 10, "九": 9, "八": 8, "七": 7, "六": 6, "五": 5, "四": 4, "三": 3, "两": 2, "二": 2, "一": 1}
LATE, NOON, EARLY = r"下午|晚上|pm|afternoon|evening", r"中午|noon", r"上午|am|morning"
DAY_PATTERN = r"(后天|明天|今天|day after tomorrow|tomorrow|today)"
CLOCK_PATTERN = r"(?:([0-9]{1,2})|(十一|十二|十|[一二两三四五六七八九]))(?:点|:)(?:([0-9]{1,2})分?)?"


def read_stamp(text: Column) -> Column:
    """A time without zone; impossible dates give null."""
    return F.try_to_timestamp(text, F.lit(STAMP)).cast("timestamp_ntz")


def _lookup(word: Column, table: dict[str, int]) -> Column:
    out = F.lit(None).cast("int")
    for k, v in table.items():
        out = F.when(word == k, v).otherwise(out)
    return out


def resolve_relative(text: Column, stated: Column, now: Column) -> Column:
    """The time that "tomorrow afternoon 3:30" names; the stated time where the text names none.

    The last period between the day and the clock decides; hours over 23 or
    minutes over 59 keep the stated time.
    """
    # one pass: day, what lies between, digits, written hour and minutes, with a mark between them
    pattern = r"^[\s\S]*?" + DAY_PATTERN + r"([\s\S]*?)" + CLOCK_PATTERN + r"[\s\S]*$"
    marked = F.regexp_replace(text, pattern, MARK.join(f"${k}" for k in range(1, 6)))
    return bound(F.split(marked, MARK), lambda parts: _resolved(parts, stated, now))


MARK = "\x01"


def _resolved(parts: Column, stated: Column, now: Column) -> Column:
    """The time of the parts of a match; the stated one where there is none."""
    day, before, digits, written, minutes = (F.get(parts, F.lit(k)) for k in range(5))
    found = (F.size(parts) == 5) & day.isin(*DAYS)
    period = F.try_element_at(F.regexp_extract_all(before, F.lit(f"({LATE}|{NOON}|{EARLY})"), 1), F.lit(-1))
    hour = F.when(digits != "", digits.try_cast("int")).otherwise(_lookup(written, HOURS))
    minute = F.when(minutes != "", minutes.try_cast("int")).otherwise(0)
    shifted = (
        F.when(period.rlike(LATE) & (hour < 12), hour + 12).when(period.rlike(NOON) & (hour < 11), hour + 12).when(period.rlike(EARLY) & (hour == 12), 0).otherwise(hour)
    )
    date = F.date_add(now.cast("date"), _lookup(day, DAYS))
    at = F.try_make_timestamp_ntz(F.year(date), F.month(date), F.dayofmonth(date), shifted, minute, F.lit(0).cast("decimal(8,6)"))
    usable = found & (shifted <= 23) & (minute <= 59)
    return F.when(usable, at).otherwise(stated)


def in_business(stamp: Column, opens: int = 9, closes: int = 21) -> Column:
    return (F.hour(stamp) >= opens) & (F.hour(stamp) < closes)


#: Parts of the day by the hour before which they end, and days counted from now.
PERIODS = ((12, "上午"), (18, "下午"), (24, "晚上"))
NEAR_DAYS = ("今天", "明天", "后天")


def time_forms(stamp: Column, now: Column | None = None) -> Column:
    """Ways in which a reply may write a time; those that name the day from ``now`` where it lies within two days of it."""
    hour, minute = F.hour(stamp), F.minute(stamp)
    clock = lambda h: F.concat(h.cast("string"), F.lit("点"), F.when(minute == 0, "").otherwise(F.concat(minute.cast("string"), F.lit("分"))))
    plain = clock(hour)
    name = F.lit(None).cast("string")
    for end, period in reversed(PERIODS):
        name = F.when(hour < end, period).otherwise(name)
    spoken = F.concat(name, clock(F.when(hour <= 12, hour).otherwise(hour - 12)))
    date = F.concat(F.month(stamp).cast("string"), F.lit("月"), F.dayofmonth(stamp).cast("string"))
    forms = [F.date_format(stamp, STAMP), F.date_format(stamp, "yyyy年MM月dd日HH点mm分"), F.concat(date, F.lit("日"), plain), F.concat(date, F.lit("号"), plain), F.date_format(stamp, "HH:mm"), plain, spoken]
    if now is not None:
        ahead = F.date_diff(stamp.cast("date"), now.cast("date"))
        day = F.get(F.array(*map(F.lit, NEAR_DAYS)), F.when(ahead >= 0, ahead))
        forms += [F.concat(day, plain), F.concat(day, spoken)]
    return F.array_distinct(F.array_compact(F.array(*forms)))
