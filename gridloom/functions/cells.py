"""Texts of cells, names of header columns, names of tabs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


#: Milliseconds of a day, and days from the epoch of 1900 to that of 1904.
DAY, LATER_EPOCH = 86_400_000, 1462
#: Serial numbers of dates that have a text: up to the end of the year 9999.
LAST_DAY = 2_958_465


def bound(value: Column, f: Callable[[Column], Column]) -> Column:
    """f of a value that is computed once, however often f names it."""
    return F.transform(F.array(value), f)[0]


def number_text(number: Column) -> Column:
    """The text of a double: whole numbers without a fraction, others by the fewest digits that read back as the same
    number, with an exponent below 0.0001 (`1e-12`). Whole numbers beyond 4e37 keep the engine's own text."""
    whole = number == F.rint(number)
    # two exact halves: a cast of the double itself would go through its shortest text
    half = F.lit(float(1 << 62))
    high = F.floor(F.abs(number) / half)
    low = F.abs(number) - high.cast("double") * half
    exact = high.cast("decimal(38,0)") * F.lit(1 << 62).cast("decimal(38,0)") + low.try_cast("bigint").cast("decimal(38,0)")
    large = F.concat(F.when(number < 0, "-").otherwise(""), exact.try_cast("decimal(38,0)").cast("string"))
    own = number.cast("string")
    plain = F.regexp_replace(F.regexp_replace(own.try_cast("decimal(38,21)").cast("string"), r"0+$", ""), r"\.$", "")
    power = F.regexp_extract(own, r"E-(\d+)$", 1)
    small = F.concat(F.regexp_replace(F.substring_index(own, "E", 1), r"\.0$", ""), F.lit("e-"), F.when(F.length(power) < 2, F.concat(F.lit("0"), power)).otherwise(power))
    told = F.when(whole & (F.abs(number) < 1e15), number.try_cast("bigint").cast("string")).when(whole & (F.abs(number) < 4e37), large)
    return F.coalesce(told.when(F.abs(number) < 1e-4, small).when(whole, own).otherwise(plain), own)


def _clock(ms: Column, hours: int) -> Column:
    """h:mm:ss of milliseconds of a day, with six digits of a fraction if there is one."""
    two = lambda x, n=2: F.lpad(x.cast("string"), n, "0")
    part = lambda unit, most: F.floor(ms / unit) % most
    hour = two(F.floor(ms / 3_600_000)) if hours == 2 else F.floor(ms / 3_600_000).cast("string")
    fraction = F.when(ms % 1000 == 0, "").otherwise(F.concat(F.lit("."), two(ms % 1000, 3), F.lit("000")))
    return F.concat(hour, F.lit(":"), two(part(60_000, 60)), F.lit(":"), two(part(1000, 60)), fraction)


def serial_text(number: Column, later_epoch: Column) -> Column:
    """The text of a serial date: `yyyy-MM-dd`, with ` HH:mm:ss` unless it is midnight, or `HH:mm:ss` below one day.

    Days count from the end of 1899, or from 1904; the first one counts a 29 February 1900, which never was, so serials
    below 60 are a day short. Times are rounded to milliseconds. Null for what has no date of four digits.
    """
    from_1900 = number + F.when(later_epoch, F.lit(float(LATER_EPOCH))).otherwise(F.lit(0.0))
    days = from_1900 + F.when(from_1900 < 60, F.lit(1.0)).otherwise(F.lit(0.0))
    date = lambda ms: F.date_add(F.lit("1899-12-30").cast("date"), F.floor(ms / DAY).cast("int")).cast("string")
    clock = lambda ms: bound(ms % DAY, lambda of_day: _clock(of_day, 2))
    told = lambda ms: F.when(number < 1, clock(ms)).when(number == F.floor(number), date(ms)).otherwise(F.concat(date(ms), F.lit(" "), clock(ms)))
    return bound(F.when((days >= 0) & (days < LAST_DAY + 1), F.round(days * DAY)).try_cast("bigint"), told)


def elapsed_text(number: Column) -> Column:
    """The text of a span of days: `h:mm:ss`, from a day on `2 days, h:mm:ss`; a negative one has negative days and time beyond them."""
    named = lambda days: F.when(days == 0, "").otherwise(F.concat(days.cast("string"), F.when(F.abs(days) == 1, " day, ").otherwise(" days, ")))
    told = lambda ms: bound(F.floor(ms / DAY), lambda days: F.concat(named(days), bound(ms - days * DAY, lambda rest: _clock(rest, 1))))
    return bound(F.when(F.abs(number) < 1e9, F.round(number * DAY)).try_cast("bigint"), told)


def cell_text(value: Column, kind: Column) -> Column:
    """The text of a cell from what it holds (string) and its kind.

    `b` boolean: `true` and `false`; `n` number (number_text); `d` and `d4` serial date from 1900 and 1904 (serial_text);
    `e` span of time (elapsed_text); `i` ISO date, whose `T` becomes a space; all else is text and stays as it is, not
    trimmed. Empty texts are null, what can't be read as its kind stays text.
    """
    truth = F.when(F.lower(value).isin("1", "true"), "true").otherwise("false")

    def numbered(number: Column) -> Column:
        dated = F.coalesce(serial_text(number, kind == "d4"), number_text(number))
        told = F.when(kind == "n", number_text(number)).when(kind == "e", F.coalesce(elapsed_text(number), number_text(number))).otherwise(dated)
        return F.when(number.isNotNull(), told)

    finite = lambda n: F.when(F.abs(n) < float("inf"), n)
    parsed = F.nanvl(value.try_cast("double"), F.lit(None).cast("double"))
    told = (
        F.when(kind == "b", truth)
        .when(kind.isin("n", "d", "d4", "e"), bound(parsed, lambda n: bound(finite(n), numbered)))
        .when(kind == "i", F.regexp_replace(value, r"^(\d{4}-\d{2}-\d{2})T", "$1 "))
    )
    return F.when(value == "", F.lit(None).cast("string")).otherwise(F.coalesce(told, value))


def header_names(cells: Column) -> Column:
    """Column names from header cells: trimmed, empty ones `col_<place>`, the k-th repeat of a name `<name>_<k>`.

    A name made that way may meet another header, or differ from one by case alone; it then gets a further `_1`, so that
    names are unique whatever their case.
    """
    named = F.transform(cells, lambda c, i: F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.concat(F.lit("col_"), i.cast("string"))).otherwise(F.trim(c)))

    def add(done: Column, name: Column) -> Column:
        seen = F.size(F.filter(done, lambda d: F.lower(d["raw"]) == F.lower(name)))
        first = F.when(seen == 0, name).otherwise(F.concat(name, F.lit("_"), seen.cast("string")))
        taken = F.exists(done, lambda d: F.lower(d["name"]) == F.lower(first))
        return F.array_append(done, F.struct(name.alias("raw"), F.when(taken, F.concat(first, F.lit("_1"))).otherwise(first).alias("name")))

    empty = F.array().cast("array<struct<raw:string,name:string>>")
    return F.transform(F.aggregate(named, empty, add), lambda d: d["name"])


def safe_tab_name(name: Column, fallback: str) -> Column:
    r"""A tab name of 31 characters at most without \ / * ? : [ ]; the fallback if nothing is left."""
    clean = F.trim(F.regexp_replace(F.coalesce(F.when(name == "", None).otherwise(name), F.lit(fallback)), r"[\\/*?:\[\]]", "_"))
    return F.substring(F.coalesce(F.when(clean == "", None).otherwise(clean), F.lit(fallback)), 1, 31)
