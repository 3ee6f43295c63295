"""Date column expressions: the multi-layout partner date grammar, DOB plausibility,
test-window and term checks. Pure Column expressions, no Python on workers."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import DOB_MAX_AGE, DOB_MIN_AGE, NON_SPRING_PATTERNS, TEST_WINDOW_END, TEST_WINDOW_START
from .text import _c, strip, try_cast

# A date is handled as the number yyyymmdd until it is known to be real: no text is parsed to find out.
_DAY = "( [1-9]|[0-9]{1,2})"
_LAYOUTS = (f"^([0-9]{{1,2}}/{_DAY}/([0-9]{{2}}|[0-9]{{4}})|[0-9]{{1,2}}-{_DAY}-[0-9]{{4}}"  # month first
            f"|[0-9]{{4}}/[0-9]{{1,2}}/{_DAY}|[0-9]{{4}}-[0-9]{{1,2}}-{_DAY})$")             # year first


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it. As the body of a
    lambda it also stays out of the stage's generated code, which has a size limit."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _div(n: Column, by: int) -> Column:
    return F.floor(n / by).cast("int")


def _century(yy: Column, last: int) -> Column:
    """Two-digit year as a year: up to ``last`` in this century, later ones in the one before."""
    return yy + F.when(yy > last, 1900).otherwise(2000)


def _ymd(y: Column, m: Column, d: Column) -> Column:
    return y * 10000 + m * 100 + d


def _real(n: Column) -> Column:
    """Whether a number yyyymmdd is a date of the years 1 to 9999."""
    y, m, d = _div(n, 10000), _div(n, 100) % 100, n % 100
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    days = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
    return (y >= 1) & m.between(1, 12) & d.between(1, days)


def _with_separators(s: Column) -> Column:
    """Number of the slash and dash layouts (two-digit years: 69 and later are 19xx); null for other texts."""
    sep = F.when(s.contains("/"), "/").otherwise("-")
    a = F.substring_index(s, "/", 1), F.substring_index(s, "-", 1)
    c = F.substring_index(s, "/", -1), F.substring_index(s, "-", -1)
    slash = sep == "/"
    first, last = F.when(slash, a[0]).otherwise(a[1]), F.when(slash, c[0]).otherwise(c[1])
    middle = F.substring(s, F.length(first) + 2, F.length(s) - F.length(first) - F.length(last) - 2)
    x, y, z = (try_cast(F.trim(p), "int") for p in (first, middle, last))
    month_first = _ymd(F.when(F.length(last) == 2, _century(z, 68)).otherwise(z), x, y)
    return F.when(s.rlike(_LAYOUTS), F.when(F.length(first) == 4, _ymd(x, y, z)).otherwise(month_first))


def _compact(s: Column) -> Column:
    """Numbers that a run of 4 to 8 digits may mean, in the order in which they are tried."""
    return _let(try_cast(s, "int"), lambda v: _readings(v, F.length(s)))


def _readings(v: Column, n: Column) -> Column:
    def part(at: int, size: int, of: int) -> Column:
        """Digits at..at+size of a run of ``of`` digits."""
        return _div(v, 10 ** (of - at - size)) % 10 ** size

    def reading(of: int, y: tuple[int, int], m: tuple[int, int], d: tuple[int, int], last: int | None = None) -> Column:
        year = part(*y, of)
        return _ymd(year if last is None else _century(year, last), part(*m, of), part(*d, of))

    return (F.when(n == 8, F.array(reading(8, (4, 4), (0, 2), (2, 2)), reading(8, (0, 4), (4, 2), (6, 2))))
            .when(n == 7, F.array(reading(7, (3, 4), (0, 1), (1, 2)), reading(7, (0, 4), (4, 2), (6, 1)),
                                  reading(7, (0, 4), (4, 1), (5, 2)), reading(7, (3, 4), (0, 2), (2, 1))))
            .when(n == 6, F.array(reading(6, (4, 2), (0, 2), (2, 2), 30), reading(6, (0, 4), (4, 1), (5, 1)),
                                  reading(6, (2, 4), (0, 1), (1, 1))))
            .when(n == 5, F.array(reading(5, (3, 2), (0, 2), (2, 1), 68), reading(5, (3, 2), (0, 1), (1, 2), 68)))
            .when(n == 4, F.array(reading(4, (2, 2), (0, 1), (1, 1), 68))))


def parse_partner_date(c: Column | str) -> Column:
    """Partner date text -> DateType, first reading that is a real date wins.

    Strip, drop a trailing `` HH:MM[:SS]``. A run of digits: 8 digits MMDDYYYY else YYYYMMDD;
    7 digits MDDYYYY, then year first, then MMDYYYY; 6 digits MMDDYY (pivot 30), then YYYYMD,
    then MDYYYY; 5 and 4 digits month, day and two-digit year (pivot 69). Otherwise the slash
    and dash layouts, month or four-digit year first. Else null; there is no year 0.

    The usual layouts (slashes, ISO with or without time, eight digits) have generated code; readings of
    the others are plain arithmetic on the digits, so one that is no date costs no failed parse."""
    c = _c(c)
    return _usual_layouts(c, _any_layout(c))


def _usual_layouts(c: Column, other: Column) -> Column:
    """Date of the layouts that most files use, by the cast from year-month-day text; ``other`` for all other texts."""
    def ymd(year: Column, month: Column, day: Column) -> Column:
        return try_cast(F.concat(year, F.lit("-"), month, F.lit("-"), day), "date")

    def digits(at: int, size: int) -> Column:
        return F.substring(c, at, size)

    last, month, day = F.substring_index(c, "/", -1), F.substring_index(c, "/", 1), F.substring_index(F.substring_index(c, "/", 2), "/", -1)
    month_first = F.when(digits(5, 4) != "0000", ymd(digits(5, 4), digits(1, 2), digits(3, 2)))
    year_first = F.when(digits(1, 4) != "0000", ymd(digits(1, 4), digits(5, 2), digits(7, 2)))
    return (F.when(c.rlike(r"^[0-9]{1,2}/[0-9]{1,2}/(?:(?!0000)[0-9]{2})?[0-9]{2}\z"),
                   ymd(F.when(F.length(last) == 4, last).otherwise(F.concat(F.when(last > "68", "19").otherwise("20"), last)), month, day))
            .when(c.rlike(r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(?: [0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?)?\z"), try_cast(F.substring_index(c, " ", 1), "date"))
            .when(c.rlike(r"^[0-9]{8}\z"), F.coalesce(month_first, year_first))
            .otherwise(other))


def _any_layout(c: Column) -> Column:
    text = F.when(c.rlike("^[0-9/-]*$"), c).otherwise(F.regexp_replace(strip(c), r"(?U)\s+[0-9]{1,2}:[0-9]{2}(:[0-9]{2})?$", ""))

    def first_real(s: Column) -> Column:
        numbers = F.when(s.rlike("^[0-9]{4,8}$"), _compact(s)).otherwise(F.array(_with_separators(s)))
        return F.get(F.transform(F.filter(numbers, _real), lambda n: F.make_date(_div(n, 10000), _div(n, 100) % 100, n % 100)), F.lit(0))

    return _let(text, first_real)


def date_text(d: Column | str) -> Column:
    """``MM/dd/yyyy`` text of a date (year padded to four digits)."""
    return F.date_format(_c(d), "MM/dd/yyyy")


def plausible_dob(d: Column | str, as_of: _dt.date) -> Column:
    """Keep a birth date only if (as-of year - birth year) lies in [4, 25]."""
    def kept(x: Column) -> Column:
        return F.when((F.lit(as_of.year) - F.year(x)).between(DOB_MIN_AGE, DOB_MAX_AGE), x)

    return kept(F.col(d)) if isinstance(d, str) else _let(d, kept)


def study_year(settings_term: Column | str) -> Column:
    """Leading four digits of the settings term (``202502`` -> 2025), else null."""
    t = strip(_c(settings_term).cast("string"))
    return try_cast(F.nullif(F.regexp_extract(t, "^([0-9]{4})", 1), F.lit("")), "int")


def term_year(term: Column | str) -> Column:
    """First four-digit run of a term text (computed by the reference, unused downstream)."""
    return try_cast(F.nullif(F.regexp_extract(_c(term), "([0-9]{4})", 1), F.lit("")), "int")


def test_date_out_of_range(test_date: Column | str, settings_term: Column | str,
                           flag_absurd_dates: bool = False) -> Column:
    """True when the test date falls before 1 Feb or after 30 Jun of the study year.
    Null on either side -> False. Dates outside the nanosecond-timestamp range
    (years before 1678 or after 2261) are not flagged unless ``flag_absurd_dates``."""
    return outside_test_window(test_date, study_year(settings_term), flag_absurd_dates)


def outside_test_window(test_date: Column | str, year: Column | str, flag_absurd_dates: bool = False) -> Column:
    """``test_date_out_of_range`` for a study year that is known already."""
    d, y = _c(test_date), _c(year)
    start = F.make_date(y, F.lit(TEST_WINDOW_START[0]), F.lit(TEST_WINDOW_START[1]))
    end = F.make_date(y, F.lit(TEST_WINDOW_END[0]), F.lit(TEST_WINDOW_END[1]))
    out = (d < start) | (d > end)
    if not flag_absurd_dates:
        out = out & F.year(d).between(1678, 2261)
    return F.coalesce(out & y.isNotNull() & d.isNotNull(), F.lit(False))


def yyyymm_number(d: Column | str) -> Column:
    return F.date_format(_c(d), "yyyyMM").cast("int")


def incorrect_term(d_term: Column | str, settings_term: Column | str) -> Column:
    """Term check. Null either side / no study year -> False. Fall, summer or winter
    wording -> True. Years named in the text (every ``20dd`` found left to right, and
    isolated two-digit numbers 0..50 read as 20dd): none -> False; study year or the year
    before among them -> False; otherwise True.

    ``term_reading`` holds what the text says, ``contradicts`` compares it with the study year; each is computed once per row (``_let``)."""
    return _let(F.struct(term_reading(d_term).alias("r"), study_year(settings_term).alias("y")), lambda x: contradicts(x["r"], x["y"]))


def term_reading(d_term: Column | str) -> Column:
    """What a term text says, whatever the study: struct of ``season`` (fall, summer or winter wording), ``four`` (every
    20dd) and ``two`` (isolated numbers 00 to 50); null for a null text. Blanks at the ends are no part of any pattern, and
    numbers have no upper case."""
    text = _c(d_term).cast("string")
    season = F.upper(text).rlike("(?U)" + "|".join(NON_SPRING_PATTERNS))
    four = F.regexp_extract_all(text, F.lit("20[0-9]{2}"), 0).cast("array<int>")
    two = F.regexp_extract_all(text, F.lit("(?<![0-9])([0-4][0-9]|50)(?![0-9])"), 1).cast("array<int>")
    return F.when(text.isNotNull(), F.struct(season.alias("season"), four.alias("four"), two.alias("two")))


def contradicts(reading: Column | str, year: Column | str) -> Column:
    """Whether a term's reading rules out the study year, see ``incorrect_term``."""
    r, y = _c(reading), _c(year)

    def named(x: Column) -> Column:
        return F.array_contains(r["four"], x) | F.array_contains(r["two"], x - 2000)

    years = (F.size(r["four"]) > 0) | (F.size(r["two"]) > 0)
    return F.when(r.isNull() | y.isNull(), F.lit(False)).when(r["season"], F.lit(True)).otherwise(years & ~(named(y) | named(y - 1)))
