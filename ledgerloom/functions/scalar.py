"""Scalar column functions of the order model.

All are built from ``pyspark.sql.functions`` so they stay inside
whole-stage codegen; none is a Python UDF. Every parse uses a ``try_*``
form: ANSI mode is on in Spark 4, and a bad value must become null (or a
policy default), never fail the job.
"""

from __future__ import annotations

import calendar

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.schemas import FACTOR, FALSE_TOKENS, NUM, TRUE_TOKENS

# Date layouts accepted after the ISO forms (which
# ``try_cast`` already handles: 'yyyy-MM-dd', 'yyyy-MM-dd HH:mm:ss',
# 'yyyy-MM-ddTHH:mm:ss', with or without a zone suffix), by the text's
# shape: every run of digits is 9, every run of letters a. Month first;
# day first where no such month exists.
DATE_SHAPES = {
    "9/9/9": ["yyyy/M/d", "M/d/yyyy", "d/M/yyyy"],
    "9/9/9 9:9": ["yyyy/M/d H:mm", "M/d/yyyy H:mm", "d/M/yyyy H:mm"],
    "9/9/9 9:9:9": ["yyyy/M/d H:mm:ss", "M/d/yyyy H:mm:ss", "d/M/yyyy H:mm:ss"],
    "9/9/9 9:9 a": ["M/d/yyyy h:mm a", "d/M/yyyy h:mm a"],
    "9.9.9": ["M.d.yyyy", "d.M.yyyy", "yyyy.M.d"],
    "9.9.9 9:9": ["M.d.yyyy H:mm", "d.M.yyyy H:mm", "yyyy.M.d H:mm"],
    "9.9.9 9:9:9": ["M.d.yyyy H:mm:ss", "d.M.yyyy H:mm:ss", "yyyy.M.d H:mm:ss"],
    "9": ["yyyyMMdd", "yyyyMMddHHmmss"],
    "a 9, 9": ["MMMM d, yyyy", "MMM d, yyyy"],
    "a 9 9": ["MMMM d yyyy", "MMM d yyyy"],
    "a 9, 9 9:9": ["MMMM d, yyyy H:mm", "MMM d, yyyy H:mm"],
    "a 9, 9 9:9:9": ["MMMM d, yyyy H:mm:ss", "MMM d, yyyy H:mm:ss"],
    "a 9, 9 9:9 a": ["MMMM d, yyyy h:mm a", "MMM d, yyyy h:mm a"],
    "a 9, 9 9:9:9 a": ["MMMM d, yyyy h:mm:ss a", "MMM d, yyyy h:mm:ss a"],
    "9 a 9": ["d MMMM yyyy", "d MMM yyyy"],
    "9 a 9 9:9": ["d MMMM yyyy H:mm", "d MMM yyyy H:mm"],
    "9 a 9 9:9:9": ["d MMMM yyyy H:mm:ss", "d MMM yyyy H:mm:ss"],
    "9-a-9": ["d-MMM-yyyy", "d-MMMM-yyyy"],
    "9-a-9 9:9:9": ["d-MMM-yyyy H:mm:ss"],
}

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def active_flag(c: ColumnOrName) -> Column:
    """F1 boolean token normaliser: trim + lower, then the true/false token
    lists, then an integer literal (non-zero is true), else false.
    Null gives false."""
    t = F.lower(F.regexp_replace(_col(c).cast("string"), r"^\s+|\s+$", ""))
    as_int = F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast("decimal(38,0)") != 0)
    return (
        F.when(t.isin(TRUE_TOKENS), F.lit(True))
        .when(t.isin(FALSE_TOKENS), F.lit(False))
        .otherwise(F.coalesce(as_int, F.lit(False)))
    )


def safe_number(c: ColumnOrName, default: float | None = None) -> Column:
    """F5 text/number to the exact numeric type; bad input gives null, or
    ``default`` when one is given (F7)."""
    v = _col(c).try_cast(NUM)
    return v if default is None else F.coalesce(v, F.lit(default).cast(NUM))


def first_present(*cols: ColumnOrName) -> Column:
    """F6 per-row choice among alternative fields (first non-null)."""
    cs = [_col(c) for c in cols]
    return cs[0] if len(cs) == 1 else F.coalesce(*cs)


def parse_date(c: ColumnOrName) -> Column:
    """F8/F9 text to DATE: ISO date or timestamp text (space or 'T'),
    then the layouts of the text's shape, so a row tries two or three and
    not all of them; a leading weekday and a trailing zone name are left
    out. Anything else gives null."""
    s = F.regexp_replace(_col(c).cast("string"), r"^\s+|\s+$", "")
    plain = F.regexp_replace(s, r"^(?i:mon|tue|wed|thu|fri|sat|sun)[a-z]*,? +| +(?:GMT|UTC|Z)$", "")
    shape = F.regexp_replace(F.regexp_replace(plain, "[0-9]+", "9"), "[A-Za-z]+", "a")
    tries = []
    for k in range(max(map(len, DATE_SHAPES.values()))):
        nth = [F.lit(x) for known, formats in DATE_SHAPES.items() if k < len(formats) for x in (known, formats[k])]
        tries.append(F.try_to_timestamp(plain, F.try_element_at(F.create_map(*nth), shape)).cast("date"))
    return F.coalesce(s.try_cast("date"), *tries)


def exact_sum(c: ColumnOrName) -> Column:
    """Sum of exact numbers: exact where it fits the type; past 28 digits
    before the point the sum of doubles, and null only where that does not
    fit either. Never an overflow error that would end the job."""
    return F.coalesce(F.try_sum(c), F.sum(_col(c).cast("double")).try_cast(NUM))


def wide_sum(c: ColumnOrName) -> Column:
    """Sum of exact numbers as a double: of the exact sum where it fits,
    else of doubles."""
    return F.coalesce(F.try_sum(c).cast("double"), F.sum(_col(c).cast("double")))


def to_double(c: ColumnOrName) -> Column:
    """Exact decimal to the output double (the nearest one)."""
    return _col(c).cast("double")


def product(a: ColumnOrName, b: ColumnOrName) -> Column:
    """F12 product of two numbers as the exact numeric type. Factors that
    ``FACTOR`` holds are multiplied exactly; others (very large values, or
    over eight decimals) as doubles, whose product is null when it has
    over 28 digits before the point."""
    a, b = _col(a), _col(b)
    x, y = a.try_cast(FACTOR), b.try_cast(FACTOR)
    return F.when((x == a) & (y == b), (x * y).cast(NUM)).otherwise(
        (a.cast("double") * b.cast("double")).try_cast(NUM)
    )


def day_key(c: ColumnOrName) -> Column:
    """F10/F16 DATE to 'yyyyMMdd' text (the dashes removed)."""
    return F.date_format(_col(c), "yyyyMMdd")


def money_text(c: ColumnOrName, fmt: str = "%.2f") -> Column:
    """F11 number to text with a printf format. The value is rounded
    half-up to the format's decimals first, so the text does not depend
    on binary floating point; null stays null (format_string would print
    'nu')."""
    digits = _decimals_of(fmt)
    v = _col(c)
    if digits is not None:
        v = F.round(v.cast("decimal(38,8)"), digits).cast("double")
    return F.when(_col(c).isNotNull(), F.format_string(fmt, v))


def _decimals_of(fmt: str) -> int | None:
    if fmt.startswith("%.") and fmt.endswith("f") and fmt[2:-1].isdigit():
        return int(fmt[2:-1])
    return None


def month_day_names(year: int, month: int) -> list[str]:
    """The ISO day strings of a month, 1..last."""
    last = calendar.monthrange(year, month)[1]
    return [f"{year:04d}-{month:02d}-{d:02d}" for d in range(1, last + 1)]
