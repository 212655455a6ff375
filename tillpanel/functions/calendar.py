"""Calendar helpers on DateType columns.

The panel uses Saturday-to-Friday weeks labelled by their Friday. Spark's
``weekday`` numbers Monday 0 … Sunday 6, the same convention as the
holiday rule's weekday arguments.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the holiday rule: (month, weekday Mon=0, n-th occurrence).
SUPER_BOWL = (2, 6, 1)     # first Sunday of February (documented approximation)
LABOR_DAY = (9, 0, 1)      # first Monday of September
THANKSGIVING = (11, 3, 4)  # fourth Thursday of November
CHRISTMAS = (12, 25)       # month, day
FRIDAY = 4


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nth_weekday(year, month: int, weekday: int, n: int) -> Column:
    """Date of the n-th ``weekday`` (Mon=0) of ``year``-``month``."""
    first = F.make_date(_col(year), F.lit(month), F.lit(1))
    offset = F.pmod(F.lit(weekday) - F.weekday(first), F.lit(7)) + F.lit(7 * (n - 1))
    return F.date_add(first, offset)


def week_ending_friday(d) -> Column:
    """Friday that closes the Saturday-to-Friday week containing ``d``."""
    d = _col(d)
    return F.date_add(d, F.lit(6) - F.pmod(F.weekday(d) - F.lit(FRIDAY + 1), F.lit(7)))


def is_major_holiday_week(d) -> Column:
    """1 when ``d`` falls in the Super Bowl, Labor Day, Thanksgiving or
    Christmas week of ``year(d)``, else 0 (null date → null)."""
    d = _col(d)
    y = F.year(d)
    anchors = [
        nth_weekday(y, *SUPER_BOWL),
        nth_weekday(y, *LABOR_DAY),
        nth_weekday(y, *THANKSGIVING),
        F.make_date(y, F.lit(CHRISTMAS[0]), F.lit(CHRISTMAS[1])),
    ]
    wk = week_ending_friday(d)
    hit = F.lit(False)
    for a in anchors:
        hit = hit | (wk == week_ending_friday(a))
    return F.when(d.isNull(), F.lit(None)).otherwise(hit.cast("int"))
