"""Column functions for observation dates and maturities."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_date(x) -> Column:
    """ISO text to date; anything unparseable becomes null (ANSI mode would throw). The cast alone would take
    shorter and longer texts as well; a formatter takes several times longer."""
    s = _c(x).cast("string")
    iso = (F.length(s) == 10) & (F.substring(s, 5, 1) == "-") & (F.substring(s, 8, 1) == "-") & (F.substring(s, 10, 1) >= "0")
    return F.when(iso, s.try_cast("date"))


def normalize_date(x) -> Column:
    """ISO kept, ``YYYY-Qn`` to the 15th of the mid-quarter month, ``YYYY-MM`` to the 1st."""
    s = _c(x)
    q = F.substring(s, 7, 1)
    mid_month = F.when(q == "2", "05").when(q == "3", "08").when(q == "4", "11").otherwise("02")
    quarter = F.concat(F.substring(s, 1, 4), F.lit("-"), mid_month, F.lit("-15"))
    return (
        F.when(s.isNull() | (s == ""), F.lit(None).cast("string"))
        .when(s.rlike(r"^.{4}-.{2}-.{2}$"), s)
        .when(s.rlike(r"^\d{4}-[Qq]\d$"), quarter)
        .when(s.rlike(r"^.{4}-.{2}$"), F.concat(s, F.lit("-01")))
        .otherwise(s)
    )


def quarter_label(d) -> Column:
    """``YYYY-Qn`` of a date."""
    return F.concat(F.year(_c(d)).cast("string"), F.lit("-Q"), F.quarter(_c(d)).cast("string"))


def month_index(d) -> Column:
    """Months since year 0, for interpolation and calendar keys."""
    return F.year(_c(d)) * 12 + F.month(_c(d))


def quarter_index(d) -> Column:
    return F.year(_c(d)) * 4 + F.quarter(_c(d)) - 1


def label_quarter_index(x) -> Column:
    """Quarter index of ``YYYY-Qn`` or of any date text starting ``YYYY-MM``."""
    s = _c(x)
    year = F.substring(s, 1, 4).try_cast("int")
    by_label = F.substring(s, 7, 1).try_cast("int")
    by_month = F.ceil(F.substring(s, 6, 2).try_cast("int") / 3.0).cast("int")
    return year * 4 + F.when(s.rlike(r"^\d{4}-[Qq]\d"), by_label).otherwise(by_month) - 1


def months_between_days(later, earlier) -> Column:
    return F.datediff(_c(later), _c(earlier)) / F.lit(C.DAYS_PER_MONTH)


def observation_date(maturity) -> Column:
    return F.date_sub(_c(maturity), C.OBSERVATION_LEAD_DAYS)
