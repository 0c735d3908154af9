"""Tenure and pay columns derived from a hire date and a monthly salary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata import catalogue as C


def tenure_columns(
    df: DataFrame,
    as_of: dt.date | str | None = None,
    hire_col: str = C.HIRE_DATE,
    salary_col: str = C.SALARY,
    department_col: str = C.DEPARTMENT,
) -> DataFrame:
    """Add hire year and month, days and years of service (1 decimal),
    annual salary; upper-case the department (null stays null).

    ``as_of`` fixes the reference day so that results repeat; ``None`` means
    today (``current_date()``, evaluated once per query).
    """
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    hired = F.col(hire_col)
    days = F.datediff(today, hired)
    return df.withColumns({
        C.HIRE_YEAR: F.year(hired),
        C.HIRE_MONTH: F.month(hired),
        C.DAYS_EMPLOYED: days,
        C.YEARS_EMPLOYED: F.round(days / C.DAYS_PER_YEAR, C.YEARS_DIGITS),
        C.ANNUAL_SALARY: F.col(salary_col) * C.MONTHS_PER_YEAR,
        department_col: F.upper(F.col(department_col)),
    })
