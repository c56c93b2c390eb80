"""Column helpers that reproduce T-SQL / PowerShell semantics with built-in
Spark expressions (no UDFs). See SURVEY §1.4 for why each exists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_or_lit(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x)


def tsql_concat(*parts) -> Column:
    """T-SQL ``CONCAT``: NULL arguments count as ''. Strings are literals."""
    return F.concat(*[F.coalesce(col_or_lit(p).cast("string"), F.lit("")) for p in parts])


def tsql_plus(*parts) -> Column:
    """T-SQL string ``+``: any NULL makes the result NULL."""
    return F.concat(*[col_or_lit(p).cast("string") for p in parts])


def int_div(a: Column, b) -> Column:
    """Truncating integer division (T-SQL ``int / int``); NULL-propagating.

    ``a - a % b`` is an exact multiple of ``b`` (``%`` keeps the dividend's
    sign), so the decimal quotient is exact and never rounds up."""
    a = a.cast("bigint")
    b = col_or_lit(b).cast("bigint")
    return ((a - a % b).cast("decimal(38,0)") / b.cast("decimal(38,0)")).cast("bigint")


def int_avg_minutes(sum_col: Column, count_col: Column) -> Column:
    """``avg(int_seconds)/60`` with T-SQL integer arithmetic: (sum div count) div 60."""
    return F.when(count_col > 0, int_div(int_div(sum_col, count_col), 60)).cast("bigint")


def fmt_ts(c: Column) -> Column:
    """``CAST(datetime AS VARCHAR(19))`` / ``CONVERT(..., 120)``."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def fmt_date(c: Column) -> Column:
    """``CONVERT(VARCHAR(10), date, 120)``."""
    return F.date_format(c, "yyyy-MM-dd")


def quote_name(c: Column) -> Column:
    """``QUOTENAME``: bracket an identifier, doubling ']' (NULL stays NULL)."""
    return F.concat(F.lit("["), F.replace(c, F.lit("]"), F.lit("]]")), F.lit("]"))


def amp_to_and(c: Column) -> Column:
    """PF-3 name cleanup: ``REPLACE(name, '&', 'and')``."""
    return F.replace(c, F.lit("&"), F.lit("and"))


def ne_true(a: Column, b) -> Column:
    """``a <> b`` as a WHERE would treat it: unknown counts as false."""
    return F.coalesce(a != col_or_lit(b), F.lit(False))


def eq_true(a: Column, b) -> Column:
    return F.coalesce(a == col_or_lit(b), F.lit(False))


def fill_template(template: Column, values: dict) -> Column:
    """F-20: substitute each placeholder of a text template (e.g. a page
    skeleton) by a column or literal, in the given order -- a chain of
    built-in ``replace`` calls, evaluated per row."""
    out = template
    for placeholder, value in values.items():
        out = F.replace(out, F.lit(placeholder), col_or_lit(value).cast("string"))
    return out
