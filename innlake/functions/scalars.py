"""Column expressions: rounding, binning, labels, dates and period names.

All of them are built-in expressions, so they stay inside whole-stage codegen
and filters over them can still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from innlake.schemas import MONTHS

# Price-band edges (right-closed) and the quarter calendar.
RATE_EDGES = [49, 75, 100, 125, 150, 175, 200, 225, 250, 275, 300, 325, 350, 375, 400]
QUARTER_MONTHS = {q: MONTHS[3 * (q - 1):3 * q] for q in (1, 2, 3, 4)}


def round_half_even(col: Column) -> Column:
    return F.bround(col, 0).cast("int")


def rate_category(rate: Column) -> Column:
    """Band 1..14 of a rate; NULL outside (49, 400]."""
    bands = None
    for label, (low, high) in enumerate(zip(RATE_EDGES, RATE_EDGES[1:]), start=1):
        inside = (rate > low) & (rate <= high)
        bands = F.when(inside, label) if bands is None else bands.when(inside, label)
    return bands.cast("int")


def upper_clamp(col: Column, bound: int) -> Column:
    """Cap at the bound; missing stays missing."""
    return F.when(col > bound, F.lit(bound)).otherwise(col)


def within_upper_bound(col: Column, bound: int) -> Column:
    """Filter predicate that drops only rows known to exceed the bound."""
    return col.isNull() | (col <= bound)


def presence_label(col: Column, present: str, absent: str) -> Column:
    return F.when(col.isNotNull(), F.lit(present)).otherwise(F.lit(absent))


def booking_number(col: Column) -> Column:
    """'INN00154' -> 154."""
    return F.substring(col, 4, 2147483647).cast("bigint")


def quarter_months(quarter: Column) -> Column:
    """Names of the three months of a quarter, as an array."""
    calendar = F.create_map(*[
        part for q, names in QUARTER_MONTHS.items()
        for part in (F.lit(q), F.array(*map(F.lit, names)))
    ])
    return F.element_at(calendar, quarter)


def month_period(label: Column) -> tuple[Column, Column]:
    """Year and month of a label such as '2017-10.csv'."""
    pattern = r"^(\d{4})-(\d{1,2})\.csv$"
    return (F.regexp_extract(label, pattern, 1).cast("int"),
            F.regexp_extract(label, pattern, 2).cast("int"))


def quarter_period(label: Column) -> tuple[Column, Column]:
    """Year and quarter of a label such as 'Q32017'."""
    pattern = r"^Q([1-4])(\d{4})$"
    return (F.regexp_extract(label, pattern, 2).cast("int"),
            F.regexp_extract(label, pattern, 1).cast("int"))


def next_month(year: Column, month: Column) -> Column:
    """First day of the following calendar month."""
    return F.add_months(F.make_date(year, month, F.lit(1)), 1)
