"""The population sort order.

Business keys (last name, first name, birth date, event date) ascend in even
measurement years and descend in odd ones; member id and visit id always ascend
as the final tie-break, so the order is total and a rank never depends on how
the input was partitioned.

One sort specification serves groups of both parities: each business key k is
split into ``when(even, k)`` ascending and ``when(odd, k)`` descending. Inside
one group (the year is part of the group) one of the two is constant null, so
only the other one orders the rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BUSINESS_KEYS = ("last_name", "first_name", "date_of_birth", "event_date")
TIE_BREAK_KEYS = ("patient_id", "visit_id")


def parity_keys(year_col: str = "measurement_year", keys=BUSINESS_KEYS) -> list[Column]:
    even = (F.col(year_col) % 2) == 0
    cols: list[Column] = []
    for k in keys:
        cols.append(F.when(even, F.col(k)).asc_nulls_first())
        cols.append(F.when(~even, F.col(k)).desc_nulls_last())
    return cols


def population_order(year_col: str = "measurement_year", keys=BUSINESS_KEYS, tie_break=TIE_BREAK_KEYS) -> list[Column]:
    """Full sort order for a ranked population (business keys by parity, ids ascending)."""
    return parity_keys(year_col, keys) + [F.col(k).asc_nulls_first() for k in tie_break]
