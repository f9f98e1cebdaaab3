"""Exact integer arithmetic for sample sizes and the systematic draw.

No double ever enters a size, a start or a step: percentages and RAND arrive as
decimals, are scaled to integers exactly, and every division is an integer
``div`` of non-negative operands (so Spark ``div`` and SQL ``//`` agree).

  os_bp  = oversampling percent * 100                    (10.00 % -> 1000)
  FSS    = ceil(MRSS * (10000 + os_bp) / 10000)
  N      = EM div FSS                                    (interval, floor)
  rand6  = RAND * 1_000_000                              (RAND in [0, 1])
  START  = max(1, half_up(rand6 * N / 1_000_000))
  pos(i) = START + half_up(i * EM / FSS)                 i = 0 .. FSS-1

The largest intermediate is about 2 * EM * FSS (and 2 * RAND6 * N), so 64-bit
integers hold populations up to 10^9 units per group with samples up to 10^6.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: scale of a percent in basis points and of RAND in millionths
BP_PER_UNIT = 10000
MICRO = 1000000


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def _sql_div(a: Column, b: Column) -> Column:
    """Integer division (SQL ``div``) of bigints; operands are non-negative here."""
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def ceil_div(a, b) -> Column:
    """ceil(a / b) for a >= 0, b > 0."""
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    return _sql_div(a + b - 1, b)


def half_up_div(a, b) -> Column:
    """round_half_up(a / b) for a >= 0, b > 0: (2a + b) div 2b."""
    a, b = _c(a).cast("bigint"), _c(b).cast("bigint")
    return _sql_div(a * 2 + b, b * 2)


def percent_to_bp(pct) -> Column:
    """decimal percent (e.g. 10.00) -> integer basis points (1000), exact."""
    return (_c(pct).cast("decimal(7,2)") * 100).cast("bigint")


def final_size(mrss, os_pct) -> Column:
    """FSS = ceil(MRSS * (1 + os%)), in integers."""
    return _sql_div(_c(mrss).cast("bigint") * (percent_to_bp(os_pct) + BP_PER_UNIT) + (BP_PER_UNIT - 1), F.lit(BP_PER_UNIT))


def interval_n(em, fss) -> Column:
    """N = floor(EM / FSS)."""
    return _sql_div(_c(em), _c(fss))


def rand_to_micro(rand) -> Column:
    """RAND decimal in [0, 1] -> integer millionths, exact."""
    return (_c(rand).cast("decimal(9,6)") * MICRO).cast("bigint")


def start_position(rand, n) -> Column:
    """START = max(1, half_up(RAND * N))."""
    return F.greatest(F.lit(1).cast("bigint"), half_up_div(rand_to_micro(rand) * _c(n).cast("bigint"), F.lit(MICRO)))


def position_of(i, em, fss, start) -> Column:
    """1-based population rank of the i-th (0-based) systematic pick."""
    return _c(start).cast("bigint") + half_up_div(_c(i).cast("bigint") * _c(em).cast("bigint"), _c(fss))


def draw_index(rank, em, fss, start) -> Column:
    """Inverse of ``position_of``: the pick index i whose position is ``rank``,
    or null when ``rank`` is not picked. Narrow, per row, no index list.

    With d = rank - START >= 0, pos(i) - START = d  <=>  (2d-1)*FSS <= 2*i*EM < (2d+1)*FSS,
    so the only candidate is i = ceil((2d-1)*FSS / (2*EM)) (0 when d = 0).
    Valid for EM >= FSS (scenario C), where the step is at least one.
    """
    r, em_, fss_, st = (_c(x).cast("bigint") for x in (rank, em, fss, start))
    d = r - st
    cand = F.when(d <= 0, F.lit(0).cast("bigint")).otherwise(_sql_div((d * 2 - 1) * fss_ + em_ * 2 - 1, em_ * 2))
    ok = (d >= 0) & (cand < fss_) & (position_of(cand, em_, fss_, st) == r)
    return F.when(ok, cand)
