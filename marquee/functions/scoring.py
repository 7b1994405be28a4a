"""Score arithmetic shared by recommenders and evaluation (S-10 ... S-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def value_similarity(diff: Column, max_diff: Column, eps: float = 1e-10) -> Column:
    """S-10: ``1 - d / (max d + eps)``; ``try_divide`` keeps eps=0 safe under ANSI."""
    return F.lit(1.0) - F.coalesce(F.try_divide(diff, max_diff + F.lit(eps)), F.lit(0.0))


def distance_similarity(d: Column) -> Column:
    """S-11: distance to similarity."""
    return F.lit(1.0) - d


def clamp_max(c: Column, hi: float) -> Column:
    """S-14: ``min(hi, c)``."""
    return F.least(c, F.lit(hi))


def precision_bonus(precision_pct: Column, full_at: float = 70.0, bonus: float = 15.0) -> Column:
    """S-15: full bonus at ``full_at`` %, proportional below."""
    return F.when(precision_pct >= full_at, F.lit(bonus)).otherwise(precision_pct / full_at * bonus)


def speed_bonus(ms: Column) -> Column:
    """S-15: 5 below 50 ms, 3 below 100 ms, otherwise 1."""
    return F.when(ms < 50, F.lit(5.0)).when(ms < 100, F.lit(3.0)).otherwise(F.lit(1.0))
