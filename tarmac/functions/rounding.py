"""Rounding that two engines agree on, for result comparison.

``round_sig`` keeps ``digits`` significant digits by printing the value in scientific
notation and parsing it back: both Java's formatter and C's printf round the exact
binary value, so engines agree wherever they computed the same double. ``+ 0.0``
turns -0.0 into 0.0. The ``sql_*`` twins produce the same expressions as SQL text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_dp(c: str | Column, decimals: int) -> Column:
    return F.round(_col(c).cast("double"), decimals) + F.lit(0.0)


def round_sig(c: str | Column, digits: int = 9) -> Column:
    x = _col(c).cast("double")
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
        F.format_string(f"%.{digits - 1}e", x).cast("double") + F.lit(0.0)
    )


def sql_round_dp(expr: str, decimals: int) -> str:
    return f"(round(CAST({expr} AS DOUBLE), {decimals}) + 0.0)"


def sql_round_sig(expr: str, digits: int = 9) -> str:
    return f"(CAST(printf('%.{digits - 1}e', CAST({expr} AS DOUBLE)) AS DOUBLE) + 0.0)"
