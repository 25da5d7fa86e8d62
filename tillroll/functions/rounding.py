"""Exact rounding in integer arithmetic.

The cube's means and sums are specified as ``round(avg(x), 1)`` and
``round(sum(x), 1)`` cast to long. Done in doubles, the result of a tie
depends on summation order and so on partitioning. Here amounts of any number of decimals
are summed exactly (``exact_sums``) and every rounding is one integer division at
the end, so results are the same on any number of partitions and equal to an
independent SQL engine.

All rounding is half away from zero, as Spark's ``round`` does. The helpers
return Spark SQL expression text (arguments are expression text too), so a
whole formula reaches the JVM as one expression (``F.expr``/``selectExpr``).
"""

from __future__ import annotations

from pyspark.sql import types as T


def sign(x: str) -> str:
    """-1 for negative ``x``, else 1 (bigint; ``signum`` would give a double)."""
    return f"(CASE WHEN ({x}) < 0 THEN -1L ELSE 1L END)"


def half_up(num: str, den: str) -> str:
    """round(num / den), half away from zero, for integer ``num`` and positive
    integer ``den``. Null when ``den`` is null, so pass ``nullif(count, 0)``
    for groups that may be empty."""
    return f"({sign(num)} * ((2 * abs({num}) + ({den})) div (2 * ({den}))))"


def toward_zero(num: str, den: str) -> str:
    """num / den truncated toward zero, as a cast to long does."""
    return f"({sign(num)} * (abs({num}) div ({den})))"


#: Decimals that are summed exactly; a value with more is rounded to them first.
DECIMALS = 12
_MICRO = 1_000_000
_UNIT = 10 ** DECIMALS


def exact_sums(amount: str, kind: T.DataType) -> dict[str, str]:
    """Partial sums of a number column (name -> aggregate) that hold its exact total.

    A number of at most six decimals, by far the usual case, is a whole count of millionths:
    its units and its millionths are summed as longs, which neither overflow nor round. A double
    is such a number if it is the double nearest to that count over a million. All
    other values are summed as ``decimal(28, 12)`` of the shortest decimal that prints the double. Sums of
    integers and decimals don't depend on the order, so the total doesn't either.
    """
    if isinstance(kind, T.DecimalType):
        fits = kind.scale <= 6 and kind.precision - kind.scale <= 12
        count, fine = f"CAST(({amount}) * {_MICRO} AS BIGINT)", str(fits).lower()
    else:
        small = f"abs({amount}) < 9.0E9D"  # counts below 2**53 are exact doubles
        count = f"CASE WHEN {small} THEN CAST(rint(({amount}) * {_MICRO}) AS BIGINT) END"
        fine = f"({small} AND rint(({amount}) * {_MICRO}) / {_MICRO}.0D = ({amount}))"
    return {
        "_units": f"sum(CASE WHEN {fine} THEN ({count}) div {_MICRO} END)",
        "_millionths": f"sum(CASE WHEN {fine} THEN ({count}) % {_MICRO} END)",
        "_others": f"sum(CASE WHEN NOT {fine} THEN CAST(({amount}) AS DECIMAL(28,{DECIMALS})) END)",
    }


#: Columns that turn the sums into the total, its sign, and its size as whole units and parts of
#: ``10 ** -DECIMALS``; each step reads the one before.
EXACT_TOTAL = [
    {"_total": f"CAST(coalesce(_units, 0) AS DECIMAL(34,{DECIMALS})) + CAST("
               f"CAST(coalesce(_millionths, 0) AS DECIMAL(19,0)) * CAST(0.000001 AS DECIMAL(6,6)) AS "
               f"DECIMAL(34,{DECIMALS})) + CAST(coalesce(_others, 0) AS DECIMAL(34,{DECIMALS}))"},
    {"_sign": "CASE WHEN _total < 0 THEN -1L ELSE 1L END", "_whole": "CAST(abs(_total) AS BIGINT)"},
    {"_parts": f"CAST((abs(_total) - CAST(_whole AS DECIMAL(19,0))) * CAST({_UNIT} AS DECIMAL(13,0)) "
               "AS BIGINT)"},
]


def total_tenths(count: str) -> str:
    """round(total / count, 1) in tenths, half away from zero, of the columns of EXACT_TOTAL.
    Whole numbers only: the fraction of a tenth can't lift the floor of a division by ``2 * count``."""
    return (f"(_sign * ((20 * _whole + ({count}) + (20 * _parts) div {_UNIT}) div (2 * ({count}))))")


def tenths(x_tenths: str) -> str:
    """A count of tenths as the double the reference's ``round(.., 1)`` gives."""
    return f"(({x_tenths}) / 10.0D)"


def mean_tenths(total: str, count: str) -> str:
    """round(total / count, 1) in tenths, for integer ``total`` in tenths."""
    return half_up(total, f"nullif({count}, 0)")
