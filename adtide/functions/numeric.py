"""Exact sums, averages and rounding.

Arguments are SQL expressions over the columns of the DataFrame at hand.

Money and conversion counts are stored as DOUBLE. Adding doubles gives a result
that depends on the order of the rows, and a shuffle changes that order, so sums
go through whole units, millionths and millionths of those held in BIGINT: exact to
twelve decimals, order-free, and kept in the primitive buffers of a code-generated
hash aggregate.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS = 1_000_000


def micros_to_currency(expression: str) -> Column:
    """Platform cost in millionths of a currency unit as a DOUBLE amount."""
    return F.expr(f"({expression}) / {MICROS}D")


# Values from here on, and NaN, which compares as greater, are added as plain doubles.
LARGE = "1e12D"


def _sum_text(expression: str) -> str:
    value = f"CAST(({expression}) AS DOUBLE)"
    small = f"abs({value}) < {LARGE}"
    units = f"floor({value})"
    millionths = f"(({value} - {units}) * {MICROS}D)"
    # an amount of six decimals is off by its binary rounding only
    even = f"abs({millionths} - rint({millionths})) <= abs({value}) * {MICROS}D * 4.5e-16D"
    whole = f"CASE WHEN {even} THEN rint({millionths}) ELSE floor({millionths}) END"
    rest = f"CASE WHEN {even} THEN 0D ELSE rint(({millionths} - floor({millionths})) * {MICROS}D) END"

    def limb(part: str, unit: str) -> str:
        held = f"CASE WHEN {small} THEN CAST({part} AS BIGINT) END"
        return f"CAST(sum({held}) AS DECIMAL(20,0)) * {unit}BD"

    limbs = f"{limb(units, '1')} + {limb(whole, '0.000001')} + {limb(rest, '0.000000000001')}"
    exact = f"CAST({limbs} AS DOUBLE)"
    large = f"sum(CASE WHEN NOT ({small}) THEN {value} END)"
    return f"CASE WHEN {large} IS NULL THEN {exact} ELSE coalesce({exact}, 0D) + {large} END"


def exact_sum(expression: str) -> Column:
    """Aggregate: sum of a DOUBLE to twelve decimals, independent of row order.

    Each BIGINT sum holds 9 million rows of the largest amount there is below ``LARGE``,
    and fails beyond rather than overflow. Larger amounts, infinities and NaN give what a plain sum gives.
    """
    return F.expr(_sum_text(expression))


def exact_avg(expression: str) -> Column:
    """Aggregate: average over the non-NULL values, built on ``exact_sum``."""
    return F.expr(f"({_sum_text(expression)}) / nullif(count({expression}), 0)")


def _round_text(expression: str, digits: int) -> str:
    return f"CAST(round(CAST(({expression}) AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def exact_round(expression: str, digits: int) -> Column:
    """SQL ``numeric`` rounding of a DOUBLE: decimal digits, half away from zero."""
    return F.expr(_round_text(expression, digits))


def ratio(top: str, bottom: str, digits: int) -> Column:
    """Rounded quotient that is NULL where the divisor is zero."""
    return exact_round(f"({top}) / nullif(CAST(({bottom}) AS DOUBLE), 0D)", digits)


def _binary_round_text(expression: str, digits: int) -> str:
    scale = f"{10**digits}D"
    value = f"CAST(({expression}) AS DOUBLE)"
    scaled = f"({value} * {scale})"
    below = f"CAST(floor({scaled}) AS DOUBLE)"
    spread = f"({value} * 134217729D)"  # 2^27 + 1
    high = f"({spread} - ({spread} - {value}))"
    error = f"(({high} * {scale} - {scaled}) + ({value} - {high}) * {scale})"
    return f"""CASE WHEN {scaled} - {below} <> 0.5D THEN rint({scaled})
                    WHEN {error} > 0D THEN {below} + 1D
                    WHEN {error} < 0D THEN {below}
                    ELSE rint({scaled}) END / {scale}"""


def binary_round(expression: str, digits: int) -> Column:
    """Round the exact binary value, ties to even, as IEEE-correct formatters do.

    ``2.675`` is stored slightly below 2.675, so two digits give 2.67; SQL rounding
    works on the printed digits and gives 2.68. The scaled value decides unless it
    lands on a half; then the error of the multiplication, recovered exactly by
    splitting the value into two 26-bit parts, tells on which side it lies.
    """
    return F.expr(_binary_round_text(expression, digits))


def fixed_text(expression: str, digits: int) -> Column:
    """Text with exactly ``digits`` decimals, rounded by ``binary_round``."""
    rounded = _binary_round_text(expression, digits)
    return F.expr(f"CAST(CAST({rounded} AS DECIMAL(38,{digits})) AS STRING)")
