"""Numeric helpers: coercion, exact-order rounding, ratios, overs notation.

Arguments are SQL expressions over the frame's columns, not user input; each helper
makes one parsed expression, which keeps plans with dozens of them cheap to build.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def to_int_sql(leaf: str) -> str:
    return f"try_variant_get({leaf}, '$', 'int')"


def to_int(leaf: str) -> Column:
    """Integer or NULL from a raw leaf, a variant.

    A JSON number is cut to its whole part and a text must be a whole number: ``12.7``
    gives 12, ``"12"`` gives 12, and ``"12.7"`` gives NULL.
    """
    return F.expr(to_int_sql(leaf))


def to_flag_sql(leaf: str) -> str:
    """Boolean from the text of a raw leaf: NULL unless it is true or false."""
    return f"CASE {leaf} WHEN 'true' THEN true WHEN 'false' THEN false END"


def to_list_sql(leaf: str) -> str:
    """List of texts from the text of a raw leaf; a lone text is a list of one."""
    return (
        f"CASE WHEN startswith({leaf}, '[') THEN from_json({leaf}, 'array<string>') "
        f"WHEN {leaf} IS NOT NULL THEN array({leaf}) END"
    )


def round_half_up_sql(x: str, scale: int) -> str:
    step = f"{10**scale}D"
    return f"(cast(floor(({x}) * {step} + 0.5D) AS double) / {step})"


def round_half_up(x: str, scale: int) -> Column:
    """Round a non-negative double by binary scaling.

    ``round`` on doubles goes through the shortest decimal text; scaling in binary
    gives what engines with a plain floating-point round give, bit for bit.
    """
    return F.expr(round_half_up_sql(x, scale))


def ratio_sql(
    num: str,
    den: str,
    scale: int | None = 2,
    times: float | None = None,
    then_times: float | None = None,
) -> str:
    top = f"cast({num} AS double)" + (f" * {float(times)}D" if times is not None else "")
    out = f"{top} / nullif(cast({den} AS double), 0D)"
    if then_times is not None:
        out = f"{out} * {float(then_times)}D"
    return f"({out})" if scale is None else round_half_up_sql(out, scale)


def ratio(
    num: str,
    den: str,
    scale: int | None = 2,
    times: float | None = None,
    then_times: float | None = None,
) -> Column:
    """``num * times / den * then_times`` as double; NULL when ``den`` is zero or NULL.

    The two factors differ only in the order of floating-point operations.
    """
    return F.expr(ratio_sql(num, den, scale, times, then_times))


def count_when(cond: str) -> Column:
    """Rows satisfying ``cond``; zero, not NULL, when none does (but NULL on no rows)."""
    return F.expr(f"sum(CASE WHEN {cond} THEN 1 ELSE 0 END)")


def flag_sum(cond: str) -> Column:
    """Sum of a three-valued flag: unknown rows are skipped, all unknown gives NULL."""
    return F.expr(f"sum(cast(({cond}) AS int))")


def overs_sql(balls: str, per_over: int = 6) -> str:
    return f"concat({balls} div {per_over}, '.', {balls} % {per_over})"


def format_overs(balls: str, per_over: int = 6) -> Column:
    """Ball count as ``overs.balls`` text, e.g. 25 -> ``4.1``."""
    return F.expr(overs_sql(balls, per_over))


def overs_decimal(balls: str, per_over: str) -> Column:
    """Ball count as the number ``overs.balls``, e.g. 25 at 6 an over -> 4.1."""
    per = f"nullif({per_over}, 0)"
    return F.expr(
        f"cast(floor(cast({balls} AS double) / {per}) AS double) + cast({balls} % {per} AS double) * 0.1D"
    )


def named(**expressions: str) -> list[Column]:
    """Columns from SQL expressions by name."""
    return [F.expr(f"{sql} AS `{name}`") for name, sql in expressions.items()]
