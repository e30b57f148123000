"""Integer and IEEE rounding as Spark SQL expressions.

Arguments and results are SQL texts: an expression with hundreds of nodes is
then handed to Spark in one call, while building it from Column objects takes
one call per node and costs more than scoring a small table.
"""

from __future__ import annotations

from collections.abc import Iterable


def literal(value: str | int | float) -> str:
    """SQL literal of a text or number."""
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else str(value)


def literals(values: Iterable[str | int | float]) -> str:
    return ", ".join(literal(value) for value in values)


def lookup(table: dict[str, int] | dict[str, str], key: str) -> str:
    """Value of ``key`` in a constant map, else null."""
    return f"element_at(map({literals(x for pair in table.items() for x in pair)}), {key})"


def bind(name: str, value: str, body: str) -> str:
    """``body``, in which ``name`` stands for ``value``, computed once.

    A lambda variable cannot be inlined, so the optimizer never copies an
    expensive value into each place that uses it.
    """
    return f"transform(array({value}), {name} -> {body})[0]"


def half_up_ratio(numerator: str, denominator: str, scale: int) -> str:
    """``numerator / denominator`` in units of 1/scale, rounded half away from zero.

    Both must be integers, the denominator above zero; the result is exact.
    """
    size = f"((abs({numerator}) * {2 * scale} + ({denominator})) div (({denominator}) * 2))"
    return f"(CASE WHEN ({numerator}) < 0 THEN -{size} ELSE {size} END)"


def percent(part: str, total: str, rounding: str = "exact", digits: int = 1) -> str:
    """Percentage; 0.0 where the total is zero."""
    if rounding == "binary":
        value = round_binary(f"(CAST(coalesce({part}, 0) AS DOUBLE) / greatest({total}, 1) * 100)", digits)
    else:
        value = half_up_ratio(f"coalesce({part}, 0) * 100", f"greatest({total}, 1)", 10**digits) + f" / {float(10**digits)}D"
    return f"(CASE WHEN {total} > 0 THEN {value} ELSE 0.0D END)"


def mean_milli(sum_milli: str, total: str, rounding: str = "exact") -> str:
    """Mean of values kept as thousandths, to three decimals; 0.0 on no rows."""
    if rounding == "binary":
        value = round_binary(f"(coalesce({sum_milli}, 0) / 1000.0D / greatest({total}, 1))", 3)
    else:
        value = half_up_ratio(f"coalesce({sum_milli}, 0)", f"greatest({total}, 1)", 1) + " / 1000.0D"
    return f"(CASE WHEN {total} > 0 THEN {value} ELSE 0.0D END)"


def to_milli(value: str) -> str:
    """A three-decimal double as an exact count of thousandths."""
    return f"CAST(round({value} * 1000) AS BIGINT)"


def round_binary(value: str, digits: int, ties_even: bool = True) -> str:
    """Round the exact binary value of a double, ties to even or away from zero.

    ``round`` and ``bround`` see the shortest decimal form, in which 2.675 is a
    tie; its binary value lies below the tie. Multiplying in two halves gives
    the product and its rounding error, and the error decides such cases.
    """
    scale = literal(float(10**digits))
    size = f"abs({value})"
    high = f"({size} * 134217729.0D - ({size} * 134217729.0D - {size}))"
    product = f"({size} * {scale})"
    error = f"(({high} * {scale} - {product}) + ({size} - {high}) * {scale})"
    down = f"floor({product})"
    rest = f"({product} - {down})"
    tie_up = f"({error} = 0 AND {down} % 2 = 1)" if ties_even else f"{error} = 0"
    up = f"({rest} > 0.5D OR ({rest} = 0.5D AND ({error} > 0 OR {tie_up})))"
    units = f"({down} + CASE WHEN {up} THEN 1 ELSE 0 END)"
    return f"(CASE WHEN {value} < 0 THEN -{units} ELSE {units} END / {scale})"
