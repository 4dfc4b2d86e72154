"""SQL text for wide projections.

A column object costs several calls into the JVM to build, which adds up when a plan has
hundreds of output columns; one text per column costs a single call.
"""

from __future__ import annotations

import math

# Terms that a sum spells out as a chain; longer sums give the same digits in another form.
CHAIN = 200


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def number(x: float) -> str:
    x = float(x)
    if math.isfinite(x):
        return f"{x!r}D"
    return "double('NaN')" if math.isnan(x) else f"double('{'-' if x < 0 else ''}Infinity')"


def literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int):
        return f"{value}L" if abs(value) > 2**31 - 1 else str(value)
    if isinstance(value, float):
        return number(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def alias(expression: str, column: str) -> str:
    return f"{expression} AS {name(column)}"


def dot(names, weights, intercept: float) -> str:
    """intercept + sum of weight * column, skipping zero weights.

    Many terms are added by a fold over an array: a chain of that many plus signs is too deep to parse.
    """
    used = [(f"CAST({name(c)} AS DOUBLE)", number(w)) for c, w in zip(names, weights, strict=True) if w != 0.0]
    if len(used) <= CHAIN:
        return " + ".join([number(intercept), *(f"{w} * {c}" for c, w in used)])
    columns, factors = (", ".join(part) for part in zip(*used))
    return (f"aggregate(zip_with(array({columns}), array({factors}), (x, w) -> w * x), {number(intercept)}, "
            "(total, term) -> total + term)")


def yeo_johnson(x: str, lam: float) -> str:
    """The same as the column form, for a known lambda."""
    def branch(size, power):
        log = f"log1p({size})"
        return log if power == 0 else f"expm1(least({number(power)} * {log}, 700D)) / {number(power)}"

    return f"CASE WHEN {x} >= 0 THEN {branch(x, lam)} ELSE -({branch(f'-({x})', 2.0 - lam)}) END"
