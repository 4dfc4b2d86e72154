"""Exact order statistics and curve fits over whole columns, in a few bounded passes.

Every fit below starts from weighted values (column number, x, n). A column with few
distinct values is counted first, so later passes read the counts; a column with many
is read as it is, since counting it would shuffle every row for nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import text
from ..functions.columns import col
from ..session import kept, small_frame

# Columns with at most this many distinct values (estimated) are counted first.
FEW_VALUES = 10_000
# Steps of the sketch that brackets a quantile.
GRID = 256


class Range(NamedTuple):
    n: int
    low: float
    high: float
    mean: float
    std: float
    distinct: int


def ranges(df: DataFrame, columns: Sequence[str]) -> list[Range]:
    """Count, extremes, moments and distinct estimate of each column; one aggregate. NaN and
    infinite values count as missing, here and in all fits of this module."""
    aggs = []
    for i, c in enumerate(columns):
        x = f"CAST({text.name(c)} AS DOUBLE)"
        x = f"CASE WHEN abs({x}) < double('Infinity') THEN {x} END"
        aggs += [F.expr(f"{f}({x}) AS {name}{i}") for f, name in (
            ("count", "n"), ("min", "lo"), ("max", "hi"), ("avg", "mean"), ("stddev_pop", "std"),
            ("approx_count_distinct", "d"))]
    row = df.agg(*aggs).first()
    return [Range(row[f"n{i}"], row[f"lo{i}"], row[f"hi{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"d{i}"])
            for i in range(len(columns))]


@contextmanager
def weighted_values(df: DataFrame, columns: Sequence[str], found: Sequence[Range], y: str | None = None):
    """Frame (which, x, n) of non-missing values; with ``y`` also its sum and sum of
    squares per row, over rows where both are present. Columns without values are absent."""
    def long(indices):
        entries = [F.struct(F.lit(i).alias("which"), col(columns[i]).cast("double").alias("x")) for i in indices]
        picked = [F.explode(F.array(*entries)).alias("e")]
        if y:
            picked.append(col(y).cast("double").alias("y"))
        rows = df.select(*picked).select("e.which", "e.x", *(["y"] if y else [])).where("abs(x) < double('Infinity')")
        return rows.where("abs(y) < double('Infinity')") if y else rows

    few = [i for i, r in enumerate(found) if r.n and r.distinct <= FEW_VALUES]
    many = [i for i, r in enumerate(found) if r.n and r.distinct > FEW_VALUES]
    y_sums = [F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy")] if y else []
    y_each = [F.col("y").alias("sy"), (F.col("y") * F.col("y")).alias("syy")] if y else []
    each = long(many).select("which", "x", F.lit(1).cast("bigint").alias("n"), *y_each) if many else None
    if not few:
        yield each
        return
    with kept(long(few).groupBy("which", "x").agg(F.count(F.lit(1)).alias("n"), *y_sums)) as counted:
        yield counted if each is None else counted.unionByName(each)


def exact_quantiles(df: DataFrame, columns: Sequence[str], qs: Sequence[float]) -> list[dict]:
    """Per column {q: (x at rank k, x at rank k+1, share of the second)}."""
    with kept(df.select([col(c) for c in dict.fromkeys(columns)])) as source:
        found = ranges(source, columns)
        with weighted_values(source, columns, found) as values:
            return quantiles_of(values, found, range(len(columns)), qs)


class Bracket(NamedTuple):
    """Where a quantile lies: values from low to high, of which there are ``n``, and ``below`` smaller ones."""
    low: float
    high: float
    below: int
    n: int


def quantiles_of(values: DataFrame | None, found: Sequence[Range], which: Iterable[int],
                 qs: Sequence[float]) -> list[dict]:
    """``exact_quantiles`` of some of the weighted columns.

    A sketch brackets every quantile and one exact count says which ranks the bracket holds; the count
    corrects the sketch, so the result is exact. A bracket of few values is then put in order. Each round takes
    two passes for all columns and shrinks a bracket about a hundredfold, whatever the values: columns
    of up to some million rows take three passes in all.
    """
    which, brackets = list(which), {}
    spots = {(i, q): q * (found[i].n - 1) for i in which if found[i].n for q in qs}
    for i, q in spots:
        r = found[i]
        brackets[i, q] = Bracket(r.low, r.high, 0, r.n)
    ranks = {key: (math.floor(s), min(math.floor(s) + 1, found[key[0]].n - 1)) for key, s in spots.items()}
    wide = {i for i in which if found[i].n and found[i].distinct > FEW_VALUES}
    first = True
    while open_ := {k: b for k, b in brackets.items() if k[0] in wide and b.n > FEW_VALUES and b.low < b.high}:
        _tighten(values, brackets, open_, ranks, first)
        first = False
    picked = _pick(values, brackets, ranks) if brackets else {}
    return [{q: (*(picked[i, q][k] for k in ranks[i, q]), spots[i, q] - ranks[i, q][0]) for q in qs if (i, q) in spots}
            for i in which]


def _within(values: DataFrame, brackets: dict) -> DataFrame:
    """Rows by the bracket (which, q) that they lie in."""
    rows = [(i, q, float(b.low), float(b.high)) for (i, q), b in brackets.items()]
    targets = F.broadcast(small_frame(values.sparkSession, rows, "which int, q double, lo double, hi double"))  # columns x quantiles
    return values.join(targets, "which")


def _tighten(values: DataFrame, brackets: dict, open_: dict, ranks: dict, first: bool) -> None:
    grid = F.percentile_approx("x", [j / GRID for j in range(GRID + 1)], 50 * GRID).alias("grid")
    if first:  # every bracket is the whole column still
        found = {r["which"]: r["grid"] for r in values.where(F.col("which").isin(sorted({i for i, _ in open_})))
                 .groupBy("which").agg(grid).collect()}
        grids = {(i, q): found[i] for i, q in open_}
    else:
        inside = _within(values, open_).where("x >= lo and x <= hi")
        grids = {(r["which"], r["q"]): r["grid"] for r in inside.groupBy("which", "q").agg(grid).collect()}
    inner = {}
    for key, b in open_.items():
        low, high = ((r - b.below) / b.n * GRID for r in ranks[key])
        points = grids[key]
        inner[key] = Bracket(points[max(math.floor(low) - 1, 0)], points[min(math.ceil(high) + 1, GRID)], 0, 0)
        if inner[key][:2] == b[:2]:  # nearly all of the bracket is one value: set it apart
            inner[key] = Bracket(points[GRID // 2], points[GRID // 2], 0, 0)
    outer = {key: brackets[key] for key in open_}
    parts = {"left": F.col("x") < F.col("lo"), "mid": (F.col("x") >= F.col("lo")) & (F.col("x") <= F.col("hi")),
             "right": F.col("x") > F.col("hi")}
    aggs = [f(F.when(test, F.col(c))).alias(f"{name}_{part}") for part, test in parts.items()
            for name, f, c in (("n", F.sum, "n"), ("lo", F.min, "x"), ("hi", F.max, "x"))]
    rows = [(i, q, float(b.low), float(b.high)) for (i, q), b in outer.items()]
    span = F.broadcast(small_frame(values.sparkSession, rows, "which int, q double, outer_lo double, outer_hi double"))
    counted = (_within(values, inner).join(span, ["which", "q"]).where("x >= outer_lo and x <= outer_hi")
               .groupBy("which", "q").agg(*aggs).collect())
    for r in counted:
        key, below = (r["which"], r["q"]), outer[r["which"], r["q"]].below
        k, last = ranks[key]
        for part in parts:
            n = r[f"n_{part}"] or 0
            if n and below <= k and last < below + n:
                brackets[key] = Bracket(r[f"lo_{part}"], r[f"hi_{part}"], below, n)
                break
            below += n
        else:  # the two ranks lie in two parts: they are the neighbours at the border
            left = max(r[f"hi_{p}"] for p in parts if r[f"n_{p}"] and _upto(r, p, outer[key].below) <= k)
            right = min(r[f"lo_{p}"] for p in parts if r[f"n_{p}"] and _upto(r, p, outer[key].below) > k)
            at_left = sum(r[f"n_{p}"] or 0 for p in parts if r[f"n_{p}"] and r[f"hi_{p}"] <= left)
            brackets[key] = Bracket(left, right, outer[key].below + at_left - 1, 2)


def _upto(row, part: str, below: int) -> int:
    """Rank of the first value of a part."""
    for name in ("left", "mid", "right"):
        if name == part:
            return below
        below += row[f"n_{name}"] or 0
    return below


def _pick(values: DataFrame, brackets: dict, ranks: dict) -> dict:
    """{bracket: {rank: value}}, from the ordered values of each bracket: at most about FEW_VALUES different ones."""
    out = {key: {k: b.low for k in ranks[key]} for key, b in brackets.items() if b.low == b.high or b.n <= 0}
    for key, b in brackets.items():
        if b.n == 2 and b.low < b.high:
            out[key] = {k: (b.low if k <= b.below else b.high) for k in ranks[key]}
    rest = {key: b for key, b in brackets.items() if key not in out}
    if not rest:
        return out
    ordered = Window.partitionBy("which", "q").orderBy("x")
    inside = (_within(values, rest).where("x >= lo and x <= hi").groupBy("which", "q", "x").agg(F.sum("n").alias("n"))
              .withColumn("upto", F.sum("n").over(ordered)))
    wanted = [(i, q, k - b.below) for (i, q), b in rest.items() for k in dict.fromkeys(ranks[i, q])]
    places = F.broadcast(small_frame(values.sparkSession, wanted, "which int, q double, k bigint"))  # columns x quantiles x 2
    for r in inside.join(places, ["which", "q"]).where("k < upto and k >= upto - n").select("which", "q", "k", "x").collect():
        key = r["which"], r["q"]
        out.setdefault(key, {})[r["k"] + rest[key].below] = r["x"]
    return out


def between(low: float, high: float, share: float) -> float:
    """Linear interpolation between neighboring order statistics."""
    return low + (high - low) * share


# --- power transform ---------------------------------------------------------

def yeo_johnson(x: Column, lam: Column) -> Column:
    """Yeo-Johnson (2000). The exponent is clipped so that the result stays finite."""
    up, down = lam, F.lit(2.0) - lam

    def branch(size, power):
        # log1p and expm1 keep the digits near power = 0
        log = F.log1p(size)
        return F.when(power == 0.0, log).otherwise(F.expm1(F.least(power * log, F.lit(700.0))) / power)

    return F.when(x >= 0, branch(x, up)).otherwise(-branch(-x, down))


def yeo_johnson_inverse(t: Column, lam: float) -> Column:
    lam = float(lam)
    other = 2.0 - lam
    up = F.expm1(t) if lam == 0 else F.expm1(F.log1p(F.lit(lam) * t) / F.lit(lam))
    down = -F.expm1(-t) if other == 0 else -F.expm1(F.log1p(F.lit(-other) * t) / F.lit(other))
    return F.when(t >= 0, up).otherwise(down)


def yeo_johnson_likelihood(values: DataFrame, means: Sequence[float], starts: Sequence[float],
                           step: float, points: int) -> dict:
    """{(column, grid point): log-likelihood} for lambda = start + point * step.

    The grid is exploded, so one pass serves every column and candidate. Transformed
    values are taken relative to the transformed mean: for strongly negative lambda they
    differ only in their last digits otherwise.
    """
    x, which = F.col("x"), F.col("which")
    center = F.array(*[F.lit(float(m)) for m in means])[which]
    start = F.array(*[F.lit(float(s)) for s in starts])[which]
    lam = F.col("lam")
    offset = (values.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
              .withColumn("lam", F.round(start + F.col("point") * F.lit(float(step)), 12))
              .withColumn("d", yeo_johnson(x, lam) - yeo_johnson(center, lam)))
    n, d = F.col("n"), F.col("d")
    out = {}
    for row in (offset.groupBy("which", "point")
                .agg(F.sum("n").alias("n"), F.sum(n * d).alias("s1"), F.sum(n * d * d).alias("s2"),
                     F.sum(n * F.signum(x) * F.log1p(F.abs(x))).alias("logs"))
                .collect()):
        variance = row["s2"] / row["n"] - (row["s1"] / row["n"]) ** 2
        lam_value = round(starts[row["which"]] + row["point"] * step, 12)
        if variance > 0:
            out[row["which"], row["point"]] = (
                lam_value, -row["n"] / 2 * math.log(variance) + (lam_value - 1) * row["logs"])
    return out


def fit_yeo_johnson(df: DataFrame, columns: Sequence[str], refine: int = 2) -> list[tuple[float, float | None]]:
    """(lambda, log-likelihood) per column: the grid -2..2 by 0.1, then ``refine`` rounds
    that are ten times finer around the best, then the top of the parabola through the
    best three points. A constant or empty column keeps lambda 1."""
    with kept(df.select([col(c) for c in dict.fromkeys(columns)])) as source:
        found = ranges(source, columns)
        with weighted_values(source, columns, found) as values:
            return lambdas_of(values, found, range(len(columns)), refine)


def lambdas_of(values: DataFrame | None, found: Sequence[Range], which: Iterable[int],
               refine: int = 2) -> list[tuple[float, float | None]]:
    """``fit_yeo_johnson`` of some of the weighted columns."""
    which, best = list(which), {}
    if values is None or not which:
        return [(1.0, None)] * len(which)
    means = [r.mean if r.mean is not None else 0.0 for r in found]
    values = values.where(F.col("which").isin(which))
    starts, step, points = [-2.0] * len(found), 0.1, 41
    for round_ in range(refine + 1):
        curve = yeo_johnson_likelihood(values, means, starts, step, points)
        for (i, _), (lam, score) in sorted(curve.items()):
            rounded = round(score, 3) if round_ == 0 else score
            if i not in best or rounded > best[i][1]:
                best[i] = (lam, rounded)
        if round_ == refine:
            if refine:
                _parabola(curve, best, step)
            break
        starts = [best.get(i, (1.0,))[0] - step for i in range(len(found))]
        step, points = step / 10, 21
        best = {i: (lam, -math.inf) for i, (lam, _) in best.items()}
    return [best.get(i, (1.0, None)) for i in which]


def _parabola(curve: dict, best: dict, step: float) -> None:
    by_column: dict = {}
    for (i, point), value in curve.items():
        by_column.setdefault(i, {})[point] = value
    for i, points in by_column.items():
        top = max(points, key=lambda p: points[p][1])
        if top - 1 in points and top + 1 in points:
            left, mid, right = (points[top + s][1] for s in (-1, 0, 1))
            bend = left - 2 * mid + right
            if bend < 0:
                best[i] = (points[top][0] + step * 0.5 * (left - right) / bend, mid)


# --- best exponent -----------------------------------------------------------

def power_curve(values: DataFrame, grid: Sequence[float]) -> DataFrame:
    """R2 of y ~ 1 + x^p per (column, exponent) from weighted values with y sums."""
    points = F.array(*[F.struct(F.lit(j).alias("j"), F.lit(float(p)).alias("p")) for j, p in enumerate(grid)])
    t, n = F.pow(F.col("x"), F.col("g.p")), F.col("n")
    sums = (values.withColumn("g", F.explode(points)).withColumn("t", t)
            .groupBy("which", F.col("g.j").alias("j"), F.col("g.p").alias("p"))
            .agg(F.sum("n").alias("n"), F.sum(n * F.col("t")).alias("st"), F.sum(n * F.col("t") * F.col("t")).alias("stt"),
                 F.sum(F.col("t") * F.col("sy")).alias("sty"), F.sum("sy").alias("sy"), F.sum("syy").alias("syy")))
    count = F.col("n").cast("double")
    cross = F.col("sty") - F.col("st") * F.col("sy") / count
    spread = (F.col("stt") - F.col("st") * F.col("st") / count) * (F.col("syy") - F.col("sy") * F.col("sy") / count)
    return sums.select("which", "j", "p", F.when(spread > 0, cross * cross / spread).alias("r2"))


def best_powers(df: DataFrame, columns: Sequence[str], y: str, grid: Sequence[float]) -> list[tuple[float, float]]:
    """(exponent, R2) per column; the first exponent on ties at six digits."""
    with kept(df.select(*[col(c) for c in dict.fromkeys([*columns, y])])) as source:
        found = ranges(source, columns)
        with weighted_values(source, columns, found, y) as values:
            if values is None:
                return [(float("nan"), float("nan"))] * len(columns)
            r2 = F.round("r2", 6)
            rows = (power_curve(values, grid).where("r2 is not null").groupBy("which")
                    .agg(F.max_by(F.struct("p", r2.alias("r2")), F.struct(r2, -F.col("j"))).alias("top")).collect())
    top = {r["which"]: (r["top"]["p"], r["top"]["r2"]) for r in rows}
    return [top.get(i, (float("nan"), float("nan"))) for i in range(len(columns))]


def linspace(low: float, high: float, points: int) -> list[float]:
    """low + (high - low) * i / (points - 1), in that order of operations."""
    return [low + (high - low) * (i / (points - 1)) for i in range(points)]
