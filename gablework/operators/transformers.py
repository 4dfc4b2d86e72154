"""Feature transformers: learned on one table, applied to any."""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import text
from ..functions.columns import col, log_of_positive
from ..session import rows_within
from ..stage import Fitted, Learner, unique
from . import distribution as D
from .profile import fit_moments
from .select import text_names

# All levels of all encoded columns together. More than this is no category.
MOST_LEVELS = 5_000


def _or_one(width: float | None) -> float:
    """A column without spread is centered only."""
    return float(width) if width else 1.0


# --- scaling -----------------------------------------------------------------

class ScaleModel(Fitted):
    """(x - center) / width per column."""

    def __init__(self, columns=(), centers=(), widths=()):
        super().__init__(**({"columns": list(columns), "centers": list(centers), "widths": list(widths)}
                            if columns else {}))

    def _each(self):
        return zip(self["columns"], self["centers"], self["widths"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (col(c) - F.lit(m)) / F.lit(w) for c, m, w in self._each()})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: col(c) * F.lit(w) + F.lit(m) for c, m, w in self._each()})


class StandardScale(Learner):
    """Mean 0 and population standard deviation 1."""

    def __init__(self, columns: Iterable[str] = ()):
        super().__init__(**({"columns": list(columns)} if columns else {}))

    def _fit(self, df: DataFrame) -> ScaleModel:
        columns = unique(self["columns"])
        found = fit_moments(df, columns)
        return ScaleModel(columns, [found[c][0] for c in columns], [_or_one(found[c][1]) for c in columns])


class RobustScale(Learner):
    """Median 0 and distance between the quartiles 1, with exact interpolated quantiles."""

    def __init__(self, columns: Iterable[str] = ()):
        super().__init__(**({"columns": list(columns)} if columns else {}))

    def _fit(self, df: DataFrame) -> ScaleModel:
        columns = unique(self["columns"])
        quartiles = [quartiles_of(spots) for spots in D.exact_quantiles(df, columns, QUARTILES)]
        return ScaleModel(columns, [q[1] for q in quartiles], [_or_one(q[2] - q[0]) for q in quartiles])


QUARTILES = (0.25, 0.5, 0.75)


def quartiles_of(spots: dict, change=lambda x: x) -> tuple[float, float, float]:
    """Interpolated quartiles of an increasing function of the column."""
    if not spots:
        return 0.0, 0.0, 0.0
    return tuple(D.between(change(spots[q][0]), change(spots[q][1]), spots[q][2]) for q in QUARTILES)


def yeo_johnson_value(x: float, lam: float) -> float:
    def branch(size, power):
        log = math.log1p(size)
        return log if power == 0 else math.expm1(min(power * log, 700.0)) / power

    return branch(x, lam) if x >= 0 else -branch(-x, 2.0 - lam)


class YeoJohnson(Learner):
    """Power transform toward a normal shape; lambda by maximum likelihood."""

    def __init__(self, columns: Iterable[str] = (), standardize: bool = False):
        super().__init__(**({"columns": list(columns), "standardize": standardize} if columns else {}))

    def _fit(self, df: DataFrame) -> YeoJohnsonModel:
        columns = unique(self["columns"])
        lambdas = [lam for lam, _ in D.fit_yeo_johnson(df, columns)]
        model = YeoJohnsonModel(columns, lambdas)
        if self["standardize"]:
            moments = fit_moments(model.transform(df.select([col(c) for c in columns])), columns)
            model = YeoJohnsonModel(columns, lambdas, [moments[c][0] for c in columns],
                                    [_or_one(moments[c][1]) for c in columns])
        return model


class YeoJohnsonModel(Fitted):
    def __init__(self, columns=(), lambdas=(), centers=None, widths=None):
        if not columns:
            super().__init__()
            return
        super().__init__(columns=list(columns), lambdas=list(lambdas),
                         centers=list(centers or [0.0] * len(columns)), widths=list(widths or [1.0] * len(columns)))

    def _each(self):
        return zip(self["columns"], self["lambdas"], self["centers"], self["widths"])

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({
            c: (D.yeo_johnson(col(c).cast("double"), F.lit(lam)) - F.lit(m)) / F.lit(w)
            for c, lam, m, w in self._each()})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: D.yeo_johnson_inverse(col(c) * F.lit(w) + F.lit(m), lam)
                               for c, lam, m, w in self._each()})


class LogZScore(Learner):
    """Natural log, then mean 0 and population standard deviation 1. Values of 0 or less are an error."""

    def __init__(self, columns: Iterable[str] = ()):
        super().__init__(**({"columns": list(columns)} if columns else {}))

    def _fit(self, df: DataFrame) -> LogZScoreModel:
        columns = unique(self["columns"])
        found = fit_moments(df.select([log_of_positive(col(c), c).alias(c) for c in columns]), columns)
        return LogZScoreModel(columns, [found[c][0] for c in columns], [_or_one(found[c][1]) for c in columns])


class LogZScoreModel(ScaleModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (log_of_positive(col(c), c) - F.lit(m)) / F.lit(w) for c, m, w in self._each()})

    def inverse(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.exp(col(c) * F.lit(w) + F.lit(m)) for c, m, w in self._each()})


# --- encoding ----------------------------------------------------------------

def learn_levels(df: DataFrame, columns: Sequence[str], most: int | None = None) -> list[list]:
    """Distinct non-missing values of each column in order; all columns in one pass. More than ``most``
    levels (MOST_LEVELS if not given) are an error. Dates, decimals and the like become text."""
    most = MOST_LEVELS if most is None else most
    if not columns:
        return []
    entries = [F.struct(F.lit(i).alias("which"), col(c).cast("string").alias("v")) for i, c in enumerate(columns)]
    found = rows_within(df.select(F.explode(F.array(*entries)).alias("e")).select("e.*")
                          .where("v is not null").distinct(), most)
    if found is None:
        raise ValueError(f"more than {most} levels in {list(columns)}: not categories")
    parse = {T.BooleanType: lambda v: v == "true", T.DoubleType: float, T.FloatType: float,
             **dict.fromkeys((T.ByteType, T.ShortType, T.IntegerType, T.LongType), int)}
    levels: list[list] = [[] for _ in columns]
    for row in found:
        levels[row["which"]].append(parse.get(type(df.schema[columns[row["which"]]].dataType), str)(row["v"]))
    return [sorted(v) for v in levels]


def level_name(column: str, level) -> str:
    return f"{column}_{str(level).lower() if isinstance(level, bool) else level}"


def place(column: str, levels: Sequence, unseen: str, label: str | None = None) -> str:
    """SQL for the position of a value among the levels from 1; 0 for an unseen or missing
    one, or an error if so wished."""
    if not levels:
        return "0L"
    c = text.name(column)
    if isinstance(levels[0], str):
        c = f"CAST({c} AS STRING)"
    found = f"coalesce(array_position(array({', '.join(map(text.literal, levels))}), {c}), 0L)"
    if unseen == "error":
        message = f"concat({text.literal(f'unseen level in {label or column}: ')}, coalesce(CAST({c} AS STRING), 'missing'))"
        found = f"nvl(nullif({found}, 0L), CAST(raise_error({message}) AS BIGINT))"
    return found


class OneHot(Learner):
    """One 0/1 column per level, in alphabetical (numeric) order, named column_level.
    ``drop="first"`` leaves the first level out; ``unseen`` is "error" or "ignore"; ``most_levels`` is how many
    levels all columns may have together before they count as no categories."""

    def __init__(self, columns: Iterable[str] = (), drop: str | None = "first", unseen: str = "error",
                 most_levels: int = MOST_LEVELS):
        super().__init__(**({"columns": list(columns), "drop": drop, "unseen": unseen, "most_levels": most_levels}
                            if columns else {}))

    def _fit(self, df: DataFrame) -> OneHotModel:
        columns = unique(self["columns"])
        return OneHotModel(columns, learn_levels(df, columns, self.get("most_levels")), self["drop"], self["unseen"])


class OneHotModel(Fitted):
    def __init__(self, columns=(), levels=(), drop="first", unseen="error"):
        super().__init__(**({"columns": list(columns), "levels": list(levels), "drop": drop, "unseen": unseen}
                            if columns else {}))

    def names(self, i: int) -> list[str]:
        first = 1 if self["drop"] == "first" else 0
        return [level_name(self["columns"][i], v) for v in self["levels"][i][first:]]

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, first = self["columns"], 1 if self["drop"] == "first" else 0
        others = [text.name(c) for c in df.columns if c not in columns]
        # the position is found once per row and compared once per level
        placed = df.selectExpr(*others, *[text.alias(place(c, self["levels"][i], self["unseen"]), f"_place{i}")
                                          for i, c in enumerate(columns)])
        flags = [text.alias(f"CAST(_place{i} = {k + 1 + first} AS INT)", n)
                 for i in range(len(columns)) for k, n in enumerate(self.names(i))]
        return placed.selectExpr(*others, *flags)


def get_dummies(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Every text column as dummies; a missing value has zeros throughout."""
    columns = list(columns or text_names(df))
    return OneHot(columns, drop=None, unseen="ignore").fit(df).transform(df)


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """The feature columns as one ML vector; missing values raise."""
    from pyspark.ml.feature import VectorAssembler

    typed = df.withColumns({c: col(c).cast("double") for c in columns
                            if not isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))}) if any(
        not isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType)) for c in columns) else df
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="error").transform(typed)
