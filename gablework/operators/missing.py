"""Missing values: fill, flag, count."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col
from ..stage import Learner, Step, unique
from .lookup import LookupModel, freeze, numbered


def fill_constant(df: DataFrame, columns: Iterable[str], value) -> DataFrame:
    """Fill with one value; it is cast to each column's own type."""
    columns = list(columns)
    return df.withColumns({c: F.coalesce(col(c), F.lit(value).cast(df.schema[c].dataType)) for c in columns})


def fill_defaults(df: DataFrame, defaults: Mapping) -> DataFrame:
    return df.withColumns({c: F.coalesce(col(c), F.lit(v)) for c, v in defaults.items()})


def add_null_flags(df: DataFrame, columns: Iterable[str], prefix: str = "null_") -> DataFrame:
    return df.withColumns({f"{prefix}{c}": col(c).isNull() for c in columns})


class DictImputer(Step):
    """Per-column defaults; returns those columns only, in the given order, plus any
    ``keep`` columns in front (a key to join back on)."""

    def __init__(self, defaults: Mapping | None = None, keep: Iterable[str] = ()):
        super().__init__(**({"defaults": dict(defaults), "keep": list(keep)} if defaults else {}))

    def _transform(self, df: DataFrame) -> DataFrame:
        filled = [F.coalesce(col(c), F.lit(v)).alias(c) for c, v in self["defaults"].items()]
        return df.select(*[col(c) for c in self["keep"]], *filled)


# --- values chosen per group -------------------------------------------------

def group_choice(df: DataFrame, group: str, columns: Iterable[str], strategy: str = "mode") -> DataFrame:
    """One value per group and column: the most frequent ("mode") or the least
    frequent one ("rarest"), the smallest on ties. Rows without a group are left out;
    a group without values gets NULL.

    Counting by (group, column, value) first keeps a hot group's rows from meeting in
    one task, and all columns share one pass.
    """
    if strategy not in ("mode", "rarest"):
        raise ValueError(f"unknown strategy {strategy!r}")
    columns = unique(columns)
    types = [df.schema[c].dataType for c in columns]

    def entry(i):
        return F.struct(F.lit(i).alias("which"), *[
            (col(c) if j == i else F.lit(None)).cast(types[j]).alias(f"v{j}") for j, c in enumerate(columns)])

    counted = (df.where(col(group).isNotNull())
                 .select(col(group).alias("_group"), F.explode(F.array(*map(entry, range(len(columns))))).alias("e"))
                 .groupBy("_group", "e.which", *[f"e.v{j}" for j in range(len(columns))])
                 .agg(F.count(F.lit(1)).alias("n")))
    rank = -F.col("n") if strategy == "mode" else F.col("n")
    picks = [F.min_by(F.col(f"v{j}"), F.when((F.col("which") == j) & F.col(f"v{j}").isNotNull(),
                                             F.struct(rank, F.col(f"v{j}")))).alias(c)
             for j, c in enumerate(columns)]
    return counted.groupBy(F.col("_group").alias(group)).agg(*picks)


class GroupModeImputer(Learner):
    """Learns ``group_choice``; the model fills missing values from it."""

    def __init__(self, group: str | None = None, columns: Iterable[str] = (), strategy: str = "mode"):
        super().__init__(**({"group": group, "columns": list(columns), "strategy": strategy} if group else {}))

    def _fit(self, df: DataFrame) -> GroupModeModel:
        table = group_choice(df, self["group"], self["columns"], self["strategy"])
        return GroupModeModel(self["group"], unique(self["columns"]), freeze(table))


class GroupModeModel(LookupModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        """Unseen groups and groups without values stay missing."""
        columns = self["columns"]
        return (self.attach(df)
                .withColumns({c: F.coalesce(col(c), col(f"_found_{c}")) for c in columns})
                .select(df.columns))


def impute_variant(df: DataFrame, column: str, how: str, group: str | None = None,
                   fitted: GroupModeModel | None = None) -> DataFrame:
    """One column filled by "zero" or by the group's value."""
    if how == "zero":
        return fill_constant(df, [column], 0)
    if how not in ("mode", "rarest"):
        raise ValueError(f"unknown fill {how!r}")
    fitted = fitted or GroupModeImputer(group, [column], how).fit(df)
    return fitted.transform(df)


# --- integer codes -----------------------------------------------------------

class Factorizer(Learner):
    """Integer codes by first appearance in the order of a unique key. Learned on one
    table, so that other tables get the same codes; missing and unseen values give -1."""

    def __init__(self, column: str | None = None, order_by: str | None = None, output: str | None = None):
        super().__init__(**({"column": column, "order_by": order_by, "output": output or column} if column else {}))

    def _fit(self, df: DataFrame) -> FactorizerModel:
        column = self["column"]
        first = (df.where(col(column).isNotNull()).groupBy(col(column))
                   .agg(F.min(col(self["order_by"])).alias("_first")))
        frozen = freeze(numbered(first, "_first", "code").select(col(column), "code"))
        return FactorizerModel(column, ["code"], frozen, output=self["output"])


class FactorizerModel(LookupModel):
    def _transform(self, df: DataFrame) -> DataFrame:
        coded = self.attach(df).withColumn(self["output"], F.coalesce(col("_found_code"), F.lit(-1)).cast("bigint"))
        return coded.drop("_found_code")


# --- counts ------------------------------------------------------------------

def _missing_counts(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    columns = unique(columns)
    one_row = df.agg(*[F.count_if(col(c).isNull()).alias(c) for c in columns])
    return one_row.unpivot([], [col(c) for c in columns], "column_name", "n_missing")


def null_profile(df: DataFrame, n: int | None = None, columns: Iterable[str] | None = None) -> DataFrame:
    """Missing count per column, most first; ties by name."""
    ordered = _missing_counts(df, columns or df.columns).orderBy(F.desc("n_missing"), "column_name")
    return ordered if n is None else ordered.limit(n)


def null_total(df: DataFrame) -> DataFrame:
    return df.agg(sum((F.count_if(col(c).isNull()) for c in df.columns), F.lit(0)).cast("bigint").alias("n_missing"))


def null_by_group(df: DataFrame, column: str, group: str) -> DataFrame:
    """Missing and total rows per group, most missing first."""
    return (df.where(col(group).isNotNull()).groupBy(col(group))
              .agg(F.count_if(col(column).isNull()).alias("n_missing"))
              .orderBy(F.desc("n_missing"), col(group)))


def null_vs_total(df: DataFrame, column: str, group: str) -> DataFrame:
    """Both counts side by side: one aggregate, where two tables would need a join."""
    return (df.where(col(group).isNotNull()).groupBy(col(group))
              .agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(col(column).isNull()).alias("n_missing")))


def columns_with_nulls(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    return _missing_counts(df, columns or df.columns).where("n_missing > 0")
