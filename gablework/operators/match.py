"""Comparing two sources and stacking tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from ..functions.columns import col, conjunction, same
from ..session import fresh_path


def match_sources(a: DataFrame, b: DataFrame, keys: Sequence[str],
                  suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """Full outer join on a composite key; other columns get a suffix where both tables
    have them. Missing keys match missing keys.

    Both tables are written once under their keys, then joined by a left outer and an anti join: AQE can
    split a hot key of the left table in these, and no key in a full outer join. Rows whose whole key is missing
    match all such rows of the other table, as any equal keys do.
    """
    shared = set(a.columns) & set(b.columns) - set(keys)

    def named(df, suffix):
        return {c: c + suffix if c in shared else c for c in df.columns if c not in keys}

    left_names, right_names = named(a, suffixes[0]), named(b, suffixes[1])
    left = a.select(*[col(k).alias(f"_l{i}") for i, k in enumerate(keys)],
                    *[col(c).alias(n) for c, n in left_names.items()])
    right = b.select(*[col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
                     *[col(c).alias(n) for c, n in right_names.items()])
    left, right = (_written(side, name) for side, name in ((left, "match-left"), (right, "match-right")))
    on = reduce(and_, [F.col(f"_l{i}").eqNullSafe(F.col(f"_r{i}")) for i in range(len(keys))])
    left_keys = [F.col(f"_l{i}").alias(k) for i, k in enumerate(keys)]
    right_keys = [F.col(f"_r{i}").alias(k) for i, k in enumerate(keys)]
    left_values, right_values = ([col(n) for n in names.values()] for names in (left_names, right_names))
    no_left = [F.lit(None).cast(a.schema[c].dataType).alias(n) for c, n in left_names.items()]
    all_left = left.join(right, on, "left_outer").select(*left_keys, *left_values, *right_values)
    right_only = right.join(left, on, "left_anti").select(*right_keys, *no_left, *right_values)
    return all_left.unionByName(right_only)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rows_agree(df: DataFrame, columns: Sequence[str], name: str = "agree",
               suffixes: tuple[str, str] = ("_x", "_y")) -> DataFrame:
    """All paired columns are equal as numbers or texts; a missing value never agrees."""
    return df.withColumn(name, conjunction([same(col(c + suffixes[0]), col(c + suffixes[1])) for c in columns]))


def union_split(first: DataFrame, second: DataFrame,
                change: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Change two tables as one, then take them apart again; columns one of them lacks
    are missing there."""
    stacked = (first.withColumn("_part", F.lit(0))
               .unionByName(second.withColumn("_part", F.lit(1)), allowMissingColumns=True))
    changed = change(stacked)
    return changed.where("_part = 0").drop("_part"), changed.where("_part = 1").drop("_part")
