"""One-hot encoding without a column per level: a level table joined to the rows.

A row's features are the entries that are not 0, ``array<struct<at int, x double>>``. Tables with
any number of levels keep their width, and a row costs as much as it has encoded columns.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.columns import col, value
from ..stage import Learner, unique
from .lookup import TableHolder, freeze, numbered, thaw


def _key(df: DataFrame, c: str) -> Column:
    """The value as text; NaN is missing."""
    fractional = isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))
    return F.when(~F.isnan(col(c)), col(c)).cast("string") if fractional else col(c).cast("string")


class SparseOneHot(Learner):
    """Adds ``output``: an entry of 1 per level and an entry per number. Levels are in natural order, column by
    column, then come ``numbers``. ``drop`` and ``unseen`` are as in ``OneHot``; a level count has no limit. A row
    with a missing number has no entries (NULL); a missing category counts as unseen."""

    def __init__(self, columns: Iterable[str] = (), numbers: Iterable[str] = (), drop: str | None = "first",
                 unseen: str = "error", output: str = "entries"):
        columns, numbers = list(columns), list(numbers)
        super().__init__(**({"columns": columns, "numbers": numbers, "drop": drop, "unseen": unseen, "output": output}
                            if columns or numbers else {}))

    def _fit(self, df: DataFrame) -> SparseOneHotModel:
        columns, numbers = unique(self["columns"]), unique(self["numbers"])
        levels = None
        widths: list[int] = []
        if columns:
            numeric = [isinstance(df.schema[c].dataType, T.NumericType) for c in columns]
            entries = [F.struct(F.lit(i).alias("which"),
                                (value(c) if n else F.lit(None).cast("double")).alias("number"),
                                _key(df, c).alias("level")) for i, (c, n) in enumerate(zip(columns, numeric))]
            found = (df.select(F.explode(F.array(*entries)).alias("e")).where("e.level is not null").distinct()
                       .select("e.which", "e.level", "e"))
            table = numbered(found, "e", "n").drop("e")
            first = 1 if self["drop"] == "first" else 0
            spans = {r["which"]: (r["low"], r["c"]) for r in table.groupBy("which").agg(
                F.min("n").alias("low"), F.count(F.lit(1)).alias("c")).collect()}
            widths = [max(spans.get(i, (0, 0))[1] - first, 0) for i in range(len(columns))]
            # a dropped level is known, but lies nowhere: -1
            place = F.lit(-1).cast("bigint")
            for i in spans:
                low, ahead = spans[i][0] + first, sum(widths[:i])
                place = F.when((F.col("which") == i) & (F.col("n") >= low), F.col("n") - low + ahead).otherwise(place)
            levels = freeze(table.select("which", "level", place.cast("int").alias("at")))
        return SparseOneHotModel(columns, numbers, levels, widths, self["unseen"], self["output"])


class SparseOneHotModel(TableHolder):
    """The level table (which, level, at) and the widths of the columns."""

    def __init__(self, columns=(), numbers=(), table=None, widths=(), unseen="error", output="entries"):
        super().__init__(**({"columns": list(columns), "numbers": list(numbers), "table": table,
                             "widths": list(widths), "unseen": unseen, "output": output} if columns or numbers else {}))

    def frozen(self) -> dict | None:
        return self["table"]

    def take_from(self, path: str) -> None:
        self._set(config={**self.getOrDefault(self.config), "table": {**self["table"], "path": path}})

    @property
    def width(self) -> int:
        """How many columns the dense table would have."""
        return sum(self["widths"]) + len(self["numbers"])

    def names(self, spark: SparkSession) -> DataFrame:
        """(at, column, level) of every feature; numbers have no level."""
        columns, numbers, ahead = self["columns"], self["numbers"], sum(self["widths"])
        parts = []
        if columns:
            named = F.element_at(F.array(*[F.lit(c) for c in columns]), F.col("which") + 1)
            parts.append(thaw(spark, self["table"]).where("at >= 0").select("at", named.alias("column"), "level"))
        if numbers:
            parts.append(spark.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in numbers]))).select(
                (F.col("pos") + ahead).alias("at"), F.col("col").alias("column"), F.lit(None).cast("string").alias("level")))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])

    def _transform(self, df: DataFrame) -> DataFrame:
        columns, numbers, before = self["columns"], self["numbers"], df.columns
        output = self["output"]
        # names that the table does not have, whatever it holds
        stem = "_l"
        while any(c.lower().startswith(stem) for c in before):
            stem = f"_{stem}"
        out = df.withColumns({f"{stem}k{i}": _key(df, c) for i, c in enumerate(columns)}) if columns else df
        entries = []
        for i, c in enumerate(columns):
            key, known, at = f"{stem}k{i}", f"{stem}v{i}", f"{stem}a{i}"
            levels = thaw(df.sparkSession, self["table"]).where(F.col("which") == i).select(
                F.col("level").alias(known), F.col("at").alias(at))
            out = out.join(levels, F.col(key) == F.col(known), "left")
            place = F.col(at)
            if self["unseen"] == "error":
                message = F.concat(F.lit(f"unseen level in {c}: "), F.coalesce(F.col(key), F.lit("missing")))
                place = F.coalesce(place, F.raise_error(message).cast("int"))
            entries.append(F.struct(F.coalesce(place, F.lit(-1)).alias("at"), F.lit(1.0).alias("x")))
        ahead = sum(self["widths"])
        entries += [F.struct(F.lit(ahead + j).alias("at"), value(c).alias("x")) for j, c in enumerate(numbers)]
        listed = F.filter(F.array(*entries), lambda e: e["at"] >= 0)
        whole = F.lit(True)
        for c in numbers:
            whole = whole & value(c).isNotNull()
        return out.select(*[col(c) for c in before if c != output], F.when(whole, listed).alias(output))
