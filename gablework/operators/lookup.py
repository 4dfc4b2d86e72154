"""Fitted look-up tables: value per key, joined without moving the big side."""

from __future__ import annotations

import json

from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ..functions.columns import col
from ..session import fresh_path
from ..stage import Fitted


def freeze(table: DataFrame) -> dict:
    """Evaluate a look-up once: it is written to the shared folder, and into a model's own folder with the model."""
    path = fresh_path(table.sparkSession, "lookup")
    table.write.parquet(path)
    return {"schema": table.schema.json(), "path": path}


def thaw(spark: SparkSession, frozen: dict) -> DataFrame:
    """The look-up as a frame. It carries no hint: the size of its files decides the join, and AQE splits hot keys."""
    return spark.read.schema(T.StructType.fromJson(json.loads(frozen["schema"]))).parquet(frozen["path"])


class _TableWriter(DefaultParamsWriter):
    """Constants as usual, and the look-up beside them."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        frozen = self.instance.frozen()
        if frozen:
            thaw(SparkSession.active(), frozen).write.parquet(f"{path}/table")


class _TableReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        if model.frozen():
            model.take_from(f"{path}/table")
        return model


class TableHolder(Fitted):
    """A fitted step with a look-up, which lies in the model's own folder once it is saved."""

    def write(self) -> DefaultParamsWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _TableReader(cls)

    def frozen(self) -> dict | None:
        """Where the look-up lies, as ``freeze`` gives it; ``None`` without one."""
        raise NotImplementedError

    def take_from(self, path: str) -> None:
        """Read the look-up from ``path`` from now on."""
        raise NotImplementedError


class LookupModel(TableHolder):
    """Left join of ``table`` on ``key``; subclasses say what to do with the values. A saved model
    holds its table, whatever its size and types."""

    def __init__(self, key=None, columns=(), table=None, **more):
        super().__init__(**({"key": key, "columns": list(columns), "table": table, **more} if key else {}))

    def frozen(self) -> dict | None:
        return self["table"]

    def take_from(self, path: str) -> None:
        self._set(config={**self.getOrDefault(self.config), "table": {**self["table"], "path": path}})

    def table(self, spark: SparkSession) -> DataFrame:
        return thaw(spark, self["table"])

    def attach(self, df: DataFrame) -> DataFrame:
        """Adds ``_found_<column>`` for every looked-up column."""
        key, columns = self["key"], self["columns"]
        table = self.table(df.sparkSession).select(
            col(key).alias("_key"), *[col(c).alias(f"_found_{c}") for c in columns])
        return df.join(table, df[key] == table["_key"], "left").drop("_key")


def numbered(table: DataFrame, order: str, name: str) -> DataFrame:
    """Row numbers from 0 over a whole table without a single-task window: range
    partitions are written once, counted, and numbered inside with an offset."""
    spark = table.sparkSession
    path = fresh_path(spark, "numbered")
    (table.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id())
          .write.parquet(path))
    written = spark.read.parquet(path)
    start, cases = 0, []
    for part, n in sorted(tuple(r) for r in written.groupBy("_part").count().collect()):
        cases.append((part, start))
        start += n
    if not cases:
        return written.drop("_part").withColumn(name, F.lit(None).cast("bigint"))
    offsets = F.create_map(*[F.lit(v) for pair in cases for v in pair])
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    return (written.withColumn(name, (inside - 1 + offsets[F.col("_part")]).cast("bigint"))
                   .drop("_part"))
