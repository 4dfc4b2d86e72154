"""Row identity, scratch tables and worker-wide tables that several operators share."""

from __future__ import annotations

import contextlib
import gc
import sys
import types
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from gablework.session import fresh_path

#: Records in one Arrow batch; long texts make batches large, so this stays small.
BATCH_ROWS = 256


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def row_key(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Add ``_id`` (the id, a missing one as the smallest long) and ``_h`` (a hash of the text).

    Rows that agree in both are repeats of one row; every operator gives them one result.
    """
    return df.withColumns({"_id": F.coalesce(F.col(id_col).cast("long"), F.lit(-(2 ** 63))),
                           "_h": F.xxhash64(text_or_empty(text_col))})


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables that one computation writes on its way, deleted together once its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write and reread like ``stored``, and let Spark drop the shuffle files behind it."""
        path = fresh_path(self.spark, label)
        df.write.parquet(path)
        self.paths.append(path)
        release(self.spark)
        return self.spark.read.schema(df.schema).parquet(path)

    def delete(self) -> None:
        """Delete all tables; frames that read them can't be used any more."""
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in self.paths:
            place = jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)
        self.paths = []


def located(docs: DataFrame) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns, the file and the row in it where each row lies, and the names of these columns, which
    ``docs`` did not have. A frame that is no plain scan of files is written to the shared folder first."""
    file, row = unused(docs, "_file"), unused(docs, "_row")
    places = {file: F.col("_metadata.file_path"), row: F.col("_metadata.row_index")}
    if "_metadata" not in docs.columns:  # a column of that name would hide the places
        try:
            return docs.withColumns(places), file, row
        except AnalysisException:
            pass
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    written = stored(docs.toDF(*names.values()), "located")
    return written.select(*(F.col(new).alias(old) for old, new in names.items()),
                          *(place.alias(name) for name, place in places.items())), file, row


def numbered(df: DataFrame, order: list[str], name: str, label: str) -> DataFrame:
    """``df`` with the column ``name``: the number of each row, from 0, in ``order``, which has to tell all rows apart.

    Rows are dealt by ranges, counted, and numbered inside each range, so the numbers depend on the rows only and no
    value, however frequent, puts all its rows into one task.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()), label)
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as there are ranges
    starts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows")).select(
        "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return (dealt.withColumn("_inside", inside).join(F.broadcast(starts), "_range")
            .withColumn(name, F.col("_start") + F.col("_inside")).drop("_range", "_start", "_inside"))


def quoted(name: str) -> Column:
    """A column by its exact name."""
    return F.col("`" + name.replace("`", "``") + "`")


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have: ``name`` with as many more underscores as it takes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def in_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the records that one Arrow batch holds, since a record can be a very long text."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > rows:
        spark.conf.set(name, rows)


@contextlib.contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many records, for what is run inside: records that are short."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def worker_cached(key: object, build: Callable[[], object]) -> object:
    """A table built once per worker process and kept between its tasks."""
    home = sys.modules.setdefault("_gablework_worker", types.ModuleType("_gablework_worker"))
    tables = home.__dict__.setdefault("tables", {})
    if key not in tables:
        tables[key] = build()
    return tables[key]


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished frames that nothing refers to any more;
    it does so only when the driver collects garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
