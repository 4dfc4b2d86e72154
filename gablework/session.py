"""Session-level helpers: the shared scratch folder and bounded look-ups."""

from __future__ import annotations

import atexit
import contextlib
import re
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark import StorageLevel, cloudpickle, inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Spark jobs that may run at the same time from one call.
AT_ONCE = 4
# HotSpot interprets a method of more bytecode than this, however often it runs.
COMPILED_BYTES = 8_000

_local_folder: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as the cluster names it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):  # local-cluster has executors of its own
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.mkdtemp(prefix="gablework-")
        atexit.register(shutil.rmtree, _local_folder, ignore_errors=True)
    return _local_folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a table that ``fresh_path`` named; frames that read it can't be used any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextlib.contextmanager
def arrow_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of so many rows for what runs inside."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Iterative learners cut lineage with checkpoint(); give them a folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(spark))


def in_compiled_methods(spark: SparkSession) -> None:
    """Let Spark generate code by operator where the code of a whole stage would be one method too long for HotSpot
    to compile: wide plans and linear predictions come to that. Spark's documentation advises this limit."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > COMPILED_BYTES:
        spark.conf.set(name, COMPILED_BYTES)


def side_by_side(work: Sequence[Callable[[], object]], at_once: int = AT_ONCE) -> list:
    """Submit independent jobs from a few threads; results in order."""
    if len(work) <= 1:
        return [w() for w in work]
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(at_once) as pool:
        return [f.result() for f in [pool.submit(inherit(w)) for w in work]]


@contextlib.contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a frame that several eager passes read, and release it after."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def rows_within(df: DataFrame, bound: int) -> list | None:
    """All rows when there are at most ``bound`` of them, else ``None``."""
    rows = df.limit(bound + 1).collect()
    return rows if len(rows) <= bound else None


def small_frame(spark: SparkSession, rows: Iterable, schema: T.StructType | str) -> DataFrame:
    """A few driver-side rows as a local relation: its size is known to the planner, and
    no Python worker is needed to read it."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    columns = list(zip(*rows)) or [()] * len(schema.fields)
    arrow = pa.Table.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, to_arrow_schema(schema))],
        schema=to_arrow_schema(schema))
    return spark.createDataFrame(arrow, schema)


def runs_in_tasks(module: str) -> None:
    """Send a module's functions to tasks by value, so that a worker need not have the
    package on its path."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
