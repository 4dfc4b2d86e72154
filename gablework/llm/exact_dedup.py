"""Exact deduplication by a stateful stream.

The digests of all texts flow through a streaming aggregation whose keyed state lies on disk
(RocksDB) and never expires: per digest it retains the number of rows and the stable identifier
and content locator (file and row) of the row that stays. Further files can be fed to the same
checkpoint later. A digest seen before is a hit only after the full bytes of the texts agree.

A hot digest costs nothing extra: rows are combined inside each task before the state is
touched, and the joins with the state are plain inner joins that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gablework.session import fresh_path

from .common import located, quoted, stored, text_or_empty

#: The state on disk; without reserving megabytes ahead for each partition's small files.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
#: A micro-batch takes about this much of the digest table; the state, not the batch, spans the corpus.
BATCH_BYTES = 64 << 30


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def feed(digests: str, schema, state: str, spark: SparkSession) -> None:
    """Run everything that is new under ``digests`` through the state kept in ``state``."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        stream = spark.readStream.schema(schema).option("maxBytesPerTrigger", BATCH_BYTES).parquet(digests)
        groups = stream.groupBy("digest").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.struct("id", "_file", "_row")).alias("keep"))
        (groups.writeStream.format("noop").outputMode("update").trigger(availableNow=True)
         .option("checkpointLocation", state).start().awaitTermination())
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def kept_by_digest(state: str, spark: SparkSession) -> DataFrame:
    """The state as a table: digest, n, keep (id, _file, _row)."""
    held = spark.read.format("statestore").load(state)
    n, keep = (F.col("value").getField(name) for name in held.schema["value"].dataType.names[:2])
    return held.select(F.col("key.digest").alias("digest"), n.alias("n"), keep.alias("keep"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    """One row per input row: digest, id, keep_id, group_size, kept, and its place (_file, _row).

    Texts are equal when their bytes are; a missing text counts as empty. Of equal texts the row with
    the largest id stays, and among repeats of that id the one that lies last (by file, then row), so exactly one row
    of each group is kept. A missing id is smaller than any other. An empty table gives no rows.
    Further columns of ``docs`` are ignored, whatever their names.
    """
    return _exact_groups(*located(docs), id_col, text_col, digest)


def _exact_groups(rows: DataFrame, file: str, row: str, id_col: str, text_col: str,
                  digest: Callable[[Column], Column] = sha256_digest) -> DataFrame:
    spark = rows.sparkSession
    body = text_or_empty(text_col)
    places = [F.col(file).alias("_file"), F.col(row).alias("_row")]
    slim = rows.select(digest(body).alias("digest"), F.col(id_col).alias("id"), *places)
    digests = fresh_path(spark, "exact-digests")
    slim.write.parquet(digests)
    slim = spark.read.schema(slim.schema).parquet(digests)
    state = fresh_path(spark, "exact-state")
    feed(digests, slim.schema, state, spark)
    held = stored(kept_by_digest(state, spark), "exact-held")

    texts = rows.select(digest(body).alias("digest"), F.col(id_col).alias("id"), *places, body.alias("body"))
    hits = stored(texts.join(held.filter("n > 1"), "digest"), "exact-hits")
    place = F.struct("id", "_file", "_row")
    first = hits.filter(place == F.col("keep")).select("digest", F.col("body").alias("kept_body"))
    unlike = (hits.filter(place != F.col("keep")).join(first, "digest")
              .filter(F.col("body") != F.col("kept_body")).select("digest"))
    # Stored before distinct(), which would keep the join from splitting a hot digest.
    unlike = stored(unlike, "exact-unlike").distinct()

    def result(rows_with_group: DataFrame) -> DataFrame:
        return rows_with_group.select(
            "digest", "id", "_file", "_row", F.col("keep.id").alias("keep_id"), F.col("n").alias("group_size"),
            (F.struct("id", "_file", "_row") == F.col("keep")).alias("kept"))

    plain = result(slim.join(held, "digest"))
    if unlike.isEmpty():
        return plain
    # Different texts under one digest: group these few by their bytes.
    clashing = texts.join(unlike, "digest")
    groups = clashing.groupBy("digest", "body").agg(F.count(F.lit(1)).alias("n"), F.max(place).alias("keep"))
    return plain.join(unlike, "digest", "left_anti").unionByName(
        result(clashing.join(groups, ["digest", "body"])))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that ``exact_groups`` does not keep; all columns as they were."""
    rows, file, row = located(docs)
    dropped = (_exact_groups(rows, file, row, id_col, text_col).filter("not kept")
               .select(F.col("_file").alias(file), F.col("_row").alias(row)))
    return rows.join(dropped, [file, row], "left_anti").select(*map(quoted, docs.columns))
