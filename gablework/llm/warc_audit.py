"""Fixity audit of web archives by Merkle trees.

A record of an archive has a file, an offset, a length and a digest. A node of the tree hashes what lies below it in order: the
records that begin in one range of 64 KB of a file with their offsets, lengths and digests, the ranges of 16 MB, of a
file, of one of 4096 groups of files, and all. The tree depends on the records only, so replicas that were written apart can
be compared: at the root first, then only where nodes differ are their children looked at. An intact replica is told by
one hash, and damage is located by a few narrow joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import located, numbered, stored, unused

#: Records of a file of ``archive``.
FILE_RECORDS = 4096
#: Bits of the offset inside the lower two ranges, and the number of groups of files.
RANGE_BITS, WIDE_BITS, FILE_GROUPS = 16, 24, 4096


def record(url: Column, body: Column) -> Column:
    """A page as a WARC resource record, as text."""
    url, body = F.coalesce(url, F.lit("")), F.coalesce(body, F.lit(""))
    return F.concat(F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:md5:"), F.md5(F.concat(url, F.lit(" "), body)),
                    F.lit(">\r\nWARC-Target-URI: "), url, F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body, F.lit("\r\n\r\n"))


def laid_out(records: DataFrame, order: list[str], length: str = "n_bytes") -> DataFrame:
    """Add ``leaf`` (number of the record over all files in ``order``, which tells all rows apart), ``file`` (leaf / 4096) and
    ``offset`` in the file; all three depend on the records only."""
    rows = numbered(records, order, "leaf", "warc-order").withColumn("file", F.floor(F.col("leaf") / FILE_RECORDS))
    earlier = Window.partitionBy("file").orderBy("leaf").rowsBetween(Window.unboundedPreceding, -1)  # of one file
    return rows.withColumn("offset", F.coalesce(F.sum(length).over(earlier), F.lit(0)))


def parents() -> list[tuple[Column, Column]]:
    """For each level but the root: file and part of the node above a node (file, part)."""
    none = F.lit("")
    return [(F.col("file"), F.shiftright("part", RANGE_BITS)), (F.col("file"), F.shiftright("part", WIDE_BITS - RANGE_BITS)),
            (F.col("file"), F.lit(0).cast("long")), (none, F.pmod(F.xxhash64("file"), F.lit(FILE_GROUPS))), (none, F.lit(0).cast("long"))]


def leaf_keys() -> list[Column]:
    """file, part and hash of a record as a leaf: its file's name, its offset, and length and digest."""
    return [F.col("file").cast("string").alias("file"), F.col("offset").cast("long").alias("part"),
            F.concat(F.coalesce(F.col("n_bytes").cast("string"), F.lit("")), F.lit(":"),
                     F.coalesce(F.col("digest"), F.lit(""))).alias("hash")]


def tree(records: DataFrame) -> list[DataFrame]:
    """Levels of (file, part, hash) from the leaves of ``records`` (file, offset, n_bytes, digest) up to the root: leaves, 64 KB,
    16 MB, files, groups of files, root. Each but the first is a written table. Records without file or offset have no place in it."""
    level = records.select(*leaf_keys()).filter("file is not null and part is not null")
    levels = [level]
    for file, part in parents():
        below = F.array_sort(F.collect_set(F.struct("file", "part", "hash")))  # what one range, file or group has
        joined = F.array_join(F.transform(below, lambda c: F.concat_ws(":", c["file"], c["part"].cast("string"), c["hash"])), ",")
        level = level.groupBy(file.alias("up"), part.alias("upper")).agg(F.sha2(joined, 256).alias("hash"))
        level = stored(level.select(F.col("up").alias("file"), F.col("upper").alias("part"), "hash"), "warc-tree")
        levels.append(level)
    return levels


def mismatches(one: list[DataFrame], two: list[DataFrame]) -> DataFrame:
    """Leaves (file, part, hash) of tree ``one`` that ``two`` has not, with status changed, moved (and to_file, to_part) or
    missing, and those of ``two`` that nothing in ``one`` became, as added."""
    ups = parents()

    def below(level: DataFrame, depth: int, nodes: DataFrame) -> DataFrame:
        file, part = ups[depth]
        upper = nodes.select(F.col("file").alias("up"), F.col("part").alias("upper"))
        return level.join(upper, (file == F.col("up")) & (part == F.col("upper")), "left_semi")

    unlike, depth = None, len(ups)
    while depth > 0 and (unlike is None or not unlike.isEmpty()):
        sides = [levels[depth] if unlike is None else below(levels[depth], depth, unlike) for levels in (one, two)]
        both = sides[0].join(sides[1].withColumnRenamed("hash", "other"), ["file", "part"], "full_outer")
        unlike = stored(both.filter(~F.col("hash").eqNullSafe(F.col("other"))).select("file", "part"), "warc-open")
        depth -= 1
    place, whole = ["file", "part"], ["file", "part", "hash"]
    a, b = (stored(below(levels[0], 0, unlike).distinct(), "warc-leaves") for levels in (one, two))
    only_a, only_b = (stored(x.join(y, whole, "left_anti"), "warc-unlike") for x, y in ((a, b), (b, a)))
    lost, new = (stored(x.join(y, place, "left_anti"), "warc-gone") for x, y in ((only_a, only_b), (only_b, only_a)))
    moved = stored(nth_of_hash(lost).join(nth_of_hash(new).withColumnsRenamed({"file": "to_file", "part": "to_part"}), ["hash", "nth"])
                   .select(*whole, "to_file", "to_part"), "warc-moved")
    nowhere = {"to_file": F.lit(None).cast("string"), "to_part": F.lit(None).cast("long")}
    gone_to = moved.select(F.col("to_file").alias("file"), F.col("to_part").alias("part"), "hash")
    return (only_a.join(only_b, place, "left_semi").withColumn("status", F.lit("changed")).withColumns(nowhere)
            .unionByName(moved.withColumn("status", F.lit("moved")))
            .unionByName(lost.join(moved, whole, "left_anti").withColumn("status", F.lit("missing")).withColumns(nowhere))
            .unionByName(new.join(gone_to, whole, "left_anti").withColumn("status", F.lit("added")).withColumns(nowhere)))


def nth_of_hash(leaves: DataFrame) -> DataFrame:
    """Leaves with ``nth``, their number among those of one hash by file and part; a frequent hash is split over tasks."""
    rows = stored(numbered(leaves, ["hash", "file", "part"], "place", "warc-order"), "warc-places")
    firsts = stored(rows.groupBy("hash").agg(F.min("place").alias("first")), "warc-firsts")
    return rows.join(firsts, "hash").select("file", "part", "hash", (F.col("place") - F.col("first")).alias("nth"))


FOUND = ["status", "moved_file", "moved_offset"]


def audit(records: DataFrame, replica: DataFrame, one: list[DataFrame] | None = None) -> DataFrame:
    """``records`` (file, offset, n_bytes, digest, ...) with status: ok, changed (other bytes at its place in ``replica``), moved
    (not at its place, but at moved_file and moved_offset), missing, or unplaced (it has no file or offset); and rows of what
    only the replica has, as added, with its file, offset, n_bytes and digest.

    Records are compared by place, length and digest, so replicas may have been written apart. Rows that repeat a place with the
    same length and digest count once in either and share their status; a place is meant to have few different ones. A missing
    length or digest counts as empty. Moves pair equal records in the order of their places. With an empty replica all are
    missing, with empty records all added. Columns of ``records`` named like the three results are left out. ``one`` is the
    tree of ``records``, if it has been made.
    """
    records = records.drop(*FOUND)
    keys = [unused(records, f"_leaf_{name}") for name in ("file", "part", "hash")]
    found = mismatches(one or tree(records), tree(replica))
    kind = {c: records.schema[c].dataType for c in ("file", "offset", "n_bytes", "digest")}
    results = ["status", F.col("to_file").cast(kind["file"]).alias("moved_file"), F.col("to_part").cast(kind["offset"]).alias("moved_offset")]
    placed = records.withColumns(dict(zip(keys, leaf_keys()))).join(
        found.filter("status <> 'added'").select(*(F.col(c).alias(k) for c, k in zip(("file", "part", "hash"), keys)), *results), keys, "left")
    nowhere = F.col("file").isNull() | F.col("offset").isNull()
    placed = placed.withColumn("status", F.when(nowhere, "unplaced").otherwise(F.coalesce("status", F.lit("ok")))).drop(*keys)
    length, digest = (F.nullif(F.substring_index("hash", ":", 1), F.lit("")), F.expr("substring(hash, instr(hash, ':') + 1)"))
    added = found.filter("status = 'added'").select(
        F.col("file").cast(kind["file"]).alias("file"), F.col("part").cast(kind["offset"]).alias("offset"),
        length.cast(kind["n_bytes"]).alias("n_bytes"), digest.cast(kind["digest"]).alias("digest"), *results)
    return placed.unionByName(added, allowMissingColumns=True)


def archive(pages: DataFrame, id_col: str = "page_id", url: str = "url", body: str = "html",
            replica_body: Column | None = None) -> DataFrame:
    """Every page's id with leaf, file, offset, n_bytes and digest (SHA-256) of its WARC record.

    Pages are ordered by id, then digest, then place, so ids may be missing or repeated, and repeated rows are records of their own.
    Missing urls and bodies count as empty. Other columns are left out, whatever their names. With ``replica_body`` there are also
    replica_bytes and replica_digest, of the record with that body (none where it is missing: the replica lost the record).
    """
    rows, file, row = located(pages)
    whole = record(F.col(url), F.col(body))
    columns = [F.col(id_col).alias("id"), F.sha2(whole, 256).alias("digest"),
               F.octet_length(whole).cast("long").alias("n_bytes"), F.col(file).alias("_file"), F.col(row).alias("_row")]
    if replica_body is not None:
        other = record(F.col(url), replica_body)
        columns += [F.when(replica_body.isNotNull(), F.octet_length(other).cast("long")).alias("replica_bytes"),
                    F.when(replica_body.isNotNull(), F.sha2(other, 256)).alias("replica_digest")]
    return laid_out(rows.select(*columns), ["id", "digest", "_file", "_row"]).drop("_file", "_row")
