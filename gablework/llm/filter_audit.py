"""How quality filters interact: what each removes, repeats or would have removed, in every order.

Four filters judge a text by itself, the fifth fails every text that a smaller id has too. One pass over the texts
gives each row its failures and a hash. The hashes are thrown into a counting Bloom filter: every task counts the
cells of its rows, segment by segment, and the segments are merged by adding. A text with a cell that only one row of the
table has reached is unique for certain; only the other texts are shuffled, and compared in full, for the least id of each.
The failures of a row become a mask; counts of masks are additive, so all orders of the filters are read off
at most 32 counts a part.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from .byte_hashes import mixed, text_bytes
from .common import Scratch, in_batches, stored, text_or_empty
from .exact_dedup import sha256_digest

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
ORDERS = ["".join(order) for order in itertools.permutations(FILTERS)]
#: Cells that one text reaches, all in one segment; a segment has 2 ** SEGMENT_BITS cells.
REACHED, SEGMENT_BITS = 4, 18
#: Cells for each row, up to MOST_CELLS in all: the merged filter is a bit a cell, so at most 32 MB go to the tasks. With
#: more rows than that the filter clears fewer texts and more are compared in full; the result is exact either way.
CELLS_A_ROW, MOST_CELLS = 16, 1 << 28
#: A task adds its counts up in blocks of so many cells reached.
BLOCK = 1 << 21


def flagged(docs: DataFrame, id_col: str, text_col: str, part_col: str) -> DataFrame:
    """id, part, mask (bits of the filters A to D that the text fails) and digest (the text's SHA-256)."""
    in_batches(docs.sparkSession)
    capitals = bytes(range(ord("A"), ord("Z") + 1))
    symbols = b"#$%&*|"

    def mask(text: str) -> int:
        data = text.encode()
        words = data.split()  # at the bytes 0x20 and 0x09 to 0x0D
        upper = len(data) - len(data.translate(None, capitals))
        fails = (len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * upper > 3 * len(text),
                 len(data.translate(None, symbols)) < len(data))
        return sum(fail << i for i, fail in enumerate(fails))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = [mask(text) for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("part"), pa.array(masks, pa.int32()),
                                              batch.column("digest")], ["id", "part", "mask", "digest"])

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                       sha256_digest(text).alias("digest"), text.alias("_text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, part string, mask int, digest binary")


def cells(digests: pa.Array, segments: int) -> np.ndarray:
    """The cells that each digest reaches, a row of REACHED each; those of one digest lie in one segment."""
    data, offsets = text_bytes(digests)
    h = data.reshape(len(digests), 32)[:, :8].copy().view(np.uint64)[:, 0] if len(digests) else np.zeros(0, np.uint64)
    segment = (h >> np.uint64(40)) % np.uint64(segments)
    within = mixed(h[:, None] + np.arange(1, REACHED + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return ((segment[:, None] << np.uint64(SEGMENT_BITS)) | (within >> np.uint64(64 - SEGMENT_BITS))).astype(np.int64)


def counting_bloom(digests: DataFrame, segments: int) -> DataFrame:
    """segment, bits: a bit for each cell of the segment that rows have reached more than once.

    ``digests`` has a column digest. Tasks send the cells they have reached, with counts of one or more than one, which is all
    that the merge needs to know; a merge adds up one segment.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def counted() -> pa.RecordBatch:
            # A text reaches a cell twice if two of its own places fall together: that is one row.
            cell = np.concatenate([np.sort(c, axis=1) for c in held])
            fresh = np.ones(cell.shape, bool)
            fresh[:, 1:] = cell[:, 1:] != cell[:, :-1]
            cell, n = np.unique(cell[fresh], return_counts=True)
            segment, starts = np.unique(cell >> SEGMENT_BITS, return_index=True)
            spans = list(zip(starts, np.append(starts[1:], len(cell))))
            places = (cell & ((1 << SEGMENT_BITS) - 1)).astype(np.uint32)
            once = np.minimum(n, 2).astype(np.uint8)
            return pa.RecordBatch.from_arrays(
                [pa.array(segment), pa.array([places[a:b].tobytes() for a, b in spans], pa.binary()),
                 pa.array([once[a:b].tobytes() for a, b in spans], pa.binary())], ["segment", "places", "counts"])

        for batch in batches:
            if batch.num_rows:
                held.append(cells(batch.column("digest"), segments))
                size += held[-1].size
            if size >= BLOCK:
                yield counted()
                held, size = [], 0
        if held:
            yield counted()

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Parts come sorted by segment, so one array of counters is held at a time.
        segment, counters = None, np.zeros(1 << SEGMENT_BITS, np.uint8)

        def merged() -> pa.RecordBatch:
            bits = np.packbits(counters > 1, bitorder="little").tobytes()
            return pa.RecordBatch.from_arrays([pa.array([segment]), pa.array([bits], pa.binary())], ["segment", "bits"])

        for part in parts:
            for s, places, counts in zip(*(part.column(c).to_pylist() for c in ("segment", "places", "counts"))):
                if s != segment:
                    if segment is not None:
                        yield merged()
                    segment, counters = s, np.zeros(1 << SEGMENT_BITS, np.uint8)
                at = np.frombuffer(places, np.uint32)
                counters[at] = np.minimum(counters[at] + np.frombuffer(counts, np.uint8), 2)
        if segment is not None:
            yield merged()

    sent = digests.select("digest").mapInArrow(count, "segment long, places binary, counts binary")
    return sent.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment long, bits binary")


def sent_to_tasks(bloom: DataFrame, segments: int) -> Broadcast:
    """The merged filter, at most MOST_CELLS bits, for every task."""
    bits = np.zeros((segments, 1 << (SEGMENT_BITS - 3)), np.uint8)
    for segment, held in bloom.toLocalIterator():
        bits[segment] = np.frombuffer(held, np.uint8)
    return bloom.sparkSession.sparkContext.broadcast(bits.reshape(-1))


def possible_repeats(rows: DataFrame, sent: Broadcast, segments: int, again: bool = True) -> DataFrame:
    """``rows`` (with a column digest) that reach no cell which one row alone has reached, or with ``again=False`` the
    others, whose texts are unique for certain."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = cells(batch.column("digest"), segments)
            full = (sent.value[cell >> 3] >> (cell & 7).astype(np.uint8)) & 1
            yield batch.filter(pa.array(full.all(axis=1) == again))

    return rows.mapInArrow(run, rows.schema)


def masks(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "lang") -> DataFrame:
    """part, mask, n, good, toxic: rows of a part that fail just the filters in the mask's bits (A is the lowest), how many
    of them are labelled of quality 1, and how many toxic.

    A null text is empty and a null part the empty string. Repeated rows each count. A text is a repeat if a
    smaller id has the same text, so equal ids are no repeats of each other, and a null id is neither smaller nor larger
    than any. A row is good or toxic if any label of its id (a column of the same name) says so. No rows give no rows.
    Other columns are left out, whatever their names.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(flagged(docs, id_col, text_col, part_col), "audit-rows")
    cells_wanted = max(1, rows.count() * CELLS_A_ROW)
    segments = max(1, min(MOST_CELLS, 1 << (cells_wanted - 1).bit_length()) >> SEGMENT_BITS)
    bloom = sent_to_tasks(scratch.keep(counting_bloom(rows, segments), "audit-bloom"), segments)
    text = text_or_empty(text_col)
    texts = possible_repeats(docs.select(F.col(id_col).alias("id"), sha256_digest(text).alias("digest"), text.alias("_text")),
                             bloom, segments)
    # Whole texts are the keys; their digests then lead from rows to groups.
    firsts = scratch.keep(texts.groupBy("_text").agg(F.min("id").alias("first"), F.max("id").alias("last"))
                          .filter("first < last").select(sha256_digest(F.col("_text")).alias("digest"), "first"), "audit-firsts")
    single = possible_repeats(rows, bloom, segments, again=False).select("id", "part", "mask")
    late = F.when(F.col("id") > F.col("first"), F.lit(REPEATED)).otherwise(F.lit(0))
    repeated = (possible_repeats(rows, bloom, segments).join(firsts, "digest", "left")
                .select("id", "part", F.col("mask").bitwiseOR(late).alias("mask")))
    masked = scratch.keep(single.union(repeated), "audit-masked")
    marks = (labels.groupBy(F.col(id_col).alias("id")).agg(F.max(F.expr("int(quality <=> 1)")).alias("good"),
                                                           F.max(F.expr("int(toxic <=> 1)")).alias("toxic"))
             .filter("good + toxic > 0"))
    none = F.lit(0).alias("none")
    counted = (masked.select("part", "mask", F.lit(1).alias("n"), none.alias("good"), none.alias("toxic"))
               .union(masked.join(marks, "id").select("part", "mask", none, "good", "toxic"))
               .groupBy("part", "mask").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic"))))
    result = stored(counted, "audit-masks")
    scratch.delete()
    return result


def audit(counts: DataFrame) -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and
    shapley, from the counts that ``masks`` gives."""
    order = F.element_at(F.array(*map(F.lit, ORDERS)), F.expr("int(place div 5) + 1"))
    steps = (counts.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(5 * len(ORDERS) - 1))))
             .select("*", order.alias("filter_order"), F.expr("int(place % 5) + 1").alias("step")))
    steps = steps.withColumns({
        "bit": F.expr("int(shiftleft(1, instr('ABCDE', substring(filter_order, step, 1)) - 1))"),
        "before": F.expr("int(aggregate(sequence(1, step), 0, (m, i) -> m | if(i = step, 0,"
                         " shiftleft(1, instr('ABCDE', substring(filter_order, i, 1)) - 1))))")})
    fails, earlier = F.expr("mask & bit <> 0"), F.expr("mask & before <> 0")

    def total(of: str, when: Column, name: str) -> Column:
        return F.sum(F.when(when, F.col(of)).otherwise(F.lit(0))).alias(name)

    here = fails & ~earlier
    return steps.groupBy("part", "filter_order", "step").agg(
        total("n", ~fails & ~earlier, "kept"), total("n", here, "removed"), total("n", fails & earlier, "redundant"),
        total("n", F.expr("mask = bit"), "unique_fails"), total("good", here, "good_lost"), total("toxic", here, "toxic_lost"),
        # Of the orders of a mask's filters the same number begin with each of them.
        F.sum(F.when(fails, F.col("n") * F.expr("120 div bit_count(mask)")).otherwise(F.lit(0))).alias("shapley"))


def audit_sql() -> str:
    """The audit of the table documents in DuckDB SQL."""
    return r"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
marks AS (SELECT doc_id, max((quality IS NOT DISTINCT FROM 1)::INT) AS good, max((toxic IS NOT DISTINCT FROM 1)::INT) AS toxic
  FROM labels GROUP BY doc_id),
failing AS (
  SELECT doc_id, part, (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
    + 4 * (100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t))::INT
    + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask
  FROM texts),
counts AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failing LEFT JOIN marks USING (doc_id) GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
orders AS (SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31
    AND a.b | b.b | c.b | d.b | e.b = 31),
steps AS (SELECT filter_order, s::INT AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0)::INT AS before
  FROM orders, range(1, 6) AS r(s)),
walked AS (
  SELECT part, filter_order, step, bit, sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM walked"""
