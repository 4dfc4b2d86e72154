"""Removal of repeated byte windows by a depth-limited radix sort of suffixes.

Two suffixes need to be told apart only through their first ``window`` bytes. They are ordered by most significant
digits, one pass per digit; a suffix whose group has no other member leaves, and the groups that are
equal through the last digit are exactly the repeated windows. Digits are stretches of the window, the most
telling first:

1. the anchor: the 32-byte gram of least hash in the window. Neighbouring windows share their anchor, so
   one row stands for a run of about 90 suffixes, and most runs leave in this pass;
2. the run: all bytes that the windows of a run cover. Equal runs need no finer digit;
3. the core: what 16 neighbouring windows have in common, of runs that differ but share their anchor;
4. the whole window, where cores agree and what surrounds them does not.

No digit ever needs the members of a group together: groups are counted, with counts combined inside tasks
first, and joined back, which adaptive execution can split. An anchor is chosen by the window's bytes alone,
so equal windows always meet. Groups are told apart by 128-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .byte_hashes import Rolling, cut, gram_hashes, mixed, sliding_min, text_bytes
from .common import Scratch, in_batches, release, row_key, stored, text_or_empty, worker_cached

WINDOW = 200
DOUBLINGS = 5
GRAM = 1 << DOUBLINGS
#: Bytes handled at a time inside a task; a longer text goes through in overlapping pieces.
PIECE = 1 << 20
#: Neighbouring windows whose common bytes make one core.
CORE = 16

_PLACE = np.uint64((1 << 24) - 1)


def _rolling(seed: int) -> Rolling:
    return worker_cached(("rolling", seed), lambda: Rolling(2 * PIECE, seed))


def _pieces(data: np.ndarray, offsets: np.ndarray, window: int) -> Iterator[tuple]:
    """(bytes, where each text begins in them, number of its row, where the piece begins in its text)."""
    for i, j in cut(offsets, PIECE):
        size = int(offsets[j] - offsets[i])
        if size < window:
            continue
        if size <= PIECE:
            yield data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], np.arange(i, j), np.zeros(j - i, np.int64)
            continue
        for base in range(0, size - window + 1, PIECE):
            part = data[offsets[i] + base:min(offsets[j], offsets[i] + base + PIECE + window - 1)]
            yield part, np.array([0, len(part)], np.int64), np.array([i]), np.array([base], np.int64)


def _runs(data: np.ndarray, starts: np.ndarray, window: int):
    """Runs of neighbouring windows with one anchor: first and last window, anchor, hashes of anchor and run."""
    grams = mixed(gram_hashes(data, _rolling(3).table, DOUBLINGS))
    least = sliding_min((grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64), window - GRAM + 1)
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, starts[:-1], 1)
    np.add.at(inside, np.maximum(starts[1:] - window + 1, starts[:-1]), -1)
    inside = np.cumsum(inside)[:len(least)] > 0
    change = np.empty(len(least), bool)
    change[0] = True
    np.not_equal(least[1:], least[:-1], out=change[1:])
    change[starts[starts < len(least)]] = True
    first = np.flatnonzero(change & inside)
    breaks = np.append(np.flatnonzero(change | ~inside), len(least))
    last = breaks[np.searchsorted(breaks, first, side="right")] - 1
    anchor = (least[first] & _PLACE).astype(np.int64)
    rolling = _rolling(5)
    run = rolling.of(rolling.sums(data), first, last + window) + (anchor - first).astype(np.uint64)
    return first, last, anchor, grams[anchor], run


def anchors(docs: DataFrame, window: int) -> DataFrame:
    """One row per run: g and s (hashes of anchor and run), the row's key, lo (first window's place), d (anchor
    less lo), e (last window less lo)."""
    in_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("_text"))
            key, content = (np.asarray(batch.column(c)) for c in ("_id", "_h"))
            for part, starts, rows, bases in _pieces(data, offsets, window):
                first, last, anchor, g, s = _runs(part, starts, window)
                at = np.searchsorted(starts, first, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(g.view(np.int64)), pa.array(s.view(np.int64)), pa.array(key[rows[at]]),
                     pa.array(content[rows[at]]), pa.array(first - starts[at] + bases[at]),
                     pa.array(((anchor - first) << 32) | (last - first))], ["g", "s", "_id", "_h", "lo", "de"])

    rows = docs.select("_id", "_h", "_text").filter(F.octet_length("_text") >= window)
    return rows.mapInArrow(run, "g long, s long, _id long, _h long, lo long, de long")


def _spread(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value ``count`` times, and the number 0.. within its repeats."""
    which = np.repeat(np.arange(len(values)), counts)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)


def _stretches(batch: pa.RecordBatch):
    """Per piece of a batch of runs: rows, their places in the piece's bytes, and the sums of two hashes."""
    data, offsets = text_bytes(batch.column("bytes"))
    for i, j in cut(offsets, PIECE):
        part = data[offsets[i]:offsets[j]]
        yield np.arange(i, j), offsets[i:j] - offsets[i], [(r, r.sums(part)) for r in (_rolling(11), _rolling(13))]


def cores(runs: DataFrame, window: int) -> DataFrame:
    """One row per run and stretch of CORE anchor distances a0..a0+CORE-1 in it: c1, c2 (hash of what its
    windows share), o (hash of all they cover; of an incomplete stretch a number of its own)."""
    in_batches(runs.sparkSession, 4096)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, s, w, de = (np.asarray(batch.column(c)) for c in ("g", "s", "w", "de"))
            for rows, places, hashes in _stretches(batch):
                most = de[rows] >> 32
                least = most - (de[rows] & 0xFFFFFFFF)
                which, k = _spread(rows, most // CORE - least // CORE + 1)
                a0 = (least[which] // CORE + k) * CORE
                a1 = a0 + CORE - 1
                at, row = (places + most)[which], rows[which]
                c1, c2 = (r.of(sums, at - a0, at - a1 + window) + mixed(a0.astype(np.uint64)) for r, sums in hashes)
                whole = (least[which] <= a0) & (most[which] >= a1)
                r, sums = hashes[0]
                own = mixed(g[row].view(np.uint64) ^ mixed(s[row].view(np.uint64) + a0.astype(np.uint64)))
                begin, end = np.where(whole, at - a1, at), np.where(whole, at - a0 + window, at)
                o = np.where(whole, r.of(sums, begin, end), own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (c1.view(np.int64), c2.view(np.int64), o.view(np.int64), g[row], s[row], w[row],
                                           np.maximum(a0, least[which]), np.minimum(a1, most[which]))],
                    ["c1", "c2", "o", "g", "s", "w", "a_from", "a_to"])

    return runs.mapInArrow(run, "c1 long, c2 long, o long, g long, s long, w long, a_from long, a_to long")


def windows(runs: DataFrame, window: int) -> DataFrame:
    """One row per window of the stretches (array ``parts`` of a_from, a_to) of a run: x1, x2 (its hash), a."""
    in_batches(runs.sparkSession, 4096)
    flat = runs.select("g", "s", "w", "de", "bytes", F.transform("parts", lambda p: p["a_from"]).alias("a_from"),
                       F.transform("parts", lambda p: p["a_to"]).alias("a_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g, s, w, de = (np.asarray(batch.column(c)) for c in ("g", "s", "w", "de"))
            lists = batch.column("a_from"), batch.column("a_to")
            counts = np.asarray(lists[0].value_lengths()).astype(np.int64)
            froms, tos = (np.asarray(x.flatten()) for x in lists)
            ends = np.cumsum(counts)
            for rows, places, hashes in _stretches(batch):
                which, k = _spread(rows, counts[rows])
                part = (ends - counts)[rows][which] + k
                inner, step = _spread(part, tos[part] - froms[part] + 1)
                row, a = which[inner], froms[part][inner] + step
                at = (places + (de[rows] >> 32))[row] - a
                x1, x2 = (r.of(sums, at, at + window) + mixed(a.astype(np.uint64)) for r, sums in hashes)
                source = rows[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (x1.view(np.int64), x2.view(np.int64), g[source], s[source], w[source], a)],
                    ["x1", "x2", "g", "s", "w", "a"])

    return flat.mapInArrow(run, "x1 long, x2 long, g long, s long, w long, a long")


def repeated_spans(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """_id, _h, spans (array of start, stop in bytes): where windows lie that also begin somewhere else.
    ``docs`` has _id, _h and _text. Spans of a text may overlap."""
    spark = docs.sparkSession
    # Counts are written before they are joined back: a join of plain shuffles can split a hot key.
    scratch = Scratch(spark)
    rows = anchors(docs, window)
    often = scratch.keep(rows.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g"), "suffix-often")
    shared = scratch.keep(rows.join(often, "g"), "suffix-anchors")

    place = F.struct("_id", "_h", "lo", "de")
    classes = scratch.keep(shared.groupBy("g", "s").agg(F.count(F.lit(1)).alias("w"), F.min(place).alias("at")),
                           "suffix-runs")
    mixed_groups = scratch.keep(classes.groupBy("g").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("g"),
                                "suffix-mixed")
    wanted = (classes.join(mixed_groups, "g").select("at._id", "at._h", F.struct("g", "s", "w", "at.lo", "at.de").alias("r"))
              .groupBy("_id", "_h").agg(F.collect_list("r").alias("wanted")))  # as long as the text at most
    runs = (docs.join(wanted, ["_id", "_h"])
            .select(F.encode("_text", "UTF-8").alias("b"), "wanted")
            .select(F.explode(F.expr(
                "transform(wanted, r -> struct(r.g as g, r.s as s, r.w as w, r.de as de, "
                f"substring(b, int(r.lo + 1), int((r.de & 4294967295) + {window})) as bytes))")).alias("r")).select("r.*"))
    runs = scratch.keep(runs, "suffix-bytes")

    parts = cores(runs, window)
    groups = parts.groupBy("c1", "c2").agg(F.sum("w").alias("all"), F.min("o").alias("o1"), F.max("o").alias("o2"))
    groups = scratch.keep(groups.filter("all > 1").select("c1", "c2", (F.col("o1") != F.col("o2")).alias("split")),
                          "suffix-groups")
    met = scratch.keep(parts.drop("o").join(groups, ["c1", "c2"]).select("g", "s", "w", "a_from", "a_to", "split"),
                       "suffix-cores")
    open_parts = met.filter("split").groupBy("g", "s").agg(F.collect_list(F.struct("a_from", "a_to")).alias("parts"))
    fine = windows(runs.join(open_parts, ["g", "s"]), window)
    twice = scratch.keep(fine.groupBy("x1", "x2").agg(F.sum("w").alias("all")).filter("all > 1").select("x1", "x2"),
                         "suffix-windows")
    found = fine.filter("w = 1").join(twice, ["x1", "x2"]).select("g", "s", F.col("a").alias("a_from"), F.col("a").alias("a_to"))
    single = (met.filter("not split and w = 1").select("g", "s", "a_from", "a_to").unionByName(found)
              .groupBy("g", "s").agg(F.collect_list(F.struct("a_from", "a_to")).alias("parts"))  # 169 at most
              .join(classes, ["g", "s"])
              .select("at._id", "at._h", F.explode(F.expr(
                  "transform(parts, p -> struct(at.lo + shiftright(at.de, 32) - p.a_to as start, "
                  f"at.lo + shiftright(at.de, 32) - p.a_from + {window} as stop))")).alias("span")))
    several = (shared.join(classes.filter("w > 1").select("g", "s"), ["g", "s"])
               .select("_id", "_h", F.struct(F.col("lo").alias("start"), F.expr(
                   f"lo + (de & 4294967295) + {window}").alias("stop")).alias("span")))
    # Rows repeated with one id and text bring the same spans, which are merged inside the tasks first.
    spans = stored(single.unionByName(several).groupBy("_id", "_h").agg(F.collect_set("span").alias("spans")),
                   "suffix-spans")
    scratch.delete()
    release(spark)
    return spans


def merged_spans(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of stretches as maximal runs, in order."""
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    new = np.append(True, starts[1:] > reach[:-1])
    return starts[new], reach[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id with n_bytes, n_removed, n_spans, spans (maximal removed runs as start, stop) and ``kept``, the bytes that stay.

    A byte goes if a window of ``window`` bytes that covers it also begins at any other place, in the same
    text or another; copies may overlap, and all is judged on the texts as they came. Windows do not cross
    texts. Texts shorter than a window, empty and missing ones lose nothing; a missing one counts as empty. Rows
    repeated with the same id and text are copies of each other, so both lose their windows. Texts of any length are cut
    into pieces inside the tasks. Other columns are left out, whatever their names.
    """
    if window < 2 * GRAM:
        raise ValueError(f"a window has at least {2 * GRAM} bytes")
    keyed = row_key(docs, id_col, text_col).select(
        F.col(id_col).alias("_given"), "_id", "_h", text_or_empty(text_col).alias("_text"))
    spans = repeated_spans(keyed.select("_id", "_h", "_text"), window)
    in_batches(docs.sparkSession)
    both = keyed.join(spans, ["_id", "_h"], "left").select(
        "_given", F.encode("_text", "UTF-8").alias("bytes"),
        *(F.coalesce(F.transform("spans", lambda s: s[end]), F.array().cast("array<long>")).alias(end) for end in ("start", "stop")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("bytes"))
            lists = batch.column("start"), batch.column("stop")
            ends = np.cumsum(np.asarray(lists[0].value_lengths()).astype(np.int64))
            starts, stops = (np.asarray(x.flatten()) for x in lists)
            out = []
            for i in range(batch.num_rows):
                text, own = data[offsets[i]:offsets[i + 1]], slice(ends[i - 1] if i else 0, ends[i])
                if own.start == own.stop:
                    out.append((len(text), 0, 0, [], text.tobytes()))
                    continue
                a, b = merged_spans(starts[own], stops[own])
                keep = np.ones(len(text), bool)
                for x, y in zip(a, b):
                    keep[x:y] = False
                out.append((len(text), int((b - a).sum()), len(a),
                            [{"start": int(x), "stop": int(y)} for x, y in zip(a, b)], text[keep].tobytes()))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct({"start": pa.int64(), "stop": pa.int64()})), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_given"), *(pa.array(c, k) for c, k in zip(zip(*out), kinds))],
                [id_col, "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    kind = both.schema["_given"].dataType.simpleString()
    return both.mapInArrow(run, f"`{id_col}` {kind}, n_bytes long, n_removed long, n_spans long, "
                                "spans array<struct<start: long, stop: long>>, kept binary")
