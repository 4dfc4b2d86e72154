"""Near duplicates by DartMinHash signatures and a banded join.

A text is a weighted set: its shingles of five words, each as heavy as it is frequent. Weight is laid out in regions [0,1),
[1,2), [2,4), [4,8), ... of each shingle. Hashed darts fall into every region at a steady rate over a second
axis, the rank; a dart counts if it lies below the shingle's weight. Each dart belongs to one of K coordinates, and a
coordinate keeps its dart of least rank. Only ranks up to about (K ln K + 3 K) / total weight are thrown, so
a signature costs the same for short and long texts beyond reading them. Two signatures agree in a
coordinate with the odds of the weighted Jaccard similarity.

Texts with equal words are one node from the start. Nodes that agree in a band of six coordinates are compared with the
least node of that bucket, so a bucket of n gives n candidates and a large group is held together by few leaders. Where this leaves members of several classes in a bucket, as in a
family of texts on one template, an exact join over the shingles of these members finds the rest: of two near texts, in the
order from rare to common shingles, the first that they share lies early in both, so a shingle is a key for
the few texts only that have it at their beginning, and texts that each differ from the template by edits of their own never meet.
Where many would meet still, each is first compared with few neighbours in a drawn order, turn by turn, and classes that a link
joins are one from then on, so that all pairs are made only of the classes that are left.
Candidates are judged by their signatures when
these leave no doubt, and by their exact shingles otherwise; classes are the connected components of the links.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .byte_hashes import Rolling, mixed, text_bytes, word_hashes
from .common import Scratch, in_batches, located, quoted, release, stored, text_or_empty, unused, worker_cached
from .components import components

SHINGLE = 5
ROWS, BANDS = 6, 42
COORDINATES = ROWS * BANDS
SIMILARITY = 0.8
#: Signatures within this distance of the threshold (four standard errors) are settled by exact shingles.
DOUBT = 0.1
#: Sizes of texts that meet are dealt into bins of this ratio.
SIZE_STEP = 1.04
#: Room for rounding in sums of weights.
SLACK = 1e-9
#: With more meetings a text than CROWD, neighbours by a drawn order are linked before all pairs are made.
CROWD = 16
#: Followers that a row is compared with in one turn, and texts of a cell in which it has them.
REACH, CELL = 16, 1024
#: Bytes whose words are hashed at a time; a worker keeps 32 bytes of powers for each.
PIECE = 1 << 17


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits, parted by single blanks."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}]+", " "))


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of five words, and where each text's begin. A text of fewer words has one, all its words."""
    rolling = worker_cached(("rolling", 21), lambda: Rolling(2 * PIECE, 21))
    found, begins = word_hashes(data, offsets, rolling, PIECE)
    sizes = np.diff(begins)
    counts = np.where(sizes > 0, np.maximum(sizes - SHINGLE + 1, 1), 0)
    starts = np.append(0, np.cumsum(counts))
    first = np.repeat(begins[:-1], counts) + np.arange(starts[-1]) - np.repeat(starts[:-1], counts)
    stop = np.repeat(begins[1:], counts)
    padded = np.append(found, np.zeros(SHINGLE, np.uint64))
    out = np.zeros(len(first), np.uint64)
    for k in range(SHINGLE):
        out = out * np.uint64(0xD6E8FEB86659FD93) + np.where(first + k < stop, padded[first + k], np.uint64(0))
    return mixed(out), starts


def weighted(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of each text with their weights, and the number of their text."""
    doc = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    order = np.lexsort((hashes, doc))
    h, d = hashes[order], doc[order]
    new = np.empty(len(h), bool)
    new[:1] = True
    new[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    at = np.flatnonzero(new)
    return h[at], np.diff(np.append(at, len(h))).astype(np.float64), d[at]


def _throw(best: np.ndarray, element: np.ndarray, weight: np.ndarray, doc: np.ndarray, limit: np.ndarray) -> None:
    """Throw the darts of ranks below ``limit`` of each text and keep the least of each coordinate in ``best``."""
    regions = np.where(weight > 1, np.ceil(np.log2(np.maximum(weight, 1))), 0).astype(np.int64) + 1
    which = np.repeat(np.arange(len(element)), regions)
    region = np.arange(len(which)) - np.repeat(np.cumsum(regions) - regions, regions)
    low = np.where(region > 0, 2.0 ** (region - 1), 0.0)
    wide = np.where(region > 0, low, 1.0)
    seed = mixed(element[which] + region.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    need, goal, home, heavy = limit[doc[which]], wide, doc[which] * COORDINATES, weight[which]
    number = np.zeros(len(seed), np.int64)
    reached = np.zeros(len(seed))
    alive = np.arange(len(seed))
    while len(alive):
        # Regions of like expected numbers of darts are handled together, as a matrix of successive arrivals.
        expected = (need[alive] - reached[alive]) * goal[alive]
        power = np.clip(np.ceil(np.log2(np.maximum(expected, 0.25))), -2, 11).astype(np.int64)
        rest = []
        for p in np.unique(power):
            rows_all = alive[power == p]
            width = 1 if p < 0 else int(1.3 * 2 ** p) + 4
            for k in range(0, len(rows_all), max(1, (1 << 18) // width)):
                rows = rows_all[k:k + max(1, (1 << 18) // width)]
                nth = (number[rows][:, None] + np.arange(width)).astype(np.uint64)
                h = mixed(seed[rows][:, None] + nth * np.uint64(0x9E3779B97F4A7C15))
                gap = -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) / 2 ** 53) / goal[rows][:, None]
                rank = reached[rows][:, None] + np.cumsum(gap, axis=1)
                inside = rank < need[rows][:, None]
                r, c = np.nonzero(inside)
                dart = mixed(h[r, c] ^ np.uint64(0x5851F42D4C957F2D))
                owner = rows[r]
                height = low[owner] + wide[owner] * ((dart & np.uint64(0xFFFFF)).astype(np.float64) / 2 ** 20)
                under = height < heavy[owner]
                dart, owner, ranks = dart[under], owner[under], rank[r, c][under]
                coordinate = ((dart >> np.uint64(44)) * np.uint64(COORDINATES)) >> np.uint64(20)
                mark = mixed(dart) & np.uint64(0xFFFF)
                np.minimum.at(best, home[owner] + coordinate.astype(np.int64),
                              (ranks.view(np.uint64) & ~np.uint64(0xFFFF)) | mark)
                going = inside[:, -1]
                reached[rows] = rank[:, -1]
                number[rows] += width
                rest.append(rows[going])
        alive = np.concatenate(rest) if rest else alive[:0]


def signatures(element: np.ndarray, weight: np.ndarray, doc: np.ndarray, texts: int) -> np.ndarray:
    """One row of COORDINATES 16-bit marks for each text; rows of texts without shingles are zero."""
    none = np.uint64(2 ** 64 - 1)
    total = np.bincount(doc, weight, texts)
    best = np.full(texts * COORDINATES, none)
    darts = COORDINATES * math.log(COORDINATES) + 3 * COORDINATES
    missing = total > 0
    while missing.any():
        take = missing[doc]
        limit = np.where(missing, darts / np.maximum(total, 1e-300), 0.0)
        _throw(best, element[take], weight[take], doc[take], limit)
        missing &= (best.reshape(texts, COORDINATES) == none).any(axis=1)
        darts *= 2
    marks = (best & np.uint64(0xFFFF)).astype(np.uint16).reshape(texts, COORDINATES)
    marks[total == 0] = 0
    return marks


def signed(docs: DataFrame) -> DataFrame:
    """id, _f and _row (its place), node (a number), h1 and h2 (hash of its words), n (its shingles), sig, of rows with _id and _words."""
    in_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("_words"))
            hashes, starts = shingles(data, offsets)
            element, weight, doc = weighted(hashes, starts)
            sig = signatures(element, weight, doc, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "_f", "_row", "h1", "h2")), pa.array(np.diff(starts)),
                 pa.array([row.tobytes() for row in sig], pa.binary())], ["id", "_f", "_row", "h1", "h2", "n", "sig"])

    digest = F.md5("_words")
    halves = [F.conv(F.substring(digest, start, 15), 16, 10).cast("long") for start in (1, 17)]
    rows = docs.select("id", "_f", "_row", halves[0].alias("h1"), halves[1].alias("h2"), "_words")
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, _f long, _row long, h1 long, h2 long, n long, sig binary").withColumn(
        "node", F.monotonically_increasing_id())


def shared_buckets(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """band, node, low (the least node of the bucket) and n (its nodes), where n > 1."""
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(
        b, F.substring("sig", b * 2 * ROWS + 1, F.lit(2 * ROWS))))
    rows = nodes.select("node", F.explode(bands).alias("band"))
    heads = rows.groupBy("band").agg(F.min("node").alias("low"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    heads = scratch.keep(heads, "near-buckets")  # written first, so that the join can split a hot bucket
    return scratch.keep(rows.join(heads, "band").select("band", "node", "low", "n"), "near-met")


def candidates(met: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes that share a bucket of ``met`` with a or b at its head."""
    return (met.filter("node <> low").select(F.least("node", "low").alias("a"), F.greatest("node", "low").alias("b")).distinct())


def undecided(met: DataFrame, labels: DataFrame, scratch: Scratch) -> DataFrame:
    """node, label of the members of buckets of ``met`` whose members are not all of one label."""
    named = scratch.keep(met.filter("n > 2").join(labels, "node", "left").select(
        "band", "node", F.coalesce("label", "node").alias("label")), "near-named")
    mixed_bands = (named.groupBy("band").agg(F.min("label").alias("least"), F.max("label").alias("most"))
                   .filter("least < most").select("band"))
    return named.join(scratch.keep(mixed_bands, "near-bands"), "band").select("node", "label").distinct()


def joined_classes(labels: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` after further links among ``nodes`` (node, label): only the classes that they join are gone through again."""
    ends = [nodes.select(F.col("node").alias(end), F.col("label").alias(f"class_{end}")) for end in ("a", "b")]
    classes = links.join(ends[0], "a").join(ends[1], "b").select(F.col("class_a").alias("a"), F.col("class_b").alias("b"))
    moved = components(classes)
    onto = moved.select(F.col("node").alias("label"), F.col("label").alias("onto"))
    kept = labels.join(onto, "label", "left").select("node", F.coalesce("onto", "label").alias("label"))
    return stored(kept.union(moved.join(labels, "node", "left_anti").select("node", "label")), "near-labels")


def shingle_rows(texts: DataFrame) -> DataFrame:
    """node, label, total (weight of all shingles), shingle, weight of texts with node, label and _words."""
    in_batches(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            element, weight, doc = weighted(*shingles(*text_bytes(batch.column("_words"))))
            total = np.bincount(doc, weight, batch.num_rows)
            node, label = (batch.column(c).to_numpy() for c in ("node", "label"))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (node[doc], label[doc], total[doc], element.view(np.int64), weight)],
                ["node", "label", "total", "shingle", "weight"])

    return texts.select("node", "label", "_words").mapInArrow(run, "node long, label long, total double, shingle long, weight double")


def beginnings(texts: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """node, label, total, rest (weight from this shingle on), shingle, texts (that have it), bin and small, of the shingles by which
    texts (node, label, _words) of different labels can meet.

    Similar texts have an overlap of at least s / (1 + s) of their weights together. In any order common to all texts, what a
    text holds from the first shared shingle on bounds the overlap, so that shingle lies within the first 1 - s of the larger
    text and the first (1 - s) / (1 + s) of the smaller one. The order is from rare to common, which makes these
    beginnings differ where the texts do. A text lies in the bins of all sizes that a smaller partner can have; as a smaller
    partner itself, where ``small`` says so, in the bin of its own size, which is one of them.
    """
    rows = scratch.keep(shingle_rows(texts), "near-shingles")
    shared = (rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("texts"), F.min("label").alias("least"), F.max("label").alias("most"))
              .filter("texts > 1"))
    onward = Window.partitionBy("node").orderBy("texts", "shingle").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    early = (rows.join(scratch.keep(shared, "near-shared"), "shingle").withColumn("rest", F.sum("weight").over(onward))
             .filter((F.col("rest") >= similarity * F.col("total") - SLACK) & (F.col("least") < F.col("most"))))
    share = similarity / (1 + similarity)

    def size(weight: Column) -> Column:
        return F.floor(F.log(weight) / math.log(SIZE_STEP)).cast("int")

    most = F.least(F.col("total"), F.col("rest") / share - F.col("total"))
    least = similarity * F.col("total") - SLACK
    own = (F.col("rest") >= 2 * share * F.col("total") - SLACK) & (F.col("bin") == size(F.col("total")))
    binned = early.filter(most >= least).withColumn("bin", F.explode(F.sequence(size(least), size(most + SLACK))))
    return scratch.keep(binned.select("node", "label", "total", "rest", "shingle", "texts", "bin", own.alias("small")), "near-early")


def relabelled(open_nodes: DataFrame, labels: DataFrame) -> DataFrame:
    """``open_nodes`` (node) with the label of ``labels``; a node alone has its own."""
    return open_nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("label", "node").alias("label"))


def in_play(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``beginnings`` that meet one of another label, one of the two as the smaller partner. Links make labels
    equal, so what is out once stays out, and each turn goes through what the one before left."""
    small = F.when(F.col("small"), F.col("label"))
    keys = rows.groupBy("shingle", "bin").agg(F.min("label").alias("least"), F.max("label").alias("most"),
                                              F.min(small).alias("least_small"), F.max(small).alias("most_small"))
    keys = scratch.keep(keys.filter("least < most and least_small is not null"), "near-keys")
    here = rows.join(keys, ["shingle", "bin"]).filter("small or label <> least_small or label <> most_small")
    return scratch.keep(here.select(rows.columns), "near-rows")


def meetings(rows: DataFrame) -> int:
    """How often texts of different labels meet in a shingle and bin of ``rows``, if all pairs were made."""
    by_label = rows.groupBy("shingle", "bin", "label").agg(F.sum(F.col("small").cast("long")).alias("s"), F.count(F.lit(1)).alias("n"))
    by_key = by_label.groupBy("shingle", "bin").agg((F.sum("s") * F.sum("n") - F.sum(F.col("s") * F.col("n"))).alias("met"))
    return by_key.agg(F.sum("met")).first()[0] or 0


def can_be_near(one: str, two: str, similarity: float) -> Column:
    """Whether what both texts hold from a shared shingle on leaves room for the overlap."""
    both = similarity / (1 + similarity) * (F.col(f"{one}.total") + F.col(f"{two}.total")) - SLACK
    return ((F.col(f"{one}.label") != F.col(f"{two}.label")) & (F.col(f"{one}.rest") >= both) & (F.col(f"{two}.rest") >= both))


def ordered(one: str, two: str) -> list[Column]:
    return [F.least(f"{one}.node", f"{two}.node").alias("a"), F.greatest(f"{one}.node", f"{two}.node").alias("b")]


def neighbours(rows: DataFrame, turn: int, similarity: float) -> DataFrame:
    """Pairs (a, b) of texts of different labels that are next to each other in a shingle and bin, in an order drawn for the turn:
    no more than REACH a row. Crowds are dealt into cells first, by the same draw."""
    draw = F.xxhash64("node", F.lit(turn))
    cell = F.pmod(F.xxhash64("node", F.lit(-1 - turn)), F.greatest(F.lit(1), (F.col("texts") / CELL).cast("long")))
    after = Window.partitionBy("shingle", "bin", "cell").orderBy("draw", "node").rowsBetween(1, REACH)
    one = F.struct("node", "label", "total", "rest")
    near = rows.withColumns({"draw": draw, "cell": cell, "one": one}).select("one", F.collect_list("one").over(after).alias("after"))
    # filtered before they are unrolled: most followers in a crowd are of one class
    other = near.select("one", F.explode(F.filter("after", lambda two: two["label"] != F.col("one.label"))).alias("two"))
    return other.filter(can_be_near("one", "two", similarity)).select(*ordered("one", "two")).distinct()


def all_meeting(rows: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of the texts of ``rows`` (see ``in_play``), of different labels, that can be similar."""
    pairs = rows.filter("small").alias("small").join(rows.alias("large"), ["shingle", "bin"]).filter(
        (F.col("small.total") <= F.col("large.total")) & can_be_near("small", "large", similarity))
    return pairs.select(*ordered("small", "large")).distinct()


def sharing(texts: DataFrame, similarity: float, scratch: Scratch) -> DataFrame:
    """Pairs (a, b) of texts (node, label, _words) of different labels that can be similar: all that are, and few others."""
    return all_meeting(in_play(beginnings(texts, similarity, scratch), scratch), similarity)


def judged(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """a, b, alike: the share of coordinates in which the signatures agree."""
    in_batches(pairs.sparkSession, 4096)
    one, two = (nodes.select(F.col("node").alias(n), F.col("sig").alias(f"sig_{n}")) for n in ("a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [text_bytes(batch.column(c))[0].view(np.uint16).reshape(-1, COORDINATES) for c in ("sig_a", "sig_b")]
            alike = (marks[0] == marks[1]).mean(axis=1) if batch.num_rows else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(alike)], ["a", "b", "alike"])

    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long, alike double")


def weighted_jaccard(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b, similarity of the exact shingles; ``texts`` has node and _words."""
    in_batches(pairs.sparkSession)
    one, two = (texts.select(F.col("node").alias(n), F.col("_words").alias(f"words_{n}")) for n in ("a", "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bags = [weighted(*shingles(*text_bytes(batch.column(c)))) for c in ("words_a", "words_b")]
            pair = np.concatenate([b[2] for b in bags])
            h, w = (np.concatenate([b[i] for b in bags]) for i in (0, 1))
            order = np.lexsort((h, pair))
            h, w, pair = h[order], w[order], pair[order]
            same = np.flatnonzero((h[1:] == h[:-1]) & (pair[1:] == pair[:-1]))
            common = np.bincount(pair[same], np.minimum(w[same], w[same + 1]), batch.num_rows)
            union = np.bincount(pair, w, batch.num_rows) - common
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"),
                                              pa.array(common / np.maximum(union, 1))], ["a", "b", "similarity"])

    return pairs.join(one, "a").join(two, "b").mapInArrow(run, "a long, b long, similarity double")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 similarity: float = SIMILARITY) -> DataFrame:
    """One row per input row: id, class_id (least id of its class), class_size, n_links (links by which its text was joined to
    different texts; two texts of one class that were never compared count none), kept, and its place (_file, _row or their hash _f).

    Rows are of one class if a chain of texts connects them whose neighbours have five-word shingles of a weighted Jaccard
    similarity of at least ``similarity``. Words are runs of letters and digits in lower case; a text of fewer than five
    words is one shingle. Texts without words, empty or missing, are alone. Rows with equal words are one class.
    Of each class the row with the least id is kept, the first by place among repeats of it; a missing id comes first.
    An empty table gives no rows. Other columns are left out, whatever their names.
    """
    located_rows, file, row = located(docs)
    return _near_classes(located_rows, file, row, id_col, text_col, similarity)


def _near_classes(located_rows: DataFrame, file: str, row: str, id_col: str, text_col: str, similarity: float) -> DataFrame:
    spark = located_rows.sparkSession
    rows = located_rows.select(F.col(id_col).alias("id"), F.xxhash64(file).alias("_f"), F.col(row).alias("_row"),
                               words(text_or_empty(text_col)).alias("_words"))
    whole = located_rows.select(F.xxhash64(file).alias("_f"), F.col(row).alias("_row"), text_or_empty(text_col).alias("_text"))
    scratch = Scratch(spark)
    table = scratch.keep(signed(rows), "near-signatures")
    heads = table.filter("n > 0").groupBy("h1", "h2").agg(F.min("node").alias("head"))
    nodes = scratch.keep(table.join(heads, F.col("node") == F.col("head"), "left_semi").filter("n > 0"), "near-nodes")

    def texts_at(placed: DataFrame, label: str) -> DataFrame:
        """_words of the few texts that ``placed`` names by _f and _row; words are taken after the join, from these texts only.
        The places are written first, so that their size decides the join."""
        places = scratch.keep(placed, "near-places")
        found = whole.join(places, ["_f", "_row"]).withColumn("_words", words(F.col("_text")))
        return scratch.keep(found.drop("_f", "_row", "_text"), label)

    def linked(pairs: DataFrame) -> DataFrame:
        likely = scratch.keep(judged(pairs, nodes.select("node", "sig")), "near-judged")
        sure = likely.filter(F.col("alike") >= similarity + DOUBT).select("a", "b")
        open_pairs = likely.filter((F.col("alike") < similarity + DOUBT) & (F.col("alike") >= similarity - DOUBT))
        open_nodes = open_pairs.select(F.col("a").alias("node")).union(open_pairs.select("b")).distinct()
        texts = texts_at(nodes.join(open_nodes, "node").select("node", "_f", "_row"), "near-texts")
        exact = weighted_jaccard(open_pairs.select("a", "b"), texts).filter(F.col("similarity") >= similarity)
        return stored(sure.union(exact.select("a", "b")), "near-links")

    met = shared_buckets(nodes.select("node", "sig"), scratch)
    links = linked(scratch.keep(candidates(met), "near-candidates"))
    labels = components(links)
    open_nodes = scratch.keep(undecided(met, labels, scratch), "near-open")
    if not open_nodes.isEmpty():
        texts = texts_at(nodes.join(open_nodes, "node").select("node", "label", "_f", "_row"), "near-open-texts")
        rows = beginnings(texts, similarity, scratch)
        before = math.inf
        for turn in itertools.count():
            rows = in_play(rows, scratch)
            left = meetings(rows)
            # texts of one class need not meet, so each turn leaves fewer pairs; it ends where they are few, or mostly unlike
            crowded = CROWD * open_nodes.count() < left < 0.9 * before
            before = left
            pairs = neighbours(rows, turn, similarity) if crowded else all_meeting(rows, similarity)
            found = linked(scratch.keep(pairs, "near-candidates"))
            if not found.isEmpty():
                labels = joined_classes(labels, open_nodes, found)
                links = links.union(found)
            if not crowded:
                break
            open_nodes = scratch.keep(relabelled(open_nodes, labels), "near-open")
            rows = scratch.keep(rows.drop("label").join(open_nodes, "node").select(rows.columns), "near-rows")
    degree = links.select(F.explode(F.array("a", "b")).alias("head")).groupBy("head").agg(F.count(F.lit(1)).alias("n_links"))

    in_class = (table.select("id", "_f", "_row", "node", F.when(F.col("n") > 0, F.col("h1")).otherwise(F.col("node")).alias("h1"),
                             F.when(F.col("n") > 0, F.col("h2")).alias("h2"), "n"))
    heads = heads.join(labels, F.col("head") == F.col("node"), "left").join(degree, "head", "left").select(
        "h1", "h2", "head", F.coalesce("label", "head").alias("label"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    heads = stored(heads, "near-heads")
    worded = in_class.filter("n > 0").join(heads, ["h1", "h2"]).select("id", "_f", "_row", "label", "n_links")
    alone = in_class.filter("n = 0").select("id", "_f", "_row", (-1 - F.col("node")).alias("label"), F.lit(0).cast("long").alias("n_links"))
    labelled = stored(worded.union(alone), "near-labelled")
    scratch.delete()
    release(spark)
    classes = stored(labelled.groupBy("label").agg(
        F.min(F.struct("id", "_f", "_row")).alias("keep"), F.count(F.lit(1)).alias("class_size")), "near-classes")
    return labelled.join(classes, "label").select(
        "id", F.col("keep.id").alias("class_id"), "class_size", "n_links",
        (F.struct("id", "_f", "_row") == F.col("keep")).alias("kept"), "_f", "_row")


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     similarity: float = SIMILARITY) -> DataFrame:
    """``docs`` with one row of each class of ``near_classes``; all columns as they were."""
    rows, file, row = located(docs)
    place, line = unused(rows, "_place"), unused(rows, "_line")
    dropped = (_near_classes(rows, file, row, id_col, text_col, similarity).filter("not kept")
               .select(F.col("_f").alias(place), F.col("_row").alias(line)))
    named = rows.withColumn(place, F.xxhash64(file)).withColumn(line, F.col(row))
    return named.join(dropped, [place, line], "left_anti").select(*map(quoted, docs.columns))
