"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs, cut after every eighth word. Each piece is hashed to a wide vector; the
vectors are added lane by lane modulo a power of two. The sum does not depend on the order, and adding or taking
away the vector of a paragraph inserts or deletes it. Two parts make a fingerprint:

* 8 lanes modulo 2^32 from SHA-256, for equality;
* 128 cells modulo 2^32: each paragraph adds +1 or -1 to one of them. The inner product of two such rows of cells
  estimates, for texts of any length, how many paragraphs two texts share.

All of it is DataFrame functions: paragraphs are exploded and added up, by cell first, inside the task that has the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import row_key, stored, text_or_empty

LANES, CELLS = 8, 128
#: Hexadecimal digits of a lane and of a cell; both are modulo 2^32, so no cell of a text that Spark can hold wraps twice.
HEX = 8
MOD = 2 ** 32
#: Words of a piece of a paragraph.
WORDS = 8


def paragraphs(text: Column) -> Column:
    """Pieces of eight words of each line, from its start; empty ones are left out."""
    def pieces(words: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(words) - 1) / WORDS).cast("int")),
                           lambda i: F.array_join(F.slice(words, i * WORDS + 1, WORDS), " "))

    # Each line is split once and bound to a variable before its pieces are taken.
    lines = F.transform(F.split(text, "\n"), lambda line: F.split(line, " "))
    return F.filter(F.flatten(F.transform(lines, pieces)), lambda p: p != "")


def _number(digits: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(digits, start, length), 16, 10).cast("long")


def _digits(total: Column) -> Column:
    return F.lpad(F.lower(F.hex(F.pmod(total, F.lit(MOD)))), HEX, "0")


def _each(count: int, part: Callable[[Column], Column]) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), part)


def _at(fingerprint: Column, i: Column) -> Column:
    return F.conv(F.substring(fingerprint, i * HEX + 1, F.lit(HEX)), 16, 10).cast("long")


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Fingerprint of the paragraphs of ``a`` with those of ``b`` inserted (or, with -1, deleted)."""
    return F.array_join(_each(LANES + CELLS, lambda i: _digits(_at(a, i) + sign * _at(b, i))), "")


def with_likeness(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add a likeness (0 to 1) for each pair of fingerprint columns: the estimate of the paragraphs in both as a share of
    those in either, 1 for equal fingerprints. Its error is about 0.04 for half a text shared, whatever its length;
    a paragraph that comes n times weighs n squared."""
    def cell(f: str) -> Column:
        def signed(c: Column) -> Column:
            return F.when(c >= MOD // 2, c - MOD).otherwise(c).cast("double")
        return F.transform(_each(CELLS, lambda i: _at(F.col(f), i + LANES)), signed)

    def product(a: Column, b: Column) -> Column:
        return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    used = dict.fromkeys(f for pair in pairs.values() for f in pair)
    df = df.withColumns({f"_cells_{f}": cell(f) for f in used})
    df = df.withColumns({f"_norm_{f}": product(F.col(f"_cells_{f}"), F.col(f"_cells_{f}")) for f in used}
                        | {f"_both_{name}": product(F.col(f"_cells_{a}"), F.col(f"_cells_{b}")) for name, (a, b) in pairs.items()})
    made = [*(f"_{kind}_{f}" for kind in ("cells", "norm") for f in used), *(f"_both_{name}" for name in pairs)]

    def likeness(name: str, a: str, b: str) -> Column:
        both = F.col(f"_both_{name}")
        share = F.try_divide(both, F.col(f"_norm_{a}") + F.col(f"_norm_{b}") - both)
        return F.when(F.col(a) == F.col(b), 1.0).when(both > 0, share).otherwise(0.0)

    return df.withColumns({name: likeness(name, a, b) for name, (a, b) in pairs.items()}).drop(*made)


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Rows of (_id, _h, which, ``name``) from rows of (_id, _h, texts array): one for each text of the array."""
    # A missing piece stands beside the others, so that a text without any has a row too.
    units = F.flatten(F.transform(F.col(text), lambda t, which: F.transform(
        F.concat(F.array(F.lit(None).cast("string")), paragraphs(t)), lambda p: F.struct(which.alias("which"), p.alias("p")))))
    flat = docs.select("_id", "_h", F.explode(units).alias("u")).select("_id", "_h", "u.which", "u.p")
    hashed = flat.select("_id", "_h", "which", F.sha2("p", 256).alias("wide"), F.md5("p").alias("short"))
    cell, sign = _number(F.col("short"), 1, 2) % CELLS, F.when(_number(F.col("short"), 3, 1) < 8, 1).otherwise(-1)
    lanes = [f"s{i}" for i in range(LANES)]
    cells = hashed.groupBy("_id", "_h", "which", cell.alias("cell")).agg(
        *(F.sum(_number(F.col("wide"), 1 + HEX * i, HEX)).alias(s) for i, s in enumerate(lanes)), F.sum(sign).alias("v"))
    entry = F.when(F.col("cell").isNotNull(), F.struct("cell", "v"))
    added = cells.groupBy("_id", "_h", "which").agg(
        *(F.sum(s).alias(s) for s in lanes), F.map_from_entries(F.collect_list(entry)).alias("cells"))  # CELLS at most
    filled = _each(CELLS, lambda c: F.coalesce(_digits(F.try_element_at("cells", c.cast("long"))), F.lit("0" * HEX)))
    return added.select("_id", "_h", "which", F.concat(
        *(_digits(F.coalesce(F.col(s), F.lit(0))) for s in lanes), F.array_join(filled, "")).alias(name))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per different (id, text): the id and ``fingerprint``. A missing text counts as empty,
    and an empty one has the fingerprint zero. Other columns are left out, whatever their names."""
    rows = (row_key(docs, id_col, text_col).groupBy("_id", "_h")
            .agg(F.first(text_or_empty(text_col)).alias("text"), F.first(F.col(id_col)).alias("_given")))
    prints = with_fingerprint(rows.select("_id", "_h", F.array("text").alias("text")))
    return rows.select("_id", "_h", F.col("_given").alias(id_col)).join(prints.drop("which"), ["_id", "_h"]).drop("_id", "_h")


def neighbours(keys: DataFrame) -> DataFrame:
    """For each (_id, _h): p_id, p_h and p_chars of the row before it in this order; the first comes after the last.

    The rows are dealt by ranges and numbered by range; inside a range a window finds the row before, and
    only the first row of a range looks at the ranges before it, of which there are few.
    """
    spark = keys.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(keys.repartitionByRange(ranges, "_id", "_h").withColumn("_range", F.spark_partition_id()),
                   "fingerprint-order")
    me = F.struct("_id", "_h", "chars")
    order = Window.partitionBy("_range").orderBy("_id", "_h")
    lasts = dealt.groupBy("_range").agg(F.max(me).alias("last"))
    across = Window.orderBy("_range")  # one row for each range: no more rows than partitions
    everywhere = across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lasts = lasts.select("_range", F.coalesce(F.lag("last").over(across), F.last("last").over(everywhere)).alias("outer"))
    found = (dealt.withColumn("inner", F.lag(me).over(order))
             .join(F.broadcast(lasts), "_range")  # as many rows as there are ranges
             .withColumn("before", F.coalesce("inner", "outer")))
    return found.select("_id", "_h", F.col("before._id").alias("p_id"), F.col("before._h").alias("p_h"),
                        F.col("before.chars").alias("p_chars"))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edit, whose last quarter gives way to the start of the next text.

    The last floor(n/4) of a text's n characters are replaced by as many (or all) of the next text by id; after the last
    comes the first. Returns id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next. One row per input row: repeats of a row (same id, same text) get the same result, and count once in
    the order; different texts of one id follow each other by a hash. A missing id comes first. Missing texts count
    as empty. An only document is its own next. Other columns are left out, whatever their names.
    """
    keyed = row_key(docs, id_col, text_col).withColumn("_text", text_or_empty(text_col))
    keys = stored(keyed.groupBy("_id", "_h").agg(
        F.max(F.length("_text")).cast("long").alias("chars"), F.count(F.lit(1)).alias("repeats"),
        F.max(F.col(id_col)).alias("_given")), "fingerprint-keys")
    before = stored(neighbours(keys.select("_id", "_h", "chars")), "fingerprint-before")
    # One text per key, combined inside the tasks first; both uses below share this shuffle.
    texts = keyed.groupBy("_id", "_h").agg(F.first("_text").alias("_text"))
    starts = (texts.join(before, ["_id", "_h"])
              .select(F.col("p_id").alias("_id"), F.col("p_h").alias("_h"),
                      F.expr("substring(_text, 1, int(p_chars div 4))").alias("_start")))
    both = texts.join(starts, ["_id", "_h"])
    edited = F.expr("concat(substring(_text, 1, int(length(_text) - length(_text) div 4)), _start)")
    both = both.select("_id", "_h", "_text", edited.alias("_edited"))
    prints = with_fingerprint(both.select("_id", "_h", F.array("_text", "_edited").alias("texts")), "texts")
    hashes = both.select("_id", "_h", F.sha2("_edited", 256).alias("edited_sha256"))
    first, second = (F.max(F.when(F.col("which") == i, F.col("fingerprint"))) for i in (0, 1))
    prints = stored(prints.groupBy("_id", "_h").agg(first.alias("fingerprint"), second.alias("edited_fingerprint"))
                    .join(hashes, ["_id", "_h"]), "fingerprint-prints")
    following = (prints.join(before, ["_id", "_h"])
                 .select(F.col("p_id").alias("_id"), F.col("p_h").alias("_h"), F.col("fingerprint").alias("_next")))
    rows = (prints.join(following, ["_id", "_h"]).join(keys, ["_id", "_h"])
            .withColumn("_repeat", F.explode(F.sequence(F.lit(1).cast("long"), F.col("repeats")))))
    near = with_likeness(rows, {"near_edited": ("fingerprint", "edited_fingerprint"), "near_next": ("fingerprint", "_next")})
    return near.select(F.col("_given").alias(id_col), F.col("chars").alias("n_chars"), "edited_sha256", "fingerprint",
                       "edited_fingerprint", "near_edited", "near_next")


def edited_sql() -> str:
    """The same over ``documents`` in SQL, for tables in which no id comes twice."""
    lanes = ", ".join(f"sum(('0x' || substr(w, {1 + HEX * i}, {HEX}))::bigint) AS s{i}" for i in range(LANES))
    cells = ", ".join(f"sum(CASE WHEN cell = {c} THEN v END) AS c{c}" for c in range(CELLS))
    digits = "printf('%08x', ((coalesce({0}, 0) % {1} + {1}) % {1})::bigint)"
    text = " || ".join(digits.format(x, MOD) for x in [f"s{i}" for i in range(LANES)] + [f"c{c}" for c in range(CELLS)])

    def signed(f: str) -> str:
        number = f"('0x' || substr({f}, {1 + HEX * LANES} + i * {HEX}, {HEX}))::bigint"
        return f"list_transform(range({CELLS}), lambda i: (CASE WHEN {number} >= {MOD // 2} THEN {number} - {MOD} ELSE {number} END)::double)"

    return f"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, lead(coalesce(text, '')) OVER (ORDER BY doc_id) AS nt,
    first_value(coalesce(text, '')) OVER (ORDER BY doc_id) AS ft,
    coalesce(lead(doc_id) OVER (ORDER BY doc_id), first_value(doc_id) OVER (ORDER BY doc_id)) AS next_id
  FROM documents),
e AS (
  SELECT doc_id, next_id, t, length(t) AS n,
    substr(t, 1, length(t) - length(t) // 4) || substr(coalesce(nt, ft), 1, length(t) // 4) AS ed FROM d),
lines AS (
  SELECT doc_id, which, string_split(unnest(string_split(x, chr(10))), ' ') AS ws
  FROM (SELECT doc_id, 0 AS which, t AS x FROM e UNION ALL SELECT doc_id, 1, ed FROM e)),
u AS (
  SELECT doc_id, which, array_to_string(ws[i * {WORDS} + 1 : i * {WORDS} + {WORDS}], ' ') AS p
  FROM (SELECT doc_id, which, ws, unnest(range(0, (len(ws) - 1) // {WORDS} + 1)) AS i FROM lines)),
h AS (
  SELECT doc_id, which, sha256(p) AS w, md5(p) AS m FROM u WHERE p <> ''),
g AS (
  SELECT doc_id, which, w, ('0x' || substr(m, 1, 2))::bigint % {CELLS} AS cell,
    CASE WHEN ('0x' || substr(m, 3, 1))::bigint < 8 THEN 1 ELSE -1 END AS v FROM h),
s AS (SELECT doc_id, which, {lanes}, {cells} FROM g GROUP BY ALL),
f AS (
  SELECT k.doc_id, k.which, {text} AS fp
  FROM (SELECT doc_id, unnest([0, 1]) AS which FROM e) k LEFT JOIN s USING (doc_id, which)),
r AS (
  SELECT e.doc_id, n, sha256(ed) AS edited_sha256, a.fp AS fa, b.fp AS fb, c.fp AS fc
  FROM e JOIN f a ON a.doc_id = e.doc_id AND a.which = 0 JOIN f b ON b.doc_id = e.doc_id AND b.which = 1
  JOIN f c ON c.doc_id = e.next_id AND c.which = 0),
pairs AS (SELECT doc_id, 1 AS k, fa AS x, fb AS y FROM r UNION ALL SELECT doc_id, 2, fa, fc FROM r),
cut AS (SELECT doc_id, k, x = y AS alike, {signed("x")} AS cx, {signed("y")} AS cy FROM pairs),
near AS (
  SELECT doc_id, k, CASE WHEN alike THEN 1.0::double WHEN list_inner_product(cx, cy) <= 0 THEN 0.0::double
    ELSE list_inner_product(cx, cy) / (list_inner_product(cx, cx) + list_inner_product(cy, cy) - list_inner_product(cx, cy))
    END AS near FROM cut)
SELECT r.doc_id, n AS n_chars, edited_sha256, fa AS fingerprint, fb AS edited_fingerprint,
  a.near AS near_edited, b.near AS near_next
FROM r JOIN near a ON a.doc_id = r.doc_id AND a.k = 1 JOIN near b ON b.doc_id = r.doc_id AND b.k = 2"""
