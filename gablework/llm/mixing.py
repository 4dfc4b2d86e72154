"""Mixing sources to target weights by Poisson replication.

A source with target share w of ``total`` units and u units of its own is repeated at the rate
w * total / u. Each document gets a whole number of copies: a uniform number hashed from the seed
and the document is put through the inverse of the Poisson distribution with that mean, so every
document is decided alone, again and again alike, without any state or sort. The document is
exploded by its count and all copies are dealt over the cluster by a hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from .common import located, numbered, quoted, stored, unused

#: Means above this are summed from equal parts, as exp(-mean) would vanish.
LARGEST_PART = 256.0
HEX = 13  # hexadecimal digits of a hash that make a uniform number: 52 bits


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) hashed from the parts, the same in any engine that has md5."""
    whole = F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, HEX), 16, 10).cast("long")
    return (whole.cast("double") + 0.5) / float(16 ** HEX)


def poisson_inverse(u: Column, mean: Column) -> Column:
    """The least k with P(X <= k) > u for X of a Poisson distribution with ``mean`` (at most 256).

    The search goes up to mean + 12 sqrt(mean) + 40; beyond it lies less than the smallest step
    of ``u``, so nothing is cut off.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")
    start = F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("c"))

    def step(a: Column, i: Column) -> Column:
        p = a["p"] * mean / i
        return F.when(a["c"] > u, a).otherwise(
            F.struct(i.alias("k"), p.alias("p"), (a["c"] + p).alias("c")))

    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["k"])


def copies(seed: int, key: list[Column], mean: Column) -> Column:
    """Poisson count of a document, hashed from seed and key; large means are summed from parts."""
    parts = F.greatest(F.lit(1), F.ceil(mean / LARGEST_PART).cast("int"))
    counts = F.transform(F.sequence(F.lit(1), parts), lambda part: poisson_inverse(
        uniform(F.lit(str(seed)), *key, part.cast("string")), mean / parts))
    return F.when(mean > 0, F.aggregate(counts, F.lit(0), lambda a, x: a + x)).otherwise(0)


def size_of(text: str) -> Column:
    """Units of a document: its characters, at least one."""
    return F.greatest(F.coalesce(F.length(text), F.lit(0)), F.lit(1)).cast("long")


def rates(docs: DataFrame, source: str, text: str, weights: Mapping[str | None, float] | None,
          flatten: float, epochs: float) -> DataFrame:
    """source, rate: mean number of copies of each document of the source."""
    units = docs.groupBy(F.col(source).alias("_mix_source")).agg(F.sum(size_of(text)).alias("_mix_units"))
    if weights is None:
        share = F.pow(F.col("_mix_units").cast("double"), F.lit(flatten))
    else:
        spelled = [F.when(F.col("_mix_source").eqNullSafe(F.lit(k)), F.lit(float(w))) for k, w in weights.items()]
        share = F.coalesce(*spelled, F.lit(0.0))
    units = units.withColumn("_mix_share", share)
    whole = units.agg(F.sum("_mix_units").alias("_mix_all"), F.sum("_mix_share").alias("_mix_shares"))
    return units.join(F.broadcast(whole)).select(  # one row
        "_mix_source", F.when(F.col("_mix_shares") > 0, F.round(
            F.lit(float(epochs)) * F.col("_mix_all") * F.col("_mix_share") / F.col("_mix_shares") / F.col("_mix_units"), 9))
        .otherwise(0.0).alias("_mix_rate"))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, *, flatten: float = 0.5,
        epochs: float = 1.0, seed: int = 17, id_col: str = "doc_id", source: str = "source",
        text: str = "text", partitions: int | None = None) -> DataFrame:
    """Replicate documents so that the units of each source come to their target share.

    ``weights`` gives a share to each source (None: the rows without one); a source that it does
    not name gets none, so its rows go. Without weights a source's share is its units to the power ``flatten``.
    The result has about ``epochs`` times the units of the input. Units are characters, at least one
    a row, so empty and missing texts are mixed too. Columns are those of ``docs`` and ``_copy``
    (1, 2, ...; with more underscores if ``docs`` has such a column); rows are dealt by a hash of seed, id, text and
    copy, and lie in that order. Rows repeated with the same id and text are numbered and draw for themselves, so
    a source of equal rows meets its weight too, and their copies are spread. An empty table gives an empty one.
    """
    names = {n: unused(docs, n) for n in ("_mix_source", "_mix_rate", "_mix_n", "_mix_deal", "_mix_nth", "_copy")}
    units, rate, many, deal, nth, copy = names.values()
    # Stored, so that its size is known: it is broadcast while small, else joined without a hint.
    wanted = stored(rates(docs, source, text, weights, flatten, epochs), "mixing-rates").toDF(units, rate)
    plain = [F.coalesce(quoted(id_col).cast("string"), F.lit("")), F.coalesce(quoted(text), F.lit(""))]
    key = [plain[0], F.md5(plain[1]), F.when(F.col(nth) > 0, F.col(nth).cast("string"))]
    rows = with_occurrence(docs, F.xxhash64(*plain), nth)
    rows = rows.join(wanted, quoted(source).eqNullSafe(F.col(units))).withColumn(many, copies(seed, key, F.col(rate)))
    rows = rows.filter(F.col(many) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(many))))
    rows = rows.withColumn(deal, F.xxhash64(F.lit(seed), *key, F.col(copy)))
    rows = rows.repartition(partitions, deal) if partitions else rows.repartition(deal)
    return rows.sortWithinPartitions(deal).select(*map(quoted, docs.columns), copy)


def with_occurrence(docs: DataFrame, same: Column, name: str) -> DataFrame:
    """``docs`` with the column ``name``: how many rows of equal ``same`` come before each row, by their places.

    Only rows that have an equal one are numbered, by ranges of (same, place), so a frequent row is split.
    """
    counts = docs.select(same.alias("same")).groupBy("same").agg(F.count(F.lit(1)).alias("n"))
    repeated = stored(counts.filter("n > 1").select("same"), "mixing-repeated")
    if repeated.isEmpty():
        return docs.withColumn(name, F.lit(0).cast("long"))
    rows, file, row = located(docs)
    places = rows.select(same.alias("same"), F.col(file).alias("file"), F.col(row).alias("row")).join(repeated, "same")
    placed = stored(numbered(places, ["same", "file", "row"], "place", "mixing-places"), "mixing-numbers")
    firsts = stored(placed.groupBy("same").agg(F.min("place").alias("first")), "mixing-firsts")
    found = {c: unused(rows, c) for c in ("_mix_file", "_mix_row")}
    nth = placed.join(firsts, "same").select(F.col("file").alias(found["_mix_file"]), F.col("row").alias(found["_mix_row"]),
                                             (F.col("place") - F.col("first")).alias(name))
    here = (F.col(file) == F.col(found["_mix_file"])) & (F.col(row) == F.col(found["_mix_row"]))
    return rows.join(nth, here, "left").withColumn(name, F.coalesce(name, F.lit(0))).select(*map(quoted, docs.columns), name)


def mix_sql(flatten: float = 0.5, epochs: float = 1.0, seed: int = 17) -> str:
    """The same choice of copies over ``documents`` in SQL: doc_id, source, copy."""
    return f"""
WITH RECURSIVE units AS (
  SELECT source, sum(greatest(coalesce(length(text), 0), 1)) AS units FROM documents GROUP BY source),
shares AS (SELECT source, units, pow(units::double, {flatten}) AS share FROM units),
rates AS (
  SELECT source, round({epochs} * (SELECT sum(units) FROM shares)::double * share
    / (SELECT sum(share) FROM shares) / units, 9) AS rate FROM shares),
parts AS (
  SELECT doc_id, d.source, md5(coalesce(text, '')) AS h, rate, greatest(1, ceil(rate / {LARGEST_PART}))::int AS parts,
    row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) - 1 AS nth
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source WHERE rate > 0),
draws AS (
  SELECT doc_id, source, h, nth, part, rate / parts AS mean,
    (('0x' || substr(md5(concat_ws('|', '{seed}', coalesce(doc_id::varchar, ''), h, CASE WHEN nth > 0 THEN nth::varchar END,
      part::varchar)), 1, {HEX}))::bigint::double
      + 0.5) / {float(16 ** HEX)} AS u
  FROM (SELECT *, unnest(range(1, parts + 1)) AS part FROM parts)),
walk AS (
  SELECT doc_id, source, h, nth, part, mean, u, 0 AS k, exp(-mean) AS p, exp(-mean) AS c FROM draws
  UNION ALL
  SELECT doc_id, source, h, nth, part, mean, u, k + 1, p * mean / (k + 1), c + p * mean / (k + 1) FROM walk
  WHERE c <= u AND k < ceil(mean + 12 * sqrt(mean) + 40)),
counts AS (
  SELECT doc_id, source, h, nth, sum(k) AS n FROM (
    SELECT doc_id, source, h, nth, part, max(k) AS k FROM walk GROUP BY ALL) GROUP BY ALL)
SELECT doc_id, source, unnest(range(1, n::bigint + 1))::int AS copy FROM counts"""
