"""Exact search beside a plain version."""

from __future__ import annotations

import math
import random

import pytest

from gablework.llm import exact_search


def plain(vectors, queries, k=10):
    def whole(v):
        return None if v is None or any(x is None or not math.isfinite(x) for x in v) else [math.floor(1024 * x) for x in v]

    rows = [(i, w) for i, v in vectors if (w := whole(v)) is not None]
    result = []
    for q, v in queries:
        if q is None or (v := whole(v)) is None:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), i is not None, i, i) for i, w in rows if i != q and len(w) == len(v)]
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        result += [(q, rank, s[3], -s[0]) for rank, s in enumerate(scored[:k], 1)]
    return sorted(result, key=repr)


def ours(vectors, queries, **options):
    rows = exact_search.search(vectors, queries, **options).select("query_id", "rank", "id", "score").collect()
    return sorted(map(tuple, rows), key=repr)


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(parts)


@pytest.mark.parametrize("bins, few", [(exact_search.BINS, exact_search.FEW), (3, 0)])
def test_plain_version(spark, monkeypatch, bins, few):
    """Ties, repeats, other lengths, nulls; with few bins every score is located by many rounds."""
    monkeypatch.setattr(exact_search, "BINS", bins), monkeypatch.setattr(exact_search, "FEW", few)
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) for _ in range(4)]) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(90)] + [rows[5], rows[5], (None, rows[8][1]), (400, None), (401, [0.1, None, 1.0, 2.0]),
             (402, [math.nan] * 4), (403, [math.inf] * 4), (404, []), (405, []), (500, [1.0, 2.0]), (501, [-1.0, 0.5])]
    queries = [rows[5], rows[5], rows[7], rows[20], (404, []), (500, [1.0, 2.0]), (None, rows[8][1]), (9, None), (7000, [1.0] * 9)]
    assert ours(frame(spark, rows), frame(spark, queries, 2)) == plain(rows, queries)


def test_more_queries_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(exact_search, "BLOCK_QUERIES", 3), monkeypatch.setattr(exact_search, "AT_ONCE", 2)
    monkeypatch.setattr(exact_search, "HELD", 10), monkeypatch.setattr(exact_search, "SCORES", 40)
    r = random.Random(2)
    rows = [(i, [r.randint(-2, 2) / 2 for _ in range(3)]) for i in range(200)]
    queries = rows[::14]
    assert ours(frame(spark, rows, 3), frame(spark, queries, 2), k=4) == plain(rows, queries, 4)


def test_fewer_rows_than_wanted(spark):
    rows = [(1, [0.5, 1.0]), (2, [0.25, 1.0]), (3, [3.0, 1.0])]
    assert ours(frame(spark, rows), frame(spark, rows)) == plain(rows, rows)
    assert ours(frame(spark, rows).filter("false"), frame(spark, rows)) == []
    assert ours(frame(spark, rows), frame(spark, rows).filter("false")) == []


def test_large_components(spark):
    """Products beyond the exact range of doubles are whole numbers of Python; beyond 64 bits they are an error."""
    rows = [(i, [1e5 + i / 1024, 3e5 - i * i / 1024, 7.0]) for i in range(40)]
    assert ours(frame(spark, rows), frame(spark, rows[:3])) == plain(rows, rows[:3])
    with pytest.raises(ValueError, match="64 bits"):
        ours(frame(spark, [(1, [1e12]), (2, [1e12])]), frame(spark, [(1, [1e12])]))


def test_clashing_names(spark):
    rows = [(i, [i / 7, 1.0]) for i in range(30)]
    named = frame(spark, rows).selectExpr("*", "1 AS id", "2 AS vector", "3 AS query", "4 AS bin", "5 AS n", "6 AS score")
    assert ours(named, named.limit(4)) == ours(frame(spark, rows), named.limit(4))
