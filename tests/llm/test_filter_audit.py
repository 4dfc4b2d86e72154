"""The filter audit beside a plain version; its counting Bloom filter."""

from __future__ import annotations

import itertools
import re
from collections import Counter

import pyarrow as pa
import pytest

from gablework.llm import filter_audit


def plain_audit(rows, labels):
    """rows of (id, text, part); labels {id: (good, toxic)}."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    failing = []
    for i, text, part in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and i > least[text]}
        failing.append((part or "", {c for c in fails if fails[c]}, *labels.get(i, (0, 0))))
    result, shapley = {}, Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for step, c in enumerate(order, 1):
            for part in {f[0] for f in failing}:
                mine = [f for f in failing if f[0] == part]
                left = [f for f in mine if not f[1] & set(order[:step - 1])]
                removed = [f for f in left if c in f[1]]
                result[part, order, step] = [len(left) - len(removed), len(removed), sum(c in f[1] for f in mine) - len(removed),
                                             sum(f[1] == {c} for f in mine), sum(f[2] for f in removed), sum(f[3] for f in removed)]
                shapley[part, c] += len(removed)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in result.items()}


def ours(docs, labels):
    rows = filter_audit.audit(filter_audit.masks(docs, labels))
    names = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
    return {tuple(r) for r in rows.select(names).collect()}


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (1, 0, 1), (3, 1, 0), (6, 1, 1), (7, None, 1), (None, 1, 1), (99, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_plain_version(spark, odd_documents, labels):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in odd_documents.collect()]
    assert ours(odd_documents, labels) == plain_audit(rows, {1: (1, 1), 3: (1, 0), 6: (1, 1), 7: (0, 1), 99: (1, 1)})


def test_no_rows(no_documents, labels):
    assert ours(no_documents, labels) == set()


def test_repeats_of_one_text(spark, labels):
    rows = [(i % 500, "same Text #" if i % 3 == 0 else f"text {i}", None) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    assert ours(docs, labels) == plain_audit(rows, {1: (1, 1), 3: (1, 0), 6: (1, 1), 7: (0, 1), 99: (1, 1)})


def test_filter_clears_unique_texts_only(spark):
    n = 20_000
    rows = spark.range(n, numPartitions=6).selectExpr("id", "unhex(sha2(string(if(id % 10 = 0, id div 20, -id)), 256)) digest")
    segments = max(1, (1 << (16 * n - 1).bit_length()) >> filter_audit.SEGMENT_BITS)
    sent = filter_audit.sent_to_tasks(filter_audit.counting_bloom(rows, segments), segments)
    kept = {r["id"] for r in filter_audit.possible_repeats(rows, sent, segments).collect()}
    digests = Counter(bytes(r["digest"]) for r in rows.collect())
    repeated = {r["id"] for r in rows.collect() if digests[bytes(r["digest"])] > 1}
    assert repeated <= kept and len(kept - repeated) < 0.01 * n
    cleared = {r["id"] for r in filter_audit.possible_repeats(rows, sent, segments, again=False).collect()}
    assert cleared == set(range(n)) - kept


def test_cells_of_no_digests():
    assert filter_audit.cells(pa.array([], pa.binary()), 4).shape == (0, filter_audit.REACHED)
