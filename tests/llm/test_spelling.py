"""Spelling variants beside plain versions."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gablework.llm import spelling
from gablework.llm.common import Scratch
from gablework.llm.queries import table


def plain_words(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_near(words):
    """Words that share a word with one letter left out at one place, or are such a word of each other."""
    places, near = defaultdict(set), {w: set() for w in words}
    for w in words:
        for i in range(len(w)):
            places[w[:i], w[i + 1:]].add(w)
            if (short := w[:i] + w[i + 1:]) in near:
                near[short].add(w), near[w].add(short)
    for same in places.values():
        for w in same:
            near[w] |= same - {w}
    return near


def plain_variants(words):
    near = plain_near(words)
    form = {}
    for w in words:
        top = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = top if top is not None and words[top] >= 2 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return rows


def ours(docs):
    rows = spelling.variants(docs).collect()
    assert len(rows) == len({r["word"] for r in rows})
    return {(r["word"], r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


def test_plain_version_over_documents(spark, small):
    docs = table(spark, small, "documents")
    words = plain_words([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert ours(docs) == plain_variants(words) and len(words) > 1000


def test_odd_documents(spark, odd_documents):
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    more = [(10, "Größe gröÞe größe GRÖSSE ÀÉÎÕÜ ÀÉÎÕÜ ÀÉÎÕÜ ÀÉÎÕÜx × ÷÷÷÷÷÷ abcde€fghij " * 9), (None, "Straße Strasse straßen " * 5)]
    docs = odd_documents.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    assert ours(docs) == plain_variants(plain_words(rows + more))


def test_no_documents(no_documents):
    assert ours(no_documents) == set()


@pytest.mark.parametrize("chunk, leaf, queries", [(spelling.CHUNK, spelling.LEAF, spelling.QUERIES), (7, 1, 5)])
def test_near_words_of_few_letters(spark, monkeypatch, chunk, leaf, queries):
    """Many words on few letters, very long ones among them, with cells in one piece or in small chunks."""
    monkeypatch.setattr(spelling, "CHUNK", chunk), monkeypatch.setattr(spelling, "LEAF", leaf)
    monkeypatch.setattr(spelling, "QUERIES", queries)
    r = random.Random(3)
    words = {"".join(r.choices("abcdeé", k=r.randint(5, 7))): r.randint(3, 9) for _ in range(900)}
    long = "".join(r.choices("abcdefgh", k=700))
    words |= {long: 9, long[:300] + long[301:]: 3, long[:600] + "z" + long[601:]: 4, "a" * 300: 3, "a" * 301: 3}
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    scratch = Scratch(spark)
    found = {r["word"]: (r["n_near"], r["best"], r["best_n"]) for r in spelling.near_words(frame, scratch).collect()}
    near = plain_near(words)
    tops = {w: min(near[w], key=lambda o: (-words[o], o)) for w in words if near[w]}
    assert found == {w: (len(near[w]), top, words[top]) for w, top in tops.items()} and len(tops) > 300
    scratch.delete()


def test_roots_of_long_chains(spark):
    scratch = Scratch(spark)
    chain = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w5")], "word string, form string")
    assert {r["root"] for r in spelling.roots(chain, scratch).collect()} == {"w37"}
    scratch.delete()


def test_groups_cover_all_letters(spark):
    words = spark.createDataFrame([("eeeeeenn", 3), ("ttnée", 3)], "word string, n long")
    groups = spelling.letter_groups(words)
    assert groups[ord("e")] == 0 and set(groups[spelling.LETTERS]) == set(range(spelling.GROUPS))
    counts = spelling.vectors(np.frombuffer(b"eenz", np.uint8), np.array([0, 2, 4]), groups)
    assert counts.sum(axis=1).tolist() == [2, 2] and counts[0, 0] == 2
