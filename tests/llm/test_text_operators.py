"""Operators that SQL cannot express, against plain versions, a library, or held-out rows."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gablework.llm import (byte_hashes, exact_dedup, fingerprints, language, licenses, mixing, near_dedup,
                           sentencepiece_codec, suffix_dedup, token_counts, warc_audit)
from gablework.llm.common import stored
from gablework.llm.queries import QUERIES, table, tokenizer_file


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


# 1 -- repeated windows

def plain_removal(rows, window):
    seen = collections.Counter(b[i:i + window] for _, b in rows for i in range(len(b) - window + 1))
    out = []
    for key, b in rows:
        gone = bytearray(len(b))
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = b"\1" * window
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((key, len(b), len(b) - len(kept), runs, kept))
    return collections.Counter(out)


def removal(df, window):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
                               for r in suffix_dedup.remove_repeats(df, window).collect())


def test_suffix_dedup_like_plain(spark, small):
    docs = table(spark, small, "documents")
    assert removal(docs, 200) == plain_removal([(k, t.encode()) for k, t in texts_of(docs)], 200)


def test_suffix_dedup_edges(spark, monkeypatch):
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdé ") for _ in range(3000))
    rows = [(1, base[:900]), (2, base[100:400]), (3, base[800:] + base[:120]), (4, "a" * 700), (5, "ab" * 300), (6, None), (7, ""),
            (8, base[399:598]), (9, base[:900]), (9, base[:900]), (10, base[300:420] + "Q" + base[421:600]), (None, base[50:300])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_id", F.lit("x"))
    for window in (64, 100, 200):
        want = plain_removal([(k, (t or "").encode()) for k, t in rows], window)
        assert removal(df, window) == want
    assert suffix_dedup.remove_repeats(df.filter("false")).count() == 0


def test_suffix_dedup_of_repeated_rows(spark):
    """Rows repeated under one id bring their spans once, however often they come."""
    text = " ".join(f"word{i * i}" for i in range(300))
    df = spark.createDataFrame([(None, text)] * 400 + [(1, "x" + text[:500]), (2, "short")], "doc_id long, text string")
    keyed = df.selectExpr("coalesce(doc_id, -9) AS _id", "xxhash64(text) AS _h", "text AS _text")
    assert max(len(r.spans) for r in suffix_dedup.repeated_spans(keyed).collect()) < 2 * len(text) / 64
    got = removal(df, 200)
    assert got[(None, len(text), len(text), 1, b"")] == 400 and got[(1, 501, 500, 1, b"x")] == 1


def test_suffix_dedup_long_text_in_pieces():
    rnd = np.random.default_rng(1)
    block = rnd.integers(97, 123, 5000).astype(np.uint8)
    data = np.concatenate([rnd.integers(97, 123, 3000).astype(np.uint8), block, block])
    whole = suffix_dedup._runs(data, np.array([0, len(data)]), 200)
    assert (np.diff(whole[0]) > 0).all() and whole[0][0] == 0 and whole[1][-1] == len(data) - 200
    assert (whole[0][1:] == whole[1][:-1] + 1).all()
    old, suffix_dedup.PIECE = suffix_dedup.PIECE, 4096
    try:
        parts = list(suffix_dedup._pieces(data, np.array([0, len(data)]), 200))
    finally:
        suffix_dedup.PIECE = old
    starts = [(int(b[0]), len(p) - 199) for p, _, _, b in parts]
    assert [s for s, _ in starts] == list(range(0, len(data) - 199, 4096)) and sum(n for _, n in starts) == len(data) - 199


def test_odd_documents_suffix(odd_documents):
    rows = [(k, t.encode()) for k, t in texts_of(odd_documents)]
    assert removal(odd_documents, 200) == plain_removal(rows, 200)


# 2 -- mixing

def test_poisson_inverse(spark):
    from math import exp

    rows = [(u / 97 + 0.001, m) for u in range(97) for m in (0.01, 0.7, 3.0, 40.0, 256.0)]
    df = spark.createDataFrame(rows, "u double, mean double")
    for r in df.withColumn("k", mixing.poisson_inverse(F.col("u"), F.col("mean"))).collect():
        k, p = 0, exp(-r.mean)
        c = p
        while c <= r.u:
            k += 1
            p *= r.mean / k
            c += p
        assert r.k == k


def test_mixing_meets_weights(spark):
    rows = [(i, f"text {i} " + "x" * (i % 50), "big" if i % 10 else "small") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(docs, {"big": 1.0, "small": 1.0}, epochs=2.0)
    units = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    total = docs.agg(F.sum(F.length("text"))).first()[0]
    assert abs(units["big"] / total - 1) < 0.08 and abs(units["small"] / total - 1) < 0.08
    again = mixing.mix(docs.repartition(7), {"big": 1.0, "small": 1.0}, epochs=2.0)
    assert sorted(again.collect()) == sorted(mixed.collect())
    assert mixed.filter("_copy > 1").count() > 0


def test_mixing_edges(odd_documents, no_documents):
    mixed = mixing.mix(odd_documents, epochs=30.0)
    assert mixed.columns == [*odd_documents.columns, "_copy_"] and mixed.count() > 0
    assert {r._copy for r in mixed.collect()} == {"clash"}
    assert mixing.mix(no_documents).count() == 0
    assert {r.source for r in mixing.mix(odd_documents, {None: 1.0}, epochs=5.0).collect()} == {None}


def test_mixing_of_equal_rows(spark):
    """Equal rows draw for themselves, so their source meets its weight, and their copies are spread."""
    docs = spark.createDataFrame([(1, "the same text", "a")] * 4000 + [(i, f"text {i}", "b") for i in range(2, 2000)],
                                 "doc_id long, text string, source string")
    mixed = mixing.mix(docs, {"a": 1.0, "b": 1.0}, epochs=2.0, partitions=8)
    units = {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    total = docs.agg(F.sum(F.length("text"))).first()[0]
    assert abs(units["a"] / total - 1) < 0.08 and abs(units["b"] / total - 1) < 0.08
    parts = [r.n for r in mixed.filter("source = 'a'").groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(parts) == 8 and max(parts) < 2 * min(parts)
    again = mixing.mix(docs.repartition(7), {"a": 1.0, "b": 1.0}, epochs=2.0)
    assert sorted(again.collect()) == sorted(mixed.collect())


# 3 -- licenses

@pytest.fixture(scope="module")
def license_model(spark, small):
    return licenses.fit(table(spark, small, "documents"))


def test_licenses_of_documents(spark, small, license_model):
    wanted = {"apache": "licensed under the apache license", "gpl": "gnu general public license",
              "mit": "released under the mit license", "cc": "licensed under cc by"}
    docs = table(spark, small, "documents")
    for r in licenses.scan(docs, license_model).collect():
        assert sorted({m.family for m in r.matches}) == sorted(f for f, p in wanted.items() if p in r.text.lower())


def test_license_edges(spark, license_model, odd_documents, no_documents):
    notice = "Released under the MIT License."
    text = "first line\n\nsome more words here\n" + notice + "\nlast"
    docs = spark.createDataFrame([(1, text), (2, text), (2, text), (3, "x" * 100_000 + "\n" + notice), (4, "the license of the version")],
                                 "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(docs, license_model).collect()}
    assert [(m.paragraph, m.family) for m in got[1].matches] == [(3, "mit")]
    assert [(m.paragraph, m.family) for m in got[3].matches] == [(1, "mit")]
    assert got[4].matches == [] and got[1].n_paragraphs == 5
    scanned = licenses.scan(odd_documents, license_model)
    assert scanned.count() == odd_documents.count() and scanned.filter("size(matches) > 0").count() == 0
    assert licenses.scan(no_documents, licenses.fit(no_documents)).count() == 0


# 4 -- languages

def test_language_of_held_out(spark):
    folder = "/root/testdata/sf0.01"
    rows = QUERIES["op4_language"](spark, folder).join(table(spark, folder, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 2


def test_gram_counts_like_plain(monkeypatch):
    texts = ["the cat", "", "a", "été là", "b c  d"]
    big = language.counts_of(texts)
    monkeypatch.setattr(language, "PIECE", 5)
    assert (language.counts_of(texts) == big).all()
    for t, row in zip(texts, big):
        b = bytes(x if 97 <= x < 123 or x > 127 else 32 for x in t.encode())
        grams = [b[i:i + n] for n in (2, 3) for i in range(len(b) - n + 1) if b[i:i + n].strip(b" ")]
        assert row.sum() == len(grams)


def test_language_edges(odd_documents, no_documents):
    model = language.fit(odd_documents)
    got = language.identify(odd_documents, model).collect()
    assert len(got) == odd_documents.count()
    for r in got:
        if not r.text or not re.search(r"[^\W\d_]", r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in {"en", "fr", "xx"}
    assert language.identify(no_documents, language.fit(no_documents)).count() == 0
    unlearned = language.identify(odd_documents, language.fit(no_documents))
    assert {r.lang_pred for r in unlearned.collect()} == {"und"}
    kept = language.keep_identified(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() < odd_documents.count()


def test_language_rejects_noise_of_all_lengths(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    known = [(r.lang, r.text) for r in docs.filter("text is not null and length(text) > 200").orderBy("doc_id").limit(200).collect()]
    rnd = random.Random(4)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    noise = ["".join(rnd.choice(letters) for _ in range(n)) for n in (1000, 3000, 10_000, 50_000)]
    noise += [" ".join("".join(rnd.choice(letters[26:52]) for _ in range(rnd.randint(3, 9))) for _ in range(n // 7))
              for n in (3000, 10_000, 50_000)]
    clean = [" ".join([t for lang, t in known if lang == "en"] * 3)[:n] for n in (300, 1000, 3000, 10_000, 50_000)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(noise + clean)], "doc_id long, text string")
    got = {r.doc_id: r.rejected for r in language.identify(rows, language.fit(docs)).collect()}
    assert [got[i] for i in range(len(got))] == [True] * len(noise) + [False] * len(clean)


def test_floors_of_sparse_sizes():
    nan = float("nan")
    got = language.carried(np.array([[nan, .2, nan, nan, .3, nan], [nan] * 6, [.1, nan, nan, nan, nan, .4]]), np.full(3, .05))
    assert got.tolist() == [[.2, .2, .2, .3, .3, .3], [.1, .1, .1, .3, .3, .3], [.1, .1, .1, .4, .4, .4]]
    assert language.carried(np.full((2, 3), nan), np.array([.05, .06])).tolist() == [[.05] * 3, [.06] * 3]
    assert language.carried(np.zeros((0, 3)), np.zeros(0)).shape == (0, 3)


# 5 -- near duplicates

def bags_of(rows):
    out = {}
    for key, text in rows:
        w = re.findall(r"[^\W_]+", text.lower())
        out[key] = collections.Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else None
    return out


def plain_classes(rows, least=0.8):
    bags = bags_of(rows)
    where = collections.defaultdict(list)
    for k, bag in bags.items():
        for s in bag or ():
            where[s].append(k)
    top = {k: k for k in bags}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in {(min(x, y), max(x, y)) for ks in where.values() for x in ks for y in ks if x != y}:
        same = sum((bags[a] & bags[b]).values())
        if same / (sum(bags[a].values()) + sum(bags[b].values()) - same) >= least:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    return {k: find(k) for k in bags}


def test_near_classes_like_plain(spark, small):
    docs = table(spark, small, "documents")
    got = near_dedup.near_classes(docs).collect()
    assert {r.id: r.class_id for r in got} == plain_classes(texts_of(docs))
    assert all(r.kept == (r.id == r.class_id) for r in got)


def test_near_classes_of_edited_texts(spark):
    rnd = random.Random(5)
    vocabulary = ["".join(rnd.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    rows, n = [], 0
    for family in range(25):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice((30, 200, 1500)))]
        for edits in (0.0, 0.004, 0.01, 0.02, 0.05):
            rows.append((n, " ".join(rnd.choice(vocabulary) if rnd.random() < edits else w for w in words)))
            n += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.class_id for r in near_dedup.near_classes(docs).collect()}
    want = plain_classes(rows)
    assert sum(got[k] != want[k] for k in want) <= 1


def test_near_pairs_inside_a_template_family(spark):
    """Texts on one template (0.786) hold pairs of 0.807, which must be found in buckets whose ends are unlike both."""
    template = " ".join(f"t{i}" for i in range(532))
    rows = [(2 * pair + one, " ".join([template, *(f"p{pair}x{i}" for i in range(8)), *(f"o{pair}x{one}x{i}" for i in range(64))]))
            for pair in range(80) for one in (0, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: (r.class_id, r.class_size) for r in near_dedup.near_classes(df).collect()}
    assert got == {i: (i - i % 2, 2) for i, _ in rows}


def test_sharing_finds_all_near_pairs(spark):
    """Families of edited texts with repeated words: the join gives every near pair of two labels, and few others."""
    from gablework.llm.common import Scratch

    rnd = random.Random(9)
    rows = []
    for family in range(6):
        words = [f"f{family}w{rnd.randrange(40)}" for _ in range((60, 61, 90, 200, 7, 400)[family])]
        for _ in range(60):
            share = rnd.choice((0.0, 0.01, 0.02, 0.05))
            edited = [f"e{rnd.randrange(30)}" if rnd.random() < share else w for w in words]
            cut = rnd.randrange(len(words) // 8 + 1) if rnd.random() < 0.3 else 0
            rows.append((len(rows), " ".join(edited[cut:])))
    texts = spark.createDataFrame([(i, i % 7, t) for i, t in rows], "node long, label long, _words string").repartition(3)
    scratch = Scratch(spark)
    found = {(r.a, r.b) for r in near_dedup.sharing(texts, 0.8, scratch).collect()}
    scratch.delete()
    bags = bags_of(rows)

    def likeness(a, b):
        same = sum((bags[a] & bags[b]).values())
        return same / (sum(bags[a].values()) + sum(bags[b].values()) - same)

    pairs = [(a, b) for a in bags for b in bags if a < b and a % 7 != b % 7]
    near = {p for p in pairs if likeness(*p) >= 0.8}
    assert near <= found and all(a % 7 != b % 7 for a, b in found) and len(near) > 500
    assert len(found) < 0.5 * sum(a // 60 == b // 60 for a, b in pairs)


def test_families_of_own_edits_do_not_meet(spark):
    """Texts that differ from one template by edits of their own: the join compares next to none of their pairs."""
    from gablework.llm.common import Scratch

    rnd = random.Random(4)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, i, " ".join(f"e{i}x{j}" if rnd.random() < 0.05 else w for j, w in enumerate(words))) for i in range(300)]
    scratch = Scratch(spark)
    found = near_dedup.sharing(spark.createDataFrame(rows, "node long, label long, _words string"), 0.8, scratch).collect()
    scratch.delete()
    bags = bags_of([(i, t) for i, _, t in rows])
    near = [(a, b) for a in bags for b in bags if a < b and sum((bags[a] & bags[b]).values()) / sum((bags[a] | bags[b]).values()) >= 0.8]
    assert set(near) <= {(r.a, r.b) for r in found} and len(found) < 0.1 * 300 * 299 / 2


def test_crowds_of_near_copies_meet_few_of_each_other(spark, monkeypatch):
    """Texts with some of few edits to one template share rare shingles with many: each is compared with few, and classes are whole.
    Star links are left out, so that the join over shingles has all of them to find."""
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(170)]
    rows = []
    for i in range(300):
        gone = set(rnd.sample(range(5, 170, 14), rnd.choice((1, 2, 3, 4))))
        rows.append((i, " ".join(w for k, w in enumerate(words) if k not in gone)))
    pairs = []
    judged = near_dedup.judged

    def counted(found, nodes):
        pairs.append(found.count())
        return judged(found, nodes)

    monkeypatch.setattr(near_dedup, "judged", counted)
    monkeypatch.setattr(near_dedup, "candidates", lambda met: met.select(met.node.alias("a"), met.low.alias("b")).limit(0))
    classes = {r.id: r.class_id for r in near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bags = bags_of(rows)
    head = list(range(300))
    for a in range(300):
        for b in range(a):
            same = sum((bags[a] & bags[b]).values())
            if same >= 0.8 * (sum(bags[a].values()) + sum(bags[b].values()) - same) and head[a] != head[b]:
                low, high = sorted((head[a], head[b]))
                head = [low if h == high else h for h in head]
    assert classes == dict(enumerate(head))
    assert sum(pairs) < 35 * 300, pairs


def test_turns_go_through_fewer_rows_each(spark, monkeypatch):
    """Every turn used to join all beginnings anew; now only texts that still meet one of another class stay in play."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(170)]
    rows = [(i, " ".join(w for k, w in enumerate(words) if k not in gone)) for i in range(200)
            for gone in [set(rnd.sample(range(5, 170, 14), rnd.choice((1, 2, 3, 4))))]]
    rows += [(200 + i, " ".join(f"v{i}_{k // 2}" for k in range(60))) for i in range(20)]
    turns = []
    meetings = near_dedup.meetings

    def counted(found):
        turns.append(found.count())
        return meetings(found)

    monkeypatch.setattr(near_dedup, "meetings", counted)
    monkeypatch.setattr(near_dedup, "candidates", lambda met: met.select(met.node.alias("a"), met.low.alias("b")).limit(0))
    near_dedup.near_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(turns) > 1 and all(b < a for a, b in zip(turns, turns[1:])), turns


def test_rows_in_play_meet_another_label_by_a_smaller_partner(spark):
    given = [(1, 1, "one label", True), (2, 1, "one label", False),
             (3, 3, "no smaller partner", False), (4, 4, "no smaller partner", False),
             (5, 5, "met", True), (6, 6, "met", False), (7, 5, "met", False),
             (8, 8, "two small", True), (9, 9, "two small", True), (10, 8, "two small", False)]
    rows = spark.createDataFrame([(n, label, key, 0, small) for n, label, key, small in given],
                                 "node long, label long, shingle string, bin int, small boolean")
    scratch = near_dedup.Scratch(spark)
    assert sorted(r.node for r in near_dedup.in_play(rows, scratch).collect()) == [5, 6, 8, 9, 10]
    scratch.delete()


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(2)
    element = rng.integers(1, 2 ** 62, 400).astype(np.uint64)
    one, two = rng.integers(0, 6, 400).astype(float), rng.integers(0, 6, 400).astype(float)
    real = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    doc = np.repeat([0, 1], 400)
    both, weight = np.tile(element, 2), np.concatenate([one, two])
    use = weight > 0
    found = []
    for salt in range(12):
        sig = near_dedup.signatures(byte_hashes.mixed(both + np.uint64(salt))[use], weight[use], doc[use], 2)
        found.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(found) - real) < 0.03


def test_near_edges(odd_documents, no_documents):
    got = near_dedup.near_classes(odd_documents).collect()
    assert len(got) == odd_documents.count()
    assert len({r.class_id for r in got if r.id in (3, 4)}) == 1
    assert sorted(r.kept for r in got if r.id in (5, 6)) == [False, False, True]
    named = odd_documents.withColumn("_metadata", F.lit("mine")).withColumn("a`b.c", F.lit(1))
    assert near_dedup.drop_near_copies(named).columns == named.columns
    assert near_dedup.drop_near_copies(named).filter("_metadata <> 'mine' or _file <> 'clash'").count() == 0
    kept = near_dedup.drop_near_copies(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == sum(r.kept for r in got)
    assert near_dedup.near_classes(no_documents).count() == 0


# 6 -- SentencePiece

@pytest.fixture(scope="module")
def model_file():
    return tokenizer_file("piece_bpe_32k.model")


def test_codec_like_library(model_file):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
    codec = sentencepiece_codec.Codec(sentencepiece_codec.read_model(model_file))
    rnd = random.Random(1)
    signs = [" " * k for k in (1, 2, 3, 4, 5, 7, 9, 15, 16, 17, 33)] + list("aethinorsd\n\t\r.,é日本한x0▁﻿\x00") + ["the", "ing", "tion"]
    cases = ["", " ", "▁", "a▁b", "\x00", "".join(rnd.choice("aethinorsd") for _ in range(20_000))]
    cases += ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25))) for _ in range(4000)]
    for text in cases:
        ids = lib.encode(text, add_eos=True)
        assert codec.encode(text) == ids and codec.decode(ids) == lib.decode(ids)
        assert codec.digests(text) == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)))
    for _ in range(500):
        ids = [rnd.randrange(codec.end + 1, 1200) for _ in range(8)]
        assert codec.decode(ids) == lib.decode(ids)


def test_codec_over_tables(spark, small, model_file, odd_documents, no_documents):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=model_file)
    for docs in (table(spark, small, "documents"), odd_documents):
        coded = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, model_file), model_file)
        digests = sentencepiece_codec.encoded_digests(docs, model_file, keep=["doc_id", "text"])
        rows = coded.collect()
        assert len(rows) == docs.count()
        for r in rows:
            ids = lib.encode(r.text or "", add_eos=True)
            assert r.ids == ids and r.decoded == lib.decode(ids)
        for r in digests.collect():
            ids = lib.encode(r.text or "", add_eos=True)
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)))
    assert sentencepiece_codec.encode(no_documents, model_file).count() == 0


# 7 -- exact copies

def test_exact_groups_edges(odd_documents, no_documents):
    got = exact_dedup.exact_groups(odd_documents).collect()
    assert len(got) == odd_documents.count()
    by_keep = collections.defaultdict(list)
    for r in got:
        by_keep[bytes(r.digest)].append(r)
    for rows in by_keep.values():
        assert sum(r.kept for r in rows) == 1 and {r.group_size for r in rows} == {len(rows)}
        ids = [r.id for r in rows if r.id is not None]
        assert {r.keep_id for r in rows} == {max(ids) if ids else None}
    kept = exact_dedup.drop_copies(odd_documents)
    assert kept.columns == odd_documents.columns and kept.count() == len(by_keep)
    assert exact_dedup.exact_groups(no_documents).count() == 0


def test_exact_groups_with_a_clashing_digest(spark):
    rows = [(i, f"text {i % 40}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = exact_dedup.exact_groups(docs, digest=lambda t: F.substring(F.sha2(t, 256), 1, 1).cast("binary")).collect()
    assert {(r.id, r.keep_id, r.group_size, r.kept) for r in got} == {(i, 160 + i % 40, 5, i >= 160) for i in range(200)}


def test_state_takes_further_files(spark, tmp_path):
    folder, state = str(tmp_path / "digests"), str(tmp_path / "state")
    part = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "id long, text string").select(
        exact_dedup.sha256_digest(F.col("text")).alias("digest"), "id", F.lit("f").alias("_file"), F.col("id").alias("_row"))
    for shift in (0, 10):
        part.withColumn("id", F.col("id") + shift).write.mode("append").parquet(folder)
        exact_dedup.feed(folder, part.schema, state, spark)
    held = exact_dedup.kept_by_digest(state, spark).collect()
    assert sorted((r.n, r.keep.id) for r in held) == [(2, 12), (4, 13)]


# 8 -- archives

def plain_root(rows):
    """The root over (file, offset, n_bytes, digest) by plain Python; the groups of files are given by their numbers."""
    nodes = {(str(f), o, f"{n}:{d}") for f, o, n, d, _ in rows}
    group = {str(f): g for f, _, _, _, g in rows}
    for up in (lambda f, p: (f, p >> 16), lambda f, p: (f, p >> 8), lambda f, p: (f, 0), lambda f, p: ("", group[f]), lambda f, p: ("", 0)):
        above = collections.defaultdict(set)
        for f, p, h in nodes:
            above[up(f, p)].add((f, p, h))
        nodes = {(*k, sha(",".join(f"{f}:{p}:{h}" for f, p, h in sorted(v)))) for k, v in above.items()}
    return nodes


ARCHIVE = "file string, offset long, n_bytes long, digest string, id long"


def test_audit_locates_damage(spark):
    rows = [(f"f{i % 3}.warc", i * 5000, 4000 + i % 7, f"{i % 4000:064x}", i) for i in range(9000)]
    whole = spark.createDataFrame(rows, ARCHIVE)
    changed, lost, moved = {17, 4096, 8999}, {0, 5001}, {33, 8034}
    damaged = [(f, o, n, "x" if i in changed else d, i) for f, o, n, d, i in rows if i not in lost | moved]
    damaged += [("patch.warc", 10 * i, rows[i][2], rows[i][3], i) for i in sorted(moved)] + [("f1.warc", 3, 9, "new", -1)]
    got = warc_audit.audit(whole, spark.createDataFrame(damaged, ARCHIVE)).collect()
    assert len(got) == len(rows) + 1
    assert {r.id: r.status for r in got if r.status not in ("ok", "added")} == {
        **dict.fromkeys(changed, "changed"), **dict.fromkeys(lost, "missing"), **dict.fromkeys(moved, "moved")}
    assert {(r.id, r.moved_file, r.moved_offset) for r in got if r.status == "moved"} == {(i, "patch.warc", 10 * i) for i in moved}
    assert [(r.file, r.offset, r.n_bytes, r.digest, r.id) for r in got if r.status == "added"] == [("f1.warc", 3, 9, "new", None)]


def test_audit_trees_do_not_depend_on_the_session(spark, small):
    pages = table(spark, small, "pages")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    one = warc_audit.archive(pages).collect()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", 7)
        other = warc_audit.archive(pages.repartition(5))
        assert sorted(other.collect()) == sorted(one)
        whole = spark.createDataFrame(one, other.schema)
        roots = [warc_audit.tree(x)[-1].collect() for x in (other, whole)]
        assert roots[0] == roots[1] and len(roots[0]) == 1
        grouped = whole.withColumn("g", F.pmod(F.xxhash64(F.col("file").cast("string")), F.lit(warc_audit.FILE_GROUPS)))
        assert {tuple(r) for r in roots[0]} == plain_root(grouped.select("file", "offset", "n_bytes", "digest", "g").collect())
        assert warc_audit.audit(whole, other).filter("status <> 'ok'").isEmpty()
        shifted = warc_audit.audit(whole, other.withColumn("offset", F.col("offset") + 1))
        assert {r.status for r in shifted.collect()} == {"moved"}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_audit_edges(spark):
    rows = [("a", 0, 5, "d", 1), ("a", 0, 5, "d", 2), ("a", 5, None, None, 3), (None, 9, 5, "e", 4), ("b", None, 5, "f", 5), ("a", 9, 1, "g", 6)]
    df = spark.createDataFrame(rows, ARCHIVE).withColumns({n: F.lit("clash") for n in ("status", "_leaf_file", "part", "hash", "up")})
    got = warc_audit.audit(df, df).collect()
    assert {r.id: r.status for r in got} == {1: "ok", 2: "ok", 3: "ok", 4: "unplaced", 5: "unplaced", 6: "ok"}
    assert {r.hash for r in got} == {"clash"}
    none = warc_audit.audit(df, df.filter("id = 1 or id = 2")).collect()
    assert {r.id: r.status for r in none} == {1: "ok", 2: "ok", 3: "missing", 4: "unplaced", 5: "unplaced", 6: "missing"}
    empty = df.filter("false")
    assert {r.status for r in warc_audit.audit(empty, df).collect()} == {"added"} and warc_audit.audit(empty, empty).count() == 0


def test_archive_edges(spark, small):
    pages = spark.createDataFrame([(1, None, None), (1, None, None), (None, "u", "é" * 1000), (2, "u", "")], "page_id long, url string, html string")
    rows = warc_audit.archive(pages.withColumn("leaf", F.lit(1))).collect()
    assert len(rows) == 4 and len({r.leaf for r in rows}) == 4 and len({r.digest for r in rows}) == 3
    assert warc_audit.archive(pages.filter("false")).count() == 0
    empty = warc_audit.archive(pages.filter("false"))
    assert warc_audit.audit(empty, empty).count() == 0
    laid = warc_audit.archive(table(spark, small, "pages")).orderBy("leaf").collect()
    reach = {}
    for r in laid:
        assert r.offset == reach.get(r.file, 0)
        reach[r.file] = r.offset + r.n_bytes


# 9 -- token counts

def plain_count(pieces, word, longest):
    n, i = 0, 0
    while i < len(word):
        size = next((k for k in range(min(longest, len(word) - i), 0, -1) if word[i:i + k] in pieces), 0)
        if not size:
            return 1
        i += size
        n += 1
    return n


def test_longest_match_like_plain():
    rnd = random.Random(4)
    for letters in ("ab", "abc", "abcd"):
        for _ in range(40):
            pieces = {bytes(rnd.choice(letters.encode()) for _ in range(rnd.randint(1, 6))) for _ in range(rnd.randint(1, 14))}
            match = token_counts.LongestMatch(pieces)
            for _ in range(60):
                word = bytes(rnd.choice(letters.encode()) for _ in range(rnd.randint(1, 20)))
                assert match.count(word) == plain_count(pieces, word, 6)


def test_token_counts_over_tables(spark, small, odd_documents, no_documents):
    import regex

    pieces = token_counts.read_ranks(tokenizer_file("byte_bpe_50k.tiktoken"))
    known, longest = set(pieces), max(map(len, pieces))
    for docs in (table(spark, small, "documents"), odd_documents):
        rows = token_counts.count_tokens(docs, pieces).collect()
        assert len(rows) == docs.count()
        for r in rows:
            words = regex.findall(token_counts.PATTERN, (r.text or "")[:20_000])
            if len(r.text or "") <= 20_000:
                assert (r.n_words, r.n_tokens) == (len(words), sum(plain_count(known, w.encode(), longest) for w in words))
    assert token_counts.count_tokens(no_documents, pieces).count() == 0


# 10 -- fingerprints

def test_fingerprints_are_homomorphic(spark):
    rows = [(1, "one\ntwo\nthree"), (2, "three\none\ntwo"), (3, "one\ntwo"), (4, "three"), (5, ""), (6, None)]
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert prints[1] == prints[2] != prints[3] and set(prints[5]) == {"0"} and prints[5] == prints[6]
    df = spark.createDataFrame([(prints[3], prints[4], prints[1])], "a string, b string, c string")
    r = df.select(fingerprints.combine(F.col("a"), F.col("b")).alias("in_"), fingerprints.combine(F.col("c"), F.col("b"), -1).alias("out")).first()
    assert r.in_ == prints[1] and r.out == prints[3]


def test_fingerprint_edges(odd_documents, no_documents):
    got = fingerprints.edited_fingerprints(odd_documents).collect()
    assert len(got) == odd_documents.count()
    rows = sorted({(-2 ** 63 if k is None else k, t) for k, t in texts_of(odd_documents)})
    assert collections.Counter(r.n_chars for r in got) == collections.Counter(len(t) for _, t in texts_of(odd_documents))
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    five, six = (next(r for r in got if r.doc_id == k) for k in (5, 6))
    assert five.fingerprint == six.fingerprint and five.near_next == 1.0
    text = dict(rows)[5]
    assert five.edited_sha256 == sha(text[:len(text) - len(text) // 4] + text[:len(text) // 4])
    assert fingerprints.edited_fingerprints(no_documents).count() == 0
    only = odd_documents.filter("doc_id = 5")
    assert fingerprints.edited_fingerprints(only).first().near_next == 1.0


def test_likeness_follows_the_edit(spark, small):
    rows = QUERIES["op10_fingerprints"](spark, small).collect()
    long = [r for r in rows if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def test_likeness_of_long_texts(spark):
    """An edit that keeps three quarters of the pieces shares 0.6 of all pieces, at any length."""
    def text(n, salt):
        return "\n".join(f"{salt} piece {i}" for i in range(n))

    rows = [(i, text(n, i), text(n - n // 4, i) + "\n" + text(n // 4, f"other{i}"), text(n, f"unlike{i}"))
            for i, n in enumerate((40, 500, 2000, 10_000, 100_000))]
    docs = spark.createDataFrame([(10 * i + k, t) for i, *texts in rows for k, t in enumerate(texts)], "doc_id long, text string")
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    pairs = spark.createDataFrame([(i, prints[10 * i], prints[10 * i + 1], prints[10 * i + 2]) for i in range(len(rows))],
                                  "i long, a string, b string, c string")
    for r in fingerprints.with_likeness(pairs, {"near": ("a", "b"), "far": ("a", "c")}).collect():
        assert abs(r.near - 0.6) < 0.1 and r.far < 0.15


# The chain

def test_pipeline_stage_by_stage(spark, small, model_file, monkeypatch):
    """Each stage of the run against a plain version over what the stage before gave."""
    import corpus_pipeline
    import duckdb
    import sentencepiece

    given = {}

    def kept(df, label):
        given[label.removeprefix("pipeline-")] = out = stored(df, label)
        return out

    monkeypatch.setattr(corpus_pipeline, "stored", kept)
    last = corpus_pipeline.run(spark, small)
    assert list(given) == [name for name, _ in corpus_pipeline.STAGES]
    docs = table(spark, small, "documents")
    ids = {name: collections.Counter(r.doc_id for r in df.select("doc_id").collect()) for name, df in given.items()}
    model = language.fit(docs.filter(~language.held_out()))
    lettered = [(i, t) for i, t in texts_of(docs) if re.search(r"[^\W\d_]", t)]
    far = model.nearest(language.counts_of([t.lower() for _, t in lettered]))[2]
    assert ids["language_id"] == collections.Counter(i for (i, _), gone in zip(lettered, far) if not gone)
    best = {}
    for i, t in texts_of(given["language_id"]):
        best[t] = max(i, best.get(t, i))
    assert ids["exact_dedup"] == collections.Counter(best.values())
    assert ids["near_dedup"] == collections.Counter(set(plain_classes(texts_of(given["exact_dedup"])).values()))
    db = duckdb.connect()
    db.register("documents", given["near_dedup"].toPandas())
    assert ids["mixing"] == collections.Counter(r[0] for r in db.execute(mixing.mix_sql()).fetchall())
    assert ids["sentencepiece"] == ids["mixing"]
    library = sentencepiece.SentencePieceProcessor(model_file=model_file)
    many = {i: len(library.encode(t, add_eos=True)) for i, t in texts_of(given["mixing"])}
    assert all(r.n_tokens == many[r.doc_id] for r in last.collect())
