"""Spelling variants: words one letter apart, found by a trie over frequency vectors.

A word's vector counts its letters by groups of letters. One inserted, deleted or replaced letter adds at most one to
one count and takes at most one from another, so near words are found by walking a trie of the successive counts,
depth first, with a budget of one surplus and one deficit; words at the leaves are verified letter by letter.

The first levels of the trie (length, then the counts of the commonest groups) are a key by which Spark deals the words, so
each task holds the subtries of its cells only, and a word goes as a query to the cells that the budget reaches. Of the
two words of a pair only one asks: the shorter, or the one whose first differing count is the smaller. A cell of very
many words is split into chunks, each a subtrie, and its queries go to all of them.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .byte_hashes import text_bytes
from .common import Scratch, batches_of, in_batches, stored, text_or_empty

#: Letters of words, one byte each in Latin-1; A-Z is lower-cased.
LETTERS = [*range(ord("a"), ord("z") + 1), *range(0xC0, 0x100)]
SHORTEST, LEAST = 5, 3
#: One run in so many (by its hash with the id) loses a letter.
SLIP = 97
#: Levels of the trie: groups of letters, of which the first KEYED, with the length, are the key.
GROUPS, KEYED = 16, 4
#: Words of a cell in one subtrie.
CHUNK = 20_000
#: Pairs of a leaf that are compared at once, and queries of one walk.
LEAF, QUERIES = 1 << 14, 1 << 15
#: Different words that a task counts before it sends the counts on.
HELD = 400_000


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, n: the words of all whole texts and how often they occur, whatever their number.

    Runs of letters are lower-cased in A-Z only. If SLIP divides the CRC-32 of ``<id>:<run>``, the letter at that number
    modulo the run's length is left out. A null text has no words, a null id is written as nothing. Repeated rows each count.
    """
    in_batches(docs.sparkSession)
    to_runs = bytearray(b" " * 256)
    for letter in LETTERS:
        to_runs[letter] = letter
    for letter in range(ord("A"), ord("Z") + 1):
        to_runs[letter] = letter + 32
    to_runs = bytes(to_runs)

    def slipped(run: bytes, number: int) -> bytes:
        at = number % len(run)
        return run[:at] + run[at + 1:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, crc = Counter(), zlib.crc32

        def counted() -> pa.RecordBatch:
            words = [w for w in counts if len(w) >= SHORTEST]
            return pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in words], pa.string()),
                 pa.array([counts[w] for w in words], pa.int64())], ["word", "n"])

        for batch in batches:
            for name, text in zip(batch.column("id").to_pylist(), batch.column("_text").to_pylist()):
                # Characters beyond Latin-1 become question marks, which end a run as they do.
                runs = text.encode("latin-1", "replace").translate(to_runs).split()
                counts.update(runs)
                start = crc(f"{name}:".encode())
                for word in set(runs):
                    number = crc(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if number % SLIP == 0:
                        n = runs.count(word)
                        counts[word] -= n
                        counts[slipped(word, number)] += n
            if len(counts) >= HELD:
                yield counted()
                counts.clear()
        if counts:
            yield counted()

    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), text_or_empty(text_col).alias("_text"))
    return (rows.mapInArrow(run, "word string, n long").filter("n > 0")
            .groupBy("word").agg(F.sum("n").alias("n")))


def letter_groups(words: DataFrame) -> np.ndarray:
    """The group of each letter, by its Latin-1 byte: the commonest letters of ``words`` head the groups in order,
    each other letter joins the lightest group. There are at most as many counts as letters."""
    common = (words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''")
              .groupBy("letter").agg(F.count(F.lit(1)).alias("n")).collect())
    found = {r["letter"].encode("latin-1")[0]: r["n"] for r in common}
    weights, groups = np.zeros(GROUPS), np.zeros(256, np.int64)
    for i, letter in enumerate(sorted(LETTERS, key=lambda c: (-found.get(c, 0), c))):
        groups[letter] = i if i < GROUPS else int(np.argmin(weights))
        weights[groups[letter]] += found.get(letter, 0)
    return groups


def vectors(letters: np.ndarray, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Counts of the letter groups of each word; its letters begin at ``starts``."""
    words = len(starts) - 1
    cell = np.repeat(np.arange(words), np.diff(starts)) * GROUPS + groups[letters]
    return np.bincount(cell, minlength=words * GROUPS).reshape(words, GROUPS)


def dealt(words: DataFrame, groups: np.ndarray) -> DataFrame:
    """key, kind, surplus, deficit, n, word (its letters' bytes): each word as a member (kind 0) of its cell and as a query in all
    cells that hold words as long (1) or a letter longer (2), with the budget that its way there leaves."""
    steps = np.eye(KEYED + 1, dtype=np.int32)  # the first is the length

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, starts = text_bytes(batch.column("word"))
            counts = vectors(letters, starts, groups)[:, :KEYED]
            home = np.column_stack([np.diff(starts), counts]).astype(np.int32)

            def sent(key: np.ndarray, kind: int, surplus: int, deficit: int) -> pa.RecordBatch:
                rows = batch if (key >= 0).all() else batch.filter(pa.array((key >= 0).all(axis=1)))
                key = key[(key >= 0).all(axis=1)]
                whole = [pa.array(np.full(len(key), v, np.int32)) for v in (kind, surplus, deficit)]
                return pa.RecordBatch.from_arrays([pa.array([k.tobytes() for k in key], pa.binary()), *whole,
                                                   rows.column("n"), rows.column("word")],
                                                  ["key", "kind", "surplus", "deficit", "n", "word"])

            yield sent(home, 0, 0, 0)
            yield sent(home, 1, 1, 1)
            yield sent(home + steps[0], 2, 1, 0)
            for i in range(1, KEYED + 1):
                yield sent(home + steps[i], 1, 0, 1)
                yield sent(home + steps[0] + steps[i], 2, 0, 0)
                for j in range(i + 1, KEYED + 1):
                    yield sent(home + steps[i] - steps[j], 1, 0, 0)

    return (words.select("n", F.encode("word", "ISO-8859-1").alias("word"))
            .mapInArrow(run, "key binary, kind int, surplus int, deficit int, n long, word binary"))


def best(of: np.ndarray, n: np.ndarray, letters: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of pairs (of, pick): each different ``of``, its number of pairs, and its pick of largest n, the first by letters."""
    place = np.empty(len(n), np.int64)
    place[np.lexsort(letters.T[::-1])] = np.arange(len(n))
    order = np.lexsort((place[pick], -n[pick], of))
    found, first, pairs = np.unique(of[order], return_index=True, return_counts=True)
    return found, pairs, pick[order][first]


class Subtrie:
    """The words of one cell, in the order of their counts, so that a node of the trie is a range of them."""

    def __init__(self, letters: np.ndarray, n: np.ndarray, groups: np.ndarray):
        counts = self.counted(letters, groups)
        order = np.lexsort(counts.T[::-1])
        self.letters, self.n, self.counts, self.groups = letters[order], n[order], counts[order], groups

    @staticmethod
    def counted(letters: np.ndarray, groups: np.ndarray) -> np.ndarray:
        starts = np.arange(len(letters) + 1) * letters.shape[1]
        return vectors(letters.reshape(-1), starts, groups)[:, KEYED:].astype(np.int32)

    def near(self, letters: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Query and word of each pair of near words; queries of one walk are as long as the words or a letter shorter."""
        asked = self.counted(letters, self.groups)
        levels = self.counts.shape[1]
        pairs: list[tuple[np.ndarray, np.ndarray]] = []

        def walk(level: int, low: int, high: int, query: np.ndarray, more: np.ndarray, less: np.ndarray) -> None:
            if not len(query):
                return
            if level == levels or (high - low) * len(query) <= LEAF:
                step = max(1, (8 * LEAF) // (high - low))
                for k in range(0, len(query), step):
                    some = slice(k, k + step)
                    change = self.counts[None, low:high, level:] - asked[query[some], None, level:]
                    fits = ((np.maximum(change, 0).sum(axis=2) <= more[some, None])
                            & (np.maximum(-change, 0).sum(axis=2) <= less[some, None]))
                    q, w = np.nonzero(fits)
                    pairs.append(self.verified(letters, query[some][q], low + w))
                return
            column = self.counts[low:high, level]
            ends = np.append(np.flatnonzero(column[1:] != column[:-1]) + 1, high - low)
            begin, wanted = 0, asked[query, level]
            for end in ends:
                change = column[begin] - wanted
                reached = (change <= more) & (-change <= less)
                moved = change[reached]
                walk(level + 1, low + begin, low + int(end), query[reached], more[reached] - np.maximum(moved, 0),
                     less[reached] - np.maximum(-moved, 0))
                begin = int(end)

        walk(0, 0, len(self.n), np.arange(len(letters)), surplus, deficit)
        none = np.zeros(0, np.int64)
        return tuple(map(np.concatenate, zip(*pairs))) if pairs else (none, none)

    def verified(self, letters: np.ndarray, query: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs that differ by exactly one letter."""
        a, b = letters[query], self.letters[word]
        if a.shape[1] == b.shape[1]:
            right = (a != b).sum(axis=1) == 1
        else:
            same, moved = a == b[:, :-1], a == b[:, 1:]
            right = np.logical_and.accumulate(same, axis=1).sum(axis=1) + np.logical_and.accumulate(
                moved[:, ::-1], axis=1).sum(axis=1) >= a.shape[1]
        return query[right], word[right]


def met(rows: Iterator[pa.RecordBatch], groups: np.ndarray) -> Iterator[pa.RecordBatch]:
    """word, n_near, best, best_n of the queries and members among ``rows`` of ``dealt``, which come by key, chunk and kind.
    A cell's members are held while its queries pass by in blocks; a word may come out in several rows."""
    here, members, queries, trie = None, [], {1: [], 2: []}, None

    def results(kind: int) -> Iterator[pa.RecordBatch]:
        nonlocal trie, members
        asked, queries[kind] = queries[kind], []
        if not asked or not members:
            return
        if trie is None:
            trie = Subtrie(np.concatenate([m[0] for m in members]), np.concatenate([m[1] for m in members]), groups)
        letters, n, surplus, deficit = map(np.concatenate, zip(*asked))
        query, word = trie.near(letters, surplus, deficit)
        yield answers(letters, trie.letters, trie.n, query, word)
        # Two words of one cell ask each other; else the member has to be told.
        told = surplus[query] + deficit[query] < 2
        yield answers(trie.letters, letters, n, word[told], query[told])

    def answers(asking, others, n, of, pick) -> pa.RecordBatch:
        found, pairs, top = best(of, n, others, pick)
        return pa.RecordBatch.from_arrays(
            [pa.array([w.tobytes() for w in asking[found]], pa.binary()), pa.array(pairs, pa.int64()),
             pa.array([w.tobytes() for w in others[top]], pa.binary()), pa.array(n[top], pa.int64())],
            ["word", "n_near", "best", "best_n"])

    for batch in rows:
        if not batch.num_rows:
            continue
        width = 4 * (KEYED + 1)
        keys = text_bytes(batch.column("key"))[0].reshape(-1, width)
        chunk, kind = (batch.column(c).to_numpy() for c in ("chunk", "kind"))
        change = (keys[1:] != keys[:-1]).any(axis=1) | (chunk[1:] != chunk[:-1]) | (kind[1:] != kind[:-1])
        starts = np.append(0, np.flatnonzero(change) + 1)
        for a, b in zip(starts, np.append(starts[1:], len(keys))):
            cell = keys[a].tobytes(), chunk[a]
            if cell != here:
                for k in queries:
                    yield from results(k)
                here, members, trie = cell, [], None
            part = batch.slice(a, b - a)
            letters = text_bytes(part.column("word"))[0].reshape(b - a, -1)
            if kind[a] == 0:
                members.append((letters, part.column("n").to_numpy()))
            elif members:
                queries[kind[a]].append((letters, *(part.column(c).to_numpy() for c in ("n", "surplus", "deficit"))))
                if sum(len(q[0]) for q in queries[kind[a]]) >= QUERIES:
                    yield from results(kind[a])
    for k in queries:
        yield from results(k)


def near_words(words: DataFrame, scratch: Scratch) -> DataFrame:
    """word, n_near, best, best_n: how many of ``words`` (word, n; each once) differ from a word by one letter, and the commonest of
    them, the first in code-point order among equals. Words without any are left out."""
    spark = words.sparkSession
    groups = letter_groups(words)
    with batches_of(spark, 20_000):
        sent = scratch.keep(dealt(words, groups), "spelling-dealt")
        sizes = sent.filter("kind = 0").groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > CHUNK)
        chunks = F.coalesce(F.ceil(F.col("size") / CHUNK).cast("int"), F.lit(1))
        own = F.array(F.pmod(F.xxhash64("word"), chunks).cast("int"))
        sent = (sent.join(scratch.keep(sizes, "spelling-large"), "key", "left")
                .withColumn("chunk", F.explode(F.when(F.col("kind") == 0, own).otherwise(F.sequence(F.lit(0), chunks - 1))))
                .drop("size"))
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = (sent.repartition(tasks, "key", "chunk").sortWithinPartitions("key", "chunk", "kind")
                 .mapInArrow(lambda rows: met(rows, groups), "word binary, n_near long, best binary, best_n long"))
        found = scratch.keep(found, "spelling-found")
    top = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("top")
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top)
            .select(F.decode("word", "ISO-8859-1").alias("word"), "n_near",
                    F.decode("top.best", "ISO-8859-1").alias("best"), (-F.col("top.less")).alias("best_n")))


def roots(forms: DataFrame, scratch: Scratch) -> DataFrame:
    """word, root: the end of the chain of forms from each word. ``forms`` has word and form; a form is at least twice as frequent
    as its word, so chains are short and end. Each round doubles the steps taken, as a written table."""
    steps = scratch.keep(forms.select("word", F.col("form").alias("root")), "spelling-steps")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        far = scratch.keep(steps.join(onward, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")), "spelling-steps")
        if far.filter("moved").isEmpty():
            return far.select("word", "root")
        steps = far.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """word, form, root, n, n_near, form_n of each word of at least SHORTEST letters that occurs LEAST times (``word_counts``).

    Words are near if they differ by exactly one inserted, deleted or replaced letter. The form is the commonest near word,
    the first in code-point order among equals, if it is at least twice as frequent, else null; the root is the
    last of the chain of forms, or the word itself. No texts give no rows. Other columns are left out, whatever their names.
    """
    scratch = Scratch(docs.sparkSession)
    words = scratch.keep(word_counts(docs, id_col, text_col).filter((F.col("n") >= LEAST) & (F.length("word") >= SHORTEST)),
                         "spelling-words")
    near = words.join(near_words(words, scratch), "word", "left")
    better = F.col("best_n") >= 2 * F.col("n")
    near = scratch.keep(near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(better, F.col("best")).alias("form"),
                                    F.when(better, F.col("best_n")).alias("form_n")), "spelling-near")
    chains = roots(near.filter("form is not null"), scratch)
    result = stored(near.join(chains, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "spelling-variants")
    scratch.delete()
    return result


def variants_sql() -> str:
    """The variants of the table documents in DuckDB SQL."""
    return """
WITH RECURSIVE
bytes AS (
  SELECT i, list_reduce(range(8), lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i) AS v
  FROM range(256) AS r(i)),
runs AS (
  SELECT id, r, count(*) AS k FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r FROM documents) GROUP BY ALL),
named AS (SELECT row_number() OVER () AS name, r, k, hex(encode(id || ':' || r)) AS hx FROM runs),
crc AS (
  SELECT name, hx, 0 AS place, 4294967295 AS c FROM named
  UNION ALL
  SELECT name, hx, place + 1, xor(c >> 8, v) FROM crc JOIN bytes ON i = xor(c, ('0x' || substr(hx, 2 * place + 1, 2))::BIGINT) & 255
  WHERE 2 * place < length(hx)),
hashed AS (SELECT r, k, xor(c, 4294967295) AS h FROM named JOIN crc USING (name) WHERE 2 * place = length(named.hx)),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
cut AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words),
gaps AS (SELECT word, n, substr(word, 1, i - 1) || '.' || substr(word, i + 1) AS gap,
  substr(word, 1, i - 1) || substr(word, i + 1) AS shorter FROM cut),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.gap = b.gap AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.shorter = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.shorter = w.word),
tops AS (SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * w.n THEN other END AS form,
    CASE WHEN other_n >= 2 * w.n THEN other_n END AS form_n FROM words w LEFT JOIN tops t ON w.word = t.word),
chain AS (
  SELECT word, word AS root, form AS ahead FROM formed
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON c.ahead = f.word)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN chain c ON f.word = c.word WHERE c.ahead IS NULL"""
