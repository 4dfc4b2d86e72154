"""Token counts by a linear longest-match automaton.

The vocabulary is a trie over bytes. Every node also knows where to go on when no longer piece matches (its
failure link) and how many pieces are complete by then (its popped count), both found once, ahead. A word is
read byte by byte: each step goes down the trie or along a failure link, adding its count; so its number of
greedy longest pieces comes in time linear in its length, and no piece is ever built.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import in_batches, text_or_empty, unused, worker_cached

#: Words kept in a worker's memo, and the longest of them.
MEMO_WORDS, MEMO_LENGTH = 300_000, 64
#: Words as the byte-level vocabularies cut them: contractions, letters, digits, other signs, white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def read_ranks(path: str) -> list[bytes]:
    """Pieces of a vocabulary file of lines with a base64 piece and its rank."""
    with open(path, "rb") as f:
        return [base64.b64decode(line.split()[0]) for line in f if line.strip()]


class LongestMatch:
    """Counts greedy longest pieces of byte strings."""

    def __init__(self, pieces: Iterable[bytes]):
        down: dict[int, int] = {}  # node * 256 + byte -> node; the root is 0
        parents, ends = [(-1, -1)], [False]
        for piece in pieces:
            node = 0
            for byte in piece:
                key = node << 8 | byte
                node = down.get(key, -1)
                if node < 0:
                    node = down[key] = len(parents)
                    parents.append((key >> 8, byte))
                    ends.append(False)
            ends[node] = node > 0
        self.down = down
        self.fail = [-1] * len(parents)
        self.popped = [0] * len(parents)
        depth = [0] * len(parents)
        for node in range(1, len(parents)):
            depth[node] = depth[parents[node][0]] + 1
        for node in sorted(range(1, len(parents)), key=depth.__getitem__):
            if ends[node]:
                self.fail[node], self.popped[node] = 0, 1
                continue
            parent, byte = parents[node]
            at, count = self.fail[parent], self.popped[parent]
            while at >= 0 and (at << 8 | byte) not in down:
                count += self.popped[at]
                at = self.fail[at]
            if at >= 0:
                self.fail[node], self.popped[node] = down[at << 8 | byte], count

    def count(self, word: bytes) -> int:
        """Number of pieces; 1 (the unknown token) for a word that longest matches do not cover."""
        down, fail, popped = self.down, self.fail, self.popped
        node = total = 0
        for byte in word:
            while (following := down.get(node << 8 | byte, -1)) < 0:
                total += popped[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = following
        while node > 0:
            total += popped[node]
            node = fail[node]
        return 1 if node < 0 else total


class Counter:
    """Counts words and tokens of texts, remembering frequent words in bounded memory."""

    def __init__(self, pieces: list[bytes]):
        import regex

        self.words = regex.compile(PATTERN).findall
        self.match = LongestMatch(pieces)
        self.memo: dict[str, int] = {}

    def of(self, word: str) -> int:
        n = self.match.count(word.encode())
        if len(word) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            self.memo[word] = n
        return n

    def counts(self, text: str) -> tuple[int, int]:
        words = self.words(text)
        get = self.memo.get
        return len(words), sum([get(w) or self.of(w) for w in words])


def count_tokens(docs: DataFrame, pieces: list[bytes], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_words and n_tokens of each whole text.

    Missing and empty texts have none. A word that longest matches do not cover is one (unknown) token. Rows are
    counted one by one, so repeated rows and other columns stay; columns with the two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(pieces)  # size of one vocabulary
    key = "longest-match", hash(tuple(pieces))
    in_batches(docs.sparkSession)
    new = {"n_words": T.LongType(), "n_tokens": T.LongType()}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = unused(docs, "_text")
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(n, t) for n, t in new.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_cached(key, lambda: Counter(shared.value))
        for batch in batches:
            found = [counter.counts(text) for text in batch.column(source).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array([f[i] for f in found], pa.int64()) for i in (0, 1))], [*keep, *new])

    return docs.select(*keep, text_or_empty(text_col).alias(source)).mapInArrow(run, schema)
