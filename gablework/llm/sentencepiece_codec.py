"""SentencePiece encoding and decoding for merge-type models with byte fallback.

Encoding does not replay the merges. It walks through the text with the longest vocabulary match at
each place (Aho-Corasick), accepts a piece only if it may follow the one before (merging the two
texts again must give just these two pieces), takes the next shorter match otherwise, and steps
back when none is left; places from which no encoding goes on are marked in a field of flags, so
each is tried once. A sequence in which every two neighbours are compatible is the one that
merging gives.

A text is cut where no piece can span (before a word's leading blank, beside characters of no longer
piece), so that frequent words are looked up in a memo of bounded size.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import in_batches, unused

BLANK = "▁"
#: Words kept in a worker's memo, and the longest of them.
MEMO_WORDS, MEMO_LENGTH = 250_000, 64
#: Pairs of pieces whose compatibility is remembered, as often again from before.
FIT_PAIRS = 1 << 17
#: Characters whose matches are found at a time, in texts without a blank.
BLOCK = 1024


def read_model(path: str) -> dict:
    """What encoding needs of a model file, as plain values to send to tasks."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, trained = model.normalizer_spec, model.trainer_spec
    if trained.model_type != trained.BPE or not trained.byte_fallback or trained.treat_whitespace_as_suffix \
            or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
        raise ValueError("only merge-type models with byte fallback and identity normalization")
    lib = sentencepiece.SentencePieceProcessor(model_file=path)
    kinds = {p.type for p in model.pieces}
    if proto.ModelProto.SentencePiece.USER_DEFINED in kinds or proto.ModelProto.SentencePiece.UNUSED in kinds:
        raise ValueError("user-defined and unused pieces are not supported")
    text = [(i, p.piece, p.score) for i, p in enumerate(model.pieces) if p.type == p.NORMAL]
    tables = {"pieces": text, "bytes": {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == p.BYTE},
              "prefix": bool(norm.add_dummy_prefix), "end": lib.eos_id()}
    # Pieces that merging their own characters does not give can't occur.
    scores = {p: s for _, p, s in text}
    tables["reachable"] = [i for i, p, _ in text if merged(p, scores) == [p]]
    return tables


def merged(text: str, scores: dict[str, float]) -> list[str]:
    """Plain merging of a short text: the best-scored neighbours first, the leftmost of equals."""
    parts = list(text)
    while True:
        best, at = None, -1
        for i in range(len(parts) - 1):
            score = scores.get(parts[i] + parts[i + 1])
            if score is not None and (best is None or score > best):
                best, at = score, i
        if at < 0:
            return parts
        parts[at:at + 2] = [parts[at] + parts[at + 1]]


class Codec:
    """Encodes and decodes texts with the tables of ``read_model``."""

    def __init__(self, tables: dict):
        import ahocorasick

        self.scores = {p: s for _, p, s in tables["pieces"]}
        self.piece = {i: p for i, p, _ in tables["pieces"]}
        self.byte_id, self.byte_of = tables["bytes"], {i: b for b, i in tables["bytes"].items()}
        self.prefix, self.end = tables["prefix"], tables["end"]
        self.automaton = ahocorasick.Automaton()
        self.known: set[str] = set()
        for i in tables["reachable"]:
            p = self.piece[i]
            self.automaton.add_word(p, (len(p), i))
            if len(p) == 1:
                self.known.add(p)
        self.automaton.make_automaton()
        self.longest = max(map(len, self.piece.values()))
        # The next shorter piece that begins as a piece does.
        by_text = {self.piece[i]: (len(self.piece[i]), i) for i in tables["reachable"]}
        self.shorter = {i: next((by_text[p[:n]] for n in range(len(p) - 1, 0, -1) if p[:n] in by_text), None)
                        for p, (_, i) in by_text.items()}
        long = [p for p in self.piece.values() if len(p) > 1]
        joined = {c for p in long for c in p}
        if any(BLANK in p.lstrip(BLANK) for p in long):  # a blank may also end a piece
            inside = "".join(map(re.escape, sorted(joined)))
            self.cut = re.compile(f"[{inside}]+|[^{inside}]").findall
        else:
            inside = "".join(map(re.escape, sorted(joined - {BLANK})))
            self.cut = re.compile(f"{BLANK}*[{inside}]+|{BLANK}+|[^{inside}{BLANK}]").findall
        self.fits: dict[tuple[int, int], bool] = {}
        self.older_fits: dict[tuple[int, int], bool] = {}
        self.memo: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.digits = {i: f"{i} " for i in (*self.piece, *self.byte_of)}
        self.changed = False

    def compatible(self, a: int, b: int) -> bool:
        """Whether merging the joined text of two pieces gives the two pieces again."""
        found = self.fits.get((a, b))
        if found is None:
            found = self.older_fits.get((a, b))
            if found is None:
                p, q = self.piece[a], self.piece[b]
                found = merged(p + q, self.scores) == [p, q]
            if len(self.fits) >= FIT_PAIRS:
                self.older_fits, self.fits = self.fits, {}
            self.fits[a, b] = found
        return found

    def longest_at(self, text: str, block: int) -> dict[int, tuple[int, int]]:
        """For each place of a block the (length, id) of the longest piece that starts there."""
        start = block * BLOCK
        stop = start + BLOCK
        longest = {}
        for last, found in self.automaton.iter(text, start, min(len(text), stop + self.longest)):
            longest[last - found[0] + 1] = found  # matches come by their ends, so the longest is the last
        return longest

    def walk(self, text: str) -> list[int]:
        """Ids of a text all of whose characters are pieces, by longest matches with backtracking."""
        size = len(text)
        failed = bytearray(size + 1)
        number, longest = 0, self.longest_at(text, 0)
        ids: list[int] = []
        sizes: list[int] = []
        fits, shorter = self.fits, self.shorter
        place, before = 0, -1
        found = longest[0]
        while True:
            while found is not None:
                length, piece = found
                if not failed[place + length]:
                    fit = before < 0 or fits.get((before, piece))
                    if fit or fit is None and self.compatible(before, piece):
                        break
                found = shorter[piece]
            if found is not None:
                ids.append(piece)
                sizes.append(length)
                place += length
                if place == size:
                    return ids
                before = piece
                if place // BLOCK != number:
                    number = place // BLOCK
                    longest = self.longest_at(text, number)
                found = longest[place]
            else:
                # No piece goes on from here; step back and shorten the last one.
                failed[place] = 1
                piece = ids.pop()
                place -= sizes.pop()
                before = ids[-1] if ids else -1
                found = shorter[piece]
                if place // BLOCK != number:
                    number = place // BLOCK
                    longest = self.longest_at(text, number)

    def encode_part(self, part: str) -> list[int]:
        if len(part) == 1 and part not in self.known:
            return [self.byte_id[b] for b in part.encode()]
        if self.known.issuperset(part):
            return self.walk(part)
        ids: list[int] = []  # characters that only occur inside longer pieces
        for run in re.findall("|".join((f"[{''.join(map(re.escape, sorted(set(part) & self.known)))}]+", ".")), part, re.S):
            ids += self.walk(run) if self.known.issuperset(run) else [self.byte_id[b] for b in run.encode()]
        return ids

    def parts(self, text: str) -> list[str]:
        if not text:
            return []
        return self.cut((BLANK if self.prefix else "") + text.replace(" ", BLANK))

    def encode(self, text: str) -> list[int]:
        """All ids of a text with the end id."""
        return [i for part in self.parts(text) for i in self.encode_part(part)] + [self.end]

    def decode(self, ids: list[int], start: bool = True) -> str:
        """The text of ids; control ids have none, and the blank put before a text goes."""
        out: list[str] = []
        raw = bytearray()
        if self.byte_of.keys().isdisjoint(ids):
            out, ids = [self.piece.get(i, "") for i in ids], []
        for i in ids:
            if i in self.byte_of:
                raw.append(self.byte_of[i])
                continue
            if raw:
                out.append(utf8(raw))
                raw = bytearray()
            out.append(self.piece.get(i, ""))
        if raw:
            out.append(utf8(raw))
        text = "".join(out).replace(BLANK, " ")
        return text[1:] if start and self.prefix and text.startswith(" ") else text

    def written(self, part: str) -> str:
        """The ids of a part, each with a blank behind; remembered if they decode to the part."""
        found = self.older.get(part)
        if found is None:
            ids = self.encode_part(part)
            found = "".join([self.digits[i] for i in ids])
            if self.decode(ids, start=False) != part.replace(BLANK, " "):
                self.changed = True
                return found
        if len(part) <= MEMO_LENGTH:
            if len(self.memo) >= MEMO_WORDS:  # words not met again for two such spans are forgotten
                self.older, self.memo = self.memo, {}
            self.memo[part] = found
        return found

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, hash of the written ids, hash of the text that they decode to.

        Ids decode part by part, and each different part is decoded when it is first met; so the text is
        put together again from its parts unless one of them comes back changed.
        """
        self.changed = False
        ids = "".join([self.memo.get(part) or self.written(part) for part in self.parts(text)]) + str(self.end)
        if self.changed:
            back = self.decode([int(i) for i in ids.split()])
        else:
            back = text.replace(BLANK, " ")
        return ids.count(" ") + 1, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def utf8(raw: bytes | bytearray) -> str:
    """Text of a run of bytes; each byte that is no part of a character becomes a replacement mark."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, i = [], 0
    while i < len(raw):
        for n in (1, 2, 3, 4):
            try:
                out.append(bytes(raw[i:i + n]).decode())
                i += n
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            i += 1
    return "".join(out)


def _shared(docs: DataFrame, model: str):
    """A function for tasks that gives the worker's codec. What is broadcast is one vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(read_model(model))
    in_batches(docs.sparkSession)

    def codec() -> Codec:
        tables = shared.value  # Spark takes it out of a worker, the codec with it, when the next task has other work
        if "codec" not in tables:
            tables["codec"] = Codec(tables)
        return tables["codec"]

    return codec


def encode(docs: DataFrame, model: str, text_col: str = "text", ids: str = "ids") -> DataFrame:
    """``docs`` with a column of all ids (with the end id, no begin id) of each whole text.

    A missing text is encoded as an empty one, whose ids are the end id alone. Rows are mapped
    one by one, so repeated rows and other columns stay as they are; a column named ``ids`` is replaced.
    """
    return _mapped(docs, model, text_col, [(ids, pa.list_(pa.int32()), T.ArrayType(T.IntegerType()))],
                   lambda codec, text: (codec.encode(text),))


def decode(docs: DataFrame, model: str, ids: str = "ids", text_col: str = "decoded") -> DataFrame:
    """``docs`` with the text of a column of ids; missing ids give a missing text."""
    codec_of_worker = _shared(docs, model)
    plain = docs.drop(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of_worker()
        for batch in batches:
            found = [None if x is None else codec.decode(x) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())],
                                             [*batch.schema.names, text_col])

    return plain.mapInArrow(run, T.StructType([*plain.schema.fields, T.StructField(text_col, T.StringType())]))


def encoded_digests(docs: DataFrame, model: str, text_col: str = "text",
                    keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_tokens, ids_sha256 and decoded_sha256 (see ``Codec.digests``),
    for tables whose ids need not be kept. Missing and empty texts, repeats and other columns as for ``encode``."""
    return _mapped(docs, model, text_col, [("n_tokens", pa.int64(), "long"), ("ids_sha256", pa.string(), "string"),
                                           ("decoded_sha256", pa.string(), "string")], Codec.digests, keep)


def _mapped(docs: DataFrame, model: str, text_col: str, added: list, of, keep: list[str] | None = None) -> DataFrame:
    codec_of_worker = _shared(docs, model)
    new = {name for name, _, _ in added}
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    source = unused(docs, "_encoded")
    schema = docs.select(*keep).schema
    plain = docs.select(*keep, F.col(text_col).alias(source))  # the text itself, whatever becomes of its column
    for name, _, kind in added:
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of_worker()
        for batch in batches:
            found = [of(codec, text or "") for text in batch.column(source).to_pylist()]
            columns = list(zip(*found)) or [()] * len(added)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *(pa.array(list(c), kind) for c, (_, kind, _) in zip(columns, added))],
                [*keep, *(name for name, _, _ in added)])

    return plain.mapInArrow(run, schema)
