"""Language identification by nearest centroid.

A text is a vector of byte 2-grams and 3-grams of its lower-case letters, hashed to DIMENSIONS places, weighted by
1 + log(count) and inverse document frequency, of length one. Each language has several centroids, found by
spherical k-means among its training texts; a text gets the language of the centroid with the greatest cosine.
A text that is further from its centroid than nearly any training text with as many grams is rejected.
Training texts are also cut short and joined for this, and sizes that few of them have use the limit of the nearest size.

The model is learned from at most about ``per_language`` texts of each language, dealt by a hash of the id; frequencies
are counted by Spark and each language's centroids are found in a task of its own. Prediction is a map over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .byte_hashes import text_bytes
from .common import in_batches, stored, unused

DIMENSIONS = 4096
CENTROIDS = 3
#: Training texts of one language; the model is fitted on a sample of this expected size.
PER_LANGUAGE = 1500
#: A cosine under this share of the lowest usual one (by number of grams) is rejected.
REJECT_SHARE, USUAL = 0.4, 0.002
#: Training fragments from which a class of sizes has a floor of its own; others take the nearest one's.
FILLED = 20
SIZES = 24  # classes of texts by the binary logarithm of their number of different grams
#: Bytes whose grams are counted at a time.
PIECE = 1 << 17
UNKNOWN = "und"

_BITS = DIMENSIONS.bit_length() - 1
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed 2-grams and 3-grams: one row for each text, whatever its length."""
    texts = len(offsets) - 1
    out = np.zeros(texts * DIMENSIONS, np.float32)
    for start in range(0, len(data), PIECE):
        stop = min(start + PIECE, len(data))
        b = _LETTER[data[start:min(stop + 2, len(data))]].astype(np.uint32)
        first, last = np.searchsorted(offsets, [start, stop - 1], side="right") - 1
        edges = np.clip(offsets[first:last + 2], start, stop) - start
        home = np.repeat(np.arange(first, last + 1), np.diff(edges)) * DIMENSIONS
        ends = offsets[first + 1:last + 2] - start
        for n, factor in ((2, 2654435769), (3, 2246822519)):
            code = np.zeros(max(len(b) - n + 1, 0), np.uint32)
            for k in range(n):
                code = (code << np.uint32(8)) | b[k:len(code) + k]
            size = min(len(code), stop - start)
            code = code[:size]
            blank = np.uint32(0x2020 if n == 2 else 0x202020)
            at = home[:size] + (code * np.uint32(factor) >> np.uint32(32 - _BITS))
            inside = code != blank
            for back in range(1, n):
                crossing = ends - back
                inside[crossing[(crossing >= 0) & (crossing < size)]] = False
            base = int(first) * DIMENSIONS
            found = np.bincount(at[inside] - base)
            out[base:base + len(found)] += found
    return out.reshape(texts, DIMENSIONS)


def unit_vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    v = np.zeros_like(counts)
    seen = counts > 0
    v[seen] = 1 + np.log(counts[seen])
    v *= idf
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return v


def size_class(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum((counts > 0).sum(axis=1), 1)).astype(int)


@dataclass
class LanguageModel:
    """Centroids (one row each) with their languages, inverse frequencies, and least accepted cosines by size."""
    languages: list[str]
    centroids: np.ndarray
    floors: np.ndarray
    idf: np.ndarray

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Number of the nearest centroid, its cosine, and whether the text is too far from it."""
        cosines = unit_vectors(counts, self.idf) @ self.centroids.T
        best = cosines.argmax(axis=1)
        score = np.clip(cosines[np.arange(len(best)), best], 0.0, 1.0)
        return best, score, score < self.floors[best, size_class(counts)]


def spherical_means(v: np.ndarray, k: int, rounds: int = 20) -> np.ndarray:
    """k unit centroids by cosine; the first is the mean, further starts are the vectors furthest from all so far."""
    def unit(x):
        return x / np.maximum(np.linalg.norm(x), 1e-12)

    centers = [unit(v.mean(axis=0))]
    while len(centers) < min(k, len(v)):
        centers.append(v[(v @ np.array(centers).T).max(axis=1).argmin()])
    c = np.array(centers)
    for _ in range(rounds):
        own = (v @ c.T).argmax(axis=1)
        c = np.array([unit(v[own == i].mean(axis=0)) if (own == i).any() else c[i] for i in range(len(c))])
    return c


def carried(floors: np.ndarray, least: np.ndarray) -> np.ndarray:
    """``floors`` with those of sparse classes (NaN) taken from the nearest filled class of the row, the smaller one if two are
    as near. A row without any takes the least of the others for each class, or its own ``least`` if no row has any."""
    out = floors.copy()
    filled = ~np.isnan(floors)
    some = filled.any(axis=1)
    for i in np.flatnonzero(some):
        at = np.flatnonzero(filled[i])
        out[i] = floors[i, at[np.abs(np.arange(floors.shape[1])[:, None] - at).argmin(axis=1)]]
    out[~some] = out[some].min(axis=0) if some.any() else least[:, None]
    return out


def _fragments(text: str) -> list[str]:
    """A text and its first 1, 2, 4, ... words, so that short texts have their usual distances too."""
    parts = text.split()
    out, n = [text], 1
    while n < len(parts):
        out.append(" ".join(parts[:n]))
        n *= 2
    return out


def counts_of(texts: list[str]) -> np.ndarray:
    data, offsets = text_bytes(pa.array(texts, pa.string()))
    return gram_counts(data, offsets)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> LanguageModel:
    """Learn from rows that have a text with a letter and a language; a language of more than ``per_language`` such rows is
    sampled down to about as many. Without such rows the model has no language."""
    text = F.lower(F.col(text_col))
    rows = docs.select(F.col(id_col).alias("id"), text.alias("text"), F.col(lang_col).alias("lang")).filter(
        F.col("lang").isNotNull() & has_letter(F.col("text")))
    sizes = stored(rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    dealt = F.pmod(F.xxhash64("id", F.lit(29)), F.lit(1_000_000)) / 1_000_000
    sample = stored(rows.join(sizes, "lang").filter(dealt < per_language / F.col("n")).select("lang", "text"), "language-sample")

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            total += (gram_counts(*text_bytes(batch.column("text"))) > 0).sum(axis=0)
            texts += batch.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(DIMENSIONS), -1)), pa.array(np.append(total, texts))],
                                         ["place", "n"])

    in_batches(docs.sparkSession)
    frequency = sample.mapInArrow(present, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    found = {r.place: r.n for r in frequency}  # DIMENSIONS + 1 rows
    idf = np.array([np.log((1 + found.get(-1, 0)) / (1 + found.get(i, 0))) + 1 for i in range(DIMENSIONS)], np.float32)

    def of_language(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("text")
        counts = np.empty((len(group), DIMENSIONS), np.float32)
        for i in range(0, len(group), 256):
            counts[i:i + 256] = counts_of(list(group.text[i:i + 256]))
        c = spherical_means(unit_vectors(counts, idf), centroids)
        size, cosine, joined = [], [], counts
        for t in group.text:
            counts = counts_of(_fragments(t))
            size.append(size_class(counts))
            cosine.append((unit_vectors(counts, idf) @ c.T).max(axis=1))
        while len(joined) > 1:  # 2, 4, 8, ... texts as one, by the sums of their grams
            half = len(joined) // 2
            joined = joined[:half] + joined[half:2 * half]
            for i in range(0, half, 256):
                size.append(size_class(joined[i:i + 256]))
                cosine.append((unit_vectors(joined[i:i + 256], idf) @ c.T).max(axis=1))
        size, cosine = np.concatenate(size), np.concatenate(cosine)
        floors = [REJECT_SHARE * float(np.quantile(cosine[size == i], USUAL)) if (size == i).sum() >= FILLED else float("nan")
                  for i in range(SIZES)]
        return pd.DataFrame({"lang": group.lang.iloc[0], "number": range(len(c)), "centroid": [x.tolist() for x in c],
                             "floors": [floors] * len(c), "least": REJECT_SHARE * float(cosine.min())})

    learned = (sample.groupBy("lang").applyInPandas(
        of_language, "lang string, number int, centroid array<float>, floors array<double>, least double")
        .orderBy("lang", "number").collect())  # ``centroids`` rows a language
    return LanguageModel([r.lang for r in learned],
                         np.array([r.centroid for r in learned], np.float32).reshape(len(learned), DIMENSIONS),
                         carried(np.array([r.floors for r in learned], float).reshape(len(learned), SIZES),
                                 np.array([r.least for r in learned], float)), idf)


def identify(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None,
             names: tuple[str, str, str] = ("lang_pred", "score", "rejected")) -> DataFrame:
    """``docs`` (or its columns ``keep``) with lang_pred, score (cosine, 0 to 1) and rejected, or as ``names`` says.

    The whole text is used, and nothing else of the row. A missing text or one without a letter is ``und``, scored 0 and
    rejected; so are all if the model has no language. A text rejected for its distance still names its nearest language.
    Repeated rows get equal results; existing columns with the three names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the number of languages
    in_batches(docs.sparkSession)
    new = dict(zip(names, (T.StringType(), T.DoubleType(), T.BooleanType())))
    lower = unused(docs, "_lower")
    keep = [c for c in (docs.columns if keep is None else keep) if c not in new]
    plain = docs.select(*keep, F.when(has_letter(F.col(text_col)), F.lower(F.col(text_col))).otherwise("").alias(lower))
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(n, t) for n, t in new.items())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(lower))
            known = (np.diff(offsets) > 0) & (len(model.languages) > 0)
            found, score, rejected = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows), np.ones(batch.num_rows, bool)
            if known.any():
                best, cosine, far = model.nearest(gram_counts(data, offsets))
                found = [model.languages[b] if k else UNKNOWN for b, k in zip(best, known)]
                score, rejected = np.where(known, cosine, 0.0), np.where(known, far, True)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.string()), pa.array(score, pa.float64()),
                                              pa.array(rejected, pa.bool_())], [*keep, *new])

    return plain.mapInArrow(run, schema)


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the model of the query does not learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def keep_identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without the rows that a model learned from its own labelled rows rejects; all columns as they were."""
    model = fit(docs.filter(~held_out(id_col)), id_col, text_col, lang_col)
    names = tuple(unused(docs, name) for name in ("lang_pred", "score", "rejected"))
    return identify(docs, model, text_col, names=names).filter(~F.col(names[2])).select(*docs.columns)
