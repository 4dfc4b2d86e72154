"""What Python workers hold during and after the stages of the pipeline."""

import gc
import random
import sys
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from gablework.llm import language, near_dedup, sentencepiece_codec
from gablework.llm.byte_hashes import Rolling, text_bytes, word_hashes
from gablework.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def model_file():
    return tokenizer_file("piece_bpe_32k.model")


def texts_of(n, size, seed=3):
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdeé    z") for _ in range(size)).strip() or "a" for _ in range(n)]


def most_mb(run):
    tracemalloc.start()
    try:
        run()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_codec_leaves_the_worker_with_its_stage(spark, model_file):
    def codecs(batches):
        gc.collect()
        for batch in batches:
            held = sum(type(x).__name__ == "Codec" for x in gc.get_objects())
            yield pa.RecordBatch.from_arrays([pa.array([held] * batch.num_rows, pa.int64())], ["held"])

    many = spark.sparkContext.defaultParallelism
    docs = spark.range(0, 20 * many, 1, many).selectExpr("id", "concat('some words ', id) AS text")
    assert sentencepiece_codec.encoded_digests(docs, model_file).agg({"n_tokens": "min"}).first()[0] > 1
    assert spark.range(0, many, 1, many).mapInArrow(codecs, "held long").agg({"held": "sum"}).first()[0] == 0


def test_remembered_pairs_are_bounded(monkeypatch, model_file):
    tables = sentencepiece_codec.read_model(model_file)
    texts = ["preparation of remarkable neighbourhoods", "Zwölf Boxkämpfer jagen", "xqzvw kkjjq zzzq", "preparation again"] * 2
    free = sentencepiece_codec.Codec(tables)
    wanted = [free.encode(t) for t in texts]
    monkeypatch.setattr(sentencepiece_codec, "FIT_PAIRS", 4)
    bounded = sentencepiece_codec.Codec(tables)
    assert len(free.fits) > 8
    assert [bounded.encode(t) for t in texts] == wanted
    assert max(len(bounded.fits), len(bounded.older_fits)) <= 4


def test_hashing_words_takes_little_memory():
    data, offsets = text_bytes(pa.array(texts_of(256, 4000)))
    sys.modules.pop("_gablework_worker", None)  # as in a new worker
    assert most_mb(lambda: near_dedup.shingles(data, offsets)) < 36
    once = word_hashes(data, offsets, Rolling(2 << 20, 21), 1 << 20)
    parts = word_hashes(data, offsets, Rolling(2 * near_dedup.PIECE, 21), near_dedup.PIECE)
    assert all(np.array_equal(a, b) for a, b in zip(once, parts))


def test_counting_grams_takes_little_memory():
    texts = ["", "a", *texts_of(253, 4000), "x" * 300_000]
    data, offsets = text_bytes(pa.array(texts))
    assert most_mb(lambda: language.gram_counts(data, offsets)) < 24
    found = language.gram_counts(data, offsets)
    assert found.dtype == np.float32
    alone = [language.gram_counts(*text_bytes(pa.array([t]))) for t in texts[:20]]
    assert np.array_equal(found[:20], np.concatenate(alone))
