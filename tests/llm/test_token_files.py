"""Token files against the tokenizers library, and random access against plain arrays."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import AWKWARD
from tidewater.llm import token_files as tf
from tidewater.session import scratch_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tf.tokenizer_file())
    t.encode_special_tokens = True
    return t


def wanted(tokenizer, rows):
    """Rows by doc_id (null first); texts of one doc_id in any order."""
    return sorted(((-1 if d is None else d, tokenizer.encode(t or "", add_special_tokens=False).ids + [tf.END_ID]) for d, t, *_ in rows),
                  key=lambda x: x[0])


def held(rows, want):
    """Starts are gapless from 0 in the order of doc_id, and every document has its ids."""
    rows = sorted(rows, key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    assert [-1 if r.doc_id is None else r.doc_id for r in rows] == [d for d, _ in want]
    crc = lambda ids: zlib.crc32(np.asarray(ids, "<u4").tobytes())
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == sorted((d, len(i), crc(i)) for d, i in want)


ROWS = [*AWKWARD, (30, "a <|endoftext|> b"), (31, "\U0001f600 déjà​ vu\r\n\r\n"), (5, "other text of five"), (None, None)]


def test_read_back(spark, docs_of, tables, tokenizer):
    docs = docs_of(ROWS).withColumn("shard", F.lit("x")).withColumn("_hash", F.lit(1)).withColumn("_place", F.lit("y"))
    held(tf.op13_token_files(spark, tables(documents=docs)).collect(), wanted(tokenizer, ROWS))


def test_small_segments_hold_whole_documents(spark, docs_of, tokenizer):
    path = scratch_path(spark, "segments")
    tf.write_tokens(docs_of(ROWS), path, segment=50)
    got = tf.read_documents(spark, path, with_ids=True).collect()
    held(got, wanted(tokenizer, ROWS))
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.n_tokens for r in got)
    assert max(r.n_docs for r in tf.read_segments(spark, path).collect() if r.n_ids > 50) == 1


def test_repeated_row_is_cut_among_files(spark, docs_of):
    path = scratch_path(spark, "segments")
    docs = docs_of([(7, "the same row")]).crossJoin(spark.range(3000)).drop("id")
    tf.write_tokens(docs, path)
    per = [r["n"] for r in tf.read_segments(spark, path).groupBy("shard").agg(F.sum("n_docs").alias("n")).collect()]
    assert sum(per) == 3000 and max(per) < 1500
    starts = sorted(r.start for r in tf.read_documents(spark, path).collect())
    assert starts == [4 * i for i in range(3000)]


def test_empty_table(spark, docs_of, tables):
    assert tf.op13_token_files(spark, tables(documents=docs_of(ROWS).where("false"))).count() == 0
    path = scratch_path(spark, "segments")
    tf.write_tokens(docs_of(ROWS).where("false"), path)
    assert [r.token for r in tf.tokens_at(spark, path, spark.createDataFrame([(0,)], "position long")).collect()] == [None]


def test_positions_of_the_corpus(spark, docs_of, tokenizer):
    path = scratch_path(spark, "segments")
    rows = [r for r in ROWS if r[0] not in (5, None)]
    tf.write_tokens(docs_of(rows), path, segment=64)
    ids = [i for _, own in wanted(tokenizer, rows) for i in own]
    places = [*range(0, len(ids), 7), 0, 0, len(ids) - 1, len(ids), -1, None]
    got = tf.tokens_at(spark, path, spark.createDataFrame([(p,) for p in places], "position long"), span=100).collect()
    assert len(got) == len(places)
    assert all(r.token == (ids[r.position] if r.position is not None and 0 <= r.position < len(ids) else None) for r in got)


@pytest.mark.parametrize("top", [1, 200, 256, 50_257, 1 << 24, (1 << 32) - 1])
def test_any_id_is_read_without_the_others(top):
    draw = random.Random(top)
    for n in (1, 7, 511, 512, 513, 5000):
        ids = np.array([draw.choice([0, draw.randrange(top), top]) for _ in range(n)], np.uint32)
        lens = [n // 3, 0, n - n // 3]
        s = tf.Segment(tf.encoded(ids, [4, None, -5], lens))
        assert (s.n_ids, s.n_docs, len(s.levels)) == (n, 3, max(1, -(-int(ids.max()).bit_length() // 8)))
        for i in [0, n - 1, *(draw.randrange(n) for _ in range(60))]:
            assert s.token(i) == ids[i]
        for _ in range(30):
            lo = draw.randrange(n + 1)
            hi = draw.randrange(lo, n + 1)
            assert (s.tokens(lo, hi) == ids[lo:hi]).all()
        assert [list(s.document(k)) for k in range(3)] == [list(ids[:n // 3]), [], list(ids[n // 3:])]
        assert list(s.doc_id[[0, 2]]) == [4, -5] and list(s.doc_null) == [0, 1, 0]
        with pytest.raises(IndexError):
            s.token(n)


def test_a_document_without_ids_and_a_foreign_file():
    s = tf.Segment(tf.encoded(np.zeros(0, np.uint32), [1], [0]))
    assert s.n_ids == 0 and len(s.document(0)) == 0
    with pytest.raises(ValueError):
        tf.Segment(b"PAR1" + bytes(64))
