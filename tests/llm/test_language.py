"""Language network: gradients, padding, held-out accuracy, awkward rows."""

import zlib

import numpy as np

from tests.llm.conftest import AWKWARD
from tidewater.llm import language


def test_gradients_by_differences():
    p = {k: v.astype(np.float64) for k, v in language.init(3, 2, np.random.default_rng(5)).items()}
    x = np.random.default_rng(6).integers(1, 4, (5, 4))
    x[3:, 1] = 0
    y = np.array([0, 1, 1, 0])
    _, g = language.gradients(p, x, y)
    for name, at in (("Ecf", (2, 1)), ("Ezb", (1, 0)), ("Urf", (0, 2)), ("Ucb", (1, 1)), ("Uzf", (2, 2)), ("Wb", (0, 1)), ("bias", (0,))):
        e = 1e-2
        q = {k: v.copy() for k, v in p.items()}
        q[name][at] += e
        up = language.gradients(q, x, y)[0]
        q[name][at] -= 2 * e
        down = language.gradients(q, x, y)[0]
        assert abs((up - down) / (2 * e) - g[name][at]) < 2e-3, name


def test_padding_is_neutral():
    p = language.init(4, 3, np.random.default_rng(1))
    text = b"some text of thirty bytes here"
    short = np.frombuffer(text, np.uint8)[:, None].astype(np.intp)
    long = np.zeros((50, 1), np.intp)
    long[:30] = short
    for d in "fb":
        assert np.allclose(language.run_direction(p, d, short), language.run_direction(p, d, long)[:30], atol=1e-6)
    assert abs(language.probabilities(p, [text * 40])[0].sum() - 1) < 1e-6


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    rows = language.op2_language_id(spark, d).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_awkward_rows(docs_of, spark, tables):
    model = language.train([("the house and the", "en"), ("das haus und der", "de")], steps=5)
    rows = language.with_language(docs_of([*AWKWARD, (30, "123 !!")]), model).select("doc_id", "language.*").collect()
    assert len(rows) == len(AWKWARD) + 1
    assert all(r.lang_pred == "und" and r.score == 0 for r in rows if r.doc_id in (1, 2, 3, 30))
    assert all(r.lang_pred in ("en", "de") for r in rows if r.doc_id in (4, 8, 9, 10))
    none = language.op2_language_id(spark, tables(documents=docs_of([(1, "abc", None)]))).collect()
    assert [(r.lang_pred, r.score) for r in none] == [("und", 0.0)]
    assert language.op2_language_id(spark, tables(documents=docs_of(AWKWARD).where("false"))).count() == 0
