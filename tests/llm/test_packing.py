"""Packing: the plan holds every piece once, ids equal the tokenizer's, sequences are gapless."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import AWKWARD
from tidewater.llm import packing


@pytest.mark.parametrize("n", [1, 7, 400, 10 ** 9])
def test_plan_holds_every_piece(n):
    rng = np.random.default_rng(n)
    p = np.exp(-((np.arange(1, 65) - 25) / 20.0) ** 2)
    histogram = {i + 1: int(k) for i, k in enumerate(rng.multinomial(n, p / p.sum())) if k}
    got = defaultdict(int)
    plan = packing.plan(histogram, 64)
    for pattern, times in plan:
        assert times > 0 and sum(c * k for c, k in pattern.items()) <= 64
        for c, k in pattern.items():
            got[c] += k * times
    assert got == histogram
    used, need = sum(t for _, t in plan), sum(c * k for c, k in histogram.items()) / 64
    assert used <= 1.002 * need + 64


def test_knapsack_by_brute_force():
    value, weight = np.array([0.3, 0.45, 0.8]), np.array([3, 4, 7])
    best = max(a * 0.3 + b * 0.45 + c * 0.8 for a in range(8) for b in range(6) for c in range(4) if 3 * a + 4 * b + 7 * c <= 21)
    got, copies = packing.knapsack(value, weight, 21)
    assert got == pytest.approx(best) and copies @ value == pytest.approx(best) and copies @ weight <= 21


def test_inverse():
    a = np.random.default_rng(0).normal(size=(30, 30))
    assert np.allclose(packing.inverted(a) @ a, np.eye(30), atol=1e-8)


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(packing.tokenizer_file())
    t.encode_special_tokens = True
    return t


def check(rows, texts):
    t = tokenizer()
    ids = sorted([*t.encode(x or "", add_special_tokens=False).ids, 1] for _, x in texts)
    want = sorted((len(i), s, zlib.crc32(np.asarray(i[s:s + 2048], "<u4").tobytes())) for i in ids for s in range(0, len(i), 2048))
    assert sorted((r.doc_tokens, r.start, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048


def test_pieces_and_sequences(spark):
    d = "/root/testdata/sf0.001"
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{d}/documents.parquet").collect()]
    rows = packing.op8_pack(spark, d).collect()
    check(rows, texts)
    assert sum(r.length for r in rows) >= 0.95 * 2048 * len({r.sequence_id for r in rows})


def test_encoder_equals_the_tokenizer_on_odd_texts():
    t, encode = tokenizer(), packing.encoder(packing.tokenizer_file())
    for s in ("", " ", "it's  <|endoftext|> 12!", "é世\U0001f642\x00\t\r\n  x", "a" * 5000, " " * 5000, "퟿￿"):
        assert encode(s) == t.encode(s, add_special_tokens=False).ids


def test_awkward_rows(docs_of):
    rows = packing.packed(docs_of(AWKWARD)).collect()
    check(rows, [(d, t) for d, t, *_ in AWKWARD])
    assert packing.packed(docs_of(AWKWARD).where("false")).count() == 0
    with_ids = packing.packed(docs_of([(1, "hello world")]), with_ids=True).collect()
    assert np.frombuffer(with_ids[0].ids, "<u4").tolist() == [*tokenizer().encode("hello world").ids, 1]


def test_a_repeated_row_is_spread_over_ranges(docs_of, monkeypatch):
    """A row that makes up most of the table is placed like any other: its copies lie in many hash ranges."""
    rows = [(7, "the same row")] * 900 + [(i, f"text {i}") for i in range(100)]
    seen = []
    plain = packing.placed
    monkeypatch.setattr(packing, "placed", lambda cut, *a: seen.append(cut) or plain(cut, *a))
    out = packing.packed(docs_of(rows)).collect()
    check(out, rows)
    places = seen[0].where("doc_id = 7").selectExpr("pmod(xxhash64(doc_id, start, ids_crc32, _pk_place), 31) AS r").groupBy("r").count().collect()
    assert len(places) > 20 and max(p["count"] for p in places) < 90


def test_block_encoder_gives_the_ids_of_each_text():
    import random

    path, rng = packing.tokenizer_file(), random.Random(3)
    one, block = packing.encoder(path), packing.block_encoder(path)
    parts = [" ", "  ", "\n", "\t", "\r\n", " ", " ", "　", "\u0085", "\x1c", "a", " the", "Bc", "é", "12", "'s", "'", "!?", "…", "​", "\U0001f600",
             "中文", "\x00", "\x7f", "<|endoftext|>"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(25))) for _ in range(4000)] + [None, "", " x" * 5000, "y" * 300, None]
    for some in (texts, texts[::-1], [], ["", None]):         # the second time most stretches are known
        ids, lens = block(pa.array(some, pa.string()))
        want = [one(t or "") for t in some]
        assert lens.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    ids, at = packing.ended(np.array([5, 6, 7], np.uint32), np.array([0, 2, 0, 1, 0]), 1)
    assert ids.tolist() == [1, 5, 6, 1, 1, 7, 1, 1] and at.tolist() == [0, 1, 4, 5, 7, 8]


def test_stretches_that_recur_are_encoded_once(monkeypatch):
    """In texts of few distinct words nearly nothing is left to encode; a full store and long stretches change no id."""
    monkeypatch.setattr(packing, "KEPT", 50)
    path, seen = packing.tokenizer_file(), []
    fast, sizes = packing._fast(path)

    class Counted:
        def encode_to_numpy(self, text, **how):
            seen.append(len(text))
            return fast.encode_to_numpy(text, **how)

        encode_ordinary = staticmethod(fast.encode_ordinary)

    monkeypatch.setattr(packing, "_fast", lambda path: (Counted(), sizes))
    block = packing.block_encoder(path)
    texts = [" ".join(f"word{(i * k) % 40}" for k in range(200)) for i in range(50)]
    for some in (texts, texts, [" ".join(f"other{i}" for i in range(3000)), "z" * 1000 + " " + "q" * 1000]):
        ids, _ = block(pa.array(some))
        assert ids.tolist() == [i for t in some for i in fast.encode_ordinary(t)]
    assert seen[0] <= 40 * len(" word40") and seen[1] == 0
