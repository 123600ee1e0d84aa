"""Exact dedup against brute force on awkward rows."""

import hashlib
from collections import defaultdict

from tests.llm.conftest import AWKWARD
from tidewater.llm import exact_dedup


def test_report(docs_of):
    rows = exact_dedup.copy_report(docs_of(AWKWARD)).collect()
    groups = defaultdict(list)
    for d, *rest in AWKWARD:
        groups[rest[0] or ""].append(d)
    assert len(rows) == len(AWKWARD)
    kept = defaultdict(list)
    for r in rows:
        text = next(t for t in groups if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        ids = groups[text]
        assert r.doc_id in ids and r.group_size == len(ids)
        assert r.keep_id == max((d for d in ids if d is not None), default=None)
        if r.kept:
            kept[text].append(r.doc_id)
    assert {t: v for t, v in kept.items()} == {t: [max((d for d in v if d is not None), default=None)] for t, v in groups.items()}


def test_refinement_separates_equal_lengths_and_prefixes(docs_of):
    same = "p" * 300
    docs = docs_of([(1, same + "a"), (2, same + "b"), (3, same + "a"), (4, "q" * 301), (5, "zz")])
    rows = {r.doc_id: r for r in exact_dedup.copy_report(docs, digest_all=False).collect()}
    assert {d: (r.keep_id, r.group_size, r.kept) for d, r in rows.items()} == {
        1: (3, 2, False), 2: (2, 1, True), 3: (3, 2, True), 4: (4, 1, True), 5: (5, 1, True)}
    assert rows[5].text_sha256 is None and rows[2].text_sha256 is not None


def test_dropping_keeps_all_columns_and_one_row_of_a_group(docs_of):
    docs = docs_of(AWKWARD)
    out = exact_dedup.drop_copies(docs)
    assert out.columns == docs.columns
    got = sorted((r.text or "", -1 if r.doc_id is None else r.doc_id) for r in out.collect())
    want = defaultdict(lambda: -1)
    for d, t, *_ in AWKWARD:
        want[t or ""] = max(want[t or ""], -1 if d is None else d)
    assert got == sorted(want.items())


def test_empty_table(docs_of):
    empty = docs_of(AWKWARD).where("false")
    assert exact_dedup.copy_report(empty).count() == 0 and exact_dedup.drop_copies(empty).count() == 0


def test_maps_and_clashing_names_are_carried(docs_of):
    from pyspark.sql import functions as F

    docs = docs_of(AWKWARD).withColumn("m", F.create_map(F.lit("k"), F.col("doc_id")))
    for name in ("_xd_len", "_xd_prefix", "_xd_sha", "row", "a.b"):
        docs = docs.withColumn(name, F.lit(name))
    out = exact_dedup.drop_copies(docs)
    rows = out.collect()
    assert out.columns == docs.columns and len(rows) == len({t or "" for _, t, *_ in AWKWARD})
    assert all(r["_xd_len"] == "_xd_len" and r["a.b"] == "a.b" and r["m"] == {"k": r["doc_id"]} for r in rows)
