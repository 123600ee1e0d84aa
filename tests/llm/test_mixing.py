"""Mixing: targets, caps, determinism."""

from collections import defaultdict

import pytest

from tests.llm.conftest import AWKWARD
from tidewater.llm import mixing


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), 1.5 * sum(sizes.values())
    while open_:
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target.update(share)
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def corpus():
    return [(i, " ".join(["w"] * (1 + (i * 37) % 60)) + (" #*$" if i % 5 == 0 else ""), "en", [None, "b", "a", "c", "é"][i % 5 if i % 7 else 2])
            for i in range(600)]


def test_targets_and_taken(docs_of):
    rows = mixing.mix_report(docs_of(corpus())).collect()
    size, source = {}, {}
    for d, t, _, s in corpus():
        size[d], source[d] = len(t.split()), s
    sums = defaultdict(int)
    for d, s in source.items():
        sums[s] += size[d]
    want = brute_targets(sums)
    taken = defaultdict(int)
    for r in rows:
        s = source[r.doc_id]
        assert r.size == size[r.doc_id] and r.source_size == sums[s]
        assert r.target == pytest.approx(want[s])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[s] += r.taken
    for s in sums:
        assert abs(taken[s] - want[s]) <= 64
        copies = [r.taken // r.size for r in rows if source[r.doc_id] == s]
        assert max(copies) - min(copies) <= 1       # whole epochs come first


def test_mixed_rows_follow_the_report_and_reruns_agree(docs_of):
    docs = docs_of(corpus())
    report = {r.doc_id: r.taken // r.size for r in mixing.mix_report(docs).collect()}
    again = {r.doc_id: r.taken // r.size for r in mixing.mix_report(docs.repartition(7)).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    count = defaultdict(int)
    for r in out.collect():
        count[r.doc_id] += 1
    assert report == again and {d: n for d, n in report.items() if n} == dict(count)


def repeated():
    """Sources whose cut falls into ties: two rows again and again, and null doc_ids with equal sizes."""
    rows = [(i, " ".join(["w"] * (1 + (i * 37) % 60)), "en", "a") for i in range(400)]
    rows += [(None, f"w{k % 90} x y", "en", "b") for k in range(4000)] + [(7 + k % 2, "one two three #*", "en", "c") for k in range(2500)]
    return rows + [(9, "a b c d", "en", None)] * 20


def test_tied_rows_are_cut_row_by_row_as_the_sql_does(spark, docs_of, tables):
    import duckdb

    folder = tables(documents=docs_of(repeated()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/documents.parquet/*.parquet')")
    order = lambda rows: sorted((tuple(r) for r in rows), key=repr)
    want = con.execute(mixing.SQL).fetchall()
    got = [(r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.op7_mix_sources(spark, folder).collect()]
    key = lambda r: (str(r[0]), r[1], r[2], r[4])
    assert sorted(map(key, got)) == sorted(map(key, want))
    values = defaultdict(set)
    for r in want:
        values[r[0], r[1], r[2]].add(r[4])
    assert sum(len(v) > 1 for v in values.values()) >= 2      # the cut does fall into tied rows
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    first, again = (order(mixing.mixed(d).select("doc_id", "text", "source").collect()) for d in (docs, docs.repartition(7)))
    assert first == again and sum(len(r[1].split()) for r in first) == sum(r[4] for r in want)


def test_awkward_rows(docs_of):
    rows = mixing.mix_report(docs_of(AWKWARD)).collect()
    assert len(rows) == len(AWKWARD) and all(r.taken <= 2 * r.size for r in rows)
    empty = docs_of(AWKWARD).where("false")
    assert mixing.mix_report(empty).count() == 0 and mixing.mixed(empty).count() == 0
    blank = docs_of([(1, None), (2, "")])
    assert [(r.size, r.target, r.taken) for r in mixing.mix_report(blank).collect()] == [(0, 0.0, 0)] * 2
