"""The pipeline's stages one by one against brute force."""

from collections import Counter

import corpus_pipeline
from tests.llm.test_near_dedup import classes_by_brute_force
from tests.llm.test_packing import check
from tidewater.llm import mixing, quality_model
from tidewater.llm.common import saved

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    (_, quality), (_, exact), (_, near), (_, mix), (_, pack) = corpus_pipeline.STAGES

    model = quality_model.learn(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = [r for r in docs.collect() if model.score(quality_model.features([r.text]))[0] >= 0.7]
    got = saved(quality(spark, docs, SF), "t1")
    assert got.columns == names and Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in want)

    best = {}
    for r in want:
        best[r.text] = max(best.get(r.text, -1), r.doc_id)
    got = saved(exact(spark, got, SF), "t2")
    rows = got.collect()
    assert got.columns == names and Counter(r.doc_id for r in rows) == Counter(best.values())

    kept = {min(rows[i].doc_id for i in g) for g in classes_by_brute_force([(r.doc_id, r.text) for r in rows])}
    got = saved(near(spark, got, SF), "t3")
    assert got.columns == names and Counter(r.doc_id for r in got.collect()) == Counter(kept)

    report = {r.doc_id: r.taken // r.size for r in mixing.mix_report(got).collect() if r.size}
    got = saved(mix(spark, got, SF), "t4")
    rows = got.collect()
    assert got.columns == names and Counter(r.doc_id for r in rows) == Counter({d: n for d, n in report.items() if n})

    check(pack(spark, got, SF).collect(), [(r.doc_id, r.text) for r in rows])


def test_run_reads_the_table(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0 and corpus_pipeline.ORACLE_SQL is None


def test_awkward_and_empty_tables(spark, docs_of, tables):
    """Null, empty, repeated and very long texts, null ids and sources, no labels, extra columns; then no rows at all."""
    from tests.llm.conftest import AWKWARD

    labels = spark.createDataFrame([(None, 1, 0), (4, None, None)], "doc_id long, quality int, toxic int")
    docs = docs_of(AWKWARD)
    out = corpus_pipeline.run(spark, tables(documents=docs, labels=labels)).collect()
    starts = Counter((r.doc_id, r.start) for r in out)
    assert out and {d for d, _ in starts} <= {d for d, *_ in AWKWARD}
    assert not any(d in (4, 6) for d, _ in starts)               # copies of 5 and 7: the larger id of equal texts stays
    empty = corpus_pipeline.run(spark, tables(documents=docs.where("false"), labels=labels))
    assert empty.count() == 0 and set(empty.columns) == set(r for r in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))
