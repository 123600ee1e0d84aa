"""The filter audit against plain counting over all orders."""

import itertools
import random
import re
from collections import defaultdict

from tests.llm.conftest import AWKWARD
from tidewater.llm import filter_audit as fa


def brute(rows, labels):
    first = {}
    for r in rows:
        if r[0] is not None:
            first[r[1] or ""] = min(first.get(r[1] or "", r[0]), r[0])
    parts = defaultdict(list)
    for r in rows:
        t = r[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search(r"[#$%&*|]", t)),
                 "E": r[0] is not None and first[t] < r[0]}
        own = [x for x in labels if x[0] is not None and x[0] == r[0]]
        part = r[2] if len(r) > 2 else "en"
        parts[part or ""].append((fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out, total = {}, defaultdict(int)
    for part, docs in parts.items():
        for order in map("".join, itertools.permutations("ABCDE")):
            left = docs
            for i, f in enumerate(order):
                gone = [d for d in left if d[0][f]]
                kept = [d for d in left if not d[0][f]]
                all_failing = sum(d[0][f] for d in docs)
                alone = sum(d[0][f] and sum(d[0].values()) == 1 for d in docs)
                out[part, order, i + 1] = [len(kept), len(gone), all_failing - len(gone), alone, sum(d[1] for d in gone), sum(d[2] for d in gone)]
                total[part, f] += len(gone)
                left = kept
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def result(df):
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in df.collect()}
    assert len(got) == df.count()
    return got


def test_awkward_rows(spark, docs_of):
    prose = " ".join(f"w{i}" for i in range(120))
    rows = [*AWKWARD, (20, prose), (21, prose), (21, prose), (None, prose), (22, prose + " #"), (23, prose.upper(), None), (24, "", "fr"), (25, None, ""),
            (26, "same " * 200, "fr"), (27, "É" * 9 + "A", "fr"), (28, "é" * 10 + "A", "fr")]
    labels = [(20, 1, 0), (20, 0, 1), (21, 1, None), (22, None, 1), (None, 1, 1), (99, 1, 1), (23, 0, 1), (1, 1, 1)]
    df = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = result(fa.interactions(fa.mask_counts(fa.failures(docs_of(rows)), df)))
    assert got == brute(rows, labels)
    assert len(got) == 600 * len({r[2] or "" if len(r) > 2 else "en" for r in rows})


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert fa.interactions(fa.mask_counts(fa.failures(docs_of(AWKWARD).where("false")), none)).count() == 0
    got = result(fa.interactions(fa.mask_counts(fa.failures(docs_of(AWKWARD)), none)))
    assert got == brute(AWKWARD, [])


def test_swaps_visit_every_order_once():
    for n in range(1, 7):
        order, seen = list(range(n)), set()
        seen.add(tuple(order))
        for i in fa.plain_changes(n):
            order[i], order[i + 1] = order[i + 1], order[i]
            assert tuple(order) not in seen
            seen.add(tuple(order))
        assert seen == set(itertools.permutations(range(n)))


def test_swaps_keep_the_diagram_reduced_and_its_weights():
    draw = random.Random(5)
    for n in (1, 2, 4, 6):
        weights = {m: (draw.randrange(3), draw.randrange(2)) for m in range(1 << n) if not m or draw.random() < 0.6}
        d = fa.Diagram(n, weights)
        for _ in range(40):
            if n > 1:
                d.swap(draw.randrange(n - 1))
            for level, known in enumerate(d.levels[:-1]):
                assert all(d.child[u] == key for key, u in known.items())
            failed = 0
            for f, kept, removed in d.all_pass():
                assert kept == tuple(sum(w[i] for m, w in weights.items() if not m & (failed | 1 << f)) for i in (0, 1))
                assert removed == tuple(sum(w[i] for m, w in weights.items() if not m & failed and m >> f & 1) for i in (0, 1))
                failed |= 1 << f
            fresh = fa.Diagram(n, {sum(1 << i for i, f in enumerate(d.order) if m >> f & 1): w for m, w in weights.items()})
            assert [len(x) for x in d.levels] == [len(x) for x in fresh.levels]


def test_query_holds_labels_with_clashing_columns(spark, docs_of, tables):
    from pyspark.sql import functions as F

    labels = spark.createDataFrame([(4, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int").withColumn("part", F.lit("x")).withColumn("n", F.lit(7))
    docs = docs_of(AWKWARD).withColumn("part", F.lit(1)).withColumn("mask", F.lit("m")).withColumn("digest", F.lit(0.5))
    got = result(fa.op11_filter_audit(spark, tables(documents=docs, labels=labels)))
    assert got == brute(AWKWARD, [(4, 1, 1), (5, 1, 0)])
