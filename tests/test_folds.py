"""Running reductions, accumulators, priority lists and row numbers against plain Python, with a hot key,
nulls in any column, ties and empty tables."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.operators.accumulate import Accumulator, accumulate, best_of, longest_gap_of
from tidewater.operators.blocks import BLOCK, numbered
from tidewater.operators.row_index import row_index, sums_before
from tidewater.operators.scan import applied_to_zero, clamped_add, running_reduce, then
from tidewater.plans.fold_jobs import top_by_arrival
from tidewater.sinks.round_robin import dealt, write_round_robin


def skewed(n=900, seed=4):
    draw = random.Random(seed)
    return [(i, None if i % 7 == 0 else 0 if i % 3 == 0 else draw.randrange(1, 30), None if draw.random() < 0.1 else round(draw.uniform(-90, 90), 9))
            for i in range(n)]


SCHEMA = "seq long, k long, v double"


@pytest.mark.parametrize("width", [4, 16, 2048])
def test_clamped_sum_in_blocks_of_any_width(spark, width):
    rows = skewed()
    out = running_reduce(spark.createDataFrame(rows, SCHEMA), ["k"], "seq", clamped_add(F.col("v").cast("decimal(27,9)"), 0, 100), then,
                         applied_to_zero, "b", width=width, chunk_width=50, hot_threshold=100)
    at, want = defaultdict(float), {}
    for seq, k, v in rows:
        at[k] = min(100.0, max(0.0, at[k] + (v or 0.0)))
        want[seq] = at[k]
    got = {r.seq: float(r.b) for r in out.collect()}
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-7 for s in want)
    assert out.columns == ["seq", "k", "v", "b"]


def test_combine_need_not_commute(spark):
    """Texts joined in order."""
    rows = [(i, i % 2, chr(97 + i % 26)) for i in range(60)]
    out = running_reduce(spark.createDataFrame(rows, "seq long, k long, v string"), ["k"], "seq", F.struct(F.col("v").alias("t")),
                         lambda a, b: F.struct(F.concat(a["t"], b["t"]).alias("t")), lambda s: s["t"], "all", width=4)
    for r in out.collect():
        assert r["all"] == "".join(v for s, k, v in rows if k == r.k and s <= r.seq)


def test_a_hot_key_is_cut_in_full_blocks(spark):
    df = spark.createDataFrame(skewed(), SCHEMA)
    per = numbered(df, ["k"], "seq", 16, chunk_width=50, hot_threshold=100).groupBy("k", BLOCK).count().collect()
    assert max(r["count"] for r in per) == 16
    full = [r for r in per if r["k"] == 0]
    assert len(full) == -(-sum(r["count"] for r in full) // 16)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert running_reduce(empty, ["k"], "seq", clamped_add(F.col("v"), 0, 1), then, applied_to_zero, "b").count() == 0
    assert accumulate(empty, ["k"], longest_gap_of("seq"), "g", order="seq").count() == 0
    assert accumulate(empty, ["k"], longest_gap_of("seq"), "g", spread_by=["seq"]).count() == 0
    assert row_index(empty, "seq").count() == 0


@pytest.mark.parametrize("width,fan", [(5, 2), (4096, 64)])
def test_longest_gap(spark, width, fan):
    draw = random.Random(3)
    rows = [(None if draw.random() < 0.05 else draw.choice([0, 0, 0, 1, 2, 3]), None if draw.random() < 0.1 else draw.randrange(3000)) for _ in range(500)]
    rows += [(77, None), (78, 5)]
    out = accumulate(spark.createDataFrame(rows, "k long, us long"), ["k"], longest_gap_of("us"), "g", order="us",
                     width=width, fan=fan, chunk_width=100, hot_threshold=50)
    want = defaultdict(list)
    for k, t in rows:
        want[k].append(t)
    got = {r.k: tuple(r.g) for r in out.collect()}
    assert got.keys() == want.keys()
    for k, ts in want.items():
        known = sorted(t for t in ts if t is not None)
        gaps = [b - a for a, b in zip(known, known[1:])]
        assert got[k] == (known[0] if known else None, known[-1] if known else None, max(gaps, default=None), len(ts))


def test_states_merge_in_order(spark):
    """An accumulator whose merge does not commute."""
    acc = Accumulator("struct<t:string>", lambda: F.struct(F.lit("").alias("t")), lambda s, x: F.struct(F.concat(s["t"], x["v"])),
                      lambda a, b: F.struct(F.concat(a["t"], b["t"])), lambda s: s["t"])
    rows = [(i, i % 3 == 0, chr(97 + i % 26)) for i in range(200)]
    random.Random(1).shuffle(rows)
    out = accumulate(spark.createDataFrame(rows, "seq long, k boolean, v string"), ["k"], acc, "t", order="seq", width=7, fan=3)
    assert {r.k: r.t for r in out.collect()} == {b: "".join(v for _, k, v in sorted(rows) if k == b) for b in (True, False)}


def test_priority_list_of_a_hot_group(spark):
    draw = random.Random(9)
    rows = [(draw.choice(["hot", "hot", "hot", "a", "b"]), draw.randrange(50), i, f"c{i}") for i in range(600)]
    best = best_of(3, "struct<n:bigint,at:bigint,name:string>", lambda a, b: F.struct(-a["n"], a["at"]) < F.struct(-b["n"], b["at"]))
    df = spark.createDataFrame(rows, "g string, n long, at long, name string")
    out = accumulate(df, ["g"], best, "best", spread_by=["name"], width=20, fan=4)
    got = {r.g: [(x.n, x.at) for x in r.best] for r in out.collect()}
    assert got == {g: [(n, at) for n, at in sorted(((n, at) for x, n, at, _ in rows if x == g), key=lambda p: (-p[0], p[1]))][:3] for g in ("hot", "a", "b")}


def test_equal_totals_rank_by_arrival(spark):
    rows = [("t", 5.0, 30, "late"), ("t", 5.0, 10, "early"), ("t", 5.0, 20, "middle"), ("t", 5.0, 40, "last"), ("t", 1.0, 1, "small"),
            ("u", 2.0, None, "x"), ("u", 2.0, 1, "y"), (None, 1.0, 1, "z")]
    out = top_by_arrival(spark.createDataFrame(rows, "date_time string, total_price double, first_sale long, category string"))
    got = defaultdict(list)
    for r in sorted(out.collect(), key=lambda r: (r.date_time or "", r["rank"])):
        got[r.date_time].append(r.category)
    assert got == {"t": ["early", "middle", "late"], "u": ["x", "y"], None: ["z"]}


def test_row_numbers_are_exact(spark):
    ids = random.Random(2).sample(range(-50_000, 10 ** 7), 700)
    df = spark.createDataFrame([(i,) for i in ids] + [(None,), (None,)], "id long").repartition(7)
    got = row_index(df, "id", width=1000, fan=4).collect()
    assert sorted(r.row_index for r in got) == list(range(702))
    known = sorted((r.row_index, r.id) for r in got if r.id is not None)
    assert known == [(i + 2, v) for i, v in enumerate(sorted(ids))]


def test_sums_before_in_levels(spark):
    rows = [(p, p % 5) for p in random.Random(6).sample(range(-3000, 3000), 400)]
    got = {r.p: r.before for r in sums_before(spark.createDataFrame(rows, "p long, n long"), "p", "n", "before", fan=8).collect()}
    at = 0
    for p, n in sorted(rows):
        assert got[p] == at
        at += n


def test_partitions_of_the_round_robin_sink_differ_by_one_row_at_most(spark, tmp_path):
    df = spark.range(1003).select((F.col("id") * 3).alias("id")).repartition(5)
    per = {r["partition"]: r["count"] for r in dealt(df, "id", 4).groupBy("partition").count().collect()}
    assert sorted(per) == [0, 1, 2, 3] and max(per.values()) - min(per.values()) <= 1
    write_round_robin(df, f"{tmp_path}/rr", "id", 4)
    back = spark.read.parquet(f"{tmp_path}/rr").collect()
    assert sorted((r.id, r.partition) for r in back) == [(3 * i, i % 4) for i in range(1003)]


def test_plans_hold_no_python_and_no_one_task_window(spark):
    from tidewater.plans.fold_jobs import QUERIES

    for name, q in QUERIES.items():
        plan = q(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan, name
