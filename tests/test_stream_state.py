"""State, positions and failures of streams: carries, day timers, unions of live sources, polls, counters, keyed tables."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tidewater.functions.money import exact_money
from tidewater.plans.registry import QUERIES
from tidewater.session import scratch_path
from tidewater.sinks.keyed_table import KeyedTable
from tidewater.sources.polled import poll_stream
from tidewater.streaming import carry as cy
from tidewater.streaming import jobs
from tidewater.streaming.counter import StreamCounter
from tidewater.streaming.feed import SliceFeed, run_available_now

from conftest import SF_SMALL


def events(n=600, seed=5):
    draw = random.Random(seed)
    return [(i, None if draw.random() < 0.1 else 0 if i % 3 == 0 else draw.randrange(1, 9), None if draw.random() < 0.2 else round(draw.uniform(0, 9), 3))
            for i in range(n)]


def run_steps(spark, how, rows, pieces, repeat=()):
    """The outputs of all micro-batches; those in ``repeat`` run twice, as after a failure."""
    step, kind = how
    out = scratch_path(spark, "steps_out")
    job = cy.CarryJob(cy.CarryTable(scratch_path(spark, "steps_carry"), ["k"], kind), "k long", out, step)
    size = -(-len(rows) // pieces)
    for e in range(pieces):
        batch = spark.createDataFrame(rows[e * size:(e + 1) * size], "seq long, k long, v double")
        for _ in range(2 if e in repeat else 1):
            job(batch, e)
    return spark.read.parquet(f"{out}/*").collect(), job.table


@pytest.mark.parametrize("hot", [None, 20])
def test_maxima_and_changelog_over_many_batches(spark, monkeypatch, hot):
    monkeypatch.setattr(cy, "BASE_EVERY", 3)
    rows = events()
    got, table = run_steps(spark, cy.running_max_step("k", "seq", "v", width=16, hot=hot or 1 << 20), rows, 8, repeat=(2, 3, 7))
    best, want = {}, {}
    for seq, k, v in rows:
        best[k] = max((x for x in (best.get(k), v) if x is not None), default=None)
        want[seq] = best[k]
    assert {r.seq: r.max_value for r in got} == want and len(got) == len(rows)
    assert {r.k: r.carry.best for r in table.before(spark, 8, "k long").collect()} == best

    got, _ = run_steps(spark, cy.changelog_step("k", "seq", width=16, hot=hot or 1 << 20), rows, 5, repeat=(0, 4))
    count, expect = Counter(), Counter()
    for seq, k, _ in rows:
        if count[k]:
            expect[seq, 0, False, k, count[k]] += 1
        count[k] += 1
        expect[seq, 1, True, k, count[k]] += 1
    assert Counter((r.seq, r.change_seq, r.op, r.k, r.frequency) for r in got) == expect


@pytest.mark.parametrize("size,slide", [(5, 5), (5, 3), (2, 7), (1, 1), (4, 1)])
def test_count_windows_over_many_batches(spark, monkeypatch, size, slide):
    monkeypatch.setattr(cy, "BASE_EVERY", 2)
    rows = events(150)
    got, _ = run_steps(spark, cy.count_window_step("k", "seq", "v", size, slide, exact_money, width=16, hot=20), rows, 5, repeat=(1, 2))
    seen, want = defaultdict(list), {}
    for seq, k, v in rows:
        seen[k].append((seq, v))
        n = len(seen[k])
        if n % slide == 0:
            last = [x for _, x in seen[k][-size:]]
            known = [x for x in last if x is not None]
            want[k, n // slide] = (len(last), round(sum(known), 6) if known else None, seq)
    assert {(r.k, r.window_index): (r.event_count, None if r.sum_value is None else round(r.sum_value, 6), r.last_seq) for r in got} == want
    assert len(got) == len(want)


def test_carries_touch_the_keys_of_the_batch_only(spark):
    rows = [(i, i // 10, 1.0) for i in range(40)]
    _, table = run_steps(spark, cy.running_max_step("k", "seq", "v"), rows, 4)
    assert [spark.read.parquet(f"{table.path}/{e:09d}").count() for e in range(4)] == [1, 1, 1, 1]


def test_keyed_streams_start_no_python_worker(spark):
    for name in ("running_max_stream", "count_tumbling_stream", "count_sliding_stream", "retract_changelog_stream"):
        import inspect

        assert "InPandas" not in inspect.getsource(getattr(jobs, name))
    assert "pandas" not in open(cy.__file__).read()


def last_progress(spark, monkeypatch, query):
    """Run a streaming query; the progress of its micro-batches."""
    from tidewater.streaming import feed

    found, plain = [], feed.drain_together

    def drained(feeds, builder, checkpoint, behind=0):
        class Watched:
            def start(self):
                found.append(self.query.start())
                return found[-1]
        w = Watched()
        w.query = builder.option("checkpointLocation", checkpoint)
        builder_like = type("B", (), {"option": lambda self, *a: w})()
        return plain(feeds, builder_like, checkpoint, behind)

    monkeypatch.setattr(feed, "drain_together", drained)
    rows = QUERIES[query](spark, SF_SMALL).count()
    return rows, found[0].recentProgress


@pytest.mark.parametrize("query", ["running_day_total_stream", "dashboard_two_stage_stream"])
def test_state_of_closed_days_is_cleared(spark, monkeypatch, query):
    rows, progress = last_progress(spark, monkeypatch, query)
    kept = [[s.numRowsTotal for s in p.stateOperators] for p in progress]
    assert rows > 0 and len(kept[-1]) == (2 if "two_stage" in query else 1)
    assert kept[-1] == [0] * len(kept[-1])                       # the closing row has moved the watermark past every day
    assert max(map(max, kept)) <= 5 + 24                          # five categories, a day of ticks at most


def test_a_union_waits_for_its_slower_source(spark):
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    counted = lambda df: df.agg(F.sum("event_count")).first()[0]
    assert counted(jobs.union_live(spark, SF_SMALL, "min", behind=2)) == total
    assert counted(jobs.union_live(spark, SF_SMALL, "max", behind=2)) < total


def test_an_empty_table_ends_a_stream_without_rows(spark, tmp_path):
    spark.read.parquet(f"{SF_SMALL}/events.parquet").where("false").write.parquet(f"{tmp_path}/events.parquet")
    for name in ("running_max_stream", "count_sliding_stream", "retract_changelog_stream", "running_day_total_stream", "late_refires_stream",
                 "observed_count_stream", "changelog_table"):
        out = QUERIES[name](spark, str(tmp_path))
        assert out.agg(F.sum("processed")).first()[0] == 0 if name == "observed_count_stream" else out.count() == 0


class Crash(Exception):
    pass


def test_polls_are_repeated_only_if_they_had_not_finished(spark):
    table = spark.range(50).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v")).unionAll(spark.sql("SELECT CAST(NULL AS BIGINT), 7L"))
    out, checkpoint, crash = scratch_path(spark, "polls"), scratch_path(spark, "polls_ckpt"), {1}

    def write(batch, epoch):
        batch.write.mode("overwrite").parquet(f"{out}/{epoch}")
        if epoch in crash:
            crash.remove(epoch)
            raise Crash("after its output was written, before it was committed")

    for due, fails in ((1, False), (3, True), (3, False), (4, False)):
        q = poll_stream(spark, table, "key", 3, due=due).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).start()
        try:
            q.processAllAvailable()
            assert not fails
        except Exception:
            assert fails
        finally:
            q.stop()
    got = Counter((r.poll_id, r.key, r.v) for r in spark.read.parquet(f"{out}/*").collect())
    assert got == Counter((p, r.key, r.v) for p in range(4) for r in table.collect())


def test_counter_counts_a_repeated_batch_once(spark, tmp_path):
    src, checkpoint, crash = f"{tmp_path}/src", f"{tmp_path}/ckpt", {1}
    counter = StreamCounter(spark, f"{tmp_path}/counts")
    spark.range(30).write.parquet(f"{src}/a")
    stream = spark.readStream.schema("id long").parquet(f"{src}/*")

    def write(batch, epoch):
        batch.count()
        if epoch in crash:
            crash.remove(epoch)
            raise Crash

    query = counter.on(stream).writeStream.foreachBatch(write)
    counter.store(run_available_now(query, checkpoint))
    spark.range(12).write.parquet(f"{src}/b")
    with pytest.raises(Exception):
        run_available_now(query, checkpoint)
    counter.store(run_available_now(query, checkpoint))
    counter.store(run_available_now(query, checkpoint))         # nothing new
    assert counter.total().first().processed == 42


def keyed(spark, buckets=4):
    return KeyedTable(spark, scratch_path(spark, "keyed"), "k", "string", "v", "long", buckets)


def test_keyed_table_against_a_dict(spark):
    draw, table, want = random.Random(3), keyed(spark), {}
    for epoch in range(9):
        rows = []
        for i in range(draw.randrange(1, 30)):
            k, live, v = draw.choice(["a", "b", "c", "d", "e", "f", None]), draw.random() < 0.7, draw.choice([None, 1, 2, 3])
            rows.append((k, live, v, i))
            want.pop(k, None)
            if live:
                want[k] = v
        batch = spark.createDataFrame(rows, "k string, op boolean, v long, i long")
        for _ in range(2 if epoch % 3 == 0 else 1):             # a retried micro-batch
            table.write_batch(batch, epoch, order=["i"], op="op")
        if epoch in (2, 5, 6):
            table.compact()
        assert {r.k: r.v for r in table.current().collect()} == want


def test_reading_after_a_compaction_does_not_depend_on_the_epochs(spark):
    files = []
    for epochs in (2, 6):
        table = keyed(spark)
        for e in range(epochs):
            table.write_batch(spark.range(40).select(F.col("id").cast("string").alias("k"), F.lit(e).cast("long").alias("v")), e)
        before = len(table.current().inputFiles())
        table.compact()
        files.append(len(table.current().inputFiles()))
        assert before > files[-1] and {r.v for r in table.current().collect()} == {epochs - 1}
    assert files[0] == files[1]


@pytest.mark.parametrize("at", ["_mark", "vacuum", "second bucket"])
def test_a_crash_during_compaction_loses_nothing(spark, monkeypatch, at):
    table = keyed(spark)
    for e in range(3):
        table.write_batch(spark.range(30).select((F.col("id") + 10 * e).cast("string").alias("k"), F.lit(e).cast("long").alias("v")), e)
    want = Counter(map(tuple, table.current().collect()))
    plain, calls = getattr(KeyedTable, at, KeyedTable.compact_bucket), []

    def broken(self, *a):
        calls.append(a)
        if at != "second bucket" or len(calls) == 2:
            raise Crash
        return plain(self, *a)

    monkeypatch.setattr(KeyedTable, "compact_bucket" if at == "second bucket" else at, broken)
    with pytest.raises(Crash):
        table.compact()
    assert Counter(map(tuple, table.current().collect())) == want
    monkeypatch.undo()
    table.write_batch(spark.createDataFrame([("new", 9)], "k string, v long"), 3)
    table.compact()
    assert Counter(map(tuple, table.current().collect())) == want + Counter({("new", 9): 1})
    assert table.epochs() == [] and len(table.folded()) == 4


def test_slices_land_in_one_step_and_rows_without_an_order_first(spark):
    rows = [(None, 1), (5, 2), (9, 3), (12, 4), (None, 5)]
    feed = SliceFeed(spark.createDataFrame(rows, "o long, v long"), "o", 2, scratch_path(spark, "feed"))
    seen = []
    while feed.land():
        seen.append(Counter(r.v for r in spark.read.parquet(f"{feed.path}/in/*").collect()))
    assert seen == [Counter([1, 2, 5]), Counter([1, 2, 3, 4, 5])]
