"""Work per micro-batch of the keyed event-time streams: state rows per bucket of users, state partitions by rows; same rows as before."""

import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewater.plans.check import compare, duck_connection
from tidewater.plans.registry import ORACLE, QUERIES
from tidewater.streaming import feed
from tidewater.streaming.processors import LateWindowProcessor

USERS = 400


@pytest.fixture(scope="module")
def many_users(spark, tmp_path_factory):
    """Few events for each of many users; some without a user or a value; late ones in every slice."""
    draw = random.Random(4)
    rows = [(i, 60.0 * i - draw.choice([0, 0, 0, 900, 2500, 9000]), None if i % 50 == 0 else draw.randrange(USERS),
             draw.choice(["view", "click"]), None if i % 9 == 0 else round(draw.uniform(0, 9), 3), "{}") for i in range(3000)]
    folder = tmp_path_factory.mktemp("users")
    ev = spark.createDataFrame(rows, "event_id long, secs double, user_id long, event_type string, value double, props string")
    ev = ev.withColumn("ts", F.expr("timestamp_ntz '2024-01-01 06:00:00' + make_dt_interval(0, 0, 0, secs)")).drop("secs")
    ev.coalesce(2).write.parquet(f"{folder}/events.parquet")
    return str(folder)


def progress_of(spark, monkeypatch, name, sf_dir):
    """Run a streaming query; its result and the progress of its micro-batches."""
    started, plain = [], feed.drain_together

    class Watched:
        def __init__(self, builder):
            self.builder = builder

        def option(self, *a):
            return Watched(self.builder.option(*a))

        def start(self):
            started.append(self.builder.start())
            return started[-1]

    monkeypatch.setattr(feed, "drain_together", lambda feeds, builder, *a: plain(feeds, Watched(builder), *a))
    out = QUERIES[name](spark, sf_dir)
    monkeypatch.undo()
    return out, started[0].recentProgress


@pytest.mark.parametrize("name", ["late_refires_stream", "late_side_output_stream"])
def test_late_streams_keep_a_state_row_per_bucket_of_users(spark, many_users, monkeypatch, name):
    con = duck_connection("/root/testdata/sf0.001")
    con.execute(f"CREATE OR REPLACE VIEW events AS SELECT * FROM read_parquet('{many_users}/events.parquet/*.parquet')")
    seen = []

    def run(session, sf_dir):
        out, progress = progress_of(session, monkeypatch, name, sf_dir)
        seen.extend(s.numRowsTotal for p in progress for s in p.stateOperators)
        return out

    res = compare(spark, many_users, name, run, ORACLE[name], con)
    assert res["status"] == "match" and res["spark_rows"] > 50, res
    assert 0 < max(seen) <= 4 * 4 + 1 and seen[-1] == 0       # four per state partition and that of no user; hundreds of users


@pytest.mark.parametrize("name,batch", [("session_sum_stream", "session_sum"), ("sliding_sum_stream", "sliding_sum")])
def test_a_small_stream_has_few_state_partitions(spark, many_users, monkeypatch, name, batch):
    key, settings = "spark.sql.shuffle.partitions", ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows")
    old = spark.conf.get(key)
    spark.conf.set(key, "40")
    try:
        before = [spark.conf.get(k, None) for k in settings]
        out, progress = progress_of(spark, monkeypatch, name, many_users)
        assert [spark.conf.get(k, None) for k in settings] == before
        assert {s.numShufflePartitions for p in progress for s in p.stateOperators} == {spark.sparkContext.defaultParallelism}
    finally:
        spark.conf.set(key, old)
    bag = lambda df: Counter(map(tuple, df.select(sorted(df.columns)).collect()))
    assert out.count() > 0 and bag(out) == bag(QUERIES[batch](spark, many_users))


class Handle:
    """State and timers of one key."""

    def __init__(self):
        self.value, self.timers = None, set()

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.remove(t)


class At:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


@pytest.mark.parametrize("key", [3, LateWindowProcessor.NO_USER])
def test_bucket_of_users_against_a_plain_model(key):
    draw, window, lateness, handle = random.Random(8), 10, 15, Handle()
    job = LateWindowProcessor(window, lateness)
    job.init(handle)
    got, want, wins, seen = Counter(), Counter(), {}, 0

    def collect(frames):
        for f in frames:
            got.update((None if pd.isna(r[0]) else r[0], *r[1:]) for r in f.itertuples(index=False))

    for wm in (0, 0, 20, 20, 35, 50, 90, 1000):
        for (u, e), w in wins.items():
            if not w["fired"] and e <= wm:
                w["fired"] = True
                want[u, e, 0, w["n"], w["s"], w["v"], -1] += 1
        rows = []
        for _ in range(0 if wm == 1000 else 40):
            valued = draw.randrange(2)
            rows.append((draw.choice([7, 7, 8, -(1 << 62)]), draw.randrange(9), seen, draw.randrange(max(0, wm - 30), wm + 25),
                         valued * draw.choice([1, 5 * 10**18]), valued))
            seen += 1
        for u, _, i, ms, s, v in sorted(rows, key=lambda r: r[1:3]):
            e = ms - ms % window + window
            if wm >= e + lateness:
                want[u, e, -1, 1, s, v, i] += 1
                continue
            w = wins.setdefault((u, e), {"n": 0, "s": 0, "v": 0, "late": 0, "fired": e <= wm})
            w["n"], w["s"], w["v"] = w["n"] + 1, (w["s"] + s + 2**63) % 2**64 - 2**63, w["v"] + v
            if e <= wm:
                w["late"] += 1
                want[u, e, w["late"], w["n"], w["s"], w["v"], i] += 1
        wins = {k: w for k, w in wins.items() if not (w["fired"] and k[1] + lateness <= wm)}
        if rows:
            frame = pd.DataFrame(rows, columns=["user_id", "arrival", "event_id", "ms", "units", "valued"])
            collect(job.handleInputRows((key,), iter([frame[:15], frame[15:16], frame[16:]]), At(wm)))
        for t in sorted(t for t in handle.timers if t <= wm):
            collect(job.handleExpiredTimer((key,), At(wm), At(t)))
            handle.timers.remove(t)
        unfired = [e for (_, e), w in wins.items() if not w["fired"]]
        assert handle.timers == ({min(unfired)} if unfired else set())
    if key == LateWindowProcessor.NO_USER:
        merged = Counter()
        for r, c in want.items():
            merged[(None, *r[1:])] += c
        want = merged
    assert len(want) > 90 and got == want and handle.value is None
