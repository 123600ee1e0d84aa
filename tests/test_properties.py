"""Random inputs against small Python simulations of the reference behaviour."""

from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewater.operators.lateness import classify_lateness, window_firings
from tidewater.operators.running import RunningSpec, row_chunk, running_aggregate
from tidewater.operators.timers import order_timeout_drain
from tidewater.operators.changelog import retract_changelog
from tidewater.operators.windows import count_windows, session_windows, tumbling

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

null_rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 2)), st.one_of(st.none(), st.integers(-50, 50))),
                     min_size=1, max_size=60)


@SETTINGS
@given(rows=null_rows, width=st.integers(1, 7), hot=st.sampled_from([None, 0, 5]))
def test_null_keys_and_null_values_equal_the_plain_window(spark, rows, width, hot):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "seq long, k long, v long")
    got = running_aggregate(df, keys=["k"], order=["seq"], chunk=row_chunk("seq", width), hot_threshold=hot, specs=[
        RunningSpec("s", "sum", "v"), RunningSpec("c", "count"), RunningSpec("mx", "max", "v"),
        RunningSpec("ps", "sum", "v", exclusive=True)])
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("seq", F.sum("v").over(w).alias("s"), F.row_number().over(w).alias("c"), F.max("v").over(w).alias("mx"),
                    F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("ps"))
    assert sorted(map(str, got.select("seq", "s", "c", "mx", "ps").collect())) == sorted(map(str, ref.collect()))


def test_sums_keep_places_beyond_cents(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("k"), F.lit(0.004).alias("v"),
                                  F.timestamp_seconds(F.col("id")).alias("ts"))
    assert tumbling(df, ["k"], "ts", "1 hour", "v").first().sum_value == 4.0
    assert session_windows(df, ["k"], "ts", "1 hour", "v", tie="id").first().sum_value == 4.0
    assert count_windows(df, ["k"], "id", 1000, 1000, "v").first().sum_value == 4.0


def test_changelog_of_a_sum_keeps_retractions_of_cancelling_values(spark):
    df = spark.createDataFrame([(1, 7, 1), (2, 7, -1), (3, 7, 5), (4, 8, 0)], "seq long, k long, v long")
    got = [(r.seq, r.op, r.total) for r in retract_changelog(df, "k", "seq", "v", out="total").orderBy("seq", "change_seq").collect()]
    assert got == [(1, True, 1), (2, False, 1), (2, True, 0), (3, False, 0), (3, True, 5), (4, True, 0)]


rows_st = st.lists(st.tuples(st.integers(0, 3), st.integers(-50, 50)), min_size=1, max_size=60)


@SETTINGS
@given(rows=rows_st, width=st.integers(1, 7), hot=st.sampled_from([None, 0, 5, 1000]))
def test_chunked_running_equals_plain_window(spark, rows, width, hot):
    df = spark.createDataFrame([(i, k, v) for i, (k, v) in enumerate(rows)], "seq long, k long, v long")
    got = running_aggregate(df, keys=["k"], order=["seq"], chunk=row_chunk("seq", width), hot_threshold=hot, specs=[
        RunningSpec("s", "sum", "v"), RunningSpec("c", "count"), RunningSpec("mx", "max", "v"),
        RunningSpec("mn", "min", "v"), RunningSpec("pmx", "max", "v", exclusive=True)])
    w = Window.partitionBy("k").orderBy("seq")
    ref = df.select("seq", F.sum("v").over(w).alias("s"), F.row_number().over(w).alias("c"),
                    F.max("v").over(w).alias("mx"), F.min("v").over(w).alias("mn"),
                    F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("pmx"))
    a = sorted((r.seq, r.s, r.c, r.mx, r.mn, r.pmx) for r in got.collect())
    b = sorted((r.seq, r.s, r.c, r.mx, r.mn, r.pmx) for r in ref.collect())
    assert a == b


def _sim_count_window(rows, size, slide):
    """Count trigger every `slide` rows of a key, evictor keeps the last `size`."""
    buf, fired = defaultdict(list), []
    for seq, k, v in rows:
        buf[k].append(v)
        if len(buf[k]) % slide == 0:
            fired.append((k, len(buf[k]) // slide, sum(buf[k][-size:])))
    return sorted(fired)


@SETTINGS
@given(rows=rows_st, size=st.integers(1, 6), slide=st.integers(1, 6))
def test_count_windows_match_trigger_and_evictor(spark, rows, size, slide):
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "seq long, k long, v long")
    got = count_windows(df, ["k"], "seq", size, slide, "v", chunk_width=3, hot_threshold=4)
    assert sorted((r.k, r.window_index, int(r.sum_value)) for r in got.collect()) == \
        _sim_count_window(data, size, slide)


def _sim_lateness(rows, window, bound, lateness):
    """Rows in arrival order; watermark after each row; allowed lateness refires."""
    mx, out, state = None, [], {}
    classes = {}
    for arr, ev, k, ts, v in sorted(rows):
        mx = ts if mx is None else max(mx, ts)
        we = ts - ts % window + window
        if mx < we + bound:
            cls = "on_time"
        elif mx < we + bound + lateness:
            cls = "late_accepted"
        else:
            cls = "late_dropped"
        classes[ev] = cls
        if cls == "late_accepted":
            n, s, f = state.get((k, we), (0, 0, 0))
            state[(k, we)] = (n + 1, s + v, f + 1)
            out.append((k, we, f + 1, n + 1, s + v))
        elif cls == "on_time":
            n, s, f = state.get((k, we), (0, 0, 0))
            assert f == 0
            state[(k, we)] = (n + 1, s + v, 0)
    # first firings: on-time content only
    on = defaultdict(lambda: [0, 0])
    for arr, ev, k, ts, v in rows:
        if classes[ev] == "on_time":
            we = ts - ts % window + window
            on[(k, we)][0] += 1
            on[(k, we)][1] += v
    out += [(k, we, 0, n, s) for (k, we), (n, s) in on.items()]
    return classes, sorted(out)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 400), st.integers(0, 9), st.integers(1, 20)),
                     min_size=1, max_size=40))
def test_lateness_classes_and_refires_match_simulation(spark, rows):
    sec = 1_000_000
    data = [(arr, ev, k, t, v) for ev, (k, t, arr, v) in enumerate(rows)]
    df = spark.createDataFrame([(ev, k, arr * 10 + ev % 10, t, v) for arr, ev, k, t, v in data],
                               "event_id long, k long, arrival long, t long, value long")
    df = df.withColumn("ts", F.timestamp_add("SECOND", F.col("t"), F.lit("2024-01-01").cast("timestamp_ntz")))
    sim_rows = [(arr * 10 + ev % 10, ev, k, t * sec, v) for arr, ev, k, t, v in data]
    classes, firings = _sim_lateness(sim_rows, 60 * sec, 10 * sec, 20 * sec)
    c = classify_lateness(df, "ts", "arrival", "event_id", "1 minute", "10 seconds", "20 seconds", chunk_width=7)
    assert {r.event_id: r.lateness_class for r in c.collect()} == classes
    f = window_firings(c, ["k"], "value", "arrival", "event_id", chunk_width=7, hot_threshold=1)
    # window_end is a naive wall clock; compare offsets from the base day
    import datetime as dt
    got = sorted((r.k, int((r.window_end - dt.datetime(2024, 1, 1)).total_seconds() * sec), r.firing,
                  r.event_count, int(r.sum_value)) for r in f.collect())
    assert got == firings


def _sim_drain(orders, interval):
    """Process events in time order; timers fire before orders at the same instant."""
    handled = {}
    by_user = defaultdict(list)
    for oid, u, t in orders:
        by_user[u].append((t, oid))
    for u, evs in by_user.items():
        evs.sort()
        pending, timers = [], []
        i = 0
        import heapq
        while i < len(evs) or timers:
            next_order = evs[i][0] if i < len(evs) else None
            if timers and (next_order is None or timers[0] <= next_order):
                ft = heapq.heappop(timers)
                for oid in pending:
                    handled[oid] = ft
                pending = []
            else:
                t, oid = evs[i]
                pending.append(oid)
                heapq.heappush(timers, t + interval)
                i += 1
    return handled


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 60)), min_size=1, max_size=40))
def test_order_timeout_drain_matches_timer_simulation(spark, rows):
    orders = [(i, u, t * 1000) for i, (u, t) in enumerate(rows)]
    df = spark.createDataFrame(orders, "order_id long, user_id long, ms long")
    df = df.withColumn("ts", F.timestamp_add("MILLISECOND", F.col("ms"), F.lit("2024-01-01").cast("timestamp_ntz")))
    got = order_timeout_drain(df, "user_id", "order_id", "ts", "10 seconds", chunk="7 seconds", hot_threshold=3)
    base = 1704067200000
    res = {r.order_id: r.handled_ms - base for r in got.collect()}
    assert res == _sim_drain(orders, 10_000)


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 2), st.integers(0, 100)), min_size=1, max_size=40))
def test_session_windows_match_merge(spark, rows):
    data = [(i, u, t) for i, (u, t) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id long, user_id long, t long").withColumn(
        "ts", F.timestamp_add("SECOND", F.col("t"), F.lit("2024-01-01").cast("timestamp_ntz"))).withColumn(
        "value", F.lit(1.0))
    got = session_windows(df, ["user_id"], "ts", "10 seconds", "value", tie="event_id", chunk="7 seconds",
                          hot_threshold=3)
    exp = []
    for u in {r[1] for r in data}:
        ts = sorted(t for _, uu, t in data if uu == u)
        start, last, n = ts[0], ts[0], 1
        for t in ts[1:]:
            if t - last <= 10:
                last, n = t, n + 1
            else:
                exp.append((u, start, last + 10, n))
                start, last, n = t, t, 1
        exp.append((u, start, last + 10, n))
    import datetime as dt
    base = dt.datetime(2024, 1, 1)
    out = sorted((r.user_id, int((r.window_start - base).total_seconds()), int((r.window_end - base).total_seconds()),
                  r.event_count) for r in got.collect())
    assert out == sorted(exp)
