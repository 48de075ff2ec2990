"""Streams on small fixtures with fixed micro-batches."""

import random

import pytest
from pyspark.sql import functions as F

from fixtures import DELAYED, DELAYED_WINDOWS, LATE_WINDOW, METERED, ON_TIME, READING_WINDOWS, READINGS, STOCK, rows
from millrace.catalog.streams import in_files
from millrace.functions.scalars import event_time_from_millis, parse_iso_seconds
from millrace.operators.aggregates import group_count_max
from millrace.operators.aggregates import top_of_changes as batch_top_of_changes
from millrace.operators.joins import heavy_keys, join_inner, join_spread
from millrace.operators.rows import distinct_rows, distinct_within_watermark, limit_rows
from millrace.operators.timers import keyed_sum_at_timers as batch_sums
from millrace.operators.userdefined import CountSum, Largest, WindowCount
from millrace.operators.userdefined import window_process as batch_window_process
from millrace.operators.windows import tumbling_count
from millrace.sinks.writers import stream_to_parquet
from millrace.sources.memory import from_collection, replay
from millrace.sources.tables import in_batches, stream_table
from millrace.streaming import stateful
from millrace.streaming.bounded import run_available, run_in_phases, run_to_end
from millrace.streaming.eventtime import assign_event_time, merge_watermarked, watermark_bounded, watermark_monotonous
from millrace.streaming.partitions import PartitionClocks

ORDERED = "name STRING, event_order INT"


def timed(df):
    return assign_event_time(df, event_time_from_millis(F.col("event_order")), "ts")


def ten_ms(df):
    return tumbling_count(df, ["name"], "ts", "10 milliseconds")


def expected(windows):
    return sorted(windows, key=str)


def test_windows_in_batch(spark):
    for data, want in ((READINGS, READING_WINDOWS), (DELAYED, DELAYED_WINDOWS)):
        df = timed(from_collection(spark, data, ORDERED))
        assert rows(ten_ms(df)) == expected(want)
        assert rows(batch_window_process(df, ["name"], "ts", "10 milliseconds", WindowCount(), [])) == expected(want)


def test_windows_on_a_stream(spark, folder):
    batches = [READINGS[:3], READINGS[3:6], READINGS[6:]]
    stream = timed(replay(spark, batches, ORDERED, f"{folder}/in"))
    assert rows(run_to_end(stream, "ts", watermark_monotonous, ten_ms)) == expected(READING_WINDOWS)


def test_user_windows_on_a_stream(spark, folder):
    batches = [READINGS[:3], READINGS[3:6], READINGS[6:]]
    stream = timed(replay(spark, batches, ORDERED, f"{folder}/in"))
    out = run_to_end(
        stream, "ts", watermark_monotonous,
        lambda e: stateful.window_process(
            e, ["name"], "ts", "10 milliseconds", CountSum("event_order"), ["event_order"]
        ),
    )
    sums = {("roof", 0): 12, ("cellar", 0): 4, ("roof", 10): 10, ("cellar", 10): 31, ("roof", 30): 31}
    assert rows(out) == expected([(*w, sums[w[0], w[1]]) for w in READING_WINDOWS])


@pytest.mark.parametrize("strict", [True, False])
def test_late_rows_after_a_closed_window(spark, strict):
    on_time, late = DELAYED[:ON_TIME], DELAYED[ON_TIME:]
    phases = [timed(from_collection(spark, p, ORDERED)) for p in (on_time, late)]
    out = run_in_phases(phases, "ts", watermark_monotonous, ten_ms, strict_late=strict)
    assert rows(out) == expected([w for w in DELAYED_WINDOWS if w != LATE_WINDOW])


def test_late_rows_in_the_very_next_batch(spark, folder):
    # Back to back micro-batches: only the strict form compares with the
    # watermark the first one leaves.
    batches = [DELAYED[:ON_TIME], DELAYED[ON_TIME:]]
    got = {}
    for strict in (True, False):
        stream = timed(replay(spark, batches, ORDERED, f"{folder}/in-{strict}"))
        got[strict] = rows(run_to_end(stream, "ts", watermark_monotonous, ten_ms, strict_late=strict))
    assert got[True] == expected([w for w in DELAYED_WINDOWS if w != LATE_WINDOW])
    assert got[False] == expected(DELAYED_WINDOWS)


def test_lateness_keeps_them(spark):
    phases = [timed(from_collection(spark, p, ORDERED)) for p in (DELAYED[:ON_TIME], DELAYED[ON_TIME:])]
    out = run_in_phases(phases, "ts", watermark_bounded("30 milliseconds"), ten_ms, strict_late=True)
    assert rows(out) == expected(DELAYED_WINDOWS)


def test_user_windows_drop_late_rows_too(spark):
    phases = [timed(from_collection(spark, p, ORDERED)) for p in (DELAYED[:ON_TIME], DELAYED[ON_TIME:])]
    out = run_in_phases(
        phases, "ts", watermark_monotonous,
        lambda e: stateful.window_process(e, ["name"], "ts", "10 milliseconds", WindowCount(), []),
    )
    assert rows(out) == expected([w for w in DELAYED_WINDOWS if w != LATE_WINDOW])


def test_the_slowest_part_holds_the_watermark(spark, folder):
    # Each part is in order; read together they are not.
    fast = replay(spark, [[("f", 100)], [("f", 200)]], ORDERED, f"{folder}/fast")
    slow = replay(spark, [[("s", 1)], [("s", 2)]], ORDERED, f"{folder}/slow")
    out = run_to_end(
        [timed(fast), timed(slow)], "ts", watermark_monotonous, lambda *p: ten_ms(merge_watermarked(p)),
        strict_late=True,
    )
    assert rows(out) == expected([("f", 100, 110, 1), ("f", 200, 210, 1), ("s", 0, 10, 2)])


PAYMENT = "at STRING, name STRING, value DOUBLE"


def payments(df):
    return assign_event_time(df, parse_iso_seconds(F.col("at")), "ts").select("name", "ts", "value")


def second(timer_ms):
    return (timer_ms // 1000) % 60


TIMERS = [("gas", 2), ("gas", 12), ("gas", 13), ("water", 6), ("water", 32)]


def test_timers_in_batch(spark):
    out = batch_sums(payments(from_collection(spark, METERED, PAYMENT)), ["name"], "ts", "value", chunks=3)
    got = rows(out.select("name", F.second("timer"), F.round("sum", 1)))
    # Rows up to two seconds after a timer's own row count.
    assert got == expected(zip(*zip(*TIMERS), [2.0, 11.0, 11.0, 10.0, 6.0]))


@pytest.mark.parametrize("spread", [1, 3])
def test_timers_on_a_stream(spark, folder, spread):
    stream = payments(replay(spark, [METERED[:4], METERED[4:]], PAYMENT, f"{folder}/in"))
    out = run_to_end(
        stream, "ts", watermark_bounded("1 hour"),
        lambda e: stateful.keyed_sum_at_timers(e, ["name"], "ts", "value", spread=spread),
    )
    got = sorted((r.name, second(r.timer_ms), round(r["sum"], 1)) for r in out.collect())
    assert got == sorted((name, s, {"gas": 11.0, "water": 6.0}[name]) for name, s in TIMERS)


FAR = [("roof", 3.0, 253402250400), ("roof", 4.0, None), ("cellar", 5.0, 1), ("roof", 6.0, 1)]


@pytest.mark.parametrize("spread", [1, 3])
def test_rows_of_any_time_are_kept(spark, spread):
    """The last day of the year 9999, and no time at all."""
    df = spark.createDataFrame(FAR, "name STRING, value DOUBLE, s BIGINT").select(
        "name", "value", F.timestamp_seconds("s").alias("ts"))
    day = lambda e: tumbling_count(e, ["name"], "ts", "1 day")
    assert rows(run_in_phases([df], "ts", watermark_monotonous, day)) == rows(day(df))
    sums = run_in_phases(
        [df], "ts", watermark_bounded("1 hour"),
        lambda e: stateful.keyed_sum_at_timers(e, ["name"], "ts", "value", spread=spread))
    assert rows(sums.select("name", "timer_ms", "sum")) == expected([
        ("roof", 253402250402000, 13.0), ("roof", 3000, 13.0), ("cellar", 3000, 5.0)])
    batch = batch_sums(df, ["name"], "ts", "value")
    assert rows(batch.select("name", F.unix_millis("timer"), "sum")) == expected([
        ("roof", 253402250402000, 13.0), ("roof", 3000, 10.0), ("cellar", 3000, 5.0)])


@pytest.mark.parametrize("spread", [1, 3])
def test_timers_fire_with_the_sum_so_far_and_late_rows_count(spark, spread):
    first = [("2024-02-19T08:00:00", "P", 1.0), ("2024-02-19T08:00:10", "P", 2.0)]
    second_ = [("2024-02-19T08:00:01", "P", 4.0), ("2024-02-19T08:00:20", "P", 8.0)]
    phases = [payments(from_collection(spark, p, PAYMENT)) for p in (first, second_)]
    out = run_in_phases(
        phases, "ts", watermark_bounded("2 seconds"),
        lambda e: stateful.keyed_sum_at_timers(e, ["name"], "ts", "value", spread=spread),
    )
    got = sorted((second(r.timer_ms), r["sum"]) for r in out.collect())
    # 08:00:02 fires after the first batch; the late row's timer at once.
    assert got == [(2, 3.0), (3, 15.0), (12, 15.0), (22, 15.0)]


def test_sums_expire(spark):
    first = [("2024-02-19T08:00:00", "P", 1.0)]
    second_ = [("2024-02-19T08:00:01", "P", 4.0)]
    phases = [payments(from_collection(spark, p, PAYMENT)) for p in (first, second_)]


    # Micro-batches are further apart than a millisecond: the first sum is
    # gone when the second row comes, and both when the timers fire.
    short = run_in_phases(
        phases, "ts", watermark_bounded("1 hour"),
        lambda e: stateful.keyed_sum_at_timers(e, ["name"], "ts", "value", ttl_seconds=0.001),
    )
    assert sorted((second(r.timer_ms), r["sum"]) for r in short.collect()) == [(2, None), (3, None)]
    ample = run_in_phases(
        phases, "ts", watermark_bounded("1 hour"),
        lambda e: stateful.keyed_sum_at_timers(e, ["name"], "ts", "value", ttl_seconds=3600),
    )
    assert sorted((second(r.timer_ms), r["sum"]) for r in ample.collect()) == [(2, 5.0), (3, 5.0)]


COUNTRY = "country STRING, id BIGINT, stock BIGINT"
AGGS = {"n": ("count", "id"), "most": ("max", "stock")}


@pytest.mark.parametrize("per_record", [True, False])
def test_changelog_row_by_row(spark, folder, per_record):
    stream = replay(spark, [[c] for c in STOCK], COUNTRY, f"{folder}/in")
    log = run_available(stateful.changelog_aggregate(stream, ["country"], AGGS, per_record))
    assert rows(log) == expected([
        ("Kenya", "+I", 1, 15), ("Norway", "+I", 1, 22), ("Peru", "+I", 1, 40),
        ("Peru", "-U", 1, 40), ("Peru", "+U", 2, 40),
    ])


def test_changelog_of_one_batch(spark, folder):
    for per_record, peru in ((False, [("Peru", "+I", 2, 40)]), (True, None)):
        stream = replay(spark, [STOCK], COUNTRY, f"{folder}/in-{per_record}")
        log = run_available(stateful.changelog_aggregate(stream, ["country"], AGGS, per_record))
        got = [r for r in rows(log) if r[0] == "Peru"]
        assert got == peru if peru else len(got) == 3 and ("Peru", "+U", 2, 40) in got


def test_changelog_with_nulls(spark, folder):
    stream = replay(spark, [[("a", None, None)], [("a", None, None)], [("a", 1, 5)]], COUNTRY, f"{folder}/in")
    log = run_available(stateful.changelog_aggregate(stream, ["country"], AGGS))
    assert rows(log) == expected([("a", "+I", 0, None), ("a", "-U", 0, None), ("a", "+U", 1, 5)])


@pytest.mark.parametrize("per_record", [True, False])
def test_changelog_keys_share_state_entries(spark, folder, monkeypatch, per_record):
    """Parts that double as keys come; keys that stay away keep their results; NULL keys, values beyond 2**53."""
    monkeypatch.setattr(stateful, "SPANS", 2)
    monkeypatch.setattr(stateful, "RECORDS_TOGETHER", 3)
    rng, calls = random.Random(5), "country STRING, city BIGINT, stock BIGINT"
    names = [(c, i) for c in ("a", "b", None) for i in (None, *range(9))]
    batches = [[(*rng.choice(names[: 6 * (step + 1)]), rng.choice([None, 1, -2, 2**60])) for _ in range(25)] for step in range(5)]
    stream = replay(spark, batches, calls, f"{folder}/in")
    log = run_available(stateful.changelog_aggregate(
        stream, ["country", "city"], {"n": ("count", "stock"), "most": ("max", "stock"), "all": ("sum", "stock")}, per_record))
    left, ops = {}, {}
    for r in log.collect():
        key, values = (r["country"], r["city"]), (r["n"], r["most"], r["all"])
        left[key, values] = left.get((key, values), 0) + (-1 if r["op"] == "-U" else 1)
        ops[key, r["op"]] = ops.get((key, r["op"]), 0) + 1
    want = {}
    for country, city, stock in (r for b in batches for r in b):
        want.setdefault((country, city), []).append(stock)
    for key, all_ in want.items():
        some = [x for x in all_ if x is not None]
        values = len(some), max(some, default=None), sum(some) if some else None
        assert left.pop((key, values)) == 1 and ops[key, "+I"] == 1
        assert ops.get((key, "-U"), 0) == ops.get((key, "+U"), 0)
    assert not any(left.values())
    if not per_record:  # a key changes once a batch at most
        assert all(ops.get((key, "+U"), 0) < sum(any(r[:2] == key for r in b) for b in batches) for key in want)


def test_a_micro_batch_hands_over_few_rows(spark):
    """Rows and state entries follow the spans, not the keys: what each costs is the query's time."""
    df = spark.range(0, 60_000, 1, 1).select((F.col("id") % 30_000).alias("k"), F.col("id").alias("v"))
    df = df.withColumn("__hash", F.xxhash64("k")).withColumn("__span", F.pmod("__hash", F.lit(stateful.SPANS)))
    dealt = stateful.deal_in_tasks(df, ["__span"], ["__hash", "k"], {"v": "sum"}, combine=True)
    assert dealt.count() <= stateful.SPANS
    flat = dealt.select(F.explode(F.arrays_zip("k", "v")).alias("r")).select("r.*")
    assert flat.count() == 30_000 and flat.filter("v != 2 * k + 30000").count() == 0


def test_user_aggregates_as_change_logs(spark, folder):
    batches = [STOCK[:2], STOCK[2:], [("Peru", 5, 60)]]
    stream = replay(spark, batches, COUNTRY, f"{folder}/sum")
    log = run_available(stateful.user_aggregate(stream, ["country"], CountSum("stock"), ["stock"]))
    assert rows(log) == expected([
        ("Kenya", "+I", 1, 15), ("Norway", "+I", 1, 22), ("Peru", "+I", 1, 40), ("Peru", "-U", 1, 40),
        ("Peru", "+U", 2, 49), ("Peru", "-U", 2, 49), ("Peru", "+U", 3, 109),
    ])
    stream = replay(spark, batches, COUNTRY, f"{folder}/top")
    log = run_available(stateful.user_aggregate(stream, ["country"], Largest("stock"), ["stock"]))
    assert rows(log) == expected([
        ("Kenya", "+I", 15), ("Norway", "+I", 22), ("Peru", "+I", 40), ("Peru", "+I", 9), ("Peru", "-D", 9),
        ("Peru", "+I", 60),
    ])


def test_limit_on_a_stream(spark, folder):
    stream = replay(spark, [STOCK[:2], STOCK[2:]], COUNTRY, f"{folder}/in")
    assert run_available(limit_rows(stream, 3)).count() == 3


def test_upserts(spark, folder):
    stream = replay(spark, [STOCK[:2], STOCK[2:]], COUNTRY, f"{folder}/in")
    counted = group_count_max(stream, ["country"], "id", F.col("stock"), "n", "most")
    writer = counted.writeStream.format("memory").queryName("upserts").outputMode("update")
    writer.trigger(availableNow=True).start().awaitTermination()
    assert rows(spark.table("upserts")) == expected([
        ("Peru", 1, 40), ("Kenya", 1, 15), ("Norway", 1, 22), ("Peru", 2, 40)])


def test_streams_join(spark, folder):
    left = replay(spark, [STOCK[:2], STOCK[2:]], COUNTRY, f"{folder}/left")
    right = replay(spark, [[(4, 10)], [(1, 18)]], "r_id BIGINT, age BIGINT", f"{folder}/right")
    out = run_available(join_inner(left, right, [("id", "r_id")]))
    assert rows(out.select("id", "r_id", "age")) == [(1, 1, 18), (4, 4, 10)]


def test_distinct_with_bounded_state(spark):
    phases = [timed(from_collection(spark, p, ORDERED)) for p in ([("a", 1), ("a", 2), ("b", 100)], [("a", 1000)])]
    out = run_in_phases(phases, "ts", watermark_monotonous, lambda e: distinct_within_watermark(e, "name"))
    assert sorted(r.name for r in out.collect()) == ["a", "a", "b"]


def test_distinct_on_a_stream(spark, folder):
    stream = replay(spark, [[c] for c in STOCK], COUNTRY, f"{folder}/in")
    assert rows(run_available(distinct_rows(stream, "country"))) == [("Kenya",), ("Norway",), ("Peru",)]


def test_replay_gives_one_batch_per_trigger(spark, folder):
    stream = replay(spark, [[("a", 1)], [("b", 2)], [("c", 3)]], ORDERED, f"{folder}/in")
    query = (stream.writeStream.format("memory").queryName("replayed").trigger(availableNow=True).start())
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [1, 1, 1]
    assert rows(spark.table("replayed")) == [("a", 1), ("b", 2), ("c", 3)]


def test_tables_stream_from_files_and_folders(spark, folder):
    df = spark.range(6).select("id", F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"))
    df.repartition(3).write.parquet(f"{folder}/many.parquet")
    stream = stream_table(spark, folder, "many", max_files_per_trigger=1)
    assert dict(stream.dtypes)["ts"] == "timestamp"
    assert run_available(stream).count() == 6


def test_rows_without_time_enter_the_stream(spark, folder):
    """Dealing a table out by time keeps the rows whose time is NULL."""
    df = spark.sql("SELECT id, IF(id % 4 = 0, NULL, timestamp_seconds(id)) AS ts FROM range(40)")
    df.write.parquet(f"{folder}/data/events.parquet")
    laid = in_files(spark, f"{folder}/data", "events", ["id", "ts"], "ts")
    seen = run_available(laid)
    assert sorted(r["id"] for r in seen.collect()) == list(range(40))


class _Timers:
    """What ``PendingTimers`` asks of a handle, with the calls counted."""

    def __init__(self):
        self.map, self.registered, self.calls = {}, [], 0

    def getMapState(self, name, key, value):
        return self

    def containsKey(self, key):
        self.calls += 1
        return key in self.map

    def getValue(self, key):
        self.calls += 1
        return self.map[key]

    def updateValue(self, key, value):
        self.calls += 1
        self.map[key] = value

    def removeKey(self, key):
        self.map.pop(key, None)

    def registerTimer(self, at):
        self.registered.append(at)

    def deleteTimer(self, at):
        self.registered.remove(at)


def test_timers_by_bucket_touch_what_is_due():
    """However many timers a key has pending, a firing reads its bucket only; each time fires once."""
    handle = _Timers()
    timers = stateful.PendingTimers(handle, bucket_ms=10)
    timers.add(range(0, 10_000, 2))
    assert len(handle.registered) == 1000 and len(handle.map) == 1000
    fired = []
    for watermark in (5, 31, 4000):
        while handle.registered and min(handle.registered) < watermark:
            at = min(handle.registered)
            handle.registered.remove(at)
            handle.calls = 0
            fired += timers.due(at, watermark)
            assert handle.calls <= 3
        assert fired == list(range(0, watermark, 2))
    timers.add([4000, 3, 4001])
    assert sorted(handle.registered)[:2] == [3, 4000] and handle.map[400,] == ([4000, 4001, 4002, 4004, 4006, 4008],)


class _Store:
    """What ``Timers`` asks of a handle: values, maps and registered timers, with the calls counted."""

    def __init__(self):
        self.calls, self.registered, self.states = 0, [], {}

    def getValueState(self, name, schema):
        return _Entry(self, name)

    getMapState = lambda self, name, key, value: _Entry(self, name)

    def registerTimer(self, at):
        self.calls += 1
        assert at not in self.registered
        self.registered.append(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.registered.remove(at)


class _Entry:
    def __init__(self, store, name):
        self.store, self.name = store, name

    def _call(self, change, key=()):
        self.store.calls += 1
        return change(self.store.states, (self.name, *key))

    def get(self):
        return self._call(dict.get)

    def update(self, value):
        self._call(lambda states, key: states.update({key: value}))

    def clear(self):
        self._call(lambda states, key: states.pop(key, None))

    def containsKey(self, key):
        return self._call(dict.__contains__, key)

    def getValue(self, key):
        return self._call(dict.__getitem__, key)

    def updateValue(self, key, value):
        self._call(lambda states, key: states.update({key: value}), key)

    def removeKey(self, key):
        self._call(dict.pop, key)


def _fired(store, timers, watermark):
    out = []
    while store.registered and min(store.registered) < watermark:
        at = min(store.registered)
        out += timers.due(at, watermark)
        store.registered.remove(at)
    return sorted(out)


def test_few_timers_cost_few_calls():
    """Times that are far apart are read and written together, and fire together."""
    store = _Store()
    timers = stateful.Timers(store)
    hour = 3_600_000
    timers.add([hour * i for i in range(1, 60)])
    assert store.calls <= 3 and store.registered == [hour]
    store.calls = 0
    assert _fired(store, timers, 50 * hour) == [hour * i for i in range(1, 50)] and store.registered == [50 * hour]
    assert store.calls <= 4
    timers.add([50 * hour, 7])
    assert _fired(store, timers, 8) == [7]
    assert _fired(store, timers, 10**12) == [hour * i for i in range(50, 60)] and not store.states


@pytest.mark.parametrize("few", [0, 3, 40])
def test_timers_few_and_many(few):
    """Against a plain set of pending times, over the border between one value and buckets."""
    rng = random.Random(few)
    store = _Store()
    timers, pending, watermark = stateful.Timers(store, few), set(), 0
    for _ in range(300):
        new = [watermark + rng.randint(-10**6, 10**8) for _ in range(rng.choice([0, 1, 2, 30]))]
        timers.add(new)
        pending.update(new)
        watermark += rng.choice([0, 10**6, 10**7, 10**8])
        assert _fired(store, timers, watermark) == sorted(t for t in pending if t < watermark)
        pending = {t for t in pending if t >= watermark}
    assert _fired(store, timers, 10**18) == sorted(pending) and not store.states


def test_windows_of_a_key_share_an_entry(spark):
    """Each fires as the watermark passes its end, once; late rows of closed windows go, those of open ones count."""
    ms = [[1000, 9000, 40_500], [9500, 40_700, 41_000, 2000], [100_000, -500, 40_100]]
    phases = [from_collection(spark, [("a", t) for t in b], "k STRING, ms BIGINT").select("k", F.timestamp_millis("ms").alias("ts"))
              for b in ms]
    out = run_in_phases(phases, "ts", watermark_bounded("35 seconds"), lambda e: stateful.window_process(
        e, ["k"], "ts", "1 second", WindowCount(), []))
    # Watermarks: 5.5 s, 6 s, 65 s.
    assert rows(out) == expected([("a", 1000, 2000, 1), ("a", 9000, 10_000, 2), ("a", 40_000, 41_000, 3),
                                  ("a", 41_000, 42_000, 1), ("a", 100_000, 101_000, 1)])


def test_windows_in_one_entry_cost_few_calls():
    class Clock:
        getCurrentWatermarkInMs = lambda self: 30_500
        getExpiryTimeInMs = lambda self: 1000

    store = _Store()
    states = stateful.WindowStates(WindowCount(), ["k", "window_start", "window_end", "cnt"])
    states.init(store)
    before = type("Before", (), {"getCurrentWatermarkInMs": lambda self: 0})()
    starts = [1000 * i for i in range(32)]
    assert not list(states.handleInputRows(
        ("a", 0), [{"window_start": t, "window_end": t + 1000, "state": [2]} for t in starts], before))
    assert store.calls <= 3 and store.registered == [1000]
    store.calls, store.registered = 0, []
    assert [tuple(r) for r in states.handleExpiredTimer(("a", 0), Clock(), Clock())] == [
        ("a", t, t + 1000, 2) for t in starts[:30]]
    assert store.calls <= 3 and store.registered == [31_000]


def test_batches_do_not_multiply_with_files(spark, folder):
    """A table of many rows is several files, and still one micro-batch; one without rows is none."""
    parts = [spark.range(a, b, numPartitions=6).select("id") for a, b in ((0, 500), (500, 500), (500, 950), (950, 2000))]
    stream = in_batches(parts, f"{folder}/in", rows_per_file=100)
    query = stream.writeStream.format("memory").queryName("in_batches").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [p.numInputRows for p in query.recentProgress if p.numInputRows] == [500, 450, 1050]
    assert len(spark.read.parquet(f"{folder}/in").inputFiles()) == 3 * 4
    assert spark.table("in_batches").distinct().count() == 2000
    assert run_available(in_batches(parts[1:2], f"{folder}/none")).count() == 0


def test_timers_fire_while_the_stream_runs(spark):
    """With the sum of that moment; a late row fires its timer at once, again if it had fired before."""
    schema = "k STRING, ms BIGINT, v DOUBLE"
    batches = [[("a", 1000, 1.0), ("a", 5000, 2.0), ("b", 1000, 7.0)], [("a", 20_000, 4.0), ("a", 5000, 8.0)],
               [("b", 1000, 1.0), ("a", None, 16.0)]]
    phases = [from_collection(spark, b, schema).select("k", F.timestamp_millis("ms").alias("ts"), "v") for b in batches]
    out = run_in_phases(phases, "ts", watermark_bounded("1 second"),
                        lambda e: stateful.keyed_sum_at_timers(e, ["k"], "ts", "v", delay_seconds=1))
    # Watermarks: 4 s, 19 s, 19 s, the end.
    assert rows(out) == expected([("a", 2000, 3.0), ("b", 2000, 7.0), ("a", 6000, 15.0), ("b", 2000, 8.0), ("a", 21_000, 31.0)])


def test_lateness_decides(spark):
    """The same arrivals with three bounds: what comes behind the watermark of its window is dropped."""
    ms = [[1000, 9000], [3900, 6900, 8900, 10_000], [8000, 7999]]
    phases = [from_collection(spark, [(t,) for t in b], "ms BIGINT").select(F.timestamp_millis("ms").alias("ts")) for b in ms]
    got = []
    for seconds in (0, 2, 5):
        out = run_in_phases(phases, "ts", watermark_bounded(f"{seconds} seconds"), lambda e: tumbling_count(
            e.withColumn("one", F.lit(1)), ["one"], "ts", "1 second"), strict_late=True)
        got.append({r["window_start"]: r["cnt"] for r in out.collect()})
    assert got == [{1000: 1, 9000: 1, 10_000: 1}, {1000: 1, 8000: 2, 9000: 1, 10_000: 1},
                   {1000: 1, 6000: 1, 7000: 1, 8000: 2, 9000: 1, 10_000: 1}]


def _net(log):
    left = {}
    for r in log:
        left[r["k"], r["v"]] = left.get((r["k"], r["v"]), 0) + (-1 if r["op"][0] == "-" else 1)
    return sorted(x for x, n in left.items() for _ in range(n))


@pytest.mark.parametrize("held", [2, 3, 64])
def test_top_of_a_change_log(spark, folder, held):
    """A value taken back brings the next one in, also when it is no longer at hand; ties, zeros, nulls, early retractions."""
    rng = random.Random(held)
    given, batches = [], []
    for step in range(4):
        batch = []
        for _ in range(40):
            if given and rng.random() < 0.45:
                batch.append((*given.pop(rng.randrange(len(given))), "-U"))
            else:
                x = rng.choice("ab"), rng.choice([0, 0, -3, 5, 5, rng.randint(1, 30)])
                given.append(x)
                batch.append((*x, "+U"))
        batches.append([*batch, ("a", None, "+I"), ("c", step, "-D"), ("c", step, "+I"), ("d", 7, "-D" if step == 0 else "+I")])
    schema = "k STRING, v BIGINT, op STRING"
    want = {"a": [], "b": [], "d": [7, 7]}
    for k, v in given:
        want[k].append(v)
    want = sorted((k, v) for k, vs in want.items() for v in sorted(vs, reverse=True)[:2] if v)
    flat = from_collection(spark, [r for b in batches for r in b], schema)
    assert sorted(tuple(r) for r in batch_top_of_changes(flat, ["k"], "v").select("k", "v").collect()) == want
    log = run_available(stateful.top_of_changes(replay(spark, batches, schema, f"{folder}/in"), ["k"], "v", held=held))
    assert _net(log.collect()) == want


def test_top_of_a_change_log_in_many_parts(spark, folder, monkeypatch):
    monkeypatch.setattr(stateful, "RECORDS_TOGETHER", 2)
    test_top_of_a_change_log(spark, folder, 3)


def test_clocks_of_partitions(spark, folder):
    """The slowest partition counts; an idle one not until it has rows again; one may come later; a batch run twice is one."""
    schema = "part INT, ms BIGINT"
    batches = [
        [(0, 1000), (0, 9000), (1, 2000), (None, 5000)],  # clock 2 s, by partition 1
        [(0, 19_000), (1, 1500), (1, 3000), (None, 6000)],  # 1.5 s is late; clock 3 s
        [(0, 21_000), (2, 12_500), (2, 14_000), (0, None)],  # partitions 1 and NULL have one batch without rows; still 3 s
        [(0, 30_000), (2, 16_000), (2, 2500), (2, 13_999)],  # 2.5 s is late; both idle now: 16 s, by partition 2
        [(1, 15_000), (1, 15_999), (0, 31_000)],  # both late; partition 1 is back, but the clock never goes back
    ]
    clocks = PartitionClocks(spark, ["one"], "ts", "part", "1 second")
    closed = []
    for batch in batches:
        rows_now = from_collection(spark, batch, schema).select("part", F.timestamp_millis("ms").alias("ts"), F.lit(1).alias("one"))
        rows_now.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        clocks.run(spark.readStream.schema("part INT, ts TIMESTAMP, one INT").parquet(f"{folder}/in"))
        closed.append({r["window_start"] // 1000: r["cnt"] for r in clocks.closed().collect()})
    most = {1: 1, 2: 1, 3: 1, 5: 1, 6: 1, 9: 1, 12: 1, 13: 1, 14: 1}
    assert closed == [{1: 1}, {1: 1, 2: 1}, {1: 1, 2: 1}, most, most]
    assert clocks.late() == 4
    whole = {r["window_start"] // 1000: r["cnt"] for r in clocks.closed(at_end=True).collect()}
    assert whole == most | {16: 1, 19: 1, 21: 1, 30: 1, 31: 1}
    clocks.step(rows_now, clocks.last)
    assert {r["window_start"] // 1000: r["cnt"] for r in clocks.closed(at_end=True).collect()} == whole and clocks.late() == 4


def test_hot_keys_of_a_join_are_spread(spark, folder):
    """A third of the rows in one key: the result of the plain join, and no state partition far above the mean."""
    left = [(i, 0 if i % 3 == 0 else i % 60) for i in range(3000)] + [(9999, None)]
    right = [(k, f"r{k}") for k in range(60)] + [(0, "twice"), (None, "none")]
    batches = [left[:1000], left[1000:2000], left[2000:]]
    left_table, right_table = from_collection(spark, left, "id INT, k INT"), from_collection(spark, right, "rk INT, name STRING")
    hot = heavy_keys(left_table, "k", 0.1)
    assert hot == [0] and heavy_keys(left_table, "k", 0.9) == [] and heavy_keys(left_table.limit(0), "k") == []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    try:
        largest = {}
        for lanes, keys in ((16, hot), (1, [])):
            a = replay(spark, batches, "id INT, k INT", f"{folder}/left{lanes}")
            b = replay(spark, [right[:30], right[30:]], "rk INT, name STRING", f"{folder}/right{lanes}")
            query = stream_to_parquet(join_spread(a, b, ("k", "rk"), keys, lanes), f"{folder}/out{lanes}", f"{folder}/check{lanes}")
            query.awaitTermination()
            assert rows(spark.read.parquet(f"{folder}/out{lanes}")) == rows(join_inner(left_table, right_table, [("k", "rk")]))
            state = spark.read.format("statestore").option("joinSide", "left").load(f"{folder}/check{lanes}")
            counts = [r["count"] for r in state.groupBy("partition_id").count().collect()]
            largest[lanes] = max(counts) / (sum(counts) / 4)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert largest[16] < 1.35 < 1.8 < largest[1]


def test_sums_expire_by_event_time(spark):
    """Access renews, by rows and by timers; a sum not accessed for longer than the TTL starts anew or is not there."""
    batches = [[("a", 1000, 1.0), ("a", 9000, 2.0), ("b", 1000, 5.0), ("c", 30_000, 0.0)],
               [("a", 25_000, 4.0), ("a", 3000, 8.0), ("b", 12_500, 6.0)], [("a", None, 16.0), ("b", 50_000, 7.0)]]
    phases = [from_collection(spark, b, "k STRING, ms BIGINT, v DOUBLE").select("k", F.timestamp_millis("ms").alias("ts"), "v")
              for b in batches]
    out = run_in_phases(phases, "ts", watermark_bounded("1 second"), lambda e: stateful.keyed_sum_at_timers(
        e, ["k"], "ts", "v", delay_seconds=2, ttl_seconds=10, ttl_clock="event"))
    # b: the timer at 3 s renews, so 12.5 s is in time though more than 10 s after the row at 1 s.
    assert rows(out) == expected([("a", 3000, 3.0), ("a", 11_000, 3.0), ("b", 3000, 5.0), ("a", 5000, 4.0), ("a", 27_000, 4.0),
                                  ("b", 14_500, 11.0), ("b", 52_000, 7.0), ("c", 32_000, 0.0)])
    never = run_in_phases(phases[:1], "ts", watermark_bounded("1 second"), lambda e: stateful.keyed_sum_at_timers(
        e, ["k"], "ts", "v", delay_seconds=2, ttl_seconds=1, ttl_clock="event"))
    assert ("b", 3000, None) in rows(never)
