"""Incremental jobs: late data, retries after a crash, order of deliveries."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from silverlode.operators import alerts
from silverlode.sources import sinks
from silverlode.streaming import changesets, jobs, keyed

EVENTS = "event_id long, ts string, event_type string"


def deliver(spark, path, rows):
    df = spark.createDataFrame(rows, EVENTS).withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.mode("append").parquet(path)
    return df.schema


def test_rows_later_than_the_bound_are_dropped(spark, tmp_path):
    root = f"file://{tmp_path}"
    waves = [
        [(1, "2024-01-01 10:00:00", "error")],
        [(2, "2024-01-01 15:00:00", "click")],
        [(3, "2024-01-01 10:30:00", "click"), (4, "2024-01-01 14:30:00", "click")],
    ]
    for wave in waves:
        schema = deliver(spark, f"{root}/in", wave)
        stream = jobs.landing_stream(spark, f"{root}/in", schema)
        jobs.write_windows(jobs.windowed_outcomes(stream, "ts", "1 hour", "1 hour"), f"{root}/out", f"{root}/cp")
    out = {r.window_start.hour: r.total for r in jobs.latest_windows(spark, f"{root}/out", ["total", "failed"]).collect()}
    assert out == {10: 1, 15: 1, 14: 1}


STAFF = "k long, at int, v string"


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 1, 0], [1, 2, 0]])
def test_upsert_does_not_depend_on_delivery_order(spark, tmp_path, rows, order):
    root = f"file://{tmp_path}"
    waves = [[(1, 1, "old"), (2, 1, "only")], [(1, 3, "newest")], [(1, 2, "middle"), (3, 1, "late")]]
    schema = spark.createDataFrame([], STAFF).schema
    for i in order:
        spark.createDataFrame(waves[i], STAFF).write.mode("append").parquet(f"{root}/in")
        stream = jobs.landing_stream(spark, f"{root}/in", schema)
        changesets.incremental_upsert(stream, f"{root}/t", f"{root}/cp", ["k"], ["at"], schema)
        if i == 1:
            changesets.compact_changes(spark, f"{root}/t", ["k"], ["at"], schema, 3)
    table = changesets.read_upserted(spark, f"{root}/t", ["k"], ["at"], schema)
    assert rows(table, "k", "v") == [(1, "newest"), (2, "only"), (3, "late")]


def test_a_batch_retried_after_a_crash_loses_nothing(spark, tmp_path, rows, monkeypatch):
    root = f"file://{tmp_path}"
    schema = spark.createDataFrame([], STAFF).schema

    def run():
        stream = jobs.landing_stream(spark, f"{root}/in", schema)
        changesets.incremental_upsert(stream, f"{root}/t", f"{root}/cp", ["k"], ["at"], schema)

    def crash(df, path, *rest):
        whole(df.where("k < 5"), path, *rest)
        raise RuntimeError("executor lost")

    spark.createDataFrame([(k, 1, "first") for k in range(20)], STAFF).write.parquet(f"{root}/in")
    run()
    spark.createDataFrame([(k, 2, "second") for k in range(10)], STAFF).write.mode("append").parquet(f"{root}/in")
    whole = sinks.overwrite
    monkeypatch.setattr(sinks, "overwrite", crash)
    # Half of the batch's set is written; then half of a base.
    with pytest.raises(Exception, match="executor lost"):
        run()
    monkeypatch.setattr(sinks, "overwrite", whole)
    run()
    whole_base = sinks.overwrite_bucketed

    def crash_base(df, *rest):
        whole_base(df.where("k < 5"), *rest)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(sinks, "overwrite_bucketed", crash_base)
    with pytest.raises(Exception, match="executor lost"):
        changesets.compact_changes(spark, f"{root}/t", ["k"], ["at"], schema, 3)
    expected = sorted([(k, "second" if k < 10 else "first") for k in range(20)], key=repr)
    assert rows(changesets.read_upserted(spark, f"{root}/t", ["k"], ["at"], schema), "k", "v") == expected
    monkeypatch.setattr(sinks, "overwrite_bucketed", whole_base)
    changesets.compact_changes(spark, f"{root}/t", ["k"], ["at"], schema, 3)
    assert rows(changesets.read_upserted(spark, f"{root}/t", ["k"], ["at"], schema), "k", "v") == expected
    assert sorted(p.name for p in (tmp_path / "t").iterdir() if p.name[0] not in "._") == ["base=1.3"]


def test_a_small_batch_writes_a_small_set(spark, tmp_path):
    root = f"file://{tmp_path}"
    schema = spark.createDataFrame([], STAFF).schema
    for rows_ in ([(k, 1, "first") for k in range(2000)], [(k, 2, "second") for k in range(0, 2000, 100)]):
        spark.createDataFrame(rows_, STAFF).write.mode("append").parquet(f"{root}/in")
        stream = jobs.landing_stream(spark, f"{root}/in", schema)
        changesets.incremental_upsert(stream, f"{root}/t", f"{root}/cp", ["k"], ["at"], schema)
    assert spark.read.parquet(f"{root}/t/change=1").count() == 20
    assert changesets.read_upserted(spark, f"{root}/t", ["k"], ["at"], schema).where("v = 'second'").count() == 20


def test_high_water_mark_of_an_empty_start(spark):
    df = spark.createDataFrame([], "ts int")
    assert jobs.high_water_mark(df, "ts").first().high_water_mark is None


def test_first_deliveries_reach_bronze_once(spark, tmp_path, rows):
    root = f"file://{tmp_path}"
    waves = [
        [(1, "2024-01-02 10:00:00", "a"), (1, "2024-01-02 10:00:00", "a"), (None, "2024-01-02 11:00:00", "n"),
         (None, "2024-01-02 11:00:00", "n")],
        # Late, again, again under another day, and another row without a key.
        [(2, "2024-01-01 09:00:00", "late"), (1, "2024-01-02 10:00:00", "a"), (1, "2024-03-05 10:00:00", "moved"),
         (None, "2024-01-02 11:00:00", "n")],
        [(3, "2024-01-02 10:30:00", "c"), (4, None, "timeless")],
        [(4, None, "timeless"), (3, None, "timeless")],
    ]
    session = keyed.stateful_session(spark, 2)
    for wave in waves:
        schema = deliver(spark, f"{root}/in", wave)
        stream = jobs.landing_stream(session, f"{root}/in", schema)
        keyed.ingest_distinct(stream, f"{root}/out", f"{root}/cp", ["event_id"], "ts")
    stored = spark.read.parquet(f"{root}/out")
    expected = [(1, "a"), (2, "late"), (3, "c"), (4, "timeless")] + [(None, "n")] * 3
    assert rows(stored, "event_id", "event_type") == sorted(expected, key=repr)
    assert (tmp_path / "cp" / "state" / "0").exists()


def test_keys_of_several_columns_pass_if_any_is_null(spark, tmp_path, rows):
    root = f"file://{tmp_path}"
    schema = "a long, b string, ts timestamp"
    at = dt.datetime(2024, 1, 1)
    session = keyed.stateful_session(spark, 2)
    for _ in range(2):
        spark.createDataFrame([(1, "x", at), (1, None, at), (None, "x", at)], schema).write.mode("append").parquet(f"{root}/in")
        stream = jobs.landing_stream(session, f"{root}/in", spark.read.parquet(f"{root}/in").schema)
        keyed.ingest_distinct(stream, f"{root}/out", f"{root}/cp", ["a", "b"], "ts")
    expected = [(1, "x")] + [(1, None), (None, "x")] * 2
    assert rows(spark.read.parquet(f"{root}/out"), "a", "b") == sorted(expected, key=repr)


def test_a_stateful_session_leaves_the_callers_settings(spark):
    before = dict(spark.conf.getAll)
    session = keyed.stateful_session(spark, 3)
    assert session.conf.get("spark.sql.shuffle.partitions") == "3"
    assert session.conf.get("spark.sql.session.timeZone") == "UTC"
    assert dict(spark.conf.getAll) == before


def test_the_base_is_not_shuffled_by_readers(spark, tmp_path, rows, plan):
    root = f"file://{tmp_path}"
    schema = spark.createDataFrame([], STAFF).schema
    table = (f"{root}/t", ["k"], ["at"], schema)

    def arrive(data):
        spark.createDataFrame(data, STAFF).write.mode("append").parquet(f"{root}/in")
        stream = jobs.landing_stream(spark, f"{root}/in", schema)
        changesets.incremental_upsert(stream, f"{root}/t", f"{root}/cp", ["k"], ["at"], schema)

    arrive([(k, 1, "first") for k in range(1000)] + [(None, 1, "nobody")])
    changesets.compact_changes(spark, *table, buckets=4)
    clean = changesets.read_upserted(spark, *table)
    assert "Exchange" not in plan(clean) and "Window" not in plan(clean)
    arrive([(k, 2, "second") for k in range(0, 1000, 10)] + [(5, 0, "older"), (2000, 1, "new"), (None, 3, "nobody again")])
    read = changesets.read_upserted(spark, *table)
    text = plan(read)
    # The second scan is that for rows without a key.
    assert text.count("Bucketed: true") == 2 and text.count("PushedFilters: [IsNull(k)]") == 2 and "SelectedBucketsCount: 4 out of 4" in text
    # Between the join and the scan of the base's buckets there is neither an exchange nor a rank.
    left = text[text.index("SortMergeJoin") : text.index("Bucketed: true")]
    assert "Exchange" not in left and "Window" not in left, text
    values = {r.k: r.v for r in read.collect()}
    assert len(values) == 1002 and values[5] == "first" and values[2000] == "new" and values[None] == "nobody again"
    assert sum(v == "second" for v in values.values()) == 100
    assert changesets.read_upserted(spark, *table).count() == 1002


def test_reading_as_of_a_moment(spark, tmp_path, rows):
    root = f"file://{tmp_path}"
    schema = spark.createDataFrame([], STAFF).schema
    table = (f"{root}/t", ["k"], ["at"], schema)
    for day in range(1, 5):
        spark.createDataFrame([(1, day, f"day {day}"), (day * 10, day, "own")], STAFF).write.mode("append").parquet(f"{root}/in")
        stream = jobs.landing_stream(spark, f"{root}/in", schema)
        changesets.incremental_upsert(stream, f"{root}/t", f"{root}/cp", ["k"], ["at"], schema, arrived=f"2024-01-0{day} 12:00:00")
        if day == 2:
            changesets.compact_changes(spark, *table, buckets=2, keep=True)

    def as_of(moment):
        return rows(changesets.read_upserted(spark, *table, as_of=moment), "k", "v")

    assert as_of("2024-01-01 11:59:59") == []
    assert as_of("2024-01-01 12:00:00") == as_of("2024-01-02 11:00:00") == [(1, "day 1"), (10, "own")]
    assert as_of("2024-01-03 00:00:00") == [(1, "day 2"), (10, "own"), (20, "own")]
    assert as_of("2024-01-03 12:00:00") == [(1, "day 3"), (10, "own"), (20, "own"), (30, "own")]
    assert as_of("2030-01-01 00:00:00") == rows(changesets.read_upserted(spark, *table), "k", "v")
    changesets.compact_changes(spark, *table, buckets=2)
    assert len(as_of("2024-01-04 12:00:00")) == 5
    with pytest.raises(RuntimeError, match="compacted"):
        as_of("2024-01-03 12:00:00")


def test_counted_and_late_rows_are_all_that_was_delivered(spark, tmp_path, rows):
    root = f"file://{tmp_path}"
    waves = [
        [(1, "2024-01-01 10:10:00", "error"), (2, "2024-01-01 10:50:00", "click"), (3, None, "click")],
        [(4, "2024-01-01 15:00:00", "click"), (5, "2024-01-01 10:20:00", "click")],
        # The newest time is 15:00, so windows that end by 13:00 are closed.
        [(6, "2024-01-01 12:59:59", "click"), (7, "2024-01-01 13:00:00", "error"), (8, "2024-01-01 10:30:00", "error")],
        [],
        [(9, "2024-01-01 12:10:00", "click")],
    ]
    for wave in waves:
        schema = deliver(spark, f"{root}/in", wave)
        stream = jobs.landing_stream(spark, f"{root}/in", schema)
        jobs.count_windows(stream, "ts", "1 hour", "2 hours", f"{root}/out", f"{root}/cp")
    counts = {r.window_start.hour: (r.total, r.succeeded, r.failed) for r in jobs.counted_windows(spark, f"{root}/out").collect()}
    assert counts == {10: (3, 2, 1), 15: (1, 1, 0), 13: (1, 0, 1)}
    assert rows(jobs.late_rows(spark, f"{root}/out", schema), "event_id") == [(3,), (6,), (8,), (9,)]
    told = jobs.accounts(spark, f"{root}/out")
    assert told.where("counted + late <> delivered").count() == 0
    assert told.groupBy().sum("delivered", "late").first()[:] == (9, 4)


ARRIVED = "pod_id string, company string, domain string, file_name string"


def test_a_company_completed_by_a_new_configuration_is_released_once(spark, tmp_path, frames):
    root = f"file://{tmp_path}"
    shape = frames.company_config.limit(1)

    def config(domains):
        changes = {"pod_id": F.lit("p"), "company": F.lit("c"), "enabled": F.lit(True), "domains": F.array(*[F.lit(d) for d in domains])}
        return shape.withColumns(changes)

    def run(arrived, domains):
        df = spark.createDataFrame([("p", "c", d, "x.csv") for d in arrived], ARRIVED)
        df.write.mode("append").parquet(f"{root}/in")
        stream = jobs.landing_stream(spark, f"{root}/in", df.schema)
        jobs.completeness_stream(stream, config(domains), f"{root}/state", f"{root}/out", f"{root}/cp")
        return jobs.all_versions(spark, f"{root}/out", jobs.RELEASED).count()

    assert run(["hr"], ["hr", "payroll"]) == 0
    # The missing domain is taken off the list; the next batch releases the company.
    assert run(["hr"], ["hr"]) == 1
    assert run(["payroll"], ["hr", "payroll"]) == 1
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == ["version=1", "version=2"]


def test_lost_state_is_an_error(spark, tmp_path):
    with pytest.raises(RuntimeError, match="is gone"):
        jobs.read_version(spark, f"file://{tmp_path}/state", 3, jobs.ARRIVALS)


RUNS = """execution_id string, pod_id string, company string, domain string, stage string, execution_start_time timestamp_ntz,
    execution_end_time timestamp_ntz, file_arrival_time timestamp_ntz, execution_duration_seconds int,
    data_quality_score double, status string, dbu_consumed double"""


ANYWHERE = (None, None, None, None, 10.0, "GREATER_THAN", "HIGH", "mail", True)


def start_of(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def slow_run(name, at):
    return (name, "p", "c", "d", "s", at, at, at, 100, 1.0, "OK", 1.0)


def quiet_run(name, at):
    return (name, "p", "c", "d", "s", at, None, at, None, None, "RUNNING", None)


@pytest.fixture
def alert_job(spark, tmp_path):
    """Deliver runs to an alert stream with a bound of two hours."""
    root = f"file://{tmp_path}"
    rules = spark.createDataFrame(
        [("free", "n", "DURATION", *ANYWHERE, None), ("calm", "n", "DURATION", *ANYWHERE, 10)], alerts.ALERT_RULE
    )
    session = keyed.stateful_session(spark, 2)

    def run(data):
        df = spark.createDataFrame(data, RUNS)
        df.write.mode("append").parquet(f"{root}/in")
        stream = jobs.landing_stream(session, f"{root}/in", df.schema)
        keyed.alert_stream(stream, rules, "2 hours", f"{root}/out", f"{root}/cp")

    run.rules, run.target = rules, f"{root}/out"
    return run


@pytest.mark.parametrize("order", [[0, 1, 2], [2, 0, 1], [2, 1, 0]])
def test_alerts_within_the_bound_do_not_depend_on_deliveries(spark, rows, alert_job, order):
    # Two runs a minute; waves end in the middle of a minute.
    runs = [slow_run(f"e{i:02d}", start_of(i // 2 * 2) + dt.timedelta(seconds=30 * (i % 2))) for i in range(45)]
    waves = [runs[:15], runs[15:29], runs[29:]]
    for i in order:
        alert_job(waves[i])
    alert_job([quiet_run("ahead", start_of(1000))])
    log = spark.createDataFrame(runs, RUNS)
    whole = alerts.apply_cooldown(alerts.firing_minutes(alerts.evaluate_alerts(log, alert_job.rules))).where("sent")
    columns = ["alert_rule_id", "minute", "firings"]
    expected = rows(whole, *columns)
    assert {r[0] for r in expected} == {"free", "calm"} and sum(r[2] for r in expected if r[0] == "free") == 45
    assert rows(keyed.alerts_sent(spark, alert_job.target), *columns) == expected
    assert keyed.late_firings(spark, alert_job.target).count() == 0


def test_sent_alerts_stay_and_late_firings_are_counted(spark, rows, alert_job):
    zero = int(dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc).timestamp()) // 60

    def sent():
        return {(r, m - zero) for r, m in rows(keyed.alerts_sent(spark, alert_job.target), "alert_rule_id", "minute")}

    alert_job([slow_run("a", start_of(100)), slow_run("b", start_of(105))])
    assert sent() == set()  # Nothing is final yet.
    alert_job([slow_run("c", start_of(300))])
    before = sent()
    assert before == {("free", 100), ("free", 105), ("calm", 100)}
    # A firing before the alert that was sent would have held it, but its minute is final.
    alert_job([slow_run("d", start_of(95)), slow_run("e", start_of(95)), slow_run("f", start_of(185))])
    alert_job([quiet_run("ahead", start_of(1000))])
    assert before <= sent() and sent() - before == {("free", 185), ("calm", 185), ("free", 300), ("calm", 300)}
    late = {(r, m - zero, n) for r, m, n in rows(keyed.late_firings(spark, alert_job.target), "alert_rule_id", "minute", "firings")}
    assert late == {("free", 95, 2), ("calm", 95, 2)}
    held = keyed.decided_minutes(spark, alert_job.target).where("outcome = 'held'")
    assert [(r[0], r[1] - zero) for r in rows(held, "alert_rule_id", "minute")] == [("calm", 105)]


def test_alert_state_and_output_do_not_grow_with_the_past(spark, tmp_path, alert_job):
    for wave in range(6):
        alert_job([slow_run(f"w{wave}r{i}", start_of(wave * 1000 + i)) for i in range(20)])
    versions = keyed.decided_minutes(spark, alert_job.target).groupBy("version").count().collect()
    # 20 minutes of two rules a wave, each written once.
    assert sum(r["count"] for r in versions) == 5 * 40 and max(r["count"] for r in versions) == 40
    state = spark.read.format("statestore").option("stateVarName", "open").load(f"file://{tmp_path}/cp")
    assert state.count() == 40


class Calls:
    """State of one rule, without a stream, that counts the calls made to it."""

    def __init__(self):
        self.entries, self.value, self.count, self.timers = [], None, 0, set()

    def getListState(self, name, schema):
        return self

    def getValueState(self, name, schema):
        state = Calls()
        state.get, state.exists, state.update = lambda: state.value, lambda: state.value is not None, lambda v: setattr(state, "value", v)
        return state

    def registerTimer(self, at):
        self.count += 1
        self.timers.add(at)

    def appendList(self, entries):
        self.count, self.entries = self.count + 1, self.entries + entries

    def put(self, entries):
        self.count, self.entries = self.count + 1, entries

    def get(self):
        self.count += 1
        return iter(self.entries)

    def clear(self):
        self.count, self.entries = self.count + 1, []


class Mark:
    def __init__(self, minute):
        self.getCurrentWatermarkInMs = lambda: minute * keyed.MINUTE_MS


def test_a_batch_calls_the_alert_state_a_few_times_whatever_its_minutes():
    state, rule = Calls(), keyed.Cooldown()
    rule.init(state)

    def firing(minute, cooldown=10):
        return Row(cooldown_minutes=cooldown, minute=minute, firings=1)

    assert list(rule.handleInputRows(("r",), map(firing, range(5000)), Mark(0))) == []
    assert list(rule.handleInputRows(("r",), map(firing, range(4000, 5000)), Mark(0))) == []
    decided = list(rule.handleExpiredTimer(("r",), Mark(4500), None))
    assert [(r.minute, r.firings) for r in decided] == [(m, 1 + (m >= 4000)) for m in range(4500)]
    assert [r.minute for r in decided if r.outcome == keyed.SENT] == list(range(0, 4500, 10))
    # What is open stays, merged, with a timer for its first minute.
    assert state.entries == [(m, 2, 10) for m in range(4500, 5000)] and 4501 * keyed.MINUTE_MS in state.timers
    assert state.count < 10
    late = list(rule.handleInputRows(("r",), [firing(7)], Mark(4500)))
    assert [(r.minute, r.outcome) for r in late] == [(7, keyed.LATE)]
    rest = list(rule.handleExpiredTimer(("r",), Mark(9000), None))
    assert [r.minute for r in rest if r.outcome == keyed.SENT] == list(range(4500, 5000, 10)) and state.entries == []
