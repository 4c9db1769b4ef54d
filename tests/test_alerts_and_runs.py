"""Alert rules, cooldown, retries and run records."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from silverlode.operators import alerts, runs


def test_wildcards_match_like_null_or_equal(spark, rows):
    tenants = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x")], "pod_id string, company string")
    rules = spark.createDataFrame(
        [("r1", "a", None), ("r2", None, "x"), ("r3", None, None), ("r4", "b", "x"), ("r5", "c", None)],
        "rule string, pod_id string, company string",
    )
    out = alerts.resolve_wildcards(tenants, rules, ["pod_id", "company"])
    t, r = tenants.alias("t"), rules.alias("r")
    brute = t.join(
        r,
        (F.col("r.pod_id").isNull() | (F.col("r.pod_id") == F.col("t.pod_id")))
        & (F.col("r.company").isNull() | (F.col("r.company") == F.col("t.company"))),
    ).select("t.pod_id", "t.company", "rule")
    assert rows(out, "pod_id", "company", "rule") == rows(brute)


@pytest.mark.parametrize("operator,hits", [("GREATER_THAN", [3]), ("LESS_THAN", [1]), ("EQUALS", [2]), ("OTHER", [])])
def test_operators(spark, operator, hits):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v int")
    assert [r.v for r in df.where(alerts.breaches(F.col("v"), F.lit(operator), F.lit(2))).collect()] == hits


def brute_cooldown(minutes, cooldown):
    sent, last = [], None
    for m in sorted(minutes):
        if last is None or m - last >= cooldown:
            sent.append(m)
            last = m
    return sent


MINUTES = "alert_rule_id string, cooldown_minutes int, minute long, firings long"


def test_cooldown_equals_brute_force(spark):
    rnd = random.Random(7)
    data, expected = [], {}
    for rule, cooldown in (("a", 5), ("b", 60), ("c", None)):
        minutes = sorted(rnd.sample(range(2000), 300))
        data += [(rule, cooldown, m, 1) for m in minutes]
        expected[rule] = brute_cooldown(minutes, cooldown or 0)
    out = alerts.apply_cooldown(spark.createDataFrame(data, MINUTES)).where("sent").collect()
    assert {r: sorted(x.minute for x in out if x.alert_rule_id == r) for r in expected} == expected


def test_cooldown_continues_from_the_last_alert(spark):
    minutes = list(range(0, 100, 7))
    whole = alerts.apply_cooldown(spark.createDataFrame([("r", 20, m, 1) for m in minutes], MINUTES))
    first = alerts.apply_cooldown(spark.createDataFrame([("r", 20, m, 1) for m in minutes if m < 50], MINUTES)).where("sent")
    last = first.groupBy("alert_rule_id").agg(F.max("minute").alias("last_sent"))
    second = alerts.apply_cooldown(spark.createDataFrame([("r", 20, m, 1) for m in minutes if m >= 50], MINUTES), last).where("sent")
    split = sorted(r.minute for df in (first, second) for r in df.collect())
    assert split == sorted(r.minute for r in whole.where("sent").collect()) == brute_cooldown(minutes, 20)


def test_firings_collapse_to_minutes(spark, rows):
    df = spark.sql(
        """SELECT 'r' AS alert_rule_id, 5 AS cooldown_minutes, CAST(t AS TIMESTAMP_NTZ) AS fired_at FROM
        VALUES ('2024-01-01 00:00:05'), ('2024-01-01 00:00:59'), ('2024-01-01 00:01:00') v(t)"""
    )
    assert [r[-1] for r in rows(alerts.firing_minutes(df))] == [2, 1]


def test_retry_takes_the_most_specific_policy(spark):
    runs_ = spark.createDataFrame(
        [("e1", "podA", "x", "s", "TIMEOUT", 2), ("e2", "podA", "y", "s", "TIMEOUT", 1), ("e3", "podB", "y", "s", "OTHER", 0),
         ("e4", "podB", "y", "s", "TIMEOUT", 9), ("e5", "podB", "y", "unknown", "TIMEOUT", 0)],
        "execution_id string, pod_id string, company string, stage string, error_type string, retry_count int",
    )
    policies = spark.createDataFrame(
        [("company", None, "x", "s", 3, 10, True, 2.0, ["TIMEOUT"], True), ("pod", "podA", None, "s", 3, 7, False, None, ["TIMEOUT"], True),
         ("any", None, None, "s", 3, 1, True, 3.0, ["TIMEOUT"], True), ("off", "podA", "x", "s", 3, 1, True, 3.0, ["TIMEOUT"], False)],
        alerts.RETRY_POLICY,
    )
    out = {r.execution_id: r for r in alerts.retry_decisions(runs_, policies).collect()}
    assert (out["e1"].policy_id, out["e1"].next_delay_seconds) == ("company", 40.0)
    assert (out["e2"].policy_id, out["e2"].next_delay_seconds) == ("pod", 7.0)
    assert (out["e3"].policy_id, out["e3"].will_retry, out["e3"].retryable) == ("any", False, False)
    assert (out["e4"].exhausted, out["e4"].will_retry) == (True, False)
    assert (out["e5"].policy_id, out["e5"].will_retry) == (None, False)


def test_active_alerts_order(spark):
    rows = [
        ("1", "n", "COST", None, None, None, None, 1.0, "EQUALS", s, "EMAIL", on, 1)
        for s, on in (("INFO", True), ("CRITICAL", True), ("WARNING", True), ("CRITICAL", False))
    ]
    df = spark.createDataFrame(rows, alerts.ALERT_RULE)
    assert [r.severity for r in alerts.active_alerts(df).collect()] == ["CRITICAL", "WARNING", "INFO"]
    assert [r.severity for r in alerts.active_alerts(df, alphabetical=True).collect()] == ["WARNING", "INFO", "CRITICAL"]


def test_closing_runs(frames):
    log = frames.execution_log
    closed = runs.close_runs(runs.start_events(log), runs.end_events(log))
    assert closed.count() == log.count()
    row = closed.where("status = 'SUCCESS'").first()
    assert row.custom_dimensions["rows"] == str(row.output_row_count) and "owner" in row.custom_dimensions
    orphan = runs.close_runs(runs.start_events(log.limit(0)), runs.end_events(log))
    assert orphan.where("company <> 'Unknown'").count() == 0


def test_truncated_mean(spark):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert tuple(df.agg(runs.average("x"), runs.average("x", truncate=True)).first()) == (1.5, 1)


def test_lineage_balances(frames):
    row = runs.lineage_reconciliation(frames.execution_log).agg(F.sum("unbalanced_runs")).first()
    assert row[0] == 0


def test_failed_runs_are_closed_and_unknown_ones_recorded(frames):
    log = frames.execution_log
    starts = runs.start_events(log.where("company_key % 2 = 0"))
    closed = runs.close_runs(starts, runs.end_events(log), runs.error_events(log))
    told = {r.execution_id: r for r in log.collect()}
    for r in closed.collect():
        run = told[r.execution_id]
        assert r.status == run.status
        assert r.error_message == run.error_message
        assert (r.company == "Unknown") == (run.company_key % 2 != 0)
    # Of an end and an error at one moment, the error counts.
    both = runs.error_events(log).limit(1)
    end = both.select("execution_id", "event_time").selectExpr("*", "'END' AS event", "'SUCCESS' AS status", "map('a','b') AS dimensions")
    row = runs.close_runs(runs.start_events(log.limit(0)), end, both).first()
    assert row.status == "FAILED" and row.duration_seconds == 0


def test_null_keys_match_open_rules_only(spark):
    rules = [
        ("any", "n", "ERROR_RATE", None, None, None, None, 50.0, "GREATER_THAN", "INFO", "EMAIL", True, 1),
        ("pod", "n", "ERROR_RATE", "p", None, None, None, 50.0, "GREATER_THAN", "INFO", "EMAIL", True, 1),
        ("company", "n", "ERROR_RATE", None, "c1", None, None, 50.0, "GREATER_THAN", "INFO", "EMAIL", True, 1),
        ("domain", "n", "ERROR_RATE", None, None, "hr", None, 50.0, "GREATER_THAN", "INFO", "EMAIL", True, 1),
    ]
    log = spark.createDataFrame(
        [("e1", "p", None, "hr", "s", "FAILED"), ("e2", None, "c1", None, None, "FAILED"), ("e3", None, None, None, None, "FAILED")],
        "execution_id string, pod_id string, company string, domain string, stage string, status string",
    ).selectExpr(
        "*", "1 AS execution_duration_seconds", "1 AS data_quality_score", "1 AS dbu_consumed", "TIMESTAMP_NTZ '2024-01-01' AS execution_start_time",
        "TIMESTAMP_NTZ '2024-01-01' AS execution_end_time", "TIMESTAMP_NTZ '2024-01-01' AS file_arrival_time",
    )
    fired = alerts.evaluate_alerts(log, spark.createDataFrame(rules, alerts.ALERT_RULE)).collect()
    assert sorted((r.execution_id, r.alert_rule_id) for r in fired) == [
        ("e1", "any"), ("e1", "domain"), ("e1", "pod"), ("e2", "any"), ("e2", "company"), ("e3", "any"),
    ]


def test_runs_without_configuration_stay(spark, frames):
    log, config = frames.execution_log, frames.company_config.limit(2)
    joined = runs.with_config(log, config, ["cost_center", "sla_hours"])
    assert joined.count() == log.count()
    assert joined.where("NOT configured AND (cost_center <> 'UNASSIGNED' OR sla_hours IS NOT NULL)").count() == 0
    costs = runs.cost_records(log, config)
    assert costs.count() == log.count()


LOG = """execution_id string, pod_id string, company string, domain string, stage string, execution_start_time timestamp_ntz,
    execution_end_time timestamp_ntz, file_arrival_time timestamp_ntz, execution_duration_seconds int,
    data_quality_score double, status string, dbu_consumed double"""
PICKED = ["alert_rule_id", "execution_id", "metric_value"]


def random_log(spark, n, seed=1):
    rnd, start = random.Random(seed), dt.datetime(2024, 1, 1)
    data = []
    for i in range(n):
        at = start + dt.timedelta(seconds=37 * i)
        data.append((
            f"e{i}", rnd.choice(["a", "b", None]), rnd.choice(["x", "y", None]), rnd.choice(["hr", "pay"]), rnd.choice(["s", None]),
            at, rnd.choice([None, at + dt.timedelta(seconds=rnd.randrange(9))]), at, rnd.choice([None, 0, 5, 10]),
            rnd.choice([None, 80.0, 90.0, float("nan")]), rnd.choice(["OK", "FAILED"]), rnd.choice([None, 0.5, 1.5]),
        ))
    return spark.createDataFrame(data, LOG)


def random_rules(spark, n, seed=2):
    rnd = random.Random(seed)
    data = [
        (f"r{i}", "n", rnd.choice(["DURATION", "QUALITY", "ERROR_RATE", "COST", "SLA", "UNKNOWN"]), rnd.choice([None, None, "a", "b"]),
         rnd.choice([None, None, "x"]), rnd.choice([None, None, "hr"]), rnd.choice([None, None, "s"]),
         rnd.choice([0.0, 0.5, 1.0, 5.0, 85.0, 90.0, 100.0]), rnd.choice(["GREATER_THAN", "LESS_THAN", "EQUALS", "OTHER"]),
         "HIGH", "mail", rnd.random() < 0.9, rnd.choice([None, 3]))
        for i in range(n)
    ]
    return spark.createDataFrame(data, alerts.ALERT_RULE)


def brute_firings(log, rules):
    runs_ = log.select("execution_id", *alerts.KEYS, *[v.alias(k) for k, v in alerts.metric_values().items()])
    out, active, metrics = [], rules.where("enabled").collect(), set(alerts.metric_values())
    for run in runs_.collect():
        for rule in active:
            v = run[rule.rule_type] if rule.rule_type in metrics else None
            if v is None or any(rule[k] is not None and rule[k] != run[k] for k in alerts.KEYS):
                continue
            v, t = (math.inf if math.isnan(v) else v), rule.threshold_value
            if {"GREATER_THAN": v > t, "LESS_THAN": v < t, "EQUALS": v == t}.get(rule.threshold_operator):
                out.append((rule.alert_rule_id, run.execution_id))
    return sorted(out)


@pytest.mark.parametrize("most_broadcast", [1000, 10])
def test_firings_equal_brute_force(spark, rows, most_broadcast):
    log, rules = random_log(spark, 150), random_rules(spark, 120)
    found = alerts.evaluate_alerts(log, rules, most_broadcast)
    expected = brute_firings(log, rules)
    assert len(expected) > 500 and rows(found, "alert_rule_id", "execution_id") == expected


def test_no_rules_fire_nothing(spark):
    log = random_log(spark, 5)
    assert alerts.evaluate_alerts(log, random_rules(spark, 3).limit(0)).count() == 0
    assert alerts.evaluate_alerts(log.limit(0), random_rules(spark, 3)).count() == 0


def test_a_run_stays_one_row_whatever_the_number_of_open_rules(spark, plan):
    log = random_log(spark, 300)
    anywhere = [(f"r{i}", "n", "DURATION", None, None, None, None, float(i), "GREATER_THAN", "HIGH", "mail", True, 1) for i in range(10_000)]
    found = alerts.evaluate_alerts(log, spark.createDataFrame(anywhere, alerts.ALERT_RULE))
    # Durations of 10 lie above the ten lowest thresholds, durations of 5 above five.
    counts = {r[0]: r[1] for r in log.groupBy("execution_duration_seconds").count().collect()}
    assert found.count() == 10 * counts[10] + 5 * counts[5]
    # Rules are copied a fixed number of times; runs are turned into rows by their firings alone.
    text = plan(found)
    assert text.count("Generate explode") == 2
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
