"""Rule engine, reports, keyed updates and config checks."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators import quality, tenants, upsert
from silverlode.sources import sinks

STAFF = "id string, email string, salary string, dept string"


def staff(spark):
    return spark.createDataFrame(
        [("1", "a@b.co", "10", "d1"), ("1", "bad", "20", "d1"), (None, "c@d.co", "0", "d9"), ("3", None, "x", None)], STAFF
    )


def rules(spark):
    parents = spark.createDataFrame([("d1",), ("d1",)], "dept string")
    return [
        quality.not_null("id"),
        quality.matches("email", "@", severity="WARNING", action=quality.QUARANTINED),
        quality.in_range("salary", 0, 100),
        quality.unique("id", severity="WARNING", action=quality.ACCEPTED_WITH_WARNING),
        quality.references("dept", parents, "dept", severity="INFO", action=quality.ACCEPTED_WITH_WARNING),
    ]


def test_rule_engine_counts(spark):
    log = {r.rule_name: r for r in quality.check_rules(staff(spark), rules(spark)).collect()}
    failed = {k: r.records_failed for k, r in log.items()}
    assert failed == {"id_not_null": 1, "email_format": 2, "salary_range": 2, "id_unique": 2, "dept_reference": 2}
    assert all(r.records_checked == 4 and r.records_passed + r.records_failed == 4 for r in log.values())
    assert log["dept_reference"].error_sample == "NULL" and log["id_not_null"].action_taken == "REJECTED"


def test_routing_keeps_every_row_once(spark):
    routed = quality.route_rows(staff(spark), rules(spark))
    parts = quality.split_by_disposition(routed)
    counts = {k: df.count() for k, df in parts.items()}
    assert counts == {"accepted": 1, "quarantined": 1, "rejected": 2}
    assert sum(counts.values()) == routed.count() == 4


def test_contract_rules(spark):
    schema = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("salary", T.DecimalType(10, 2), True)])
    log = quality.check_rules(staff(spark), quality.contract_rules(schema, {"email": 3}, key="id"))
    failed = {r.rule_name: r.records_failed for r in log.collect()}
    assert failed == {"id_required": 1, "id_type": 0, "salary_type": 1, "email_length": 2, "id_unique": 2}


def test_duplicates_option(spark):
    df = spark.createDataFrame([("1",), ("1",), (None,), (None,)], "employee_id string").select(
        "employee_id", *[F.lit(None).cast("string").alias(c) for c in ("hire_date", "salary", "email")]
    )

    def duplicates(**kw):
        report = quality.profile_employees(df, "2025-01-01", **kw)
        return report.where("issue_type = 'Duplicate Records'").first().record_count

    assert duplicates() == 1
    assert duplicates(count_nulls_as_duplicates=True) == 3


def test_empty_table_reports_zero_percent(spark):
    empty = spark.createDataFrame([], "x int")
    row = quality.cleansing_impact(empty, empty).first()
    assert (row.bronze_row_count, row.filter_percentage) == (0, 0)
    assert quality.dependency_check({"t": empty}).first().status == "FAIL - t is empty"


def test_integrity_is_true_containment(spark):
    staff_ = spark.createDataFrame([(1,), (2,), (3,)], "employee_id long")
    paid = spark.createDataFrame([(1,), (9,)], "employee_id long")  # fewer people, yet one is unknown
    row = quality.integrity_check(paid, staff_).first()
    assert row.orphaned_employees == 1 and row.integrity_status.startswith("FAIL")
    assert quality.integrity_check(staff_, staff_).first().integrity_status.startswith("PASS")


def pairs(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, p string, v int, w int")


def test_upsert_updates_inserts_and_keeps(spark, rows):
    target = pairs(spark, ("a", "x", 1, 1), ("b", "x", 2, 2), (None, "x", 3, 3))
    source = pairs(spark, ("b", "x", 20, 20), (None, "x", 30, None), ("c", "x", 40, 40))
    out = upsert.upsert(target, source, ["k", "p"])
    assert rows(out) == sorted(
        [("a", "x", 1, 1), ("b", "x", 20, 20), (None, "x", 30, None), ("c", "x", 40, 40)], key=repr
    )
    assert rows(upsert.upsert(out, source, ["k", "p"])) == rows(out)
    partial = upsert.upsert(target, source, ["k", "p"], ["v"])
    assert ("b", "x", 20, 2) in rows(partial) and ("c", "x", 40, 40) in rows(partial)


def test_latest_row_and_ambiguous_keys(spark, rows):
    df = pairs(spark, ("a", "x", 1, 5), ("a", "x", 1, 7), ("a", "x", 0, 9), ("b", "y", 1, 1))
    assert rows(upsert.latest_per_key(df, ["k", "p"], ["v"])) == [("a", "x", 1, 7), ("b", "y", 1, 1)]
    assert rows(upsert.ambiguous_keys(df, ["k", "p"])) == [("a", "x", 3)]


def test_change_feed_replays_to_the_new_snapshot(spark, rows):
    before = pairs(spark, ("a", "x", 1, 1), ("b", "x", 2, 2), ("c", "x", None, 3))
    after = pairs(spark, ("a", "x", 1, 1), ("b", "x", 9, 2), ("d", "x", 4, 4))
    feed = upsert.change_feed(before, after, ["k", "p"], ["v", "w"])
    assert rows(feed) == sorted(
        [("insert", "d", "x", 4, 4), ("delete", "c", "x", None, 3), ("update_preimage", "b", "x", 2, 2),
         ("update_postimage", "b", "x", 9, 2)], key=repr
    )
    kept = before.join(feed.where("change_type in ('delete', 'update_preimage')").select("k"), "k", "left_anti")
    added = feed.where("change_type in ('insert', 'update_postimage')").drop("change_type")
    assert rows(kept.unionByName(added), "k", "v", "w") == rows(after, "k", "v", "w")


def test_fold_keeps_the_latest_known_value(spark):
    events = spark.createDataFrame(
        [("r", 1, "RUNNING", None), ("r", 2, "SUCCESS", 5), ("r", 3, None, 6), ("s", 1, "RUNNING", None)],
        "id string, at int, status string, n int",
    )
    out = {r.id: (r.status, r.n) for r in upsert.fold_events(events, "id", ["at"], ["status", "n"]).collect()}
    assert out == {"r": ("SUCCESS", 6), "s": ("RUNNING", None)}


def test_update_where_ignores_unknown_conditions(spark, rows):
    df = pairs(spark, ("a", "x", 1, 1), ("b", "x", None, 2))
    assert rows(upsert.update_where(df, F.col("v") > 0, {"w": F.lit(0)}), "k", "w") == [("a", 0), ("b", 2)]


# The ten configured companies, four, three and three per pod.
COMPANIES = [("podA", 4), ("podB", 3), ("podC", 3)]


def config(spark, **changes):
    rows = []
    for pod, n in COMPANIES:
        for i in range(n):
            row = {
                "company_id": f"{pod}-c{i}", "pod_id": pod, "company": f"c{i}", "enabled": True, "worker_count": 2,
                "domains": ["hr", "payroll"], "priority": "HIGH", "data_classification": "INTERNAL",
                "autoscale_min_workers": 1, "autoscale_max_workers": 2, "estimated_monthly_gb": 10.0, "sla_hours": 4,
            }
            rows.append({**row, **changes} if (pod, i) == ("podC", 2) else row)
    schema = (
        "company_id string, pod_id string, company string, enabled boolean, worker_count int, domains array<string>, priority string, "
        "data_classification string, autoscale_min_workers int, autoscale_max_workers int, estimated_monthly_gb double, sla_hours int"
    )
    return spark.createDataFrame([tuple(r.values()) for r in rows], schema)


def test_companies_per_pod(spark, rows):
    assert rows(tenants.pod_statistics(config(spark)), "pod_id", "company_count") == COMPANIES


def test_config_rules_find_each_offence(spark):
    def broken(**kw):
        return [r.rule_name for r in quality.validate_config(config(spark, **kw)).where("status = 'FAIL'").collect()]

    assert broken() == []
    assert broken(worker_count=11) == ["worker_count_range"]
    assert broken(domains=[]) == ["empty_domains"]
    assert broken(priority="URGENT") == ["invalid_priority"]
    assert broken(data_classification="SECRET") == ["invalid_classification"]
    assert broken(autoscale_min_workers=3) == ["autoscale_inverted"]
    assert broken(company_id="podA-c0") == ["duplicate_company_id"]


def test_completeness_waits_for_the_last_domain(spark):
    schema = "pod_id string, company string, domain string, file_name string"
    first = [("podA", "c0", "hr", "hr.csv"), ("podA", "c0", "payroll", "notes.txt")]
    gate = tenants.completeness_gate(config(spark), spark.createDataFrame(first, schema))
    row = gate.where("pod_id = 'podA' AND company = 'c0'").first()
    assert (row.status, row.missing_domains, row.found_domains, row.domains_to_process) == ("INCOMPLETE", ["payroll"], ["hr"], [])
    later = spark.createDataFrame([*first, ("podA", "c0", "payroll", "p.parquet")], schema)
    done = tenants.completeness_gate(config(spark), later)
    assert [tuple(r) for r in tenants.work_list(done).orderBy("domain").collect()] == [("podA", "c0", "hr"), ("podA", "c0", "payroll")]
    assert gate.count() == 10


def test_priority_order(spark):
    cfg = config(spark, pod_id="podA", company="aa", priority="LOW")
    assert [r.priority for r in tenants.enabled_companies(cfg, "podA").collect()] == ["HIGH"] * 4 + ["LOW"]
    assert [r.priority for r in tenants.enabled_companies(cfg, "podA", alphabetical=True).collect()][0] == "LOW"


def test_upsert_refuses_several_rows_for_a_key(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (3, "z")], "k int, v string")
    with pytest.raises(Exception, match="several rows for key"):
        upsert.upsert(target, twice, ["k"]).collect()
    latest = upsert.upsert(target, twice, ["k"], newest_first=["v"])
    assert sorted(map(tuple, latest.collect())) == [(1, "y"), (2, "b"), (3, "z")]


def test_counts_of_rules_equal_flagged_rows(spark, rows):
    rnd = random.Random(4)
    data = [
        (rnd.choice([None, "hot", "hot", *"abcdefgh"]), rnd.choice([None, "1", "2", "9", "x"]), rnd.choice([None, "5", "-3", "oops"]))
        for _ in range(400)
    ]
    df = spark.createDataFrame(data, "k string, parent string, v string").repartition(4)
    parents = spark.createDataFrame([(1,), (2,), (2,), (None,), (77,)], "id int")
    rules = [
        quality.not_null("k"), quality.unique("k"), quality.references("parent", parents, "id"), quality.in_range("v", 0, 10),
        quality.matches("parent", "^[0-9]$"),
    ]
    flagged = quality.flag_failures(df, rules).toPandas()
    for r in quality.check_rules(df, rules).collect():
        bad = flagged[flagged[f"_failed_{r.rule_name}"]][r.column_name]
        assert (r.records_checked, r.records_failed) == (400, len(bad))
        assert r.error_sample == min(["NULL" if v is None else v for v in bad])
    empty = quality.check_rules(df.limit(0), rules).collect()
    assert [(r.records_checked, r.records_failed, r.error_sample) for r in empty] == [(0, 0, None)] * 5


def test_routed_rows_are_written_once(spark, tmp_path, rows):
    df = spark.createDataFrame([("1", "a@b.cd"), ("1", "x"), (None, "a@b.cd"), ("2", "a@b.cd")], "k string, mail string")
    rules = [quality.not_null("k"), quality.matches("mail", "@", action=quality.QUARANTINED)]
    quality.write_routed(df, rules, f"{tmp_path}/out")
    assert rows(quality.routed_counts(spark, f"{tmp_path}/out")) == [("accepted", 2), ("quarantined", 1), ("rejected", 1)]
    quality.write_routed(df.where("k = '2'"), rules, f"{tmp_path}/out")
    assert rows(quality.routed_counts(spark, f"{tmp_path}/out")) == [("accepted", 1), ("quarantined", 0), ("rejected", 0)]


def test_writes_tell_what_was_sent_and_found(spark, tmp_path):
    df = spark.range(100).withColumn("p", F.col("id") % 3)
    assert sinks.overwrite_verified(df, f"{tmp_path}/a", ["p"]) == (100, 100)
    assert sinks.overwrite_verified(df.limit(0), f"{tmp_path}/a") == (0, 0)
