"""Plans must stay free of constructs that do not scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.operators import alerts, gold, quality, upsert
from silverlode.plans import catalog
from silverlode.plans.catalog_governance import alert_rules, firings, retry_policies
from silverlode.plans.catalog_quality import hr_rules, waves
from silverlode.plans.frames import POD, PROCESSED_AT
from silverlode.sources import files, sinks

EAGER = ("src_", "snk_", "st_", "fi_1_manifest_from", "fi_8", "b2s_8", "dq_10_split", "dq_15", "tm_9_table", "tm_11", "ud_3")
LAZY = sorted(n for n in catalog.QUERIES if not n.startswith(EAGER))


@pytest.mark.parametrize("name", LAZY)
def test_no_nested_loops_and_no_row_python(frames, plan, name):
    text = plan(catalog.QUERIES[name].build(frames))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert bad not in text


def test_latest_row_is_limited_before_the_shuffle(frames, plan):
    text = plan(frames.silver_payroll)
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_top_n_is_limited_before_the_shuffle(frames, plan):
    top = gold.top_n_per_group(frames.silver_hr, ["department"], [F.col("salary").desc()], 3)
    assert len(re.findall(r"WindowGroupLimit.*Partial", plan(top))) >= 2


def test_tenant_filter_prunes_partitions(spark, tmp_path, frames, plan):
    path = f"file://{tmp_path}/runs"
    sinks.overwrite(frames.execution_log.select("execution_id", "pod_id"), path, ["pod_id"])
    text = plan(files.read_tenant(spark, path, "podB"))
    assert re.search(r"PartitionFilters: \[[^\]]*pod_id[^\]]*podB", text)


def test_scan_reads_only_needed_columns(frames, plan):
    text = plan(frames.execution_log.select("execution_id", "pod_id"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"event_id", "user_id"}


def test_filters_reach_the_parquet_scan(frames, plan):
    text = plan(frames.table("events").where("event_type = 'error'").select("event_id"))
    assert "EqualTo(event_type,error)" in text


def test_issue_report_scans_once(frames, plan):
    assert plan(quality.profile_employees(frames.bronze_hr, "2001-01-01")).count("FileScan parquet [c_") == 1


def test_monthly_trend_has_one_payment_branch(frames, plan):
    text = plan(gold.monthly_payroll_trends(frames.silver_hr, frames.silver_payroll, POD, PROCESSED_AT))
    assert text.count("FileScan parquet [o_") == 1


def test_pay_is_reduced_before_it_meets_staff(frames, plan):
    text = plan(gold.employee_payroll_summary(frames.silver_hr, frames.silver_payroll, POD, PROCESSED_AT))
    top_join = text.index("Join")
    assert "partial_sum(gross_pay" in text[top_join:]


def test_upsert_is_one_equi_join(frames, plan):
    first, second = waves(frames)
    text = plan(upsert.upsert(first, second, ["employee_id", "pod_id"]))
    assert len(re.findall(r"(SortMergeJoin|ShuffledHashJoin).*FullOuter", text)) == 1


def test_wildcard_rules_join_on_equality(frames, plan):
    for df in (firings(frames), alerts.retry_decisions(frames.execution_log, retry_policies(frames))):
        text = plan(df)
        assert "NestedLoop" not in text and "Cartesian" not in text


def test_only_counted_rules_are_broadcast_by_force(frames):
    rules = alert_rules(frames)
    routed = quality.route_rows(frames.bronze_hr, hr_rules(frames))
    many = alerts.evaluate_alerts(frames.execution_log, rules, most_broadcast=rules.where("enabled").count() - 1)
    for df in (routed, many):
        assert "ResolvedHint" not in df._jdf.queryExecution().analyzed().toString()


def hash_shuffles(text):
    return len(re.findall(r"Exchange hashpartitioning", text))


def test_rules_are_counted_in_one_scan_without_joins(frames, plan):
    text = plan(quality.check_rules(frames.bronze_hr, hr_rules(frames)))
    own, parents = plan(frames.bronze_hr), plan(frames.silver_hr.select("employee_id"))
    for step in ("FileScan", "HashJoin", "SortMergeJoin"):
        assert text.count(step) == own.count(step) + parents.count(step)
    # Shuffles by (rule, key) and by rule, besides those of the parents.
    assert hash_shuffles(text) <= 2 + hash_shuffles(plan(frames.silver_hr.select("employee_id")))


def test_contracts_are_counted_in_one_scan(frames, plan):
    rules = quality.contract_rules(T.StructType.fromDDL("employee_id bigint, salary decimal(10,2)"), key="employee_id")
    text = plan(quality.check_rules(frames.bronze_hr, rules))
    assert text.count("FileScan") == plan(frames.bronze_hr).count("FileScan") and hash_shuffles(text) == 2


def test_rows_without_a_key_are_spread_before_a_reference_join(spark, plan):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        rows = spark.createDataFrame([(None if i % 3 else str(i), i) for i in range(300)], "p string, i int").repartition(5)
        parents = spark.createDataFrame([(str(i),) for i in range(0, 300, 2)], "q string")
        rules = [quality.references("p", parents, "q"), quality.unique("i")]
        text = plan(quality.flag_failures(rows, rules))
        assert re.search(r"hashpartitioning\(_key_p_reference#\d+, _spread_p_reference#\d+", text)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
