"""Governance queries: tenants, runs, lineage, SLA, cost, alerts, retries, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.operators import alerts, retention, runs, tenants, upsert
from silverlode.sources import files

from .frames import RUNS_AS_OF
from .oracle import dbl, pct, txt
from .registry import query

RUNS_DAY = "2024-01-31"
STAMP = "'%Y-%m-%d %H:%M:%S'"


def joined(*columns: str):
    """Array columns as comma-separated text."""
    return {c: F.concat_ws(",", c) for c in columns}


# ---- tenants ------------------------------------------------------------------------


@query(
    "gov_1_enabled_companies",
    """SELECT company_id, company, worker_count, array_to_string(domains, ',') AS domains, priority, sla_hours
    FROM company_config WHERE pod_id = 'podA' AND enabled""",
)
def gov_1(t):
    return tenants.enabled_companies(t.company_config, "podA").withColumns(joined("domains"))


@query(
    "gov_1_enabled_companies_json",
    """SELECT company_id, '{"company":"' || company || '","worker_count":' || worker_count || ',"domains":[' ||
    coalesce(array_to_string(list_transform(domains, lambda d: '"' || d || '"'), ','), '') || ']}' AS json
    FROM company_config WHERE pod_id = 'podA' AND enabled""",
)
def gov_1_json(t):
    return tenants.enabled_companies_json(t.company_config, "podA")


@query(
    "gov_2_high_priority_by_sla",
    f"""SELECT pod_id, company, data_classification, sla_hours, {dbl('estimated_monthly_gb')} AS estimated_monthly_gb,
    array_to_string(compliance_tags, ',') AS compliance_tags FROM company_config WHERE enabled AND priority = 'HIGH'""",
)
def gov_2(t):
    return tenants.high_priority_by_sla(t.company_config).withColumns(joined("compliance_tags"))


@query(
    "gov_3_cluster_settings",
    """SELECT company_id, worker_node_type, autoscale_min_workers, autoscale_max_workers, spot_instances_enabled
    FROM company_config WHERE enabled AND pod_id = 'podA'""",
)
def gov_3(t):
    return tenants.cluster_settings(t.company_config, "podA")


@query(
    "gov_4_chargeback_listing",
    f"""SELECT pod_id, company, business_unit, cost_center, {dbl('estimated_monthly_gb')} AS estimated_monthly_gb, data_classification
    FROM company_config WHERE enabled""",
)
def gov_4(t):
    return tenants.chargeback_listing(t.company_config)


@query(
    "gov_5_compliance",
    """SELECT company_id, business_unit, data_classification, array_to_string(compliance_tags, ',') AS compliance_tags
    FROM company_config WHERE enabled AND list_contains(compliance_tags, 'GDPR')""",
)
def gov_5(t):
    return tenants.requiring_compliance(t.company_config, "GDPR").withColumns(joined("compliance_tags"))


@query(
    "gov_6_simple_view",
    """SELECT company_id, pod_id, company, enabled, worker_count, array_to_string(domains, ',') AS domains, priority, sla_hours,
    driver_node_type, worker_node_type, autoscale_min_workers, autoscale_max_workers, spot_instances_enabled,
    data_classification, cost_center FROM company_config WHERE enabled""",
)
def gov_6(t):
    return tenants.simple_view(t.company_config).withColumns(joined("domains"))


@query(
    "gov_7_pod_statistics",
    f"""SELECT pod_id, count(*) AS company_count, CAST(sum(worker_count) AS BIGINT) AS total_workers,
    {dbl('sum(estimated_monthly_gb)')} AS total_gb_monthly FROM company_config GROUP BY 1""",
)
def gov_7(t):
    return tenants.pod_statistics(t.company_config)


@query(
    "gov_7_label_statistics",
    """SELECT 'priority' AS dimension, priority AS label, count(*) AS company_count FROM company_config GROUP BY 2
    UNION ALL SELECT 'data_classification', data_classification, count(*) FROM company_config GROUP BY 2""",
)
def gov_7_labels(t):
    return tenants.label_statistics(t.company_config)


@query(
    "gov_8_cost_center_rollup",
    f"""SELECT business_unit, cost_center, count(*) AS company_count, {dbl('sum(estimated_monthly_gb)')} AS total_gb_monthly,
    CAST(sum(worker_count) AS BIGINT) AS total_workers FROM company_config WHERE enabled GROUP BY 1, 2""",
)
def gov_8(t):
    return tenants.cost_center_rollup(t.company_config)


@query(
    "gov_9_monthly_cost_estimate",
    f"""SELECT company_id, business_unit, {dbl('worker_count * 730 * 0.20')} AS estimated_monthly_cost_usd,
    {dbl('estimated_monthly_gb')} AS estimated_monthly_gb FROM company_config WHERE enabled""",
)
def gov_9(t):
    return tenants.monthly_cost_estimate(t.company_config)


@query(
    "gov_10_guideline_check",
    """SELECT company_id, lo AS recommended_min_workers, hi AS recommended_max_workers, worker_count BETWEEN lo AND hi AS workers_conform,
    sf AS sla_from, st AS sla_to, coalesce(sla_hours BETWEEN sf AND st, false) AS sla_conforms FROM (
    SELECT *, CASE WHEN estimated_monthly_gb < 50 THEN 1 WHEN estimated_monthly_gb < 150 THEN 2 WHEN estimated_monthly_gb < 300 THEN 3 ELSE 5 END AS lo,
    CASE WHEN estimated_monthly_gb < 50 THEN 1 WHEN estimated_monthly_gb < 150 THEN 2 WHEN estimated_monthly_gb < 300 THEN 4 ELSE 10 END AS hi,
    CASE priority WHEN 'HIGH' THEN 2 WHEN 'MEDIUM' THEN 6 WHEN 'LOW' THEN 12 END AS sf,
    CASE priority WHEN 'HIGH' THEN 4 WHEN 'MEDIUM' THEN 8 WHEN 'LOW' THEN 24 END AS st FROM company_config)""",
)
def gov_10(t):
    return tenants.guideline_check(t.company_config)


GATE_SQL = """gate AS (SELECT c.pod_id, c.company, c.domains,
    list_filter(c.domains, lambda d: NOT list_contains(coalesce(f.found, CAST([] AS VARCHAR[])), d)) AS missing,
    list_filter(c.domains, lambda d: list_contains(coalesce(f.found, CAST([] AS VARCHAR[])), d)) AS found
    FROM company_config c LEFT JOIN (SELECT pod_id, company, list(DISTINCT domain) AS found FROM bronze_files
      WHERE file_name LIKE '%.csv' OR file_name LIKE '%.parquet' GROUP BY 1, 2) f ON c.company = f.company AND c.pod_id = f.pod_id
    WHERE c.enabled)"""


@query(
    "gov_11_completeness_gate",
    f"""WITH {GATE_SQL} SELECT pod_id, company, CASE WHEN len(missing) = 0 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status,
    CASE WHEN len(missing) = 0 THEN coalesce(array_to_string(domains, ','), '') ELSE '' END AS domains_to_process,
    coalesce(array_to_string(missing, ','), '') AS missing_domains, coalesce(array_to_string(found, ','), '') AS found_domains FROM gate""",
)
def gov_11(t):
    gate = tenants.completeness_gate(t.company_config, t.bronze_files)
    return gate.withColumns(joined("domains_to_process", "missing_domains", "found_domains"))


@query(
    "gov_12_has_data_gate",
    """SELECT c.pod_id, c.company, coalesce(n, 0) AS file_count, coalesce(n, 0) > 0 AS has_data FROM company_config c
    LEFT JOIN (SELECT pod_id, company, count(*) AS n FROM bronze_files GROUP BY 1, 2) f ON c.pod_id = f.pod_id AND c.company = f.company
    WHERE c.enabled""",
)
def gov_12(t):
    return tenants.has_data_gate(t.company_config, t.bronze_files)


@query(
    "gov_13_work_list",
    f"WITH {GATE_SQL} SELECT pod_id, company, unnest(domains) AS domain FROM gate WHERE len(missing) = 0",
)
def gov_13(t):
    return tenants.work_list(tenants.completeness_gate(t.company_config, t.bronze_files))


# ---- run events --------------------------------------------------------------------------


@query(
    "gov_14_start_records",
    f"""SELECT execution_id, pipeline_name, pod_id, company, domain, stage, strftime(execution_start_time, {STAMP}) AS event_time,
    'START' AS event, 'RUNNING' AS status, dim_owner AS owner, execution_date FROM execution_log""",
)
def gov_14(t):
    starts = runs.start_events(t.execution_log)
    return starts.withColumn("owner", F.col("dimensions")["owner"]).drop("dimensions", *runs.START_LABELS)


@query(
    "gov_14_full_start_records",
    f"""SELECT execution_id, pipeline_name, pod_id, company, domain, stage, 'load' AS activity_name, 'run-' || company_key AS run_id,
    'bronze/' || company AS source_path, CAST(NULL AS VARCHAR) AS notebook_path, 'system' AS triggered_by, 'dev' AS environment,
    strftime(execution_start_time, {STAMP}) AS execution_start_time, 'RUNNING' AS status, 0 AS retry_count,
    {', '.join(f"CAST(NULL AS {'VARCHAR' if c == 'timestamp_ntz' or c == 'string' else 'DOUBLE' if c == 'double' else 'BIGINT'}) AS {n}" for n, c in runs.LATER.items())},
    dim_owner AS owner, '1.0.0' AS log_version, execution_date FROM execution_log""",
)
def gov_14_full(t):
    told = t.execution_log.withColumns({
        "activity_name": F.lit("load"),
        "run_id": F.concat(F.lit("run-"), F.col("company_key").cast("string")),
        "source_path": F.concat(F.lit("bronze/"), "company"),
    })
    records = runs.start_records(told)
    return records.withColumn("owner", F.col("custom_dimensions")["owner"]).drop("custom_dimensions")


@query(
    "gov_15_closed_runs",
    f"""SELECT execution_id, pipeline_name, company, strftime(execution_start_time, {STAMP}) AS execution_start_time,
    strftime(execution_end_time, {STAMP}) AS execution_end_time, coalesce(execution_duration_seconds, 0) AS duration_seconds, status,
    error_message, CASE WHEN status = 'FAILED' THEN retry_count END AS retry_count,
    CASE WHEN status = 'SUCCESS' THEN output_row_count END AS output_row_count, dim_owner AS owner,
    CASE WHEN status = 'SUCCESS' THEN CAST(output_row_count AS VARCHAR) END AS dim_rows FROM execution_log""",
)
def gov_15(t):
    log = t.execution_log
    closed = runs.close_runs(runs.start_events(log), runs.end_events(log), runs.error_events(log))
    return closed.select(
        "execution_id", "pipeline_name", "company", "execution_start_time", "execution_end_time", "duration_seconds", "status",
        "error_message", "retry_count", "output_row_count", F.col("custom_dimensions")["owner"].alias("owner"),
        F.try_element_at("custom_dimensions", F.lit("rows")).alias("dim_rows"),
    )


@query(
    "gov_16_error_records",
    f"""SELECT execution_id, strftime(execution_end_time, {STAMP}) AS event_time, 'ERROR' AS event, 'FAILED' AS status,
    error_message, retry_count FROM execution_log WHERE status = 'FAILED'""",
)
def gov_16(t):
    return runs.error_events(t.execution_log).drop("dimensions")


@query(
    "tm_6_fold_events",
    f"""SELECT execution_id, status, strftime(CASE WHEN status = 'RUNNING' THEN execution_start_time ELSE execution_end_time END, {STAMP}) AS last_event_time,
    error_message, CASE WHEN status = 'SUCCESS' THEN output_row_count END AS output_row_count FROM execution_log""",
)
def tm_6(t):
    log = t.execution_log
    # A run can end in the second it starts; the step number orders its events.
    cols = ["execution_id", "event_time", "status", "error_message", "output_row_count"]
    starts, ends, errors = (
        e.withColumn("step", F.lit(i)) for i, e in enumerate([runs.start_events(log), runs.end_events(log), runs.error_events(log)])
    )
    events = starts.unionByName(ends, allowMissingColumns=True).unionByName(errors, allowMissingColumns=True).select(*cols, "step")
    return upsert.fold_events(
        events.withColumn("last_event_time", F.col("event_time")), "execution_id", ["event_time", "step"],
        ["status", "last_event_time", "error_message", "output_row_count"],
    )


@query(
    "tm_7_end_without_start",
    f"""SELECT execution_id, CASE WHEN known THEN company ELSE 'Unknown' END AS company, CASE WHEN known THEN stage ELSE 'Unknown' END AS stage,
    status, error_message, strftime(CASE WHEN known THEN execution_start_time ELSE execution_end_time END, {STAMP}) AS execution_start_time,
    CASE WHEN known THEN coalesce(execution_duration_seconds, 0) ELSE 0 END AS duration_seconds
    FROM (SELECT *, company_key % 5 <> 0 AS known FROM execution_log) WHERE known OR status <> 'RUNNING'""",
)
def tm_7(t):
    log = t.execution_log
    starts = runs.start_events(log.where("company_key % 5 <> 0"))
    closed = runs.close_runs(starts, runs.end_events(log), runs.error_events(log))
    return closed.select("execution_id", "company", "stage", "status", "error_message", "execution_start_time", "duration_seconds")


# ---- lineage ------------------------------------------------------------------------------------


def lineage(t):
    return runs.fold_lineage(runs.lineage_steps(t.execution_log))


def _path(layer: str) -> str:
    return f"'{layer}/' || pod_id || '/' || company || '/' || domain"


LINEAGE_SQL = f"""lineage AS (SELECT execution_id, domain || '_' || company || '.csv' AS source_file_name, {_path('bronze')} AS bronze_path,
    CASE WHEN status <> 'RUNNING' THEN {_path('silver')} END AS silver_path, CASE WHEN status = 'SUCCESS' THEN {_path('gold')} END AS gold_path,
    strftime(file_arrival_time, {STAMP}) AS bronze_timestamp, strftime(CASE WHEN status <> 'RUNNING' THEN execution_start_time END, {STAMP}) AS silver_timestamp,
    strftime(CASE WHEN status = 'SUCCESS' THEN execution_end_time END, {STAMP}) AS gold_timestamp,
    input_row_count AS records_in_bronze, CASE WHEN status <> 'RUNNING' THEN output_row_count END AS records_in_silver,
    CASE WHEN status = 'SUCCESS' THEN output_row_count END AS records_in_gold,
    CASE WHEN status <> 'RUNNING' THEN rows_failed_validation END AS records_rejected,
    CASE WHEN status = 'SUCCESS' THEN date_diff('second', file_arrival_time, execution_end_time) END AS total_processing_seconds,
    CASE WHEN status = 'SUCCESS' THEN 'COMPLETED' ELSE 'IN_PROGRESS' END AS lineage_status FROM execution_log)"""


@query("gov_17_lineage", f"WITH {LINEAGE_SQL} SELECT * FROM lineage")
def gov_17(t):
    return lineage(t)


@query(
    "gov_18_lineage_of_file",
    f"""WITH {LINEAGE_SQL} SELECT source_file_name, bronze_path, silver_path, gold_path, records_in_bronze, records_in_silver, records_in_gold
    FROM lineage WHERE source_file_name = 'hr_company_3.csv' AND lineage_status = 'COMPLETED'""",
)
def gov_18(t):
    return runs.lineage_of_file(lineage(t), "hr_company_3.csv")


@query(
    "gov_19_lineage_reconciliation",
    """SELECT stage, count(*) AS runs, CAST(sum(input_row_count) AS BIGINT) AS records_in, CAST(sum(output_row_count) AS BIGINT) AS records_out,
    CAST(sum(rows_failed_validation) AS BIGINT) AS records_rejected,
    count(*) FILTER (WHERE input_row_count <> output_row_count + rows_failed_validation) AS unbalanced_runs FROM execution_log GROUP BY 1""",
)
def gov_19(t):
    return runs.lineage_reconciliation(t.execution_log)


# ---- run reports ---------------------------------------------------------------------------------------


@query(
    "gov_20_recent_runs",
    f"""SELECT execution_id, pipeline_name, pod_id, company, domain, stage, status, execution_duration_seconds, data_quality_score,
    strftime(execution_start_time, {STAMP}) AS execution_start_time FROM execution_log WHERE CAST(execution_date AS DATE) >= DATE '{RUNS_DAY}' - 7""",
)
def gov_20(t):
    return runs.recent_runs(t.execution_log, RUNS_DAY)


@query(
    "gov_21_failed_runs",
    f"""SELECT execution_id, pod_id, company, stage, error_message, retry_count FROM execution_log
    WHERE status = 'FAILED' AND CAST(execution_date AS DATE) >= DATE '{RUNS_DAY}' - 7""",
)
def gov_21(t):
    return runs.failed_runs(t.execution_log, RUNS_DAY)


@query(
    "gov_22_stage_performance",
    f"""SELECT stage, pod_id, count(*) AS execution_count, avg(execution_duration_seconds) AS avg_duration, avg(data_quality_score) AS avg_quality
    FROM execution_log WHERE status = 'SUCCESS' AND CAST(execution_date AS DATE) >= DATE '{RUNS_DAY}' - 30 GROUP BY 1, 2""",
)
def gov_22(t):
    return runs.stage_performance(t.execution_log, RUNS_DAY)


@query(
    "gov_23_cost_by_owner",
    f"""SELECT dim_owner AS owner, {dbl('sum(dbu_consumed)')} AS total_dbu, count(*) AS execution_count,
    CAST(sum(execution_duration_seconds) AS DOUBLE) / 3600 AS total_hours FROM execution_log
    WHERE CAST(execution_date AS DATE) >= DATE '{RUNS_DAY}' - 30 GROUP BY 1""",
)
def gov_23(t):
    return runs.cost_by_owner(t.execution_log, RUNS_DAY)


@query(
    "gov_24_runs_by_dimensions",
    "SELECT execution_id, status FROM execution_log WHERE dim_owner = 'team2' AND dim_priority = 'HIGH' AND execution_date >= '2024-01-10'",
)
def gov_24(t):
    picked = runs.with_dimensions(t.execution_log, owner="team2", priority="HIGH")
    return picked.where("execution_date >= '2024-01-10'").select("execution_id", "status")


# ---- SLA and cost --------------------------------------------------------------------------------------------

SLA_SQL = """sla AS (SELECT execution_id, e.pod_id, e.company, domain, sla_hours,
    CASE WHEN c.company IS NULL THEN 'UNASSIGNED' ELSE priority END AS priority, CAST(secs AS DOUBLE) / 3600 AS total_elapsed_hours,
    secs <= sla_hours * 3600 AS sla_met,
    CASE WHEN secs IS NOT NULL AND sla_hours IS NOT NULL THEN greatest(CAST(ceil((secs - sla_hours * 3600) / 60.0) AS BIGINT), 0) END AS sla_breach_minutes,
    execution_date AS sla_date
    FROM (SELECT *, date_diff('second', file_arrival_time, execution_end_time) AS secs FROM execution_log) e
    LEFT JOIN company_config c ON e.pod_id = c.pod_id AND e.company = c.company)"""


@query("gov_25_sla_evaluation", f"WITH {SLA_SQL} SELECT * FROM sla")
def gov_25(t):
    return runs.sla_evaluation(t.execution_log, t.company_config)


@query(
    "gov_26_sla_compliance",
    f"""WITH {SLA_SQL} SELECT company, priority, sla_hours, count(*) AS total_runs, count(*) FILTER (WHERE sla_met) AS sla_met_count,
    count(*) - count(sla_met) AS without_sla, {pct('count(*) FILTER (WHERE sla_met)', 'count(sla_met)')} AS sla_compliance_pct FROM sla
    WHERE CAST(sla_date AS DATE) >= DATE '{RUNS_DAY}' - 30 AND total_elapsed_hours IS NOT NULL GROUP BY 1, 2, 3""",
)
def gov_26(t):
    return runs.sla_compliance(runs.sla_evaluation(t.execution_log, t.company_config), RUNS_DAY)


COST_SQL = """costs AS (SELECT *, CAST(compute + storage AS DECIMAL(18,8)) AS total FROM (SELECT execution_id, e.pod_id, e.company, domain, dbu_consumed,
    CAST(dbu_consumed * CAST(0.15 AS DECIMAL(4,2)) AS DECIMAL(18,5)) AS compute,
    CAST(CAST(input_row_count + output_row_count AS DECIMAL(12,0)) * CAST(0.00000002 AS DECIMAL(9,8)) AS DECIMAL(18,8)) AS storage,
    CASE WHEN c.company IS NULL THEN 'UNASSIGNED' ELSE cost_center END AS cost_center,
    CASE WHEN c.company IS NULL THEN 'UNASSIGNED' ELSE business_unit END AS business_unit,
    output_row_count, substr(execution_date, 1, 7) AS billing_month, execution_date AS cost_date
    FROM execution_log e LEFT JOIN company_config c ON e.pod_id = c.pod_id AND e.company = c.company))"""


@query(
    "gov_27_cost_records",
    f"""WITH {COST_SQL} SELECT execution_id, pod_id, company, domain, {dbl('dbu_consumed')} AS dbu_consumed, {dbl('compute')} AS compute_cost_usd,
    {dbl('storage')} AS storage_cost_usd, {dbl('total')} AS total_cost_usd, cost_center, business_unit,
    CASE WHEN output_row_count > 0 THEN {dbl('total')} / output_row_count END AS cost_per_record, billing_month, cost_date FROM costs""",
)
def gov_27(t):
    return runs.cost_records(t.execution_log, t.company_config)


COST_SUM = f"{dbl('sum(total)')} AS total_cost, {dbl('sum(dbu_consumed)')} AS total_dbu, count(*) AS execution_count"


@query(
    "gov_28_cost_by_cost_center",
    f"WITH {COST_SQL} SELECT cost_center, business_unit, billing_month, {COST_SUM} FROM costs GROUP BY 1, 2, 3",
)
def gov_28(t):
    return runs.cost_by(runs.cost_records(t.execution_log, t.company_config), ["cost_center", "business_unit", "billing_month"])


@query(
    "gov_29_monthly_cost_by_business_unit",
    f"WITH {COST_SQL} SELECT business_unit, billing_month, {COST_SUM} FROM costs WHERE billing_month = '2024-01' GROUP BY 1, 2",
)
def gov_29(t):
    return runs.cost_by(runs.cost_records(t.execution_log, t.company_config), ["business_unit", "billing_month"], "2024-01")


@query(
    "gov_30_company_cost",
    """SELECT pod_id, company, round(CAST(coalesce(sum(execution_duration_seconds * worker_count), 0) AS DOUBLE) * 0.01 / 60, 6) AS total_cost
    FROM execution_log GROUP BY 1, 2""",
)
def gov_30(t):
    return runs.company_cost(t.execution_log)


# ---- alerts and retries ------------------------------------------------------------------------------------------

# Rules for the cases the alert queries must show: every operator, every metric, keys
# given alone and together, ladders of several thresholds, one rule that is off, one
# that names a tenant without runs.
ALERT_ROWS = [
    ("any-eq", "Failure of any run", "ERROR_RATE", None, None, None, None, 100.0, "EQUALS", "WARNING", "TEAMS", True, None),
    ("any-lt-1", "Score in the lowest fifth", "QUALITY", None, None, None, None, 85.0, "LESS_THAN", "WARNING", "TEAMS", True, 7),
    ("any-lt-2", "Score at the bottom", "QUALITY", None, None, None, None, 82.0, "LESS_THAN", "CRITICAL", "PHONE", True, 3),
    ("any-gt", "Answer later than half a day", "SLA", None, None, None, None, 43200.0, "GREATER_THAN", "INFO", "DIGEST", True, 90),
    ("domain-lt", "Suspiciously short run", "DURATION", None, None, "finance", None, 20.0, "LESS_THAN", "INFO", "DIGEST", True, 240),
    ("stage-gt-1", "Gold build above its share", "COST", None, None, None, "silver_to_gold", 6.25, "GREATER_THAN", "INFO", "DIGEST", True, 15),
    ("stage-gt-2", "Gold build far above its share", "COST", None, None, None, "silver_to_gold", 17.5, "GREATER_THAN", "WARNING", "TEAMS", True, 15),
    ("company-gt", "Company 11 is slow", "DURATION", None, "company_11", None, None, 700.0, "GREATER_THAN", "WARNING", "PHONE", True, 20),
    ("pod-domain-eq", "Marked score", "QUALITY", "podD", None, "payroll", None, 96.0, "EQUALS", "INFO", "DIGEST", True, 1),
    ("pod-company-stage-lt", "Cheap build", "COST", "podC", "company_12", None, "silver_to_gold", 2.0, "LESS_THAN", "INFO", "DIGEST", True, 60),
    ("all-gt", "Fully named", "DURATION", "podE", "company_4", "hr", "bronze_to_silver", 50.0, "GREATER_THAN", "CRITICAL", "PHONE", True, 5),
    ("off", "Switched off", "ERROR_RATE", None, None, None, None, -1.0, "GREATER_THAN", "CRITICAL", "PHONE", False, 2),
    ("nobody", "Tenant without runs", "COST", "podZ", None, None, None, 0.0, "GREATER_THAN", "CRITICAL", "PHONE", True, 2),
]

# Policies for the cases the retry queries must show: every combination of given keys, two
# equally general ones, one that is off, one without errors, one that allows no retry.
RETRY_ROWS = [
    ("everywhere-bronze", None, None, "bronze_to_silver", 1, 5, True, 4.0, ["SCHEMA_MISMATCH"], True),
    ("everywhere-gold-a", None, None, "silver_to_gold", 4, 75, False, None, ["TRANSIENT_ERROR", "SCHEMA_MISMATCH"], True),
    ("everywhere-gold-b", None, None, "silver_to_gold", 9, 1, True, 1.5, ["TIMEOUT"], True),
    ("pod-bronze", "podE", None, "bronze_to_silver", 0, 15, False, None, ["TIMEOUT"], True),
    ("pod-gold", "podB", None, "silver_to_gold", 5, 12, True, 1.1, None, True),
    ("company-bronze", None, "company_8", "bronze_to_silver", 3, 33, True, 2.5, ["RESOURCE_EXHAUSTED"], True),
    ("both-gold", "podD", "company_13", "silver_to_gold", 2, 8, True, None, ["TIMEOUT", "RESOURCE_EXHAUSTED"], True),
    ("both-off", "podA", "company_10", "bronze_to_silver", 7, 2, True, 3.0, ["TIMEOUT"], False),
]


def alert_rules(t):
    return files.literal_rows(t.spark, ALERT_ROWS, alerts.ALERT_RULE)


def retry_policies(t):
    return files.literal_rows(t.spark, RETRY_ROWS, alerts.RETRY_POLICY)


def _values(rows) -> str:
    def one(v):
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, list):
            return "[" + ", ".join(f"'{x}'" for x in v) + "]"
        return f"'{v}'" if isinstance(v, str) else str(v)

    return ", ".join("(" + ", ".join(one(v) for v in r) + ")" for r in rows)


RULES_SQL = f"""rules AS (SELECT * FROM (VALUES {_values(ALERT_ROWS)}) v(alert_rule_id, rule_name, rule_type, pod_id, company, domain, stage,
    threshold_value, threshold_operator, severity, notification_channel, enabled, cooldown_minutes))"""

POLICY_SQL = f"""policies AS (SELECT * FROM (VALUES {_values(RETRY_ROWS)}) v(policy_id, pod_id, company, stage, max_retry_count,
    retry_delay_seconds, exponential_backoff, backoff_multiplier, retry_on_errors, enabled))"""

METRIC_SQL = """metrics AS (SELECT execution_id, pod_id, company, domain, stage, execution_start_time AS fired_at, rule_type, v FROM (
    SELECT *, 'DURATION' AS rule_type, CAST(execution_duration_seconds AS DOUBLE) AS v FROM execution_log
    UNION ALL SELECT *, 'QUALITY', CAST(data_quality_score AS DOUBLE) FROM execution_log
    UNION ALL SELECT *, 'ERROR_RATE', CASE WHEN status = 'FAILED' THEN 100.0 ELSE 0.0 END FROM execution_log
    UNION ALL SELECT *, 'COST', CAST(dbu_consumed AS DOUBLE) FROM execution_log
    UNION ALL SELECT *, 'SLA', CAST(date_diff('second', file_arrival_time, execution_end_time) AS DOUBLE) FROM execution_log) WHERE v IS NOT NULL)"""

FIRED_SQL = f"""{RULES_SQL}, {METRIC_SQL}, fired AS (SELECT r.alert_rule_id, m.execution_id, m.pod_id, m.company, m.domain, m.stage, m.rule_type,
    m.v AS metric_value, CAST(r.threshold_value AS DOUBLE) AS threshold_value, r.severity, CAST(r.cooldown_minutes AS BIGINT) AS cooldown_minutes, m.fired_at
    FROM metrics m JOIN rules r ON r.enabled AND r.rule_type = m.rule_type AND (r.pod_id IS NULL OR r.pod_id = m.pod_id)
    AND (r.company IS NULL OR r.company = m.company) AND (r.domain IS NULL OR r.domain = m.domain) AND (r.stage IS NULL OR r.stage = m.stage)
    AND CASE r.threshold_operator WHEN 'GREATER_THAN' THEN m.v > r.threshold_value WHEN 'LESS_THAN' THEN m.v < r.threshold_value
        ELSE m.v = r.threshold_value END)"""


# The log with some companies and domains not known; only wildcards match those.
GAPS_SQL = """gaps AS (SELECT * REPLACE (CASE WHEN company_key % 7 <> 0 THEN company END AS company,
    CASE WHEN company_key % 5 <> 0 THEN domain END AS domain) FROM execution_log)"""


def with_gaps(t):
    log = t.execution_log
    return log.withColumns({
        "company": F.when(F.col("company_key") % 7 != 0, F.col("company")),
        "domain": F.when(F.col("company_key") % 5 != 0, F.col("domain")),
    })


def firings(t):
    return alerts.evaluate_alerts(t.execution_log, alert_rules(t))


@query(
    "gov_31_active_alerts_in_use",
    f"""WITH {FIRED_SQL} SELECT r.alert_rule_id, rule_name, r.rule_type, r.severity, notification_channel, coalesce(r.pod_id, 'ALL') AS pod_id,
    coalesce(r.company, 'ALL') AS company, coalesce(n, 0) AS firings FROM rules r
    LEFT JOIN (SELECT alert_rule_id, count(*) AS n FROM fired GROUP BY 1) f ON f.alert_rule_id = r.alert_rule_id WHERE enabled""",
)
def gov_31(t):
    used = firings(t).groupBy("alert_rule_id").agg(F.count("*").alias("n"))
    active = alerts.active_alerts(alert_rules(t)).join(used, "alert_rule_id", "left")
    return active.withColumn("firings", F.coalesce("n", F.lit(0))).drop("n")


@query("gov_32_alert_evaluation", f"WITH {FIRED_SQL} SELECT * REPLACE (strftime(fired_at, {STAMP}) AS fired_at) FROM fired")
def gov_32(t):
    return firings(t)


@query(
    "gov_32_alerts_without_company",
    f"""WITH {GAPS_SQL}, {FIRED_SQL.replace('FROM execution_log', 'FROM gaps')}
    SELECT * REPLACE (strftime(fired_at, {STAMP}) AS fired_at) FROM fired""",
)
def gov_32_gaps(t):
    return alerts.evaluate_alerts(with_gaps(t), alert_rules(t))


@query(
    "gov_33_alert_cooldown",
    f"""WITH RECURSIVE {FIRED_SQL}, minutes AS (SELECT alert_rule_id, any_value(cooldown_minutes) AS cooldown,
      CAST(epoch(fired_at) AS BIGINT) // 60 AS minute, count(*) AS firings FROM fired GROUP BY 1, 3),
    sent AS (SELECT alert_rule_id, min(minute) AS minute, any_value(cooldown) AS cooldown FROM minutes GROUP BY 1
      UNION ALL SELECT m.alert_rule_id, min(m.minute), any_value(s.cooldown) FROM sent s JOIN minutes m ON m.alert_rule_id = s.alert_rule_id
        AND m.minute > s.minute AND m.minute >= s.minute + coalesce(s.cooldown, 0) GROUP BY m.alert_rule_id)
    SELECT m.alert_rule_id, m.cooldown AS cooldown_minutes, m.minute, m.firings, s.minute IS NOT NULL AS sent FROM minutes m
    LEFT JOIN sent s ON s.alert_rule_id = m.alert_rule_id AND s.minute = m.minute""",
)
def gov_33(t):
    return alerts.apply_cooldown(alerts.firing_minutes(firings(t)))


RETRY_SQL = (
    f"""WITH {POLICY_SQL}, best AS (SELECT e.execution_id, p.*, row_number() OVER (PARTITION BY e.execution_id
      ORDER BY (p.company IS NULL), (p.pod_id IS NULL), p.policy_id) AS rn FROM execution_log e JOIN policies p
      ON p.enabled AND p.stage = e.stage AND (p.pod_id IS NULL OR p.pod_id = e.pod_id) AND (p.company IS NULL OR p.company = e.company)
      WHERE e.status = 'FAILED')
    SELECT execution_id, pod_id, company, stage, error_type, retry_count, policy_id, retryable, exhausted, will_retry,
      CASE WHEN will_retry THEN CASE WHEN exponential_backoff THEN retry_delay_seconds * pow(coalesce(backoff_multiplier, 1), retry_count)
        ELSE CAST(retry_delay_seconds AS DOUBLE) END END AS next_delay_seconds FROM (
      SELECT *, policy_id IS NOT NULL AND retryable AND NOT exhausted AS will_retry FROM (
        SELECT e.execution_id, e.pod_id, e.company, e.stage, e.error_type, e.retry_count, b.policy_id, b.exponential_backoff, b.retry_delay_seconds,
          b.backoff_multiplier, coalesce(list_contains(b.retry_on_errors, e.error_type), false) AS retryable,
          coalesce(e.retry_count >= b.max_retry_count, false) AS exhausted
        FROM execution_log e LEFT JOIN best b ON b.execution_id = e.execution_id AND b.rn = 1 WHERE e.status = 'FAILED'))"""
)


@query("gov_34_retry_decisions", RETRY_SQL)
def gov_34(t):
    return alerts.retry_decisions(t.execution_log.where("status = 'FAILED'"), retry_policies(t))


@query("gov_34_retries_without_company", RETRY_SQL.replace("WITH ", f"WITH {GAPS_SQL}, ", 1).replace("execution_log e", "gaps e"))
def gov_34_gaps(t):
    return alerts.retry_decisions(with_gaps(t).where("status = 'FAILED'"), retry_policies(t))


# ---- retention ---------------------------------------------------------------------------------------------------

ARCHIVE_SQL = """archives AS (SELECT source, count(*) AS file_count, CAST(sum(size_bytes) AS DOUBLE) / 1000000 AS total_size_mb,
    max(modified_at) AS archive_timestamp, 30 AS retention_days, CAST(max(modified_at) AS DATE) + 30 AS deletion_date FROM bronze_files GROUP BY 1)"""


def archives(t):
    return retention.archive_records(t.bronze_files, ["source"], 30)


@query(
    "gov_35_archive_records",
    f"""WITH {ARCHIVE_SQL} SELECT source, file_count, total_size_mb, strftime(archive_timestamp, {STAMP}) AS archive_timestamp, retention_days,
    {txt('deletion_date')} AS deletion_date, strftime(archive_timestamp, '%Y-%m-%d') AS archive_date FROM archives""",
)
def gov_35(t):
    return archives(t)


@query(
    "gov_36_pending_deletion",
    f"""WITH {ARCHIVE_SQL} SELECT source, file_count, {txt('deletion_date')} AS deletion_date,
    date_diff('day', DATE '2024-01-15', deletion_date) AS days_until_deletion FROM archives WHERE deletion_date > DATE '2024-01-15'""",
)
def gov_36(t):
    return retention.pending_deletion(archives(t), "2024-01-15").select("source", "file_count", "deletion_date", "days_until_deletion")


@query(
    "gov_36_due_within_30_days",
    f"""WITH {ARCHIVE_SQL} SELECT source, date_diff('day', DATE '2024-01-15', deletion_date) AS days_until_deletion FROM archives
    WHERE deletion_date BETWEEN DATE '2024-01-15' AND DATE '2024-01-15' + 30""",
)
def gov_36_due(t):
    return retention.pending_deletion(archives(t), "2024-01-15", 30).select("source", "days_until_deletion")


@query(
    "gov_37_past_retention",
    """SELECT path, age_days, CAST(30 AS BIGINT) AS retention_days FROM (
    SELECT path, date_diff('day', CAST(modified_at AS DATE), DATE '2024-02-01') AS age_days FROM bronze_files) WHERE age_days > 30""",
)
def gov_37(t):
    return retention.past_retention(t.bronze_files, "2024-02-01")


# ---- activity-level reports ------------------------------------------------------------------------------------------


@query(
    "gov_38_activity_start_and_end",
    f"""SELECT activity_id, execution_id, activity_name, strftime(start_time, {STAMP}) AS started_at,
    CASE WHEN event_type <> 'view' THEN strftime(start_time + to_seconds(duration_seconds), {STAMP}) END AS ended_at,
    CASE WHEN event_type <> 'view' THEN status ELSE 'RUNNING' END AS status,
    CASE WHEN event_type <> 'view' THEN duration_seconds END AS duration_seconds,
    CASE WHEN event_type <> 'view' THEN rows_read END AS rows_read, CASE WHEN event_type <> 'view' THEN rows_written END AS rows_written
    FROM activity_log""",
)
def gov_38(t):
    # Activities of 'view' events have started but not ended.
    events = runs.activity_events(t.activity_log)
    open_ids = t.activity_log.where("event_type = 'view'").select("activity_id", F.lit("END").alias("event"))
    return runs.close_activities(events.join(open_ids, ["activity_id", "event"], "left_anti"))


@query(
    "gov_39_error_log_with_level",
    f"""SELECT activity_id, execution_id, CASE WHEN status = 'FAILED' THEN 'ERROR' ELSE 'WARNING' END AS error_level, message,
    strftime(start_time, {STAMP}) AS logged_at FROM activity_log WHERE status = 'FAILED' OR rows_written < rows_read""",
)
def gov_39(t):
    return runs.error_records(t.activity_log)


@query(
    "gov_40_running_now",
    f"""SELECT execution_id, pipeline_name, company, strftime(execution_start_time, {STAMP}) AS execution_start_time,
    date_diff('second', execution_start_time, TIMESTAMP '{RUNS_AS_OF}') AS running_seconds FROM execution_log WHERE status = 'RUNNING'""",
)
def gov_40(t):
    return runs.running_now(t.execution_log, RUNS_AS_OF)


@query(
    "gov_41_failed_with_activity",
    """SELECT e.execution_id, pipeline_name, error_message, activity_name, activity_type, a.message AS activity_message FROM execution_log e
    LEFT JOIN activity_log a ON a.execution_id = e.execution_id AND a.status = 'FAILED' WHERE e.status = 'FAILED'""",
)
def gov_41(t):
    return runs.failed_with_activity(t.execution_log, t.activity_log)


@query(
    "gov_42_performance",
    """SELECT pipeline_name, count(*) AS total_executions, count(*) FILTER (WHERE status = 'SUCCESS') AS successful_executions,
    count(*) FILTER (WHERE status = 'FAILED') AS failed_executions, avg(execution_duration_seconds) AS avg_duration_seconds,
    min(execution_duration_seconds) AS min_duration_seconds, max(execution_duration_seconds) AS max_duration_seconds,
    CAST(sum(output_row_count) AS BIGINT) AS total_records_processed FROM execution_log WHERE status IN ('SUCCESS', 'FAILED') GROUP BY 1""",
)
def gov_42(t):
    return runs.performance_by(t.execution_log, "pipeline_name", "execution_duration_seconds")


@query(
    "gov_43_activity_performance",
    """SELECT activity_name, activity_type, count(*) AS total_executions, count(*) FILTER (WHERE status = 'SUCCESS') AS successful_executions,
    count(*) FILTER (WHERE status = 'FAILED') AS failed_executions,
    CAST(floor(avg(duration_seconds)) AS BIGINT) AS avg_duration_seconds, CAST(sum(rows_read) AS BIGINT) AS total_rows_read,
    CAST(sum(rows_written) AS BIGINT) AS total_rows_written FROM activity_log WHERE status IN ('SUCCESS', 'FAILED') GROUP BY 1, 2""",
)
def gov_43(t):
    return runs.activity_performance(t.activity_log, truncate=True)


@query(
    "gov_44_latest_runs",
    f"""SELECT execution_id, status, strftime(execution_start_time, {STAMP}) AS execution_start_time, execution_duration_seconds
    FROM execution_log WHERE pipeline_name = 'load_1' ORDER BY execution_log.execution_start_time DESC, execution_id LIMIT 20""",
)
def gov_44(t):
    return runs.latest_runs_of(t.execution_log, "load_1", 20)


@query(
    "gov_44_activity_details",
    """SELECT e.execution_id, e.status, activity_name, activity_type, a.status AS activity_status, duration_seconds AS activity_seconds,
    rows_read, rows_written FROM execution_log e JOIN activity_log a ON a.execution_id = e.execution_id WHERE pipeline_name = 'load_1'""",
)
def gov_44_details(t):
    return runs.activity_details(t.execution_log, t.activity_log, "load_1")


@query(
    "gov_45_rows_per_load_unit",
    """SELECT resource, activity_type, count(*) AS rows_processed, count(*) FILTER (WHERE status = 'FAILED') AS rows_failed
    FROM activity_log GROUP BY 1, 2""",
)
def gov_45(t):
    loads = t.activity_log.withColumn("loaded", F.col("status") != "FAILED")
    return runs.rows_per_sheet(loads, ["resource", "activity_type"])


@query(
    "gov_46_dashboard",
    f"""SELECT count(*) AS files_processed, count(*) FILTER (WHERE status = 'RUNNING') AS running,
    {pct("count(*) FILTER (WHERE status = 'SUCCESS')", "count(*) FILTER (WHERE status <> 'RUNNING')")} AS success_rate_pct,
    avg(execution_duration_seconds) AS mean_seconds,
    count(*) FILTER (WHERE status = 'FAILED' AND execution_start_time > TIMESTAMP '{RUNS_AS_OF}' - INTERVAL 24 HOUR) AS errors_last_24h FROM execution_log""",
)
def gov_46(t):
    return runs.dashboard(t.execution_log, RUNS_AS_OF)


@query(
    "gov_47_diagnostics",
    f"""SELECT activity_id, strftime(ts, {STAMP}) AS ts, resource, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type
    FROM activity_log WHERE CAST(json_extract_string(props, '$.k') AS INTEGER) >= 90""",
)
def gov_47(t):
    return runs.diagnostics(t.activity_log, "k", 90)


@query(
    "gov_48_failures_of_pod",
    f"""SELECT execution_id, strftime(execution_start_time, {STAMP}) AS execution_start_time, domain, error_message
    FROM execution_log WHERE status = 'FAILED' AND pod_id = 'podC'""",
)
def gov_48(t):
    return runs.failures_of_pod(t.execution_log, "podC")


@query(
    "gov_49_failure_bursts",
    f"""SELECT strftime(time_bucket(INTERVAL 5 MINUTE, ts), {STAMP}) AS bucket_start, count(*) AS failure_count
    FROM activity_log WHERE status = 'FAILED' GROUP BY 1""",
)
def gov_49(t):
    return runs.failure_bursts(t.activity_log)


@query(
    "gov_50_events_by_resource",
    f"""SELECT resource, count(*) AS event_count, count(*) FILTER (WHERE event_type = 'error'
    AND ts > TIMESTAMP '{RUNS_AS_OF}' - INTERVAL 24 HOUR) AS recent_errors FROM activity_log GROUP BY 1""",
)
def gov_50(t):
    return runs.events_by_resource(t.activity_log, RUNS_AS_OF)


@query(
    "gov_50_last_hour",
    f"""SELECT activity_id, strftime(ts, {STAMP}) AS ts, resource, event_type FROM activity_log
    WHERE activity_log.ts > TIMESTAMP '{RUNS_AS_OF}' - INTERVAL 1 HOUR""",
)
def gov_50_hour(t):
    return runs.newest_since(t.activity_log, RUNS_AS_OF, 1)


@query(
    "gov_51_activity_search",
    """SELECT activity_id, activity_name, message FROM activity_log WHERE lower(activity_name) LIKE 'step\\_2%' ESCAPE '\\'
    AND lower(message) LIKE '%purchase%'""",
)
def gov_51(t):
    return runs.search_activity(t.activity_log, "STEP_2", "Purchase")


@query(
    "gov_52_keyword_search",
    f"""SELECT activity_id, strftime(ts, {STAMP}) AS ts, message FROM activity_log WHERE lower(message) LIKE '%signup%'
    ORDER BY activity_log.ts DESC, activity_id LIMIT 50""",
)
def gov_52(t):
    return runs.keyword_search(t.activity_log, "signup", 50)
