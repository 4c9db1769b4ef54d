"""Quality, cleansing and mutation queries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import money, text
from silverlode.operators import cleanse, quality, upsert
from silverlode.session import scratch_path

from .catalog_rows import SILVER_HR_SQL, SILVER_PAY_SQL
from .frames import AS_OF, POD, PROCESSED_AT
from .oracle import dbl, pct
from .registry import query


def _issues(table: str, total: str, rows: list[tuple[str, str]]) -> str:
    """The report as a union of one query per issue."""
    parts = [f"SELECT '{total}' AS issue_type, count(*) AS record_count, CAST(0 AS DOUBLE) AS percentage FROM {table}"]
    for label, n in rows:
        parts.append(f"SELECT '{label}', n, {pct('n', 'w')} FROM (SELECT {n} AS n, (SELECT count(*) FROM {table}) AS w)")
    return " UNION ALL ".join(parts)


def _where(table: str, cond: str) -> str:
    return f"(SELECT count(*) FROM {table} WHERE {cond})"


HR_ISSUES_SQL = _issues(
    "bronze_hr",
    "Total Records",
    [
        ("NULL employee_id", _where("bronze_hr", "employee_id IS NULL")),
        ("Duplicate Records", "(SELECT count(employee_id) - count(DISTINCT employee_id) FROM bronze_hr)"),
        ("Future Hire Dates", _where("bronze_hr", "try_cast(hire_date AS DATE) > DATE '2001-01-01'")),
        ("Invalid Salary (<=0 or NULL)", _where("bronze_hr", "try_cast(salary AS DECIMAL(10,2)) <= 0 OR salary IS NULL")),
        ("Missing Email", _where("bronze_hr", "email IS NULL OR trim(email) = ''")),
        ("Invalid Email Format", _where("bronze_hr", "email IS NOT NULL AND trim(email) <> '' AND email NOT LIKE '%@%.%'")),
    ],
)

PAY_ISSUES_SQL = _issues(
    "bronze_payroll",
    "Total Records",
    [
        ("NULL payment_id", _where("bronze_payroll", "payment_id IS NULL")),
        ("Duplicate payment_id", "(SELECT count(payment_id) - count(DISTINCT payment_id) FROM bronze_payroll)"),
        (
            "Invalid employee_id (not in HR)",
            "(SELECT count(*) FROM bronze_payroll p WHERE NOT EXISTS (SELECT 1 FROM silver_hr e WHERE e.employee_id = try_cast(p.employee_id AS BIGINT)))",
        ),
        (
            "Invalid Date Range (start >= end)",
            _where("bronze_payroll", "try_cast(pay_period_start AS DATE) >= try_cast(pay_period_end AS DATE)"),
        ),
        ("Future Payment Dates", _where("bronze_payroll", "try_cast(payment_date AS DATE) > DATE '2001-01-01'")),
        ("NULL Deductions", _where("bronze_payroll", "deductions IS NULL")),
        (
            "Incorrect Net Pay Calculation",
            _where(
                "bronze_payroll",
                """abs(try_cast(gross_pay AS DECIMAL(10,2)) - try_cast(tax_withheld AS DECIMAL(10,2))
                - coalesce(try_cast(deductions AS DECIMAL(10,2)), 0) - try_cast(net_pay AS DECIMAL(10,2))) > 0.01""",
            ),
        ),
    ],
)


@query("dq_1_employee_issues", HR_ISSUES_SQL)
def dq_1(t):
    return quality.profile_employees(t.bronze_hr, AS_OF)


@query("dq_2_payment_issues", PAY_ISSUES_SQL)
def dq_2(t):
    return quality.profile_payments(t.bronze_payroll, t.silver_hr, POD, AS_OF)


@query(
    "dq_3_cleansing_impact",
    f"""SELECT b AS bronze_row_count, s AS silver_row_count, b - s AS rows_filtered, {pct('b - s', 'b')} AS filter_percentage
    FROM (SELECT (SELECT count(*) FROM bronze_payroll) AS b, (SELECT count(*) FROM cleansed_payroll) AS s)""",
)
def dq_3(t):
    return quality.cleansing_impact(t.bronze_payroll, t.cleansed_payroll)


@query(
    "dq_4_dependency_check",
    """SELECT 'employees' AS table_name, count(*) AS record_count, CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL - employees is empty' END AS status
    FROM silver_hr WHERE pod_id = 'podA'
    UNION ALL SELECT 'other_pod', count(*), CASE WHEN count(*) > 0 THEN 'PASS' ELSE 'FAIL - other_pod is empty' END
    FROM silver_hr WHERE pod_id = 'podZ'""",
)
def dq_4(t):
    hr = t.silver_hr
    return quality.dependency_check({"employees": hr.where("pod_id = 'podA'"), "other_pod": hr.where("pod_id = 'podZ'")})


@query(
    "dq_5_orphan_report",
    """SELECT employee_id, count(*) AS payment_count FROM bronze_payroll p
    WHERE NOT EXISTS (SELECT 1 FROM silver_hr e WHERE e.employee_id = try_cast(p.employee_id AS BIGINT)) GROUP BY 1""",
)
def dq_5(t):
    return quality.orphan_report(t.bronze_payroll, t.silver_hr, "employee_id", "employee_id")


@query(
    "dq_6_net_pay_discrepancies",
    f"""SELECT payment_id, employee_id, {dbl('g')} AS original_gross_pay, {dbl('x')} AS original_tax_withheld, {dbl('d')} AS original_deductions,
    {dbl('n')} AS original_net_pay, {dbl('g - x - d')} AS recalculated_net_pay, {dbl('n - (g - x - d)')} AS discrepancy
    FROM (SELECT *, CAST(gross_pay AS DECIMAL(10,2)) AS g, CAST(tax_withheld AS DECIMAL(10,2)) AS x,
      coalesce(CAST(deductions AS DECIMAL(10,2)), 0) AS d, CAST(net_pay AS DECIMAL(10,2)) AS n FROM bronze_payroll)
    WHERE abs(n - (g - x - d)) > 0.01""",
)
def dq_6(t):
    return quality.net_pay_discrepancies(t.bronze_payroll)


@query(
    "dq_7_integrity_check",
    """SELECT count(DISTINCT p.employee_id) AS unique_employees_in_payroll, (SELECT count(DISTINCT employee_id) FROM silver_hr) AS unique_employees_in_hr,
    count(DISTINCT p.employee_id) FILTER (WHERE e.employee_id IS NULL) AS orphaned_employees,
    CASE WHEN count(*) FILTER (WHERE e.employee_id IS NULL) = 0 THEN 'PASS - All payroll employee_ids exist in HR'
      ELSE 'FAIL - Orphaned employee_ids found' END AS integrity_status
    FROM typed_payroll p LEFT JOIN silver_hr e ON p.employee_id = e.employee_id""",
)
def dq_7(t):
    raw = t.bronze_payroll.select(F.col("employee_id").try_cast("long").alias("employee_id"))
    return quality.integrity_check(raw, t.silver_hr)


def _config_rule(name: str, cond: str) -> str:
    return f"""SELECT '{name}' AS rule_name, count(*) FILTER (WHERE {cond}) AS violations,
    min(company_id) FILTER (WHERE {cond}) AS first_offender,
    CASE WHEN count(*) FILTER (WHERE {cond}) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM company_config"""


@query(
    "dq_8_config_validation",
    " UNION ALL ".join(
        [
            _config_rule("duplicate_company_id", "company_id IN (SELECT company_id FROM company_config GROUP BY 1 HAVING count(*) > 1)"),
            _config_rule("worker_count_range", "worker_count < 1 OR worker_count > 10"),
            _config_rule("empty_domains", "len(domains) = 0"),
            _config_rule("invalid_priority", "priority NOT IN ('HIGH', 'MEDIUM', 'LOW')"),
            _config_rule("invalid_classification", "data_classification NOT IN ('PUBLIC', 'INTERNAL', 'CONFIDENTIAL', 'RESTRICTED')"),
            _config_rule("autoscale_inverted", "autoscale_min_workers > autoscale_max_workers"),
        ]
    ),
)
def dq_8(t):
    return quality.validate_config(t.company_config)


def hr_rules(t):
    warn = {"severity": "WARNING", "action": quality.ACCEPTED_WITH_WARNING}
    return [
        quality.not_null("employee_id"),
        quality.matches("email", text.STRICT_EMAIL_REGEX, severity="WARNING", action=quality.QUARANTINED),
        quality.in_range("salary", 0, 1000000),
        quality.unique("employee_id", **warn),
        quality.references("manager_id", t.silver_hr, "employee_id", severity="INFO", action=quality.ACCEPTED_WITH_WARNING),
    ]


RULE_FLAGS_SQL = r"""SELECT b.*, employee_id IS NULL AS f1,
    NOT coalesce(regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'), false) AS f2,
    NOT coalesce(try_cast(salary AS DECIMAL(12,2)) > 0 AND try_cast(salary AS DECIMAL(12,2)) < 1000000, false) AS f3,
    coalesce(employee_id IN (SELECT employee_id FROM bronze_hr WHERE employee_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1), false) AS f4,
    manager_id IS NULL OR NOT EXISTS (SELECT 1 FROM silver_hr s WHERE CAST(s.employee_id AS VARCHAR) = b.manager_id) AS f5
    FROM bronze_hr b"""


def _rule_row(name, kind, column, flag, severity, action) -> str:
    return f"""SELECT '{name}' AS rule_name, '{kind}' AS rule_type, '{column}' AS column_name, count(*) AS records_checked,
    count(*) FILTER (WHERE NOT {flag}) AS records_passed, count(*) FILTER (WHERE {flag}) AS records_failed,
    {pct(f'count(*) FILTER (WHERE NOT {flag})', 'count(*)')} AS pass_percentage, '{severity}' AS severity,
    CASE WHEN count(*) FILTER (WHERE {flag}) > 0 THEN '{action}' ELSE 'ACCEPTED' END AS action_taken,
    min(coalesce({column}, 'NULL')) FILTER (WHERE {flag}) AS error_sample FROM flagged"""


RULE_LOG_SQL = f"WITH flagged AS ({RULE_FLAGS_SQL}) " + " UNION ALL ".join(
    [
        _rule_row("employee_id_not_null", "NOT_NULL", "employee_id", "f1", "CRITICAL", "REJECTED"),
        _rule_row("email_format", "FORMAT", "email", "f2", "WARNING", "QUARANTINED"),
        _rule_row("salary_range", "RANGE", "salary", "f3", "CRITICAL", "REJECTED"),
        _rule_row("employee_id_unique", "UNIQUENESS", "employee_id", "f4", "WARNING", "ACCEPTED_WITH_WARNING"),
        _rule_row("manager_id_reference", "REFERENCE", "manager_id", "f5", "INFO", "ACCEPTED_WITH_WARNING"),
    ]
)


@query("dq_9_rule_engine", RULE_LOG_SQL)
def dq_9(t):
    return quality.check_rules(t.bronze_hr, hr_rules(t))


@query(
    "dq_10_route_by_action",
    f"""WITH flagged AS ({RULE_FLAGS_SQL}) SELECT employee_id, last_name, department, concat_ws(',', CASE WHEN f1 THEN 'employee_id_not_null' END,
    CASE WHEN f2 THEN 'email_format' END, CASE WHEN f3 THEN 'salary_range' END, CASE WHEN f4 THEN 'employee_id_unique' END,
    CASE WHEN f5 THEN 'manager_id_reference' END) AS failed_rules,
    CASE WHEN f1 OR f3 THEN 'REJECTED' WHEN f2 THEN 'QUARANTINED' WHEN f4 OR f5 THEN 'ACCEPTED_WITH_WARNING' ELSE 'ACCEPTED' END AS disposition
    FROM flagged""",
)
def dq_10(t):
    routed = quality.route_rows(t.bronze_hr, hr_rules(t))
    return routed.select("employee_id", "last_name", "department", F.concat_ws(",", "failed_rules").alias("failed_rules"), "disposition")


@query(
    "dq_10_split_counts",
    f"""WITH flagged AS ({RULE_FLAGS_SQL}) SELECT CASE WHEN f1 OR f3 THEN 'rejected' WHEN f2 THEN 'quarantined' ELSE 'accepted' END AS part,
    count(*) AS n FROM flagged GROUP BY 1""",
)
def dq_10_split(t):
    path = scratch_path(t.spark, "routed")
    quality.write_routed(t.bronze_hr, hr_rules(t), path)
    return quality.routed_counts(t.spark, path).withColumnRenamed("record_count", "n").where("n > 0")


DAILY_LOG_SQL = """daily AS (SELECT 'quality_floor_' || stage AS rule_name, 'RANGE' AS rule_type, pod_id, company, CAST(execution_date AS DATE) AS check_date,
    CASE WHEN stage = 'bronze_to_silver' THEN 'CRITICAL' ELSE 'INFO' END AS severity, CAST(sum(input_row_count) AS BIGINT) AS records_checked,
    CAST(sum(output_row_count) AS BIGINT) AS records_passed, CAST(sum(rows_failed_validation) AS BIGINT) AS records_failed
    FROM execution_log GROUP BY ALL)"""


def daily_quality_log(t):
    """Quality-log rows per stage, tenant and day from the run log."""
    g = t.execution_log.groupBy(
        F.concat(F.lit("quality_floor_"), "stage").alias("rule_name"), F.lit("RANGE").alias("rule_type"), "pod_id", "company",
        F.col("execution_date").cast("date").alias("check_date"),
        F.when(F.col("stage") == "bronze_to_silver", F.lit("CRITICAL")).otherwise(F.lit("INFO")).alias("severity"),
    ).agg(
        F.sum("input_row_count").alias("records_checked"),
        F.sum("output_row_count").alias("records_passed"),
        F.sum("rows_failed_validation").alias("records_failed"),
    )
    return g.withColumn("pass_percentage", money.percent(F.col("records_passed"), F.col("records_checked")))


@query(
    "dq_11_quality_trend",
    f"""WITH {DAILY_LOG_SQL} SELECT rule_name, rule_type, round(avg({pct('records_passed', 'records_checked')}), 6) AS avg_pass_rate,
    CAST(sum(records_failed) AS BIGINT) AS total_failures FROM daily WHERE check_date >= DATE '2024-01-31' - 14 AND severity IN ('CRITICAL', 'WARNING') GROUP BY 1, 2""",
)
def dq_11(t):
    trend = quality.quality_trend(daily_quality_log(t), "2024-01-31", 14)
    return trend.withColumn("avg_pass_rate", F.round("avg_pass_rate", 6))


@query(
    "dq_12_quality_score",
    f"""WITH {DAILY_LOG_SQL} SELECT *, CASE WHEN quality_score < 99 THEN 'CRITICAL' ELSE 'PASS' END AS gate FROM (
    SELECT pod_id, company, {pct('sum(records_passed)', 'sum(records_checked)')} AS quality_score FROM daily GROUP BY 1, 2)""",
)
def dq_12(t):
    return quality.quality_score(daily_quality_log(t), ["pod_id", "company"], threshold=99.0)


@query(
    "dq_13_metric_thresholds",
    """WITH m AS (SELECT 'rows_out' AS metric_name, CAST(sum(output_row_count) AS DOUBLE) AS metric_value FROM execution_log
      UNION ALL SELECT 'mean_score', avg(data_quality_score) FROM execution_log
      UNION ALL SELECT 'runs', CAST(count(*) AS DOUBLE) FROM execution_log),
    th AS (SELECT * FROM (VALUES ('rows_out', 1000.0), ('mean_score', 99.5)) v(metric_name, threshold_value))
    SELECT m.metric_name, metric_value, CAST(threshold_value AS DOUBLE) AS threshold_value, CASE WHEN threshold_value IS NULL THEN 'WARN' WHEN metric_value >= threshold_value THEN 'PASS' ELSE 'FAIL' END AS status
    FROM m LEFT JOIN th ON m.metric_name = th.metric_name""",
)
def dq_13(t):
    wide = t.execution_log.agg(
        F.sum("output_row_count").cast("double").alias("rows_out"), F.avg("data_quality_score").alias("mean_score"),
        F.count("*").cast("double").alias("runs"),
    )
    metrics = wide.unpivot([], ["rows_out", "mean_score", "runs"], "metric_name", "metric_value")
    floors = t.spark.createDataFrame([("rows_out", 1000.0), ("mean_score", 99.5)], "metric_name string, threshold_value double")
    return quality.metrics_against_thresholds(metrics, floors)


CONTRACT = T.StructType(
    [
        T.StructField("employee_id", T.LongType(), False),
        T.StructField("last_name", T.StringType(), False),
        T.StructField("hire_date", T.DateType(), True),
        T.StructField("salary", T.DecimalType(10, 2), False),
    ]
)


def _contract_row(name: str, kind: str, bad: str) -> str:
    return f"SELECT '{name}' AS rule_name, '{kind}' AS rule_type, count(*) FILTER (WHERE {bad}) AS records_failed FROM bronze_hr"


@query(
    "dq_14_table_contract",
    " UNION ALL ".join(
        [
            _contract_row("employee_id_required", "NOT_NULL", "employee_id IS NULL"),
            _contract_row("employee_id_type", "FORMAT", "employee_id IS NOT NULL AND try_cast(employee_id AS BIGINT) IS NULL"),
            _contract_row("last_name_required", "NOT_NULL", "last_name IS NULL"),
            _contract_row("hire_date_type", "FORMAT", "hire_date IS NOT NULL AND try_cast(hire_date AS DATE) IS NULL"),
            _contract_row("salary_required", "NOT_NULL", "salary IS NULL"),
            _contract_row("salary_type", "FORMAT", "salary IS NOT NULL AND try_cast(salary AS DECIMAL(10,2)) IS NULL"),
            _contract_row("last_name_length", "RANGE", "length(last_name) > 4"),
            _contract_row(
                "employee_id_unique", "UNIQUENESS",
                "employee_id IN (SELECT employee_id FROM bronze_hr WHERE employee_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
            ),
        ]
    ),
)
def dq_14(t):
    rules = quality.contract_rules(CONTRACT, {"last_name": 4}, key="employee_id")
    return quality.check_rules(t.bronze_hr, rules).select("rule_name", "rule_type", "records_failed")


# ---- bronze -> silver -----------------------------------------------------------


@query("b2s_1_hr_bronze_to_silver", f"SELECT {SILVER_HR_SQL} FROM cleansed_hr")
def b2s_1(t):
    return t.cleansed_hr


@query("b2s_2_payroll_bronze_to_silver", f"SELECT {SILVER_PAY_SQL} FROM cleansed_payroll")
def b2s_2(t):
    return t.cleansed_payroll


AUDIT_SQL = "'2001-01-01 06:00:00' AS processed_timestamp, 'podA' AS pod_id, 'finance' AS company"


@query(
    "b2s_3_pod_hr_rules",
    f"""SELECT DISTINCT * REPLACE (trim(first_name) AS first_name, trim(last_name) AS last_name, lower(email) AS email, upper(department) AS department),
    {AUDIT_SQL}, 'hr' AS domain FROM bronze_hr WHERE employee_id IS NOT NULL""",
)
def b2s_3(t):
    return cleanse.default_rules().apply(t.bronze_hr, POD, "finance", "hr", PROCESSED_AT)


@query(
    "b2s_4_pod_payroll_rules",
    f"SELECT DISTINCT *, {AUDIT_SQL}, 'payroll' AS domain FROM simple_payroll WHERE employee_id IS NOT NULL AND CAST(base_salary AS DECIMAL(12,2)) > 0",
)
def b2s_4(t):
    return cleanse.default_rules().apply(t.simple_payroll, POD, "finance", "payroll", PROCESSED_AT)


@query(
    "b2s_5_generic_rules",
    f"""SELECT DISTINCT *, '2001-01-01 06:00:00' AS processed_timestamp, 'podB' AS pod_id, 'finance' AS company, 'payroll' AS domain
    FROM simple_payroll WHERE employee_id IS NOT NULL AND base_salary IS NOT NULL AND bonus IS NOT NULL AND pay_period IS NOT NULL""",
)
def b2s_5(t):
    return cleanse.default_rules().apply(t.simple_payroll, "podB", "finance", "payroll", PROCESSED_AT)


@query(
    "b2s_6_customer_rules",
    rf"""SELECT *, coalesce(regexp_matches(trim(email), '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{{2,}}$'), false) AS email_valid,
    {AUDIT_SQL}, 'customer' AS domain FROM bronze_hr WHERE employee_id IS NOT NULL""",
)
def b2s_6(t):
    return cleanse.default_rules().apply(t.bronze_hr, POD, "finance", "customer", PROCESSED_AT)


@query(
    "b2s_7_joined_domains",
    """SELECT DISTINCT h.employee_id, h.last_name, h.department, h.salary, p.base_salary, p.bonus, p.pay_period
    FROM bronze_hr h JOIN simple_payroll p ON h.employee_id = p.employee_id
    WHERE h.last_name IS NOT NULL AND h.department IS NOT NULL AND h.salary IS NOT NULL AND p.base_salary IS NOT NULL
      AND p.bonus IS NOT NULL AND p.pay_period IS NOT NULL""",
)
def b2s_7(t):
    cols = ["employee_id", "last_name", "department", "salary", "base_salary", "bonus", "pay_period"]
    return cleanse.join_domains(t.bronze_hr, t.simple_payroll, "employee_id", cols)


# ---- table mutation ------------------------------------------------------------------

KEYS = ["employee_id", "pod_id"]
UPDATED = ["department", "salary"]


def waves(t):
    """The staff table after a first load, and a later delivery that changes and adds rows."""
    first = t.silver_hr.where("employee_id % 3 <> 2")
    second = t.silver_hr.where("employee_id % 3 <> 0").withColumns(
        {"department": F.concat("department", F.lit("-2")), "salary": (F.col("salary") + 1).cast("decimal(10,2)")}
    )
    return first, second


UPSERT_SQL = """SELECT employee_id, pod_id, first_name,
    CASE WHEN employee_id % 3 <> 0 THEN department || '-2' ELSE department END AS department,
    CAST(CASE WHEN employee_id % 3 <> 0 THEN salary + 1 ELSE salary END AS DOUBLE) AS salary FROM silver_hr"""
UPSERT_COLUMNS = ["employee_id", "pod_id", "first_name", "department", "salary"]


@query("tm_1_upsert_columns", UPSERT_SQL)
def tm_1(t):
    first, second = waves(t)
    return upsert.upsert(first, second, KEYS, UPDATED).select(*UPSERT_COLUMNS)


@query("tm_2_upsert_all", UPSERT_SQL)
def tm_2(t):
    first, second = waves(t)
    return upsert.upsert(first, second, KEYS).select(*UPSERT_COLUMNS)


@query(
    "tm_3_ambiguous_keys",
    "SELECT employee_id, pod_id, count(*) AS source_rows FROM cleansed_hr GROUP BY 1, 2 HAVING count(*) > 1",
)
def tm_3(t):
    return upsert.ambiguous_keys(t.cleansed_hr, KEYS)


@query("tm_4_rerun_is_idempotent", UPSERT_SQL)
def tm_4(t):
    first, second = waves(t)
    once = upsert.upsert(first, second, KEYS)
    return upsert.upsert(once, second, KEYS).select(*UPSERT_COLUMNS)


@query(
    "tm_5_conditional_update",
    """SELECT company_id, CASE WHEN priority = 'HIGH' THEN worker_count + 2 ELSE worker_count END AS worker_count,
    CASE WHEN priority = 'HIGH' THEN 'ops' ELSE modified_by END AS modified_by FROM company_config""",
)
def tm_5(t):
    changes = {"worker_count": F.col("worker_count") + 2, "modified_by": F.lit("ops")}
    out = upsert.update_where(t.company_config, F.col("priority") == "HIGH", changes)
    return out.select("company_id", "worker_count", "modified_by")


@query(
    "tm_8_change_feed",
    """SELECT 'insert' AS change_type, v2.company_id, v2.worker_count, v2.priority FROM config_v2 v2
      WHERE v2.company_id NOT IN (SELECT company_id FROM company_config)
    UNION ALL SELECT 'delete', company_id, worker_count, priority FROM company_config WHERE company_id NOT IN (SELECT company_id FROM config_v2)
    UNION ALL SELECT 'update_preimage', a.company_id, a.worker_count, a.priority FROM company_config a JOIN config_v2 b ON a.company_id = b.company_id
      WHERE a.worker_count <> b.worker_count
    UNION ALL SELECT 'update_postimage', b.company_id, b.worker_count, b.priority FROM company_config a JOIN config_v2 b ON a.company_id = b.company_id
      WHERE a.worker_count <> b.worker_count""",
)
def tm_8(t):
    return upsert.change_feed(t.company_config, t.config_v2, ["company_id"], ["worker_count", "priority"])


def config_history(t):
    """Both snapshots stacked with their version; dropped tenants are marked deleted."""
    cols = ["company_id", "worker_count"]
    v1 = t.company_config.select(*cols, F.lit(1).alias("version"), F.lit(False).alias("is_deleted"))
    v2 = t.config_v2.select(*cols, F.lit(2).alias("version"), F.lit(False).alias("is_deleted"))
    gone = t.company_config.join(t.config_v2.select("company_id"), "company_id", "left_anti").select(
        *cols, F.lit(2).alias("version"), F.lit(True).alias("is_deleted")
    )
    return v1.unionByName(v2).unionByName(gone)


@query(
    "tm_9_as_of_version",
    """SELECT 1 AS asked, company_id, worker_count FROM company_config UNION ALL SELECT 2, company_id, worker_count FROM config_v2""",
)
def tm_9(t):
    history = config_history(t)
    parts = [
        upsert.as_of_version(history, ["company_id"], "version", v).select(F.lit(v).alias("asked"), "company_id", "worker_count")
        for v in (1, 2)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "tm_10_soft_delete",
    "SELECT company_id, enabled AND priority <> 'LOW' AS enabled FROM company_config",
)
def tm_10(t):
    return upsert.soft_delete(t.company_config, F.col("priority") == "LOW").select("company_id", "enabled")
