"""Joins, aggregations, windows, orderings and set operations."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from silverlode.functions import dates, money, nested, ranking
from silverlode.operators import alerts, cleanse, gold, integrity, quality, runs, tenants
from silverlode.sources import manifests

from .frames import AS_OF, POD
from .oracle import dbl, mean2, pct, txt
from .registry import query

# ---- joins ---------------------------------------------------------------------


@query(
    "jn_1_known_employee_filter",
    """SELECT payment_id, employee_id FROM bronze_payroll p
    WHERE try_cast(employee_id AS BIGINT) IN (SELECT employee_id FROM silver_hr WHERE pod_id = 'podA')""",
)
def jn_1(t):
    return cleanse.with_known_employee(t.bronze_payroll, t.silver_hr, POD).select("payment_id", "employee_id")


@query(
    "jn_2_attributes_by_key",
    f"""SELECT payment_id, p.employee_id, department, {dbl('gross_pay')} AS gross_pay
    FROM silver_payroll p JOIN silver_hr e ON p.employee_id = e.employee_id AND p.pod_id = e.pod_id""",
)
def jn_2(t):
    staff = t.silver_hr.select("employee_id", "pod_id", "department")
    return t.silver_payroll.join(staff, ["employee_id", "pod_id"]).select("payment_id", "employee_id", "department", "gross_pay")


@query(
    "jn_3_keep_unpaid_employees",
    f"""SELECT e.employee_id, payment_id, {dbl('net_pay')} AS net_pay FROM silver_hr e
    LEFT JOIN silver_payroll p ON p.employee_id = e.employee_id AND p.pod_id = e.pod_id""",
)
def jn_3(t):
    pay = t.silver_payroll.select("employee_id", "pod_id", "payment_id", "net_pay")
    return t.silver_hr.select("employee_id", "pod_id").join(pay, ["employee_id", "pod_id"], "left").drop("pod_id")


@query(
    "jn_4_manager_name",
    """SELECT e.employee_id, e.manager_id, m.first_name || ' ' || m.last_name AS manager_name
    FROM silver_hr e LEFT JOIN silver_hr m ON e.manager_id = m.employee_id AND e.pod_id = m.pod_id""",
)
def jn_4(t):
    return gold.with_manager_name(t.silver_hr).select("employee_id", "manager_id", "manager_name")


@query(
    "jn_5_orphans",
    """SELECT payment_id, employee_id FROM bronze_payroll p
    WHERE NOT EXISTS (SELECT 1 FROM silver_hr e WHERE e.employee_id = try_cast(p.employee_id AS BIGINT))""",
)
def jn_5(t):
    return quality.orphans(t.bronze_payroll, t.silver_hr, "employee_id", "employee_id").select("payment_id", "employee_id")


@query(
    "jn_6_cross_domain",
    """SELECT h.employee_id, h.department, p.pay_period, p.base_salary FROM bronze_hr h
    JOIN simple_payroll p ON h.employee_id = p.employee_id""",
)
def jn_6(t):
    return t.bronze_hr.select("employee_id", "department").join(
        t.simple_payroll.select("employee_id", "pay_period", "base_salary"), "employee_id"
    )


@query(
    "jn_7_status_in_join_condition",
    """SELECT e.execution_id, e.error_message, a.activity_name FROM execution_log e
    LEFT JOIN activity_log a ON e.execution_id = a.execution_id AND a.status = 'FAILED' WHERE e.status = 'FAILED'""",
)
def jn_7(t):
    return runs.failed_with_activity(t.execution_log, t.activity_log).select("execution_id", "error_message", "activity_name")


RULES_SQL = """(VALUES ('r1', 'podA', NULL, 'bronze_to_silver', 95.0), ('r2', NULL, NULL, NULL, 90.0),
  ('r3', 'podB', 'company_1', NULL, 99.0), ('r4', NULL, NULL, 'silver_to_gold', 85.0)) r(rule_id, pod_id, company, stage, floor_score)"""


@query(
    "jn_8_wildcard_rules",
    f"""SELECT e.execution_id, r.rule_id FROM (SELECT * REPLACE (CASE WHEN company_key % 7 <> 0 THEN company END AS company)
    FROM execution_log) e JOIN {RULES_SQL}
    ON (r.pod_id IS NULL OR r.pod_id = e.pod_id) AND (r.company IS NULL OR r.company = e.company)
    AND (r.stage IS NULL OR r.stage = e.stage) AND e.data_quality_score < r.floor_score""",
)
def jn_8(t):
    rules = t.spark.createDataFrame(
        [("r1", "podA", None, "bronze_to_silver", 95.0), ("r2", None, None, None, 90.0),
         ("r3", "podB", "company_1", None, 99.0), ("r4", None, None, "silver_to_gold", 85.0)],
        "rule_id string, pod_id string, company string, stage string, floor_score double",
    )
    keys = ["pod_id", "company", "stage"]
    # Some runs do not know their company; only open rules match them.
    company = F.when(F.col("company_key") % 7 != 0, F.col("company")).alias("company")
    runs_ = t.execution_log.select("execution_id", "pod_id", company, "stage", "data_quality_score")
    applicable = alerts.resolve_wildcards(runs_, rules, keys)
    joined = runs_.alias("l").join(applicable.alias("r"), alerts.same_keys("l", "r", keys))
    return joined.where("data_quality_score < floor_score").select("execution_id", "rule_id")


@query(
    "jn_9_runs_with_activities",
    """SELECT e.execution_id, e.status, a.activity_name, a.status AS activity_status FROM execution_log e
    JOIN activity_log a ON e.execution_id = a.execution_id""",
)
def jn_9(t):
    acts = t.activity_log.select("execution_id", "activity_name", F.col("status").alias("activity_status"))
    return t.execution_log.select("execution_id", "status").join(acts, "execution_id")


@query(
    "jn_10_manifest_full_outer",
    """SELECT coalesce(l.archive, m.archive) AS archive, coalesce(l.path, m.path) AS path, l.path IS NOT NULL AS listed,
    m.path IS NOT NULL AS present
    FROM (SELECT DISTINCT archive, replace(substr(line, 66), chr(92), '/') AS path FROM manifest_lines WHERE line NOT LIKE '#%') l
    FULL JOIN archive_members m ON l.archive = m.archive AND l.path = m.path""",
)
def jn_10(t):
    listed = manifests.parse_entries(t.manifest_lines)
    results = integrity.validate(listed, integrity.generate_manifest(t.archive_members, "sha256"))
    return results.select(
        "archive", "path", F.col("expected").isNotNull().alias("listed"), F.col("actual").isNotNull().alias("present")
    )


@query(
    "jn_11_runs_with_config",
    """SELECT execution_id, CASE WHEN c.company IS NULL THEN 'UNASSIGNED' ELSE cost_center END AS cost_center, sla_hours,
    c.company IS NOT NULL AS configured FROM execution_log e LEFT JOIN company_config c ON e.pod_id = c.pod_id AND e.company = c.company""",
)
def jn_11(t):
    return runs.with_config(t.execution_log, t.company_config, ["cost_center", "sla_hours"]).select(
        "execution_id", "cost_center", "sla_hours", "configured"
    )


@query(
    "jn_12_counts_side_by_side",
    "SELECT (SELECT count(*) FROM bronze_hr) AS staff, (SELECT count(*) FROM bronze_payroll) AS payments, (SELECT count(*) FROM silver_hr) AS silver_staff",
)
def jn_12(t):
    return quality.count_side_by_side(staff=t.bronze_hr, payments=t.bronze_payroll, silver_staff=t.silver_hr)


# ---- aggregations ----------------------------------------------------------------


@query("ag_1_count_all", "SELECT count(*) AS total_records FROM bronze_payroll")
def ag_1(t):
    return t.bronze_payroll.agg(F.count("*").alias("total_records"))


@query("ag_2_count_column", "SELECT count(*) AS all_rows, count(deductions) AS with_deductions FROM bronze_payroll")
def ag_2(t):
    return t.bronze_payroll.agg(F.count("*").alias("all_rows"), F.count("deductions").alias("with_deductions"))


@query("ag_3_count_distinct", "SELECT payment_method, count(DISTINCT employee_id) AS people FROM silver_payroll GROUP BY 1")
def ag_3(t):
    return t.silver_payroll.groupBy("payment_method").agg(F.count_distinct("employee_id").alias("people"))


@query(
    "ag_4_conditional_distinct",
    """SELECT year(payment_date) AS pay_year, count(DISTINCT CASE WHEN payment_method = 'Check' THEN employee_id END) AS by_check,
    count(DISTINCT CASE WHEN payment_method = 'Direct Deposit' THEN employee_id END) AS by_deposit FROM silver_payroll GROUP BY 1""",
)
def ag_4(t):
    # One row per employee, year and method first, so the distinct counts need no Expand.
    method, person = F.col("payment_method"), F.col("employee_id")
    paid = t.silver_payroll.groupBy(F.year("payment_date").alias("pay_year"), person).agg(
        F.bool_or(method == "Check").alias("check"), F.bool_or(method == "Direct Deposit").alias("deposit")
    )
    return paid.where(person.isNotNull()).groupBy("pay_year").agg(
        F.count_if("check").alias("by_check"), F.count_if("deposit").alias("by_deposit")
    )


@query(
    "ag_5_conditional_count",
    "SELECT stage, count(*) FILTER (WHERE status = 'SUCCESS') AS good, count(*) FILTER (WHERE status = 'FAILED') AS bad FROM execution_log GROUP BY 1",
)
def ag_5(t):
    status = F.col("status")
    return t.execution_log.groupBy("stage").agg(
        F.count_if(status == "SUCCESS").alias("good"), F.count_if(status == "FAILED").alias("bad")
    )


@query(
    "ag_6_sum_avg_min_max",
    f"""SELECT payment_method, {dbl('sum(gross_pay)')} AS gross, {mean2('sum(net_pay)', 'count(*)')} AS avg_net,
    {txt('min(payment_date)')} AS first_day, {txt('max(payment_date)')} AS last_day, {dbl('max(gross_pay)')} AS top_gross
    FROM silver_payroll GROUP BY 1""",
)
def ag_6(t):
    return t.silver_payroll.groupBy("payment_method").agg(
        money.total("gross_pay").alias("gross"), money.mean2(F.sum("net_pay"), F.count("*")).alias("avg_net"),
        F.min("payment_date").alias("first_day"), F.max("payment_date").alias("last_day"), F.max("gross_pay").alias("top_gross"),
    )


@query(
    "ag_7_sample_deviation",
    "SELECT department, round(stddev_samp(CAST(salary AS DOUBLE)), 4) AS salary_stddev FROM silver_hr GROUP BY 1",
)
def ag_7(t):
    return t.silver_hr.groupBy("department").agg(F.round(F.stddev_samp(F.col("salary").cast("double")), 4).alias("salary_stddev"))


@query(
    "ag_8_ratio_with_zero_guard",
    f"""SELECT payment_method, {pct('sum(tax_withheld)', 'sum(gross_pay)')} AS tax_pct, {pct('sum(deductions)', 'sum(gross_pay)')} AS deduction_pct
    FROM silver_payroll GROUP BY 1""",
)
def ag_8(t):
    return t.silver_payroll.groupBy("payment_method").agg(
        money.percent(F.sum("tax_withheld"), F.sum("gross_pay")).alias("tax_pct"),
        money.percent(F.sum("deductions"), F.sum("gross_pay")).alias("deduction_pct"),
    )


TENURE_SQL = """CAST((2 * CAST(sum(date_diff('day', hire_date, DATE '2001-01-01')) AS HUGEINT) * 10000 + 36525 * count(*))
    // (2 * 36525 * count(*)) AS DOUBLE) / 100"""


@query("ag_9_average_tenure", f"SELECT department, {TENURE_SQL} AS avg_tenure_years FROM silver_hr GROUP BY 1")
def ag_9(t):
    days = F.sum(dates.days_between(dates.day(AS_OF), "hire_date").cast("long"))
    years = days / (F.lit(dates.DAYS_PER_YEAR).cast("decimal(5,2)") * F.count("*"))
    return t.silver_hr.groupBy("department").agg(F.round(years, 2).alias("avg_tenure_years"))


@query(
    "ag_10_most_frequent_value",
    """SELECT employee_id, payment_method AS primary_payment_method FROM (SELECT employee_id, payment_method,
    row_number() OVER (PARTITION BY employee_id ORDER BY count(*) DESC, payment_method) AS rn
    FROM silver_payroll GROUP BY 1, 2) WHERE rn = 1""",
)
def ag_10(t):
    methods = gold.ALL_METHODS
    counts = {m: F.count_if(F.col("payment_method") == m) for m in methods}
    return t.silver_payroll.groupBy("employee_id").agg(gold.most_frequent(counts).alias("primary_payment_method"))


@query(
    "ag_11_many_keys",
    f"""SELECT e.employee_id, last_name, department, job_title, office_location, count(payment_id) AS payments,
    {dbl('sum(gross_pay)')} AS gross FROM silver_hr e LEFT JOIN silver_payroll p ON e.employee_id = p.employee_id
    GROUP BY e.employee_id, last_name, department, job_title, office_location""",
)
def ag_11(t):
    paid = t.silver_payroll.groupBy(F.col("employee_id").alias("_e")).agg(F.count("*").alias("n"), money.total("gross_pay").alias("gross"))
    joined = t.silver_hr.join(paid, F.col("employee_id") == F.col("_e"), "left")
    return joined.select(
        "employee_id", "last_name", "department", "job_title", "office_location",
        F.coalesce("n", F.lit(0)).alias("payments"), "gross",
    )


@query(
    "ag_12_group_by_expression",
    f"""SELECT CAST(year(payment_date) AS BIGINT) AS y, {txt("CAST(date_trunc('month', payment_date) AS DATE)")} AS month_start, count(*) AS n
    FROM silver_payroll GROUP BY 1, 2""",
)
def ag_12(t):
    return t.silver_payroll.groupBy(
        F.year("payment_date").alias("y"), dates.month_start("payment_date").alias("month_start")
    ).agg(F.count("*").alias("n"))


@query("ag_13_group_by_map_value", "SELECT dim_owner AS owner, count(*) AS n FROM execution_log GROUP BY 1")
def ag_13(t):
    return t.execution_log.groupBy(nested.map_get("custom_dimensions", "owner").alias("owner")).agg(F.count("*").alias("n"))


@query(
    "ag_14_top_three_departments",
    f"""SELECT {txt('m')} AS month_start, string_agg(coalesce(department, '') || ':' || n, ',' ORDER BY rn) AS top_departments FROM (
      SELECT m, department, n, row_number() OVER (PARTITION BY m ORDER BY n DESC, department) AS rn FROM (
        SELECT CAST(date_trunc('month', payment_date) AS DATE) AS m, department, count(*) AS n
        FROM silver_payroll p JOIN silver_hr e ON p.employee_id = e.employee_id GROUP BY 1, 2)) WHERE rn <= 3 GROUP BY m""",
)
def ag_14(t):
    months = gold.monthly_payroll_trends(t.silver_hr, t.silver_payroll, POD, AS_OF)
    flat = F.transform("top_departments", lambda x: F.concat_ws(":", x["department"], x["payment_count"]))
    return months.select(F.col("payment_month_start").alias("month_start"), F.concat_ws(",", flat).alias("top_departments"))


@query("ag_15_distinct_rows", "SELECT DISTINCT * FROM bronze_hr")
def ag_15(t):
    return t.bronze_hr.distinct()


@query(
    "ag_16_distinct_groups",
    "SELECT DISTINCT employee_id, count(*) AS payments FROM bronze_payroll GROUP BY employee_id",
)
def ag_16(t):
    return t.bronze_payroll.groupBy("employee_id").agg(F.count("*").alias("payments"))


@query("ag_17_having", "SELECT employee_id, count(*) AS n FROM bronze_hr GROUP BY 1 HAVING count(*) > 1")
def ag_17(t):
    return t.bronze_hr.groupBy("employee_id").agg(F.count("*").alias("n")).where("n > 1")


@query(
    "ag_18_renamed_aggregates",
    f"""SELECT pod_id, count(company_id) AS company_count, CAST(sum(worker_count) AS BIGINT) AS total_workers,
    {dbl('sum(estimated_monthly_gb)')} AS total_gb_monthly FROM company_config GROUP BY 1""",
)
def ag_18(t):
    return tenants.pod_statistics(t.company_config)


@query(
    "ag_19_category_if_present",
    """SELECT category, count(*) AS record_count, 'grouped' AS shape FROM (SELECT department AS category FROM silver_hr) GROUP BY 1
    UNION ALL SELECT NULL, count(*), 'global' FROM silver_payroll""",
)
def ag_19(t):
    grouped = gold.generic_metrics(t.silver_hr.withColumnRenamed("department", "category")).withColumn("shape", F.lit("grouped"))
    overall = gold.generic_metrics(t.silver_payroll).select(
        F.lit(None).cast("string").alias("category"), F.col("total_records").alias("record_count"), F.lit("global").alias("shape")
    )
    return grouped.unionByName(overall)


@query(
    "ag_20_time_buckets",
    """SELECT strftime(date_trunc('hour', execution_start_time), '%Y-%m-%d %H:%M:%S') AS hour_start, count(*) AS total,
    count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, count(*) FILTER (WHERE status = 'FAILED') AS failed
    FROM execution_log GROUP BY 1""",
)
def ag_20(t):
    return runs.hourly_outcomes(t.execution_log)


@query(
    "ag_21_row_counts_with_total",
    """SELECT 'bronze_hr' AS table_name, (SELECT count(*) FROM bronze_hr) AS record_count
    UNION ALL SELECT 'bronze_payroll', (SELECT count(*) FROM bronze_payroll)
    UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM bronze_hr) + (SELECT count(*) FROM bronze_payroll)""",
)
def ag_21(t):
    return quality.row_counts({"bronze_hr": t.bronze_hr, "bronze_payroll": t.bronze_payroll}, total="TOTAL")


@query(
    "ag_22_truncated_mean",
    """SELECT pipeline_name, CAST(floor(avg(execution_duration_seconds)) AS BIGINT) AS whole_seconds,
    avg(execution_duration_seconds) AS seconds FROM execution_log GROUP BY 1""",
)
def ag_22(t):
    d = "execution_duration_seconds"
    return t.execution_log.groupBy("pipeline_name").agg(
        runs.average(d, truncate=True).alias("whole_seconds"), runs.average(d).alias("seconds")
    )


# ---- windows -----------------------------------------------------------------------


@query(
    "wn_1_share_of_count",
    f"SELECT payment_method, {pct('n', 'sum(n) OVER ()')} AS volume_pct FROM (SELECT payment_method, count(*) AS n FROM silver_payroll GROUP BY 1)",
)
def wn_1(t):
    n = t.silver_payroll.groupBy("payment_method").agg(F.count("*").alias("n"))
    return n.select("payment_method", money.percent(F.col("n"), F.sum("n").over(Window.partitionBy())).alias("volume_pct"))


@query(
    "wn_2_share_of_value",
    f"SELECT payment_method, {pct('g', 'sum(g) OVER ()')} AS value_pct FROM (SELECT payment_method, sum(gross_pay) AS g FROM silver_payroll GROUP BY 1)",
)
def wn_2(t):
    g = t.silver_payroll.groupBy("payment_method").agg(money.total("gross_pay").alias("g"))
    return g.select("payment_method", money.percent(F.col("g"), F.sum("g").over(Window.partitionBy())).alias("value_pct"))


@query(
    "wn_3_top_n_per_group",
    f"""SELECT department, employee_id, {dbl('salary')} AS salary, CAST(rank AS BIGINT) AS rank FROM (SELECT *, row_number() OVER (
    PARTITION BY department ORDER BY salary DESC, employee_id) AS rank FROM silver_hr) WHERE rank <= 3""",
)
def wn_3(t):
    rows = t.silver_hr.select("department", "employee_id", "salary")
    return gold.top_n_per_group(rows, ["department"], [F.col("salary").desc(), F.col("employee_id").asc()], 3)


@query(
    "wn_4_latest_row_per_key",
    "SELECT employee_id, department, strftime(created_datetime, '%Y-%m-%d %H:%M:%S') AS created_datetime FROM silver_hr",
)
def wn_4(t):
    return t.silver_hr.select("employee_id", "department", "created_datetime")


FIRING_SQL = """firing AS (SELECT 'fail-' || pipeline_name AS rule, CAST(epoch(execution_start_time) AS BIGINT) // 60 AS minute,
    count(*) AS firings FROM execution_log WHERE status = 'FAILED' GROUP BY 1, 2)"""


def firings(t):
    failed = t.execution_log.where("status = 'FAILED'").select(
        F.concat(F.lit("fail-"), "pipeline_name").alias("alert_rule_id"),
        F.lit(60).alias("cooldown_minutes"), F.col("execution_start_time").alias("fired_at"),
    )
    return alerts.firing_minutes(failed)


@query(
    "wn_5_gap_since_previous_firing",
    f"""WITH {FIRING_SQL} SELECT rule AS alert_rule_id, minute, firings, minute - lag(minute) OVER w AS gap_minutes,
    coalesce(minute - lag(minute) OVER w >= 60, true) AS sent FROM firing WINDOW w AS (PARTITION BY rule ORDER BY minute)""",
)
def wn_5(t):
    return alerts.gap_since_previous(firings(t)).drop("cooldown_minutes")


# ---- orderings ------------------------------------------------------------------------


@query(
    "or_1_mixed_direction",
    f"SELECT payment_id, {txt('payment_date')} AS payment_date FROM silver_payroll ORDER BY payment_date DESC, payment_id",
)
def or_1(t):
    return t.silver_payroll.orderBy(F.col("payment_date").desc(), "payment_id").select("payment_id", "payment_date")


@query(
    "or_2_top_k",
    f"SELECT employee_id, {dbl('salary')} AS salary FROM silver_hr WHERE employment_status = 'Active' ORDER BY silver_hr.salary DESC, employee_id LIMIT 10",
)
def or_2(t):
    active = t.silver_hr.where("employment_status = 'Active'")
    return active.orderBy(F.col("salary").desc(), "employee_id").limit(10).select("employee_id", "salary")


@query(
    "or_3_first_rows",
    "SELECT payment_id, employee_id FROM typed_payroll WHERE payment_id IS NOT NULL ORDER BY payment_id LIMIT 20",
)
def or_3(t):
    rows = t.bronze_payroll.select(F.col("payment_id").try_cast("long").alias("payment_id"), F.col("employee_id").try_cast("long").alias("employee_id"))
    return rows.where("payment_id IS NOT NULL").orderBy("payment_id").limit(20)


@query(
    "or_4_semantic_order",
    """SELECT company_id, priority, CAST(CASE priority WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 WHEN 'LOW' THEN 2 ELSE 3 END AS BIGINT) AS priority_rank
    FROM company_config""",
)
def or_4(t):
    ranked = t.company_config.select("company_id", "priority", ranking.priority_rank("priority").alias("priority_rank"))
    return ranked.orderBy("priority_rank", "company_id")


def _departments(t):
    return gold.department_payroll_analytics(t.silver_hr, t.silver_payroll, POD, AS_OF, AS_OF)


@query(
    "or_5_department_cost_order",
    f"""SELECT department, office_location, {dbl('sum(gross_pay)')} AS gross FROM silver_hr e
    LEFT JOIN silver_payroll p ON e.employee_id = p.employee_id GROUP BY 1, 2 ORDER BY gross DESC""",
)
def or_5(t):
    return gold.department_cost_ranking(_departments(t)).select(
        "department", "office_location", F.col("ytd_total_gross_pay").alias("gross")
    )


@query(
    "or_6_newest_month_first",
    f"""SELECT {txt("CAST(date_trunc('month', payment_date) AS DATE)")} AS month_start, {dbl('sum(net_pay)')} AS net
    FROM silver_payroll GROUP BY 1 ORDER BY 1 DESC""",
)
def or_6(t):
    g = t.silver_payroll.groupBy(dates.month_start("payment_date").alias("month_start")).agg(money.total("net_pay").alias("net"))
    return g.orderBy(F.col("month_start").desc())


@query(
    "or_7_recent_failures",
    """SELECT execution_id, error_message FROM execution_log WHERE status = 'FAILED'
    ORDER BY execution_start_time DESC, execution_id LIMIT 25""",
)
def or_7(t):
    failed = t.execution_log.where("status = 'FAILED'")
    return failed.orderBy(F.col("execution_start_time").desc(), "execution_id").limit(25).select("execution_id", "error_message")


# ---- set operations ---------------------------------------------------------------------


@query(
    "so_1_union_of_labelled_metrics",
    """SELECT 'null_id' AS metric, count(*) AS n FROM bronze_hr WHERE employee_id IS NULL
    UNION ALL SELECT 'null_email', count(*) FROM bronze_hr WHERE email IS NULL
    UNION ALL SELECT 'null_salary', count(*) FROM bronze_hr WHERE salary IS NULL""",
)
def so_1(t):
    counts = t.bronze_hr.agg(
        F.count_if(F.col("employee_id").isNull()).alias("null_id"), F.count_if(F.col("email").isNull()).alias("null_email"),
        F.count_if(F.col("salary").isNull()).alias("null_salary"),
    )
    return counts.unpivot([], ["null_id", "null_email", "null_salary"], "metric", "n")


@query(
    "so_2_union_of_checks",
    """SELECT 'HR Employees' AS table_name, (SELECT count(*) FROM silver_hr) AS record_count, 'PASS' AS status
    UNION ALL SELECT 'Payroll Payments', (SELECT count(*) FROM silver_payroll), 'PASS'""",
)
def so_2(t):
    return quality.dependency_check({"HR Employees": t.silver_hr, "Payroll Payments": t.silver_payroll})


@query(
    "so_3_union_of_tenants",
    """SELECT company, count(*) AS n FROM (SELECT 'finance' AS company FROM bronze_payroll
    UNION ALL SELECT 'operations' FROM bronze_payroll WHERE payment_method IS NULL) GROUP BY 1""",
)
def so_3(t):
    pay = t.bronze_payroll.select("payment_id", "payment_method")
    both = tenants.label_tenants({"finance": pay, "operations": pay.where("payment_method IS NULL")})
    return both.groupBy("company").agg(F.count("*").alias("n"))


@query(
    "so_4_scalar_subquery",
    f"""SELECT status, count(*) AS n, {pct('count(*)', '(SELECT count(*) FROM execution_log)')} AS share FROM execution_log GROUP BY 1""",
)
def so_4(t):
    log = t.execution_log
    total = log.agg(F.count("*").alias("total")).scalar()
    return log.groupBy("status").agg(F.count("*").alias("n")).select("status", "n", money.percent(F.col("n"), total).alias("share"))


@query(
    "so_5_not_exists",
    """SELECT employee_id FROM silver_hr e WHERE NOT EXISTS (SELECT 1 FROM silver_payroll p WHERE p.employee_id = e.employee_id)""",
)
def so_5(t):
    paid = t.silver_payroll.select("employee_id")
    return t.silver_hr.select("employee_id").join(paid, "employee_id", "left_anti")


@query(
    "so_6_missing_and_found_domains",
    """SELECT c.company, array_to_string(list_sort(list_filter(c.domains, lambda d: NOT list_contains(coalesce(f.found, []), d))), ',') AS missing,
    array_to_string(list_sort(list_filter(c.domains, lambda d: list_contains(coalesce(f.found, []), d))), ',') AS found
    FROM company_config c LEFT JOIN (SELECT company, list(DISTINCT domain) AS found FROM bronze_files
      WHERE file_name LIKE '%.csv' OR file_name LIKE '%.parquet' GROUP BY 1) f ON c.company = f.company""",
)
def so_6(t):
    found = tenants.domains_found(t.bronze_files)
    joined = t.company_config.select("pod_id", "company", "domains").join(found, ["pod_id", "company"], "left")
    got = F.coalesce("found", F.array().cast("array<string>"))
    return joined.select(
        "company",
        F.concat_ws(",", F.sort_array(nested.missing_items("domains", got))).alias("missing"),
        F.concat_ws(",", F.sort_array(nested.shared_items("domains", got))).alias("found"),
    )


@query(
    "so_7_present_but_not_listed",
    """SELECT archive, path FROM archive_members m WHERE NOT EXISTS (SELECT 1 FROM manifest_lines l
    WHERE l.archive = m.archive AND replace(substr(l.line, 66), chr(92), '/') = m.path)""",
)
def so_7(t):
    listed = manifests.parse_entries(t.manifest_lines).select("archive", "path")
    return t.archive_members.select("archive", "path").join(listed, ["archive", "path"], "left_anti")
