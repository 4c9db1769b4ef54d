"""Gold marts, analyst queries and per-tenant metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.functions import money
from silverlode.operators import cleanse, gold, quality

from .frames import AS_OF, POD, PROCESSED_AT
from .oracle import dbl, mean2, pct, txt
from .registry import query

GOLD_STAMP = "'2001-01-01 06:00:00' AS gold_processed_timestamp, 'podA' AS pod_id"

def _summary_sql(when: str = "true") -> str:
    return f"""SELECT e.employee_id, e.first_name, e.last_name, e.email, e.department, e.job_title, e.employment_status,
  {txt('e.hire_date')} AS hire_date, e.office_location, {dbl('e.salary')} AS annual_salary, e.manager_id,
  any_value(m.first_name || ' ' || m.last_name) AS manager_name, count(DISTINCT p.payment_id) AS total_payments,
  {txt('min(p.payment_date)')} AS first_payment_date, {txt('max(p.payment_date)')} AS last_payment_date,
  {dbl('sum(p.gross_pay)')} AS ytd_gross_pay, {dbl('sum(p.tax_withheld)')} AS ytd_tax_withheld,
  {dbl('sum(p.deductions)')} AS ytd_deductions, {dbl('sum(p.net_pay)')} AS ytd_net_pay,
  {mean2('sum(p.gross_pay)', 'count(p.payment_id)')} AS avg_gross_pay_per_payment,
  {mean2('sum(p.net_pay)', 'count(p.payment_id)')} AS avg_net_pay_per_payment,
  {pct('sum(p.tax_withheld)', 'sum(p.gross_pay)')} AS effective_tax_rate_pct,
  {pct('sum(p.deductions)', 'sum(p.gross_pay)')} AS deduction_rate_pct,
  any_value(u.payment_method) AS primary_payment_method, {GOLD_STAMP}
FROM silver_hr e LEFT JOIN silver_payroll p ON e.employee_id = p.employee_id AND {when}
LEFT JOIN silver_hr m ON e.manager_id = m.employee_id
LEFT JOIN (SELECT employee_id, payment_method, row_number() OVER (PARTITION BY employee_id ORDER BY count(*) DESC, payment_method) AS rn
           FROM silver_payroll p WHERE {when} GROUP BY 1, 2) u ON u.employee_id = e.employee_id AND u.rn = 1
GROUP BY ALL"""


SUMMARY_SQL = _summary_sql()

TENURE = """CAST((20000 * CAST(sum(days) AS HUGEINT) + 36525 * sum(w)) // (2 * 36525 * sum(w)) AS DOUBLE) / 100"""


def _department_sql(weight: str) -> str:
    return f"""SELECT department, office_location, count(*) AS total_employees,
  count(*) FILTER (WHERE employment_status = 'Active') AS active_employees,
  count(*) FILTER (WHERE employment_status = 'On Leave') AS on_leave_employees,
  count(*) FILTER (WHERE employment_status = 'Terminated') AS terminated_employees,
  {dbl('sum(salary * w)')} AS total_annual_salaries, {mean2('sum(salary * w)', 'CAST(sum(w) AS BIGINT)')} AS avg_annual_salary,
  {dbl('min(salary)')} AS min_annual_salary, {dbl('max(salary)')} AS max_annual_salary,
  CAST(coalesce(sum(n), 0) AS BIGINT) AS total_payments, {dbl('sum(g)')} AS ytd_total_gross_pay, {dbl('sum(x)')} AS ytd_total_tax_withheld,
  {dbl('sum(d)')} AS ytd_total_deductions, {dbl('sum(net)')} AS ytd_total_net_pay,
  {mean2('sum(g)', 'count(*)')} AS ytd_avg_gross_per_employee, {mean2('sum(net)', 'count(*)')} AS ytd_avg_net_per_employee,
  {pct('sum(x)', 'sum(g)')} AS dept_effective_tax_rate_pct, {TENURE} AS avg_tenure_years, {GOLD_STAMP}
FROM (SELECT e.*, p.*, {weight} AS w, date_diff('day', hire_date, DATE '2001-01-01') * {weight} AS days FROM silver_hr e
  LEFT JOIN (SELECT employee_id AS eid, count(*) AS n, sum(gross_pay) AS g, sum(tax_withheld) AS x, sum(deductions) AS d, sum(net_pay) AS net
             FROM silver_payroll GROUP BY 1) p ON e.employee_id = p.eid)
GROUP BY department, office_location"""


DEPARTMENT_SQL = _department_sql("1")

MONTH_SQL = f"""SELECT CAST(year(m) AS BIGINT) AS payment_year, CAST(month(m) AS BIGINT) AS payment_month, {txt('m')} AS payment_month_start,
  count(DISTINCT payment_id) AS total_payments, count(DISTINCT employee_id) AS unique_employees_paid,
  {dbl('sum(gross_pay)')} AS total_gross_pay, {dbl('sum(tax_withheld)')} AS total_tax_withheld, {dbl('sum(deductions)')} AS total_deductions,
  {dbl('sum(net_pay)')} AS total_net_pay, {mean2('sum(gross_pay)', 'count(*)')} AS avg_gross_pay_per_payment,
  {mean2('sum(net_pay)', 'count(*)')} AS avg_net_pay_per_payment, {pct('sum(tax_withheld)', 'sum(gross_pay)')} AS effective_tax_rate_pct,
  count(DISTINCT CASE WHEN payment_method = 'Direct Deposit' THEN payment_id END) AS direct_deposit_count,
  count(DISTINCT CASE WHEN payment_method = 'Check' THEN payment_id END) AS check_count,
  count(DISTINCT CASE WHEN payment_method NOT IN ('Direct Deposit', 'Check') THEN payment_id END) AS other_count,
  any_value(top_departments) AS top_departments, {GOLD_STAMP}
FROM (SELECT p.*, CAST(date_trunc('month', payment_date) AS DATE) AS m FROM silver_payroll p JOIN silver_hr e ON p.employee_id = e.employee_id) r
JOIN (SELECT tm, string_agg(coalesce(department, '') || ':' || n, ',' ORDER BY rn) AS top_departments FROM (
  SELECT tm, department, n, row_number() OVER (PARTITION BY tm ORDER BY n DESC, department) AS rn FROM (
    SELECT CAST(date_trunc('month', payment_date) AS DATE) AS tm, department, count(*) AS n
    FROM silver_payroll p JOIN silver_hr e ON p.employee_id = e.employee_id GROUP BY 1, 2)) WHERE rn <= 3 GROUP BY tm) ON tm = m
GROUP BY m"""

METHOD_SQL = f"""SELECT payment_method, count(DISTINCT payment_id) AS total_payments, count(DISTINCT p.employee_id) AS unique_employees,
  {dbl('sum(gross_pay)')} AS total_gross_pay, {dbl('sum(net_pay)')} AS total_net_pay, {mean2('sum(gross_pay)', 'count(*)')} AS avg_gross_pay,
  {mean2('sum(net_pay)', 'count(*)')} AS avg_net_pay, {pct('count(*)', 'sum(count(*)) OVER ()')} AS payment_volume_pct,
  {pct('sum(gross_pay)', 'sum(sum(gross_pay)) OVER ()')} AS payment_value_pct, count(DISTINCT department) AS departments_using_method,
  {txt('min(payment_date)')} AS first_payment_date, {txt('max(payment_date)')} AS last_payment_date, {GOLD_STAMP}
FROM silver_payroll p JOIN silver_hr e ON p.employee_id = e.employee_id GROUP BY payment_method"""


def summary(t):
    return gold.employee_payroll_summary(t.silver_hr, t.silver_payroll, POD, PROCESSED_AT)


def departments(t):
    return gold.department_payroll_analytics(t.silver_hr, t.silver_payroll, POD, AS_OF, PROCESSED_AT)


def months(t):
    return gold.monthly_payroll_trends(t.silver_hr, t.silver_payroll, POD, PROCESSED_AT)


def methods(t):
    return gold.payment_method_analysis(t.silver_hr, t.silver_payroll, POD, PROCESSED_AT)


@query("gd_1_employee_payroll_summary", SUMMARY_SQL)
def gd_1(t):
    return summary(t)


@query(
    "gd_1_summary_of_one_year",
    f"""SELECT e.employee_id, count(p.payment_id) AS total_payments, {dbl('sum(p.gross_pay)')} AS ytd_gross_pay
    FROM silver_hr e LEFT JOIN silver_payroll p ON e.employee_id = p.employee_id AND year(p.payment_date) = 2000 GROUP BY 1""",
)
def gd_1_year(t):
    one_year = gold.employee_payroll_summary(t.silver_hr, t.silver_payroll, POD, PROCESSED_AT, year=2000)
    return one_year.select("employee_id", "total_payments", "ytd_gross_pay")


@query("gd_2_department_payroll_analytics", DEPARTMENT_SQL)
def gd_2(t):
    return departments(t)


@query("gd_2_department_salaries_per_payment", _department_sql("greatest(coalesce(n, 0), 1)"))
def gd_2_repeat(t):
    return gold.department_payroll_analytics(
        t.silver_hr, t.silver_payroll, POD, AS_OF, PROCESSED_AT, repeat_salaries=True
    )


@query("gd_3_monthly_payroll_trends", MONTH_SQL)
def gd_3(t):
    flat = F.transform("top_departments", lambda x: F.concat_ws(":", x["department"], x["payment_count"]))
    return months(t).withColumn("top_departments", F.concat_ws(",", flat))


@query("gd_4_payment_method_analysis", METHOD_SQL)
def gd_4(t):
    return methods(t)


REPORT_SQL = "'2001-01-01' AS report_date, 'podA' AS pod_id, 'finance' AS company"


@query(
    "gd_5_finance_hr_metrics",
    f"""SELECT upper(department) AS department, count(*) AS employee_count,
    {mean2("CASE WHEN count(s) > 0 THEN sum(s) + 100000 * count(s) END", 'count(s)')} - 100000 AS avg_salary,
    min(hire_date) AS earliest_hire, max(hire_date) AS latest_hire, {REPORT_SQL}, 'hr' AS domain
    FROM (SELECT DISTINCT *, CAST(salary AS DECIMAL(12,2)) AS s FROM bronze_hr WHERE employee_id IS NOT NULL) GROUP BY upper(department)""",
)
def gd_5(t):
    silver = cleanse.default_rules().apply(t.bronze_hr, POD, "finance", "hr", PROCESSED_AT)
    out = gold.with_report_columns(gold.finance_hr_metrics(silver), AS_OF, pod_id=POD, company="finance", domain="hr")
    return out.withColumn("avg_salary", F.col("avg_salary").cast("decimal(20,2)"))


@query(
    "gd_6_finance_payroll_metrics",
    f"""SELECT department, count(DISTINCT e.employee_id) AS employee_count, {dbl('sum(CAST(base_salary AS DECIMAL(12,2)))')} AS total_base_salary,
    {dbl('sum(CAST(bonus AS DECIMAL(12,2)))')} AS total_bonus,
    {dbl('sum(CAST(base_salary AS DECIMAL(12,2))) + sum(CAST(bonus AS DECIMAL(12,2)))')} AS total_compensation,
    {REPORT_SQL}, 'payroll' AS domain
    FROM (SELECT DISTINCT * FROM simple_payroll WHERE employee_id IS NOT NULL AND CAST(base_salary AS DECIMAL(12,2)) > 0) p
    JOIN silver_hr e ON CAST(p.employee_id AS BIGINT) = e.employee_id GROUP BY 1""",
)
def gd_6(t):
    silver = cleanse.default_rules().apply(t.simple_payroll, POD, "finance", "payroll", PROCESSED_AT)
    paid = gold.per_employee(silver, ["base_salary", "bonus"])
    metrics = gold.finance_payroll_metrics(gold.with_department(paid, t.silver_hr))
    return gold.with_report_columns(metrics, AS_OF, pod_id=POD, company="finance", domain="payroll")


@query(
    "gd_7_operations_metrics",
    f"SELECT department AS category, count(*) AS record_count, round(avg(CAST(salary AS DOUBLE)), 4) AS avg_metric FROM silver_hr GROUP BY 1",
)
def gd_7(t):
    rows = t.silver_hr.select(F.col("department").alias("category"), F.col("salary").alias("metric_value"))
    return gold.operations_metrics(rows).withColumn("avg_metric", F.round("avg_metric", 4))


@query(
    "gd_8_generic_metrics",
    """SELECT department AS category, count(*) AS record_count, '2001-01-01' AS report_date, 'podB' AS pod_id FROM silver_hr GROUP BY 1""",
)
def gd_8(t):
    rows = t.silver_hr.withColumnRenamed("department", "category")
    return gold.with_report_columns(gold.generic_metrics(rows), AS_OF, pod_id="podB")


@query(
    "gd_8_generic_metrics_global",
    "SELECT count(*) AS total_records, '2001-01-01' AS report_date, 'podB' AS pod_id FROM silver_payroll",
)
def gd_8_global(t):
    return gold.with_report_columns(gold.generic_metrics(t.silver_payroll), AS_OF, pod_id="podB")


@query(
    "gd_9_employee_salary_summary",
    f"""SELECT department, count(*) AS employee_count, {mean2('sum(salary)', 'count(*)')} AS avg_salary, {dbl('min(salary)')} AS min_salary,
    {dbl('max(salary)')} AS max_salary, round(stddev_samp(CAST(salary AS DOUBLE)), 4) AS salary_stddev, {dbl('sum(salary)')} AS total_salary
    FROM silver_hr GROUP BY 1""",
)
def gd_9(t):
    return gold.employee_salary_summary(t.silver_hr)


@query(
    "gd_10_department_payroll_totals",
    f"""SELECT department, count(*) AS employee_count, {dbl('sum(salary)')} AS monthly_payroll, {dbl('sum(bonus)')} AS monthly_bonus, {REPORT_SQL}
    FROM (SELECT e.employee_id, any_value(e.department) AS department, any_value(e.salary) AS salary, sum(CAST(p.bonus AS DECIMAL(12,2))) AS bonus
      FROM silver_hr e JOIN simple_payroll p ON e.employee_id = CAST(p.employee_id AS BIGINT) GROUP BY e.employee_id)
    GROUP BY 1""",
)
def gd_10(t):
    pay = gold.per_employee(t.simple_payroll, ["bonus"])
    rows = t.silver_hr.select("employee_id", "department", "salary").join(pay, "employee_id")
    return gold.department_payroll_totals(rows, AS_OF, pod_id=POD, company="finance")


@query(
    "gd_11_employee_details",
    f"""SELECT employee_id, first_name, last_name, department, job_title, {dbl('salary')} AS salary, {txt('hire_date')} AS hire_date,
    '2001-01-01 06:00:00' AS processed_timestamp, 'podA' AS pod_id, 'finance' AS company FROM silver_hr""",
)
def gd_11(t):
    return gold.employee_details(t.silver_hr, pod_id=POD, company="finance")


@query(
    "gd_12_top_paid_active",
    f"""SELECT employee_id, first_name, last_name, department, job_title, annual_salary, ytd_gross_pay, ytd_net_pay, effective_tax_rate_pct
    FROM ({SUMMARY_SQL}) WHERE employment_status = 'Active' ORDER BY ytd_gross_pay DESC NULLS LAST, employee_id LIMIT 10""",
)
def gd_12(t):
    return gold.top_paid_active(summary(t))


@query(
    "gd_13_department_cost_ranking",
    f"""SELECT department, office_location, active_employees, ytd_total_gross_pay, ytd_avg_gross_per_employee,
    dept_effective_tax_rate_pct, avg_tenure_years FROM ({DEPARTMENT_SQL})""",
)
def gd_13(t):
    return gold.department_cost_ranking(departments(t))


@query(
    "gd_14_payroll_trend",
    f"""SELECT payment_month_start, unique_employees_paid, total_gross_pay, total_net_pay, avg_gross_pay_per_payment,
    effective_tax_rate_pct, direct_deposit_count, check_count FROM ({MONTH_SQL})""",
)
def gd_14(t):
    return gold.payroll_trend(months(t))


@query(
    "gd_15_active_without_payroll",
    f"""SELECT employee_id, first_name, last_name, department, employment_status, hire_date, annual_salary, total_payments, last_payment_date
    FROM ({SUMMARY_SQL}) WHERE employment_status = 'Active' AND coalesce(total_payments, 0) = 0""",
)
def gd_15(t):
    return gold.active_without_payroll(summary(t))


@query(
    "gd_16_gold_row_counts",
    """SELECT 'employee_payroll_summary' AS gold_table, count(*) AS record_count FROM silver_hr
    UNION ALL SELECT 'department_payroll_analytics', count(*) FROM (SELECT DISTINCT department, office_location FROM silver_hr)
    UNION ALL SELECT 'monthly_payroll_trends', count(*) FROM (SELECT DISTINCT date_trunc('month', payment_date) FROM silver_payroll)
    UNION ALL SELECT 'payment_method_analysis', count(*) FROM (SELECT DISTINCT payment_method FROM silver_payroll)""",
)
def gd_16(t):
    tables = {
        "employee_payroll_summary": summary(t),
        "department_payroll_analytics": departments(t),
        "monthly_payroll_trends": months(t),
        "payment_method_analysis": methods(t),
    }
    return quality.row_counts(tables, "gold_table")


@query(
    "gd_17_run_summary",
    """SELECT (SELECT count(*) FROM bronze_payroll) AS bronze_records, (SELECT count(*) FROM cleansed_payroll) AS records_after_cleansing,
    (SELECT count(*) FROM silver_payroll) AS silver_records, 'podA' AS pod_id, 'payroll' AS domain, 'PAYROLL_PAYMENTS' AS source_file,
    '2001-01-01 06:00:00' AS completed_at""",
)
def gd_17(t):
    return quality.run_summary(
        POD, "payroll", cleanse.PAYROLL_SOURCE, PROCESSED_AT,
        bronze_records=t.bronze_payroll, records_after_cleansing=t.cleansed_payroll, silver_records=t.silver_payroll,
    )
