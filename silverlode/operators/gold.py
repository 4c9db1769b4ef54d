"""Silver -> gold marts and the analyst queries on them.

Payments are reduced to one row per employee (and month or method) before they
meet the staff table: the join is then one to one, salaries are not repeated per
payment, and an employee with very many payments is combined map-side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from silverlode.functions import dates, money, text

PAY_SUMS = ("gross_pay", "tax_withheld", "deductions", "net_pay")

# Employment status labels.
ACTIVE, ON_LEAVE, TERMINATED = "Active", "On Leave", "Terminated"

ALL_METHODS = (*text.PAYMENT_METHODS, text.UNKNOWN_METHOD)


def _of_pod(df: DataFrame, pod: str, year: int | None = None) -> DataFrame:
    out = df.where(F.col("pod_id") == pod)
    return out if year is None else out.where(F.year("payment_date") == year)


def _pay_aggregates() -> list[Column]:
    return [
        F.count("*").alias("n"),
        *[money.total(c).alias(c) for c in PAY_SUMS],
        F.min("payment_date").alias("first_payment_date"),
        F.max("payment_date").alias("last_payment_date"),
    ]


def _resum() -> list[Column]:
    return [
        F.sum("n").alias("n"),
        *[money.total(c).alias(c) for c in PAY_SUMS],
        F.min("first_payment_date").alias("first_payment_date"),
        F.max("last_payment_date").alias("last_payment_date"),
    ]


def most_frequent(counts: dict[str, Column]) -> Column:
    """Label with the highest count; ties go to the alphabetically first label.

    The labels are a closed set, so the mode is a fixed number of counters in
    the same hash aggregate instead of a per-group histogram.
    """
    ordered = sorted(counts)
    best = F.greatest(*[F.coalesce(counts[k], F.lit(0)) for k in ordered])
    return F.coalesce(*[F.when((counts[k] == best) & (best > 0), F.lit(k)) for k in ordered])


def with_manager_name(employees: DataFrame) -> DataFrame:
    """Adds ``manager_name``, null where the manager is not in the table."""
    managers = employees.select(
        F.col("employee_id").alias("_mid"),
        F.col("pod_id").alias("_mpod"),
        text.full_name("first_name", "last_name").alias("manager_name"),
    )
    same = (employees["manager_id"] == F.col("_mid")) & (employees["pod_id"] == F.col("_mpod"))
    return employees.join(managers, same, "left").drop("_mid", "_mpod")


def employee_payroll_summary(
    employees: DataFrame, payments: DataFrame, pod: str, processed_at: str, year: int | None = None
) -> DataFrame:
    """One row per employee with pay totals, averages, rates and usual method."""
    method_counts = [F.count_if(F.col("payment_method") == m).alias(f"_m{i}") for i, m in enumerate(ALL_METHODS)]
    paid = _of_pod(payments, pod, year).groupBy("employee_id").agg(*_pay_aggregates(), *method_counts)
    paid = paid.withColumnRenamed("employee_id", "_eid")
    staff = with_manager_name(_of_pod(employees, pod))
    joined = staff.join(paid, F.col("employee_id") == F.col("_eid"), "left")
    return joined.select(
        "employee_id", "first_name", "last_name", "email", "department", "job_title", "employment_status",
        "hire_date", "office_location",
        F.col("salary").alias("annual_salary"),
        "manager_id", "manager_name",
        F.coalesce("n", F.lit(0)).alias("total_payments"),
        "first_payment_date", "last_payment_date",
        F.col("gross_pay").alias("ytd_gross_pay"),
        F.col("tax_withheld").alias("ytd_tax_withheld"),
        F.col("deductions").alias("ytd_deductions"),
        F.col("net_pay").alias("ytd_net_pay"),
        money.mean2(F.col("gross_pay"), F.col("n")).alias("avg_gross_pay_per_payment"),
        money.mean2(F.col("net_pay"), F.col("n")).alias("avg_net_pay_per_payment"),
        money.percent(F.col("tax_withheld"), F.col("gross_pay")).alias("effective_tax_rate_pct"),
        money.percent(F.col("deductions"), F.col("gross_pay")).alias("deduction_rate_pct"),
        most_frequent({m: F.col(f"_m{i}") for i, m in enumerate(ALL_METHODS)}).alias("primary_payment_method"),
        F.lit(processed_at).cast("timestamp").alias("gold_processed_timestamp"),
        F.lit(pod).alias("pod_id"),
    )


def department_payroll_analytics(
    employees: DataFrame, payments: DataFrame, pod: str, as_of: str, processed_at: str, year: int | None = None,
    repeat_salaries: bool = False,
) -> DataFrame:
    """Headcount, salary, pay and tenure per department and office.

    ``repeat_salaries`` counts an employee's salary and tenure once per payment,
    which is what grouping after the payments join yields.
    """
    paid = _of_pod(payments, pod, year).groupBy(F.col("employee_id").alias("_eid")).agg(*_pay_aggregates())
    joined = _of_pod(employees, pod).join(paid, F.col("employee_id") == F.col("_eid"), "left")
    weight = F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)) if repeat_salaries else F.lit(1)
    tenure_days = F.datediff(dates.day(as_of), "hire_date").cast("long")
    status = F.col("employment_status")
    g = joined.groupBy("department", "office_location").agg(
        F.count("*").alias("total_employees"),
        F.count_if(status == ACTIVE).alias("active_employees"),
        F.count_if(status == ON_LEAVE).alias("on_leave_employees"),
        F.count_if(status == TERMINATED).alias("terminated_employees"),
        F.sum(F.col("salary") * weight).cast(money.WIDE).alias("total_annual_salaries"),
        F.sum(weight).alias("_w"),
        F.min("salary").alias("min_annual_salary"),
        F.max("salary").alias("max_annual_salary"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_payments"),
        *[money.total(c).alias(c) for c in PAY_SUMS],
        F.sum(tenure_days * weight).alias("_tenure_days"),
    )
    years = F.col("_tenure_days") / (F.lit(dates.DAYS_PER_YEAR).cast("decimal(5,2)") * F.col("_w"))
    return g.select(
        "department", "office_location", "total_employees", "active_employees", "on_leave_employees",
        "terminated_employees", "total_annual_salaries",
        money.mean2(F.col("total_annual_salaries"), F.col("_w")).alias("avg_annual_salary"),
        "min_annual_salary", "max_annual_salary", "total_payments",
        F.col("gross_pay").alias("ytd_total_gross_pay"),
        F.col("tax_withheld").alias("ytd_total_tax_withheld"),
        F.col("deductions").alias("ytd_total_deductions"),
        F.col("net_pay").alias("ytd_total_net_pay"),
        money.mean2(F.col("gross_pay"), F.col("total_employees")).alias("ytd_avg_gross_per_employee"),
        money.mean2(F.col("net_pay"), F.col("total_employees")).alias("ytd_avg_net_per_employee"),
        money.percent(F.col("tax_withheld"), F.col("gross_pay")).alias("dept_effective_tax_rate_pct"),
        F.round(years, 2).alias("avg_tenure_years"),
        F.lit(processed_at).cast("timestamp").alias("gold_processed_timestamp"),
        F.lit(pod).alias("pod_id"),
    )


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per group with their ``rank``; limited map-side first."""
    ranked = df.withColumn("rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("rank") <= n)


def monthly_payroll_trends(employees: DataFrame, payments: DataFrame, pod: str, processed_at: str) -> DataFrame:
    """Pay totals per month with method split and the three busiest departments."""
    month = dates.month_start("payment_date").alias("payment_month_start")
    methods = {"direct_deposit_count": "Direct Deposit", "check_count": "Check"}
    split = [F.count_if(F.col("payment_method") == m).alias(c) for c, m in methods.items()]
    per_employee = _of_pod(payments, pod).groupBy(month, "employee_id").agg(*_pay_aggregates(), *split)
    staff = _of_pod(employees, pod).select(F.col("employee_id").alias("_eid"), "department")
    joined = per_employee.join(staff, F.col("employee_id") == F.col("_eid"), "inner")

    per_department = joined.groupBy("payment_month_start", "department").agg(
        F.count("*").alias("people"), *_resum(), *[F.sum(c).alias(c) for c in methods]
    )
    # One row per month and department is left here.  The window's partitioning
    # by month also serves the final aggregate, so ranking costs no extra shuffle.
    busiest = Window.partitionBy("payment_month_start").orderBy(F.col("n").desc(), F.col("department").asc_nulls_last())
    ranked = per_department.withColumn("rank", F.row_number().over(busiest))
    leader = F.when(F.col("rank") <= 3, F.struct("rank", "department", F.col("n").alias("payment_count")))
    # An employee has one department, so people add up over departments.
    g = ranked.groupBy("payment_month_start").agg(
        F.sum("people").alias("unique_employees_paid"),
        *_resum(),
        *[F.sum(c).alias(c) for c in methods],
        F.sort_array(F.collect_list(leader)).alias("_top"),
    )
    top_departments = F.transform("_top", lambda x: F.struct(x["department"], x["payment_count"]))
    return g.select(
        F.year("payment_month_start").alias("payment_year"),
        F.month("payment_month_start").alias("payment_month"),
        "payment_month_start",
        F.col("n").alias("total_payments"),
        "unique_employees_paid",
        F.col("gross_pay").alias("total_gross_pay"),
        F.col("tax_withheld").alias("total_tax_withheld"),
        F.col("deductions").alias("total_deductions"),
        F.col("net_pay").alias("total_net_pay"),
        money.mean2(F.col("gross_pay"), F.col("n")).alias("avg_gross_pay_per_payment"),
        money.mean2(F.col("net_pay"), F.col("n")).alias("avg_net_pay_per_payment"),
        money.percent(F.col("tax_withheld"), F.col("gross_pay")).alias("effective_tax_rate_pct"),
        *methods,
        (F.col("n") - F.col("direct_deposit_count") - F.col("check_count")).alias("other_count"),
        top_departments.alias("top_departments"),
        F.lit(processed_at).cast("timestamp").alias("gold_processed_timestamp"),
        F.lit(pod).alias("pod_id"),
    )


def payment_method_analysis(employees: DataFrame, payments: DataFrame, pod: str, processed_at: str) -> DataFrame:
    """Volume, value and shares per payment method."""
    per_employee = _of_pod(payments, pod).groupBy("payment_method", "employee_id").agg(*_pay_aggregates())
    staff = _of_pod(employees, pod).select(F.col("employee_id").alias("_eid"), "department")
    per_department = (
        per_employee.join(staff, F.col("employee_id") == F.col("_eid"), "inner")
        .groupBy("payment_method", "department")
        .agg(F.count("*").alias("people"), *_resum())
    )
    g = per_department.groupBy("payment_method").agg(
        F.sum("people").alias("people"), F.count("department").alias("departments"), *_resum()
    )
    everything = Window.partitionBy()  # a handful of method rows by construction
    return g.select(
        "payment_method",
        F.col("n").alias("total_payments"),
        F.col("people").alias("unique_employees"),
        F.col("gross_pay").alias("total_gross_pay"),
        F.col("net_pay").alias("total_net_pay"),
        money.mean2(F.col("gross_pay"), F.col("n")).alias("avg_gross_pay"),
        money.mean2(F.col("net_pay"), F.col("n")).alias("avg_net_pay"),
        money.percent(F.col("n"), F.sum("n").over(everything)).alias("payment_volume_pct"),
        money.percent(F.col("gross_pay"), F.sum("gross_pay").over(everything)).alias("payment_value_pct"),
        F.col("departments").alias("departments_using_method"),
        "first_payment_date",
        "last_payment_date",
        F.lit(processed_at).cast("timestamp").alias("gold_processed_timestamp"),
        F.lit(pod).alias("pod_id"),
    )


# ---- analyst queries -------------------------------------------------------------


def top_paid_active(summary: DataFrame, n: int = 10) -> DataFrame:
    active = summary.where(F.col("employment_status") == ACTIVE)
    return active.orderBy(F.col("ytd_gross_pay").desc_nulls_last(), "employee_id").limit(n).select(
        "employee_id", "first_name", "last_name", "department", "job_title", "annual_salary",
        "ytd_gross_pay", "ytd_net_pay", "effective_tax_rate_pct",
    )


def department_cost_ranking(departments: DataFrame) -> DataFrame:
    return departments.select(
        "department", "office_location", "active_employees", "ytd_total_gross_pay",
        "ytd_avg_gross_per_employee", "dept_effective_tax_rate_pct", "avg_tenure_years",
    ).orderBy(F.col("ytd_total_gross_pay").desc_nulls_last(), "department", "office_location")


def payroll_trend(months: DataFrame) -> DataFrame:
    return months.select(
        "payment_month_start", "unique_employees_paid", "total_gross_pay", "total_net_pay",
        "avg_gross_pay_per_payment", "effective_tax_rate_pct", "direct_deposit_count", "check_count",
    ).orderBy(F.col("payment_month_start").desc())


def active_without_payroll(summary: DataFrame) -> DataFrame:
    idle = F.coalesce("total_payments", F.lit(0)) == 0
    return summary.where((F.col("employment_status") == ACTIVE) & idle).select(
        "employee_id", "first_name", "last_name", "department", "employment_status", "hire_date",
        "annual_salary", "total_payments", "last_payment_date",
    ).orderBy(F.col("hire_date").desc(), "employee_id")


# ---- per-tenant metrics ------------------------------------------------------------


def _if_present(df: DataFrame, columns: list[str], expr, default, alias: str) -> Column:
    """``expr()`` when every column exists at plan time, else a literal."""
    return (expr() if all(c in df.columns for c in columns) else F.lit(default)).alias(alias)


def finance_hr_metrics(df: DataFrame) -> DataFrame:
    salary = F.col("salary").try_cast("decimal(12,2)") if "salary" in df.columns else None
    return df.groupBy("department").agg(
        F.count("*").alias("employee_count"),
        _if_present(df, ["salary"], lambda: money.mean2(F.sum(salary), F.count(salary)), 0, "avg_salary"),
        _if_present(df, ["hire_date"], lambda: F.min("hire_date"), None, "earliest_hire"),
        _if_present(df, ["hire_date"], lambda: F.max("hire_date"), None, "latest_hire"),
    )


def finance_payroll_metrics(df: DataFrame) -> DataFrame:
    """Headcount and compensation per department; ``df`` holds one row per employee."""

    def sum_of(c: str) -> Column:
        return F.sum(F.col(c).try_cast(money.WIDE)).cast(money.WIDE)

    return df.groupBy("department").agg(
        F.count("*").alias("employee_count"),
        _if_present(df, ["base_salary"], lambda: sum_of("base_salary"), 0, "total_base_salary"),
        _if_present(df, ["bonus"], lambda: sum_of("bonus"), 0, "total_bonus"),
        _if_present(
            df, ["base_salary", "bonus"], lambda: (sum_of("base_salary") + sum_of("bonus")).cast(money.WIDE), 0,
            "total_compensation",
        ),
    )


def operations_metrics(df: DataFrame) -> DataFrame:
    return df.groupBy("category").agg(
        F.count("*").alias("record_count"),
        _if_present(df, ["metric_value"], lambda: F.avg(F.col("metric_value").cast("double")), 0.0, "avg_metric"),
    )


def generic_metrics(df: DataFrame) -> DataFrame:
    """Record count by ``category`` where that column exists, else overall."""
    if "category" in df.columns:
        return df.groupBy("category").agg(F.count("*").alias("record_count"))
    return df.agg(F.count("*").alias("total_records"))


def per_employee(payroll: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """One row per employee with the sums of ``amounts``; combined before any join.

    Rows whose employee number does not convert belong to nobody and are left out.
    """
    number = F.col("employee_id").try_cast("long").alias("employee_id")
    sums = [F.sum(F.col(c).try_cast("decimal(12,2)")).cast(money.WIDE).alias(c) for c in amounts]
    return payroll.groupBy(number).agg(*sums).where("employee_id IS NOT NULL")


def with_department(payroll: DataFrame, employees: DataFrame) -> DataFrame:
    """Compensation rows with the department of their employee."""
    staff = employees.select(F.col("employee_id").alias("_eid"), "department")
    return payroll.join(staff, payroll["employee_id"].try_cast("long") == F.col("_eid"), "inner").drop("_eid")


def with_report_columns(df: DataFrame, as_of: str, **labels: str) -> DataFrame:
    return df.withColumns({"report_date": dates.day(as_of), **{k: F.lit(v) for k, v in labels.items()}})


def employee_salary_summary(df: DataFrame) -> DataFrame:
    """Count, mean, extremes, sample deviation and sum of salary per department."""
    salary = F.col("salary").cast("double")
    return df.groupBy("department").agg(
        F.count("*").alias("employee_count"),
        money.mean2(F.sum("salary"), F.count("salary")).alias("avg_salary"),
        F.min("salary").alias("min_salary"),
        F.max("salary").alias("max_salary"),
        F.round(F.stddev_samp(salary), 4).alias("salary_stddev"),
        money.total("salary").alias("total_salary"),
    )


def department_payroll_totals(df: DataFrame, as_of: str, **labels: str) -> DataFrame:
    """Headcount, salaries and bonuses per department; ``df`` holds one row per employee."""
    g = df.groupBy("department").agg(
        F.count("*").alias("employee_count"),
        money.total("salary").alias("monthly_payroll"),
        _if_present(df, ["bonus"], lambda: money.total("bonus"), 0, "monthly_bonus"),
    )
    return with_report_columns(g, as_of, **labels)


def employee_details(df: DataFrame, **labels: str) -> DataFrame:
    return df.select(
        "employee_id", "first_name", "last_name", "department", "job_title", "salary", "hire_date",
        "processed_timestamp", *[F.lit(v).alias(k) for k, v in labels.items()],
    )
