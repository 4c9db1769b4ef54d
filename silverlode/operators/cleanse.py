"""Bronze -> silver: typed cleansing, row filters and per-tenant rule sets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, money, text

HR_SOURCE = "HR_EMPLOYEES"
PAYROLL_SOURCE = "PAYROLL_PAYMENTS"


def with_audit_columns(df: DataFrame, processed_at: str, **labels: str) -> DataFrame:
    """Append processed_timestamp and constant label columns."""
    cols: dict[str, Column] = {"processed_timestamp": F.lit(processed_at).cast("timestamp")}
    cols.update({name: F.lit(value) for name, value in labels.items()})
    return df.withColumns(cols)


def cleanse_employees(df: DataFrame, pod: str, processed_at: str) -> DataFrame:
    """Typed silver projection of raw employee rows; no row is dropped."""
    typed = df.select(
        F.col("employee_id").try_cast("long").alias("employee_id"),
        text.proper_case("first_name").alias("first_name"),
        text.proper_case("last_name").alias("last_name"),
        text.lower_trimmed("email").alias("email"),
        text.trimmed("department").alias("department"),
        text.trimmed("job_title").alias("job_title"),
        dates.to_day("hire_date").alias("hire_date"),
        money.money("salary").alias("salary"),
        text.proper_case("employment_status").alias("employment_status"),
        F.col("manager_id").try_cast("long").alias("manager_id"),
        text.blank_to_null("office_location").alias("office_location"),
        dates.to_moment("created_datetime").alias("created_datetime"),
    )
    return with_audit_columns(typed, processed_at, source_file_name=HR_SOURCE, pod_id=pod)


def valid_employee(as_of: str) -> Column:
    """Row filter of the HR load, on the raw columns."""
    return text.all_of(
        [
            F.col("employee_id").try_cast("long").isNotNull(),
            money.money("salary") > 0,
            dates.to_day("hire_date") <= dates.day(as_of),
            text.has_text("email"),
            text.loose_email("email"),
            text.has_text("first_name"),
            text.has_text("last_name"),
        ]
    )


def hr_bronze_to_silver(
    df: DataFrame, pod: str, as_of: str, processed_at: str, distinct: bool = True
) -> DataFrame:
    """Filtered and typed employee rows, exact duplicates removed.

    ``distinct=False`` saves that shuffle when latest-row-per-key follows anyway.
    """
    out = cleanse_employees(df.where(valid_employee(as_of)), pod, processed_at)
    return out.distinct() if distinct else out


def cleanse_payments(df: DataFrame, pod: str, processed_at: str) -> DataFrame:
    """Typed silver projection of raw payment rows; net pay is recomputed."""
    typed = df.select(
        F.col("payment_id").try_cast("long").alias("payment_id"),
        F.col("employee_id").try_cast("long").alias("employee_id"),
        dates.to_day("pay_period_start").alias("pay_period_start"),
        dates.to_day("pay_period_end").alias("pay_period_end"),
        money.money("gross_pay").alias("gross_pay"),
        money.money("tax_withheld").alias("tax_withheld"),
        money.money_or_zero("deductions").alias("deductions"),
        money.net_pay("gross_pay", "tax_withheld", "deductions").alias("net_pay"),
        dates.to_day("payment_date").alias("payment_date"),
        text.payment_method("payment_method").alias("payment_method"),
        text.sentinel_to_null("bank_account_last4").alias("bank_account_last4"),
        dates.to_moment("created_datetime").alias("created_datetime"),
    )
    return with_audit_columns(typed, processed_at, source_file_name=PAYROLL_SOURCE, pod_id=pod)


def valid_payment(as_of: str) -> Column:
    """Row filter of the payroll load, on the raw columns."""
    start, end = dates.to_day("pay_period_start"), dates.to_day("pay_period_end")
    return text.all_of(
        [
            F.col("payment_id").try_cast("long").isNotNull(),
            F.col("employee_id").try_cast("long").isNotNull(),
            start < end,
            dates.to_day("payment_date") <= dates.day(as_of),
            money.money("gross_pay") >= 0,
            money.money("tax_withheld") >= 0,
            money.money_or_zero("deductions") >= 0,
        ]
    )


def with_known_employee(payments: DataFrame, employees: DataFrame, pod: str) -> DataFrame:
    """Payments whose employee exists in the pod's silver staff (semi join, no fan-out)."""
    known = employees.where(F.col("pod_id") == pod).select(F.col("employee_id").alias("_known"))
    return payments.join(known, payments["employee_id"].try_cast("long") == F.col("_known"), "left_semi")


def payroll_bronze_to_silver(
    df: DataFrame, employees: DataFrame, pod: str, as_of: str, processed_at: str, distinct: bool = True
) -> DataFrame:
    """Filtered, FK-checked and typed payment rows, exact duplicates removed.

    ``distinct=False`` saves that shuffle when latest-row-per-key follows anyway.
    """
    checked = with_known_employee(df.where(valid_payment(as_of)), employees, pod)
    out = cleanse_payments(checked, pod, processed_at)
    return out.distinct() if distinct else out


# ---- per-tenant rule sets ---------------------------------------------------

Rule = Callable[[DataFrame], DataFrame]


def pod_hr_rules(df: DataFrame) -> DataFrame:
    return (
        df.dropDuplicates()
        .where(F.col("employee_id").isNotNull())
        .withColumns(
            {
                "first_name": F.trim("first_name"),
                "last_name": F.trim("last_name"),
                "email": F.lower("email"),
                "department": F.upper("department"),
            }
        )
    )


def pod_payroll_rules(df: DataFrame) -> DataFrame:
    positive = F.col("base_salary").try_cast("decimal(12,2)") > 0
    return df.dropDuplicates().where(F.col("employee_id").isNotNull() & positive)


def generic_rules(df: DataFrame) -> DataFrame:
    return df.dropDuplicates().na.drop()


def customer_rules(df: DataFrame) -> DataFrame:
    """Keep identified rows and flag whether the e-mail is well formed."""
    return df.where(F.col("employee_id").isNotNull()).withColumn("email_valid", text.strict_email(F.trim("email")))


class RuleRegistry:
    """Rule sets by (pod, company, domain); None matches anything, specific wins."""

    def __init__(self) -> None:
        self._rules: dict[tuple[str | None, str | None, str | None], Rule] = {}

    def register(self, rule: Rule, pod: str | None = None, company: str | None = None, domain: str | None = None):
        self._rules[(pod, company, domain)] = rule
        return self

    def lookup(self, pod: str, company: str, domain: str) -> Rule:
        for p in (pod, None):
            for c in (company, None):
                for d in (domain, None):
                    if (p, c, d) in self._rules:
                        return self._rules[(p, c, d)]
        raise KeyError((pod, company, domain))

    def apply(self, df: DataFrame, pod: str, company: str, domain: str, processed_at: str) -> DataFrame:
        cleansed = df.transform(self.lookup(pod, company, domain))
        return with_audit_columns(cleansed, processed_at, pod_id=pod, company=company, domain=domain)


def default_rules() -> RuleRegistry:
    """The shipped rule sets: podA specialises hr and payroll, others are generic."""
    return (
        RuleRegistry()
        .register(generic_rules)
        .register(pod_hr_rules, pod="podA", domain="hr")
        .register(pod_payroll_rules, pod="podA", domain="payroll")
        .register(customer_rules, pod="podA", domain="customer")
    )


def join_domains(hr: DataFrame, payroll: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """hr x payroll on ``key``, de-duplicated, rows with any null dropped."""
    return hr.join(payroll, key, "inner").select(*columns).transform(generic_rules)
