"""Cleansing rules, gold marts and their regressions on small literal rows."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from silverlode.functions import text
from silverlode.operators import cleanse, gold
from silverlode.plans.catalog import QUERIES

HR = "employee_id string, first_name string, last_name string, email string, department string, job_title string, hire_date string, salary string, employment_status string, manager_id string, office_location string, created_datetime string"
PAY = "payment_id string, employee_id string, pay_period_start string, pay_period_end string, gross_pay string, tax_withheld string, deductions string, net_pay string, payment_date string, payment_method string, bank_account_last4 string, created_datetime string"
AT = "2025-01-01 00:00:00"


def employee(i, **kw):
    row = {
        "employee_id": str(i), "first_name": " ann ", "last_name": "o'neil", "email": " Ann@Corp.Example ", "department": " IT ",
        "job_title": "Dev", "hire_date": "2020-01-01", "salary": "1000.00", "employment_status": " ACTIVE", "manager_id": None,
        "office_location": " ", "created_datetime": "2020-01-01 00:00:00",
    }
    row.update(kw)
    return tuple(row.values())


def payment(i, emp, **kw):
    row = {
        "payment_id": str(i), "employee_id": str(emp), "pay_period_start": "2024-01-01", "pay_period_end": "2024-01-15",
        "gross_pay": "100.00", "tax_withheld": "20.00", "deductions": "5.00", "net_pay": "75.00", "payment_date": "2024-01-16",
        "payment_method": "direct deposit ", "bank_account_last4": "1234", "created_datetime": "2024-01-16 00:00:00",
    }
    row.update(kw)
    return tuple(row.values())


@pytest.fixture
def staff(spark):
    def build(*rows):
        return cleanse.hr_bronze_to_silver(spark.createDataFrame(list(rows), HR), "podA", "2025-01-01", AT)

    return build


def test_employee_values_are_normalised(staff):
    row = staff(employee(1)).first()
    assert (row.first_name, row.last_name, row.email, row.department) == ("Ann", "O'neil", "ann@corp.example", "IT")
    assert (row.employment_status, row.office_location, row.salary) == ("Active", None, D("1000.00"))


@pytest.mark.parametrize(
    "bad",
    [
        {"employee_id": None}, {"employee_id": "x1"}, {"salary": "0"}, {"salary": None}, {"salary": "lots"},
        {"hire_date": "2025-01-02"}, {"hire_date": "soon"}, {"email": None}, {"email": "  "}, {"email": "a.b"},
        {"first_name": " "}, {"last_name": None},
    ],
)
def test_bad_employees_are_dropped(staff, bad):
    assert staff(employee(1, **bad), employee(2)).count() == 1


def test_cleansing_twice_changes_nothing(staff, spark, rows):
    once = staff(employee(1), employee(1), employee(2))
    again = cleanse.hr_bronze_to_silver(
        once.select(*[F.col(c).cast("string") for c in once.columns]), "podA", "2025-01-01", AT
    )
    assert rows(once) == rows(again)


@pytest.mark.parametrize(
    "bad",
    [
        {"payment_id": None}, {"employee_id": "9"}, {"employee_id": None}, {"pay_period_end": "2024-01-01"},
        {"payment_date": "2025-02-01"}, {"gross_pay": "-1"}, {"tax_withheld": "-0.01"}, {"deductions": "-5"}, {"payment_date": None},
    ],
)
def test_bad_payments_are_dropped(staff, spark, bad):
    raw = spark.createDataFrame([payment(1, 1, **bad), payment(2, 1)], PAY)
    out = cleanse.payroll_bronze_to_silver(raw, staff(employee(1)), "podA", "2025-01-01", AT)
    assert [r.payment_id for r in out.collect()] == [2]


def test_payment_is_recomputed_and_labelled(staff, spark):
    raw = spark.createDataFrame([payment(1, 1, deductions=None, net_pay="1", bank_account_last4="N/A", payment_method=None)], PAY)
    row = cleanse.payroll_bronze_to_silver(raw, staff(employee(1)), "podA", "2025-01-01", AT).first()
    assert (row.net_pay, row.deductions, row.bank_account_last4, row.payment_method) == (D("80.00"), D("0.00"), None, "Unknown")


def test_strict_email(spark):
    df = spark.createDataFrame([("a@b.co",), ("a@b.",), ("a b@c.de",), (None,)], "e string")
    assert [r[0] for r in df.select(text.strict_email("e")).collect()] == [True, False, False, False]


def test_registry_prefers_the_specific_rule():
    rules = cleanse.default_rules()
    assert rules.lookup("podA", "finance", "hr") is cleanse.pod_hr_rules
    assert rules.lookup("podB", "finance", "hr") is cleanse.generic_rules
    rules.register(cleanse.customer_rules, pod="podB", company="finance")
    assert rules.lookup("podB", "finance", "hr") is cleanse.customer_rules


def test_scenario_of_three_joined_employees(spark):
    hr = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "employee_id int, department string")
    pay = spark.createDataFrame([(1, 10), (2, 20), (3, 30), (9, 90)], "employee_id int, base_salary int")
    assert cleanse.join_domains(hr, pay, "employee_id", ["employee_id", "department", "base_salary"]).count() == 3


@pytest.fixture
def silver(staff, spark):
    hr = staff(
        employee(1, salary="1000"), employee(2, salary="3000", manager_id="1"), employee(3, salary="500", manager_id="77", department="HR")
    )
    raw = spark.createDataFrame(
        [payment(i, 1, payment_method="check") for i in range(1, 4)] + [payment(9, 2, gross_pay="200.00")], PAY
    )
    return hr, cleanse.payroll_bronze_to_silver(raw, hr, "podA", "2025-01-01", AT)


def test_employee_summary(silver):
    out = {r.employee_id: r for r in gold.employee_payroll_summary(*silver, "podA", AT).collect()}
    assert out[1].total_payments == 3 and out[1].ytd_gross_pay == D("300.00") and out[1].primary_payment_method == "Check"
    assert out[2].manager_name == "Ann O'neil" and out[2].effective_tax_rate_pct == D("10.00")
    assert out[3].total_payments == 0 and out[3].ytd_gross_pay is None and out[3].effective_tax_rate_pct == 0
    assert out[3].manager_name is None and out[3].primary_payment_method is None


def test_salaries_are_not_repeated_per_payment(silver):
    it = gold.department_payroll_analytics(*silver, "podA", "2025-01-01", AT).where("department = 'IT'").first()
    assert (it.total_annual_salaries, it.avg_annual_salary, it.total_payments) == (D("4000.00"), D("2000.00"), 4)
    repeated = gold.department_payroll_analytics(*silver, "podA", "2025-01-01", AT, repeat_salaries=True)
    assert repeated.where("department = 'IT'").first().total_annual_salaries == D("6000.00")


def test_monthly_trend(silver):
    row = gold.monthly_payroll_trends(*silver, "podA", AT).first()
    assert (row.payment_month_start, row.total_payments, row.unique_employees_paid) == (dt.date(2024, 1, 1), 4, 2)
    assert (row.check_count, row.direct_deposit_count, row.other_count) == (3, 1, 0)
    assert [tuple(x) for x in row.top_departments] == [("IT", 4)]


def test_shares_add_up(silver):
    out = gold.payment_method_analysis(*silver, "podA", AT).collect()
    assert sum(r.payment_volume_pct for r in out) == 100 and sum(r.payment_value_pct for r in out) == 100


def test_mode_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([("Check",), ("Direct Deposit",)], "m string")
    counts = {m: F.count_if(F.col("m") == m) for m in gold.ALL_METHODS}
    assert df.agg(gold.most_frequent(counts)).first()[0] == "Check"


def test_metrics_without_optional_columns(spark):
    row = gold.finance_hr_metrics(spark.createDataFrame([("A",)], "department string")).first()
    assert (row.employee_count, row.avg_salary, row.earliest_hire) == (1, 0, None)
    assert gold.generic_metrics(spark.range(5)).first().total_records == 5


def test_unpaid_report_reads_every_payment(staff, spark):
    # Employees 4 and 13 are paid, 5 and 6 are not; 7 has left.
    hired = {5: "2020-01-01", 6: "2021-01-01"}
    hr = staff(*[employee(i, hire_date=hired.get(i, "2019-01-01")) for i in (4, 5, 6, 13)], employee(7, employment_status="terminated"))
    raw = spark.createDataFrame([payment(1, 4), payment(2, 13)], PAY)
    paid = cleanse.payroll_bronze_to_silver(raw, hr, "podA", "2025-01-01", AT)
    out = QUERIES["gd_15_active_without_payroll"].build(SimpleNamespace(silver_hr=hr, silver_payroll=paid)).collect()
    assert [(r.employee_id, r.total_payments) for r in out] == [(6, 0), (5, 0)]
