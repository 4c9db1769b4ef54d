"""Every registered query equals its SQL on the smallest tables."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
import re
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as entry
from silverlode.plans.catalog import QUERIES
from tests.conftest import SMALL

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
CHECKS = {name: q.check for name, q in QUERIES.items() if q.check}
WITHOUT_SQL = {"sc_25_sha512"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    yield con
    con.close()


def plain(value):
    """Values that differ between engines only in type must not slip through."""
    assert not isinstance(value, (Decimal, dt.date, dt.datetime, list, dict)), f"not portable: {value!r}"
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def table(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in records), key=repr)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    expected = duck.execute(CHECKS[name])
    columns = [c[0] for c in expected.description]
    assert sorted(df.columns) == sorted(columns)
    assert table(df.columns, df.collect()) == table(columns, expected.fetchall())


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(CHECKS) == WITHOUT_SQL


def test_sha512_query_has_one_digest_per_file(spark):
    df = QUERIES["sc_25_sha512"](spark, SMALL)
    assert df.where("length(sha512) = 128").count() == spark.read.parquet(f"{SMALL}/documents.parquet").count()


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(CHECKS) <= set(entry.oracle_sql())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_query_names():
    assert all(re.fullmatch(r"[a-z0-9]+_\d+_[a-z0-9_]+|sc_25_sha512", n) for n in QUERIES)
    assert not any("pipeline" in n or re.match(r"op\d*_", n) for n in QUERIES)


# Queries that promise an order: the SQL's own, or that of these columns of the result.
ORDERED = {
    "or_1_mixed_direction": None,
    "or_2_top_k": None,
    "or_5_department_cost_order": "gross DESC NULLS LAST, department, office_location",
    "or_6_newest_month_first": "month_start DESC",
    "or_7_recent_failures": None,
    "gd_12_top_paid_active": None,
    "gd_13_department_cost_ranking": "ytd_total_gross_pay DESC NULLS LAST, department, office_location",
    "gd_14_payroll_trend": "payment_month_start DESC",
    "gd_15_active_without_payroll": "hire_date DESC, employee_id",
    "gov_9_monthly_cost_estimate": "estimated_monthly_cost_usd DESC, company_id",
    "gov_20_recent_runs": "execution_start_time DESC, execution_id",
}


@pytest.mark.parametrize("name", sorted(ORDERED))
def test_order_of_the_result_equals_sql(spark, duck, name):
    df, order = QUERIES[name](spark, SMALL), ORDERED[name]
    sql = CHECKS[name] if order is None else ordered(CHECKS[name], order)
    expected = duck.execute(sql)
    columns = [c[0] for c in expected.description]
    got = [tuple(plain(v) for v in r) for r in df.select(*columns).collect()]
    assert len(got) > 1 and got == [tuple(plain(v) for v in r) for r in expected.fetchall()]


def ordered(sql, order):
    """``sql`` with its outermost SELECT ordered."""
    return f"SELECT * FROM ({sql}) q ORDER BY {order}"


def test_sha512_digests_equal_pythons(spark, frames):
    found = {(r.archive, r.path): r.sha512 for r in QUERIES["sc_25_sha512"](spark, SMALL).collect()}
    members = {(r.archive, r.path): r.content for r in frames.archive_members.collect()}
    assert found == {k: hashlib.sha512(v.encode() if isinstance(v, str) else bytes(v)).hexdigest() for k, v in members.items()}
