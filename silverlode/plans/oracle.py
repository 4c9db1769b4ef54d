"""The frames of ``frames.py`` stated independently in SQL, for cross-checking.

``sql(body)`` prefixes a query with the frames it names, in dependency order.
"""

from __future__ import annotations

import re

AS_OF = "DATE '2001-01-01'"


def dec(expr: str, p: int = 10) -> str:
    return f"CAST({expr} AS DECIMAL({p},2))"


def dbl(expr: str) -> str:
    return f"CAST({expr} AS DOUBLE)"


def txt(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


def big(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def mean2(total: str, n: str) -> str:
    """total/n half up to two digits in exact integers (total has <= 2 decimals, >= 0)."""
    cents = f"CAST(({total}) * 100 AS HUGEINT)"
    return f"(CASE WHEN ({n}) > 0 THEN CAST((2 * {cents} + ({n})) // (2 * ({n})) AS DOUBLE) / 100 END)"


def pct(part: str, whole: str) -> str:
    """part*100/whole half up to two digits in exact integers; 0 when whole <= 0."""
    a, b = f"CAST(({part}) * 100 AS HUGEINT)", f"CAST(({whole}) * 100 AS HUGEINT)"
    return f"(CASE WHEN ({whole}) > 0 THEN CAST((20000 * {a} + {b}) // (2 * {b}) AS DOUBLE) / 100 ELSE 0.0 END)"


def proper(expr: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({expr})), ' '), "
        f"lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
    )


FRAMES: dict[str, str] = {}

FRAMES["bronze_hr"] = """
SELECT CASE WHEN c_custkey % 97 <> 0 THEN CAST(c_custkey AS VARCHAR) END AS employee_id,
  '  CUSTOMER ' AS first_name,
  CASE WHEN c_custkey % 89 = 0 THEN '  ' ELSE 'n' || c_custkey END AS last_name,
  CASE WHEN c_custkey % 53 = 0 THEN NULL WHEN c_custkey % 59 = 0 THEN 'C' || c_custkey || '.CORP.EXAMPLE'
       ELSE 'C' || c_custkey || '@CORP.EXAMPLE' END AS email,
  CASE WHEN copy = 2 THEN 'MOVED' ELSE ' ' || c_mktsegment || ' ' END AS department,
  'Grade ' || (c_custkey % 7) AS job_title,
  CASE WHEN c_custkey % 211 = 0 THEN 'not-a-date'
       ELSE CAST(DATE '1990-01-01' + CAST((c_custkey * 37) % 4500 AS INTEGER) AS VARCHAR) END AS hire_date,
  CASE WHEN c_custkey % 61 <> 0 THEN CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS VARCHAR) END AS salary,
  CASE c_custkey % 10 WHEN 0 THEN 'terminated' WHEN 1 THEN 'on leave' ELSE 'ACTIVE' END AS employment_status,
  CASE WHEN c_custkey >= 10 THEN CAST(c_custkey // 10 AS VARCHAR) END AS manager_id,
  CASE WHEN c_custkey % 31 = 0 THEN ' ' ELSE n_name END AS office_location,
  strftime(TIMESTAMP '2000-01-01' + to_minutes(c_custkey + CASE WHEN copy = 2 THEN 1440 ELSE 0 END),
           '%Y-%m-%d %H:%M:%S') AS created_datetime
FROM (SELECT *, 0 AS copy FROM customer
      UNION ALL SELECT *, 1 FROM customer WHERE c_custkey % 50 = 0
      UNION ALL SELECT *, 2 FROM customer WHERE c_custkey % 75 = 0) c
LEFT JOIN nation ON c_nationkey = n_nationkey"""

FRAMES["bronze_payroll"] = """
SELECT CASE WHEN k % 101 <> 0 THEN CAST(k AS VARCHAR) END AS payment_id,
  CAST(CASE WHEN k % 83 = 0 THEN cust + 1000000 ELSE cust END AS VARCHAR) AS employee_id,
  CAST(CASE WHEN k % 67 = 0 THEN d ELSE d - 14 END AS VARCHAR) AS pay_period_start,
  CAST(CASE WHEN k % 67 = 0 THEN d - 14 ELSE d END AS VARCHAR) AS pay_period_end,
  CAST(gross AS VARCHAR) AS gross_pay, CAST(tax AS VARCHAR) AS tax_withheld, CAST(cut AS VARCHAR) AS deductions,
  CAST(CAST(gross - tax - COALESCE(cut, 0) + CASE WHEN k % 29 = 0 THEN 1 ELSE 0 END AS DECIMAL(10,2)) AS VARCHAR) AS net_pay,
  CAST(d AS VARCHAR) AS payment_date,
  CASE prio WHEN '1-URGENT' THEN 'direct deposit' WHEN '2-HIGH' THEN 'CHECK'
            WHEN '3-MEDIUM' THEN ' Wire Transfer ' WHEN '5-LOW' THEN 'cash' END AS payment_method,
  CASE WHEN prio = '1-URGENT' THEN lpad(CAST(cust % 10000 AS VARCHAR), 4, '0') ELSE 'N/A' END AS bank_account_last4,
  CAST(d + 1 AS VARCHAR) || ' 00:00:00' AS created_datetime
FROM (SELECT *, CASE WHEN k % 151 = 0 THEN -t ELSE t END AS tax, CASE WHEN k % 13 <> 0 THEN c END AS cut
      FROM (SELECT o_orderkey AS k, o_custkey AS cust, CAST(o_orderdate AS DATE) AS d, o_orderpriority AS prio,
              CAST(o_totalprice AS DECIMAL(10,2)) AS gross,
              CAST(round(CAST(o_totalprice AS DECIMAL(10,2)) * 0.20, 2) AS DECIMAL(10,2)) AS t,
              CAST(round(CAST(o_totalprice AS DECIMAL(10,2)) * 0.05, 2) AS DECIMAL(10,2)) AS c
            FROM orders))"""

FRAMES["typed_hr"] = f"""
SELECT TRY_CAST(employee_id AS BIGINT) AS employee_id, {proper('first_name')} AS first_name,
  {proper('last_name')} AS last_name, lower(trim(email)) AS email, trim(department) AS department,
  trim(job_title) AS job_title, TRY_CAST(hire_date AS DATE) AS hire_date,
  TRY_CAST(salary AS DECIMAL(10,2)) AS salary, {proper('employment_status')} AS employment_status,
  TRY_CAST(manager_id AS BIGINT) AS manager_id, nullif(trim(office_location), '') AS office_location,
  TRY_CAST(created_datetime AS TIMESTAMP) AS created_datetime,
  TIMESTAMP '2001-01-01 06:00:00' AS processed_timestamp, 'HR_EMPLOYEES' AS source_file_name, 'podA' AS pod_id,
  email AS raw_email
FROM bronze_hr"""

FRAMES["cleansed_hr"] = f"""
SELECT DISTINCT * EXCLUDE (raw_email) FROM typed_hr
WHERE employee_id IS NOT NULL AND salary > 0 AND hire_date <= {AS_OF}
  AND raw_email IS NOT NULL AND trim(raw_email) <> '' AND raw_email LIKE '%@%.%'
  AND first_name <> '' AND last_name <> ''"""

FRAMES["silver_hr"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY employee_id, pod_id ORDER BY created_datetime DESC, department DESC) AS rn FROM cleansed_hr) WHERE rn = 1"""

FRAMES["typed_payroll"] = """
SELECT TRY_CAST(payment_id AS BIGINT) AS payment_id, TRY_CAST(employee_id AS BIGINT) AS employee_id,
  TRY_CAST(pay_period_start AS DATE) AS pay_period_start, TRY_CAST(pay_period_end AS DATE) AS pay_period_end,
  TRY_CAST(gross_pay AS DECIMAL(10,2)) AS gross_pay, TRY_CAST(tax_withheld AS DECIMAL(10,2)) AS tax_withheld,
  COALESCE(TRY_CAST(deductions AS DECIMAL(10,2)), 0) AS deductions,
  CAST(TRY_CAST(gross_pay AS DECIMAL(10,2)) - TRY_CAST(tax_withheld AS DECIMAL(10,2))
       - COALESCE(TRY_CAST(deductions AS DECIMAL(10,2)), 0) AS DECIMAL(10,2)) AS net_pay,
  TRY_CAST(payment_date AS DATE) AS payment_date,
  CASE upper(trim(payment_method)) WHEN 'DIRECT DEPOSIT' THEN 'Direct Deposit' WHEN 'CHECK' THEN 'Check'
       WHEN 'WIRE TRANSFER' THEN 'Wire Transfer' ELSE 'Unknown' END AS payment_method,
  CASE WHEN trim(bank_account_last4) IN ('N/A', 'NA', '') THEN NULL ELSE trim(bank_account_last4) END AS bank_account_last4,
  TRY_CAST(created_datetime AS TIMESTAMP) AS created_datetime,
  TIMESTAMP '2001-01-01 06:00:00' AS processed_timestamp, 'PAYROLL_PAYMENTS' AS source_file_name, 'podA' AS pod_id
FROM bronze_payroll"""

FRAMES["cleansed_payroll"] = f"""
SELECT DISTINCT p.* FROM typed_payroll p
WHERE payment_id IS NOT NULL AND pay_period_start < pay_period_end AND payment_date <= {AS_OF}
  AND gross_pay >= 0 AND tax_withheld >= 0 AND deductions >= 0
  AND EXISTS (SELECT 1 FROM silver_hr e WHERE e.employee_id = p.employee_id)"""

FRAMES["silver_payroll"] = """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY payment_id, pod_id ORDER BY created_datetime DESC, employee_id DESC) AS rn FROM cleansed_payroll) WHERE rn = 1"""

FRAMES["simple_payroll"] = """
SELECT employee_id, gross_pay AS base_salary, deductions AS bonus, substr(payment_date, 1, 7) AS pay_period FROM bronze_payroll"""

FRAMES["company_config"] = """
SELECT k AS company_key, pod_id || '-' || company AS company_id, * EXCLUDE (k) FROM (
SELECT s_suppkey AS k, 'pod' || substr('ABCDE', CAST(s_suppkey % 5 + 1 AS INTEGER), 1) AS pod_id, 'company_' || s_suppkey AS company,
  s_suppkey % 7 <> 0 AS enabled, CAST(s_suppkey % 12 AS INTEGER) AS worker_count,
  CASE WHEN s_suppkey % 8 = 3 THEN CAST([] AS VARCHAR[]) WHEN s_suppkey % 4 = 0 THEN ['hr', 'payroll']
       WHEN s_suppkey % 4 = 1 THEN ['hr', 'payroll', 'finance'] WHEN s_suppkey % 4 = 2 THEN ['hr']
       ELSE ['payroll', 'inventory'] END AS domains,
  'BU-' || (s_suppkey % 6) AS business_unit, 'CC-' || (s_suppkey % 15) AS cost_center,
  CASE WHEN s_suppkey % 40 = 13 THEN 'SECRET'
       ELSE ['PUBLIC', 'INTERNAL', 'CONFIDENTIAL', 'RESTRICTED'][s_suppkey % 4 + 1] END AS data_classification,
  CASE s_suppkey % 3 WHEN 0 THEN ['SOX', 'GDPR'] WHEN 1 THEN ['GDPR'] ELSE ['HIPAA'] END AS compliance_tags,
  [2, 4, 6, 8, 12][s_suppkey % 5 + 1] AS sla_hours,
  CASE WHEN s_suppkey % 41 = 17 THEN 'URGENT' ELSE ['HIGH', 'MEDIUM', 'LOW'][s_suppkey % 3 + 1] END AS priority,
  CAST(s_suppkey % 3 + 1 AS INTEGER) AS max_retry_count, 'driver-m' AS driver_node_type,
  'worker-' || (s_suppkey % 3) AS worker_node_type, CAST(s_suppkey % 3 + 1 AS INTEGER) AS autoscale_min_workers,
  CASE WHEN s_suppkey % 29 = 5 THEN 0 ELSE CAST(s_suppkey % 5 + 3 AS INTEGER) END AS autoscale_max_workers,
  s_suppkey % 2 = 0 AS spot_instances_enabled, CAST(abs(s_acctbal) AS DECIMAL(12,2)) AS estimated_monthly_gb,
  (s_suppkey * 7919) % 12000000 AS estimated_monthly_rows, 'admin' || (s_suppkey % 3) AS modified_by,
  TIMESTAMP '2024-01-01' + to_hours(s_suppkey % 1000) AS modified_at,
  ['APPROVED', 'DRAFT'][s_suppkey % 2 + 1] AS approval_status, '1.0' AS config_version
FROM supplier)"""

FRAMES["config_v2"] = """
SELECT * REPLACE (CASE WHEN company_key % 5 = 0 THEN worker_count + 1 ELSE worker_count END AS worker_count)
FROM company_config WHERE company_key % 11 <> 0
UNION ALL
SELECT * REPLACE (company_id || '-new' AS company_id, company || '-new' AS company) FROM company_config WHERE company_key % 17 = 1"""

FRAMES["execution_log"] = """
SELECT 'exec-' || event_id AS execution_id, 'load_' || (event_id % 3) AS pipeline_name, user_id AS company_key,
  'pod' || substr('ABCDE', CAST(user_id % 5 + 1 AS INTEGER), 1) AS pod_id, 'company_' || user_id AS company,
  ['hr', 'payroll', 'finance'][event_id % 3 + 1] AS domain, ['bronze_to_silver', 'silver_to_gold'][event_id % 2 + 1] AS stage,
  s - to_hours(event_id % 13) AS file_arrival_time, s AS execution_start_time,
  CASE WHEN status <> 'RUNNING' THEN s + to_seconds(took) END AS execution_end_time,
  CASE WHEN status <> 'RUNNING' THEN took END AS execution_duration_seconds, status,
  CASE WHEN status = 'FAILED' THEN err END AS error_type,
  CASE WHEN status = 'FAILED' THEN err || ' in run ' || event_id END AS error_message,
  CAST(event_id % 4 AS INTEGER) AS retry_count, k * 100 AS input_row_count,
  greatest(k * 100 - event_id % 7, 0) AS output_row_count, k * 100 - greatest(k * 100 - event_id % 7, 0) AS rows_failed_validation,
  CAST(user_id % 4 + 1 AS INTEGER) AS worker_count,
  CAST(CAST(value AS DECIMAL(12,2)) * CAST(0.1 AS DECIMAL(2,1)) AS DECIMAL(14,3)) AS dbu_consumed,
  'team' || (user_id % 4) AS dim_owner, ['HIGH', 'MEDIUM', 'LOW'][user_id % 3 + 1] AS dim_priority,
  100 - k % 20 AS data_quality_score, strftime(ts, '%Y-%m-%d') AS execution_date
FROM (SELECT *, date_trunc('second', ts) AS s, CAST(floor(CAST(value AS DECIMAL(12,2)) * 10) AS BIGINT) AS took,
    CAST(COALESCE(TRY_CAST(json_extract_string(props, '$.k') AS INTEGER), 0) AS BIGINT) AS k,
    CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RUNNING' ELSE 'SUCCESS' END AS status,
    ['TIMEOUT', 'RESOURCE_EXHAUSTED', 'SCHEMA_MISMATCH', 'TRANSIENT_ERROR'][event_id % 4 + 1] AS err FROM events)"""

FRAMES["activity_log"] = """
SELECT 'act-' || event_id AS activity_id, 'exec-' || event_id AS execution_id, 'step_' || (event_id % 5) AS activity_name,
  ['Copy', 'Hash', 'Notebook'][event_id % 3 + 1] AS activity_type,
  CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
  date_trunc('second', ts) AS start_time, CAST(floor(CAST(value AS DECIMAL(12,2)) * 5) AS BIGINT) AS duration_seconds,
  event_id % 50 AS rows_read, event_id % 47 AS rows_written, event_type || ' ' || props AS message,
  'pod' || (user_id % 25) AS resource, event_type, props, ts, event_id
FROM events"""

FRAMES["bronze_files"] = """
SELECT *, 'landing/' || pod_id || '/' || company || '/' || domain || '/' || file_name AS path FROM (
SELECT 'pod' || substr('ABCDE', CAST((doc_id // 8) % 5 + 1 AS INTEGER), 1) AS pod_id, 'company_' || (doc_id // 8) AS company,
  ['hr', 'hr', 'payroll', 'payroll', 'finance', 'inventory', 'hr', 'payroll'][doc_id % 8 + 1] AS domain,
  'doc_' || doc_id || ['.csv', '.parquet', '.txt'][doc_id % 3 + 1] AS file_name, n_chars AS size_bytes,
  TIMESTAMP '2024-01-01' + to_minutes(doc_id % 100000) AS modified_at, source, doc_id
FROM documents)"""

FRAMES["archive_members"] = """
SELECT source AS archive, lang || '/' || doc_id || '.txt' AS path, text AS content FROM documents"""

FRAMES["manifest_lines"] = """
SELECT source AS archive, sha256(CASE WHEN doc_id % 19 = 0 THEN text || 'x' ELSE text END) || '|' || lang || chr(92) || doc_id || '.txt' AS line
FROM documents WHERE doc_id % 17 <> 0
UNION ALL
SELECT source, sha256(text) || '|' || lang || chr(92) || (doc_id + 1000000) || '.txt' FROM documents WHERE doc_id % 23 = 0
UNION ALL
SELECT DISTINCT source, '# Root: ' || source FROM documents"""

FRAMES["archive_drops"] = """
SELECT *, '/landing/in/' || file_name AS url FROM (
SELECT conv_id, turn, CASE WHEN conv_id % 13 = 0 THEN 'ACME' || conv_id || '.zip'
  ELSE 'ACME' || (conv_id % 50) || '_' || ['HR', 'Payroll'][turn % 2 + 1] || '_2024-01-'
       || lpad(CAST(conv_id % 28 + 1 AS VARCHAR), 2, '0') || '.zip' END AS file_name
FROM conversations)"""


def _needs(body: str, found: list[str]) -> None:
    for name in FRAMES:
        if name not in found and re.search(rf"\b{name}\b", body):
            _needs(FRAMES[name], found)
            if name not in found:
                found.append(name)


def sql(body: str) -> str:
    """``body`` with the frames it uses as leading WITH clauses."""
    found: list[str] = []
    _needs(body, found)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({FRAMES[n]})" for n in found)
    body = body.strip()
    recursive = "RECURSIVE " if body.upper().startswith("WITH RECURSIVE") else ""
    rest = re.sub(r"^WITH( RECURSIVE)?\s", "", body, flags=re.I)
    if rest != body:
        return f"WITH {recursive}{ctes + ', ' if ctes else ''}{rest}"
    return f"WITH {ctes}\n{body}" if ctes else body
