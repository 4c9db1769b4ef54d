"""Row-level queries: projections, filters and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverlode.functions import dates, digest, money, nested, paths, text
from silverlode.operators import cleanse, runs, tenants

from .frames import AS_OF, POD, PROCESSED_AT, RUNS_AS_OF
from .oracle import dbl, proper, txt
from .registry import query

STAMP = "'%Y-%m-%d %H:%M:%S'"

SILVER_HR_SQL = f"""employee_id, first_name, last_name, email, department, job_title, {txt('hire_date')} AS hire_date,
  {dbl('salary')} AS salary, employment_status, manager_id, office_location,
  strftime(created_datetime, {STAMP}) AS created_datetime, strftime(processed_timestamp, {STAMP}) AS processed_timestamp,
  source_file_name, pod_id"""

SILVER_PAY_SQL = f"""payment_id, employee_id, {txt('pay_period_start')} AS pay_period_start, {txt('pay_period_end')} AS pay_period_end,
  {dbl('gross_pay')} AS gross_pay, {dbl('tax_withheld')} AS tax_withheld, {dbl('deductions')} AS deductions,
  {dbl('net_pay')} AS net_pay, {txt('payment_date')} AS payment_date, payment_method, bank_account_last4,
  strftime(created_datetime, {STAMP}) AS created_datetime, strftime(processed_timestamp, {STAMP}) AS processed_timestamp,
  source_file_name, pod_id"""


# ---- projections -----------------------------------------------------------------


@query("prj_1_select_and_rename", "SELECT employee_id AS id, first_name AS given_name, department FROM bronze_hr")
def prj_1(t):
    return t.bronze_hr.select("employee_id", "first_name", "department").withColumnsRenamed(
        {"employee_id": "id", "first_name": "given_name"}
    )


@query("prj_2_typed_employees", f"SELECT {SILVER_HR_SQL} FROM typed_hr")
def prj_2(t):
    return cleanse.cleanse_employees(t.bronze_hr, POD, PROCESSED_AT)


@query("prj_3_typed_payments", f"SELECT {SILVER_PAY_SQL} FROM typed_payroll")
def prj_3(t):
    return cleanse.cleanse_payments(t.bronze_payroll, POD, PROCESSED_AT)


@query(
    "prj_4_audit_columns",
    f"""SELECT payment_id, '2001-01-01 06:00:00' AS processed_timestamp, 'podA' AS pod_id, 'finance' AS company,
    'payroll' AS domain, '2001-01-01' AS report_date FROM bronze_payroll""",
)
def prj_4(t):
    df = t.bronze_payroll.select("payment_id")
    df = cleanse.with_audit_columns(df, PROCESSED_AT, pod_id=POD, company="finance", domain="payroll")
    return df.withColumn("report_date", dates.day(AS_OF))


@query("prj_5_constant_label", "SELECT 'Cleansed Row Count' AS metric, count(*) AS row_count FROM cleansed_hr")
def prj_5(t):
    return t.cleansed_hr.agg(F.count("*").alias("row_count")).select(F.lit("Cleansed Row Count").alias("metric"), "row_count")


@query(
    "prj_6_column_if_present",
    f"SELECT employee_id, {dbl('salary')} AS salary, CAST(0 AS DOUBLE) AS bonus FROM silver_hr",
)
def prj_6(t):
    df = t.silver_hr
    bonus = F.col("bonus") if "bonus" in df.columns else F.lit(0.0)
    return df.select("employee_id", "salary", bonus.alias("bonus"))


@query(
    "prj_7_default_by_null",
    "SELECT payment_id, coalesce(payment_method, 'ALL') AS payment_method FROM bronze_payroll",
)
def prj_7(t):
    return t.bronze_payroll.select("payment_id", F.coalesce("payment_method", F.lit("ALL")).alias("payment_method"))


@query(
    "prj_8_tenant_discriminator",
    """SELECT employee_id, last_name, 'company_a' AS company FROM bronze_hr WHERE office_location <= 'NATION_2'
    UNION ALL SELECT employee_id, last_name, 'company_b' FROM bronze_hr WHERE office_location > 'NATION_2'""",
)
def prj_8(t):
    rows, near = t.bronze_hr, F.col("office_location") <= "NATION_2"
    cols = ["employee_id", "last_name"]
    return tenants.label_tenants({"company_a": rows.where(near).select(*cols), "company_b": rows.where(~near).select(*cols)})


@query(
    "prj_9_add_and_drop_columns",
    """SELECT company_id, worker_count, false AS backup_enabled FROM company_config
    UNION ALL SELECT company_id || '-v2', NULL, true FROM company_config WHERE enabled""",
)
def prj_9(t):
    old = t.company_config.select("company_id", "worker_count", "priority").drop("priority").withColumn("backup_enabled", F.lit(False))
    new = t.company_config.where("enabled").select(
        F.concat("company_id", F.lit("-v2")).alias("company_id"), F.lit(True).alias("backup_enabled")
    )
    return old.unionByName(new, allowMissingColumns=True)


@query("prj_10_tenant_view", "SELECT execution_id, pod_id, status FROM execution_log WHERE pod_id = 'podB'")
def prj_10(t):
    return tenants.tenant_rows(t.execution_log, "podB").select("execution_id", "pod_id", "status")


# ---- filters -----------------------------------------------------------------------


@query("flt_1_not_null", "SELECT employee_id, email FROM bronze_hr WHERE employee_id IS NOT NULL")
def flt_1(t):
    return t.bronze_hr.where(F.col("employee_id").isNotNull()).select("employee_id", "email")


@query(
    "flt_2_drop_any_null",
    """SELECT payment_id, employee_id, deductions, payment_method FROM bronze_payroll
    WHERE payment_id IS NOT NULL AND employee_id IS NOT NULL AND deductions IS NOT NULL AND payment_method IS NOT NULL""",
)
def flt_2(t):
    return t.bronze_payroll.select("payment_id", "employee_id", "deductions", "payment_method").na.drop()


@query("flt_3_castable", "SELECT employee_id, hire_date FROM bronze_hr WHERE try_cast(hire_date AS DATE) IS NOT NULL")
def flt_3(t):
    return t.bronze_hr.where(dates.to_day("hire_date").isNotNull()).select("employee_id", "hire_date")


@query(
    "flt_4_positive_amount",
    "SELECT employee_id, salary FROM bronze_hr WHERE try_cast(salary AS DECIMAL(10,2)) > 0",
)
def flt_4(t):
    return t.bronze_hr.where(money.money("salary") > 0).select("employee_id", "salary")


@query(
    "flt_5_not_in_future",
    "SELECT payment_id, payment_date FROM bronze_payroll WHERE try_cast(payment_date AS DATE) <= DATE '2001-01-01'",
)
def flt_5(t):
    return t.bronze_payroll.where(dates.to_day("payment_date") <= dates.day(AS_OF)).select("payment_id", "payment_date")


@query(
    "flt_6_date_order",
    """SELECT payment_id, pay_period_start, pay_period_end FROM bronze_payroll
    WHERE try_cast(pay_period_start AS DATE) < try_cast(pay_period_end AS DATE)""",
)
def flt_6(t):
    ordered = dates.to_day("pay_period_start") < dates.to_day("pay_period_end")
    return t.bronze_payroll.where(ordered).select("payment_id", "pay_period_start", "pay_period_end")


@query("flt_7_loose_email", "SELECT employee_id, email FROM bronze_hr WHERE email LIKE '%@%.%'")
def flt_7(t):
    return t.bronze_hr.where(text.loose_email("email")).select("employee_id", "email")


@query("flt_8_not_blank", "SELECT employee_id, last_name FROM bronze_hr WHERE trim(last_name) <> ''")
def flt_8(t):
    return t.bronze_hr.where(text.has_text("last_name")).select("employee_id", "last_name")


@query(
    "flt_9_in_list",
    """SELECT company_id, priority, data_classification FROM company_config WHERE priority IN ('HIGH', 'MEDIUM')
    AND data_classification NOT IN ('PUBLIC')""",
)
def flt_9(t):
    ok = F.col("priority").isin("HIGH", "MEDIUM") & ~F.col("data_classification").isin("PUBLIC")
    return t.company_config.where(ok).select("company_id", "priority", "data_classification")


@query(
    "flt_10_null_as_wildcard",
    "SELECT payment_id, payment_method FROM bronze_payroll WHERE payment_method = 'CHECK' OR payment_method IS NULL",
)
def flt_10(t):
    m = F.col("payment_method")
    return t.bronze_payroll.where((m == "CHECK") | m.isNull()).select("payment_id", "payment_method")


@query(
    "flt_11_relative_date",
    "SELECT execution_id, execution_date FROM execution_log WHERE CAST(execution_date AS DATE) >= DATE '2024-01-31' - 7",
)
def flt_11(t):
    return t.execution_log.where(runs.since(7, "2024-01-31")).select("execution_id", "execution_date")


@query(
    "flt_12_between_dates",
    """SELECT payment_id, payment_date FROM bronze_payroll
    WHERE CAST(payment_date AS DATE) BETWEEN DATE '2000-01-01' AND DATE '2000-01-01' + 30""",
)
def flt_12(t):
    start = dates.day("2000-01-01")
    inside = dates.to_day("payment_date").between(start, F.date_add(start, 30))
    return t.bronze_payroll.where(inside).select("payment_id", "payment_date")


@query("flt_13_map_value", "SELECT execution_id FROM execution_log WHERE dim_owner = 'team1'")
def flt_13(t):
    return t.execution_log.where(nested.map_get("custom_dimensions", "owner") == "team1").select("execution_id")


@query("flt_14_array_contains", "SELECT company_id FROM company_config WHERE list_contains(compliance_tags, 'GDPR')")
def flt_14(t):
    return t.company_config.where(F.array_contains("compliance_tags", "GDPR")).select("company_id")


@query("flt_15_flag", "SELECT company_id FROM company_config WHERE enabled")
def flt_15(t):
    return t.company_config.where("enabled").select("company_id")


@query(
    "flt_16_column_to_column",
    """SELECT company_id, autoscale_min_workers, autoscale_max_workers FROM company_config
    WHERE autoscale_min_workers > autoscale_max_workers""",
)
def flt_16(t):
    cols = ["company_id", "autoscale_min_workers", "autoscale_max_workers"]
    return t.company_config.where("autoscale_min_workers > autoscale_max_workers").select(*cols)


@query(
    "flt_17_tolerance",
    """SELECT payment_id, net_pay FROM bronze_payroll WHERE abs(CAST(gross_pay AS DECIMAL(10,2)) - CAST(tax_withheld AS DECIMAL(10,2))
    - coalesce(CAST(deductions AS DECIMAL(10,2)), 0) - CAST(net_pay AS DECIMAL(10,2))) > 0.01""",
)
def flt_17(t):
    gap = money.net_pay_gap("net_pay", "gross_pay", "tax_withheld", "deductions")
    return t.bronze_payroll.where(money.beyond_tolerance(gap)).select("payment_id", "net_pay")


@query(
    "flt_18_file_extension",
    "SELECT path FROM bronze_files WHERE file_name LIKE '%.csv' OR file_name LIKE '%.parquet'",
)
def flt_18(t):
    return t.bronze_files.where(paths.is_data_file("file_name")).select("path")


@query(
    "flt_19_zero_or_null",
    """SELECT e.employee_id FROM silver_hr e LEFT JOIN (SELECT employee_id, count(*) AS n FROM silver_payroll GROUP BY 1) p
    ON e.employee_id = p.employee_id WHERE coalesce(n, 0) = 0""",
)
def flt_19(t):
    n = t.silver_payroll.groupBy(F.col("employee_id").alias("_e")).agg(F.count("*").alias("n"))
    joined = t.silver_hr.join(n, F.col("employee_id") == F.col("_e"), "left")
    return joined.where(F.coalesce("n", F.lit(0)) == 0).select("employee_id")


@query(
    "flt_20_substring_and_prefix",
    "SELECT activity_id, message FROM activity_log WHERE lower(message) LIKE '%error%' AND activity_name LIKE 'step_1%'",
)
def flt_20(t):
    hit = text.contains_ci("message", "ERROR") & text.starts_with_ci("activity_name", "step_1")
    return t.activity_log.where(hit).select("activity_id", "message")


@query(
    "flt_21_younger_than",
    "SELECT activity_id FROM activity_log WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 24 HOUR",
)
def flt_21(t):
    return t.activity_log.where(F.col("ts") > dates.hours_before(RUNS_AS_OF, 24)).select("activity_id")


# ---- scalar functions -----------------------------------------------------------------


@query("sc_1_trim", "SELECT employee_id, trim(first_name) AS first_name, trim(department) AS department FROM bronze_hr")
def sc_1(t):
    return t.bronze_hr.select("employee_id", text.trimmed("first_name").alias("first_name"), text.trimmed("department").alias("department"))


@query("sc_2_case", "SELECT employee_id, lower(trim(email)) AS lowered, upper(employment_status) AS uppered FROM bronze_hr")
def sc_2(t):
    return t.bronze_hr.select("employee_id", text.lower_trimmed("email").alias("lowered"), F.upper("employment_status").alias("uppered"))


@query("sc_3_proper_case", f"SELECT employee_id, {proper('employment_status')} AS employment_status FROM bronze_hr")
def sc_3(t):
    return t.bronze_hr.select("employee_id", text.proper_case("employment_status").alias("employment_status"))


@query(
    "sc_4_concat_with_null",
    "SELECT employee_id, CASE WHEN email IS NULL THEN NULL ELSE last_name || ' ' || email END AS label FROM bronze_hr",
)
def sc_4(t):
    return t.bronze_hr.select("employee_id", text.full_name("last_name", "email").alias("label"))


@query("sc_5_blank_to_null", "SELECT employee_id, nullif(trim(office_location), '') AS office FROM bronze_hr")
def sc_5(t):
    return t.bronze_hr.select("employee_id", text.blank_to_null("office_location").alias("office"))


@query(
    "sc_6_sentinel_to_null",
    """SELECT payment_id, CASE WHEN trim(bank_account_last4) NOT IN ('N/A', 'NA', '') THEN trim(bank_account_last4) END AS account
    FROM bronze_payroll""",
)
def sc_6(t):
    return t.bronze_payroll.select("payment_id", text.sentinel_to_null("bank_account_last4").alias("account"))


@query("sc_7_payment_method", "SELECT payment_method, count(*) AS n FROM typed_payroll GROUP BY 1")
def sc_7(t):
    method = text.payment_method("payment_method").alias("payment_method")
    return t.bronze_payroll.groupBy(method).agg(F.count("*").alias("n"))


@query(
    "sc_8_default_amount",
    f"SELECT payment_id, {dbl('coalesce(try_cast(deductions AS DECIMAL(10,2)), 0)')} AS deductions FROM bronze_payroll",
)
def sc_8(t):
    return t.bronze_payroll.select("payment_id", money.money_or_zero("deductions").alias("deductions"))


@query(
    "sc_9_casts",
    f"""SELECT try_cast(payment_id AS BIGINT) AS payment_id, {dbl('try_cast(gross_pay AS DECIMAL(10,2))')} AS gross_pay,
    {txt('try_cast(payment_date AS DATE)')} AS payment_date,
    strftime(try_cast(created_datetime AS TIMESTAMP), {STAMP}) AS created FROM bronze_payroll""",
)
def sc_9(t):
    return t.bronze_payroll.select(
        F.col("payment_id").try_cast("long").alias("payment_id"), money.money("gross_pay").alias("gross_pay"),
        dates.to_day("payment_date").alias("payment_date"), dates.to_moment("created_datetime").alias("created"),
    )


@query("sc_10_try_cast", f"SELECT employee_id, {txt('try_cast(hire_date AS DATE)')} AS hire_date FROM bronze_hr")
def sc_10(t):
    return t.bronze_hr.select("employee_id", dates.to_day("hire_date").alias("hire_date"))


@query("sc_11_net_pay", f"SELECT payment_id, {dbl('net_pay')} AS net_pay FROM typed_payroll")
def sc_11(t):
    return t.bronze_payroll.select(
        F.col("payment_id").try_cast("long").alias("payment_id"),
        money.net_pay("gross_pay", "tax_withheld", "deductions").alias("net_pay"),
    )


@query(
    "sc_12_net_pay_gap",
    f"""SELECT b.payment_id, {dbl("CAST(CAST(net_pay AS DECIMAL(10,2)) - (CAST(gross_pay AS DECIMAL(10,2)) - CAST(tax_withheld AS DECIMAL(10,2)) - coalesce(CAST(deductions AS DECIMAL(10,2)), 0)) AS DECIMAL(10,2))")} AS gap
    FROM bronze_payroll b""",
)
def sc_12(t):
    return t.bronze_payroll.select("payment_id", money.net_pay_gap("net_pay", "gross_pay", "tax_withheld", "deductions").alias("gap"))


@query(
    "sc_13_abs_round",
    f"SELECT employee_id, {dbl('abs(round(CAST(salary AS DECIMAL(10,2)), 1))')} AS rounded FROM bronze_hr",
)
def sc_13(t):
    return t.bronze_hr.select("employee_id", F.abs(F.round(money.money("salary"), 1)).alias("rounded"))


@query(
    "sc_14_year_month",
    """SELECT CAST(year(payment_date) AS BIGINT) AS y, CAST(month(payment_date) AS BIGINT) AS m, count(*) AS n
    FROM silver_payroll GROUP BY 1, 2""",
)
def sc_14(t):
    return t.silver_payroll.groupBy(F.year("payment_date").alias("y"), F.month("payment_date").alias("m")).agg(F.count("*").alias("n"))


@query("sc_15_month_start", f"SELECT payment_id, {txt('CAST(date_trunc(' + chr(39) + 'month' + chr(39) + ', payment_date) AS DATE)')} AS month_start FROM silver_payroll")
def sc_15(t):
    return t.silver_payroll.select("payment_id", dates.month_start("payment_date").alias("month_start"))


@query("sc_16_days_between", "SELECT employee_id, date_diff('day', hire_date, DATE '2001-01-01') AS days FROM silver_hr")
def sc_16(t):
    return t.silver_hr.select("employee_id", dates.days_between(dates.day(AS_OF), "hire_date").alias("days"))


@query(
    "sc_17_seconds_between",
    """SELECT execution_id, date_diff('second', execution_start_time, execution_end_time) AS took,
    date_diff('second', execution_start_time, TIMESTAMP '2024-01-31') AS running FROM execution_log""",
)
def sc_17(t):
    return t.execution_log.select(
        "execution_id",
        dates.seconds_between("execution_start_time", "execution_end_time").alias("took"),
        dates.seconds_between("execution_start_time", dates.moment(RUNS_AS_OF)).alias("running"),
    )


@query(
    "sc_18_date_arithmetic",
    f"SELECT payment_id, {txt('payment_date + 30')} AS due, {txt('payment_date - 7')} AS week_before FROM silver_payroll",
)
def sc_18(t):
    return t.silver_payroll.select("payment_id", F.date_add("payment_date", 30).alias("due"), F.date_sub("payment_date", 7).alias("week_before"))


@query(
    "sc_19_as_of_instead_of_now",
    "SELECT employee_id, hire_date > DATE '2001-01-01' AS in_future, '2001-01-01' AS evaluated_on FROM typed_hr",
)
def sc_19(t):
    return t.bronze_hr.select(
        F.col("employee_id").try_cast("long").alias("employee_id"),
        (dates.to_day("hire_date") > dates.day(AS_OF)).alias("in_future"),
        dates.day(AS_OF).alias("evaluated_on"),
    )


@query(
    "sc_20_date_keys",
    """SELECT execution_id, strftime(execution_start_time, '%Y-%m-%d') AS day_key, strftime(execution_start_time, '%Y%m%d') AS compact_key,
    strftime(execution_start_time, '%Y-%m') AS month_key FROM execution_log""",
)
def sc_20(t):
    at = "execution_start_time"
    return t.execution_log.select(
        "execution_id", dates.date_key(at).alias("day_key"), dates.compact_date_key(at).alias("compact_key"),
        dates.month_key(at).alias("month_key"),
    )


@query("sc_21_tenant_path", "SELECT file_name, 'bronze/' || pod_id || '/' || company || '/' || domain AS folder FROM bronze_files")
def sc_21(t):
    return t.bronze_files.select("file_name", paths.tenant_path(F.lit("bronze"), "pod_id", "company", "domain").alias("folder"))


@query(
    "sc_22_route_by_name",
    r"""SELECT conv_id, turn, file_name, nullif(lower(regexp_extract(file_name, '^([^_]+)_([^_]+)_(.+)\.zip$', 1)), '') AS company,
    nullif(upper(regexp_extract(file_name, '^([^_]+)_([^_]+)_(.+)\.zip$', 2)), '') AS file_type FROM archive_drops""",
)
def sc_22(t):
    return t.archive_drops.select(
        "conv_id", "turn", "file_name",
        paths.routed_company("file_name").alias("company"), paths.routed_type("file_name").alias("file_type"),
    )


@query(
    "sc_23_base_name_and_extension",
    r"""SELECT conv_id, turn, split_part(url, '/', -1) AS base_name, regexp_replace(url, '\.zip$', '.hash') AS manifest_url
    FROM archive_drops""",
)
def sc_23(t):
    return t.archive_drops.select(
        "conv_id", "turn", paths.base_name("url").alias("base_name"), paths.swap_extension("url", ".zip", ".hash").alias("manifest_url")
    )


@query(
    "sc_24_path_normalise",
    """SELECT archive, replace(substr(line, 66), chr(92), '/') AS path,
    split_part(replace(substr(line, 66), chr(92), '/'), '/', 2) AS below_root
    FROM manifest_lines WHERE line NOT LIKE '#%'""",
)
def sc_24(t):
    entries = t.manifest_lines.where(~F.col("line").startswith("#"))
    path = paths.unix_path(F.split("line", r"\|")[1])
    return entries.select(
        "archive", path.alias("path"), paths.strip_root(path, paths.top_segment(path)).alias("below_root")
    )


@query(
    "sc_25_digests",
    "SELECT archive, path, sha256(content) AS sha256, md5(content) AS md5 FROM archive_members",
)
def sc_25(t):
    return t.archive_members.select(
        "archive", "path", digest.digest("content", "sha256").alias("sha256"), digest.digest("content", "md5").alias("md5")
    )


@query("sc_25_sha512")
def sc_25_sha512(t):
    return t.archive_members.select("archive", "path", digest.digest("content", "sha512").alias("sha512"))


@query(
    "sc_27_json_parse_and_emit",
    """SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    '{"type":"' || event_type || '","user":' || user_id || '}' AS emitted FROM events""",
)
def sc_27(t):
    parsed = F.from_json("props", "map<string,string>")
    return t.table("events").select(
        "event_id", nested.map_get(parsed, "k").try_cast("long").alias("k"),
        F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))).alias("emitted"),
    )


@query(
    "sc_28_arrays",
    """SELECT company_id, list_contains(domains, 'payroll') AS has_payroll, CAST(len(domains) AS BIGINT) AS n,
    array_to_string(list_concat(domains, ['audit']), ',') AS extended FROM company_config""",
)
def sc_28(t):
    return t.company_config.select(
        "company_id", F.array_contains("domains", "payroll").alias("has_payroll"), F.size("domains").alias("n"),
        F.concat_ws(",", F.concat("domains", F.array(F.lit("audit")))).alias("extended"),
    )


@query(
    "sc_29_map_merge",
    """SELECT execution_id, dim_owner AS owner, CASE WHEN status = 'FAILED' THEN 'HIGH' ELSE dim_priority END AS priority, status AS state
    FROM execution_log""",
)
def sc_29(t):
    newer = F.when(
        F.col("status") == "FAILED", F.create_map(F.lit("priority"), F.lit("HIGH"), F.lit("state"), F.col("status"))
    ).otherwise(F.create_map(F.lit("state"), F.col("status")))
    m = nested.merge_maps("custom_dimensions", newer)
    return t.execution_log.select("execution_id", *[nested.map_get(m, k).alias(k) for k in ("owner", "priority", "state")])


@query("sc_30_map_lookup", "SELECT execution_id, dim_owner AS owner, CAST(NULL AS VARCHAR) AS absent FROM execution_log")
def sc_30(t):
    return t.execution_log.select(
        "execution_id", nested.map_get("custom_dimensions", "owner").alias("owner"),
        nested.map_get("custom_dimensions", "absent").alias("absent"),
    )


@query("sc_31_zero_to_null", "SELECT execution_id, nullif(retry_count, 0) AS retries, retry_count AS kept FROM execution_log")
def sc_31(t):
    return t.execution_log.select("execution_id", money.zero_to_null("retry_count").alias("retries"), F.col("retry_count").alias("kept"))


@query(
    "sc_32_cost_model",
    f"SELECT company_id, {dbl('CAST(worker_count * 730 * 0.20 AS DECIMAL(20,2))')} AS monthly_usd FROM company_config",
)
def sc_32(t):
    return t.company_config.select("company_id", money.monthly_cluster_cost("worker_count").alias("monthly_usd"))


@query(
    "sc_33_strict_email",
    r"SELECT employee_id, email, coalesce(regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$'), false) AS valid FROM bronze_hr",
)
def sc_33(t):
    return t.bronze_hr.select("employee_id", "email", text.strict_email("email").alias("valid"))


@query(
    "sc_35_stable_id",
    "SELECT execution_id, sha256(execution_id || '|' || company || '|' || coalesce(error_type, '~')) AS id FROM execution_log",
)
def sc_35(t):
    return t.execution_log.select("execution_id", digest.stable_id("execution_id", "company", "error_type").alias("id"))


@query(
    "sc_36_json_property",
    "SELECT activity_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.none') AS absent FROM activity_log",
)
def sc_36(t):
    return t.activity_log.select("activity_id", nested.json_prop("props", "k").alias("k"), nested.json_prop("props", "none").alias("absent"))


@query(
    "ud_1_email_check_without_udf",
    r"SELECT count(*) FILTER (WHERE regexp_matches(email, '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$')) AS valid, count(*) AS total FROM bronze_hr",
)
def ud_1(t):
    return t.bronze_hr.agg(F.count_if(text.strict_email("email")).alias("valid"), F.count("*").alias("total"))


@query(
    "ud_2_hash_without_udf",
    "SELECT archive, count(DISTINCT sha256(content)) AS distinct_contents, count(*) AS files FROM archive_members GROUP BY 1",
)
def ud_2(t):
    hashed = t.archive_members.select("archive", digest.digest("content", "sha256").alias("h"))
    # Two steps: copies collapse per (archive, digest) before archives are counted.
    copies = hashed.groupBy("archive", "h").agg(F.count("*").alias("n"))
    return copies.groupBy("archive").agg(F.count("*").alias("distinct_contents"), F.sum("n").alias("files"))


@query(
    "ud_4_rule_registry",
    """SELECT 'hr' AS domain, count(*) AS n FROM (SELECT DISTINCT * FROM bronze_hr) WHERE employee_id IS NOT NULL
    UNION ALL SELECT 'payroll', count(*) FROM (SELECT DISTINCT * FROM simple_payroll)
      WHERE employee_id IS NOT NULL AND CAST(base_salary AS DECIMAL(12,2)) > 0
    UNION ALL SELECT 'finance', count(*) FROM (SELECT DISTINCT * FROM simple_payroll)
      WHERE employee_id IS NOT NULL AND base_salary IS NOT NULL AND bonus IS NOT NULL AND pay_period IS NOT NULL""",
)
def ud_4(t):
    rules = cleanse.default_rules()
    parts = {"hr": t.bronze_hr, "payroll": t.simple_payroll, "finance": t.simple_payroll}
    counts = [
        rules.apply(df, POD, "finance", domain, PROCESSED_AT).groupBy("domain").agg(F.count("*").alias("n"))
        for domain, df in parts.items()
    ]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])
