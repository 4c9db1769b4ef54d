"""Scans, sinks and file integrity.

Writers go to a fresh folder below the shared scratch folder and the query
returns what a reader finds there.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import dates, digest
from silverlode.operators import integrity, quality, runs
from silverlode.session import scratch_path, shared_dir
from silverlode.sources import archives, files, manifests, sinks, workbooks

from . import deliveries
from .oracle import dbl, pct, txt
from .registry import query

STAMP = "'%Y-%m-%d %H:%M:%S'"

# ---- scans ---------------------------------------------------------------------------


def _text_schema(df) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in df.columns])


def write_csv(df, path: str) -> None:
    keep = {"header": True, "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "nullValue": "\\N"}
    df.write.options(**keep).csv(path)


def staged_csv(t, df, name: str) -> str:
    path = scratch_path(t.spark, name)
    write_csv(df, path)
    return path


SIMPLE_COLUMNS = ["employee_id", "base_salary", "bonus", "pay_period"]


@query("src_1_csv_scan", "SELECT employee_id, base_salary, bonus, pay_period FROM simple_payroll")
def src_1(t):
    path = staged_csv(t, t.simple_payroll, "csv")
    df = files.read_csv(t.spark, path, _text_schema(t.simple_payroll))
    return df.select(*[F.nullif(c, F.lit("\\N")).alias(c) for c in SIMPLE_COLUMNS])


@query(
    "src_2_inferred_csv_scan",
    f"SELECT CAST(employee_id AS BIGINT) AS employee_id, {dbl('base_salary')} AS base_salary, pay_period FROM simple_payroll",
)
def src_2(t):
    path = staged_csv(t, t.simple_payroll.select("employee_id", "base_salary", "pay_period"), "csv-infer")
    df = files.read_csv(t.spark, path, infer=True)
    return df.select("employee_id", "base_salary", F.date_format("pay_period", "yyyy-MM").alias("pay_period"))


@query(
    "src_3_glob_by_domain_prefix",
    "SELECT employee_id, last_name FROM bronze_hr",
)
def src_3(t):
    root = scratch_path(t.spark, "landing")
    write_csv(t.bronze_hr.select("employee_id", "last_name"), f"{root}/hr_2024")
    write_csv(t.bronze_payroll.select("payment_id"), f"{root}/payroll_2024")
    schema = T.StructType([T.StructField("employee_id", T.StringType()), T.StructField("last_name", T.StringType())])
    df = files.read_csv(t.spark, f"{root}/hr_*", schema, glob="*.csv")
    return df.select(F.nullif("employee_id", F.lit("\\N")).alias("employee_id"), "last_name")


@query(
    "src_4_table_by_path",
    "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
)
def src_4(t):
    return files.read_table(t.spark, f"{t.dir}/events.parquet").groupBy("event_type").agg(F.count("*").alias("n"))


@query("src_5_named_view", "SELECT company_id, priority FROM company_config WHERE enabled")
def src_5(t):
    t.company_config.createOrReplaceTempView("silverlode_company_config")
    return files.read_named(t.spark, "silverlode_company_config").where("enabled").select("company_id", "priority")


@query("src_6_one_tenant_partition", "SELECT execution_id, pod_id FROM execution_log WHERE pod_id = 'podC'")
def src_6(t):
    path = scratch_path(t.spark, "runs-by-pod")
    sinks.overwrite(t.execution_log.select("execution_id", "pod_id"), path, ["pod_id"])
    return files.read_tenant(t.spark, path, "podC")


@query(
    "src_7_scan_or_empty",
    """SELECT 'events' AS source, 'READY' AS status, count(*) AS n FROM events UNION ALL SELECT 'absent', 'NO_DATA', 0""",
)
def src_7(t):
    schema = t.table("events").schema
    parts = []
    for name in ("events", "absent"):
        df, status = files.read_or_empty(t.spark, f"{t.dir}/{name}.parquet", schema)
        parts.append(df.agg(F.count("*").alias("n")).select(F.lit(name).alias("source"), F.lit(status).alias("status"), "n"))
    return parts[0].unionByName(parts[1])


DOCS_PER_ARCHIVE = 50


def packed(t):
    """Documents as members of many bounded archives."""
    doc = F.col("doc_id")
    number = F.expr(f"doc_id div {DOCS_PER_ARCHIVE}")
    return t.table("documents").select(
        F.concat(F.lit("ACME"), number % 7, F.lit("_HR_"), number, F.lit(".zip")).alias("archive"),
        F.concat(F.lit("data/"), F.col("lang"), F.lit("/"), doc, F.lit(".txt")).alias("path"),
        F.encode("text", "utf-8").alias("content"),
    )


PACKED_SQL = f"""packed AS (SELECT 'ACME' || ((doc_id // {DOCS_PER_ARCHIVE}) % 7) || '_HR_' || (doc_id // {DOCS_PER_ARCHIVE}) || '.zip' AS archive,
    'data/' || lang || '/' || doc_id || '.txt' AS path, text, octet_length(encode(text)) AS size_bytes FROM documents)"""


def staged_once(write):
    """A delivery that is written once per table folder and kept: its queries only read it."""
    done: dict[tuple[str, str], str] = {}

    def folder(t) -> str:
        key = (t.dir, shared_dir(t.spark))
        if key not in done or not files.exists(t.spark, done[key]):
            done[key] = write(t)
        return done[key]

    return folder


@staged_once
def delivered(t) -> str:
    """A folder of ZIP archives written from the documents."""
    root = scratch_path(t.spark, "zips")
    deliveries.write_archives(packed(t), root).agg(F.sum("member_count")).first()  # runs the writing job
    return root


@query("src_9_zip_members", f"WITH {PACKED_SQL} SELECT archive, path AS member_path, size_bytes, md5(text) AS md5 FROM packed")
def src_9(t):
    members = archives.read_members(t.spark, delivered(t))
    return members.select("archive", "member_path", "size_bytes", digest.digest("content", "md5").alias("md5"))


@query("src_10_file_listing", f"WITH {PACKED_SQL} SELECT DISTINCT archive AS file_name, true AS has_bytes FROM packed")
def src_10(t):
    return files.list_files(t.spark, delivered(t), "*.zip").select("file_name", (F.col("size_bytes") > 0).alias("has_bytes"))


@query(
    "src_11_manifest_scan",
    """SELECT archive, replace(substr(line, 66), chr(92), '/') AS path, substr(line, 1, 64) AS expected FROM manifest_lines WHERE line NOT LIKE '#%'""",
)
def src_11(t):
    root = scratch_path(t.spark, "manifests")
    # One text file per archive, first line with a byte order mark.
    lines = t.manifest_lines.select("archive", F.concat(F.lit(manifests.BOM), "line").alias("value"))
    lines.write.partitionBy("archive").text(root)
    raw = t.spark.read.text(root).select(F.col("archive"), F.col("value").alias("line"))
    return manifests.parse_entries(raw)


@query(
    "src_12_literal_rows",
    """SELECT company_id, v.budget_code FROM company_config c JOIN (VALUES ('HIGH', 'B1'), ('LOW', 'B3')) v(priority, budget_code) ON v.priority = c.priority""",
)
def src_12(t):
    schema = T.StructType([T.StructField("priority", T.StringType(), False), T.StructField("budget_code", T.StringType(), False)])
    codes = files.literal_rows(t.spark, [("HIGH", "B1"), ("LOW", "B3")], schema)
    return t.company_config.select("company_id", "priority").join(codes, "priority").select("company_id", "budget_code")


@query(
    "src_13_storage_events",
    """SELECT 'evt-' || doc_id AS id, path AS subject, 'BlobCreated' AS event_type, 'https://storage.example/' || path AS url, size_bytes FROM bronze_files""",
)
def src_13(t):
    root = scratch_path(t.spark, "notices")
    notice = F.struct(
        F.lit("storage").alias("topic"), F.col("path").alias("subject"), F.lit("BlobCreated").alias("eventType"),
        F.concat(F.lit("evt-"), F.col("doc_id")).alias("id"),
        F.struct(
            F.col("size_bytes").alias("contentLength"), F.concat(F.lit("https://storage.example/"), F.col("path")).alias("url")
        ).alias("data"),
    )
    t.bronze_files.select(F.to_json(notice).alias("value")).write.text(root)
    return files.read_storage_events(t.spark, root, multi_line=False)


# ---- sinks --------------------------------------------------------------------------------


@query("snk_1_overwrite", "SELECT company_id, worker_count FROM config_v2")
def snk_1(t):
    path = scratch_path(t.spark, "config")
    cols = ["company_id", "worker_count"]
    sinks.overwrite(t.company_config.select(*cols), path)
    sinks.overwrite(t.config_v2.select(*cols), path)
    return files.read_table(t.spark, path)


@query("snk_2_append", "SELECT company_id, worker_count FROM company_config UNION ALL SELECT company_id, worker_count FROM config_v2")
def snk_2(t):
    path = scratch_path(t.spark, "config-log")
    for df in (t.company_config, t.config_v2):
        sinks.append(df.select("company_id", "worker_count"), path)
    return files.read_table(t.spark, path)


@query(
    "snk_3_partitioned_write",
    "SELECT pod_id, execution_date, count(*) AS n FROM execution_log GROUP BY 1, 2",
)
def snk_3(t):
    path = scratch_path(t.spark, "runs")
    sinks.overwrite(t.execution_log.select("execution_id", "pod_id", "execution_date"), path, ["pod_id", "execution_date"])
    df = files.read_table(t.spark, path)
    return df.groupBy("pod_id", F.col("execution_date").cast("string").alias("execution_date")).agg(F.count("*").alias("n"))


@query("snk_4_empty_table", "SELECT 0 AS rows_before, (SELECT count(*) FROM execution_log) AS rows_after")
def snk_4(t):
    path = scratch_path(t.spark, "empty")
    log = t.execution_log.select("execution_id", "status")
    sinks.create_empty(t.spark, path, log.schema)
    before = files.read_table(t.spark, path).count()
    sinks.append(log, path)
    return files.read_table(t.spark, path).agg(F.lit(before).alias("rows_before"), F.count("*").alias("rows_after"))


@query("snk_4_empty_partitioned_table", "SELECT 0 AS rows_before, (SELECT count(*) FROM execution_log) AS rows_after, 3 AS columns")
def snk_4_partitioned(t):
    path = scratch_path(t.spark, "empty")
    log = t.execution_log.select("execution_id", "status", "pod_id")
    sinks.create_empty(t.spark, path, log.schema, ["pod_id"])
    empty = files.read_table(t.spark, path)
    before, columns = empty.count(), len(empty.columns)
    sinks.append(log, path, ["pod_id"])
    after = files.read_table(t.spark, path)
    return after.agg(F.lit(before).alias("rows_before"), F.count("*").alias("rows_after"), F.lit(columns).alias("columns"))


@query("snk_5_create_if_absent", "SELECT pod_id, count(*) AS n FROM execution_log GROUP BY 1")
def snk_5(t):
    path = scratch_path(t.spark, "catalog")
    name = "silverlode_" + path.rsplit("-", 1)[-1]
    for _ in range(2):  # the second call is a no-op
        sinks.create_if_absent(t.spark, name, "execution_id STRING, pod_id STRING", path, ["pod_id"])
    t.execution_log.select("execution_id", "pod_id").write.insertInto(name)
    t.spark.sql(f"DROP TABLE {name}")
    return files.read_table(t.spark, path).groupBy("pod_id").agg(F.count("*").alias("n"))


LOAD_SCHEMA = T.StructType(
    [
        T.StructField("employee_id", T.LongType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("hire_date", T.DateType()),
        T.StructField("salary", T.DecimalType(10, 2)),
    ]
)


@query(
    "snk_6_typed_load",
    f"""SELECT try_cast(employee_id AS BIGINT) AS employee_id, substr(last_name, 1, 4) AS last_name, {txt('try_cast(hire_date AS DATE)')} AS hire_date,
    {dbl('try_cast(salary AS DECIMAL(10,2))')} AS salary FROM bronze_hr""",
)
def snk_6(t):
    path = scratch_path(t.spark, "load")
    sinks.append(sinks.truncate_to(sinks.cast_to(t.bronze_hr, LOAD_SCHEMA), {"last_name": 4}), path)
    return files.read_table(t.spark, path)


@query("snk_7_json_export", "SELECT company_id, worker_count, enabled FROM company_config")
def snk_7(t):
    path = scratch_path(t.spark, "json")
    cols = ["company_id", "worker_count", "enabled"]
    sinks.export_json(t.company_config.select(*cols), path)
    return t.spark.read.schema("company_id string, worker_count int, enabled boolean").json(path)


@query(
    "snk_7_json_rows",
    """SELECT '{"company_id":"' || company_id || '","sla_hours":' || sla_hours || '}' AS json FROM company_config""",
)
def snk_7_rows(t):
    return sinks.as_json(t.company_config.select("company_id", "sla_hours"))


@query(
    "snk_8_insert_row",
    "SELECT company_id, pod_id, worker_count FROM company_config UNION ALL SELECT 'podA-legal', 'podA', 2",
)
def snk_8(t):
    rows = t.company_config.select("company_id", "pod_id", "worker_count")
    return sinks.insert_row(rows, {"company_id": "podA-legal", "pod_id": "podA", "worker_count": 2})


@query(
    "snk_9_compaction",
    "SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS checksum, true AS fewer_files FROM events",
)
def snk_9(t):
    source, target = scratch_path(t.spark, "small"), scratch_path(t.spark, "compact")
    t.table("events").select("event_id", "event_type").repartition(24).write.parquet(source)
    sinks.compact(t.spark, source, target)
    counts = quality.count_side_by_side(
        before=files.list_files(t.spark, source, "*.parquet"), after=files.list_files(t.spark, target, "*.parquet")
    )
    fewer = counts.select(F.col("after") < F.col("before")).scalar()
    rows = files.read_table(t.spark, target).agg(F.count("*").alias("n"), F.sum("event_id").alias("checksum"))
    return rows.select("n", "checksum", fewer.alias("fewer_files"))


@query(
    "snk_10_clustered_layout",
    "SELECT company_id, enabled, priority, data_classification FROM company_config WHERE enabled AND priority = 'HIGH'",
)
def snk_10(t):
    path = scratch_path(t.spark, "clustered")
    cols = ["enabled", "priority", "data_classification"]
    sinks.cluster_by_curve(t.company_config.select("company_id", *cols), path, cols)
    return files.read_table(t.spark, path).where("enabled AND priority = 'HIGH'")


@query(
    "snk_11_table_statistics",
    "SELECT 'event_id' AS column_name, CAST(min(event_id) AS VARCHAR) AS min, CAST(max(event_id) AS VARCHAR) AS max, '0' AS num_nulls FROM events",
)
def snk_11(t):
    path = scratch_path(t.spark, "analyzed")
    name = "silverlode_" + path.rsplit("-", 1)[-1]
    sinks.overwrite(t.table("events").select("event_id", "event_type"), path)
    sinks.create_if_absent(t.spark, name, "event_id BIGINT, event_type STRING", path)
    sinks.analyze(t.spark, name, ["event_id"])
    stats = t.spark.sql(f"DESCRIBE EXTENDED {name} event_id").where(F.col("info_name").isin("min", "max", "num_nulls"))
    values = {r["info_name"]: r["info_value"] for r in stats.collect()}  # three catalog values
    t.spark.sql(f"DROP TABLE {name}")
    return files.read_table(t.spark, path).agg(
        F.lit("event_id").alias("column_name"), *[F.lit(values[k]).alias(k) for k in ("min", "max", "num_nulls")]
    )


@query(
    "snk_12_expired_snapshots",
    f"""SELECT table_name, strftime(snapshot_at, {STAMP}) AS snapshot_at FROM (SELECT DISTINCT resource AS table_name, date_trunc('hour', ts) AS snapshot_at FROM activity_log) s
    WHERE snapshot_at < TIMESTAMP '2024-01-31' - INTERVAL 168 HOUR
    AND snapshot_at < (SELECT max(date_trunc('hour', ts)) FROM activity_log a WHERE a.resource = s.table_name)""",
)
def snk_12(t):
    registry = t.activity_log.select(F.col("resource").alias("table_name"), dates.hour_bucket("ts").alias("snapshot_at")).distinct()
    return sinks.expired_snapshots(registry, "2024-01-31 00:00:00", 168)


@query(
    "snk_13_route_by_name",
    r"""SELECT file_name, company, file_type, CASE WHEN company IS NULL THEN 'UNROUTABLE' ELSE 'ROUTED' END AS route_status,
    CASE WHEN company IS NOT NULL THEN company || '/' || lower(file_type) || '/' || file_name END AS target_path FROM (
    SELECT file_name, nullif(lower(regexp_extract(file_name, '^([^_]+)_([^_]+)_(.+)\.zip$', 1)), '') AS company,
    nullif(upper(regexp_extract(file_name, '^([^_]+)_([^_]+)_(.+)\.zip$', 2)), '') AS file_type FROM archive_drops)""",
)
def snk_13(t):
    return integrity.route_drops(t.archive_drops)


@query("tm_11_partition_replace", "SELECT execution_id, pod_id, CASE WHEN pod_id = 'podB' THEN 'RELOADED' ELSE status END AS status FROM execution_log")
def tm_11(t):
    path = scratch_path(t.spark, "replace")
    log = t.execution_log.select("execution_id", "status", "pod_id")
    sinks.overwrite(log, path, ["pod_id"])
    sinks.replace_partitions(log.where("pod_id = 'podB'").withColumn("status", F.lit("RELOADED")), path, ["pod_id"])
    return files.read_table(t.spark, path).select("execution_id", "pod_id", "status")


@query(
    "dq_15_post_write_verification",
    "SELECT (SELECT count(*) FROM silver_hr) AS expected, (SELECT count(*) FROM silver_hr) AS written, true AS verified",
)
def dq_15(t):
    path = scratch_path(t.spark, "verify")
    sent, found = sinks.overwrite_verified(t.silver_hr, path, ["pod_id"])
    counts = t.spark.createDataFrame([(sent, found)], "expected long, written long")
    return counts.withColumn("verified", F.col("expected") == F.col("written"))


# ---- workbooks ---------------------------------------------------------------------------------

MONEY, TEXT, DAY = T.DecimalType(10, 2), T.StringType(), T.DateType()


def _sheet(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in fields])


# Declared columns of the ten workbook tables.
SHEETS = {
    "Employees": _sheet(("EmployeeID", TEXT), ("FirstName", TEXT), ("LastName", TEXT), ("Email", TEXT), ("Department", TEXT), ("HireDate", DAY), ("Salary", MONEY)),
    "Departments": _sheet(("DepartmentID", TEXT), ("DepartmentName", TEXT), ("ManagerID", TEXT), ("Location", TEXT), ("Budget", T.DecimalType(12, 2))),
    "Positions": _sheet(("PositionID", TEXT), ("PositionTitle", TEXT), ("DepartmentID", TEXT), ("MinSalary", MONEY), ("MaxSalary", MONEY)),
    "Locations": _sheet(("LocationID", TEXT), ("BuildingName", TEXT), ("Address", TEXT), ("City", TEXT), ("State", TEXT), ("ZipCode", TEXT), ("Capacity", T.IntegerType())),
    "Performance": _sheet(("ReviewID", TEXT), ("EmployeeID", TEXT), ("ReviewDate", DAY), ("Rating", T.DecimalType(3, 2)), ("Reviewer", TEXT), ("Comments", TEXT)),
    "Salaries": _sheet(("PayrollID", TEXT), ("EmployeeID", TEXT), ("PayPeriod", TEXT), ("GrossPay", MONEY), ("Deductions", MONEY), ("NetPay", MONEY), ("PaymentDate", DAY)),
    "Bonuses": _sheet(("BonusID", TEXT), ("EmployeeID", TEXT), ("BonusType", TEXT), ("Amount", MONEY), ("BonusDate", DAY), ("Reason", TEXT)),
    "Deductions": _sheet(("DeductionID", TEXT), ("EmployeeID", TEXT), ("DeductionType", TEXT), ("Amount", MONEY), ("DeductionDate", DAY)),
    "Benefits": _sheet(("BenefitID", TEXT), ("EmployeeID", TEXT), ("BenefitType", TEXT), ("Provider", TEXT), ("MonthlyPremium", MONEY), ("StartDate", DAY)),
    "Timesheets": _sheet(("TimesheetID", TEXT), ("EmployeeID", TEXT), ("WeekEnding", DAY), ("RegularHours", T.IntegerType()), ("OvertimeHours", T.IntegerType()), ("TotalHours", T.IntegerType())),
}
HR_SHEETS = list(SHEETS)[:5]
ROWS_PER_BOOK = 100


def cell_text(sheet: str, field: T.StructField, key):
    """Cell contents derived from a customer row, as delivered text."""
    if isinstance(field.dataType, T.DateType):
        return F.when(key % 41 == 0, F.lit("soon")).otherwise(F.date_add(dates.day("2020-01-01"), (key % 1000).cast("int")).cast("string"))
    if isinstance(field.dataType, T.DecimalType):
        if field.dataType.precision == 3:
            return F.when(key % 43 == 0, F.lit("12.5")).otherwise((key % 5).cast("string"))
        return F.when(key % 43 == 0, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("decimal(10,2)").cast("string"))
    if isinstance(field.dataType, T.IntegerType):
        return (key % 60).cast("string")
    return F.concat(F.lit(field.name), F.lit("-"), key)


def workbook_rows(t):
    """(company, file_name, sheet, row_no, cells): two books per hundred customers and company."""
    key = F.col("c_custkey")
    book = F.expr(f"c_custkey div {ROWS_PER_BOOK}")
    sheets = []
    for name, schema in SHEETS.items():
        kind = "HR" if name in HR_SHEETS else "Payroll"
        header = F.array(*[F.lit(f.name) for f in schema.fields])
        cells = F.array(*[cell_text(name, f, key) for f in schema.fields])
        line = (key % ROWS_PER_BOOK + 1).alias("row_no")
        body = F.struct(F.lit(name).alias("sheet"), line, cells.alias("cells"), F.concat(F.lit(kind), F.lit("_"), book, F.lit(".xlsx")).alias("file_name"))
        head = F.struct(F.lit(name).alias("sheet"), F.lit(0).cast("long").alias("row_no"), header.alias("cells"), F.concat(F.lit(kind), F.lit("_"), book, F.lit(".xlsx")).alias("file_name"))
        # The first customer of a book brings the header along.
        sheets += [body, F.when(key % ROWS_PER_BOOK == 0, head)]
    company = F.when(book % 2 == 0, F.lit("company_a")).otherwise(F.lit("company_b"))
    # A customer becomes rows of ten sheets, so the few bytes of the table are spread over all cores first.
    customers = t.table("customer").select("c_custkey", "c_acctbal").repartition(t.spark.sparkContext.defaultParallelism, "c_custkey")
    rows = customers.select(company.alias("company"), F.explode(F.array_compact(F.array(*sheets))).alias("s"))
    return rows.select("company", "s.file_name", "s.sheet", "s.row_no", "s.cells")


@staged_once
def delivered_workbooks(t) -> str:
    root = scratch_path(t.spark, "books")
    deliveries.write_workbooks(workbook_rows(t), root).agg(F.sum("sheets")).first()  # runs the writing job
    return root


COMPANY_SQL = f"CASE WHEN (c_custkey // {ROWS_PER_BOOK}) % 2 = 0 THEN 'company_a' ELSE 'company_b' END"
BOOK_SQL = f"(c_custkey // {ROWS_PER_BOOK}) || '.xlsx'"


@query(
    "src_8_workbook_sheets",
    " UNION ALL ".join(
        f"""SELECT {COMPANY_SQL} AS company, '{'HR' if s in HR_SHEETS else 'Payroll'}_' || {BOOK_SQL} AS file_name, '{s}' AS sheet,
        c_custkey % {ROWS_PER_BOOK} + 1 AS row_no, '{SHEETS[s].fields[0].name}-' || c_custkey AS first_cell FROM customer"""
        for s in SHEETS
    ),
)
def src_8(t):
    tall = workbooks.read_workbooks(t.spark, delivered_workbooks(t))
    first = F.coalesce(*[F.when(F.col("sheet") == s, F.col("cells")[k.fields[0].name]) for s, k in SHEETS.items()])
    return tall.select("company", "file_name", "sheet", "row_no", first.alias("first_cell"))


def loaded_sheets(t):
    staged = scratch_path(t.spark, "sheets")
    workbooks.stage_sheets(t.spark, delivered_workbooks(t), staged, SHEETS)
    return {s: workbooks.load_staged(t.spark, staged, s, schema) for s, schema in SHEETS.items()}


def _load_sql(sheet: str) -> str:
    schema = SHEETS[sheet]
    checks = {
        T.DateType: "c_custkey % 41 <> 0",
        T.DecimalType: "c_custkey % 43 <> 0",
    }
    bad = " OR ".join(sorted({f"NOT ({checks[type(f.dataType)]})" for f in schema.fields if type(f.dataType) in checks})) or "false"
    return f"SELECT '{sheet}' AS sheet, {COMPANY_SQL} AS company, count(*) AS rows_processed, count(*) FILTER (WHERE {bad}) AS rows_failed FROM customer GROUP BY 2"


@query("b2s_8_sheet_load", " UNION ALL ".join(_load_sql(s) for s in SHEETS))
def b2s_8(t):
    parts = []
    for sheet, df in loaded_sheets(t).items():
        typed = [F.col(f.name).isNotNull() for f in SHEETS[sheet].fields if not isinstance(f.dataType, T.StringType)]
        ok = F.lit(True)
        for cond in typed:
            ok = ok & cond
        parts.append(df.select(F.lit(sheet).alias("sheet"), F.col("Company").alias("company"), ok.alias("loaded")))
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df)
    return runs.rows_per_sheet(out, ["sheet", "company"])


@query(
    "b2s_8_employees_sheet",
    f"""SELECT 'EmployeeID-' || c_custkey AS "EmployeeID", 'FirstName-' || c_custkey AS "FirstName", 'LastName-' || c_custkey AS "LastName",
    'Email-' || c_custkey AS "Email", 'Department-' || c_custkey AS "Department",
    CASE WHEN c_custkey % 41 <> 0 THEN CAST(DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS VARCHAR) END AS "HireDate",
    CASE WHEN c_custkey % 43 <> 0 THEN {dbl('CAST(c_acctbal AS DECIMAL(10,2))')} END AS "Salary", {COMPANY_SQL} AS "Company" FROM customer""",
)
def b2s_8_employees(t):
    return workbooks.load_sheet(t.spark, delivered_workbooks(t), "Employees", SHEETS["Employees"])


# ---- integrity --------------------------------------------------------------------------------------


@query("fi_1_generate_manifest", "SELECT archive, path, sha256(content) AS actual FROM archive_members")
def fi_1(t):
    return integrity.generate_manifest(t.archive_members, "sha256")


@query("fi_1_manifest_from_archives", f"WITH {PACKED_SQL} SELECT archive, path, size_bytes, sha256(text) AS actual FROM packed")
def fi_1_archives(t):
    return archives.member_digests(t.spark, delivered(t), "sha256")


RESULT_SQL = f"""results AS (SELECT coalesce(l.archive, m.archive) AS archive, coalesce(l.path, m.path) AS path, expected, actual,
    CASE WHEN expected IS NULL THEN 'EXTRA' WHEN actual IS NULL THEN 'MISSING' WHEN expected = actual THEN 'OK' ELSE 'FAIL' END AS result
    FROM (SELECT DISTINCT archive, replace(substr(line, 66), chr(92), '/') AS path, substr(line, 1, 64) AS expected FROM manifest_lines WHERE line NOT LIKE '#%') l
    FULL JOIN (SELECT archive, path, sha256(content) AS actual FROM archive_members) m ON l.archive = m.archive AND l.path = m.path)"""

SUMMARY_SQL = f"""{RESULT_SQL}, summaries AS (SELECT *, 'SUMMARY: OK=' || ok_count || ' FAIL=' || fail_count || ' MISSING=' || missing_count || ' EXTRA=' || extra_count AS summary,
    CASE exit_code WHEN 0 THEN 'PASS' WHEN 3 THEN 'FAIL' ELSE 'ERROR' END AS status FROM (
    SELECT archive, count(*) FILTER (WHERE result = 'OK') AS ok_count, count(*) FILTER (WHERE result = 'FAIL') AS fail_count,
    count(*) FILTER (WHERE result = 'MISSING') AS missing_count, count(*) FILTER (WHERE result = 'EXTRA') AS extra_count,
    CASE WHEN count(*) FILTER (WHERE result <> 'OK') = 0 THEN 0 ELSE 3 END AS exit_code FROM results GROUP BY 1))"""


def results(t):
    return integrity.validate(
        manifests.parse_entries(t.manifest_lines), integrity.generate_manifest(t.archive_members, "sha256")
    )


def summaries(t):
    return integrity.summarise(results(t))


@query("fi_2_validate_files", f"WITH {RESULT_SQL} SELECT * FROM results")
def fi_2(t):
    return results(t)


@query("fi_3_archive_summary", f"WITH {SUMMARY_SQL} SELECT * FROM summaries")
def fi_3(t):
    return summaries(t)


# A delivery of archives: most carry a manifest, every fifth has one beside it, every
# fifth none and every fifth one without a root; half are wrapped in a folder.  Files
# have spaces and # in their names; some are changed, missing or not listed.
SHIPPED_SQL = f"""ship AS (SELECT 'ACME' || ((doc_id // {DOCS_PER_ARCHIVE}) % 7) || '_HR_' || (doc_id // {DOCS_PER_ARCHIVE}) || '.zip' AS archive,
    doc_id // {DOCS_PER_ARCHIVE} AS n, lang || ' files#/' || doc_id || '.txt' AS path,
    CASE WHEN doc_id % 19 <> 3 THEN sha256(CASE WHEN doc_id % 17 = 2 THEN text || 'x' ELSE text END) END AS expected,
    CASE WHEN doc_id % 23 <> 5 THEN sha256(text) END AS actual FROM documents),
    job AS (SELECT archive, path, expected, actual, CASE WHEN expected IS NULL THEN 'EXTRA' WHEN actual IS NULL THEN 'MISSING'
      WHEN expected = actual THEN 'OK' ELSE 'FAIL' END AS result
      FROM ship WHERE n % 5 NOT IN (3, 4) AND (expected IS NOT NULL OR actual IS NOT NULL)),
    job_summary AS (SELECT *, 'SUMMARY: OK=' || ok_count || ' FAIL=' || fail_count || ' MISSING=' || missing_count || ' EXTRA=' || extra_count AS summary,
      CASE exit_code WHEN 0 THEN 'PASS' WHEN 3 THEN 'FAIL' ELSE 'ERROR' END AS status FROM (
      SELECT a.archive, count(*) FILTER (WHERE result = 'OK') AS ok_count, count(*) FILTER (WHERE result = 'FAIL') AS fail_count,
        count(*) FILTER (WHERE result = 'MISSING') AS missing_count, count(*) FILTER (WHERE result = 'EXTRA') AS extra_count,
        CASE WHEN n % 5 IN (3, 4) THEN 2 WHEN count(*) FILTER (WHERE result <> 'OK') = 0 THEN 0 ELSE 3 END AS exit_code
      FROM (SELECT DISTINCT archive, n FROM ship) a LEFT JOIN job j ON j.archive = a.archive GROUP BY a.archive, n))"""


def shipped(t) -> str:
    """The folder of that delivery."""
    doc, n, text = F.col("doc_id"), F.expr(f"doc_id div {DOCS_PER_ARCHIVE}"), F.col("text")
    path = F.concat(F.col("lang"), F.lit(" files#/"), doc, F.lit(".txt"))
    rows = t.table("documents").select(
        F.concat(F.lit("ACME"), n % 7, F.lit("_HR_"), n, F.lit(".zip")).alias("archive"), n.alias("n"), "doc_id",
        path.alias("path"), text.alias("text"), F.when(doc % 17 == 2, F.concat(text, F.lit("x"))).otherwise(text).alias("listed"),
    )
    line = F.concat(F.sha2("listed", 256), F.lit("|"), F.replace("path", F.lit("/"), F.lit("\\")))
    lines = rows.where(doc % 19 != 3).groupBy("archive", "n").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    header = F.when(F.col("n") % 5 != 4, F.array(F.lit("# Root: delivery"))).otherwise(F.array(F.lit("# no root")))
    body = F.encode(F.array_join(F.concat(header, "lines"), "\n"), "utf-8").alias("content")
    wrap = F.when(F.col("n") % 2 == 0, F.concat(F.lit("wrap/"), "path")).otherwise(F.col("path")).alias("path")
    members = rows.where(doc % 23 != 5).select("archive", wrap, F.encode("text", "utf-8").alias("content"))
    own = lines.where((F.col("n") % 5 != 0) & (F.col("n") % 5 != 3)).select("archive", F.lit("list.hash").alias("path"), body)
    root = scratch_path(t.spark, "shipped")
    deliveries.write_archives(members.union(own), root).agg(F.sum("member_count")).first()
    beside = lines.where(F.col("n") % 5 == 0).select(F.concat("archive", F.lit(".hash")).alias("path"), body)
    deliveries.write_files(beside, root).agg(F.count("*")).first()
    return root


def delivery_validation(t):
    root = shipped(t)
    beside = manifests.read_manifest_lines(t.spark, root).withColumn("manifest_path", F.concat("archive", F.lit(".hash")))
    listed = files.list_files(t.spark, root, "*.zip").select(files.below(t.spark, root, F.col("path")).alias("archive"))
    members = archives.member_digests(t.spark, root, "sha256").select("archive", "path", "actual")
    return integrity.validate_archives(listed, members, archives.inside_manifests(t.spark, root), beside)


@query("fi_2_delivery_results", f"WITH {SHIPPED_SQL} SELECT * FROM job")
def fi_2_delivery(t):
    return delivery_validation(t)[0]


@query("fi_3_delivery_summary", f"WITH {SHIPPED_SQL} SELECT * FROM job_summary")
def fi_3_delivery(t):
    return delivery_validation(t)[1]


# The same archive names on two days: on the second every file is changed and one member has a twin path.
TWO_DAYS_SQL = f"""days AS (SELECT n AS day, 'ACME' || ((doc_id // {DOCS_PER_ARCHIVE}) % 7) || '_HR_' || (doc_id // {DOCS_PER_ARCHIVE}) || '.zip' AS name,
    'd/' || doc_id || '.txt' AS path, CASE WHEN n = 2 THEN 'new ' || text ELSE text END AS text FROM documents, range(1, 3) r(n))"""


def two_days(t) -> str:
    """Deliveries of two days in folders of their own."""
    root, doc = scratch_path(t.spark, "days"), F.col("doc_id")
    number = F.expr(f"doc_id div {DOCS_PER_ARCHIVE}")
    name = F.concat(F.lit("ACME"), number % 7, F.lit("_HR_"), number, F.lit(".zip")).alias("archive")
    for day, text in ((1, F.col("text")), (2, F.concat(F.lit("new "), "text"))):
        members = t.table("documents").select(name, F.concat(F.lit("d/"), doc, F.lit(".txt")).alias("path"), F.encode(text, "utf-8").alias("content"))
        deliveries.write_archives(members, f"{root}/day{day}").agg(F.sum("member_count")).first()
    return root


@query("fi_1_manifest_of_two_days", f"WITH {TWO_DAYS_SQL} SELECT 'day' || day || '/' || name AS archive, path, octet_length(encode(text)) AS size_bytes, sha256(text) AS actual FROM days")
def fi_1_days(t):
    return archives.member_digests(t.spark, two_days(t), "sha256")


@query(
    "fi_8_unzip_two_days",
    f"WITH {TWO_DAYS_SQL} SELECT 'day' || day AS day, count(*) AS placed, CAST(sum(octet_length(encode(text))) AS BIGINT) AS placed_bytes FROM days GROUP BY 1",
)
def fi_8_days(t):
    target = scratch_path(t.spark, "placed-days")
    archives.place_members(t.spark, two_days(t), target).agg(F.count("*")).first()  # runs the copying job
    found = files.list_tree(t.spark, target)
    place = F.split(files.below(t.spark, target, F.col("path")), "/")  # company/kind/day/archive/member...
    return found.groupBy(place[2].alias("day")).agg(F.count("*").alias("placed"), F.sum("size_bytes").alias("placed_bytes"))


@query(
    "fi_11_delivery_zones",
    f"WITH {SHIPPED_SQL} SELECT archive, status, CASE WHEN status = 'PASS' THEN 'staging' ELSE 'quarantine' END AS zone FROM job_summary",
)
def fi_11_delivery(t):
    return integrity.destination(delivery_validation(t)[1])


@query("sc_26_parse_summary_line", f"WITH {SUMMARY_SQL} SELECT archive, ok_count, fail_count, missing_count, extra_count FROM summaries")
def sc_26(t):
    return integrity.parse_summary(summaries(t).select("archive", "summary"))


@query(
    "sc_34_status_from_exit_code",
    "SELECT doc_id, doc_id % 4 AS exit_code, ['PASS', 'ERROR', 'ERROR', 'FAIL'][doc_id % 4 + 1] AS status FROM documents",
)
def sc_34(t):
    code = F.col("doc_id") % 4
    return t.table("documents").select("doc_id", code.alias("exit_code"), integrity.exit_status(code).alias("status"))


@query(
    "fi_4_manifest_discovery",
    """SELECT archive, coalesce(inside, beside) AS manifest_path, CASE WHEN inside IS NOT NULL THEN 'inside' ELSE 'sibling' END AS found FROM (
    SELECT source AS archive, min(CASE WHEN doc_id % 29 = 0 THEN lang || '/' || doc_id || '.hash' END) AS inside, source || '.hash' AS beside
    FROM documents GROUP BY source)""",
)
def fi_4(t):
    doc = F.col("doc_id")
    inside = t.table("documents").where(doc % 29 == 0).select(
        F.col("source").alias("archive"), F.concat(F.col("lang"), F.lit("/"), doc, F.lit(".hash")).alias("manifest_path")
    )
    beside = t.table("documents").select(F.col("source").alias("archive")).distinct().withColumn(
        "manifest_path", F.concat("archive", F.lit(".hash"))
    )
    return integrity.discover_manifests(inside, beside)


@query(
    "fi_5_wrapper_folder",
    """SELECT archive, CASE WHEN count(DISTINCT top) = 1 AND count(*) FILTER (WHERE path NOT LIKE '%/%') = 0 THEN min(top) ELSE '' END AS root
    FROM (SELECT archive, path, split_part(path, '/', 1) AS top FROM (SELECT source AS archive,
      CASE WHEN CAST(substr(source, 4) AS INTEGER) % 2 = 0 THEN 'wrap/' || lang || '/' || doc_id ELSE lang || '/' || doc_id END AS path FROM documents)) GROUP BY 1""",
)
def fi_5(t):
    return integrity.wrapper_roots(wrapped_members(t))


def wrapped_members(t):
    """Members of every second archive sit in one wrapper folder."""
    inner = F.concat(F.col("lang"), F.lit("/"), F.col("doc_id"))
    even = F.substring("source", 4, 10).cast("int") % 2 == 0
    return t.table("documents").select(
        F.col("source").alias("archive"), F.when(even, F.concat(F.lit("wrap/"), inner)).otherwise(inner).alias("path")
    )


@query("fi_5_strip_wrapper", "SELECT source AS archive, lang || '/' || doc_id AS path FROM documents")
def fi_5_strip(t):
    members = wrapped_members(t)
    return integrity.strip_roots(members, integrity.wrapper_roots(members))


@query("fi_6_root_from_header", "SELECT DISTINCT source AS archive, source AS root FROM documents")
def fi_6(t):
    return manifests.parse_roots(t.manifest_lines)


@query(
    "fi_7_digest_by_length",
    """SELECT source AS archive, lang || '/' || doc_id || '.txt' AS path, CASE doc_id % 3 WHEN 0 THEN 32 WHEN 1 THEN 64 ELSE 10 END AS digest_length,
    CASE WHEN doc_id % 3 = 2 THEN 'UNKNOWN_ALGORITHM' WHEN doc_id % 19 = 0 THEN 'FAIL' ELSE 'OK' END AS result FROM documents""",
)
def fi_7(t):
    doc, text = F.col("doc_id"), F.col("text")
    content = F.when(doc % 19 == 0, F.concat(text, F.lit("x"))).otherwise(text)
    expected = (
        F.when(doc % 3 == 0, F.upper(digest.digest(content, "md5")))
        .when(doc % 3 == 1, digest.digest(content, "sha256"))
        .otherwise(F.lit("0123456789"))
    )
    rows = t.table("documents").select(
        F.col("source").alias("archive"), F.concat(F.col("lang"), F.lit("/"), doc, F.lit(".txt")).alias("path"),
        text.alias("content"), expected.alias("expected"),
    )
    return integrity.verify_digest(rows)


@query(
    "fi_8_unzip_and_place",
    f"""WITH {PACKED_SQL} SELECT split_part(archive, '_', 1) AS company_code, count(*) AS placed, CAST(sum(size_bytes) AS BIGINT) AS placed_bytes FROM packed GROUP BY 1""",
)
def fi_8(t):
    target = scratch_path(t.spark, "placed")
    placed = archives.place_members(t.spark, delivered(t), target)
    placed.agg(F.count("*")).first()  # runs the copying job
    # Report what really lies there: target/company/kind/archive/member...
    found = files.list_tree(t.spark, target)
    below = F.split(F.element_at(F.split("path", target.rsplit("/", 1)[-1] + "/"), -1), "/")
    return found.groupBy(F.upper(below[0]).alias("company_code")).agg(
        F.count("*").alias("placed"), F.sum("size_bytes").alias("placed_bytes")
    )


@query("ud_3_one_archive_to_many_rows", f"WITH {PACKED_SQL} SELECT archive, count(*) AS members FROM packed GROUP BY 1")
def ud_3(t):
    return archives.list_members(t.spark, delivered(t)).groupBy("archive").agg(F.count("*").alias("members"))


HISTORY_SQL = f"""history AS (SELECT source || '-' || (doc_id % 40) AS archive, TIMESTAMP '2024-01-01' + to_hours(doc_id % 700) AS validated_at,
    ['PASS', 'ERROR', 'PASS', 'FAIL', 'PASS'][doc_id % 5 + 1] AS status, doc_id FROM documents)"""


def history(t):
    """One validation per document, several per archive."""
    doc = F.col("doc_id")
    status = F.element_at(F.array(*[F.lit(s) for s in ("PASS", "ERROR", "PASS", "FAIL", "PASS")]), (doc % 5 + 1).cast("int"))
    return t.table("documents").select(
        F.concat(F.col("source"), F.lit("-"), doc % 40).alias("archive"),
        F.timestamp_add("HOUR", (doc % 700).cast("int"), dates.moment("2024-01-01 00:00:00")).alias("validated_at"),
        status.alias("status"), "doc_id",
    )


@query(
    "fi_9_daily_summary",
    f"""WITH {HISTORY_SQL} SELECT {txt('CAST(validated_at AS DATE)')} AS validation_day, count(*) AS total, count(*) FILTER (WHERE status = 'PASS') AS passed,
    count(*) FILTER (WHERE status = 'FAIL') AS failed, {pct("count(*) FILTER (WHERE status = 'PASS')", 'count(*)')} AS pass_pct FROM history GROUP BY 1""",
)
def fi_9(t):
    return integrity.daily_summary(history(t))


@query(
    "fi_9_recent_failures",
    f"""WITH {HISTORY_SQL} SELECT archive, strftime(validated_at, {STAMP}) AS validated_at, status, doc_id FROM history
    WHERE status <> 'PASS' AND validated_at >= DATE '2024-01-31' - 30 ORDER BY history.validated_at DESC, archive, status, doc_id LIMIT 30""",
)
def fi_9_failures(t):
    return integrity.recent_failures(history(t), "2024-01-31", 30, 30)


@query(
    "fi_9_history_rows",
    f"""WITH {SUMMARY_SQL} SELECT archive, '2024-01-31 00:00:00' AS validated_at, status, ok_count, fail_count, missing_count, extra_count FROM summaries""",
)
def fi_9_rows(t):
    return integrity.history_rows(summaries(t), dates.moment("2024-01-31 00:00:00"))


@query(
    "fi_10_go_or_no_go",
    f"""WITH {HISTORY_SQL} SELECT archive, strftime(validated_at, {STAMP}) AS validated_at, status, status = 'PASS' AS go FROM (SELECT *, row_number() OVER (
    PARTITION BY archive ORDER BY validated_at DESC, status = 'PASS', status DESC) AS rn FROM history) WHERE rn = 1""",
)
def fi_10(t):
    return integrity.latest_status(history(t))


@query(
    "fi_11_quarantine_split",
    f"WITH {SUMMARY_SQL} SELECT archive, status, CASE WHEN status = 'PASS' THEN 'staging' ELSE 'quarantine' END AS zone FROM summaries",
)
def fi_11(t):
    return integrity.destination(summaries(t))


@query(
    "fi_1_manifest_lines",
    """SELECT archive, sha256(content) || '|' || replace(path, '/', chr(92)) AS line FROM archive_members
    UNION ALL SELECT DISTINCT archive, '# Root: ' || archive FROM archive_members""",
)
def fi_1_lines(t):
    return integrity.manifest_text(integrity.generate_manifest(t.archive_members, "sha256"))
