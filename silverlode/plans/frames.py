"""Bronze, configuration, log and file frames derived from the given tables.

Each frame grows with its source table: tenants come from ``supplier``, runs
from ``events``, files from ``documents``, staff from ``customer`` and payments
from ``orders``.  Modulus rules inject the dirt the quality rules must find.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.functions import dates, nested
from silverlode.operators import cleanse, upsert
from silverlode.session import configure

POD = "podA"
AS_OF = "2001-01-01"
PROCESSED_AT = "2001-01-01 06:00:00"
RUNS_AS_OF = "2024-01-31 00:00:00"


def _every(key: Column, n: int, rest: int = 0) -> Column:
    return key % n == rest


def _pick(key: Column, values) -> Column:
    """The value at position key mod len(values)."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (key % len(values) + 1).cast("int"))


def _strings(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


class Frames:
    """Lazily built frames over one directory of parquet tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    # ---- HR and payroll -------------------------------------------------

    @cached_property
    def bronze_hr(self) -> DataFrame:
        key = F.col("c_custkey")
        rows = self.table("customer").join(
            self.table("nation").select("n_nationkey", "n_name"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
        )
        mail = F.when(_every(key, 59), F.concat(F.lit("C"), key, F.lit(".CORP.EXAMPLE"))).otherwise(
            F.concat(F.lit("C"), key, F.lit("@CORP.EXAMPLE"))
        )
        hired = F.date_add(dates.day("1990-01-01"), ((key * 37) % 4500).cast("int"))
        copies = F.array_compact(
            F.array(F.lit(0), F.when(_every(key, 50), F.lit(1)), F.when(_every(key, 75), F.lit(2)))
        )
        made = F.timestamp_add(
            "MINUTE", (key + F.when(F.col("copy") == 2, 1440).otherwise(0)).cast("int"), dates.moment("2000-01-01 00:00:00")
        )
        rows = rows.withColumn("copy", F.explode(copies))
        return rows.select(
            F.when(~_every(key, 97), key.cast("string")).alias("employee_id"),
            F.lit("  CUSTOMER ").alias("first_name"),
            F.when(_every(key, 89), F.lit("  ")).otherwise(F.concat(F.lit("n"), key)).alias("last_name"),
            F.when(~_every(key, 53), mail).alias("email"),
            F.when(F.col("copy") == 2, F.lit("MOVED"))
            .otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(" ")))
            .alias("department"),
            F.concat(F.lit("Grade "), key % 7).alias("job_title"),
            F.when(_every(key, 211), F.lit("not-a-date")).otherwise(hired.cast("string")).alias("hire_date"),
            F.when(~_every(key, 61), F.col("c_acctbal").cast("decimal(10,2)").cast("string")).alias("salary"),
            F.when(_every(key, 10), F.lit("terminated"))
            .when(_every(key, 10, 1), F.lit("on leave"))
            .otherwise(F.lit("ACTIVE"))
            .alias("employment_status"),
            F.when(key >= 10, F.expr("c_custkey div 10").cast("string")).alias("manager_id"),
            F.when(_every(key, 31), F.lit(" ")).otherwise(F.col("n_name")).alias("office_location"),
            F.date_format(made, "yyyy-MM-dd HH:mm:ss").alias("created_datetime"),
        )

    @cached_property
    def bronze_payroll(self) -> DataFrame:
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        day = F.col("o_orderdate").cast("date")
        rows = self.table("orders").withColumn("gross", F.col("o_totalprice").cast("decimal(10,2)"))
        tax = F.round(F.col("gross") * F.lit("0.20").cast("decimal(3,2)"), 2).cast("decimal(10,2)")
        cut = F.round(F.col("gross") * F.lit("0.05").cast("decimal(3,2)"), 2).cast("decimal(10,2)")
        rows = rows.withColumn("tax", F.when(_every(key, 151), -tax).otherwise(tax)).withColumn(
            "cut", F.when(~_every(key, 13), cut)
        )
        zero = F.lit(0).cast("decimal(10,2)")
        net = F.col("gross") - F.col("tax") - F.coalesce(F.col("cut"), zero)
        net = (net + F.when(_every(key, 29), F.lit(1).cast("decimal(10,2)")).otherwise(zero)).cast("decimal(10,2)")
        before, swapped = F.date_sub(day, 14), _every(key, 67)
        prio = F.col("o_orderpriority")
        method = (
            F.when(prio == "1-URGENT", F.lit("direct deposit"))
            .when(prio == "2-HIGH", F.lit("CHECK"))
            .when(prio == "3-MEDIUM", F.lit(" Wire Transfer "))
            .when(prio == "5-LOW", F.lit("cash"))
        )
        account = F.when(prio == "1-URGENT", F.lpad((cust % 10000).cast("string"), 4, "0")).otherwise(F.lit("N/A"))
        return rows.select(
            F.when(~_every(key, 101), key.cast("string")).alias("payment_id"),
            F.when(_every(key, 83), cust + 1000000).otherwise(cust).cast("string").alias("employee_id"),
            F.when(swapped, day).otherwise(before).cast("string").alias("pay_period_start"),
            F.when(swapped, before).otherwise(day).cast("string").alias("pay_period_end"),
            F.col("gross").cast("string").alias("gross_pay"),
            F.col("tax").cast("string").alias("tax_withheld"),
            F.col("cut").cast("string").alias("deductions"),
            net.cast("string").alias("net_pay"),
            day.cast("string").alias("payment_date"),
            method.alias("payment_method"),
            account.alias("bank_account_last4"),
            F.concat(F.date_add(day, 1).cast("string"), F.lit(" 00:00:00")).alias("created_datetime"),
        )

    @cached_property
    def cleansed_hr(self) -> DataFrame:
        return cleanse.hr_bronze_to_silver(self.bronze_hr, POD, AS_OF, PROCESSED_AT)

    @cached_property
    def silver_hr(self) -> DataFrame:
        rows = cleanse.hr_bronze_to_silver(self.bronze_hr, POD, AS_OF, PROCESSED_AT, distinct=False)
        return upsert.latest_per_key(rows, ["employee_id", "pod_id"], ["created_datetime", "department"])

    @cached_property
    def cleansed_payroll(self) -> DataFrame:
        return cleanse.payroll_bronze_to_silver(self.bronze_payroll, self.silver_hr, POD, AS_OF, PROCESSED_AT)

    @cached_property
    def silver_payroll(self) -> DataFrame:
        rows = cleanse.payroll_bronze_to_silver(
            self.bronze_payroll, self.silver_hr, POD, AS_OF, PROCESSED_AT, distinct=False
        )
        return upsert.latest_per_key(rows, ["payment_id", "pod_id"], ["created_datetime"])

    @cached_property
    def simple_payroll(self) -> DataFrame:
        """Compensation rows: base_salary and bonus from the raw payments."""
        return self.bronze_payroll.select(
            "employee_id",
            F.col("gross_pay").alias("base_salary"),
            F.col("deductions").alias("bonus"),
            F.substring("payment_date", 1, 7).alias("pay_period"),
        )

    # ---- tenants --------------------------------------------------------

    @cached_property
    def company_config(self) -> DataFrame:
        key = F.col("s_suppkey")
        pod = F.concat(F.lit("pod"), _pick(key, "ABCDE"))
        company = F.concat(F.lit("company_"), key)
        domains = (
            F.when(_every(key, 8, 3), _strings())
            .when(_every(key, 4, 0), _strings("hr", "payroll"))
            .when(_every(key, 4, 1), _strings("hr", "payroll", "finance"))
            .when(_every(key, 4, 2), _strings("hr"))
            .otherwise(_strings("payroll", "inventory"))
        )
        tags = (
            F.when(_every(key, 3, 0), _strings("SOX", "GDPR"))
            .when(_every(key, 3, 1), _strings("GDPR"))
            .otherwise(_strings("HIPAA"))
        )
        return self.table("supplier").select(
            key.alias("company_key"),
            F.concat(pod, F.lit("-"), company).alias("company_id"),
            pod.alias("pod_id"),
            company.alias("company"),
            (~_every(key, 7)).alias("enabled"),
            (key % 12).cast("int").alias("worker_count"),
            domains.alias("domains"),
            F.concat(F.lit("BU-"), key % 6).alias("business_unit"),
            F.concat(F.lit("CC-"), key % 15).alias("cost_center"),
            F.when(_every(key, 40, 13), F.lit("SECRET"))
            .otherwise(_pick(key, ["PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"]))
            .alias("data_classification"),
            tags.alias("compliance_tags"),
            _pick(key, [2, 4, 6, 8, 12]).alias("sla_hours"),
            F.when(_every(key, 41, 17), F.lit("URGENT")).otherwise(_pick(key, ["HIGH", "MEDIUM", "LOW"])).alias("priority"),
            (key % 3 + 1).cast("int").alias("max_retry_count"),
            F.lit("driver-m").alias("driver_node_type"),
            F.concat(F.lit("worker-"), key % 3).alias("worker_node_type"),
            (key % 3 + 1).cast("int").alias("autoscale_min_workers"),
            F.when(_every(key, 29, 5), F.lit(0)).otherwise((key % 5 + 3).cast("int")).alias("autoscale_max_workers"),
            _every(key, 2).alias("spot_instances_enabled"),
            F.abs(F.col("s_acctbal")).cast("decimal(12,2)").alias("estimated_monthly_gb"),
            ((key * 7919) % 12000000).alias("estimated_monthly_rows"),
            F.concat(F.lit("admin"), key % 3).alias("modified_by"),
            F.timestamp_add("HOUR", (key % 1000).cast("int"), dates.moment("2024-01-01 00:00:00")).alias("modified_at"),
            _pick(key, ["APPROVED", "DRAFT"]).alias("approval_status"),
            F.lit("1.0").alias("config_version"),
        )

    @cached_property
    def config_v2(self) -> DataFrame:
        """Second snapshot: some tenants changed, some dropped, some new."""
        key = F.col("company_key")
        kept = self.company_config.where(~_every(key, 11)).withColumn(
            "worker_count", F.when(_every(key, 5), F.col("worker_count") + 1).otherwise(F.col("worker_count"))
        )
        added = self.company_config.where(_every(key, 17, 1)).withColumns(
            {
                "company_id": F.concat(F.col("company_id"), F.lit("-new")),
                "company": F.concat(F.col("company"), F.lit("-new")),
            }
        )
        return kept.unionByName(added)

    # ---- runs -----------------------------------------------------------

    @cached_property
    def execution_log(self) -> DataFrame:
        ev, user = F.col("event_id"), F.col("user_id")
        k = nested.json_prop("props", "k").try_cast("int")
        start = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
        value = F.col("value").cast("decimal(12,2)")
        took = F.floor(value * 10).cast("long")
        status = (
            F.when(F.col("event_type") == "error", F.lit("FAILED"))
            .when(F.col("event_type") == "view", F.lit("RUNNING"))
            .otherwise(F.lit("SUCCESS"))
        )
        done = status != "RUNNING"
        error = F.when(status == "FAILED", _pick(ev, ["TIMEOUT", "RESOURCE_EXHAUSTED", "SCHEMA_MISMATCH", "TRANSIENT_ERROR"]))
        rows_in = F.coalesce(k, F.lit(0)).cast("long") * 100
        rows_out = F.greatest(rows_in - ev % 7, F.lit(0))
        return self.table("events").select(
            F.concat(F.lit("exec-"), ev).alias("execution_id"),
            F.concat(F.lit("load_"), ev % 3).alias("pipeline_name"),
            user.alias("company_key"),
            F.concat(F.lit("pod"), _pick(user, "ABCDE")).alias("pod_id"),
            F.concat(F.lit("company_"), user).alias("company"),
            _pick(ev, ["hr", "payroll", "finance"]).alias("domain"),
            _pick(ev, ["bronze_to_silver", "silver_to_gold"]).alias("stage"),
            dates.add_seconds(start, -(ev % 13) * 3600).alias("file_arrival_time"),
            start.alias("execution_start_time"),
            F.when(done, dates.add_seconds(start, took)).alias("execution_end_time"),
            F.when(done, took).alias("execution_duration_seconds"),
            status.alias("status"),
            error.alias("error_type"),
            F.when(error.isNotNull(), F.concat(error, F.lit(" in run "), ev)).alias("error_message"),
            (ev % 4).cast("int").alias("retry_count"),
            rows_in.alias("input_row_count"),
            rows_out.alias("output_row_count"),
            (rows_in - rows_out).alias("rows_failed_validation"),
            (user % 4 + 1).cast("int").alias("worker_count"),
            (value * F.lit("0.1").cast("decimal(2,1)")).cast("decimal(14,3)").alias("dbu_consumed"),
            F.create_map(
                F.lit("owner"), F.concat(F.lit("team"), user % 4),
                F.lit("priority"), _pick(user, ["HIGH", "MEDIUM", "LOW"]),
            ).alias("custom_dimensions"),
            (F.lit(100) - F.coalesce(k, F.lit(0)) % 20).cast("long").alias("data_quality_score"),
            F.date_format("ts", "yyyy-MM-dd").alias("execution_date"),
        )

    @cached_property
    def activity_log(self) -> DataFrame:
        ev = F.col("event_id")
        start = F.date_trunc("second", F.col("ts")).cast("timestamp_ntz")
        failed = (F.col("event_type") == "error") & _every(ev, 2)
        return self.table("events").select(
            F.concat(F.lit("act-"), ev).alias("activity_id"),
            F.concat(F.lit("exec-"), ev).alias("execution_id"),
            F.concat(F.lit("step_"), ev % 5).alias("activity_name"),
            _pick(ev, ["Copy", "Hash", "Notebook"]).alias("activity_type"),
            F.when(failed, F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("status"),
            start.alias("start_time"),
            F.floor(F.col("value").cast("decimal(12,2)") * 5).cast("long").alias("duration_seconds"),
            (ev % 50).alias("rows_read"),
            (ev % 47).alias("rows_written"),
            F.concat_ws(" ", "event_type", "props").alias("message"),
            F.concat(F.lit("pod"), F.col("user_id") % 25).alias("resource"),
            "event_type",
            "props",
            F.col("ts").cast("timestamp_ntz").alias("ts"),
            ev.alias("event_id"),
        )

    # ---- files ----------------------------------------------------------

    @cached_property
    def bronze_files(self) -> DataFrame:
        doc = F.col("doc_id")
        owner = F.expr("doc_id div 8")
        domain = _pick(doc, ["hr", "hr", "payroll", "payroll", "finance", "inventory", "hr", "payroll"])
        name = F.concat(F.lit("doc_"), doc, _pick(doc, [".csv", ".parquet", ".txt"]))
        pod, company = F.concat(F.lit("pod"), _pick(owner, "ABCDE")), F.concat(F.lit("company_"), owner)
        return self.table("documents").select(
            pod.alias("pod_id"),
            company.alias("company"),
            domain.alias("domain"),
            name.alias("file_name"),
            F.concat_ws("/", F.lit("landing"), pod, company, domain, name).alias("path"),
            F.col("n_chars").alias("size_bytes"),
            F.timestamp_add("MINUTE", (doc % 100000).cast("int"), dates.moment("2024-01-01 00:00:00")).alias("modified_at"),
            F.col("source"),
            doc.alias("doc_id"),
        )

    @cached_property
    def archive_members(self) -> DataFrame:
        return self.table("documents").select(
            F.col("source").alias("archive"),
            F.concat(F.col("lang"), F.lit("/"), F.col("doc_id"), F.lit(".txt")).alias("path"),
            F.col("text").alias("content"),
        )

    @cached_property
    def manifest_lines(self) -> DataFrame:
        """``<digest>|<path with backslashes>`` lines, one root header per archive."""
        doc = F.col("doc_id")
        text = F.when(_every(doc, 19), F.concat(F.col("text"), F.lit("x"))).otherwise(F.col("text"))
        line = F.concat(F.sha2(text, 256), F.lit("|"), F.col("lang"), F.lit("\\"), doc, F.lit(".txt"))
        ghost = F.concat(F.sha2(F.col("text"), 256), F.lit("|"), F.col("lang"), F.lit("\\"), doc + 1000000, F.lit(".txt"))
        docs = self.table("documents")
        listed = docs.select(
            F.col("source").alias("archive"),
            F.explode(
                F.array_compact(F.array(F.when(~_every(doc, 17), line), F.when(_every(doc, 23), ghost)))
            ).alias("line"),
        )
        headers = docs.select(F.col("source").alias("archive")).distinct().select(
            "archive", F.concat(F.lit("# Root: "), F.col("archive")).alias("line")
        )
        return listed.unionByName(headers)

    @cached_property
    def archive_drops(self) -> DataFrame:
        """One delivered archive name per conversation turn; some cannot be routed."""
        conv, turn = F.col("conv_id"), F.col("turn")
        name = F.when(
            _every(conv, 13), F.concat(F.lit("ACME"), conv, F.lit(".zip"))
        ).otherwise(
            F.concat(
                F.lit("ACME"), conv % 50, F.lit("_"), _pick(turn, ["HR", "Payroll"]), F.lit("_2024-01-"),
                F.lpad((conv % 28 + 1).cast("string"), 2, "0"), F.lit(".zip"),
            )
        )
        return self.table("conversations").select(
            conv.alias("conv_id"), turn.alias("turn"), name.alias("file_name"),
            F.concat(F.lit("/landing/in/"), name).alias("url"),
        )
