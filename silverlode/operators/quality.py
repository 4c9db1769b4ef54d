"""Profiling, declarative quality rules, quarantine and verification."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import dates, money, ranking, text
from silverlode.sources import sinks

# ---- labelled counts ----------------------------------------------------------


def labelled_counts(counts: DataFrame, labels: dict[str, str]) -> DataFrame:
    """One wide row of counts -> (issue_type, record_count, percentage).

    ``labels`` maps the column to its label; the column ``total`` is the
    denominator and itself reported with percentage 0.
    """
    rows = F.array(
        *[
            F.struct(
                F.lit(label).alias("issue_type"),
                F.col(c).alias("record_count"),
                (F.lit(0).cast("decimal(20,2)") if c == "total" else money.percent(F.col(c), F.col("total"))).alias(
                    "percentage"
                ),
            )
            for c, label in labels.items()
        ]
    )
    return counts.select(F.inline(rows))


def _null_aware_duplicates(key: str, count_nulls_as_duplicates: bool) -> Column:
    rows = F.count("*") if count_nulls_as_duplicates else F.count(key)
    return (rows - F.count_distinct(F.col(key))).alias("duplicates")


# Labels of the HR and payroll issue reports.
HR_ISSUES = {
    "total": "Total Records",
    "null_id": "NULL employee_id",
    "duplicates": "Duplicate Records",
    "future_hire": "Future Hire Dates",
    "bad_salary": "Invalid Salary (<=0 or NULL)",
    "missing_email": "Missing Email",
    "bad_email": "Invalid Email Format",
}
PAYROLL_ISSUES = {
    "total": "Total Records",
    "null_id": "NULL payment_id",
    "duplicates": "Duplicate payment_id",
    "orphan": "Invalid employee_id (not in HR)",
    "bad_range": "Invalid Date Range (start >= end)",
    "future_payment": "Future Payment Dates",
    "null_deductions": "NULL Deductions",
    "wrong_net": "Incorrect Net Pay Calculation",
}


def profile_employees(df: DataFrame, as_of: str, count_nulls_as_duplicates: bool = False) -> DataFrame:
    """HR issue report in one pass over the raw rows."""
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("employee_id").isNull()).alias("null_id"),
        _null_aware_duplicates("employee_id", count_nulls_as_duplicates),
        F.count_if(dates.to_day("hire_date") > dates.day(as_of)).alias("future_hire"),
        F.count_if((money.money("salary") <= 0) | F.col("salary").isNull()).alias("bad_salary"),
        F.count_if(text.is_blank("email")).alias("missing_email"),
        F.count_if(text.has_text("email") & ~text.loose_email("email")).alias("bad_email"),
    )
    return labelled_counts(counts, HR_ISSUES)


def profile_payments(
    df: DataFrame, employees: DataFrame, pod: str, as_of: str, count_nulls_as_duplicates: bool = False
) -> DataFrame:
    """Payroll issue report: one pass over the rows joined to a known-employee flag."""
    known = employees.where(F.col("pod_id") == pod).select(F.col("employee_id").alias("_id")).distinct()
    flagged = df.join(known, df["employee_id"].try_cast("long") == F.col("_id"), "left")
    gap = money.net_pay_gap("net_pay", "gross_pay", "tax_withheld", "deductions")
    counts = flagged.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("payment_id").isNull()).alias("null_id"),
        _null_aware_duplicates("payment_id", count_nulls_as_duplicates),
        F.count_if(F.col("_id").isNull()).alias("orphan"),
        F.count_if(dates.to_day("pay_period_start") >= dates.to_day("pay_period_end")).alias("bad_range"),
        F.count_if(dates.to_day("payment_date") > dates.day(as_of)).alias("future_payment"),
        F.count_if(F.col("deductions").isNull()).alias("null_deductions"),
        F.count_if(money.beyond_tolerance(gap)).alias("wrong_net"),
    )
    return labelled_counts(counts, PAYROLL_ISSUES)


# ---- comparisons of whole tables ------------------------------------------------


def count_side_by_side(**tables: DataFrame) -> DataFrame:
    """One row with ``count(*)`` of every table under its keyword, without a cross join."""
    tagged = [df.agg(F.count("*").alias("n")).withColumn("t", F.lit(name)) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, tagged).agg(
        *[F.sum(F.when(F.col("t") == name, F.col("n"))).alias(name) for name in tables]
    )


def cleansing_impact(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    n = count_side_by_side(bronze_row_count=bronze, silver_row_count=silver)
    lost = F.col("bronze_row_count") - F.col("silver_row_count")
    return n.select(
        "bronze_row_count",
        "silver_row_count",
        lost.alias("rows_filtered"),
        money.percent(lost, F.col("bronze_row_count")).alias("filter_percentage"),
    )


def dependency_check(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, record_count, status) with FAIL for an empty prerequisite."""
    checks = [
        df.agg(F.count("*").alias("record_count")).select(
            F.lit(name).alias("table_name"),
            "record_count",
            F.when(F.col("record_count") > 0, F.lit("PASS")).otherwise(F.lit(f"FAIL - {name} is empty")).alias("status"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def row_counts(tables: dict[str, DataFrame], name_column: str = "table_name", total: str | None = None) -> DataFrame:
    """Row count per table, optionally with a grand-total line."""
    counts = reduce(
        DataFrame.unionByName,
        [df.agg(F.count("*").alias("record_count")).select(F.lit(n).alias(name_column), "record_count") for n, df in tables.items()],
    )
    if total is None:
        return counts
    return counts.rollup(name_column).agg(F.sum("record_count").alias("record_count")).select(
        F.coalesce(name_column, F.lit(total)).alias(name_column), "record_count"
    )


def run_summary(pod: str, domain: str, source: str, completed_at: str, **tables: DataFrame) -> DataFrame:
    return count_side_by_side(**tables).withColumns(
        {
            "pod_id": F.lit(pod),
            "domain": F.lit(domain),
            "source_file": F.lit(source),
            "completed_at": F.lit(completed_at).cast("timestamp"),
        }
    )


# ---- referential integrity --------------------------------------------------------


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent.

    Child keys are text as delivered.  A null or uncastable key has no parent.
    """
    keys = parent.select(F.col(parent_key).alias("_parent"))
    return child.join(keys, child[child_key].try_cast("long") == F.col("_parent"), "left_anti")


def orphan_report(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    lost = orphans(child, parent, child_key, parent_key)
    return lost.groupBy(child_key).agg(F.count("*").alias("payment_count"))


def integrity_check(payments: DataFrame, employees: DataFrame) -> DataFrame:
    """True containment: PASS only if no paid employee is missing from staff."""
    paid = payments.select("employee_id").distinct()
    staff = employees.select(F.col("employee_id").alias("_id")).distinct()
    both = paid.join(staff, paid["employee_id"] == F.col("_id"), "full_outer")
    counts = both.agg(
        F.count("employee_id").alias("unique_employees_in_payroll"),
        F.count("_id").alias("unique_employees_in_hr"),
        F.count_if(F.col("employee_id").isNotNull() & F.col("_id").isNull()).alias("orphaned_employees"),
    )
    status = F.when(F.col("orphaned_employees") == 0, F.lit("PASS - All payroll employee_ids exist in HR"))
    return counts.withColumn("integrity_status", status.otherwise(F.lit("FAIL - Orphaned employee_ids found")))


def net_pay_discrepancies(df: DataFrame) -> DataFrame:
    gap = money.net_pay_gap("net_pay", "gross_pay", "tax_withheld", "deductions")
    return df.select(
        "payment_id",
        "employee_id",
        money.money("gross_pay").alias("original_gross_pay"),
        money.money("tax_withheld").alias("original_tax_withheld"),
        money.money_or_zero("deductions").alias("original_deductions"),
        money.money("net_pay").alias("original_net_pay"),
        money.net_pay("gross_pay", "tax_withheld", "deductions").alias("recalculated_net_pay"),
        gap.alias("discrepancy"),
    ).where(money.beyond_tolerance(F.col("discrepancy")))


# ---- rule engine ------------------------------------------------------------------

# What happens to a failing row, by action name.
REJECTED, QUARANTINED, ACCEPTED_WITH_WARNING = "REJECTED", "QUARANTINED", "ACCEPTED_WITH_WARNING"


@dataclass(frozen=True)
class Rule:
    """One quality rule.

    ``kind`` is NOT_NULL, FORMAT, RANGE, UNIQUENESS or REFERENCE.  Row rules give
    ``passes``, a condition that is true for a good row (null counts as failed).
    UNIQUENESS and REFERENCE work on ``column``; REFERENCE also names the parent.
    """

    name: str
    kind: str
    column: str
    passes: Column | None = None
    parent: DataFrame | None = None
    parent_column: str | None = None
    severity: str = "CRITICAL"
    action: str = REJECTED


def not_null(column: str, **kw) -> Rule:
    return Rule(f"{column}_not_null", "NOT_NULL", column, F.col(column).isNotNull(), **kw)


def matches(column: str, regex: str, **kw) -> Rule:
    return Rule(f"{column}_format", "FORMAT", column, F.col(column).rlike(regex), **kw)


def in_range(column: str, low, high, data_type: str = "decimal(12,2)", **kw) -> Rule:
    v = F.col(column).try_cast(data_type)
    return Rule(f"{column}_range", "RANGE", column, (v > F.lit(low)) & (v < F.lit(high)), **kw)


def unique(column: str, **kw) -> Rule:
    return Rule(f"{column}_unique", "UNIQUENESS", column, **kw)


def references(column: str, parent: DataFrame, parent_column: str, **kw) -> Rule:
    return Rule(f"{column}_reference", "REFERENCE", column, None, parent, parent_column, **kw)


def _flag(rule: Rule) -> str:
    return f"_failed_{rule.name}"


def _join_key(rule: Rule, column: Column) -> dict[str, Column]:
    """Key columns of a row for ``rule``'s join; rows without a key, which match nothing, are spread by their task."""
    return {
        f"_key_{rule.name}": column,
        f"_spread_{rule.name}": F.when(column.isNull(), F.spark_partition_id()).otherwise(F.lit(-1)),
    }


def flag_failures(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` plus one boolean column per rule, true where the row fails it.

    Row rules are plain expressions.  UNIQUENESS joins the (small) set of
    repeated keys instead of gathering each key's rows in a window, and
    REFERENCE joins the distinct parent keys; AQE splits skewed partitions of
    the row side in both.
    """
    out = df
    for r in rules:
        if r.kind == "UNIQUENESS":
            repeated = df.where(F.col(r.column).isNotNull()).groupBy(r.column).agg(F.count("*").alias("_n"))
            known, key = repeated.where("_n > 1").select(F.col(r.column).alias("_known")), F.col(r.column)
        elif r.kind == "REFERENCE":
            parents = r.parent.select(F.col(r.parent_column).cast("string").alias("_known"))
            known, key = parents.where("_known IS NOT NULL").distinct(), F.col(r.column).cast("string")
        else:
            continue
        # Not a literal: the optimizer would take a constant out of the join's key.
        nowhere = F.length(F.col("_known").cast("string")) * 0 - 1
        known = known.select(F.col("_known").alias(f"_k_{r.name}"), nowhere.alias(f"_no_{r.name}"))
        own = _join_key(r, key)
        same = (F.col(f"_key_{r.name}") == F.col(f"_k_{r.name}")) & (F.col(f"_spread_{r.name}") == F.col(f"_no_{r.name}"))
        found = F.col(f"_k_{r.name}").isNotNull()
        out = out.withColumns(own).join(known, same, "left")
        out = out.withColumn(_flag(r), found if r.kind == "UNIQUENESS" else ~found)
        out = out.drop(*own, f"_k_{r.name}", f"_no_{r.name}")
    return out.withColumns({_flag(r): ~F.coalesce(r.passes, F.lit(False)) for r in rules if r.passes is not None})


KEY_KINDS = ("UNIQUENESS", "REFERENCE")
ALL_ROWS = -1


def _notes(rules: Sequence[Rule]) -> Column:
    """What a row adds to the counts: itself, its failures of row rules, and its keys under the rules on keys."""

    def note(rule: int, key: Column, failed: int, sample: Column) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), key.alias("key"), F.lit(1).cast("long").alias("n"), F.lit(failed).cast("long").alias("failed"),
            sample.alias("sample"), F.lit(False).alias("known"),
        )

    nothing = F.lit(None).cast("string")
    out = [note(ALL_ROWS, nothing, 0, nothing)]
    for i, r in enumerate(rules):
        value = F.col(r.column).cast("string")
        bad = F.coalesce(value, F.lit("NULL"))
        if r.kind not in KEY_KINDS:
            out.append(F.when(~F.coalesce(r.passes, F.lit(False)), note(i, nothing, 1, bad)))
        elif r.kind == "REFERENCE":
            out.append(F.when(value.isNull(), note(i, nothing, 1, bad)).otherwise(note(i, value, 0, bad)))
        else:
            out.append(F.when(value.isNotNull(), note(i, value, 0, bad)))
    return F.array_compact(F.array(*out))


def failure_counts(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """(rule, failed, sample) by the rules' positions; rule -1 counts the rows.

    One scan of the rows and one aggregate, whatever the number of rules: rows become
    notes under (rule, key), parents are noted as known keys, and notes are combined
    before they are shuffled.  Repeated keys and keys without a parent are then told by
    their counts; no row is joined, and notes without a key are one per rule and task.
    """
    tall = df.select(F.inline(_notes(rules)))
    for i, r in enumerate(rules):
        if r.kind == "REFERENCE":
            key = F.col(r.parent_column).cast("string")
            known = r.parent.where(key.isNotNull()).select(
                F.lit(i).alias("rule"), key.alias("key"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("failed"),
                key.alias("sample"), F.lit(True).alias("known"),
            )
            tall = tall.unionByName(known)
    keys = tall.groupBy("rule", "key").agg(
        F.sum("n").alias("n"), F.sum("failed").alias("failed"), F.min("sample").alias("sample"), F.bool_or("known").alias("known")
    )
    unique_rules = [i for i, r in enumerate(rules) if r.kind == "UNIQUENESS"]
    by_key = F.col("key").isNotNull()
    bad_key = F.when(F.col("rule").isin(unique_rules), F.col("n") > 1).otherwise(~F.col("known"))
    failed = F.when(by_key, F.when(bad_key, F.col("n")).otherwise(0)).when(F.col("rule") == ALL_ROWS, F.col("n")).otherwise(F.col("failed"))
    counted = keys.withColumn("failed", failed)
    return counted.groupBy("rule").agg(
        F.sum("failed").alias("failed"), F.min(F.when(F.col("failed") > 0, F.col("sample"))).alias("sample")
    )


def check_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Quality-log rows: checked, passed, failed, pass %, severity, action, sample.

    The sample is the smallest failing value, kept by a plain aggregate; failing
    rows are never gathered, and rows are scanned once (``failure_counts``).
    """
    counts = failure_counts(df, rules)
    wide = counts.agg(
        F.coalesce(F.sum(F.when(F.col("rule") == ALL_ROWS, F.col("failed"))), F.lit(0)).alias("_checked"),
        *[F.coalesce(F.sum(F.when(F.col("rule") == i, F.col("failed"))), F.lit(0)).alias(f"_n_{r.name}") for i, r in enumerate(rules)],
        *[F.min(F.when(F.col("rule") == i, F.col("sample"))).alias(f"_s_{r.name}") for i, r in enumerate(rules)],
    )
    rows = []
    for r in rules:
        failed = F.col(f"_n_{r.name}")
        passed = F.col("_checked") - failed
        rows.append(
            F.struct(
                F.lit(r.name).alias("rule_name"),
                F.lit(r.kind).alias("rule_type"),
                F.lit(r.column).alias("column_name"),
                F.col("_checked").alias("records_checked"),
                passed.alias("records_passed"),
                failed.alias("records_failed"),
                money.percent(passed, F.col("_checked")).alias("pass_percentage"),
                F.lit(r.severity).alias("severity"),
                F.when(failed > 0, F.lit(r.action)).otherwise(F.lit("ACCEPTED")).alias("action_taken"),
                F.col(f"_s_{r.name}").alias("error_sample"),
            )
        )
    return wide.select(F.inline(F.array(*rows)))


def route_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``df`` plus ``failed_rules`` and the strictest ``disposition`` of its failures."""
    flagged = flag_failures(df, rules)
    failed = F.array_compact(F.array(*[F.when(F.col(_flag(r)), F.lit(r.name)) for r in rules]))

    def hit(action: str) -> Column:
        return text.any_of([F.lit(False), *[F.col(_flag(r)) for r in rules if r.action == action]])

    disposition = (
        F.when(hit(REJECTED), F.lit(REJECTED))
        .when(hit(QUARANTINED), F.lit(QUARANTINED))
        .when(hit(ACCEPTED_WITH_WARNING), F.lit(ACCEPTED_WITH_WARNING))
        .otherwise(F.lit("ACCEPTED"))
    )
    out = flagged.withColumns({"failed_rules": failed, "disposition": disposition})
    return out.drop(*[_flag(r) for r in rules])


def split_by_disposition(routed: DataFrame) -> dict[str, DataFrame]:
    """Accepted (with or without warning), quarantined and rejected rows."""
    kind = F.col("disposition")
    return {
        "accepted": routed.where(kind.isin("ACCEPTED", ACCEPTED_WITH_WARNING)),
        "quarantined": routed.where(kind == QUARANTINED),
        "rejected": routed.where(kind == REJECTED),
    }


def write_routed(df: DataFrame, rules: Sequence[Rule], path: str) -> None:
    """Route all rows in one pass into one folder per disposition below ``path``."""
    sinks.overwrite(route_rows(df, rules), path, ["disposition"])


def routed_counts(spark: SparkSession, path: str) -> DataFrame:
    """(part, record_count) of written rows; files' footers and folder names suffice."""
    part = (
        F.when(F.col("disposition").isin("ACCEPTED", ACCEPTED_WITH_WARNING), "accepted")
        .when(F.col("disposition") == QUARANTINED, "quarantined")
        .otherwise("rejected")
    )
    parts = spark.createDataFrame([("accepted",), ("quarantined",), ("rejected",)], "part string")
    found = spark.read.parquet(path).groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    return parts.join(found, "part", "left").select("part", F.coalesce("n", F.lit(0)).alias("record_count"))


def quality_trend(log: DataFrame, as_of: str, days: int, severities=("CRITICAL", "WARNING")) -> DataFrame:
    recent = log.where((F.col("check_date") >= F.date_sub(dates.day(as_of), days)) & F.col("severity").isin(*severities))
    return recent.groupBy("rule_name", "rule_type").agg(
        F.avg(F.col("pass_percentage").cast("double")).alias("avg_pass_rate"),
        F.sum("records_failed").alias("total_failures"),
    )


def quality_score(log: DataFrame, keys: Sequence[str], threshold: float = 95.0) -> DataFrame:
    """Share of checked records that passed per dataset, and whether it reaches the gate."""
    score = money.percent(F.sum("records_passed"), F.sum("records_checked"))
    scored = log.groupBy(*keys).agg(score.alias("quality_score"))
    gate = F.when(F.col("quality_score") < threshold, F.lit("CRITICAL")).otherwise(F.lit("PASS"))
    return scored.withColumn("gate", gate)


def metrics_against_thresholds(metrics: DataFrame, thresholds: DataFrame) -> DataFrame:
    """(metric_name, metric_value) joined with its floor: PASS, WARN when unknown, FAIL below."""
    joined = metrics.join(thresholds, "metric_name", "left")
    status = (
        F.when(F.col("threshold_value").isNull(), F.lit("WARN"))
        .when(F.col("metric_value") >= F.col("threshold_value"), F.lit("PASS"))
        .otherwise(F.lit("FAIL"))
    )
    return joined.select("metric_name", "metric_value", "threshold_value", status.alias("status"))


def contract_rules(schema: T.StructType, lengths: dict[str, int] | None = None, key: str | None = None) -> list[Rule]:
    """Rules that delivered text columns fit a declared table.

    NOT NULL columns must be present, every value must cast to its type, texts
    must not exceed their length, and the key must be unique.
    """
    rules: list[Rule] = []
    for f in schema.fields:
        c = F.col(f.name)
        if not f.nullable:
            rules.append(Rule(f"{f.name}_required", "NOT_NULL", f.name, c.isNotNull()))
        if not isinstance(f.dataType, T.StringType):
            fits = c.isNull() | c.try_cast(f.dataType).isNotNull()
            rules.append(Rule(f"{f.name}_type", "FORMAT", f.name, fits))
    for name, n in (lengths or {}).items():
        fits = F.col(name).isNull() | (F.length(name) <= n)
        rules.append(Rule(f"{name}_length", "RANGE", name, fits, severity="WARNING", action=ACCEPTED_WITH_WARNING))
    if key:
        rules.append(unique(key))
    return rules


# ---- configuration checks ----------------------------------------------------------

# Allowed priorities, classifications and worker range.
VALID_PRIORITIES = ranking.PRIORITIES
VALID_CLASSIFICATIONS = ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED")
WORKER_RANGE = (1, 10)


def validate_config(config: DataFrame) -> DataFrame:
    """(rule_name, violations, first_offender, status) of the six configuration rules."""
    repeated = config.groupBy("company_id").agg(F.count("*").alias("_n")).where("_n > 1").select(
        F.col("company_id").alias("_dup")
    )
    rows = config.join(repeated, F.col("company_id") == F.col("_dup"), "left")
    low, high = WORKER_RANGE
    broken = {
        "duplicate_company_id": F.col("_dup").isNotNull(),
        "worker_count_range": ~F.col("worker_count").between(low, high),
        "empty_domains": F.size("domains") == 0,
        "invalid_priority": ~F.col("priority").isin(*VALID_PRIORITIES),
        "invalid_classification": ~F.col("data_classification").isin(*VALID_CLASSIFICATIONS),
        "autoscale_inverted": F.col("autoscale_min_workers") > F.col("autoscale_max_workers"),
    }
    aggs = []
    for name, cond in broken.items():
        aggs += [F.count_if(cond).alias(f"n_{name}"), F.min(F.when(cond, F.col("company_id"))).alias(f"o_{name}")]
    rows_out = [
        F.struct(
            F.lit(name).alias("rule_name"),
            F.col(f"n_{name}").alias("violations"),
            F.col(f"o_{name}").alias("first_offender"),
            F.when(F.col(f"n_{name}") == 0, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        )
        for name in broken
    ]
    return rows.agg(*aggs).select(F.inline(F.array(*rows_out)))
