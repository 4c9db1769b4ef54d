"""Company configuration: listings, statistics, completeness gate and work list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import money, nested, paths, ranking


def by_priority(alphabetical: bool = False) -> list[Column]:
    """HIGH, MEDIUM, LOW; or the plain descending text order."""
    return [F.col("priority").desc()] if alphabetical else [ranking.priority_rank("priority").asc()]


def enabled_companies(config: DataFrame, pod: str, alphabetical: bool = False) -> DataFrame:
    picked = config.where((F.col("pod_id") == pod) & F.col("enabled"))
    return picked.orderBy(*by_priority(alphabetical), "company").select(
        "company_id", "company", "worker_count", "domains", "priority", "sla_hours"
    )


def enabled_companies_json(config: DataFrame, pod: str) -> DataFrame:
    """One JSON text per enabled company, for callers outside Spark."""
    rows = config.where((F.col("pod_id") == pod) & F.col("enabled"))
    return rows.select("company_id", F.to_json(F.struct("company", "worker_count", "domains")).alias("json"))


def high_priority_by_sla(config: DataFrame) -> DataFrame:
    picked = config.where(F.col("enabled") & (F.col("priority") == "HIGH"))
    return picked.orderBy("sla_hours", "company_id").select(
        "pod_id", "company", "data_classification", "sla_hours", "estimated_monthly_gb", "compliance_tags"
    )


def cluster_settings(config: DataFrame, pod: str) -> DataFrame:
    return config.where(F.col("enabled") & (F.col("pod_id") == pod)).select(
        "company_id", "worker_node_type", "autoscale_min_workers", "autoscale_max_workers", "spot_instances_enabled"
    )


def chargeback_listing(config: DataFrame) -> DataFrame:
    return config.where("enabled").orderBy(F.col("estimated_monthly_gb").desc(), "company_id").select(
        "pod_id", "company", "business_unit", "cost_center", "estimated_monthly_gb", "data_classification"
    )


def requiring_compliance(config: DataFrame, tag: str) -> DataFrame:
    picked = config.where(F.col("enabled") & F.array_contains("compliance_tags", tag))
    return picked.orderBy(F.col("data_classification").desc(), "company_id").select(
        "company_id", "business_unit", "data_classification", "compliance_tags"
    )


def simple_view(config: DataFrame, alphabetical: bool = False) -> DataFrame:
    return config.where("enabled").orderBy("pod_id", *by_priority(alphabetical), "company").select(
        "company_id", "pod_id", "company", "enabled", "worker_count", "domains", "priority", "sla_hours",
        "driver_node_type", "worker_node_type", "autoscale_min_workers", "autoscale_max_workers",
        "spot_instances_enabled", "data_classification", "cost_center",
    )


def pod_statistics(config: DataFrame) -> DataFrame:
    return config.groupBy("pod_id").agg(
        F.count("company_id").alias("company_count"),
        F.sum("worker_count").alias("total_workers"),
        F.sum("estimated_monthly_gb").cast("decimal(20,2)").alias("total_gb_monthly"),
    )


def label_statistics(config: DataFrame) -> DataFrame:
    """Companies per priority and per classification in one pass."""
    pairs = F.array(
        F.struct(F.lit("priority").alias("dimension"), F.col("priority").alias("label")),
        F.struct(F.lit("data_classification").alias("dimension"), F.col("data_classification").alias("label")),
    )
    return config.select(F.inline(pairs)).groupBy("dimension", "label").agg(F.count("*").alias("company_count"))


def cost_center_rollup(config: DataFrame) -> DataFrame:
    return config.where("enabled").groupBy("business_unit", "cost_center").agg(
        F.count("*").alias("company_count"),
        F.sum("estimated_monthly_gb").cast("decimal(20,2)").alias("total_gb_monthly"),
        F.sum("worker_count").alias("total_workers"),
    )


def monthly_cost_estimate(config: DataFrame) -> DataFrame:
    return config.where("enabled").select(
        "company_id", "business_unit",
        money.monthly_cluster_cost("worker_count").alias("estimated_monthly_cost_usd"),
        "estimated_monthly_gb",
    ).orderBy(F.col("estimated_monthly_cost_usd").desc(), "company_id")


# Sizing bands (upper GB bound -> worker range) and SLA hour ranges.
WORKER_BANDS = ((50, 1, 1), (150, 2, 2), (300, 3, 4))
LARGEST_BAND = (5, 10)
SLA_BANDS = {"HIGH": (2, 4), "MEDIUM": (6, 8), "LOW": (12, 24)}


def guideline_check(config: DataFrame) -> DataFrame:
    """Recommended workers and SLA by volume and priority, and conformity of the set values."""
    gb = F.col("estimated_monthly_gb")
    low, high = F.lit(LARGEST_BAND[0]), F.lit(LARGEST_BAND[1])
    for bound, lo, hi in reversed(WORKER_BANDS):
        low, high = F.when(gb < bound, lo).otherwise(low), F.when(gb < bound, hi).otherwise(high)
    sla_low = F.coalesce(*[F.when(F.col("priority") == p, F.lit(b[0])) for p, b in SLA_BANDS.items()])
    sla_high = F.coalesce(*[F.when(F.col("priority") == p, F.lit(b[1])) for p, b in SLA_BANDS.items()])
    return config.select(
        "company_id",
        low.alias("recommended_min_workers"),
        high.alias("recommended_max_workers"),
        F.col("worker_count").between(low, high).alias("workers_conform"),
        sla_low.alias("sla_from"),
        sla_high.alias("sla_to"),
        F.coalesce(F.col("sla_hours").between(sla_low, sla_high), F.lit(False)).alias("sla_conforms"),
    )


# ---- completeness -------------------------------------------------------------------


def domains_found(files: DataFrame) -> DataFrame:
    """(pod_id, company, found_domains) from delivered data files.

    Distinct first: the set per company is then as large as its domains, however
    many files it delivered.
    """
    seen = files.where(paths.is_data_file("file_name")).select("pod_id", "company", "domain").distinct()
    return seen.groupBy("pod_id", "company").agg(F.sort_array(F.collect_list("domain")).alias("found"))


def completeness_gate(config: DataFrame, files: DataFrame) -> DataFrame:
    """COMPLETE or INCOMPLETE per enabled company, with missing and startable domains."""
    keys = ["pod_id", "company"]
    joined = config.where("enabled").select(*keys, F.col("domains").alias("required")).join(
        domains_found(files), keys, "left"
    )
    found = F.coalesce("found", F.array().cast("array<string>"))
    missing = nested.missing_items("required", found)
    complete = F.size(missing) == 0
    return joined.select(
        *keys,
        F.when(complete, F.lit("COMPLETE")).otherwise(F.lit("INCOMPLETE")).alias("status"),
        F.when(complete, F.col("required")).otherwise(F.array().cast("array<string>")).alias("domains_to_process"),
        missing.alias("missing_domains"),
        nested.shared_items("required", found).alias("found_domains"),
    )


def has_data_gate(config: DataFrame, files: DataFrame) -> DataFrame:
    """File count per enabled company and whether it has anything to process."""
    counts = files.groupBy("pod_id", "company").agg(F.count("*").alias("n"))
    joined = config.where("enabled").select("pod_id", "company").join(counts, ["pod_id", "company"], "left")
    n = F.coalesce("n", F.lit(0))
    return joined.select("pod_id", "company", n.alias("file_count"), (n > 0).alias("has_data"))


def work_list(gate: DataFrame) -> DataFrame:
    """One row per (company, domain) ready to process."""
    return gate.where("status = 'COMPLETE'").select("pod_id", "company", F.explode("domains_to_process").alias("domain"))


def found_report(gate: DataFrame) -> DataFrame:
    """The gate's answer as one JSON text per company."""
    payload = F.to_json(F.struct("status", "domains_to_process", "missing_domains", "found_domains"))
    return gate.select("pod_id", "company", payload.alias("output"))


def tenant_rows(df: DataFrame, pod: str) -> DataFrame:
    """Rows one tenant may see."""
    return df.where(F.col("pod_id") == pod)


def label_tenants(sources: dict[str, DataFrame]) -> DataFrame:
    """Union of same-shaped tenant tables with a ``company`` column."""
    parts: Sequence[DataFrame] = [df.withColumn("company", F.lit(name)) for name, df in sources.items()]
    out = parts[0]
    for df in parts[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
