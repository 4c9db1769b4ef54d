"""Execution, activity, lineage, SLA and cost logs and the reports on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverlode.functions import dates, money, nested, text

UNKNOWN = "Unknown"
# Label of runs whose company has no configuration row.
UNASSIGNED = "UNASSIGNED"
LOG_VERSION = "1.0.0"

# Run states.
RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"

# Price per compute unit, per GB moved and per worker minute.
DBU_RATE = "0.15"
STORAGE_RATE_PER_GB = "0.02"
WORKER_MINUTE_RATE = "0.01"


# ---- append-only run events ---------------------------------------------------------


# What a start record may be told, and what it says otherwise.
START_LABELS = {
    "activity_name": None, "run_id": None, "source_path": None, "notebook_path": None,
    "triggered_by": "system", "environment": "dev",
}
# What only the end of a run knows.
LATER = {
    "execution_end_time": "timestamp_ntz", "execution_duration_seconds": "long", "error_message": "string",
    "error_stack_trace": "string", "input_file_count": "long", "input_row_count": "long", "output_row_count": "long",
    "input_size_mb": "double", "output_size_mb": "double", "rows_failed_validation": "long", "cluster_id": "string",
    "worker_count": "int", "node_type": "string", "dbu_consumed": "double", "target_path": "string",
    "data_quality_score": "double", "completeness_check_status": "string",
}


def start_events(runs: DataFrame) -> DataFrame:
    """Log rows written when a run starts."""
    return runs.select(
        "execution_id", "pipeline_name", "pod_id", "company", "domain", "stage",
        F.col("execution_start_time").alias("event_time"),
        F.lit("START").alias("event"),
        F.lit(RUNNING).alias("status"),
        F.col("custom_dimensions").alias("dimensions"),
        F.date_format("execution_start_time", "yyyy-MM-dd").alias("execution_date"),
        *[F.col(c) if c in runs.columns else F.lit(None).cast("string").alias(c) for c in START_LABELS],
    )


def start_records(runs: DataFrame) -> DataFrame:
    """The full log row of a run that has just started, later columns still null."""
    labels = [F.coalesce(c, F.lit(v)).alias(c) if v else F.col(c) for c, v in START_LABELS.items()]
    return start_events(runs).select(
        "execution_id", "pipeline_name", "pod_id", "company", "domain", "stage", *labels,
        F.col("event_time").alias("execution_start_time"), "status",
        F.lit(0).alias("retry_count"),
        *[F.lit(None).cast(t).alias(c) for c, t in LATER.items()],
        F.col("dimensions").alias("custom_dimensions"),
        F.lit(LOG_VERSION).alias("log_version"), "execution_date",
    )


def end_events(runs: DataFrame) -> DataFrame:
    """Log rows written when a run ends well."""
    return runs.where(F.col("status") == SUCCESS).select(
        "execution_id",
        F.col("execution_end_time").alias("event_time"),
        F.lit("END").alias("event"),
        F.lit(SUCCESS).alias("status"),
        "input_row_count", "output_row_count", "rows_failed_validation", "data_quality_score",
        F.create_map(F.lit("rows"), F.col("output_row_count").cast("string")).alias("dimensions"),
    )


def error_events(runs: DataFrame) -> DataFrame:
    """Log rows written when a run fails."""
    return runs.where(F.col("status") == FAILED).select(
        "execution_id",
        F.col("execution_end_time").alias("event_time"),
        F.lit("ERROR").alias("event"),
        F.lit(FAILED).alias("status"),
        "error_message", "retry_count",
        F.create_map().cast("map<string,string>").alias("dimensions"),
    )


def activity_events(activities: DataFrame) -> DataFrame:
    """START and END log rows of every activity, carrying its run's id."""
    ended_at = dates.add_seconds("start_time", "duration_seconds")
    no_rows = F.lit(None).cast("long")
    rows = F.array(
        F.struct(
            F.lit("START").alias("event"), F.col("start_time").alias("event_time"), F.lit(RUNNING).alias("status"),
            no_rows.alias("rows_read"), no_rows.alias("rows_written"),
        ),
        F.struct(F.lit("END").alias("event"), ended_at.alias("event_time"), "status", "rows_read", "rows_written"),
    )
    return activities.select("activity_id", "execution_id", "activity_name", F.inline(rows))


def close_activities(events: DataFrame) -> DataFrame:
    """Activity events folded to one row per activity; without an END it is still running."""

    def at(event: str) -> Column:
        return F.max(F.when(F.col("event") == event, F.col("event_time")))

    ended = F.col("event") == "END"
    folded = events.groupBy("activity_id", "execution_id", "activity_name").agg(
        at("START").alias("started_at"),
        at("END").alias("ended_at"),
        F.max(F.when(ended, F.col("status"))).alias("_status"),
        F.max("rows_read").alias("rows_read"),
        F.max("rows_written").alias("rows_written"),
    )
    return folded.select(
        "activity_id", "execution_id", "activity_name", "started_at", "ended_at",
        F.coalesce("_status", F.lit(RUNNING)).alias("status"),
        dates.seconds_between("started_at", "ended_at").alias("duration_seconds"),
        "rows_read", "rows_written",
    )


def close_runs(starts: DataFrame, *finishing: DataFrame) -> DataFrame:
    """Start events joined with the run's last end or error event.

    An end or error without a start becomes a row with 'Unknown' labels; the dimensions
    of both events are merged, the later value winning.  Of several finishing events
    the latest counts, at the same moment an error.
    """
    ends = finishing[0]
    for more in finishing[1:]:
        ends = ends.unionByName(more, allowMissingColumns=True)
    values = F.struct(*[c for c in ends.columns if c != "execution_id"])
    last = F.max_by(values, F.struct("event_time", F.col("status") == FAILED))
    ends = ends.groupBy("execution_id").agg(last.alias("_last")).select("execution_id", "_last.*")
    ended = ends.select(
        F.col("execution_id").alias("_id"),
        F.col("event_time").alias("execution_end_time"),
        F.col("status").alias("_status"),
        F.col("dimensions").alias("_dims"),
        *[c for c in ends.columns if c not in ("execution_id", "event_time", "event", "status", "dimensions")],
    )
    joined = starts.join(ended, F.col("execution_id") == F.col("_id"), "full_outer")
    no_dims = F.create_map().cast("map<string,string>")
    labels = ["pipeline_name", "pod_id", "company", "stage"]
    extra = [c for c in ended.columns if c not in ("_id", "_status", "_dims", "execution_end_time")]
    return joined.select(
        F.coalesce("execution_id", "_id").alias("execution_id"),
        *[F.coalesce(c, F.lit(UNKNOWN)).alias(c) for c in labels],
        F.coalesce("event_time", "execution_end_time").alias("execution_start_time"),
        "execution_end_time",
        F.coalesce(dates.seconds_between("event_time", "execution_end_time"), F.lit(0)).alias("duration_seconds"),
        F.coalesce("_status", "status").alias("status"),
        nested.merge_maps(F.coalesce("dimensions", no_dims), F.coalesce("_dims", no_dims)).alias("custom_dimensions"),
        *extra,
    )


# ---- run reports -----------------------------------------------------------------------


def since(days: int, as_of: str, column: str = "execution_date") -> Column:
    return F.col(column).cast("date") >= F.date_sub(dates.day(as_of), days)


def recent_runs(log: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    return log.where(since(days, as_of)).orderBy(F.col("execution_start_time").desc(), "execution_id").select(
        "execution_id", "pipeline_name", "pod_id", "company", "domain", "stage", "status",
        "execution_duration_seconds", "data_quality_score", "execution_start_time",
    )


def failed_runs(log: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    failed = log.where((F.col("status") == FAILED) & since(days, as_of))
    return failed.orderBy(F.col("execution_start_time").desc(), "execution_id").select(
        "execution_id", "pod_id", "company", "stage", "error_message", "retry_count"
    )


def stage_performance(log: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    done = log.where((F.col("status") == SUCCESS) & since(days, as_of))
    return done.groupBy("stage", "pod_id").agg(
        F.count("*").alias("execution_count"),
        F.avg("execution_duration_seconds").alias("avg_duration"),
        F.avg("data_quality_score").alias("avg_quality"),
    )


def cost_by_owner(log: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    return log.where(since(days, as_of)).groupBy(nested.map_get("custom_dimensions", "owner").alias("owner")).agg(
        F.sum("dbu_consumed").cast("decimal(20,3)").alias("total_dbu"),
        F.count("*").alias("execution_count"),
        (F.sum("execution_duration_seconds") / F.lit(3600.0)).alias("total_hours"),
    )


def with_dimensions(log: DataFrame, **wanted: str) -> DataFrame:
    """Runs whose custom dimensions carry all the given values."""
    return log.where(text.all_of([nested.map_get("custom_dimensions", k) == v for k, v in wanted.items()]))


def average(c: str, truncate: bool = False) -> Column:
    """Mean of whole numbers; ``truncate`` cuts it to a whole number."""
    mean = F.avg(c)
    return F.floor(mean).cast("long") if truncate else mean


def performance_by(log: DataFrame, key: str, duration: str, truncate: bool = False) -> DataFrame:
    """Finished runs, successes, failures, durations and records per key."""
    return log.where(F.col("status").isin(SUCCESS, FAILED)).groupBy(key).agg(
        F.count("*").alias("total_executions"),
        F.count_if(F.col("status") == SUCCESS).alias("successful_executions"),
        F.count_if(F.col("status") == FAILED).alias("failed_executions"),
        average(duration, truncate).alias("avg_duration_seconds"),
        F.min(duration).alias("min_duration_seconds"),
        F.max(duration).alias("max_duration_seconds"),
        F.sum("output_row_count").alias("total_records_processed"),
    )


def activity_performance(activities: DataFrame, truncate: bool = False) -> DataFrame:
    """Finished activities, successes, failures, mean duration and rows per activity."""
    return activities.where(F.col("status").isin(SUCCESS, FAILED)).groupBy("activity_name", "activity_type").agg(
        F.count("*").alias("total_executions"),
        F.count_if(F.col("status") == SUCCESS).alias("successful_executions"),
        F.count_if(F.col("status") == FAILED).alias("failed_executions"),
        average("duration_seconds", truncate).alias("avg_duration_seconds"),
        F.sum("rows_read").alias("total_rows_read"),
        F.sum("rows_written").alias("total_rows_written"),
    )


def running_now(log: DataFrame, as_of: str) -> DataFrame:
    return log.where(F.col("status") == RUNNING).select(
        "execution_id", "pipeline_name", "company", "execution_start_time",
        dates.seconds_between("execution_start_time", dates.moment(as_of)).alias("running_seconds"),
    )


def failed_with_activity(log: DataFrame, activities: DataFrame) -> DataFrame:
    """Failed runs with their failed activities; runs without one stay."""
    bad = activities.where(F.col("status") == FAILED).select(
        F.col("execution_id").alias("_eid"), "activity_name", "activity_type", F.col("message").alias("activity_message")
    )
    return (
        log.where(F.col("status") == FAILED)
        .join(bad, F.col("execution_id") == F.col("_eid"), "left")
        .select("execution_id", "pipeline_name", "error_message", "activity_name", "activity_type", "activity_message")
    )


def activity_details(log: DataFrame, activities: DataFrame, process: str) -> DataFrame:
    steps = activities.select(
        "execution_id", "activity_name", "activity_type", F.col("status").alias("activity_status"),
        F.col("duration_seconds").alias("activity_seconds"), "rows_read", "rows_written",
    )
    return log.where(F.col("pipeline_name") == process).select("execution_id", "status").join(steps, "execution_id")


def latest_runs_of(log: DataFrame, process: str, n: int) -> DataFrame:
    newest = [F.col("execution_start_time").desc(), F.col("execution_id")]
    return log.where(F.col("pipeline_name") == process).orderBy(*newest).limit(n).select(
        "execution_id", "status", "execution_start_time", "execution_duration_seconds"
    )


def dashboard(log: DataFrame, as_of: str) -> DataFrame:
    """Headline figures of all runs in one pass."""
    day_ago = dates.hours_before(as_of, 24)
    finished = F.count_if(F.col("status") != RUNNING)
    return log.agg(
        F.count("*").alias("files_processed"),
        F.count_if(F.col("status") == RUNNING).alias("running"),
        money.percent(F.count_if(F.col("status") == SUCCESS), finished).alias("success_rate_pct"),
        F.avg("execution_duration_seconds").alias("mean_seconds"),
        F.count_if((F.col("status") == FAILED) & (F.col("execution_start_time") > day_ago)).alias("errors_last_24h"),
    )


def rows_per_sheet(loads: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Processed and failed rows per load unit."""
    return loads.groupBy(*keys).agg(
        F.count("*").alias("rows_processed"), F.count_if(~F.col("loaded")).alias("rows_failed")
    )


# ---- diagnostic log searches ----------------------------------------------------------------


def diagnostics(activities: DataFrame, prop: str, at_least: int) -> DataFrame:
    """Rows whose JSON property reaches a value, newest first."""
    value = nested.json_prop("props", prop).try_cast("int")
    return activities.withColumn(prop, value).where(F.col(prop) >= at_least).orderBy(
        F.col("ts").desc(), "activity_id"
    ).select("activity_id", "ts", "resource", prop, "event_type")


def failures_of_pod(log: DataFrame, pod: str) -> DataFrame:
    return log.where((F.col("status") == FAILED) & (F.col("pod_id") == pod)).select(
        "execution_id", "execution_start_time", "domain", "error_message"
    )


def failure_bursts(activities: DataFrame, at_least: int = 1) -> DataFrame:
    """Five-minute buckets with at least ``at_least`` failures."""
    bucket = dates.five_minute_bucket("ts").alias("bucket_start")
    counts = activities.groupBy(bucket).agg(F.count_if(F.col("status") == FAILED).alias("failure_count"))
    return counts.where(F.col("failure_count") >= at_least)


def hourly_outcomes(log: DataFrame) -> DataFrame:
    """Runs, successes and failures per hour."""
    return log.groupBy(dates.hour_bucket("execution_start_time").alias("hour_start")).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == SUCCESS).alias("succeeded"),
        F.count_if(F.col("status") == FAILED).alias("failed"),
    )


def events_by_resource(activities: DataFrame, as_of: str, hours: int = 24) -> DataFrame:
    recent = F.col("ts") > dates.hours_before(as_of, hours)
    return activities.groupBy("resource").agg(
        F.count("*").alias("event_count"),
        F.count_if((F.col("event_type") == "error") & recent).alias("recent_errors"),
    )


def newest_since(activities: DataFrame, as_of: str, hours: int) -> DataFrame:
    recent = activities.where(F.col("ts") > dates.hours_before(as_of, hours))
    return recent.orderBy(F.col("ts").desc(), "activity_id").select("activity_id", "ts", "resource", "event_type")


def search_activity(activities: DataFrame, name_prefix: str, keyword: str) -> DataFrame:
    hit = text.starts_with_ci("activity_name", name_prefix) & text.contains_ci("message", keyword)
    return activities.where(hit).select("activity_id", "activity_name", "message")


def keyword_search(activities: DataFrame, keyword: str, n: int) -> DataFrame:
    hits = activities.where(text.contains_ci("message", keyword))
    return hits.orderBy(F.col("ts").desc(), "activity_id").limit(n).select("activity_id", "ts", "message")


def error_records(activities: DataFrame) -> DataFrame:
    """Error-log rows with a level, derived from failed or suspicious activities."""
    level = F.when(F.col("status") == FAILED, F.lit("ERROR")).when(F.col("rows_written") < F.col("rows_read"), F.lit("WARNING"))
    return activities.withColumn("error_level", level).where("error_level IS NOT NULL").select(
        "activity_id", "execution_id", "error_level", "message", F.col("start_time").alias("logged_at")
    )


# ---- lineage -----------------------------------------------------------------------------------

# Layers in flow order.
LAYERS = ("bronze", "silver", "gold")


def lineage_steps(runs: DataFrame) -> DataFrame:
    """One step event per layer a run has reached."""
    reached = {"bronze": F.lit(True), "silver": F.col("status") != RUNNING, "gold": F.col("status") == SUCCESS}
    at = {
        "bronze": F.col("file_arrival_time"),
        "silver": F.col("execution_start_time"),
        "gold": F.col("execution_end_time"),
    }
    rows = {"bronze": "input_row_count", "silver": "output_row_count", "gold": "output_row_count"}
    steps = F.array_compact(
        F.array(
            *[
                F.when(
                    reached[layer],
                    F.struct(
                        F.lit(layer).alias("layer"),
                        F.concat_ws("/", F.lit(layer), "pod_id", "company", "domain").alias("path"),
                        at[layer].alias("step_time"),
                        F.col(rows[layer]).alias("records"),
                    ),
                )
                for layer in LAYERS
            ]
        )
    )
    return runs.select(
        "execution_id", F.concat("domain", F.lit("_"), "company", F.lit(".csv")).alias("source_file_name"), F.inline(steps)
    )


def fold_lineage(steps: DataFrame) -> DataFrame:
    """Latest step per layer as columns; the gold step completes the lineage."""
    aggs = []
    for layer in LAYERS:
        here = F.when(F.col("layer") == layer, F.struct("step_time", "path", "records"))
        aggs.append(F.max(here).alias(f"_{layer}"))
    wide = steps.groupBy("execution_id", "source_file_name").agg(F.min("step_time").alias("started"), *aggs)
    cols = []
    for layer in LAYERS:
        cols += [
            F.col(f"_{layer}.path").alias(f"{layer}_path"),
            F.col(f"_{layer}.step_time").alias(f"{layer}_timestamp"),
            F.col(f"_{layer}.records").alias(f"records_in_{layer}"),
        ]
    rejected = F.col("_bronze.records") - F.col("_silver.records")
    return wide.select(
        "execution_id",
        "source_file_name",
        *cols,
        rejected.alias("records_rejected"),
        dates.seconds_between("started", F.col("_gold.step_time")).alias("total_processing_seconds"),
        F.when(F.col("_gold").isNotNull(), F.lit("COMPLETED")).otherwise(F.lit("IN_PROGRESS")).alias("lineage_status"),
    )


def lineage_of_file(lineage: DataFrame, file_name: str) -> DataFrame:
    done = lineage.where((F.col("source_file_name") == file_name) & (F.col("lineage_status") == "COMPLETED"))
    return done.select(
        "source_file_name", "bronze_path", "silver_path", "gold_path",
        "records_in_bronze", "records_in_silver", "records_in_gold",
    )


def lineage_reconciliation(log: DataFrame) -> DataFrame:
    """Whether rows in equal rows out plus rows rejected, per stage."""
    balanced = F.col("input_row_count") == F.col("output_row_count") + F.col("rows_failed_validation")
    return log.groupBy("stage").agg(
        F.count("*").alias("runs"),
        F.sum("input_row_count").alias("records_in"),
        F.sum("output_row_count").alias("records_out"),
        F.sum("rows_failed_validation").alias("records_rejected"),
        F.count_if(~balanced).alias("unbalanced_runs"),
    )


# ---- SLA and cost --------------------------------------------------------------------------------


def with_config(log: DataFrame, config: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All runs, with attributes of their company's configuration.

    Runs of companies without configuration have ``configured`` false, 'UNASSIGNED' in
    text attributes and null in others.  The configuration grows with the tenants; no
    broadcast is forced.
    """
    kinds = dict(config.select(*columns).dtypes)
    c = config.select(
        F.col("pod_id").alias("_pod"), F.col("company").alias("_company"), F.lit(True).alias("_known"), *columns
    )
    joined = log.join(c, (F.col("pod_id") == F.col("_pod")) & (F.col("company") == F.col("_company")), "left")
    known = F.col("_known").isNotNull()
    texts = {n: F.when(known, F.col(n)).otherwise(UNASSIGNED) for n, t in kinds.items() if t == "string"}
    return joined.withColumns({"configured": known, **texts}).drop("_pod", "_company", "_known")


def sla_evaluation(log: DataFrame, config: DataFrame) -> DataFrame:
    """Elapsed time from file arrival to end, against the company's SLA.

    Runs that are still open, or whose company has no SLA, are neither met nor missed.
    """
    runs = with_config(log, config, ["sla_hours", F.col("priority").alias("priority")])
    elapsed = dates.seconds_between("file_arrival_time", "execution_end_time")
    allowed = F.col("sla_hours") * 3600
    late_minutes = F.ceil((elapsed - allowed) / 60).cast("long")
    return runs.select(
        "execution_id", "pod_id", "company", "domain", "sla_hours", "priority",
        (elapsed / F.lit(3600.0)).alias("total_elapsed_hours"),
        (elapsed <= allowed).alias("sla_met"),
        F.when((elapsed - allowed).isNotNull(), F.greatest(late_minutes, F.lit(0))).alias("sla_breach_minutes"),
        F.col("execution_date").alias("sla_date"),
    )


def sla_compliance(sla: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Ended runs, those within their SLA and those without an SLA; the share is of runs with one."""
    ended = sla.where(since(days, as_of, "sla_date") & F.col("total_elapsed_hours").isNotNull())
    return ended.groupBy("company", "priority", "sla_hours").agg(
        F.count("*").alias("total_runs"),
        F.count_if(F.col("sla_met")).alias("sla_met_count"),
        F.count_if(F.col("sla_met").isNull()).alias("without_sla"),
        money.percent(F.count_if(F.col("sla_met")), F.count("sla_met")).alias("sla_compliance_pct"),
    )


def cost_records(log: DataFrame, config: DataFrame) -> DataFrame:
    """Compute, storage and total cost per run, charged to the company's cost center."""
    runs = with_config(log, config, ["cost_center", "business_unit"])
    compute = (F.col("dbu_consumed") * F.lit(DBU_RATE).cast("decimal(4,2)")).cast("decimal(18,5)")
    gb = (F.col("input_row_count") + F.col("output_row_count")).cast("decimal(12,0)") / 1000000
    storage = (gb * F.lit(STORAGE_RATE_PER_GB).cast("decimal(4,2)")).cast("decimal(18,8)")
    total = (compute + storage).cast("decimal(18,8)")
    return runs.select(
        "execution_id", "pod_id", "company", "domain", "dbu_consumed",
        compute.alias("compute_cost_usd"),
        storage.alias("storage_cost_usd"),
        total.alias("total_cost_usd"),
        "cost_center", "business_unit",
        F.try_divide(total.cast("double"), F.col("output_row_count").cast("double")).alias("cost_per_record"),
        F.substring("execution_date", 1, 7).alias("billing_month"),
        F.col("execution_date").alias("cost_date"),
    )


def cost_by(costs: DataFrame, keys: Sequence[str], month: str | None = None) -> DataFrame:
    rows = costs if month is None else costs.where(F.col("billing_month") == month)
    return rows.groupBy(*keys).agg(
        F.sum("total_cost_usd").cast("decimal(28,8)").alias("total_cost"),
        F.sum("dbu_consumed").cast("decimal(20,3)").alias("total_dbu"),
        F.count("*").alias("execution_count"),
    )


def company_cost(log: DataFrame) -> DataFrame:
    """Worker minutes times rate per company; runs still open cost nothing yet."""
    worker_seconds = F.sum(F.col("execution_duration_seconds") * F.col("worker_count"))
    rate = F.lit(WORKER_MINUTE_RATE).cast("decimal(4,2)")
    return log.groupBy("pod_id", "company").agg(
        (F.coalesce(worker_seconds, F.lit(0)) * rate / 60).cast("decimal(20,6)").alias("total_cost")
    )
