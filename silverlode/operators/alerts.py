"""Alert rules, cooldown and retry decisions.

Rules and policies may leave pod, company or stage null, meaning "any".  Those
wildcards are resolved by equi-joins on every combination of given and starred
keys of the (distinct) tenants, never by a nested-loop join over the runs.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from silverlode.functions import money, ranking

ANY = "*"

ALERT_RULE = T.StructType(
    [
        T.StructField("alert_rule_id", T.StringType(), False),
        T.StructField("rule_name", T.StringType(), False),
        T.StructField("rule_type", T.StringType(), False),
        T.StructField("pod_id", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("domain", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("threshold_value", T.DoubleType(), False),
        T.StructField("threshold_operator", T.StringType(), False),
        T.StructField("severity", T.StringType(), False),
        T.StructField("notification_channel", T.StringType(), False),
        T.StructField("enabled", T.BooleanType(), False),
        T.StructField("cooldown_minutes", T.IntegerType()),
    ]
)

RETRY_POLICY = T.StructType(
    [
        T.StructField("policy_id", T.StringType(), False),
        T.StructField("pod_id", T.StringType()),
        T.StructField("company", T.StringType()),
        T.StructField("stage", T.StringType(), False),
        T.StructField("max_retry_count", T.IntegerType(), False),
        T.StructField("retry_delay_seconds", T.IntegerType(), False),
        T.StructField("exponential_backoff", T.BooleanType(), False),
        T.StructField("backoff_multiplier", T.DoubleType()),
        T.StructField("retry_on_errors", T.ArrayType(T.StringType())),
        T.StructField("enabled", T.BooleanType(), False),
    ]
)


def active_alerts(rules: DataFrame, alphabetical: bool = False) -> DataFrame:
    """Enabled rules, most severe first, with 'ALL' for wildcards."""
    order = F.col("severity").desc() if alphabetical else ranking.severity_rank("severity").asc()
    return rules.where("enabled").orderBy(order, "rule_type").select(
        "alert_rule_id", "rule_name", "rule_type", "severity", "notification_channel",
        F.coalesce("pod_id", F.lit("ALL")).alias("pod_id"),
        F.coalesce("company", F.lit("ALL")).alias("company"),
    )


def resolve_wildcards(tenants: DataFrame, rules: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rules that apply to each tenant: tenant keys plus the rule's other columns.

    A tenant whose key is null is matched by rules that leave this key open; join the
    result null-safely (``same_keys``).

    Every tenant looks its rules up under each combination of its own key values
    and ``*``.  ``generality`` orders the hits: 0 is fully specific, and a star
    in a later key outweighs stars in all earlier ones.
    """
    options = []
    for starred in itertools.product([False, True], repeat=len(keys)):
        parts = [F.lit(ANY) if s else F.col(k) for k, s in zip(keys, starred, strict=True)]
        generality = sum(2**i for i, s in enumerate(starred) if s)
        options.append(
            F.struct(
                *[p.alias(f"_r_{k}") for p, k in zip(parts, keys, strict=True)], F.lit(generality).alias("generality")
            )
        )
    lookups = tenants.select(*keys).distinct().select(*keys, F.inline(F.array(*options)))
    starred_rules = rules.select(
        *[F.coalesce(k, F.lit(ANY)).alias(f"_r_{k}") for k in keys], *[c for c in rules.columns if c not in keys]
    )
    starred_keys = [f"_r_{k}" for k in keys]
    return lookups.join(starred_rules, starred_keys).drop(*starred_keys)


def same_keys(left: str, right: str, keys: Sequence[str]) -> Column:
    """Null-safe equality of ``keys`` between two aliased frames."""
    return functools.reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


KEYS = ["pod_id", "company", "domain", "stage"]


def metric_values() -> dict[str, Column]:
    """Every metric of a run, null where it has none."""
    return {
        "DURATION": F.col("execution_duration_seconds").cast("double"),
        "QUALITY": F.col("data_quality_score").cast("double"),
        "ERROR_RATE": F.when(F.col("status") == "FAILED", F.lit(100.0)).otherwise(F.lit(0.0)),
        "COST": F.col("dbu_consumed").cast("double"),
        "SLA": F.timestamp_diff("SECOND", F.col("file_arrival_time"), F.col("execution_end_time")).cast("double"),
    }


def breaches(value: Column, operator: Column, threshold: Column) -> Column:
    return (
        F.when(operator == "GREATER_THAN", value > threshold)
        .when(operator == "LESS_THAN", value < threshold)
        .when(operator == "EQUALS", value == threshold)
        .otherwise(F.lit(False))
    )


OPERATORS = ("GREATER_THAN", "LESS_THAN", "EQUALS")
# Rules up to this number, some 100 bytes each, are broadcast; beyond, runs are shuffled to their rules.
MOST_BROADCAST = 20_000
# Copies of the rules that name no key, so that runs meet them on a key that is not hot.
COPIES = 16

RUNG = T.StructType(
    [
        T.StructField("threshold_value", T.DoubleType()),
        T.StructField("alert_rule_id", T.StringType()),
        T.StructField("severity", T.StringType()),
        T.StructField("cooldown_minutes", T.IntegerType()),
    ]
)
Kinds = dict[str, tuple[str, str]]


def threshold_table(active: DataFrame, given: Sequence[str], kinds: Kinds) -> DataFrame:
    """One row per combination of the ``given`` keys, with its rules sorted by threshold.

    Each of ``kinds`` is the name of a column and the metric and operator of its rules.
    """
    rule = F.struct(*RUNG.names)
    ladders = [
        F.sort_array(F.collect_list(F.when((F.col("rule_type") == metric) & (F.col("threshold_operator") == operator), rule))).alias(c)
        for c, (metric, operator) in kinds.items()
    ]
    return active.groupBy(*given).agg(*ladders)


def _small_table(spark: SparkSession, active: list[Row], given: Sequence[str], kinds: Kinds) -> DataFrame:
    """``threshold_table`` of rules that the driver holds."""
    rows: dict[tuple, dict[str, list]] = {}
    names = {kind: c for c, kind in kinds.items()}
    for r in active:
        ladders = rows.setdefault(tuple(r[k] for k in given), {c: [] for c in kinds})
        ladders[names[r.rule_type, r.threshold_operator]].append(tuple(r[c] for c in RUNG.names))
    for ladders in rows.values():
        for ladder in ladders.values():
            ladder.sort(key=lambda rule: (math.isnan(rule[0]), rule[0], rule[1]))
    schema = T.StructType([T.StructField(k, T.StringType()) for k in given] + [T.StructField(c, T.ArrayType(RUNG)) for c in kinds])
    return spark.createDataFrame([(*keys, *ladders.values()) for keys, ladders in rows.items()], schema)


def _below(rules: Column, value: Column, equal: bool) -> Column:
    """Number of the sorted rules whose threshold lies below ``value`` (or at it), by bisection."""

    def halve(at: Column, _: Column) -> Column:
        middle = F.floor((at["low"] + at["high"]) / 2).cast("int")
        threshold = F.get(rules, middle)["threshold_value"]
        under = threshold <= value if equal else threshold < value
        nearer = F.when(
            under, F.struct((middle + 1).alias("low"), at["high"].alias("high"))
        ).otherwise(F.struct(at["low"].alias("low"), middle.alias("high")))
        return F.when(at["low"] < at["high"], nearer).otherwise(at)

    rounds = F.sequence(F.lit(1), F.length(F.bin(F.size(rules))))
    whole = F.struct(F.lit(0).alias("low"), F.size(rules).alias("high"))
    return F.aggregate(rounds, whole, halve, lambda at: at["low"])


def _may_breach(rules: Column, value: Column, operator: str) -> Column:
    """Whether any rule of a ladder fires, by its lowest and its highest threshold."""
    lowest, highest = F.get(rules, F.lit(0))["threshold_value"], F.get(rules, F.size(rules) - 1)["threshold_value"]
    if operator == "GREATER_THAN":
        return value > lowest
    return value < highest if operator == "LESS_THAN" else (value >= lowest) & (value <= highest)


def _breached(rules: Column, value: Column, operator: str) -> Column:
    """The rules of a ladder that fire: up to the value, above it, or those that equal it."""
    first = F.lit(0) if operator == "GREATER_THAN" else _below(rules, value, equal=operator == "LESS_THAN")
    last = F.size(rules) if operator == "LESS_THAN" else _below(rules, value, equal=operator == "EQUALS")
    # A ladder of one rule that may fire does.
    return F.when(F.size(rules) == 1, rules).otherwise(F.slice(rules, first + 1, last - first))


def _hit(metric: str, value: Column, rule: Column) -> Column:
    return F.struct(F.lit(metric).alias("rule_type"), value.alias("metric_value"), rule.alias("rule"))


def evaluate_alerts(log: DataFrame, rules: DataFrame, most_broadcast: int = MOST_BROADCAST) -> DataFrame:
    """One firing per run and applicable rule whose threshold it breaches.

    Rules are compiled once: per combination of the keys they name, metric and operator
    a ladder of thresholds in ascending order.  A run looks its ladders up by one
    equi-join per combination that occurs (16 at most) and searches them by bisection,
    so it stays one row until a rule fires, however many rules there are.  Rules that
    name no key are joined on one of ``COPIES`` numbers.  Keys that a run lacks match
    open rules only.  ``log`` may be a stream.  Up to ``most_broadcast`` rules are
    compiled on the driver and broadcast; more are compiled and joined by shuffles.
    """
    values = metric_values()
    active = rules.where("enabled").where(F.col("rule_type").isin(*values) & F.col("threshold_operator").isin(*OPERATORS)).select(
        "alert_rule_id", *KEYS, "rule_type", "threshold_value", "threshold_operator", "severity", "cooldown_minutes"
    )
    held = active.limit(most_broadcast + 1).collect()
    few = len(held) <= most_broadcast
    # At most 16 combinations of keys, with 15 of metric and operator each.
    kinds: dict[tuple, set[tuple[str, str]]] = {}
    shape = [F.col(k).isNotNull().alias(k) for k in KEYS]
    distinct = active.select(*shape, "rule_type", "threshold_operator").distinct()
    for r in held if few else distinct.collect():
        pattern = tuple(r[k] is not None if few else r[k] for k in KEYS)
        kinds.setdefault(pattern, set()).add((r.rule_type, r.threshold_operator))
    runs = log.select(
        "execution_id", *KEYS, F.col("execution_start_time").alias("fired_at"), *[v.alias(f"_{k}") for k, v in values.items()]
    )
    may, hits = [], []
    for n, pattern in enumerate(sorted(kinds)):
        given = [k for k, is_named in zip(KEYS, pattern, strict=True) if is_named]
        columns = {f"_rules_{n}_{i}": kind for i, kind in enumerate(sorted(kinds[pattern]))}
        if few:
            own = [r for r in held if tuple(r[k] is not None for k in KEYS) == pattern]
            table = _small_table(log.sparkSession, own, given, columns)
        else:
            same = [F.col(k).isNotNull() == F.lit(p) for k, p in zip(KEYS, pattern, strict=True)]
            table = threshold_table(active.where(functools.reduce(lambda a, b: a & b, same)), given, columns)
        if given:
            on = {k: f"_of_{k}" for k in given}
            table = table.withColumnsRenamed(on)
        else:
            on = {"_spread": "_copy"}
            table = table.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
            runs = runs.withColumn("_spread", F.pmod(F.xxhash64("execution_id"), F.lit(COPIES)).cast("int"))
        meet = functools.reduce(lambda a, b: a & b, [F.col(left) == F.col(right) for left, right in on.items()])
        runs = runs.join(F.broadcast(table) if few else table, meet, "left").drop(*on.values())
        for column, (metric, operator) in columns.items():
            ladder, value = F.col(column), F.col(f"_{metric}")
            may.append(F.coalesce(_may_breach(ladder, value, operator), F.lit(False)))
            found = _breached(ladder, value, operator)
            hits.append(F.when(may[-1], F.transform(found, functools.partial(_hit, metric, value))))
    if not hits:
        nothing = f"array<struct<rule_type:string,metric_value:double,rule:{RUNG.simpleString()}>>"
        may, hits = [F.lit(False)], [F.array().cast(nothing)]
    fired = runs.where(functools.reduce(lambda a, b: a | b, may)).select(
        "execution_id", *KEYS, "fired_at", F.explode(F.flatten(F.array_compact(F.array(*hits)))).alias("hit")
    )
    return fired.select(
        "hit.rule.alert_rule_id", "execution_id", *KEYS, "hit.rule_type", "hit.metric_value", "hit.rule.threshold_value",
        "hit.rule.severity", "hit.rule.cooldown_minutes", "fired_at",
    )


# ---- cooldown ---------------------------------------------------------------------------


def firing_minutes(firings: DataFrame) -> DataFrame:
    """(alert_rule_id, cooldown_minutes, minute, firings): alerts go out per minute.

    Reduces any number of firings to at most one row per rule and minute of the
    covered time span, with a map-side combine.
    """
    minute = F.floor(F.unix_seconds(F.col("fired_at").cast("timestamp")) / 60).cast("long")
    return firings.groupBy("alert_rule_id", "cooldown_minutes", minute.alias("minute")).agg(
        F.count("*").alias("firings")
    )


def _suppress(minutes: pd.Series, cooldown: int, last: float | None = None) -> list[bool]:
    """Which of the ascending minutes are sent when each blocks the next ``cooldown``."""
    sent = []
    for m in minutes:
        ok = last is None or m - last >= cooldown
        sent.append(ok)
        if ok:
            last = m
    return sent


def apply_cooldown(minutes: DataFrame, last_sent: DataFrame | None = None) -> DataFrame:
    """``minutes`` plus ``sent``: false within the cooldown of the last alert sent.

    ``last_sent`` (alert_rule_id, last_sent) carries earlier decisions over.  The
    decision is sequential per rule.  A group holds at most one row per minute of
    the time span (about half a million a year), whatever the number of firings,
    so it fits one task.
    """
    if last_sent is None:
        carried = minutes.withColumn("last_sent", F.lit(None).cast("long"))
    else:
        carried = minutes.join(last_sent, "alert_rule_id", "left")

    def per_rule(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values("minute")
        cooldown, last = ordered["cooldown_minutes"].iloc[0], ordered["last_sent"].iloc[0]
        sent = _suppress(
            ordered["minute"], 0 if pd.isna(cooldown) else int(cooldown), None if pd.isna(last) else int(last)
        )
        return ordered.drop(columns="last_sent").assign(sent=sent)

    return carried.select("alert_rule_id", "cooldown_minutes", "minute", "firings", "last_sent").groupBy(
        "alert_rule_id"
    ).applyInPandas(per_rule, "alert_rule_id string, cooldown_minutes int, minute long, firings long, sent boolean")


def gap_since_previous(minutes: DataFrame) -> DataFrame:
    """Simple variant: quiet if the previous firing minute of the rule is within the cooldown."""
    previous = F.lag("minute").over(Window.partitionBy("alert_rule_id").orderBy("minute"))
    gap = F.col("minute") - previous
    return minutes.withColumns(
        {"gap_minutes": gap, "sent": gap.isNull() | (gap >= F.coalesce("cooldown_minutes", F.lit(0)))}
    )


# ---- retries --------------------------------------------------------------------------------


def retry_decisions(failures: DataFrame, policies: DataFrame) -> DataFrame:
    """Per failed run: policy, whether to retry, the delay, and whether retries are used up.

    The most specific policy wins: a named company before a named pod before none.
    """
    keys = ["pod_id", "company"]
    active = policies.where("enabled").drop("enabled").withColumnRenamed("stage", "_stage")
    applicable = resolve_wildcards(failures, active.select(*keys, "policy_id", "_stage"), keys)
    # One policy per tenant and stage: the least general, then the lowest id.
    best = applicable.groupBy(*keys, "_stage").agg(
        F.min(F.struct("generality", "policy_id")).getField("policy_id").alias("_best")
    )
    detail = active.select(
        F.col("policy_id").alias("_best"), F.col("max_retry_count").alias("_max"), "retry_delay_seconds",
        "exponential_backoff", "backoff_multiplier", "retry_on_errors",
    )
    chosen = best.join(detail, "_best")
    joined = failures.join(
        chosen.withColumnsRenamed({"pod_id": "_pod", "company": "_company"}),
        F.col("pod_id").eqNullSafe(F.col("_pod"))
        & F.col("company").eqNullSafe(F.col("_company"))
        & (F.col("stage") == F.col("_stage")),
        "left",
    )
    retryable = F.coalesce(F.array_contains("retry_on_errors", F.col("error_type")), F.lit(False))
    exhausted = F.coalesce(F.col("retry_count") >= F.col("_max"), F.lit(False))
    will_retry = F.col("_best").isNotNull() & retryable & ~exhausted
    delay = money.backoff_seconds("retry_delay_seconds", "exponential_backoff", "backoff_multiplier", "retry_count")
    return joined.select(
        "execution_id", "pod_id", "company", "stage", "error_type", "retry_count",
        F.col("_best").alias("policy_id"),
        retryable.alias("retryable"),
        exhausted.alias("exhausted"),
        will_retry.alias("will_retry"),
        F.when(will_retry, delay).alias("next_delay_seconds"),
    )
