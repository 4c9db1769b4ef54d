"""Keyed updates of tables expressed as DataFrame joins.

Plain parquet has no MERGE.  Each operator returns the full new content of the
target; ``sources.sinks`` writes it to a new snapshot, never over its own input.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """One row per key: the newest, ties broken by every other column.

    ``row_number() = 1`` is limited map-side before the shuffle, so a hot key
    sends one row per input partition, not all its rows.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.col(c).desc_nulls_last() for c in [*newest_first, *rest]]
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")


def ambiguous_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one source row; an upsert from them is undefined."""
    return source.groupBy(*keys).agg(F.count("*").alias("source_rows")).where("source_rows > 1")


def guarded(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``source``, failing when it is read if a key has several rows.

    Keys are counted map-side and joined by the same shuffle that an upsert needs; no
    group is gathered.
    """
    rest = [c for c in source.columns if c not in keys]
    one = F.any_value(F.struct(*rest)) if rest else F.any_value(F.struct(F.lit(0).alias("_")))
    counted = source.groupBy(*keys).agg(F.count("*").alias("_n"), one.alias("_row"))
    message = F.concat(F.lit("upsert source has several rows for key "), F.to_json(F.struct(*keys)))
    checked = F.when(F.col("_n") > 1, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    # The check is part of the row itself, so that no optimisation drops it.
    rows = counted.withColumn("_row", F.when(checked, F.col("_row")))
    return rows.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*source.columns)


def _side(df: DataFrame, keys: Sequence[str], columns: Sequence[str], tag: str) -> DataFrame:
    """Keys prefixed with ``tag`` and the other columns as one struct ``{tag}row``."""
    return df.select(*[F.col(k).alias(tag + k) for k in keys], F.struct(*columns).alias(f"{tag}row"))


def _full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of two ``_side`` frames on null-safe keys."""
    same = reduce(lambda a, b: a & b, [F.col(f"_t_{k}").eqNullSafe(F.col(f"_s_{k}")) for k in keys])
    return left.join(right, same, "full_outer")


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    newest_first: Sequence[str] | None = None,
) -> DataFrame:
    """Rows of ``target`` updated or extended from ``source`` on null-safe keys.

    ``update_columns`` limits what a match overwrites; by default all columns.
    Several source rows for a key fail the job when it runs; with ``newest_first`` the
    latest of them is taken instead.  The target must hold one row per key.
    """
    if newest_first is not None:
        source = latest_per_key(source, keys, newest_first)
    else:
        source = guarded(source, keys)
    values = [c for c in target.columns if c not in keys]
    updated = set(values if update_columns is None else update_columns)
    joined = _full_outer(_side(target, keys, values, "_t_"), _side(source, keys, values, "_s_"), keys)
    in_t, in_s = F.col("_t_row").isNotNull(), F.col("_s_row").isNotNull()
    cols = {k: F.when(in_t, F.col(f"_t_{k}")).otherwise(F.col(f"_s_{k}")).alias(k) for k in keys}
    for c in values:
        take_source = in_s if c in updated else (in_s & ~in_t)
        cols[c] = F.when(take_source, F.col(f"_s_row.{c}")).otherwise(F.col(f"_t_row.{c}")).alias(c)
    return joined.select(*[cols[c] for c in target.columns])


def update_where(df: DataFrame, condition: Column, changes: dict[str, Column]) -> DataFrame:
    """Set columns where ``condition`` is true; other rows keep their values."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, new).otherwise(F.col(c)) for c, new in changes.items()})


def soft_delete(df: DataFrame, condition: Column) -> DataFrame:
    return update_where(df, condition, {"enabled": F.lit(False)})


def fold_events(events: DataFrame, key: str, order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Latest non-null value of each column per key of an append-only event log.

    Uses ``max`` over ``struct(order..., value)``, so partial results combine
    before the shuffle and no group is ever gathered.
    """
    aggs = [
        F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c)))).getField(c).alias(c) for c in columns
    ]
    return events.groupBy(key).agg(*aggs)


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Row changes between two snapshots as insert / update / delete records."""
    joined = _full_outer(_side(before, keys, columns, "_t_"), _side(after, keys, columns, "_s_"), keys)
    pre, post = F.col("_t_row"), F.col("_s_row")

    def record(kind: str, value: Column) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), value.alias("row"))

    changes = (
        F.when(pre.isNull(), F.array(record("insert", post)))
        .when(post.isNull(), F.array(record("delete", pre)))
        .when(~pre.eqNullSafe(post), F.array(record("update_preimage", pre), record("update_postimage", post)))
    )
    out = joined.select(*[F.coalesce(f"_t_{k}", f"_s_{k}").alias(k) for k in keys], F.explode(changes).alias("_c"))
    return out.select("_c.change_type", *keys, *[F.col(f"_c.row.{c}").alias(c) for c in columns])


def as_of_version(history: DataFrame, keys: Sequence[str], version_column: str, version) -> DataFrame:
    """State of every key at ``version``; deleted keys carry ``is_deleted``."""
    seen = history.where(F.col(version_column) <= F.lit(version))
    return latest_per_key(seen, keys, [version_column]).where(~F.coalesce(F.col("is_deleted"), F.lit(False)))
