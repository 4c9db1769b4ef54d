"""Registration of named queries together with their cross-check SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import oracle
from .frames import Frames

MOMENT_FORMAT = "yyyy-MM-dd HH:mm:ss"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Frames], DataFrame]
    check: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(self.build(Frames(spark, sf_dir)))


QUERIES: dict[str, Query] = {}


def query(name: str, check: str | None = None):
    """Register ``build(frames)`` under ``name``; ``check`` is the equivalent SQL."""

    def add(build):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Query(name, build, oracle.sql(check) if check else None)
        return build

    return add


def portable(df: DataFrame) -> DataFrame:
    """Result types every engine prints alike: text dates, doubles, longs, JSON."""

    def cell(f: T.StructField):
        c, t = F.col(f"`{f.name}`"), f.dataType
        if isinstance(t, T.DecimalType):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = c.cast("string")
        elif isinstance(t, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, MOMENT_FORMAT)
        elif isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        elif isinstance(t, (T.ArrayType, T.MapType, T.StructType)):
            c = F.to_json(c)
        return c.alias(f.name)

    return df.select(*[cell(f) for f in df.schema.fields])
