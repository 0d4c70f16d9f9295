"""Query registration and the shared inputs of registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.plans.vocabulary import corpus_vocabulary
from textloom.session import shared_folder, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_shared: dict[tuple[str, str, str], DataFrame] = {}


def plain(df: DataFrame) -> DataFrame:
    """Report types: integers as long, doubles to six digits, arrays as text."""
    columns = []
    for field in df.schema.fields:
        c, kind = F.col(field.name), field.dataType
        if isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType, T.BooleanType)):
            c = c.cast("long")
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            c = F.round(c.cast("double"), 6)
        elif isinstance(kind, T.ArrayType):
            c = F.array_join(c.cast("array<string>"), " ")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name`` with its check SQL."""

    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: plain(fn(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spread(df) if name in ("documents", "pages") else df


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A written intermediate table, built once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _shared:
        _shared[key] = build()
    return _shared[key]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, for files that a query writes and reads."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus vocabulary of ``documents``."""
    return shared(
        spark, sf_dir, "vocabulary", lambda: corpus_vocabulary(table(spark, sf_dir, "documents"))
    )
