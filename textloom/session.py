"""Session helpers: checkpoints in the shared folder and size-checked broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A hinted side may hold at most this many rows and characters; anything
# larger is joined by Spark's own choice (sort-merge with AQE skew handling).
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_CHARS = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables that the driver and all executors see.

    The one ``spark.checkpoint.dir`` names; where it is unset, a folder inside
    the warehouse, which is shared as well. Never a machine-local one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_textloom"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` once to reliable storage and continue from the written rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, ascending: tuple[str, ...] = ()) -> DataFrame:
    """``cut`` for wide rows: compressed columns, of which later steps read what they need.

    Arrays of whole numbers named in ``ascending`` are written as differences.
    """
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/rows-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    for name in ascending:
        writer = writer.option("parquet.writer.version", "PARQUET_2_0").option(f"parquet.enable.dictionary#{name}.list.element", "false")
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Give a small input one partition per core; large inputs already have more.

    Text steps are CPU-bound, so a small file read as one split would leave
    the other cores idle. No job is run to decide.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    have = df._jdf.queryExecution().toRdd().getNumPartitions()
    return df if have >= cores else df.repartition(cores)


def small_enough(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` is proven to fit the broadcast bound.

    At most ``max_rows + 1`` rows are looked at, so the check itself stays
    cheap however large ``df`` is.
    """
    sizes = [
        F.coalesce(F.length(F.col(f.name)), F.lit(0))
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType)
    ] + [
        8 * F.coalesce(F.size(F.col(f.name)), F.lit(0))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.ArrayType, T.MapType))
    ]
    width = sum(sizes, F.lit(8)).cast("long")
    seen = (
        df.limit(max_rows + 1)
        .agg(F.count("*").alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("chars"))
        .first()
    )
    return seen["rows"] <= max_rows and seen["chars"] <= BROADCAST_MAX_CHARS


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    return F.broadcast(df) if small_enough(df, max_rows) else df
