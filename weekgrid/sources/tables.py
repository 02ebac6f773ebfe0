"""Readers and writers for files and tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

DEFAULT_FORMAT = "parquet"


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    null_text: str | None = None,
) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, which
    costs a second pass over the files: give the schema for large input."""
    reader = spark.read.option("header", True)
    if null_text is not None:
        reader = reader.option("nullValue", null_text)
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per partition (no funnel through one task)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    return spark.read.format(fmt).load(path)


def write_table(
    df: DataFrame,
    path: str,
    partition_by: list[str] | None = None,
    fmt: str = DEFAULT_FORMAT,
    rows_per_file: int | None = None,
    order_by: list[str] | None = None,
) -> None:
    """Overwrite a table, optionally in one directory per partition value.

    Rows are rebalanced by partition value: small values are gathered into few
    files, and one that holds a third of all rows is split over many tasks.
    ``order_by`` sorts the whole table by sampled ranges on its way out.
    """
    if order_by:
        df = df.orderBy(*order_by)
    elif partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.format(fmt).mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_sql(spark: SparkSession, path: str, columns: str = "*", fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """A stored table queried by path from SQL."""
    return spark.sql(f"SELECT {columns} FROM {fmt}.`{path}`")


def create_table(df: DataFrame, name: str, path: str | None = None, replace: bool = True, fmt: str = DEFAULT_FORMAT) -> None:
    """A named table in the catalog with the rows of ``df``, for every session that
    shares the catalog. ``replace`` overwrites one that exists; otherwise it stays as
    it is and ``df`` is not run. ``path`` makes an external table there."""
    if not replace and df.sparkSession.catalog.tableExists(name):
        return
    writer = df.write.format(fmt).mode("overwrite")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_snapshot(df: DataFrame, path: str, version: int, taken_at: str) -> None:
    """Store one version of a table under ``path/snapshot=n``, with its time.

    The directory is replaced as a whole, so a retried write cannot leave two
    copies of a version.
    """
    timed = df.withColumn("taken_at", F.lit(taken_at))
    timed.write.mode("overwrite").partitionBy("taken_at").parquet(f"{path}/snapshot={version}")


def read_snapshot(
    spark: SparkSession,
    path: str,
    version: int | None = None,
    as_of: str | None = None,
    fmt: str = DEFAULT_FORMAT,
) -> DataFrame:
    """One version of a table: by number, by time, or the newest. A table format
    with its own time travel is asked for it, otherwise snapshot directories are
    pruned by partition."""
    if fmt == "delta":
        reader = spark.read.format("delta")
        if version is not None:
            reader = reader.option("versionAsOf", version)
        elif as_of is not None:
            reader = reader.option("timestampAsOf", as_of)
        return reader.load(path)
    every = spark.read.parquet(path)
    wanted: Column | int
    if version is not None:
        wanted = version
    else:
        known = every.select("snapshot", "taken_at").distinct()
        if as_of is not None:
            known = known.where(F.col("taken_at").cast("timestamp") <= F.lit(as_of).cast("timestamp"))
        wanted = known.agg(F.max("snapshot")).scalar()
    return every.where(F.col("snapshot") == wanted).drop("snapshot", "taken_at")
