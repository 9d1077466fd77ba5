"""Materialising datasets: full refresh, append, model save."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

# Conditions that mean "nothing is stored under this name".
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def ensure_schema(spark: SparkSession, schema: str, comment: str | None = None, location: str | None = None) -> None:
    """CREATE SCHEMA IF NOT EXISTS, with an optional comment and storage folder."""
    stmt = f"CREATE SCHEMA IF NOT EXISTS `{schema}`"
    if comment:
        stmt += " COMMENT '" + comment.replace("'", "\\'") + "'"
    if location:
        stmt += f" LOCATION '{location}'"
    spark.sql(stmt)


def _quoted(name: str) -> str:
    return ".".join(f"`{part}`" for part in name.split("."))


def table_path(spark: SparkSession, database: str | None, name: str) -> str | None:
    """Storage folder of dataset ``name`` inside the database's location."""
    if not database:
        return None
    return spark.catalog.getDatabase(database).locationUri.rstrip("/") + "/" + name


def _missing_local(path: str) -> bool:
    """True for a local path that does not exist (other file systems: unknown, False)."""
    if "://" in path and not path.startswith("file:"):
        return False
    local = path[len("file:"):] if path.startswith("file:") else path
    return not os.path.isdir(local)


def attach_tables(spark: SparkSession, database: str, names, location: str | None = None) -> list[str]:
    """Register tables already stored under a database folder.

    Spark's built-in catalog is per-session, so a later session (another CLI
    run, another job) does not know the tables an earlier one wrote. This
    re-attaches each named table found under ``<warehouse>/<database>.db``
    (or ``location``); with a persistent metastore every name is already
    known and nothing happens. Returns the names attached.
    """
    if location is None:
        location = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + f"/{database}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{location}'")
    location = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    known = {t.name for t in spark.catalog.listTables(database) if not t.isTemporary}
    attached = []
    for name in names:
        path = f"{location}/{name}"
        if name in known or _missing_local(path):
            continue
        try:
            spark.sql(f"CREATE TABLE `{database}`.`{name}` USING parquet LOCATION '{path}'")
            if any(c.isPartition for c in spark.catalog.listColumns(f"{database}.{name}")):
                spark.catalog.recoverPartitions(f"{database}.{name}")
            attached.append(name)
        except AnalysisException as error:
            if error.getCondition() not in MISSING:  # e.g. no permission, or files that cannot be read
                raise
    return attached


def use_schema(spark: SparkSession, schema: str) -> None:
    """Make ``schema`` the session's current database (unqualified names resolve there)."""
    spark.catalog.setCurrentDatabase(schema)


def write_table(df: DataFrame, name: str, mode: str = "overwrite", comment: str | None = None,
                partition_by: list[str] | None = None, path: str | None = None,
                bucket_by: tuple[int, str] | None = None) -> None:
    """Write ``df`` as a table (``overwrite`` = full refresh, ``append`` adds rows).

    With ``path`` the table's data lives in that folder, so a later session
    can overwrite or append to it even when its catalog has not seen the
    table before (see ``attach_tables``). ``bucket_by`` (buckets, column) stores
    one file a bucket, so later joins and groupings on the column read it in
    place; a catalog that only re-attached the folder reads it as a plain table.
    """
    if bucket_by:
        df = df.repartition(*bucket_by)
    writer = df.write.mode(mode).format("parquet").option("compression", "zstd")
    if path:
        writer = writer.option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    writer.saveAsTable(name)
    if comment:
        df.sparkSession.sql(f"COMMENT ON TABLE {_quoted(name)} IS '" + comment.replace("'", "\\'") + "'")


def write_run_rows(df: DataFrame, name: str, run_id: str, path: str | None = None) -> None:
    """Add the rows of one run to a table, exactly once.

    The table is partitioned by ``run_id`` and only this run's partition is overwritten: a step that is
    tried again, by Spark or by a job that starts over, replaces its own rows, and rows of other runs stay.
    """
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_quoted(name)} ({columns}, run_id STRING) USING parquet "
              f"PARTITIONED BY (run_id){place}")
    written = [c for c in spark.table(name).columns if c != "run_id"]
    quoted_id = run_id.replace("'", "\\'")
    spark.sql(f"INSERT OVERWRITE TABLE {_quoted(name)} PARTITION (run_id = '{quoted_id}') SELECT * FROM {{rows}}",
              rows=df.select(*written))


def save_model(model, path: str) -> str:
    """Persist a fitted PipelineModel (overwriting) and return its path."""
    model.write().overwrite().save(path)
    return path
