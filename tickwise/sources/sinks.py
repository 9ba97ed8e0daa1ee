"""Sinks: mart tables, the audit log as a plain table, staged intermediates.

* A mart goes to a folder of its own, range-partitioned by its order so that file statistics
  prune a selection and the presentation order costs nothing more.
* The audit table is append-only and is created on first use with the fixed
  15-column schema (create-if-absent, never dropped).  Ingestion runs commit
  their audit rows together with the data, see ``tickwise.sources.warehouse``.
* Intermediate results are staged under the shared ``spark.checkpoint.dir``,
  never in a machine-local folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwise.session import checkpoint_dir
from tickwise.sources.tables import PIPELINE_LOG_SCHEMA


# Codec of what is written to be read again: smaller than Spark's default at little more time.
CODEC = "zstd"


def read_if_present(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """A table with its fixed schema, or None where the path does not exist.

    Only that one condition means "absent": any other failure is raised.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _file_context(spark: SparkSession, path: str):
    """The file system's own view of ``path``: (context, path), on the driver."""
    fs = spark._jvm.org.apache.hadoop.fs
    where = fs.Path(path)
    where = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where)
    return fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration()), where


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where it does not exist."""
    context, where = _file_context(spark, path)
    if not context.util().exists(where):
        return []
    return [entry.getPath().getName() for entry in context.util().listStatus(where)]


def exists(spark: SparkSession, path: str) -> bool:
    context, where = _file_context(spark, path)
    return context.util().exists(where)


def rename_if_absent(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder; False where the target exists.  One step on HDFS and local disks, so of
    two runs that rename to one name one succeeds."""
    context, there = _file_context(spark, target)
    _, here = _file_context(spark, source)
    context.mkdir(there.getParent(), None, True)
    options = spark._sc._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(here, there, options)
    except Py4JJavaError as exc:
        if context.util().exists(there):
            return False
        raise exc
    return True


def stage(spark: SparkSession, df: DataFrame, name: str, run_key: str | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back (cuts lineage).

    A lost executor then costs a re-read of the staged files, not a recompute
    of the whole upstream plan.
    """
    key = run_key or uuid.uuid4().hex
    path = f"{checkpoint_dir(spark).rstrip('/')}/tickwise/{key}/{name}"
    df.write.mode("overwrite").parquet(path, compression=CODEC)
    return spark.read.schema(df.schema).parquet(path)


def clear_run(spark: SparkSession, run_key: str) -> bool:
    """Delete what ``stage`` wrote under a run's key, once nothing reads it any more; whether
    there was something."""
    fs = spark._jvm.org.apache.hadoop.fs
    where = fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/tickwise/{run_key}")
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def write_mart(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """A mart in a new folder, range-partitioned and sorted by ``order``: files hold
    ranges of the first column, so their statistics prune a selection, and a long range is cut
    by the columns after it."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path, compression=CODEC)


def table_location(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/tickwise/tables/{name}"


def write_bucketed(spark: SparkSession, df: DataFrame, name: str, keys: Sequence[str],
                   buckets: int | None = None) -> DataFrame:
    """A keyed snapshot as a table bucketed and sorted by its key, so that a merge on the key
    moves the batch only.  As many buckets as the session shuffles to: with fewer, Spark would
    move both sides to have enough tasks."""
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(n, *keys).write.bucketBy(n, *keys).sortBy(*keys).option("path", table_location(spark, name)) \
        .format("parquet").saveAsTable(name)
    return spark.table(name)


class WrongColumns(ValueError):
    """Rows that do not have a table's columns."""


def create_audit_table(spark: SparkSession, name: str) -> None:
    """S12 by name: the audit table in the session's catalog, if it is absent; never dropped."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PIPELINE_LOG_SCHEMA.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS IDENTIFIER(:name) ({columns}) USING parquet "
              f"LOCATION '{table_location(spark, name)}'", args={"name": name})


def append_audit_rows(spark: SparkSession, rows: DataFrame, name: str) -> None:
    """S11 by name: append rows that have the table's columns, in any order, cast to its types."""
    table = spark.table(name)
    if sorted(rows.columns) != sorted(table.columns):
        raise WrongColumns(f"{name} has {table.columns}, not {rows.columns}")
    rows.select(*[F.col(f.name).cast(f.dataType) for f in table.schema.fields]).write.insertInto(name)


def typed_log(rows: DataFrame) -> DataFrame:
    """Audit rows in the fixed column order and types."""
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in PIPELINE_LOG_SCHEMA.fields])


def ensure_audit_table(spark: SparkSession, path: str) -> None:
    """Create the audit table if absent (an empty, typed Parquet folder)."""
    if read_if_present(spark, path, PIPELINE_LOG_SCHEMA) is None:
        spark.createDataFrame([], PIPELINE_LOG_SCHEMA).write.mode("ignore").parquet(path)


def append_pipeline_log(spark: SparkSession, rows: DataFrame, path: str) -> None:
    """Append audit rows in the fixed column order and types."""
    ensure_audit_table(spark, path)
    typed_log(rows).write.mode("append").parquet(path)


def read_pipeline_logs(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.schema(PIPELINE_LOG_SCHEMA).parquet(*paths)
