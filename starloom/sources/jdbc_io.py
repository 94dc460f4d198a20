"""SQL-database sources and sinks (SRC5, SNK4, SNK5).

Executors open their own connections; nothing passes through the driver.
Connection properties (user, password, driver class) are parameters and must
never be written into code.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.materialize import materialize

_BATCH = re.compile(r"[A-Za-z0-9_.:-]+")


def read_columns(spark: SparkSession, url: str, table: str, columns: list[str],
                 properties: dict[str, str] | None = None, connections: int = 1) -> DataFrame:
    """Columns of a database table (the projection is pruned into the remote
    query).  With several ``connections`` the rows are read in that many ranges
    of the first column, which must then be an integer; its bounds are asked of
    the database first."""
    props = properties or {}
    if connections > 1:
        bounds = spark.read.jdbc(url, f"(SELECT MIN({columns[0]}) AS lo, MAX({columns[0]}) AS hi FROM {table}) bounds",
                                 properties=props).first()
        if bounds is not None and bounds[0] is not None and bounds[0] < bounds[1]:
            return spark.read.jdbc(url, table, column=columns[0], lowerBound=bounds[0], upperBound=bounds[1] + 1,
                                   numPartitions=connections, properties=props).select(*columns)
    return spark.read.jdbc(url, table, properties=props).select(*columns)


def read_key_column(spark: SparkSession, url: str, table: str, key: str,
                    properties: dict[str, str] | None = None, connections: int = 1) -> DataFrame:
    """SRC5: the key column of a database table."""
    return read_columns(spark, url, table, [key], properties, connections)


def append_rows(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                num_partitions: int | None = None) -> None:
    """SNK4: INSERT the rows, ``num_partitions`` connections at most."""
    props = dict(properties or {})
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url, table, mode="append", properties=props)


def run_statement(spark: SparkSession, url: str, statement: str, properties: dict[str, str] | None = None) -> None:
    """One SQL statement over a connection of the driver's own (no rows pass)."""
    props = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.createStatement().executeUpdate(statement)
    finally:
        connection.close()


def append_batch(df: DataFrame, url: str, table: str, batch: str, properties: dict[str, str] | None = None,
                 num_partitions: int | None = None, staging: str | None = None, ledger: str = "append_ledger",
                 statements=None) -> bool:
    """SNK4 that may be repeated: INSERT the rows of a batch once, whatever is retried.

    The rows are written to the shared folder first and numbered there, so that a
    task that runs again inserts the same row numbers into the staging table.  One
    transaction then names the batch in the ledger (batch, target; primary key), moves
    the distinct rows of this attempt on and empties the batch's staging rows, those of
    attempts that died among them; a batch that is in the ledger adds nothing.
    ``staging`` (default ``<table>_staging``) has the target's columns and ``batch_id``,
    ``attempt_id``, ``batch_row``.  ``batch`` becomes part of SQL
    text and is checked.  Returns whether rows were added."""
    if not _BATCH.fullmatch(batch):
        raise ValueError("batch: letters, digits, '_', '-', ':' and '.' only")
    spark, staging, statements = df.sparkSession, staging or f"{table}_staging", statements or run_statements
    done = spark.read.jdbc(url, f"(SELECT batch_id FROM {ledger} WHERE batch_id = '{batch}' AND target = '{table}') done", properties=properties or {})
    if done.head(1):
        return False
    held = materialize(df, "append")
    attempt = uuid.uuid4().hex
    numbered = held.df.withColumns({"batch_id": F.lit(batch), "attempt_id": F.lit(attempt), "batch_row": F.monotonically_increasing_id()})
    append_rows(numbered, url, staging, properties, num_partitions)
    names = ", ".join(df.columns)
    statements(spark, url, [
        f"INSERT INTO {ledger} (batch_id, target) VALUES ('{batch}', '{table}')",
        f"INSERT INTO {table} ({names}) SELECT {names} FROM (SELECT DISTINCT batch_row, {names} FROM {staging} WHERE batch_id = '{batch}' AND attempt_id = '{attempt}') fresh",
        f"DELETE FROM {staging} WHERE batch_id = '{batch}'",
    ], properties)
    held.remove()
    return True


def run_statements(spark: SparkSession, url: str, statements: list[str], properties: dict[str, str] | None = None) -> None:
    """SQL statements as one transaction over a connection of the driver's own (no rows pass)."""
    props = spark._jvm.java.util.Properties()
    for k, v in (properties or {}).items():
        props.setProperty(k, v)
    connection = spark._jvm.java.sql.DriverManager.getConnection(url, props)
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().executeUpdate(statement)
        connection.commit()
    finally:
        connection.close()


def refresh_rows(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None,
                 num_partitions: int | None = None, clear: str = "truncate") -> None:
    """SNK5: full refresh; the table keeps its definition, its rows are replaced.

    ``clear="truncate"`` is quick, but some databases (SQL Server among them)
    refuse to truncate a table that a foreign key points at, even an empty one;
    ``clear="delete"`` deletes the rows, as the reference did, and is what such
    parents (authors, genres) need."""
    if clear not in ("truncate", "delete"):
        raise ValueError("clear must be 'truncate' or 'delete'")
    if clear == "delete":
        run_statement(df.sparkSession, url, f"DELETE FROM {table}", properties)
        append_rows(df, url, table, properties, num_partitions)
        return
    props = dict(properties or {})
    props["truncate"] = "true"
    if num_partitions:
        props["numPartitions"] = str(num_partitions)
    df.write.jdbc(url, table, mode="overwrite", properties=props)
