"""Ingest of the operational tables over JDBC."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from cargolake.config import OPERATIONAL_TABLES
from cargolake.sources.tables import publish_table

FETCH_ROWS = 10_000
REPORT = "table string, status string, message string"


def literal(value: object) -> str:
    return str(value) if isinstance(value, (int, Decimal)) else "'" + str(value).replace("'", "''") + "'"


def read_jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    properties: Mapping[str, str],
    key: str = "id",
    rows_per_task: int = 500_000,
) -> DataFrame:
    """One table, read by as many tasks as its rows need, over ranges of its key.

    The database counts the rows and gives the first key of every range, so
    ranges hold equal numbers of rows whatever the gaps between the keys, which
    may be of any type. Rows arrive in portions, since some drivers would
    otherwise hold a whole range in memory.
    """
    options = {"fetchsize": str(FETCH_ROWS), **properties}
    rows = spark.read.jdbc(url, f"(SELECT COUNT(*) AS n FROM {table}) counted", properties=options).first()[0]
    ranges = -(-int(rows) // rows_per_task)
    if ranges < 2:
        df = spark.read.jdbc(url, table, properties=options)
    else:
        parts = f"SELECT {key} AS k, NTILE({ranges}) OVER (ORDER BY {key}) AS part FROM {table} WHERE {key} IS NOT NULL"
        starts = spark.read.jdbc(url, f"(SELECT MIN(k) AS k FROM ({parts}) parts GROUP BY part) starts", properties=options)
        ends = [literal(k) for k in sorted({r[0] for r in starts.collect()})[1:]]  # one per task
        between = [f"{key} >= {a} AND {key} < {b}" for a, b in zip(ends, ends[1:])]
        predicates = [f"{key} < {ends[0]} OR {key} IS NULL", *between, f"{key} >= {ends[-1]}"] if ends else ["1 = 1"]
        df = spark.read.jdbc(url, table, predicates=predicates, properties=options)
    return df.toDF(*(c.lower() for c in df.columns))


def ingest_tables(
    spark: SparkSession, read: Callable[[str], DataFrame], out: str,
    tables: Sequence[str] = OPERATIONAL_TABLES,
) -> DataFrame:
    """Copy every table to ``out``/<table>; a table that fails is reported and the rest go on."""
    report = []
    for table in tables:
        try:
            publish_table(read(table), f"{out}/{table}")
            report.append((table, "loaded", None))
        except Exception as e:  # whatever stops one table must not stop the others
            report.append((table, "failed", (str(e) or repr(e)).splitlines()[0]))
    return spark.createDataFrame(report, REPORT)


def ingest_jdbc(
    spark: SparkSession,
    url: str,
    out: str,
    tables: Sequence[str] = OPERATIONAL_TABLES,
    properties: Mapping[str, str] | None = None,
    rows_per_task: int = 500_000,
) -> DataFrame:
    """Copy the operational tables of a database to ``out``."""

    def read(table: str) -> DataFrame:
        return read_jdbc_table(spark, url, table, properties or {}, rows_per_task=rows_per_task)

    return ingest_tables(spark, read, out, tables)
