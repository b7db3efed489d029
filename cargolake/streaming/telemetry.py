"""Daily telemetry ingest that reads each log file once.

The batch reader parses every log again on each run. Here the file source
remembers in its checkpoint which files it has taken; one run takes what is
new and stops. Points go to the current version of the table the batch
publishes, in plain appends.

A ledger makes a micro-batch that runs again add nothing twice. It has a row
per file, in folders by log day and batch, and a mark for each batch that began
and that ended:

* A batch that has ended is not run again.
* A batch that began and did not end may have landed in part. Its files are
  compared row by row with what landed, and only rows that lack are added.
* Any other batch leaves out the files that the ledger, the table or the
  rejects already have, as after a full run between two incremental ones.

All look-ups read the log days of the batch and no others. Points and rejects
are treated alike. So incremental and full runs may follow each other in any
order.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from cargolake.sources.tables import exists, read_optional
from cargolake.sources.telemetry import LINES, OPTIONS, broken_count, parsed, to_bronze, to_rejected, with_lineage
from cargolake.sources.versions import content, put, resolved

FILES_PER_BATCH = 100_000
FILE = ["source_file", "log_date"]


class Ledger:
    """Which files the micro-batches of a stream took, and how far each batch came."""

    def __init__(self, spark: SparkSession, folder: str, stream: str) -> None:
        self.spark, self.folder, self.stream = spark, folder, stream

    def batch(self, number: int) -> str:
        """The batch's name; numbers begin anew with every checkpoint, names do not."""
        return f"{self.stream}-{number:012d}"

    def _mark(self, batch: str, word: str) -> str:
        return f"{self.folder}/_{word}/{batch}"

    def began(self, batch: str) -> bool:
        return exists(self.spark, self._mark(batch, "began"))

    def ended(self, batch: str) -> bool:
        return exists(self.spark, self._mark(batch, "ended"))

    def begin(self, batch: str) -> None:
        put(self.spark, self._mark(batch, "began"), "")

    def end(self, batch: str) -> None:
        put(self.spark, self._mark(batch, "ended"), "")

    def record(self, batch: str, files: DataFrame) -> DataFrame:
        """Write the files of a batch (once more if it runs again) and return them."""
        rows = files.withColumn("batch", F.lit(batch))
        rows.hint("rebalance", "log_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "log_date", "batch"
        ).parquet(f"{self.folder}/files")
        return self.files().where(F.col("batch") == batch)

    def files(self) -> DataFrame:
        """``source_file``, ``lines``, ``broken``, ``log_date`` and ``batch`` of every file taken."""
        schema = "source_file string, lines long, broken long, log_date string, batch string"
        return self.spark.read.schema(schema).parquet(f"{self.folder}/files")


def of_days(table: DataFrame, days: Sequence[str]) -> DataFrame:
    """The rows of some log days, with the day as text; on a table in day folders no other folder is read."""
    day = dict(table.dtypes)["log_date"]
    return table.where(F.col("log_date").isin([F.lit(d).try_cast(day) for d in days])).withColumn("log_date", F.col("log_date").cast("string"))


def lacking(fresh: DataFrame, landed: DataFrame, ignore: Sequence[str] = ("load_timestamp",)) -> DataFrame:
    """The rows of ``fresh`` that ``landed`` has not as often, by all columns but those in ``ignore``."""
    columns = [c for c in fresh.columns if c not in ignore]
    added = fresh.select(columns).exceptAll(landed.select(columns))
    later = {c: F.lit(None).cast(fresh.schema[c].dataType) for c in fresh.columns if c in ignore}
    return added.withColumns(later).select(fresh.columns)


def stream_name(spark: SparkSession, checkpoint: str) -> str:
    """The identity Spark gave the stream of a checkpoint."""
    return json.loads("\n".join(content(spark, f"{checkpoint}/metadata")))["id"]


def land_new_telemetry(
    spark: SparkSession,
    base: str,
    out: str,
    checkpoint: str,
    run_ts: datetime,
    rejected: str | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    ledger: str | None = None,
) -> bool:
    """Append the points of new files to ``out``, partitioned by log day; tells whether there were any files.

    Lines that are no points are appended to ``rejected``, if it is given. At
    most ``files_per_batch`` files are one micro-batch; all new files are taken.
    The ledger lies beside the checkpoint unless it is given.
    """
    if not exists(spark, base):
        return False
    lines = (
        spark.readStream.schema(LINES).options(**OPTIONS).option("basePath", base)
        .option("maxFilesPerTrigger", files_per_batch).text(f"{base}/dt=*")
    )
    ledger = ledger or f"{checkpoint.rstrip('/')}_ledger"
    landed = []

    def append(batch: DataFrame, number: int) -> None:
        landed.append(land_batch(batch, number, out, run_ts, rejected, Ledger(spark, ledger, stream_name(spark, checkpoint))))

    source = lines.select("value", "dt", "_metadata.file_name")
    run = source.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    run.awaitTermination()
    return bool(landed)


def land_batch(batch: DataFrame, number: int, out: str, run_ts: datetime, rejected: str | None, ledger: Ledger) -> bool:
    """Land one micro-batch of lines (value, dt, file_name); False if it had ended before."""
    spark, name = batch.sparkSession, ledger.batch(number)
    if ledger.ended(name):
        return False
    again = ledger.began(name)
    ledger.begin(name)
    points = parsed(batch)
    files = ledger.record(name, to_files(points, run_ts))
    days = [r[0] for r in files.select("log_date").distinct().collect()]  # day folders of the batch
    known = of_days(ledger.files(), days).where(F.col("batch") != name).select(FILE)

    def add(rows: DataFrame, path: str, write: Callable[[DataFrame], None]) -> None:
        table = read_optional(spark, path)
        there = None if table is None else of_days(table, days)
        if there is not None and again:
            rows = lacking(rows, there.join(files, FILE, "left_semi"))
            rows = rows.withColumns({c: F.lit(run_ts).cast(rows.schema[c].dataType) for c in ("load_timestamp",) if c in rows.columns})
            rows = rows.join(known, FILE, "left_anti")
        else:
            taken = known if there is None else known.union(there.select(FILE))
            rows = rows.join(taken.distinct(), FILE, "left_anti")
        write(rows)

    fresh = to_bronze(points, run_ts)
    columns = fresh.columns
    add(fresh, out, lambda rows: rows.select(columns).hint("rebalance", "log_date").write.mode("append").partitionBy("log_date").parquet(resolved(spark, out)))
    if rejected is not None and not files.where("broken > 0").isEmpty():
        bad = to_rejected(points, run_ts)
        wanted = bad.columns
        add(bad, rejected, lambda rows: rows.select(wanted).write.mode("append").parquet(resolved(spark, rejected)))
    ledger.end(name)
    return True


def to_files(points: DataFrame, run_ts: datetime) -> DataFrame:
    """``source_file``, ``log_date`` and the numbers of ``lines`` and of ``broken`` ones of every file."""
    return with_lineage(points, run_ts).groupBy(*FILE).agg(F.count(F.lit(1)).alias("lines"), broken_count().alias("broken"))
